"""Sharding by proportional stratified interleaving.

Rows of each source are ranked in a seeded random order; the rank as a fraction of the source's
rows puts every source on the same scale from 0 to 1. Sorted by that fraction the sources are
interleaved in proportion, and any contiguous cut has the corpus's mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import HASH_BITS, key_text, packed, seeded_number, unpacked

SEED = 20_240_601
ROWS_PER_BIN = 1_000_000
LEAST_BINS = 4_096


def assign_shards(
    rows: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = SEED,
    rows_per_bin: int = ROWS_PER_BIN,
) -> DataFrame:
    """``rows`` with ``shard`` (int, 0 to n_shards - 1) and ``slot`` (long, gapless from 0).

    Shards differ by one row at most. A rerun, also on other partitions, deals the same rows to
    the same places; rows that agree in every column are interchangeable.

    No sort sees more than one bin: random keys and fractions both fall evenly into bins of about
    ``rows_per_bin`` rows, however the sources are sized, and only counts per bin are accumulated
    in sequence (a source's bins, then all bins).

    A NULL source is a source of its own. A NULL id draws its random key from a hash of the row, so
    many of them spread over the bins. Repeated ids share one key: their rows are ordered by a hash
    of the row. An empty table gives an empty table. Columns of ``rows``
    named ``shard`` or ``slot`` are replaced; other names never clash.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    bins = max(LEAST_BINS, rows.count() // rows_per_bin)
    unit = bins / float(1 << HASH_BITS)
    keyed = rows.select(
        packed(rows).alias("row"),
        key_text(rows[source_col]).alias("source"),
        rows[id_col].cast("string").alias("id"),
    )
    own = F.concat(F.lit("row "), F.xxhash64("row").cast("string"))
    keyed = keyed.withColumn("key", seeded_number(F.coalesce("id", own), seed)).drop("id")
    keyed = keyed.withColumn("bin", F.floor(F.col("key") * F.lit(unit)))

    of_source = Window.partitionBy("source")
    counts = keyed.groupBy("source", "bin").agg(F.count("*").alias("n"))
    counts = counts.select(
        "source",
        "bin",
        F.sum("n").over(of_source).alias("source_rows"),
        (F.sum("n").over(of_source.orderBy("bin")) - F.col("n")).alias("before"),
    )
    in_bin = Window.partitionBy("source", "bin").orderBy("key", F.xxhash64("row"))
    rank = F.col("before") + F.row_number().over(in_bin)
    ranked = (
        keyed.join(counts, ["source", "bin"])
        .withColumn("fraction", (rank - F.lit(0.5)) / F.col("source_rows"))
        .select(
            "row", "source", "fraction", F.floor(F.col("fraction") * F.lit(bins)).alias("band")
        )
    )

    everything = Window.partitionBy(F.lit(0))
    bands = ranked.groupBy("band").agg(F.count("*").alias("n"))
    bands = bands.select(
        "band",
        F.sum("n").over(everything).alias("total"),
        (F.sum("n").over(everything.orderBy("band")) - F.col("n")).alias("before"),
    )
    in_band = Window.partitionBy("band").orderBy("fraction", "source")
    placed = ranked.join(bands, "band").withColumn(
        "at", F.col("before") + F.row_number().over(in_band) - 1
    )
    placed = placed.withColumn("shard", F.expr(f"at * {n_shards}L div total"))
    return unpacked(
        placed,
        "row",
        rows.columns,
        shard=F.col("shard").cast("int"),
        slot=F.expr(f"at - (shard * total + {n_shards - 1}L) div {n_shards}L"),
    )


def write_shards(assigned: DataFrame, path: str, files: int) -> None:
    """Write assigned rows below ``path`` as ``shard=<n>`` folders, each in slot order.

    Range partitions cut large shards into several files, so no task holds a whole shard.
    """
    (
        assigned.repartitionByRange(files, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
