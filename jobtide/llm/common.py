"""What several corpus operators share: packed rows, seeded numbers, stored results, samples."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.sources.store import scratch_path

SAMPLE_SEED = 5
HASH_BITS = 52  # a whole number of so many bits is exact as a double


def quoted(name: str) -> Column:
    """The column called exactly ``name``, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, without: str | None = None) -> Column:
    """The columns of ``df`` as one struct, so that helper columns cannot clash with them."""
    kept = [quoted(c).alias(c) for c in df.columns if c != without]
    return F.struct(*kept or [F.lit(0).alias("_")])


def unpacked(df: DataFrame, row: str, columns: list[str], **new: Column) -> DataFrame:
    """``columns`` of struct ``row`` and then ``new`` ones, which replace columns of their name."""
    taken = {c.lower() for c in new}
    return df.select(
        *[F.col(row).getField(c).alias(c) for c in columns if c.lower() not in taken],
        *[value.alias(name) for name, value in new.items()],
    )


def key_text(column: Column) -> Column:
    """A key as text that is never NULL and keeps NULL apart from every value."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("~"))


def seeded_number(column: Column, seed: int) -> Column:
    """A whole number below 2**52 that depends on the seed and the value alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the session's shared scratch folder and read again.

    Cuts the lineage: an executor lost later does not start the work again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with a stored column ``name``: the place of each row in ``order``, from 0.

    Sorted by ranges, so no task has all rows; only row counts of the partitions, one number each,
    are added up in sequence. Columns of ``df`` must not be called ``name``.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id()
    sorted_ = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, place), "ranked")
    part = F.shiftright(name, 33)
    before, total = [], 0
    for row in sorted(sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
        before.append((row.part, total))
        total += row.n
    parts = F.broadcast(spark.createDataFrame(before, "__part long, __before long"))  # a row per partition
    rank = F.col("__before") + F.expr(f"`{name}` & {(1 << 33) - 1}L")
    return sorted_.join(parts, part == F.col("__part")).withColumn(name, rank).drop("__part", "__before")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    usable: Column,
    size: int,
    most_bytes: int = 65_536,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[pa.Array, list[int]]:
    """Texts and labels of a bounded sample: ``size`` documents of each class, by a seeded hash.

    ``usable`` selects rows of ``labels``. Twice as many ids are drawn first, from the labels
    alone, as labels may lack a document; ids and texts that reach the driver are bounded by
    ``size`` and ``most_bytes``. Rows with a NULL id or label are not used, and of repeated
    labels of one id the smaller counts.
    """
    drawn = None
    for value in (0, 1):
        ids = (
            labels.where(usable & F.col(id_col).isNotNull() & (F.col(label) == value))
            .select(F.col(id_col).alias("id"), F.lit(value).alias("label"))
            .orderBy(seeded_number(F.col("id"), SAMPLE_SEED), "id")
            .limit(2 * size)
        )
        drawn = ids if drawn is None else drawn.unionByName(ids)
    drawn = drawn.groupBy("id").agg(F.min("label").alias("label"))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where(
        F.octet_length("text") <= most_bytes
    )
    found = texts.join(F.broadcast(drawn), "id")  # 4 * size ids at most
    each = [
        found.where(F.col("label") == value)
        .orderBy(seeded_number(F.col("id"), SAMPLE_SEED), "id", "text")
        .limit(size)
        for value in (0, 1)
    ]
    table = each[0].unionByName(each[1]).select("text", "label").toArrow()
    return table.column("text").combine_chunks(), table.column("label").to_pylist()
