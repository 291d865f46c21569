"""Mixing sources to target weights by Pareto order sampling.

A source's target, divided by its size, is what every document of it is worth on average: whole
copies are allocated for certain, and for the rest each document draws random odds U/(1-U),
divided by the odds of its own inclusion. The smallest quotients are taken until the source's
remaining words are reached: a sample of fixed size with unequal probabilities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import HASH_BITS, key_text, packed, ranked, seeded_number, stored, unpacked

SEED = 7_041
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
#: A text of so many words gets half the inclusion odds of a very long one.
HALF_ODDS_WORDS = 50.0
BINS = 16_384


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
) -> DataFrame:
    """(source, source_size) -> source, source_size, target.

    Sources in order of code points, NULL last, have the ``weights`` in turn and divide
    ``share`` times all words. No target is above ``cap`` times its source; what is above is
    shared again by weight, until none is. That is one level L with target = min(cap * size,
    L * weight), L being what the sources below their cap get for each unit of weight. It rises
    until no more reach their cap, a sum over all sources each time, so there may be any number.
    """
    placed = ranked(sizes, "nth", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    placed = placed.select(
        "source", "source_size", weight.alias("weight"), (F.col("source_size") * cap).alias("most")
    )
    placed = stored(placed, "weighed-sources")
    level, full = None, 0
    while True:
        capped = F.lit(False) if level is None else F.col("most") < F.lit(level) * F.col("weight")
        total, spent, free, reached = placed.agg(
            F.sum("source_size"),
            F.sum(F.when(capped, F.col("most"))),
            F.sum(F.when(~capped, F.col("weight"))),
            F.sum(capped.cast("bigint")),
        ).first()
        if free is None or level is not None and reached == full:
            break
        level, full = (share * total - (spent or 0)) / free, reached
    if level is None:  # no sources
        return placed.select("source", "source_size", F.col("most").cast("double").alias("target"))
    target = F.when(F.col("most") < F.lit(level) * F.col("weight"), F.col("most").cast("double"))
    return placed.select(
        "source", "source_size", target.otherwise(F.lit(level) * F.col("weight")).alias("target")
    )


def mix_sources(
    rows: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: int = SEED,
    bins: int = BINS,
) -> DataFrame:
    """``rows`` with ``source_size``, ``target``, ``copies`` and ``taken`` (= copies * size).

    ``size_col`` holds the words of each row (NULL: 0). Inclusion odds are f / (1 - f), f being
    the fraction left after whole copies, times (size + 1) / (size + 50): short texts are the
    less likely to be repeated. Within a source f is the same for all, so it does not change the
    order. Of the row at the boundary, the nearer side of the target is taken; a source misses
    its target by half a document at most.

    Random numbers depend on seed and id alone, so reruns agree. Where a source's order is cut is
    found from numbers only, in sums per bin and then per bin of the bin it falls in; each row is
    then compared with its source's cut. So rows are neither sorted nor shuffled, whatever texts
    they hold, and a hot source is like any other. ``rows`` are read twice.

    A NULL source is a source of its own. A NULL id draws from a hash of the row. Rows with equal
    ids draw the same number and are ordered by size and a hash of the row; rows that agree in all
    columns are interchangeable, and only if some of those are taken and some not are they numbered.
    Sources without words have target 0. An empty table gives an empty table. Columns of ``rows``
    with the names of new columns are replaced.
    """
    drawn = _drawn(rows, id_col, source_col, size_col, seed)
    slim = drawn.withColumn("hash", F.xxhash64("row")).drop("row")
    slim = stored(slim, "drawn-rows")
    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = source_targets(totals, weights, share, cap).select(
        key_text(F.col("source")).alias("key"),
        "source_size",
        "target",
        F.coalesce(whole, F.lit(0)).cast("bigint").alias("whole"),
    )
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    targets = stored(targets.withColumn("rest", rest), "targets")
    cuts = stored(targets.drop("rest").join(_cuts(slim, targets, bins), "key", "left"), "cuts")

    dealt = drawn.drop("source").join(cuts, "key")
    at, cut = F.struct("quotient", "number", "size"), F.col("cut")
    hashed = F.xxhash64("row")
    below = (at < cut) | ((at == cut) & (hashed < F.col("cut_hash")))
    level = (at == cut) & (hashed == F.col("cut_hash"))
    extra = F.coalesce(below | (level & (F.col("equal_taken") == F.col("equal"))), F.lit(False))
    apart = cuts.where("equal_taken > 0 and equal_taken < equal")
    if apart.isEmpty():
        dealt = dealt.withColumn("extra", extra)
    else:
        tied = level & (F.col("equal_taken") > 0) & (F.col("equal_taken") < F.col("equal"))
        tied = F.coalesce(tied, F.lit(False))
        nth = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
        some = dealt.where(tied).withColumn("extra", nth <= F.col("equal_taken"))
        dealt = dealt.where(~tied).withColumn("extra", extra).unionByName(some)
    dealt = dealt.withColumn("copies", F.col("whole") + F.col("extra").cast("bigint"))
    return unpacked(
        dealt,
        "row",
        rows.columns,
        source_size=F.col("source_size"),
        target=F.col("target"),
        copies=F.col("copies"),
        taken=F.col("copies") * F.col("size"),
    )


def _drawn(rows: DataFrame, id_col: str, source_col: str, size_col: str, seed: int) -> DataFrame:
    """row, key, source, size, number, quotient."""
    size = F.coalesce(rows[size_col].cast("bigint"), F.lit(0).cast("bigint"))
    drawn = rows.select(
        packed(rows).alias("row"),
        rows[source_col].cast("string").alias("source"),
        size.alias("size"),
        rows[id_col].cast("string").alias("id"),
    )
    own = F.concat(F.lit("row "), F.xxhash64("row").cast("string"))
    drawn = drawn.withColumn("number", seeded_number(F.coalesce("id", own), seed)).drop("id")
    uniform = (F.col("number") + F.lit(0.5)) / F.lit(float(1 << HASH_BITS))
    odds = uniform / (1 - uniform)
    tilt = (F.col("size") + F.lit(1.0)) / (F.col("size") + F.lit(HALF_ODDS_WORDS))
    return drawn.withColumn("quotient", odds / tilt).withColumn("key", key_text(F.col("source")))


def _cuts(slim: DataFrame, targets: DataFrame, bins: int) -> DataFrame:
    """Where each source's order is cut: key, cut, cut_hash, equal, equal_taken.

    ``cut`` is (quotient, number, size) of the last rows taken. Of several such rows those below
    ``cut_hash`` are taken, and of the ``equal`` ones with that hash ``equal_taken``. Sources that
    need nothing beyond whole copies have no row.
    """
    quotient = F.col("quotient")
    scaled = quotient / (1 + quotient) * F.lit(bins)
    slim = slim.withColumn("bin", F.floor(scaled))
    slim = slim.withColumn("fine", F.floor((scaled - F.col("bin")) * F.lit(bins)))
    limits = targets.where("rest > 0").select("key", "rest", F.lit(0).cast("bigint").alias("start"))

    def narrowed(sums: DataFrame, known: DataFrame, *by: str) -> DataFrame:
        """The last bin that begins at or before the cut; all bins before it are taken whole."""
        running = Window.partitionBy("key").orderBy(*by)
        start = F.col("start") + F.sum("words").over(running) - F.col("words")
        found = sums.join(known, "key").withColumn("start", start).where("start <= rest")
        last = F.max(F.struct(*by, "start", *[c for c in sums.columns if c not in ("key", "words", *by)]))
        return found.groupBy("key", "rest").agg(last.alias("last")).select("key", "rest", "last.*")

    for name in ("bin", "fine"):
        limits = stored(narrowed(slim.groupBy("key", name).agg(F.sum("size").alias("words")), limits, name), "bins")
        slim = slim.join(limits.select("key", name), ["key", name])
        limits = limits.drop(name)
    order = ("quotient", "number", "size")
    groups = slim.groupBy("key", *order).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    left = F.col("rest") - F.col("start")
    full = F.when(F.col("size") > 0, F.floor(left / F.col("size"))).otherwise(F.col("n"))
    taken = F.least(full, "n").cast("bigint")
    below = left - F.col("taken") * F.col("size")  # what is missing after those that fit
    nearer = (F.col("taken") < F.col("n")) & (below > 0) & (F.col("size") - below <= below)
    last = narrowed(groups, limits, *order).withColumn("taken", taken)
    last = last.withColumn("taken", F.col("taken") + nearer.cast("bigint"))
    last = stored(last.select("key", F.struct(*order).alias("cut"), "n", "taken"), "cut-groups")

    # Several rows of one id and size: the smallest hashes are taken, found by bins once more.
    whole = last.where("taken = 0 or taken = n").select(
        "key", "cut", F.lit(-(1 << 63)).cast("bigint").alias("cut_hash"), F.lit(0).cast("bigint").alias("equal"),
        F.lit(0).cast("bigint").alias("equal_taken"), "taken",
    )
    most = F.when(F.col("taken") > 0, F.lit((1 << 63) - 1)).otherwise(F.col("cut_hash"))
    whole = whole.withColumn("cut_hash", most.cast("bigint")).drop("taken")
    some = last.where("taken > 0 and taken < n").select("key", "cut", "taken")
    tied = slim.withColumn("cut", F.struct(*order)).join(some, ["key", "cut"])
    for by in (F.shiftright("hash", 48), F.col("hash")):
        counts = tied.groupBy("key", "cut", "taken", by.alias("part")).agg(F.count("*").alias("c"))
        upto = F.sum("c").over(Window.partitionBy("key").orderBy("part"))
        first = counts.withColumn("upto", upto).where("upto >= taken").groupBy("key").agg(
            F.min(F.struct("part", "c", "upto", "taken", "cut")).alias("f")
        ).select("key", "f.*")
        here = first.select("key", "cut", "part", (F.col("taken") - F.col("upto") + F.col("c")).alias("taken"), "c")
        tied = tied.drop("cut", "taken").withColumn("part", by).join(here.drop("c"), ["key", "part"]).drop("part")
    some = here.select(
        "key", "cut", F.col("part").alias("cut_hash"), F.col("c").alias("equal"), F.col("taken").alias("equal_taken")
    )
    return whole.unionByName(some)


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: ``columns`` of every row as often as ``copies`` says."""
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return (
        mixed.where(F.col("copies") > 0)
        .select(packed(mixed.select(*columns)).alias("row"), copies.alias("nth"))
        .select("row.*")
    )
