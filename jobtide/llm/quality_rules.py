"""Quality rules as weak supervision, in DataFrame functions alone.

Rules vote good (1), bad (-1) or abstain (0). Expectation-maximisation over the votes of all
documents estimates how often good and bad documents get each vote; a document is kept by its
posterior probability of being good, not by passing every rule.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import packed, stored, unpacked

#: name -> tests of (measure, bad above, good below, bad below, good above); None: no such limit.
#: Measures that see the same fault are tests of one rule, as the model takes rules as independent.
RULES: dict[str, tuple[tuple[str, float | None, float | None, float | None, float | None], ...]] = {
    "length": (("n_words", None, None, 50, 100),),
    "word_length": (("word_chars / n_words", 14, 11, 2.5, None),),
    "symbols": (
        ("n_symbols / n_words", 0.10, 0.03, None, None),
        ("n_symbols / word_chars", 0.04, 0.01, None, None),
    ),
    "letters": (("n_letters / word_chars", None, None, 0.85, 0.93),),
    "dup_lines": (("n_dup_lines / n_lines", 0.50, 0.20, None, None),),
    "repeats": (("n_repeat_words / n_words", 0.40, 0.20, None, None),),
    "vocabulary": (("n_distinct / n_words", None, None, 0.10, 0.25),),
}
ROUNDS = 300
#: Beliefs about votes on good and on bad documents: how often right, and worth how many documents.
RIGHT_ON_GOOD = (0.99, 50)
RIGHT_ON_BAD = (0.4, 50)
#: Rules are written to accuse good documents seldom. Without this, a fault that one rule alone sees
#: would be taken for that rule's mistake on good documents, as votes cannot tell these apart.
LEAST_RIGHT_ON_GOOD = 0.99
KEEP_FROM = 0.5

_WS = r" \t\n\x0B\f\r"


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` (without the text) and the measures of every whole text.

    ``n_words``: ``[^\\x20\\x09-\\x0D]+``; ``word_chars``: their code points; ``n_symbols``:
    ``[#*$%&|<>]``; ``n_letters``: code points of letters; ``n_lines``: \\n-split lines with a
    word; ``n_dup_lines``: those equal to an earlier one; ``n_distinct``: different words;
    ``n_repeat_words``: words inside three-word windows that occur at least twice in the text.
    NULL counts as empty; all are 0 then.

    Repeats are found by sorting, not by comparing all windows: hashes of windows with their
    position in the low bits are sorted as plain numbers, and only windows whose shortened hash
    meets an equal one are sorted again by their words, which decides. No text is cut.
    """
    step = docs.select(
        packed(docs, text_col).alias("row"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    step = step.withColumn("bare", F.btrim(F.col("text"), F.lit(" \t\n\x0b\f\r")))
    step = step.withColumn(
        "words",
        F.when(F.col("bare") == "", F.array().cast("array<string>")).otherwise(
            F.split("bare", f"[{_WS}]+")
        ),
    )
    lines = f"filter(split(text, '\\n'), l -> l rlike '[^{_WS}]')".replace("\\", "\\\\")
    step = step.select(
        "row",
        "words",
        F.size("words").alias("n"),
        F.expr("length(array_join(words, ''))").cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"\P{L}+", "")).cast("bigint").alias("n_letters"),
        F.expr(lines).alias("lines"),
        F.expr("size(array_distinct(words))").cast("bigint").alias("n_distinct"),
        F.expr("transform(words, w -> xxhash64(w))").alias("h"),
    )
    step = step.withColumn("bits", F.expr("length(bin(n))")).withColumn(
        "sorted",
        F.expr(
            """if(n < 3, cast(array() as array<bigint>), sort_array(transform(sequence(0, n - 3),
               i -> shiftleft(xxhash64(get(h, i), get(h, i + 1), get(h, i + 2)), bits) | i)))"""
        ),
    )
    step = step.withColumn(
        "maybe",
        F.expr(
            """transform(filter(sorted, (x, i) ->
                 shiftright(x, bits) = shiftright(coalesce(get(sorted, i - 1), ~x), bits)
                 or shiftright(x, bits) = shiftright(coalesce(get(sorted, i + 1), ~x), bits)),
               x -> cast(x & (shiftleft(1L, bits) - 1) as int))"""
        ),
    )
    step = step.withColumn(
        "named",
        F.expr(
            """sort_array(transform(maybe, p -> named_struct(
                 'a', get(words, p), 'b', get(words, p + 1), 'c', get(words, p + 2), 'p', p)))"""
        ),
    )
    same = "x.a = get(named, {0}).a and x.b = get(named, {0}).b and x.c = get(named, {0}).c"
    twice = f"filter(named, (x, i) -> coalesce({same.format('i - 1')}, false) or " + (
        f"coalesce({same.format('i + 1')}, false))"
    )
    step = step.withColumn("starts", F.expr(f"sort_array(transform({twice}, x -> x.p))"))
    covered = F.expr(
        """aggregate(starts, named_struct('last', -3, 'n', 0L), (a, p) -> named_struct(
             'last', p, 'n', a.n + least(3, p - a.last)), a -> a.n)"""
    )
    return unpacked(
        step,
        "row",
        [c for c in docs.columns if c != text_col],
        n_words=F.col("n").cast("bigint"),
        word_chars=F.col("word_chars"),
        n_symbols=F.col("n_symbols"),
        n_letters=F.col("n_letters"),
        n_dup_lines=F.expr("size(lines) - size(array_distinct(lines))").cast("bigint"),
        n_repeat_words=covered,
        n_lines=F.size("lines").cast("bigint"),
        n_distinct=F.col("n_distinct"),
    )


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def votes(rules: Mapping[str, tuple] = RULES) -> dict[str, Column]:
    """Each rule as a column of 1, 0 or -1: bad if one of its tests is, good if all are.

    A ratio without a denominator abstains.
    """
    return {name: F.least(*[_vote(test) for test in tests]) if len(tests) > 1 else _vote(tests[0])
            for name, tests in rules.items()}


def _vote(test: tuple) -> Column:
    ratio, bad_above, good_below, bad_below, good_above = test
    over, _, under = ratio.partition(" / ")
    x = F.col(over).cast("double")
    x = F.try_divide(x, F.col(under)) if under else x
    vote = F.lit(None).cast("int")
    cases = [
        (bad_above, lambda v: x > v, -1),
        (bad_below, lambda v: x < v, -1),
        (good_below, lambda v: x < v, 1),
        (good_above, lambda v: x > v, 1),
    ]
    for limit, holds, value in cases:
        if limit is not None:
            vote = F.coalesce(vote, F.when(holds(limit), F.lit(value)))
    return F.coalesce(vote, F.lit(0))


def estimate(
    patterns: list[tuple[tuple[int, ...], int]],
    rounds: int = ROUNDS,
    on_good: tuple[float, float] = RIGHT_ON_GOOD,
    on_bad: tuple[float, float] = RIGHT_ON_BAD,
    least_right_on_good: float = LEAST_RIGHT_ON_GOOD,
) -> dict:
    """Expectation-maximisation over (votes, documents) pairs.

    Returns ``good`` (share of good documents) and for each rule ``right_good`` and ``right_bad``:
    how often its votes on good, and on bad documents are right. ``on_good`` and ``on_bad`` are
    where the search starts and prior beliefs, worth a fixed number of documents, so that with many
    documents the votes decide. Ends when nothing changes any more.
    """
    n_rules = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns)
    (g0, g_weight), (b0, b_weight) = on_good, on_bad
    good, right_good, right_bad = 0.85, [g0] * n_rules, [b0] * n_rules
    for _ in range(rounds):
        q = [posterior(v, good, right_good, right_bad) for v, _ in patterns]
        good = (sum(p * n for p, (_, n) in zip(q, patterns)) + 8) / (total + 10)
        before = [*right_good, *right_bad]
        for j in range(n_rules):
            cast = [(p, n, v[j]) for p, (v, n) in zip(q, patterns) if v[j]]
            voted_good = sum(p * n for p, n, _ in cast)
            voted_bad = sum((1 - p) * n for p, n, _ in cast)
            hit_good = sum(p * n for p, n, v in cast if v > 0)
            hit_bad = sum((1 - p) * n for p, n, v in cast if v < 0)
            right = (hit_good + g0 * g_weight) / (voted_good + g_weight)
            right_good[j] = max(least_right_on_good, right)
            right_bad[j] = (hit_bad + b0 * b_weight) / (voted_bad + b_weight)
        if max((abs(x - y) for x, y in zip(before, [*right_good, *right_bad])), default=0) < 1e-9:
            break
    return {"good": good, "right_good": right_good, "right_bad": right_bad}


def _weights(good: float, right_good: list[float], right_bad: list[float]):
    """Log odds of good: prior, and what a good and a bad vote of each rule add."""
    return math.log(good / (1 - good)), [
        (math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in zip(right_good, right_bad)
    ]


def posterior(vote: tuple[int, ...], good, right_good, right_bad) -> float:
    odds, each = _weights(good, right_good, right_bad)
    odds += sum(up if v > 0 else down for v, (up, down) in zip(vote, each) if v)
    return 1 / (1 + math.exp(-odds))


def judge(
    docs: DataFrame,
    text_col: str = "text",
    rules: Mapping[str, tuple] = RULES,
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """``docs`` without the text, with the measures, ``vote_<rule>``, ``posterior``,
    ``base_failed`` and ``kept`` (not base_failed, and posterior >= keep_from).

    Measures are computed once and written to the shared scratch folder as numbers. The votes of
    all documents are counted there by pattern; the driver gets these counts, at most
    3 ** len(rules) rows whatever the input, and runs the estimation on them.

    NULL and empty texts have no words: they fail the base and abstain in all ratios. Repeated
    rows get equal verdicts, an empty table gives an empty one. Columns of ``docs`` with the names
    of new columns are replaced.
    """
    found = stored(measure(docs, text_col), "quality-measures")
    names = list(rules)
    cast = found.select(*[v.alias(n) for n, v in votes(rules).items()])
    counts = cast.groupBy(*names).count().collect()
    patterns = sorted((tuple(r[n] for n in names), r["count"]) for r in counts)
    model = estimate(patterns)
    prior, each = _weights(**model) if patterns else (0.0, [])
    odds = F.lit(prior)
    for (up, down), vote in zip(each, votes(rules).values()):
        odds = odds + F.when(vote > 0, F.lit(up)).when(vote < 0, F.lit(down)).otherwise(0.0)
    chance = 1 / (1 + F.exp(-odds))
    new = {f"vote_{n}": v for n, v in votes(rules).items()}
    taken = {c.lower() for c in (*new, "posterior", "base_failed", "kept")}
    return found.select(
        *[F.col(f"`{c}`") for c in found.columns if c.lower() not in taken],
        *[v.alias(n) for n, v in new.items()],
        chance.alias("posterior"),
        base_failed().alias("base_failed"),
        (~base_failed() & (chance >= keep_from)).alias("kept"),
    )
