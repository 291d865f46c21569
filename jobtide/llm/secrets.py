"""Secret scans in DataFrame functions alone: fixed patterns and sliding-window entropy.

What no fixed pattern and no placeholder covers of a candidate string is read through a window; the Shannon entropy of
the window is kept up to date from the counts of its characters as one enters and one leaves.
Runs of windows above the limit of the stretch's character class form spans, unless an allow-list
knows the stretch.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import packed, unpacked

#: Fixed patterns, kinds in order: pattern, group whose length counts, least length.
KINDS: dict[str, tuple[str, int, int]] = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
        r"([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Character class of a candidate or of a stretch left of it -> least entropy of a window, in bits a character.
CLASSES: dict[str, tuple[str, float]] = {
    "hex": (r"[0-9a-f]+|[0-9A-F]+", 3.2),
    "one_case": (r"[0-9a-z]+|[0-9A-Z]+", 3.6),
    "mixed": (r".*", 3.8),
}
#: Strings that are no secrets: words, numbers, UUIDs.
ALLOWED: tuple[str, ...] = (
    r"[A-Z]?[a-z/_=-]+|[A-Z/_=-]+",
    r"[0-9+/_=-]+",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
)
#: Placeholders and counting; one covers the part of a candidate between slashes and equals signs
#: that holds it, and no other part.
PLACEHOLDERS = (
    r"(?i)(?<![^/=])[^/=]*?(?:example|sample|dummy|placeholder|changeme|redacted|xxxx"
    r"|abcdefgh|01234567|12345678)[^/=]*"
)


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running(values: str, step: str, zero: str) -> str:
    """SQL: for each of ``values`` what ``step`` (of ``a`` and ``x``) makes of all before it.

    An array grows by copying it, so this goes over blocks of a square root of the values, and then
    over the blocks' results.
    """
    grown = f"(acc, x) -> concat(acc, array({let('element_at(acc, -1)', 'a', step)}))"
    blocks = f"""transform(sequence(0, (size(v) - 1) div b), k ->
        aggregate(slice(v, k * b + 1, b), array({zero}), {grown}))"""
    before = f"aggregate(transform(blocks, p -> element_at(p, -1)), array({zero}), {grown})"
    each = f"transform(slice(p, 1, size(p) - 1), x -> {let('get(done, k)', 'a', step)})"
    body = let(before, "done", f"flatten(transform(blocks, (p, k) -> {each}))")
    size = "greatest(16, cast(ceil(sqrt(size(v))) as int))"
    return let(values, "v", let(size, "b", let(blocks, "blocks", body)))


def matches(text: str, pattern: str, kind: int, name: str, group: int, least: int) -> str:
    """SQL: the leftmost non-overlapping matches in column ``text``, as an array of
    (start, kind, name, end, value); matches whose ``group`` is shorter than ``least`` are dropped.

    Pieces between matches and the matches themselves add up to the text, which gives the
    positions in code points; the last piece has no match and is dropped with the short ones.
    Texts without a match cost one search.
    """
    p = _sql_text(pattern)
    spans = "array<struct<start: int, kind: int, name: string, end: int, value: string>>"
    parts = f"""arrays_zip(split({text}, {p}), regexp_extract_all({text}, {p}, 0),
        regexp_extract_all({text}, {p}, {group}))"""
    lengths = "transform(parts, m -> length(m.`0`) + coalesce(length(m.`1`), 0))"
    span = f"""named_struct('start', get(before, i) + length(m.`0`), 'kind', {kind},
        'name', {_sql_text(name)}, 'end', get(before, i) + length(m.`0`) + length(m.`1`),
        'value', m.`2`)"""
    found = let(running(lengths, "a + x", "0"), "before", f"transform(parts, (m, i) -> {span})")
    return f"""if({text} rlike {p}, filter({let(parts, "parts", found)},
        s -> length(s.value) >= {least}), cast(array() as {spans}))"""


def hot_stretches(value: str, limit: str, window: int = WINDOW) -> str:
    """SQL: (from, to) of the runs of windows of ``value`` with an entropy of ``limit`` bits at
    least, first start to last end; runs that share characters are one.

    The state holds how often each character of the alphabet is in the window, and the sum of
    c * log2(c) over these counts; H = log2(window) - sum / window. A step changes two counts.
    """
    plogp = ", ".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(window + 2))
    index = f"instr({_sql_text(ALPHABET)}, {{}}) - 1"
    run = "named_struct('from', {}, 'to', {})"
    hot = f"b.i >= {window} and {math.log2(window)!r}D - b.s / {window} >= {limit}"
    apart = f"a.from is not null and b.i - {window} > a.to"
    whole = run.format("a.from", "a.to")
    return f"""transform(array(split({value}, '')), cs -> aggregate(
        transform(cs, (c, i) -> named_struct(
            'new', {index.format('c')},
            'old', if(i >= {window}, {index.format(f"get(cs, i - {window})")}, -1))),
        named_struct('i', 0, 'counts', array_repeat(0, {len(ALPHABET)}), 's', 0.0D,
            'from', cast(null as int), 'to', cast(null as int),
            'runs', cast(array() as array<struct<from: int, to: int>>)),
        (a, x) -> transform(array(named_struct(
            'i', a.i + 1,
            'counts', transform(a.counts, (c, k) -> c + int(k = x.new) - int(k = x.old)),
            's', a.s + if(x.new = x.old, 0.0D,
                get(array({plogp}), get(a.counts, x.new) + 1)
                - get(array({plogp}), get(a.counts, x.new))
                + if(x.old < 0, 0.0D, get(array({plogp}), get(a.counts, x.old) - 1)
                    - get(array({plogp}), get(a.counts, x.old)))))), b -> if({hot},
            named_struct('i', b.i, 'counts', b.counts, 's', b.s,
                'from', if(a.from is null or {apart}, b.i - {window}, a.from), 'to', b.i,
                'runs', if({apart}, concat(a.runs, array({whole})), a.runs)),
            named_struct('i', b.i, 'counts', b.counts, 's', b.s,
                'from', a.from, 'to', a.to, 'runs', a.runs)))[0],
        a -> if(a.from is null, a.runs, concat(a.runs, array({whole})))))[0]"""


#: Long candidates are kept in blocks, as reading amid a long text starts at its front.
BLOCK = 4_096


def in_blocks(spans: str) -> str:
    """SQL: candidates as (start, end, blocks)."""
    return f"""transform({spans}, c -> named_struct('start', c.start, 'end', c.end,
        'blocks', regexp_extract_all(c.value, '.{{1,{BLOCK}}}', 0)))"""


def placeholder_spans(spans: str, placeholders: str) -> str:
    """SQL: (start, end) of all placeholders in candidates."""
    found = matches("c.value", placeholders, 0, "placeholder", 0, 1)
    return f"""flatten(transform({spans}, c -> transform({found}, p -> named_struct(
        'start', c.start + p.start, 'end', c.start + p.end))))"""


def stretches(candidates: str, base: str, placed: str, window: int = WINDOW) -> str:
    """SQL: what is left of ``candidates`` (in blocks) outside the spans ``base`` and ``placed``, from
    ``window`` on, as (start, end, value, bare); ``bare`` is the value that classes and allow-list
    look at: without punctuation at the ends if something was cut off.

    One sweep over all starts and ends in order: a stretch lies between the furthest end so far and
    the next start, if both are in the candidate that began last.
    """
    event = "named_struct('at', {}, 'order', {}, 'upto', {}, 'nth', {})"
    cut = f"s -> {event.format('s.start', '1', 's.end', '-1')}"
    events = f"""array_sort(concat(transform({base}, {cut}), transform({placed}, {cut}),
        transform({candidates}, (c, i) -> {event.format('c.start', '0', 'c.start', 'i')}),
        transform({candidates}, c -> {event.format('c.end', '1', 'c.end', '-1')})))"""
    upto = running("transform(events, e -> e.upto)", "greatest(a, x)", "0")
    nth = running("transform(events, e -> e.nth)", "greatest(a, x)", "-1")
    free = let(upto, "upto", let(nth, "nth", """filter(
        transform(events, (e, i) -> named_struct('start', get(upto, i), 'end', e.at,
            'c', get(CANDIDATES, get(nth, i)))),
        s -> s.c is not null and s.end - s.start >= WINDOW and s.start >= s.c.start
            and s.end <= s.c.end)""".replace("CANDIDATES", candidates).replace("WINDOW", str(window))))
    low, high = "(s.start - s.c.start)", "(s.end - s.c.start)"
    blocks = f"slice(s.c.blocks, {low} div {BLOCK} + 1, ({high} - 1) div {BLOCK} - {low} div {BLOCK} + 1)"
    value = f"substring(array_join({blocks}, ''), {low} % {BLOCK} + 1, s.end - s.start)"
    whole = "s.end - s.start = s.c.end - s.c.start"
    each = f"""named_struct('start', s.start, 'end', s.end, 'value', value,
        'bare', if({whole}, value, btrim(value, '+/_=-')))"""
    return f"transform({let(events, 'events', free)}, s -> {let(value, 'value', each)})"


def digest(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    each = f"transform({spans}, s -> concat_ws(':', s.name, s.start, s.end))"
    return F.expr(f"array_join({each}, ',')")


def find_secrets(
    docs: DataFrame,
    text_col: str = "text",
    kinds: Mapping[str, tuple[str, int, int]] = KINDS,
    classes: Mapping[str, tuple[str, float]] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
    window: int = WINDOW,
    placeholders: str = PLACEHOLDERS,
) -> DataFrame:
    """``docs`` without the text, with ``n_<kind>``, ``base`` and ``spans``.

    ``base`` holds the spans of the fixed patterns and ``spans`` those and the entropy spans, as
    arrays of (start, kind, name, end), sorted by start and then by kind. Positions count code
    points, ends are exclusive. Entropy spans (``entropy``, the last kind) are looked for in the
    stretches of candidates outside base spans and placeholders, so none overlaps a base span, and
    what stands beside one is still found.

    NULL counts as empty and has no spans. Texts are scanned whole, of any length and with any number
    of matches: positions are running sums over blocks, spans are swept once in order. One row never
    looks at another, so ties and repeated rows change nothing. Columns of ``docs`` with the names
    of new columns are replaced.
    """
    step = docs.select(
        packed(docs, text_col).alias("row"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    base = [
        F.expr(matches("text", pattern, i, name, group, least)).alias(name)
        for i, (name, (pattern, group, least)) in enumerate(kinds.items())
    ]
    found = matches("text", CANDIDATE, len(kinds), "entropy", 0, window)
    step = step.select("row", *base, F.expr(found).alias("found"))
    step = step.withColumn("base", F.expr(f"array_sort(concat({', '.join(kinds)}))"))
    step = step.withColumn("placed", F.expr(placeholder_spans("found", placeholders)))
    step = step.withColumn("candidates", F.expr(in_blocks("found"))).drop("found")
    known = " or ".join(f"c.bare rlike {_sql_text(f'^(?:{p})$')}" for p in allowed) or "false"
    left = stretches("candidates", "base", "placed", window)
    fresh = f"if(size(candidates) = 0, null, filter({left}, c -> not ({known})))"
    step = step.withColumn("fresh", F.expr(fresh)).drop("candidates", "placed")
    limit = " ".join(
        f"when c.bare rlike {_sql_text(f'^(?:{p})$')} then {bits!r}D"
        for p, bits in classes.values()
    )
    hot = f"""transform(fresh, c -> named_struct('c', c, 'runs', {let(
        f'case {limit} end', 'least', hot_stretches('c.value', 'least', window))}))"""
    step = step.withColumn("hot", F.expr(f"if(coalesce(size(fresh), 0) <= 0, null, {hot})"))
    slim = "named_struct('start', {}, 'kind', {}, 'name', {}, 'end', {})"
    span = slim.format("h.c.start + r.from", len(kinds), "'entropy'", "h.c.start + r.to")
    entropy = f"flatten(transform(coalesce(hot, array()), h -> transform(h.runs, r -> {span})))"
    plain = f"transform(base, s -> {slim.format('s.start', 's.kind', 's.name', 's.end')})"
    return unpacked(
        step,
        "row",
        [c for c in docs.columns if c != text_col],
        **{f"n_{name}": F.size(name).cast("bigint") for name in kinds},
        base=F.expr(plain),
        spans=F.expr(f"array_sort(concat({plain}, {entropy}))"),
    )
