"""Benchmark decontamination: Wu-Manber search for many word patterns at once.

The alphabet is words. Patterns of one length form a table: for each block of words the shift
table says how far the search may jump, 0 only for blocks that end a pattern; there the bucket of
that suffix block lists the test strings, and direct comparison confirms the occurrence.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm import byte_text
from jobtide.llm.common import packed, stored, unpacked

WINDOW = 10
BLOCK = 3
#: Benchmark bytes searched for in one pass; a larger benchmark takes several passes.
PASS_BYTES = 16 << 20
#: Long texts are split into runs of words of about this many bytes, which overlap by a pattern.
RUN_BYTES = 4 << 20

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
#: ``hits`` are starts and ends in turn; ``anonymous`` tells of items without id.
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("anonymous", T.BooleanType()),
    ]
)


def words_of(text: bytes, limit: int = RUN_BYTES) -> Iterator[list[bytes]]:
    """Words of a UTF-8 text with A-Z lower-cased, in runs; no run cuts a word."""
    text = text.lower()  # of bytes: A-Z alone
    at = 0
    while at < len(text):
        end = at + limit
        gap = GAP.search(text, end) if end < len(text) else None
        end = gap.start() if gap else len(text)
        yield WORD.findall(text, at, end)
        at = end


class WuManber:
    """Search tables for windows of ``length`` words, as numbers.

    ``words`` are the numbers of all items' words, 1 or more; windows begin at ``starts`` and belong
    to items ``owners``. Shift table and buckets go by a hash of a block of words, so their size is
    a few bytes a window.
    """

    def __init__(self, length: int, words: np.ndarray, starts: np.ndarray, owners: np.ndarray):
        self.length, self.words = length, words
        self.block = min(BLOCK, length)
        self.skip = length - self.block + 1
        self.bits = min(26, max(8, int(4 * len(starts)).bit_length()))
        self.shift = np.full(1 << self.bits, self.skip, np.uint8)
        hashes = self._hashes(words)
        for back in range(self.skip - 1, -1, -1):
            self.shift[hashes[starts + length - back - self.block]] = back
        last = hashes[starts + length - self.block]
        windows = np.lib.stride_tricks.sliding_window_view(words, length)
        mixed = np.zeros(len(starts), np.uint64)
        for k in range(length):
            mixed = byte_text.mix(mixed ^ words[starts + k].astype(np.uint64))
        order = np.lexsort((mixed, last))
        starts, owners, last, mixed = starts[order], owners[order], last[order], mixed[order]
        new = np.ones(len(starts), bool)
        new[1:] = (last[1:] != last[:-1]) | (mixed[1:] != mixed[:-1])
        same = np.flatnonzero(~new)
        new[same] = (windows[starts[same]] != windows[starts[same - 1]]).any(axis=1)
        first = np.flatnonzero(new)
        self.at = starts[first].astype(np.int32)
        self.owners, self.owned = owners, np.append(first, len(starts)).astype(np.int32)
        self.bucket = np.searchsorted(last[first], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def _hashes(self, words: np.ndarray) -> np.ndarray:
        """Of the block of words that starts at each word."""
        n = max(0, len(words) - self.block + 1)
        mixed = np.zeros(n, np.uint64)
        for k in range(self.block):
            mixed = (mixed ^ words[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(end, item numbers) of every occurrence, in the order of ends; 0 is an unknown word."""
        length, block = self.length, self.block
        end, n = length, len(words)
        if n < length:
            return
        hashes = self._hashes(words)
        known = words[: len(hashes)] > 0
        for k in range(1, block):
            known &= words[k : k + len(hashes)] > 0
        jumps = np.where(known, self.shift[hashes], self.skip).tobytes()
        while end <= n:
            jump = jumps[end - block]
            if jump:
                end += jump
                continue
            at = hashes[end - block]
            here = words[end - length : end]
            for k in range(self.bucket[at], self.bucket[at + 1]):
                start = self.at[k]
                if (self.words[start : start + length] == here).all():
                    yield end, self.owners[self.owned[k] : self.owned[k + 1]]
            end += 1


class Tables(NamedTuple):
    """The number of each word of the items, a search for each length of window, item ids."""

    numbers: dict[bytes, int]
    searches: list[WuManber]
    items: list[str | None]


def tables(items: Iterable[tuple[str | None, bytes]], window: int = WINDOW) -> Tables:
    """Tables of (item id, text) pairs, with a search for each length of window.

    A window is ``window`` consecutive words of an item, or all words of a shorter one.
    """
    numbers: dict[bytes, int] = {}
    ids, parts, sizes = [], [], []
    for item, text in items:
        own = [numbers.setdefault(w, len(numbers) + 1) for run in words_of(text) for w in run]
        if own:
            ids.append(item)
            parts.append(np.array(own, np.int32))
            sizes.append(len(own))
    if not ids:
        return Tables({}, [], [])
    words, sizes = np.concatenate(parts), np.array(sizes)
    owner = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    begins = np.repeat(np.cumsum(sizes) - sizes, sizes)
    lengths = np.minimum(sizes, window)[owner]
    place = np.arange(len(words))
    fits = place - begins + lengths <= sizes[owner]
    searches = []
    for length in np.unique(lengths).tolist():
        starts = np.flatnonzero(fits & (lengths == length))
        searches.append(WuManber(length, words, starts, owner[starts]))
    return Tables(numbers, searches, ids)


def scan(text: bytes, found: Tables, run_bytes: int = RUN_BYTES):
    """(words, [start, end, start, end, ...] of the hit stretches, items that occur)."""
    carry = max((s.length for s in found.searches), default=1) - 1
    number = found.numbers.get
    seen, tail, stretches, items = 0, np.empty(0, np.int32), [], set()
    for run in words_of(text, run_bytes):
        own = np.fromiter(map(number, run, repeat(0)), np.int32, len(run))
        words = np.concatenate([tail, own]) if len(tail) else own
        base = seen - len(tail)
        for search in found.searches:
            for end, owners in search.search(words):
                if end > len(tail):  # else the run before has reported it
                    stretches.append((base + end - search.length, base + end))
                    items.update(owners.tolist())
        seen += len(run)
        tail = words[len(words) - carry :] if 0 < carry < len(words) else words[: carry and len(words)]
    return seen, merged(stretches), {found.items[i] for i in items}


def scan_all(texts: list[bytes], found: Tables, run_bytes: int = RUN_BYTES) -> list[tuple]:
    """``scan`` of each text. Short ones are searched together, with an unknown word between them,
    which no window holds."""
    out: list[tuple] = [()] * len(texts)
    held, size = [], 0
    for i, text in enumerate(texts):
        if len(text) > run_bytes:
            out[i] = scan(text, found, run_bytes)
            continue
        held.append(i)
        size += len(text)
        if size > run_bytes:
            _scan_short(texts, held, found, out)
            held, size = [], 0
    _scan_short(texts, held, found, out)
    return out


def _scan_short(texts: list[bytes], held: list[int], found: Tables, out: list[tuple]) -> None:
    flat: list[bytes] = []
    starts = []
    for i in held:
        starts.append(len(flat))
        flat += WORD.findall(texts[i].lower())
        flat.append(b"")
    starts.append(len(flat))
    words = np.fromiter(map(found.numbers.get, flat, repeat(0)), np.int32, len(flat))
    stretches: dict[int, list] = {}
    items: dict[int, set] = {}
    for search in found.searches:
        at = 0
        for end, owners in search.search(words):
            while starts[at + 1] < end:
                at += 1
            low = end - search.length - starts[at]
            stretches.setdefault(at, []).append((low, low + search.length))
            items.setdefault(at, set()).update(owners.tolist())
    for at, i in enumerate(held):
        hits = merged(stretches.get(at, ()))
        out[i] = starts[at + 1] - starts[at] - 1, hits, {found.items[k] for k in items.get(at, ())}


def merged(stretches: Iterable[tuple[int, int]]) -> list[int]:
    """Flat starts and ends of the union of the stretches."""
    flat: list[int] = []
    for start, end in sorted(stretches):
        if flat and start <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += (start, end)
    return flat


def _passes(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> list[DataFrame]:
    """The benchmark in parts of about ``limit`` bytes, split by a hash of the rows."""
    parts = benchmark.select(
        benchmark[id_col].cast("string").alias("item"),
        benchmark[text_col].cast("binary").alias("text"),
    ).where(F.col("text").isNotNull())
    size = parts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // limit)
    if n <= 1:
        return [parts]
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [parts.where(part == i) for i in range(n)]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. A word is
    hit if it lies in an occurrence of ``window`` consecutive words of an item, or of all words of
    a shorter item; ``items`` are the ids of items with occurrences, sorted as text.

    The benchmark is the query set: its tables go to every task. Its size is read first; beyond
    ``pass_bytes`` it is cut into parts and the documents are searched once for each part, one after
    the other, so driver and tasks hold one part however large the benchmark is. A worker builds the
    tables of a part once. The findings of several passes meet by a hash of the whole row.

    NULL and empty texts have no words and are clean; items without words match nothing. Items
    with a NULL id contaminate, but have no id to list or count. Repeated rows get equal results.
    Texts of any length are searched whole. Columns of ``docs`` with the names of new columns are
    replaced. An empty benchmark leaves every document clean. Without ``keep_text`` the result
    has no text column, which spares its way back from Python.
    """
    rows = docs.select(packed(docs, doc_text).alias("row"), docs[doc_text].alias("text"))
    parts = _passes(benchmark, item_id, item_text, pass_bytes)
    if len(parts) == 1:
        carried = rows if keep_text else rows.select("row")
        found = rows.mapInArrow(
            _searcher(parts[0], window, carried.columns), T.StructType([*carried.schema, *FOUND])
        )
    else:
        found = _several_passes(rows, parts, window)
    union = F.expr(
        "aggregate(array_sort(transform(sequence(0, size(hits) div 2), i ->"
        " named_struct('s', get(hits, 2 * i), 'e', get(hits, 2 * i + 1)))),"
        " named_struct('n', 0L, 'upto', 0L), (a, p) -> if(p.e is null, a, named_struct("
        " 'n', a.n + greatest(0L, p.e - greatest(p.s, a.upto)), 'upto', greatest(a.upto, p.e))),"
        " a -> a.n)"
    )
    text = {doc_text: F.col("text")} if keep_text else {}
    return unpacked(
        found,
        "row",
        [c for c in docs.columns if c != doc_text],
        **text,
        n_words=F.col("n_words"),
        n_hit=union,
        n_items=F.size("items").cast("bigint"),
        items=F.col("items"),
        contaminated=F.size("hits") > 0,
    )


_BUILT: dict[str, Tables] = {}


def _built(key: str, items: list[tuple[str | None, bytes]], window: int) -> Tables:
    """The tables of ``key``, made once in a worker process; those of other passes go."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = tables(items, window)
    return _BUILT[key]


def _searcher(part: DataFrame, window: int, passed: list[str]):
    """A mapInArrow function that searches for the items of one bounded part."""
    items = [(r["item"], bytes(r["text"])) for r in part.collect()]
    key = uuid.uuid4().hex

    def search(batches):
        known = _built(key, items, window)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            found = scan_all(texts, known)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in passed],
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([hits for _, hits, _ in found], pa.list_(pa.int64())),
                    pa.array(
                        [sorted(i for i in owners if i is not None) for _, _, owners in found],
                        pa.list_(pa.string()),
                    ),
                    pa.array([None in owners for _, _, owners in found], pa.bool_()),
                ],
                names=[*passed, *FOUND.names],
            )

    return search


def _several_passes(rows: DataFrame, parts: list[DataFrame], window: int) -> DataFrame:
    """One search of all rows for each part; equal rows have equal findings and share them.

    A pass is written before the next part is read.
    """
    whole = F.concat(F.to_json("row"), F.lit("|"), F.coalesce("text", F.lit("")))
    rows = rows.withColumn("id", F.sha2(whole, 256))
    slim = rows.select("id", "text")
    union = None
    for part in parts:
        found = slim.mapInArrow(
            _searcher(part, window, ["id"]), T.StructType([*slim.select("id").schema, *FOUND])
        )
        found = stored(found.where(F.size("hits") > 0).select("id", "hits", "items"), "hits-of-pass")
        union = found if union is None else union.unionByName(found)
    # One row of findings per part and different document: as many as there are parts at most.
    union = union.groupBy("id").agg(
        F.flatten(F.collect_set("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    counted = rows.select(
        "row", "text", "id", F.regexp_count("text", F.lit(WORDS_SQL)).alias("n")
    )
    return counted.join(union, "id", "left").select(
        "row",
        "text",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_words"),
        F.coalesce("hits", F.array().cast("array<bigint>")).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


WORDS_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def items_digest(items) -> F.Column:
    """Lowercase hex SHA-256 of the ids, comma-joined."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)
