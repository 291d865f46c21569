"""Phrase collocations by sorting suffix pointers.

Texts are cut into pieces at punctuation and line breaks, pieces into words. Every word is the start
of a suffix of up to four words. Suffixes are routed by their leading words, so that one task has all
that begin alike; there a multikey three-way quicksort orders pointers to them word by word, and the
size of a partition of equal words is the count of that phrase. Partitions below the least count are
abandoned, as nothing inside them can reach it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm import byte_text
from jobtide.llm.common import stored

LEAST = 30
DEEPEST = 4
TOP = 2_000
SCALE = 2_000_000
#: A candidate goes if a longer one around it has so many hundredths of its count.
INSIDE = 80

CHUNK_BYTES = 8 << 20
SUFFIXES_PER_BUCKET = 1_000_000
#: A pair or triple with such a part of a chunk's suffixes is reported as leading many.
HEAVY = 1 / 4_096
#: Frequent words are sent to all tasks up to so many bytes; beyond, suffixes keep rare words.
WORD_BYTES = 16 << 20
SMALL = 16_384

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0 part of a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


class Words(NamedTuple):
    """Words of a chunk: dictionary code, row and piece of each, whether its suffix belongs here."""

    codes: np.ndarray
    rows: np.ndarray
    pieces: np.ndarray
    own: np.ndarray
    dictionary: pa.Array


def _words(memory: np.ndarray, bounds: np.ndarray, first: int, own: int) -> Words:
    """Words of ``memory``, whose rows ``first``... are bounded by ``bounds``; suffixes that start
    before ``own`` belong to it."""
    kind = _KIND[memory]
    solid = kind == 0
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(memory))]
    opens[inner] = solid[inner]
    closes[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = np.ascontiguousarray(_LOWER[memory[solid]])
    found = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    ).dictionary_encode()
    rows = np.searchsorted(bounds, starts, side="right") - 1
    pieces = np.cumsum(kind == 2, dtype=np.int64)[starts] + rows
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(codes, rows + first, pieces, starts < own, found.dictionary)


def chunks(values: pa.Array, limit: int = CHUNK_BYTES, ahead: int = DEEPEST - 1) -> Iterator[Words]:
    """Words of all rows, in chunks of about ``limit`` bytes.

    A longer row comes in several chunks, cut between words; each is read on by the ``ahead`` words
    that its last suffixes need.
    """
    memory, bounds = byte_text.buffers(values)
    row, n = 0, len(values)
    while row < n:
        last = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
        if last > row:
            low, high = int(bounds[row]), int(bounds[last])
            yield _words(memory[low:high], bounds[row : last + 1] - low, row, high - low)
            row = last
            continue
        at, end = int(bounds[row]), int(bounds[row + 1])
        while at < end:
            cut = _next_gap(memory, at + limit, end)
            stop = cut
            for _ in range(ahead):
                stop = _next_gap(memory, _next_word(memory, stop, end), end)
            yield _words(memory[at:stop], np.array([0, stop - at]), row, cut - at)
            at = cut
        row += 1


def _first(memory: np.ndarray, at: int, end: int, word: bool) -> int:
    step = 4_096
    while at < end:
        hits = np.flatnonzero((_KIND[memory[at : min(end, at + step)]] == 0) == word)
        if len(hits):
            return at + int(hits[0])
        at, step = at + step, 2 * step
    return end


def _next_gap(memory: np.ndarray, at: int, end: int) -> int:
    return _first(memory, at, end, False)


def _next_word(memory: np.ndarray, at: int, end: int) -> int:
    return _first(memory, at, end, True)


def _lang_codes(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    found = batch.column("lang").dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_pylist()


def _sums(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


COUNTS = "lang string, phrase string, size int, n bigint"


def _count_words(limit: int, least_heavy: float):
    """Counts by chunk: all words of a language (size 0), each word (size 1), and the leading pairs
    and triples that have much of the chunk (size 2 and 3)."""
    names = ["lang", "phrase", "size", "n"]

    def count(batches):
        for batch in batches:
            lang_of, langs = _lang_codes(batch)
            for words in chunks(batch.column("text"), limit):
                own, wide = words.own, len(words.dictionary)
                if not own.any():
                    continue
                lang = lang_of[words.rows]
                keys, counts = _sums(lang[own] * wide + words.codes[own])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(langs, pa.string()).take(pa.array(keys // wide)),
                        words.dictionary.take(pa.array(keys % wide)).cast(pa.string()),
                        pa.array(np.ones(len(keys), np.int32)),
                        pa.array(counts),
                    ],
                    names=names,
                )
                few = [(langs[k], b"", 0, int(n)) for k, n in zip(*_sums(lang[own]), strict=True)]
                columns = zip(*few, *_heavy(words, lang, langs, least_heavy), strict=True)
                kinds = pa.string(), pa.binary(), pa.int32(), pa.int64()
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                arrays[1] = arrays[1].cast(pa.string())
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return count


def _windows(words: Words, values: np.ndarray) -> np.ndarray:
    """Values of up to four words from each word on; 0 after a piece ends or a word without value."""
    n = len(words.codes)
    out = np.zeros((DEEPEST, n), np.int64)
    alive = words.own & (values > 0)
    out[0, alive] = values[alive]
    for k in range(1, min(DEEPEST, n)):
        alive = alive[: n - k] & (values[k:] > 0) & (words.pieces[k:] == words.pieces[: n - k])
        out[k, : n - k][alive] = values[k:][alive]
    return out


def _heavy(
    words: Words, lang: np.ndarray, langs: list[str], share: float
) -> list[tuple[str, bytes, int, int]]:
    """Leading pairs and triples with ``share`` of the chunk's words, which their words have too."""
    least = max(2, int(share * words.own.sum()))
    often = np.bincount(words.codes, minlength=len(words.dictionary)) >= least
    if not often.any():
        return []
    shown = words.dictionary.to_pylist()
    at = _windows(words, np.where(often[words.codes], words.codes + 1, 0))
    found = []
    for size in (2, 3):
        have = np.flatnonzero(at[size - 1])
        number = lang[have]
        for k in range(size):  # renumber at every step, so that keys stay small
            number = np.unique(number * (len(shown) + 1) + at[k][have], return_inverse=True)[1]
        _, one, counts = np.unique(number, return_index=True, return_counts=True)
        for i, n in zip(have[one[counts >= least]], counts[counts >= least].tolist(), strict=True):
            phrase = b" ".join(shown[c - 1] for c in at[:size, i])
            found.append((langs[lang[i]], phrase, size, n))
    return found


SUFFIXES = "bucket int, langs array<string>, words array<string>, cells binary"
_BITS = 22  # a word's number within a chunk, or among the frequent ones sent to all tasks


def _hash(text: bytes, salt: int) -> int:
    return zlib.crc32(text, salt) | zlib.crc32(text, salt ^ 0x5BD1E995) << 32


def _cells(columns: list[np.ndarray]) -> bytes:
    """int32 columns, compressed by byte planes: neighbours in a plane are alike."""
    planes = np.vstack(columns).astype("<i4").view(np.uint8).reshape(len(columns), -1, 4)
    return zstandard.ZstdCompressor(3).compress(planes.transpose(0, 2, 1).tobytes())


def _columns(cells: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(cells), np.uint8)
    planes = planes.reshape(DEEPEST + 2, 4, -1).transpose(0, 2, 1)
    return np.ascontiguousarray(planes).view("<i4")[:, :, 0]


def _split_suffixes(frequent, heavy, buckets: int, limit: int):
    """Distinct suffixes of a chunk with their counts, dealt to buckets by their leading words.

    Two words lead; three where the pair is heavy, four where the triple is. Bucket numbers say how
    many: ``buckets`` of each kind, in this order. ``cells`` are int32 columns: language, words,
    count. Words are numbers in ``frequent``, or else in ``words``, from 1; 0 is past the end.
    """

    def split(batches):
        numbers = frequent and {
            lang: {w: i for i, w in enumerate(words, 1)} for lang, words in frequent.items()
        }
        for batch in batches:
            lang_of, langs = _lang_codes(batch)
            for words in chunks(batch.column("text"), limit):
                yield from deal(words, lang_of[words.rows], langs, numbers)

    def deal(words: Words, lang, langs, numbers):
        dictionary = words.dictionary.to_pylist()
        if numbers is None:
            own = {w: i for i, w in enumerate(dictionary, 1)}
            number_of = dict.fromkeys(langs, own)
            values = words.codes + 1
            hashes = np.array([0, *[_hash(w, 7) for w in dictionary]], np.uint64)
        else:
            number_of = {name: numbers.get(name, {}) for name in langs}
            known = np.array([[number_of[x].get(w, 0) for w in dictionary] for x in langs], np.int64)
            values = known.reshape(len(langs), -1)[lang, words.codes]
            hashes = None
        at = _windows(words, values)
        have = at[1] > 0
        at, lang = at[:, have], lang[have]
        if not len(lang):
            return
        pair = (lang << 2 * _BITS) | (at[0] << _BITS) | at[1]
        rest = (at[2] << _BITS) | at[3]
        order = np.lexsort((rest, pair))
        pair, rest = pair[order], rest[order]
        new = np.ones(len(order), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (rest[1:] != rest[:-1])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(order)))
        pair, at, lang = pair[starts], at[:, order[starts]], lang[order[starts]]
        leading = _leading(pair, at[2], heavy, langs, number_of)
        route = np.array([_hash(x.encode(), 11) for x in langs], np.uint64)[lang]
        for k in range(DEEPEST):
            step = hashes[at[k]] if hashes is not None else at[k].astype(np.uint64)
            route = np.where(leading > k, byte_text.mix(route ^ step), route)
        bucket = (route % np.uint64(buckets)).astype(np.int64) + (leading - 2) * buckets
        order = np.argsort(bucket, kind="stable")
        edges = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
        out = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            part = order[low:high]
            codes, shown = at[:, part], []
            if numbers is None:
                local, codes = np.unique(codes, return_inverse=True)
                codes = codes.reshape(DEEPEST, -1) + (local[0] > 0)
                shown = [dictionary[w - 1] for w in local[local > 0].tolist()]
            out.append((int(bucket[part[0]]), langs, shown, _cells([lang[part], *codes, counts[part]])))
        for low in range(0, len(out), 256):
            columns = list(zip(*out[low : low + 256], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int32()),
                    pa.array(columns[1], pa.list_(pa.string())),
                    pa.array(columns[2], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                    pa.array(columns[3], pa.binary()),
                ],
                names=["bucket", "langs", "words", "cells"],
            )

    return split


def _leading(pair: np.ndarray, third: np.ndarray, heavy, langs, number_of) -> np.ndarray:
    """How many words route each suffix; ``pair`` is sorted."""
    leading = np.full(len(pair), 2)
    for size in (2, 3):
        for lang, phrase in heavy[size]:
            codes = [number_of.get(lang, {}).get(w) for w in phrase.split(b" ")]
            if None in codes:
                continue
            key = (langs.index(lang) << 2 * _BITS) | (codes[0] << _BITS) | codes[1]
            low, high = np.searchsorted(pair, [key, key + 1])
            led = np.ones(high - low, bool) if size == 2 else third[low:high] == codes[2]
            leading[low:high][led] = size + 1
    return leading


def frequent_phrases(
    columns: list[np.ndarray], weight: np.ndarray, least: int, leading: int = 2
) -> Iterator[tuple[int, int, int]]:
    """(pointer, words, count) of each phrase of two words or more that is frequent.

    ``columns`` are the language and the words of suffixes, -1 for none; ``weight`` is how often each
    occurs. All suffixes with the same ``leading`` words must be here; counts of fewer words are
    parts of a total, and are returned whatever they are.

    Multikey three-way quicksort: pointers are parted by the word at one depth into smaller, equal
    and larger; the equal ones go on one word deeper. Short ranges are sorted at once.
    """
    stack = [(np.arange(len(weight)), 0)]
    while stack:
        at, depth = stack.pop()
        if not len(at) or max(depth, 2) >= leading and weight[at].sum() < least:
            continue
        if len(at) <= SMALL:
            yield from _short(columns, weight, at, depth, least, leading)
            continue
        keys = columns[depth][at]
        sample = np.sort(keys[:: max(1, len(keys) // 9)])
        pivot = sample[len(sample) // 2]
        stack.append((at[keys < pivot], depth))
        stack.append((at[keys > pivot], depth))
        if pivot < 0:
            continue
        same = at[keys == pivot]
        count = int(weight[same].sum())
        if depth >= 2 and (count >= least or depth < leading):
            yield int(same[0]), depth, count
        if depth < DEEPEST and (count >= least or depth < leading):
            stack.append((same, depth + 1))


def _short(columns, weight, at, depth, least, leading):
    keys = [columns[k][at].astype(np.int64) + 1 for k in range(depth, DEEPEST + 1)]
    packed = [a << 32 | b for a, b in zip(keys[::2], [*keys[1::2], *[0] * (len(keys) % 2)], strict=True)]
    at = at[np.lexsort(packed[::-1])]
    new = np.zeros(len(at), bool)
    new[0] = True
    for k in range(depth, DEEPEST + 1):
        keys = columns[k][at]
        new[1:] |= keys[1:] != keys[:-1]
        if k < 2:
            continue
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(weight[at], starts)
        good = (keys[starts] >= 0) & ((counts >= least) | (k < leading))
        yield from zip(at[starts[good]].tolist(), [k] * int(good.sum()), counts[good].tolist(), strict=True)


def _count_bucket(frequent, least: int, buckets: int):
    """Phrases of buckets, which come sorted; one bucket is held at a time."""

    def count(batches):
        rows, now = [], None
        for batch in batches:
            for bucket, langs, words, cells in zip(
                *(batch.column(c).to_pylist() for c in ("bucket", "langs", "words", "cells")),
                strict=True,
            ):
                if bucket != now and rows:
                    yield counted(now, rows)
                    rows = []
                now = bucket
                rows.append((langs, words, cells))
        if rows:
            yield counted(now, rows)

    def counted(bucket, rows):
        numbers: dict[str, int] = {}
        names: dict[str, int] = {}
        parts = []
        for langs, words, cells in rows:
            cells = _columns(cells)
            lang = np.array([names.setdefault(x, len(names)) for x in langs], np.int32)
            codes = cells[1 : DEEPEST + 1] - 1
            if frequent is None:
                own = np.array([*(numbers.setdefault(w, len(numbers)) for w in words), -1], np.int32)
                codes = own[codes]
            parts.append(np.vstack([lang[cells[0]][None], codes, cells[-1:]]))
        cells = np.hstack(parts)
        langs = list(names)
        shown = [list(numbers)] * len(langs) if frequent is None else [frequent.get(x) for x in langs]
        text = (lambda w: w) if frequent is None else bytes.decode
        columns = list(cells[: DEEPEST + 1])
        out = []
        for i, size, n in frequent_phrases(columns, cells[-1].astype(np.int64), least, 2 + bucket // buckets):
            words = shown[columns[0][i]]
            phrase = " ".join(text(words[columns[k][i]]) for k in range(1, size + 1))
            out.append((langs[columns[0][i]], phrase, size, n))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int64()), strict=True)],
            names=["lang", "phrase", "size", "n"],
        )

    return count


def phrase_counts(
    docs: DataFrame,
    least: int = LEAST,
    text_col: str = "text",
    lang_col: str = "lang",
    chunk_bytes: int = CHUNK_BYTES,
    bucket_suffixes: int = SUFFIXES_PER_BUCKET,
    word_bytes: int = WORD_BYTES,
    least_heavy: float = HEAVY,
) -> DataFrame:
    """lang, phrase, size, n: exact counts of all phrases of one to four words with ``least`` or
    more occurrences in a language; size 0 has the number of all its words.

    Two passes over the texts: words first, then suffixes of words that are frequent themselves. If
    the frequent words are more than ``word_bytes``, they are not sent to the tasks and suffixes keep
    rare words: more to sort, the same counts. Buckets have about ``bucket_suffixes`` suffixes before
    equal ones are put together; a leading pair or triple with more than ``least_heavy`` of all words
    (and a sixteenth of a bucket) is dealt by one word more, and its own count is summed afterwards.

    A NULL text is empty, a NULL language is ``und``. Texts of any length are read whole, in chunks;
    repeated rows count as often as they occur. An empty table has no rows.
    """
    texts = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
        docs[text_col].alias("text"),
    )
    parts = texts.mapInArrow(_count_words(chunk_bytes, least_heavy), COUNTS)
    words = parts.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    words = stored(words.where((F.col("size") != 1) | (F.col("n") >= least)), "word-counts")

    total = words.where("size = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    once = words.where("size = 1")
    held = once.agg(F.coalesce(F.sum(F.octet_length("phrase") + 16), F.lit(0))).first()[0]
    frequent: dict[str, list[bytes]] | None = None
    if held <= word_bytes:  # at least 17 bytes are reckoned for a word, so numbers are below 2**22
        frequent = {}
        for lang, word in once.orderBy(F.desc("n"), "lang", "phrase").select("lang", "phrase").collect():
            frequent.setdefault(lang, []).append(word.encode())
    heavy = {2: [], 3: []}  # shares of all words add up to one for each size, so these are few
    least_led = max(least_heavy * total / 2, bucket_suffixes / 16)
    shares = (F.col("size") > 1) & (F.col("n") >= least_led)
    for lang, phrase, size in words.where(shares).select("lang", "phrase", "size").collect():
        heavy[size].append((lang, phrase.encode()))

    buckets = max(1, -(-total // bucket_suffixes))
    suffixes = texts.mapInArrow(_split_suffixes(frequent, heavy, buckets, chunk_bytes), SUFFIXES)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(buckets, 100_000))
    dealt = suffixes.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(_count_bucket(frequent, least, buckets), COUNTS)
    longer = found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    longer = stored(longer.where(F.col("n") >= least), "phrase-counts")
    return words.where("size < 2").unionByName(longer)


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    scale: int = SCALE,
    inside: int = INSIDE,
    **counting,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of two to four words with ``least`` occurrences. A cut into a first part
    and a rest has the score floor(scale * a / (l + r)); a candidate has that of its worst cut, the
    earliest of several. Candidates inside a longer one that is nearly as frequent (``inside``
    hundredths) go. Numbers that may pass 64 bits are decimals. Ties are ordered by a, then by the
    phrase's bytes. Odd texts are as in ``phrase_counts``, which takes the other arguments.
    """
    counts = phrase_counts(docs, least, **counting)
    totals = counts.where("size = 0").select("lang", F.col("n").alias("n"))
    known = counts.where("size > 0").select("lang", "phrase", "n")
    found = counts.where("size > 1").select(
        "lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("words")
    )

    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    product = (F.lit(scale).cast("decimal(10,0)") * wide("a")).alias("p")
    scored = scored.select("lang", "phrase", "a", "k", "l", "r", product, (wide("l") + wide("r")).alias("s"))
    scored = scored.withColumn("score", F.expr("p div s"))
    worst = scored.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )

    spans = found.where("size > 2").withColumn(
        "length", F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    )
    spans = spans.withColumn(
        "start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1))
    )
    around = spans.select("lang", part(F.col("start"), F.col("length")).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = worst.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * inside)
    )
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("bigint").alias("rank"),
        "phrase",
        "a",
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        "n",
        F.col("cut.score").cast("bigint").alias("score"),
    )
