"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

Texts with equal sets of word n-grams are one class, which is searched for once. Bands of MinHash
values send similar classes to the same buckets. Buckets with the same least member are one group,
whose pairs are compared on their full sets, in cells of bounded size; groups do not grow over
chains of buckets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.byte_text import mix, pieces, word_hashes, words
from jobtide.llm.common import packed, stored, unpacked
from jobtide.llm.components import components

N = 5
THRESHOLD = 0.8
RECALL = 0.999
MOST_HASHES = 256
#: A group is cut into chunks of so many classes or n-grams; a cell holds two chunks.
CHUNK_ROWS, CHUNK_NGRAMS = 1_024, 1_500_000
#: Members of groups are sent to the tasks that read texts up to so many bytes; beyond, both sides of
#: that join are shuffled by id.
BROADCAST_BYTES = 32 << 20
SEED = 10
_STEP = np.uint64(0xD6E8FEB86659FD93)


def choose_bands(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest chance candidates, with which a pair
    at the threshold still shares a band with probability ``recall`` within ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        hit = threshold**rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("too few hashes for this recall")
    return best


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words."""
    count = len(hashes) - n + 1
    found = np.full(max(0, count), np.uint64(n))
    for i in range(n):
        found = found * _STEP + hashes[i : i + count]
    return mix(found)


def ngrams(values: pa.Array, n: int = N) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, n-gram hashes, bounds of each row) over runs of rows.

    Words are ``[^\\x20\\x09-\\x0D]+``. A text of fewer than n words, but not none, has one n-gram of
    all its words.
    """
    long_row, held = None, []
    for piece in pieces(values):
        rows, starts, ends = words(piece)
        hashes = word_hashes(piece, starts, ends)
        count = len(piece.bounds) - 1
        alone = count == 1
        if long_row is not None and piece.first != long_row:
            yield _one(long_row, held, n)
            long_row, held = None, []
        if alone and (piece.tail or long_row is not None):
            long_row = piece.first
            held.append(hashes)
            continue
        at = np.searchsorted(rows, np.arange(count + 1))
        grams = _grams(hashes, n)
        own = at[1:] - at[:-1]
        inside = np.ones(len(grams), bool)
        for back in range(1, n):
            bad = at[1:-1] - back
            inside[bad[(bad >= 0) & (bad < len(grams))]] = False
        kept = np.concatenate(([0], np.cumsum(inside)))
        low = kept[np.minimum(at, len(grams))]
        grams = grams[inside]
        short = np.flatnonzero((own > 0) & (own < n))
        if len(short):
            extra = [_grams(hashes[at[k] : at[k + 1]], int(own[k])) for k in short]
            grams = np.insert(grams, low[short], np.concatenate(extra))
            low = low + np.concatenate(([0], np.cumsum((own > 0) & (own < n))))
        yield piece.first, grams, low
    if long_row is not None:
        yield _one(long_row, held, n)


def _one(row: int, held: list[np.ndarray], n: int) -> tuple[int, np.ndarray, np.ndarray]:
    hashes = np.concatenate(held)
    grams = _grams(hashes, min(n, len(hashes))) if len(hashes) else hashes
    return row, grams, np.array([0, len(grams)])


def gram_sets(values: pa.Array, n: int = N) -> list[np.ndarray]:
    """Sorted different n-gram hashes of each text."""
    found = [np.empty(0, np.uint64)] * len(values)
    for first, grams, bounds in ngrams(values, n):
        for k in range(len(bounds) - 1):
            found[first + k] = np.unique(grams[bounds[k] : bounds[k + 1]])
    return found


class Signer:
    """MinHash values of n-gram sets, folded into one number for each band."""

    def __init__(self, bands: int, rows: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = bands * rows
        self.bands, self.rows = bands, rows
        self.factor = rng.integers(0, 1 << 31, size, np.uint32) * np.uint32(2) + np.uint32(1)
        self.shift = rng.integers(0, 1 << 32, size, np.uint32)

    def sign(self, grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(texts, bands); texts without n-grams get arbitrary numbers."""
        short = (grams >> np.uint64(32)).astype(np.uint32)
        full = np.flatnonzero(bounds[1:] > bounds[:-1])
        least = np.zeros((len(bounds) - 1, len(self.factor)), np.uint32)
        at = bounds[:-1][full]
        if len(full):
            for k, (a, b) in enumerate(zip(self.factor, self.shift)):
                least[full, k] = np.minimum.reduceat(short * a + b, at)
        split = least.reshape(len(least), self.bands, self.rows).astype(np.uint64)
        found = np.arange(self.bands, dtype=np.uint64)[None, :] * np.ones(
            (len(least), 1), np.uint64
        )
        for r in range(self.rows):
            found = found * _STEP + split[:, :, r] + np.uint64(1)
        return mix(found)


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int):
    """doc (the id), id (never NULL), key1, key2 (a digest of the n-gram set), n_grams and bands of
    every whole text."""
    wanted = _identified(docs, id_col, text_col)

    def sign(batches):
        signer = Signer(bands, rows)
        for batch in batches:
            size = batch.num_rows
            keys = np.zeros((2, size), np.int64)
            counts = np.zeros(size, np.int64)
            signed = np.zeros((size, bands), np.uint64)
            for first, grams, bounds in ngrams(batch.column(2), n):
                signed[first : first + len(bounds) - 1] = signer.sign(grams, bounds)
                for k in range(len(bounds) - 1):
                    own = np.unique(grams[bounds[k] : bounds[k + 1]])
                    counts[first + k] = len(own)
                    keys[:, first + k] = _digest(own)
            flat = pa.array(signed.ravel().view(np.int64))
            offsets = pa.array(np.arange(size + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *[pa.array(k) for k in keys],
                    pa.array(counts),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["doc", "id", "key1", "key2", "n_grams", "bands"],
            )

    kinds = "doc long, id long, key1 long, key2 long, n_grams long, bands array<bigint>"
    return wanted.mapInArrow(sign, kinds)


def _digest(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for a set of n-grams."""
    sums = [mix(g).sum(dtype=np.uint64) for g in (grams, grams ^ _STEP)]
    return tuple(int(s.astype(np.int64)) for s in sums)


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, id, text; a missing id is a negative number from the text."""
    doc, text = docs[id_col].cast("bigint"), docs[text_col].cast("string")
    made = -1 - F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1))
    return docs.select(doc.alias("doc"), F.coalesce(doc, made).alias("id"), text.alias("text"))


def compare(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of n-gram sets reach the threshold, as a symmetric matrix."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen[code] > 1
    owner, code = owner[shared], code[shared]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    _, code = np.unique(code, return_inverse=True)
    both = np.zeros((len(sets), len(sets)), np.float32)
    block = max(256, (8 << 20) // max(1, len(sets)))
    width = int(code[-1]) + 1 if len(code) else 0
    for low in range(0, width, block):
        a, b = np.searchsorted(code, [low, low + block])
        has = np.zeros((len(sets), min(block, width - low)), np.float32)
        has[owner[a:b], code[a:b] - low] = 1
        both += has @ has.T
    together = sizes[:, None] + sizes[None, :] - both
    linked = (both > 0) & (both >= threshold * together - 1e-6)
    np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The smallest node in each one's component of a matrix of links."""
    roots = nodes.copy()
    while True:
        least = np.where(linked, roots[None, :], np.iinfo(np.int64).max).min(1, initial=2**63 - 1)
        new = np.minimum(roots, least)
        if (new == roots).all():
            return roots
        roots = new


def _owned(linked: np.ndarray, leaders: list[list[int]], root: int) -> np.ndarray:
    """Links whose two ends share no leader before ``root``; each link is counted in one group."""
    if all(own[0] == root for own in leaders):  # sorted
        return linked
    width = max(len(own) for own in leaders)
    table = np.full((len(leaders), width), np.iinfo(np.int64).max)
    for k, own in enumerate(leaders):
        table[k, : len(own)] = own
    a, b = np.nonzero(linked)
    seen = np.zeros(len(a), bool)
    for column in range(width):
        some = np.flatnonzero((table[a, column] < root) & ~seen)
        if not len(some):
            continue
        for low in range(0, len(some), 200_000):
            part = some[low : low + 200_000]
            seen[part] = (table[b[part]] == table[a[part], column][:, None]).any(axis=1)
    owned = linked.copy()
    owned[a[seen], b[seen]] = False
    return owned


def _cell(rows: list[tuple], threshold: float) -> pa.RecordBatch | None:
    """Links within one cell: (node, texts it is linked to, smallest node connected)."""
    root, left, right = rows[0][:3]
    rows = list({(r[3], r[6]): r for r in rows}.values())  # a repeated row counts in ``texts``
    nodes = np.array([r[3] for r in rows], np.int64)
    weight = np.array([r[4] for r in rows], np.int64)
    chunk = np.array([r[5] for r in rows])
    linked = compare([np.frombuffer(r[8], np.uint64) for r in rows], threshold)
    if left != right:  # pairs within a chunk belong to another cell
        linked &= chunk[:, None] != chunk[None, :]
    some = linked.any(1)
    if not some.any():
        return None
    roots = _roots(linked, nodes)
    links = _owned(linked, [r[7] for r in rows], root) @ weight
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[some]), pa.array(links[some]), pa.array(roots[some])],
        names=["node", "links", "root"],
    )


def verified(cells: DataFrame, threshold: float) -> DataFrame:
    """Rows sorted by cell -> node, links, root for each cell a node is linked in."""

    def check(batches):
        held: list[tuple] = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(9)]
            for row in zip(*columns):
                if held and held[0][:3] != row[:3]:
                    found = _cell(held, threshold)
                    if found is not None:
                        yield found
                    held = []
                held.append(row)
        if held:
            found = _cell(held, threshold)
            if found is not None:
                yield found

    return cells.mapInArrow(check, "node long, links long, root long")


def _sets(texts: DataFrame, n: int) -> DataFrame:
    """``texts`` with their sorted n-gram hashes, ``grams``, in place of the text; rows whose text is
    not that of the class they were joined to are left out."""
    rest = [c for c in texts.columns if c != "text"]

    def read(batches):
        for batch in batches:
            sets = gram_sets(batch.column("text"), n)
            same = [_digest(x)[0] == k for x, k in zip(sets, batch.column("key1").to_pylist())]
            grams = pa.array([x.tobytes() for x in sets], pa.binary())
            columns = [*[batch.column(c) for c in rest], grams]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "grams"]).filter(pa.array(same, pa.bool_()))

    schema = T.StructType([*texts.select(*rest).schema, T.StructField("grams", T.BinaryType())])
    return texts.mapInArrow(read, schema)


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    chunk_rows: int = CHUNK_ROWS,
    chunk_ngrams: int = CHUNK_NGRAMS,
) -> DataFrame:
    """One row per document: ``id``, ``copy_of``, ``class_id``, ``n_links``, ``n_grams``.

    Two texts are linked if the Jaccard similarity of their sets of ``n`` consecutive words is
    ``threshold`` or more. ``copy_of`` is the smallest id with the same set, ``class_id`` the
    smallest id reached over links, ``n_links`` the number of other documents linked directly.
    A pair at the threshold is found with probability ``recall``, more similar ones more surely;
    what is found is exact.

    Copies count without being paired. A class goes to the group of each of its buckets' smallest
    members, a few for copies of one text, as these mostly share it, and as many as there are bands
    at most; its set of n-grams is made once. The pairs of a group are compared in memory, cell by
    cell; only sums and one root per member leave a cell, and a pair of several groups counts in the
    first. A group of k chunks has k (k + 1) / 2 cells on as many tasks, so no task holds a large
    one; there is no cap on groups, buckets or partners. Chains of buckets do not make groups grow.

    NULL texts and texts without words have no n-grams, no links and a class of their own. Rows
    with a NULL id are linked too, and have a negative number from their text for an id in
    ``copy_of`` and ``class_id``. Rows that share an id are one node: each counts as a document,
    and their links and classes are one. An empty table gives an empty table. Texts are read
    whole. Other columns of ``docs`` are not touched.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = stored(signatures(docs, id_col, text_col, n, bands, rows), "signatures")
    key = ["key1", "key2", "n_grams"]
    some = signed.where("n_grams > 0")
    classes = stored(
        some.groupBy(*key).agg(F.min("id").alias("node"), F.count("*").alias("texts")), "classes"
    )

    keyed = some.join(classes.select(*key, "node"), key).where("id = node")
    buckets = keyed.select("node", F.explode("bands").alias("bucket"))
    least = buckets.groupBy("bucket").agg(F.min("node").alias("b"), F.max("node").alias("last"))
    led = buckets.join(least.where("b < last").select("bucket", "b"), "bucket")
    leaders = led.groupBy("node").agg(F.array_sort(F.collect_set("b")).alias("leaders"))
    members = stored(classes.join(leaders, "node"), "group-members")
    sizes = members.select(F.explode("leaders").alias("root"), "n_grams")
    sizes = sizes.groupBy("root").agg(F.count("*").alias("m"), F.sum("n_grams").alias("g"))
    chunks = F.greatest(F.ceil(F.col("m") / chunk_rows), F.ceil(F.col("g") / chunk_ngrams))
    own = members.select(F.col("node").alias("id"), "texts", "key1", "leaders")
    count, entries = members.agg(F.count("*"), F.coalesce(F.sum(F.size("leaders")), F.lit(0))).first()
    if 64 * count + 8 * entries <= BROADCAST_BYTES:
        own = F.broadcast(own)  # few texts have a candidate: the others need not move
    sets = _sets(_identified(docs, id_col, text_col).drop("doc").join(own, "id"), n)
    cells = sets.withColumn("root", F.explode("leaders")).join(
        sizes.select("root", chunks.alias("chunks")), "root"
    )
    cells = cells.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    cells = (
        cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .select(
            "root",
            F.least("chunk", "other").alias("low"),
            F.greatest("chunk", "other").alias("high"),
            "id",
            "texts",
            "chunk",
            "key1",
            "leaders",
            "grams",
        )
        .repartition("root", "low", "high")
        .sortWithinPartitions("root", "low", "high", "id")
    )
    found = stored(verified(cells, threshold), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.selectExpr("node a", "root b"))

    named = (
        classes.join(joined, "node", "left")
        .join(links, "node", "left")
        .select(
            *key,
            F.col("node").alias("copy_of"),
            F.coalesce("root", "node").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("texts") - 1).alias("n_links"),
        )
    )
    alone = signed.where("n_grams = 0").select(
        F.col("doc").alias("id"), F.col("id").alias("copy_of"), F.col("id").alias("class_id"),
        F.lit(0).cast("bigint").alias("n_links"), "n_grams",
    )
    return (
        signed.where("n_grams > 0")
        .join(named, key)
        .select(F.col("doc").alias("id"), "copy_of", "class_id", "n_links", "n_grams")
        .unionByName(alone)
    )


def keep_one_row(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options):
    """``docs`` with exactly one row of each class of near duplicates, whatever the ids.

    The row with the smallest id stays, NULL ids last, then by text and by the other columns. Of
    rows with equal texts one goes on, so repeated rows and copies with a NULL id do not stay
    beside each other, and different texts under one id are judged apart. Texts without words are
    copies of each other only if their ids are equal or both NULL.

    Rows of one text, and of one class, are reduced in the map tasks before the shuffle. The rows
    of different texts are written to the scratch folder, which gives each a number to join by.
    """
    text = docs[text_col].cast("string")
    words = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.select(
        packed(docs).alias("row"),
        docs[id_col].cast("bigint").alias("id"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        words.alias("words"),
        F.to_json(packed(docs, text_col)).alias("rest"),
    ).withColumn("own", F.when(~F.col("words"), F.col("id")))
    order = [F.col("id").asc_nulls_last(), "digest", "rest"]
    same = Window.partitionBy("digest", "words", "own").orderBy(*order)
    rows = rows.withColumn("nth", F.row_number().over(same)).where("nth = 1").drop("nth", "own")
    rows = stored(rows.withColumn("node", F.monotonically_increasing_id()), "different-texts")

    texts = rows.where("words").select("node", F.col("row").getField(text_col).alias("text"))
    found = jaccard_join(texts, "node", "text", **options)
    classes = found.select(F.col("id").alias("node"), "class_id")
    near = Window.partitionBy("class_id").orderBy(*order)
    kept = (
        rows.where("words")
        .join(classes, "node")
        .withColumn("nth", F.row_number().over(near))
        .where("nth = 1")
    )
    wordless = rows.where("not words").select("row")
    return unpacked(kept.select("row").unionByName(wordless), "row", docs.columns)
