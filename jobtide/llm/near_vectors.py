"""Near-duplicate vectors by NN-descent.

Every distinct vector keeps a list of its nearest ones found so far. Lists begin in runs of vectors
sorted by the signs of random projections, and are refined by joins over neighbours of neighbours:
all that a vector lists, and all that list it, are introduced to each other. A list whose last entry
still is a link is saturated; such lists are enlarged to everything in the dense surroundings. Recall
is audited against brute force, and the search goes on until it is enough. Links are the entries at
or above the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import quoted, seeded_number, stored
from jobtide.llm.components import components

THRESHOLD = 0.95
NEIGHBOURS = 10
TREES = 6
BITS = 32
LEAF = 128
#: Neighbours introduced to each other at once; a vector that many list has several such groups.
MEETING = 96
#: Rounds go on while they add this part of the links, and tries until recall is that of the audit.
NEW_LINKS = 0.001
ROUNDS = 8
AUDITED = 1_024
RECALL = 0.995
TRIES = 3
#: Rows of one cell of a dense group that is compared whole, and links that lead to a pivot.
CELL = 1_024
REACH = 8
SEED = 77

NEAR = "array<struct<sim:double,node:bigint,old:boolean>>"
_NEAR = pa.list_(pa.struct([("sim", pa.float64()), ("node", pa.int64()), ("old", pa.bool_())]))


class Found(NamedTuple):
    """``links`` has a row per vector: id, n_links, component_id. ``recall`` is that of the audited
    vectors' links, None if they have none."""

    links: DataFrame
    recall: float | None


def _packed(batches):
    """Vectors as bytes in their own precision; NULL for those that link with nothing."""
    for batch in batches:
        lists = batch.column("vector")
        kind = np.float32 if pa.types.is_float32(lists.type.value_type) else np.float64
        out = []
        for values in lists:
            if not values.is_valid or values.values.null_count:
                out.append(None)
                continue
            x = values.values.to_numpy(zero_copy_only=False).astype(kind) + kind(0)
            out.append(x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "vec"])


def _units(column: pa.Array, kind) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    x = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _lists(nodes, others, sims, old, keep: int) -> pa.RecordBatch:
    """(node, near): the ``keep`` most similar different entries of each node, best first."""
    order = np.lexsort((~old, others, nodes))
    nodes, others, sims, old = nodes[order], others[order], sims[order], old[order]
    new = np.ones(len(nodes), bool)
    new[1:] = (nodes[1:] != nodes[:-1]) | (others[1:] != others[:-1])
    nodes, others, sims, old = nodes[new], others[new], sims[new], old[new]
    order = np.lexsort((others, -sims, nodes))
    nodes, others, sims, old = nodes[order], others[order], sims[order], old[order]
    kinds, starts, counts = np.unique(nodes, return_index=True, return_counts=True)
    best = np.arange(len(nodes)) - np.repeat(starts, counts) < keep
    offsets = np.zeros(len(kinds) + 1, np.int32)
    np.cumsum(np.minimum(counts, keep), out=offsets[1:])
    entries = pa.StructArray.from_arrays(
        [pa.array(sims[best]), pa.array(others[best]), pa.array(old[best])], fields=list(_NEAR.value_type)
    )
    near = pa.ListArray.from_arrays(pa.array(offsets), entries, type=_NEAR)
    return pa.RecordBatch.from_arrays([pa.array(kinds), near], names=["node", "near"])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int | None):
    """Consecutive rows with equal ``keys``, at most ``most`` of them at a time."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        n = rest.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        new[0] = True
        for key in keys:
            values = rest.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        edges = [*np.flatnonzero(new).tolist(), n]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            while most and high - low >= most:
                yield rest.slice(low, most)
                low += most
            if high == n:
                rest = rest.slice(low)
            elif high > low:
                yield rest.slice(low, high - low)
    if rest is not None and rest.num_rows:
        yield rest


class _Entries:
    """Entries of lists, gathered until they are enough for a batch."""

    def __init__(self, keep: int, most: int = 200_000):
        self.keep, self.most, self.parts, self.n = keep, most, [], 0

    def add(self, nodes, others, sims) -> Iterator[pa.RecordBatch]:
        self.parts.append((nodes, others, sims))
        self.n += len(nodes)
        if self.n >= self.most:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            nodes, others, sims = (np.concatenate(p) for p in zip(*self.parts, strict=True))
            yield _lists(nodes, others, sims, np.zeros(len(nodes), bool), self.keep)
        self.parts, self.n = [], 0


def _coded(trees: int, seed: int, kind):
    """Each vector once per tree, with the signs of its projections as one number."""

    def code(batches):
        planes = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes).tolist():
                if dim not in planes:
                    planes[dim] = np.random.default_rng((seed, dim)).normal(size=(dim, trees * BITS))
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                signs = _units(part.column("vec"), kind) @ planes[dim] > 0
                for tree in range(trees):
                    bits = signs[:, tree * BITS : (tree + 1) * BITS].astype(np.int64)
                    number = bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), tree, np.int32)), pa.array(number), *map(part.column, ("dim", "node", "vec"))],
                        names=["tree", "code", "dim", "node", "vec"],
                    )

    return code


def _first_lists(keep: int, kind):
    """Lists within runs of vectors with similar signs."""

    def compare(batches):
        found = _Entries(keep)
        for run in _runs(batches, ["tree", "dim"], LEAF):
            nodes = run.column("node").to_numpy()
            sims = (x := _units(run.column("vec"), kind)) @ x.T
            np.fill_diagonal(sims, -2)
            most = min(keep, len(nodes) - 1)
            if most > 0:
                best = np.argpartition(-sims, most - 1, axis=1)[:, :most]
                yield from found.add(
                    np.repeat(nodes, most), nodes[best].ravel(), np.take_along_axis(sims, best, 1).ravel()
                )
        yield from found.rest()

    return compare


def _meetings(keep: int, kind):
    """Neighbours of a centre introduced to each other; what betters a member's list is returned."""

    def compare(batches):
        found = _Entries(keep)
        for run in _runs(batches, ["centre"], MEETING):
            if not run.column("fresh").to_numpy().any():
                continue  # all here have met before
            nodes, first = np.unique(run.column("node").to_numpy(), return_index=True)
            if len(nodes) < 2:
                continue
            run = run.take(pa.array(first))
            x = _units(run.column("vec").combine_chunks(), kind)
            sims = x @ x.T
            np.fill_diagonal(sims, -2)
            a, b = np.nonzero(sims > run.column("worst").to_numpy()[:, None])
            yield from found.add(nodes[a], nodes[b], sims[a, b])
        yield from found.rest()

    return compare


def _merged(keep: int):
    def merge(batches):
        for batch in batches:
            near = batch.column("near")
            entries = near.flatten()
            sizes = np.diff(near.offsets.to_numpy())
            if not len(entries):
                continue
            old = entries.field("old").to_numpy(zero_copy_only=False)
            yield _lists(
                np.repeat(batch.column("node").to_numpy(), sizes),
                entries.field("node").to_numpy(),
                entries.field("sim").to_numpy(),
                old.astype(bool),
                keep,
            )

    return merge


def _merge(lists: DataFrame, keep: int) -> DataFrame:
    """One list per node of several; as many as there are trees, or meetings it was bettered in."""
    gathered = lists.groupBy("node").agg(F.flatten(F.collect_list("near")).alias("near"))
    return gathered.mapInArrow(_merged(keep), f"node bigint, near {NEAR}")


def _refined(vectors: DataFrame, lists: DataFrame, keep: int, kind) -> DataFrame:
    """One round: join lists with the lists of those in them, both ways."""
    entries = lists.select("node", F.explode("near").alias("e")).select(
        "node", F.col("e.node").alias("other"), (~F.col("e.old")).alias("fresh")
    )
    ways = [
        entries.select(F.col(a).alias("centre"), F.col(b).alias("node"), "fresh")
        for a, b in (("node", "other"), ("other", "node"))
    ]
    own = lists.select(F.col("node").alias("centre"), "node", F.lit(False).alias("fresh"))
    members = ways[0].unionByName(ways[1]).unionByName(own)
    worst = F.when(F.size("near") < keep, -1.5).otherwise(F.element_at("near", -1)["sim"])
    known = vectors.select("node", "vec").join(lists.select("node", worst.alias("worst")), "node")
    members = members.join(known, "node")
    by = ["centre", F.xxhash64("node")]
    met = members.repartitionByRange(*by).sortWithinPartitions(*by)
    better = met.mapInArrow(_meetings(keep, kind), f"node bigint, near {NEAR}")
    before = lists.select("node", F.transform("near", lambda e: e.withField("old", F.lit(True))).alias("near"))
    return stored(_merge(before.unionByName(better), keep), "neighbour-lists")


def _searched(vectors: DataFrame, lists: DataFrame | None, keep: int, threshold: float, kind, seed: int) -> DataFrame:
    """Lists from new trees, beside those of a search before, refined until links come no more."""
    coded = vectors.select("node", F.col("dim"), "vec").mapInArrow(
        _coded(TREES, seed, kind), "tree int, code bigint, dim int, node bigint, vec binary"
    )
    by = ["tree", "dim", "code", "node"]
    runs = coded.repartitionByRange(*by).sortWithinPartitions(*by)
    first = runs.mapInArrow(_first_lists(keep, kind), f"node bigint, near {NEAR}")
    if lists is not None:
        first = first.unionByName(lists)
    now = stored(_merge(first, keep), "neighbour-lists")
    is_link = lambda e: e["sim"] >= threshold
    links = F.coalesce(F.sum(F.size(F.filter("near", is_link))), F.lit(0))
    fresh = F.coalesce(F.sum(F.size(F.filter("near", lambda e: is_link(e) & ~e["old"]))), F.lit(0))
    for _ in range(ROUNDS):
        now = _refined(vectors, now, keep, kind)
        n, new = now.agg(links, fresh).first()
        if new <= NEW_LINKS * n:
            break
    return now


def _pairs_of_open(lists: DataFrame, saturated: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: links of which one end has a whole list."""
    entries = lists.select("node", F.explode("near").alias("e")).where(F.col("e.sim") >= threshold)
    entries = entries.select("node", F.col("e.node").alias("other"))
    full = saturated.select("node", F.lit(True).alias("full"))
    entries = entries.join(full, "node", "left").join(
        full.select(F.col("node").alias("other"), F.col("full").alias("other_full")), "other", "left"
    )
    return (
        entries.where("full is null or other_full is null")
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
    )


def _close(pairs: DataFrame, vectors: DataFrame, least: float, kind) -> DataFrame:
    """Those (node, pivot) whose vectors have cosine ``least`` or more."""

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                a, b = (_units(part.column(c), kind) for c in ("vec", "pivot_vec"))
                near = np.einsum("ij,ij->i", a, b) >= least
                yield part.select(["node", "pivot"]).filter(pa.array(near))

    own = vectors.select("node", "dim", "vec")
    pivot = vectors.select(F.col("node").alias("pivot"), F.col("vec").alias("pivot_vec"))
    return pairs.join(own, "node").join(pivot, "pivot").select(
        "node", "pivot", "dim", "vec", "pivot_vec"
    ).mapInArrow(compare, "node bigint, pivot bigint")


def _dense_groups(saturated: DataFrame, vectors: DataFrame, threshold: float, kind) -> DataFrame:
    """(node, groups): the pivots around each saturated vector.

    Every saturated vector follows links to the pivot with the least hash that it is linked to
    itself. Two linked vectors are then at most two such angles from each other's pivots, so a group
    is all that can be reached by links within twice the angle around its pivot. A clump has one
    pivot, a long chain has one every few links.
    """
    alone = saturated.select("node", F.explode("near").alias("e")).select("node", F.col("e.node").alias("other"))
    alone = alone.join(saturated.select(F.col("node").alias("other")), "other", "left_semi")
    both = stored(alone.unionByName(alone.selectExpr("other node", "node other")).distinct(), "dense-links")
    pivots = saturated.select("node", F.col("node").alias("pivot"))
    for _ in range(REACH):
        named = pivots.select(F.col("node").alias("other"), "pivot")
        told = both.join(named, "other").select("node", "pivot").distinct()
        told = told.join(pivots, ["node", "pivot"], "left_anti")
        least = F.min(F.struct(F.xxhash64("pivot").alias("h"), "pivot"))["pivot"]
        close = _close(told, vectors, threshold, kind).unionByName(pivots)
        now = stored(close.groupBy("node").agg(least.alias("pivot")), "pivots")
        moved = not now.join(pivots, ["node", "pivot"], "left_anti").isEmpty()
        pivots = now
        if not moved:
            break
    members = new = pivots
    while not new.isEmpty():
        at = new.select(F.col("node").alias("other"), "pivot")
        told = both.join(at, "other").select("node", "pivot").distinct()
        told = told.join(members, ["node", "pivot"], "left_anti")
        new = stored(_close(told, vectors, 2 * threshold**2 - 1, kind), "new-members")
        members = members.unionByName(new)
    return members.groupBy("node").agg(F.array_sort(F.collect_list("pivot")).alias("groups"))


def _cells(threshold: float, kind):
    """Links within a cell, weighted by copies, and the least node that each is connected to there.

    A pair that shares several groups is counted in the first of them only.
    """

    def compare(batches):
        for run in _runs(batches, ["group", "low", "high"], None):
            group, low, high = (run.column(c)[0].as_py() for c in ("group", "low", "high"))
            part = run.column("part").to_numpy()
            x = _units(run.column("vec").combine_chunks(), kind)
            near = x @ x.T >= threshold
            if low != high:
                near &= part[:, None] != part
            np.fill_diagonal(near, False)
            groups = run.column("groups").to_pylist()
            for earlier in {g for gs in groups for g in gs if g < group}:
                there = np.array([earlier in gs for gs in groups])
                near &= ~(there[:, None] & there)
            nodes, weight = run.column("node").to_numpy(), run.column("copies").to_numpy()
            roots = nodes.copy()
            while True:
                seen = np.where(near, roots, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
                if (now := np.minimum(roots, seen)).tolist() == roots.tolist():
                    break
                roots = now
            counts = near @ weight
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(counts.astype(np.int64)), pa.array(roots)], names=["node", "n", "root"]
            )

    return compare


def _within_groups(vectors: DataFrame, groups: DataFrame, threshold: float, cell: int, kind) -> DataFrame:
    """(node, n, root) of all cells of all dense groups."""
    rows = groups.join(vectors.select("node", "copies", "vec"), "node")
    rows = rows.select("node", "copies", "vec", "groups", F.explode("groups").alias("group"))
    parts = rows.groupBy("group").agg(F.ceil(F.count("*") / cell).alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("parts"))
    rows = rows.join(parts, "group").withColumn("part", part)
    rows = rows.withColumn("beside", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    rows = rows.select(
        "group", F.least("part", "beside").alias("low"), F.greatest("part", "beside").alias("high"),
        "part", "node", "copies", "vec", "groups",
    )
    by = ["group", "low", "high"]
    met = rows.repartition(*by).sortWithinPartitions(*by)
    return stored(met.mapInArrow(_cells(threshold, kind), "node bigint, n bigint, root bigint"), "dense-cells")


def _audit(vectors: DataFrame, found: DataFrame, threshold: float, size: int, kind) -> float | None:
    """Which part of the links of ``size`` vectors, drawn by a hash, is in ``found``."""
    drawn = vectors.select("node", "dim", "vec").orderBy(seeded_number(F.col("node"), SEED), "node").limit(size)
    table = drawn.toArrow().combine_chunks()
    sizes = table.column("dim").to_numpy()
    queries = {}
    for dim in np.unique(sizes).tolist():
        part = table.take(pa.array(np.flatnonzero(sizes == dim)))
        queries[dim] = part.column("node").to_numpy(), _units(part.column("vec").combine_chunks(), kind)

    def count(batches):
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim, (nodes, units) in queries.items():
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                if not part.num_rows:
                    continue
                near = units @ _units(part.column("vec"), kind).T >= threshold
                near &= nodes[:, None] != part.column("node").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes), pa.array(near @ part.column("copies").to_numpy())], names=["node", "n"]
                )

    true = vectors.select("node", "dim", "vec", "copies").mapInArrow(count, "node bigint, n bigint")
    true = true.groupBy("node").agg(F.sum("n").alias("n")).where("n > 0")
    both = true.join(found.select("node", F.col("n").alias("m")), "node", "left")
    total, seen = both.agg(F.sum("n"), F.sum(F.least(F.coalesce("m", F.lit(0)), "n"))).first()
    return seen / total if total else None


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    neighbours: int = NEIGHBOURS,
    cell: int = CELL,
    audited: int = AUDITED,
    recall: float = RECALL,
    tries: int = TRIES,
) -> Found:
    """Links between vectors with cosine ``threshold`` or more, and their connected components.

    Returns id, n_links (other vectors linked directly, equal ones too) and component_id (the
    smallest id reachable) of every row. Equal vectors are one while searching, and count as many as
    they are. Nothing below the threshold is linked, cosines being computed in double precision;
    recall is measured on ``audited`` vectors against all, and up to ``tries`` searches are made,
    each with other trees on top of the lists so far, until it is ``recall``.

    Lists have ``neighbours`` entries. One that is full of links is enlarged to all of its dense
    group: those groups are compared in cells of ``cell`` by ``cell`` vectors over many tasks, and
    only counts and a spanning star leave a cell, so rows stay linear however dense a group is.

    Vectors that are NULL, empty or zero, or hold NULL or non-finite components, link with nothing,
    vectors of different lengths not with each other. Repeated ids are rows of their own; a NULL id
    is nobody's component unless a component has no other. Other columns are ignored; an empty table
    has no rows.
    """
    single = dict(rows.select(quoted(vector_col).alias("v")).dtypes)["v"] == "array<float>"
    kind, width = (np.float32, 4) if single else (np.float64, 8)
    vector = quoted(vector_col) if single else quoted(vector_col).cast("array<double>")
    given = rows.select(quoted(id_col).alias("id"), vector.alias("vector"))
    id_type = given.schema["id"].dataType.simpleString()
    packed = stored(given.mapInArrow(_packed, f"id {id_type}, vec binary"), "vectors")

    distinct = packed.where("vec is not null").groupBy("vec").agg(
        F.count("*").alias("copies"), F.min("id").alias("first_id")
    )
    distinct = distinct.withColumn("dim", (F.octet_length("vec") / width).cast("int"))
    vectors = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")

    lists, measured = None, None
    for attempt in range(max(1, tries)):
        lists = _searched(vectors, lists, neighbours, threshold, kind, SEED + attempt)
        full = (F.size("near") >= neighbours) & (F.element_at("near", -1)["sim"] >= threshold)
        saturated = stored(lists.where(full), "saturated-lists")
        pairs = stored(_pairs_of_open(lists, saturated, threshold), "links")
        dense = _within_groups(vectors, _dense_groups(saturated, vectors, threshold, kind), threshold, cell, kind)
        ways = pairs.selectExpr("a node", "b other").unionByName(pairs.selectExpr("b node", "a other"))
        weights = vectors.select(F.col("node").alias("other"), F.col("copies").alias("n"))
        counts = ways.join(weights, "other").select("node", "n").unionByName(dense.select("node", "n"))
        counts = stored(counts.groupBy("node").agg(F.sum("n").alias("n")), "link-counts")
        measured = _audit(vectors, counts, threshold, audited, kind)
        if measured is None or measured >= recall:
            break

    edges = pairs.unionByName(dense.where("root <> node").selectExpr("node a", "root b"))
    roots = components(edges)
    whole = vectors.join(counts, "node", "left").join(roots, "node", "left").select(
        F.sha2("vec", 256).alias("digest"),
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("root", "node").alias("component"),
        "first_id",
    )
    whole = stored(whole, "linked-vectors")
    firsts = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    whole = whole.drop("first_id").join(firsts, "component")
    links = packed.select("id", F.sha2("vec", 256).alias("digest")).join(whole, "digest", "left")
    return Found(
        links.select(
            "id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        measured,
    )
