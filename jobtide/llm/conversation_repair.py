"""Cheapest repair of conversations' structure, by rank-convergence parallel Viterbi.

The roles of a good conversation read ``(s?(ua)+)?`` by their initials. What the rest of a
conversation costs from each state of that pattern is a vector of four costs, computed from the last
turn to the first. All turns, sorted, are cut into chunks of one size wherever conversations end.
Every chunk starts at once: from the end of a conversation with true costs, amid one with a guess.
Fix-up passes rerun the chunks whose guess differs from what the chunk after them found by more than
a constant; what has not converged after a few passes is put together by doubling. The stitched
backward costs then lead a trace from the front, whose entry states are settled the same way.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import key_text, quoted, stored

CHUNK_ROWS = 4_096
SPACE = " \t\n\x0b\x0c\r"
TIE_CHARS = 64

# States: nothing yet, after s, after u, after a. Classes of rows: s, u, a, other initials.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
KEEPS = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}  # (state, class) -> state
NEXT = (USER, USER, ASSISTANT, USER)  # where an inserted or re-roled turn leads
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}
OK, TRUNCATED, MUST_GO = range(3)
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5

Vector = tuple[int, int, int, int]
#: Costs from each state at the end of a conversation: what is open is closed by insertions.
END: Vector = (0, 2 * INSERT, INSERT, 0)
GUESS: Vector = (0, 0, 0, 0)
GUESSED_STATE = ASSISTANT
FAR = 1 << 40
#: So many fix-up passes, each over the chunks that are still wrong; stretches that have not
#: converged by then are settled by doubling.
PASSES = 4


@lru_cache(1 << 16)
def step(after: Vector, kind: int, status: int) -> tuple[Vector, int]:
    """(costs from each state before a row, less their minimum; that minimum)."""
    costs = [_choices(after, kind, status, q)[0] for q in range(4)]
    for _ in range(2):  # insertions before the row: at most u and a
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    least = min(costs)
    return tuple(c - least for c in costs), least


def _choices(after: Vector, kind: int, status: int, q: int) -> tuple[int, int, int, int]:
    """(cheapest, delete, keep, rerole) for a row met in state ``q``."""
    delete, far = DELETE + after[q], FAR
    if status == MUST_GO:
        return delete, delete, far, far
    extra = LEFT_TRUNCATED if status == TRUNCATED else 0
    keep = extra + after[KEEPS[q, kind]] if (q, kind) in KEEPS else far
    rerole = REROLE + extra + after[NEXT[q]]
    return min(delete, keep, rerole), delete, keep, rerole


@lru_cache(1 << 16)
def move(after: Vector, kind: int, status: int, q: int) -> tuple[int, str, str, int]:
    """(next state, insertions before, edit, cost) of the cheapest edits at a row.

    Of equal ones the initials that come first in ASCII: delete, insert, keep, rerole. After every
    edit the same choice is left to what follows, so taking the least letter each time is least.
    """
    before, least = step(after, kind, status)
    inserted = ""
    while True:
        cost = before[q] + least
        _, delete, keep, _ = _choices(after, kind, status, q)
        spent = INSERT * len(inserted)
        if cost == delete:
            return q, inserted, "D", spent + DELETE
        if cost == INSERT + before[NEXT[q]] + least:
            q = NEXT[q]
            inserted += "ua"[q == ASSISTANT]
            continue
        extra = LEFT_TRUNCATED if status == TRUNCATED else 0
        if cost == keep:
            return KEEPS[q, kind], inserted, "K", spent + extra
        return NEXT[q], inserted, "R", spent + REROLE + extra


class Chunk(NamedTuple):
    """Rows of a chunk: class, status, copies, and whether each is the last of its conversation."""

    kinds: list[int]
    statuses: list[int]
    copies: list[int]
    ends: list[bool]
    convs: list[str]

    def backward(self, last: Vector) -> list[Vector]:
        """Costs before each row (less a constant), and those after the last row."""
        now = last
        costs = [now]
        for kind, status, end in zip(
            reversed(self.kinds), reversed(self.statuses), reversed(self.ends), strict=True
        ):
            now, _ = step(END if end else now, kind, status)
            costs.append(now)
        return costs[::-1]

    def transfer(self) -> list[int]:
        """Costs from each state before the first row to each after the last, by rows; of a chunk
        that lies within one conversation."""
        columns = []
        for k in range(4):
            now, spent = tuple(0 if q == k else FAR for q in range(4)), 0
            for kind, status in zip(reversed(self.kinds), reversed(self.statuses), strict=True):
                now, least = step(now, kind, status)
                spent += least
            columns.append([min(FAR, c + spent) for c in now])
        return [columns[k][q] for q in range(4) for k in range(4)]

    def exit_state(self, last: Vector, entry: int) -> int:
        q, costs = entry, self.backward(last)
        for i, (kind, status, end) in enumerate(zip(self.kinds, self.statuses, self.ends, strict=True)):
            q = move(END if end else costs[i + 1], kind, status, q)[0]
            q = EMPTY if end else q
        return q

    def trace(self, last: Vector, entry: int, next_kind: int | None) -> tuple[list[dict], list[dict]]:
        """(one summary per conversation, one edit per row that stays or has insertions beside)."""
        costs = self.backward(last)
        q, parts, edits = entry, [], []
        letters, cost, illegal = [], 0, 0
        n = len(self.kinds)
        for i in range(n):
            end, copies = self.ends[i], self.copies[i]
            at, before, letter, paid = move(
                END if end else costs[i + 1], self.kinds[i], self.statuses[i], q
            )
            letters += ["I" * len(before), letter, "D" * (copies - 1)]
            cost += paid + DELETE * (copies - 1)
            illegal += copies - 1
            q, after = at, ""
            if end:
                after = {SYSTEM: "ua", USER: "a"}.get(q, "")
                letters.append("I" * len(after))
                cost += INSERT * len(after)
            else:
                following = self.kinds[i + 1] if i + 1 < n else next_kind
                illegal += (self.kinds[i], following) not in LEGAL
            if letter != "D" or before or after:
                role = NAMES[at] if letter == "R" else None
                edits.append({"nth": i, "before": before, "edit": letter, "role": role, "after": after})
            if end or i + 1 == n:
                parts.append(
                    {"key": self.convs[i], "audit": "".join(letters), "cost": cost, "illegal": illegal}
                )
                letters, cost, illegal = [], 0, 0
                q = EMPTY if end else q
        return parts, edits


def _chunks(batch: pa.RecordBatch):
    """The chunks of a batch, from columns ``cells`` and ``next_key``."""
    cells, following = batch.column("cells"), batch.column("next_key").to_pylist()
    for i, next_key in enumerate(following):
        rows = cells[i].values
        convs = rows.field("key").to_pylist()
        ends = [a != b for a, b in zip(convs, [*convs[1:], next_key], strict=True)]
        yield Chunk(
            rows.field("kind").to_pylist(),
            rows.field("status").to_pylist(),
            rows.field("copies").to_pylist(),
            ends,
            convs,
        )


def _costs(batches):
    """(g, open, used, first): costs a chunk began with and those before its first row."""
    for batch in batches:
        used = [tuple(v) for v in batch.column("used").to_pylist()]
        first = [c.backward(v)[0] for c, v in zip(_chunks(batch), used, strict=True)]
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("g"), batch.column("goes_on"), pa.array(used, kind), pa.array(first, kind)],
            names=["g", "goes_on", "used", "found"],
        )


def _states(batches):
    for batch in batches:
        entry = batch.column("used").to_pylist()
        last = [tuple(v) for v in batch.column("costs").to_pylist()]
        found = [c.exit_state(v, q) for c, v, q in zip(_chunks(batch), last, entry, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("g"), batch.column("came_on"), batch.column("used"), pa.array(found, pa.int32())],
            names=["g", "came_on", "used", "found"],
        )


PARTS = "g bigint, parts array<struct<key string, audit string, cost bigint, illegal bigint>>"
EDITS = "edits array<struct<nth int, before string, edit string, role string, after string>>"


def _traces(batches):
    for batch in batches:
        last = [tuple(v) for v in batch.column("costs").to_pylist()]
        entry, kinds = batch.column("used").to_pylist(), batch.column("next_kind").to_pylist()
        found = [c.trace(*x) for c, *x in zip(_chunks(batch), last, entry, kinds, strict=True)]
        text = pa.string()
        part = pa.struct([("key", text), ("audit", text), ("cost", pa.int64()), ("illegal", pa.int64())])
        edit = pa.struct([("nth", pa.int32()), *[(c, text) for c in ("before", "edit", "role", "after")]])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("g"),
                pa.array([p for p, _ in found], pa.list_(part)),
                pa.array([e for _, e in found], pa.list_(edit)),
            ],
            names=["g", "parts", "edits"],
        )


def _transfers(batches):
    """(g, t): how the costs after a chunk become those before it."""
    for batch in batches:
        found = [c.transfer() for c in _chunks(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("g"), pa.array(found, pa.list_(pa.int64()))], names=["g", "t"]
        )


def _exits(batches):
    """(g, t): how the state before a chunk becomes that after it."""
    for batch in batches:
        last = [tuple(v) for v in batch.column("costs").to_pylist()]
        found = [[c.exit_state(v, q) for q in range(4)] for c, v in zip(_chunks(batch), last, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("g"), pa.array(found, pa.list_(pa.int64()))], names=["g", "t"]
        )


class Pass(NamedTuple):
    """A direction of passes: what chunks run, the neighbour that a chunk with ``flag`` depends on;
    and for doubling, ``functions`` of chunks within one conversation, how two in a row are put
    together (SQL of ``t`` and ``next_t``) and applied to what the neighbour found (``t``, ``found``)."""

    run: object
    schema: str
    neighbour: int
    flag: str
    functions: object
    compose: str
    apply: str


_FOUND = "transform(sequence(0, 3), i -> array_min(transform(sequence(0, 3), k -> t[i * 4 + k] + found[k])))"
BACKWARD = Pass(
    _costs,
    "g bigint, goes_on boolean, used array<bigint>, found array<bigint>",
    1,
    "goes_on",
    _transfers,
    f"""transform(sequence(0, 15), x -> least({FAR}L, array_min(transform(sequence(0, 3),
        k -> t[(x div 4) * 4 + k] + next_t[k * 4 + x % 4]))))""",
    f"transform(array({_FOUND}), v -> transform(v, c -> c - array_min(v)))[0]",
)
FORWARD = Pass(
    _states,
    "g bigint, came_on boolean, used int, found int",
    -1,
    "came_on",
    _exits,
    "transform(next_t, q -> t[cast(q as int)])",
    "cast(t[found] as int)",
)


def settled(chunks: DataFrame, begun: DataFrame, way: Pass, passes: int = PASSES) -> DataFrame:
    """g and ``used`` of every chunk: what it begins with once all agree with their neighbours.

    ``begun`` are the chunks with the ``used`` that is guessed first. A pass joins neighbours by
    number, so no conversation meets in one task, and reruns only what had another start. Vectors are
    kept less their minimum: equal means that they differ by a constant. Usually costs converge within
    a chunk and one pass is enough. Where they do not, a pass goes one chunk further only; after
    ``passes`` of them, the functions of the chunks that lie within one conversation are put together
    in twos, fours and so on, which settles a stretch of n chunks in log2(n) joins.
    """
    now = stored(begun.mapInArrow(way.run, way.schema), "chunk-costs")
    for _ in range(passes):
        found = now.select((F.col("g") - way.neighbour).alias("g"), F.col("found").alias("need"))
        wrong = now.where(way.flag).join(found, "g").where("need <> used").select("g", "need")
        wrong = stored(wrong, "chunks-to-rerun")
        if wrong.isEmpty():
            return now.select("g", "used")
        redone = chunks.join(wrong.withColumnRenamed("need", "used"), "g").mapInArrow(way.run, way.schema)
        now = stored(now.join(wrong, "g", "left_anti").unionByName(redone), "chunk-costs")
    return _doubled(chunks, now, way)


def _doubled(chunks: DataFrame, now: DataFrame, way: Pass) -> DataFrame:
    """``settled`` from functions of chunks; those of all other chunks have found what is true."""
    inside = chunks.where((F.col("cells")[0]["key"] == F.element_at("cells", -1)["key"]) & F.col("goes_on"))
    if way.flag == "came_on":
        inside = inside.where("came_on")
    chains = inside.mapInArrow(way.functions, "g bigint, t array<bigint>")
    chains = stored(chains.withColumn("to", F.col("g") + way.neighbour), "chunk-functions")
    while not chains.join(chains.select(F.col("g").alias("to")), "to", "left_semi").isEmpty():
        further = chains.select(F.col("g").alias("to"), F.col("t").alias("next_t"), F.col("to").alias("next_to"))
        chains = stored(
            chains.join(further, "to", "left").select(
                "g",
                F.when(F.col("next_to").isNull(), F.col("t")).otherwise(F.expr(way.compose)).alias("t"),
                F.coalesce("next_to", "to").alias("to"),
            ),
            "chunk-functions",
        )
    true = now.join(chains, "g", "left_anti").select("g", "found")
    led = chains.join(true.withColumnRenamed("g", "to"), "to").select("g", F.expr(way.apply).alias("found"))
    found = true.unionByName(led).select((F.col("g") - way.neighbour).alias("g"), F.col("found").alias("need"))
    used = F.when(F.col(way.flag), F.coalesce("need", "used")).otherwise(F.col("used"))
    return stored(now.join(found, "g", "left").select("g", used.alias("used")), "chunk-costs")


class Repair(NamedTuple):
    """``report`` has a row per conversation: key, gaps, blank, duplicate, truncated, illegal, cost,
    audit. ``turns`` has the repaired conversations: key, place, nth, role, text, in this order.
    ``key`` is the conversation's id as ``common.key_text`` writes it."""

    report: DataFrame
    turns: DataFrame


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    chunk_rows: int = CHUNK_ROWS,
    passes: int = PASSES,
) -> Repair:
    """Count the faults of each conversation and repair it at least cost.

    A row's first fault counts: blank (white space only), duplicate (role and text came earlier in
    the conversation), truncated (the last other character is no ``.!?``). Keeping a row is free, a
    new role costs 1, a deletion 2 (the only choice for blank and duplicate rows), an inserted empty
    turn 5, a truncated row that stays 5 more. ``audit`` has the edits' initials, the first in ASCII
    order of equally cheap ones. ``gaps`` is how many turns from the first to the last are missing.

    Rows are ordered by turn, NULL first, then role, the first 64 characters of the text and its hash.
    Equal rows are put together first and told by a count, so a turn repeated without end is one row.
    A NULL conversation id is a conversation of its own; NULL roles and texts are one space. A role
    without a legal initial, empty ones too, must be changed or deleted. Other columns are ignored.
    Texts may have any length; an empty table has no report.

    No step needs a conversation in one task: rows are sorted by ranges, chunks of ``chunk_rows`` rows
    meet their neighbours by number. Only the audit of a conversation is one value, a letter a row.
    """
    spark = rows.sparkSession
    given = rows.select(
        key_text(quoted(conv_col)).alias("key"),
        quoted(turn_col).cast("bigint").alias("turn"),
        F.coalesce(quoted(role_col), F.lit(" ")).alias("role"),
        F.coalesce(quoted(text_col), F.lit(" ")).alias("text"),
    )
    distinct = given.groupBy("key", "turn", "role", "text").agg(F.count("*").alias("copies"))
    saying = F.sha2(F.concat(F.sha2(F.col("role").cast("binary"), 256), "text").cast("binary"), 256)
    distinct = stored(distinct.withColumn("saying", saying), "turns")

    # The first row that says something is one row, so this join has no key with many rows.
    numbered = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = distinct.groupBy("key", "saying").agg(F.min(numbered).alias("at")).select(
        F.col("key").alias("key_"), F.col("saying").alias("saying_"), F.col("at.turn").alias("turn_")
    )
    same = (
        (F.col("key") == F.col("key_"))
        & (F.col("saying") == F.col("saying_"))
        & F.col("turn").eqNullSafe(F.col("turn_"))
    )
    marked = distinct.join(first, same, "left").withColumn("new", F.col("key_").isNotNull())

    solid = F.rtrim(F.col("text"), F.lit(SPACE))
    blank = solid == ""
    whole = F.right(solid, F.lit(1)).isin(".", "!", "?")
    goes = blank | ~F.col("new")
    status = F.when(goes, MUST_GO).when(~whole, TRUNCATED).otherwise(OK)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    marked = marked.select(
        "key", "turn", "role", "text", "copies", kind.alias("kind"), status.alias("status"),
        blank.alias("blank"), "new",
    )
    order = [
        F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"),
        F.substring("text", 1, TIE_CHARS), F.sha2(F.col("text").cast("binary"), 256),
    ]
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered-turns")

    chunks = _chunked(spark, ordered, chunk_rows)
    begin = F.when(F.col("goes_on"), F.lit(list(GUESS))).otherwise(F.lit(list(END)))
    begun = chunks.withColumn("used", begin.cast("array<bigint>"))
    backward = settled(chunks, begun, BACKWARD, passes)
    chunks = chunks.join(backward.withColumnRenamed("used", "costs"), "g")

    begin = F.when(F.col("came_on"), F.lit(GUESSED_STATE)).otherwise(F.lit(EMPTY))
    forward = settled(chunks, chunks.withColumn("used", begin), FORWARD, passes)
    chunks = chunks.join(forward, "g")
    traced = stored(chunks.mapInArrow(_traces, f"{PARTS}, {EDITS}"), "traced-chunks")

    return Repair(_report(ordered, traced), _turns(ordered, traced, _places(spark, ordered, chunk_rows), chunk_rows))


def _numbers(chunk_rows: int) -> tuple[F.Column, F.Column, F.Column]:
    """(partition, chunk within it, row within that) of a ``place``."""
    part, nth = F.shiftright("place", 33), F.expr(f"place & {(1 << 33) - 1}L")
    return part, F.floor(nth / chunk_rows), (nth % chunk_rows).cast("int")


def _places(spark, ordered: DataFrame, chunk_rows: int) -> DataFrame:
    """(part, before): chunks before each partition's first. As many rows as partitions."""
    part, chunk, _ = _numbers(chunk_rows)
    found = ordered.groupBy(part.alias("part")).agg((F.max(chunk) + 1).alias("n")).collect()
    before, total = [], 0
    for row in sorted(found):
        before.append((row.part, total))
        total += row.n
    return spark.createDataFrame(before, "part long, before long")


def _chunked(spark, ordered: DataFrame, chunk_rows: int) -> DataFrame:
    """g, cells, next_key, next_kind, goes_on, came_on: chunks numbered through, and what is beside."""
    part, chunk, nth = _numbers(chunk_rows)
    cell = F.struct(nth.alias("nth"), "key", "kind", "status", "copies")
    cells = ordered.groupBy(part.alias("part"), chunk.alias("chunk")).agg(
        F.array_sort(F.collect_list(cell)).alias("cells")
    )
    places = F.broadcast(_places(spark, ordered, chunk_rows))  # a row per partition
    cells = cells.join(places, "part").select((F.col("before") + F.col("chunk")).alias("g"), "cells")
    cells = stored(cells, "chunks")
    head, tail = F.col("cells")[0], F.element_at("cells", -1)
    after = cells.select(
        (F.col("g") - 1).alias("g"), head["key"].alias("next_key"), head["kind"].alias("next_kind")
    )
    before = cells.select((F.col("g") + 1).alias("g"), tail["key"].alias("last_key"))
    beside = cells.join(after, "g", "left").join(before, "g", "left")
    return stored(
        beside.select(
            "g", "cells", "next_key", "next_kind",
            F.coalesce(F.col("next_key") == tail["key"], F.lit(False)).alias("goes_on"),
            F.coalesce(F.col("last_key") == head["key"], F.lit(False)).alias("came_on"),
        ),
        "chunks",
    )


def _report(ordered: DataFrame, traced: DataFrame) -> DataFrame:
    extra = F.when(F.col("new"), F.col("copies") - 1).otherwise(F.col("copies"))
    span = F.max("turn") - F.min("turn") + 1
    counts = ordered.groupBy("key").agg(
        F.coalesce(span - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), extra).otherwise(0)).alias("duplicate"),
        F.sum((F.col("status") == TRUNCATED).cast("bigint")).alias("truncated"),
    )
    parts = traced.select("g", F.explode("parts").alias("p")).select("g", "p.*")
    audit = F.array_sort(F.collect_list(F.struct("g", "audit")))
    whole = parts.groupBy("key").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(audit, lambda p: p["audit"]), "").alias("audit"),
    )
    return counts.join(whole, "key")


def _turns(ordered: DataFrame, traced: DataFrame, places: DataFrame, chunk_rows: int) -> DataFrame:
    """Rows that stay, with their role, and inserted ones."""
    part, chunk, nth = _numbers(chunk_rows)
    numbered = ordered.select("key", "place", "role", "text", part.alias("part"), chunk.alias("c"), nth.alias("nth"))
    numbered = numbered.join(F.broadcast(places), "part").withColumn("g", F.col("before") + F.col("c"))
    edits = traced.select("g", F.explode("edits").alias("e")).select(
        "g", "e.nth", F.col("e.before").alias("first"), "e.edit", F.col("e.role").alias("new_role"), "e.after"
    )
    rows = numbered.drop("before").join(edits, ["g", "nth"])
    empty = lambda c: F.struct(
        F.when(c == "u", NAMES[USER]).otherwise(NAMES[ASSISTANT]).alias("role"), F.lit("").alias("text")
    )
    inserted = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: x != ""), empty)
    own = F.struct(F.coalesce("new_role", "role").alias("role"), F.col("text").alias("text"))
    stays = F.when(F.col("edit") != "D", F.array(own)).otherwise(F.array().cast(
        "array<struct<role:string,text:string>>"
    ))
    told = F.posexplode(F.concat(inserted(F.col("first")), stays, inserted(F.col("after"))))
    return rows.select("key", "place", told.alias("nth", "turn")).select(
        "key", "place", "nth", "turn.role", "turn.text"
    )


def digests(turns: DataFrame) -> DataFrame:
    """(key, sha256): lowercase hex SHA-256 of each repaired conversation, ``role:text`` by lines.

    SHA-256 runs from the first byte to the last, so a conversation's turns pass through one task;
    they come sorted and are not held.
    """
    by = turns.repartition("key").sortWithinPartitions("key", "place", "nth")
    line = F.concat("role", F.lit(":"), "text").cast("binary")

    def hashed(batches):
        now, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for key, data in zip(batch.column("key").to_pylist(), batch.column("line"), strict=True):
                if key != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(data.as_buffer())
            yield _pairs(out)
        if now is not None:
            yield _pairs([(now, digest.hexdigest())])

    return by.select("key", line.alias("line")).mapInArrow(hashed, "key string, sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["key", "sha256"])
