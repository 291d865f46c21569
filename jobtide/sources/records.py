"""Records that span lines, from files that many tasks read.

A task reads the lines that begin in its part of a file, and cannot know whether its first line
begins a record. So a file is read in three passes over its lines: what each part does to the state
of the reader, which tells the state that each part begins in; the pieces of records at the ends of
the parts, put together by file; and the records that lie whole within a part. Only the first two
leave anything between tasks: a row per part, and a record per boundary. Rows never move.

Fields are not parsed here: records go to Spark's own CSV and JSON functions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobtide.sources.store import files, scratch_path

SURVEY = "file string, start bigint, returns boolean, states array<bigint>"
PIECE = "file string, start bigint, part int, header boolean, text string"
HEAD, THROUGH, TAIL = 0, 1, 2


def lines_of(reader, path: str | list[str]) -> DataFrame:
    """value, file, start: the lines of text files, and the part of a file that a line begins in.

    ``reader`` is ``spark.read`` or ``spark.readStream``. Lines end at ``\\n``; a ``\\r`` before it
    stays with the line.
    """
    lines = reader.option("lineSep", "\n").text(path)
    place = F.col("_metadata")
    return lines.select(
        "value", place["file_path"].alias("file"), place["file_block_start"].alias("start")
    )


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file at ``path``, a file, folder or pattern."""
    fs, at = files(spark, path)
    most = 0
    for status in fs.globStatus(at) or []:
        if status.isFile():
            most = max(most, status.getLen())
            continue
        found = fs.listFiles(status.getPath(), True)
        while found.hasNext():
            most = max(most, found.next().getLen())
    return most


def worth_splitting(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether a file is larger than the part of a file that Spark gives to a task."""
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most)
    return any(largest_file(spark, p) > size for p in ([path] if isinstance(path, str) else path))


class Part(NamedTuple):
    """A run of lines of one part of a file; ``fresh`` if it is the first of that part."""

    file: str
    start: int
    fresh: bool
    lines: list[str]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    now = None
    for batch in batches:
        lines, low = batch.column("value").to_pylist(), 0
        # Equal values side by side are made once, as a file has far more lines than parts.
        file, start = (pc.run_end_encode(batch.column(c)) for c in ("file", "start"))
        ends = [run.run_ends.to_pylist() for run in (file, start)]
        values = [run.values.to_pylist() for run in (file, start)]
        nth = [0, 0]
        while low < len(lines):
            high = min(ends[0][nth[0]], ends[1][nth[1]])
            at = values[0][nth[0]], values[1][nth[1]]
            yield Part(*at, at != now, lines[low:high])
            now, low = at, high
            nth = [n + (e[n] == high) for n, e in zip(nth, ends, strict=True)]


def _rows(rows: list[tuple], names: tuple[str, ...], kinds: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names)
    )


class Cutter(NamedTuple):
    """How a format is cut. ``after(lines, state)`` is the state after lines, which states it starts
    from being ``guesses``; ``cutting(state, first)`` makes an object whose ``feed(lines)`` returns
    finished pieces as (part, header, text) and whose ``rest()`` returns the last, those of part None
    being whole."""

    guesses: tuple[int, ...]
    after: Callable[[list[str], int], int]
    cutting: Callable[[int, bool], object]


def _survey(cutter: Cutter):
    """(file, start, whether its first line ends with \\r, [state after the part, from each guess])."""
    names = ("file", "start", "returns", "states")
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64()))

    def survey(batches):
        now, states = None, []
        for part in _parts(batches):
            if part.fresh:
                if now is not None:
                    yield _rows([(*now, states)], names, kinds)
                now = part.file, part.start, part.lines[0].endswith("\r")
                states = list(cutter.guesses)
            states = [cutter.after(part.lines, s) for s in states]
        if now is not None:
            yield _rows([(*now, states)], names, kinds)

    return survey


def _cut(cutter: Cutter, found: Broadcast, whole: bool):
    """Records that lie within their part (``whole``), or the pieces at its ends. ``found`` holds the
    states that parts begin in, and the files whose lines end with ``\\r\\n``."""
    names = ("record",) if whole else ("file", "start", "part", "header", "text")
    kinds = (pa.string(),) if whole else (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())

    def cut(batches):
        states, returns = found.value
        now, cutting = None, None
        for part in _parts(batches):
            if part.fresh:
                if cutting is not None:
                    yield from wanted(now, cutting.rest())
                now = (part.file, part.start)
                cutting = cutter.cutting(states.get(now, 0), part.start == 0)
            lines = part.lines
            if part.file in returns:
                lines = [line.removesuffix("\r") for line in lines]
            yield from wanted(now, cutting.feed(lines))
        if cutting is not None:
            yield from wanted(now, cutting.rest())

    def wanted(now, pieces):
        if whole:
            rows = [(text,) for part, _, text in pieces if part is None]
        else:
            rows = [(*now, *piece) for piece in pieces if piece[0] is not None]
        if rows:
            yield _rows(rows, names, kinds)

    return cut


def _put_together(pieces: DataFrame) -> DataFrame:
    """Records that several parts share: each begins with a tail. A row per boundary of parts."""
    order = Window.partitionBy("file").orderBy("start", "part")
    begun = F.sum((F.col("part") == TAIL).cast("int")).over(order)
    piece = F.struct("start", "part", "text")
    return (
        pieces.withColumn("nth", begun)
        .groupBy("file", "nth")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.max("header").alias("header"))
        .where("not header")
        .select(F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("record"))
    )


def _records(
    lines: DataFrame, cutter: Cutter, states: dict[tuple[str, int], int], returns: set[str]
) -> DataFrame:
    spark = lines.sparkSession
    path = scratch_path(spark, "pieces-of-records")
    # Once a worker, not once a task: there are as many states as tasks.
    found = spark.sparkContext.broadcast((states, returns))
    lines.mapInArrow(_cut(cutter, found, False), PIECE).write.parquet(path)
    pieces = spark.read.schema(PIECE).parquet(path)
    whole = lines.mapInArrow(_cut(cutter, found, True), "record string")
    return whole.unionByName(_put_together(pieces)).where("trim(both ' \t\r\n' from record) <> ''")


# --- CSV ---


_QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'


def quoted_after(line: str, quoted: int) -> int:
    """Whether a field is still open after ``line``, by the rules of quoting: a quote opens at the
    start of a field only, and two quotes are one inside."""
    if '"' not in line:
        return quoted
    at = 0
    if not quoted and line[0] == '"':
        quoted, at = 1, 1
    while True:
        while quoted:
            at = line.find('"', at)
            if at < 0:
                return 1
            quoted = int(line[at + 1 : at + 2] == '"')
            at += 1 + quoted
        at = line.find(',"', at) + 2
        if at < 2:
            return 0
        quoted = 1


def quoted_after_all(lines: list[str], quoted: int) -> int:
    """``quoted_after`` of one line after another."""
    for line in lines:
        if '"' in line:
            quoted = quoted_after(line, quoted)
    return quoted


def left_open(line: Column) -> Column:
    """``quoted_after(line, 0)`` as Spark computes it."""
    # Quotes in pairs never change the state, and of the others the last decides, if it may open.
    single = F.replace(line, F.lit('""'), F.lit(""))
    ends = F.concat(F.lit('"'), F.substring_index(single, '"', -1))
    may_open = (single == ends) | single.endswith(F.concat(F.lit(","), ends))
    return F.contains(single, F.lit('"')) & may_open & F.regexp_replace(line, _QUOTED, "").rlike('^"|,"')


def files_to_cut(lines: DataFrame) -> list[str]:
    """CSV files that may have a record over several lines, or lines ended by ``\\r\\n``; told from
    every line. In the others no line leaves a field open, so each record is a line and any reader
    may cut them at lines.
    """
    several = left_open(F.col("value")) | F.contains("value", F.lit("\r"))
    found = lines.where(several).select("file").distinct()
    return [r.file for r in found.collect()]  # files, as Spark lists them


class _CsvCutting:
    """Lines to records; a record ends with a line after which no field is open."""

    def __init__(self, quoted: int, first: bool):
        self.quoted, self.open, self.inherited = quoted, [], bool(quoted)
        self.header = first  # the first record of a file is not data

    def feed(self, lines: list[str]):
        quoted = self.quoted
        for line in lines:
            before = quoted
            if '"' in line:
                quoted = quoted_after(line, quoted)
            if quoted:
                self.open.append(line)
                continue
            if not before:
                if not line or line.isspace():
                    continue
                text, part = line, None
            else:
                text, part = "\n".join([*self.open, line]), HEAD if self.inherited else None
                self.open, self.inherited = [], False
            if part is None and self.header:
                self.header = False
                continue
            yield part, False, text
        self.quoted = quoted

    def rest(self):
        if self.open:
            yield THROUGH if self.inherited else TAIL, self.header, "\n".join(self.open)


CSV = Cutter((0, 1), quoted_after_all, _CsvCutting)


def csv_records(lines: DataFrame) -> DataFrame:
    """(record): every record of CSV files but the first of each, line breaks in fields and all.

    A file whose first line ends with ``\\r\\n`` has such lines, and ``\\n`` in their place in fields.
    Blank lines between records are passed over. A file that ends within quotes fails.
    """
    surveyed = lines.mapInArrow(_survey(CSV), SURVEY)
    # A part sets the state, or keeps or turns it: the last that sets it, and the turns since, decide.
    sets = F.col("states")[0] == F.col("states")[1]
    turns = (F.col("states")[0] == 1) & ~sets
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    counted = surveyed.withColumn("turns", F.sum(turns.cast("int")).over(order))
    state = F.struct(F.col("states")[0].alias("state"), "turns")
    known = counted.select(
        "file",
        "start",
        "returns",
        "states",
        F.last(F.when(sets, state), ignorenulls=True).over(before).alias("set"),
        F.max("turns").over(before).alias("turns"),
    )
    quoted = F.coalesce(F.col("set.state"), F.lit(0)) + F.col("turns") - F.coalesce(F.col("set.turns"), F.lit(0))
    inside = F.coalesce(quoted % 2, F.lit(0))
    last = F.col("start") == F.max("start").over(Window.partitionBy("file"))
    found = known.select(
        "file",
        "start",
        (inside == 1).alias("inside"),
        ((F.col("start") == 0) & F.col("returns")).alias("returns"),
        (last & (F.get("states", inside.cast("int")) == 1)).alias("broken"),
    )
    found = found.where("inside or returns or broken").collect()  # parts of files, as Spark lists them
    if broken := [r.file for r in found if r.broken]:
        raise ValueError(f"malformed CSV, a quoted field is open at the end: {broken[:5]}")
    states = {(r.file, r.start): 1 for r in found if r.inside}
    return _records(lines, CSV, states, {r.file for r in found if r.returns})


# --- JSON ---

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{},]')
_TEXT = re.compile(r'"(?:[^"\\\n]|\\.)*"')
_DEEPER = {"[": 1, "{": 1, "]": -1, "}": -1}


def depth_after(lines: list[str], depth: int) -> int:
    """Brackets open after ``lines``; a text ends in the line it begins in."""
    marks = _TEXT.sub("", "\n".join(lines))
    return depth + sum(deeper * marks.count(mark) for mark, deeper in _DEEPER.items())


class _JsonCutting:
    """Lines to the elements of the outer array, cut at the commas between them."""

    def __init__(self, depth: int, first: bool):
        self.depth, self.open, self.cut = depth, [], False
        self.outside = first

    def feed(self, lines: list[str]):
        for line in lines:
            begin = 0
            for token in _TOKEN.finditer(line):
                mark = token[0]
                if self.depth == 0:
                    if mark != "[" or not self.outside or line[begin : token.start()].strip():
                        raise ValueError(f"not an array of JSON records: {line[:80]!r}")
                    self.outside, self.depth, self.cut, begin = False, 1, True, token.end()
                    continue
                self.depth += _DEEPER.get(mark, 0)
                if self.depth == 0 or self.depth == 1 and mark == ",":
                    self.open.append(line[begin : token.start()])
                    yield self._piece(HEAD)
                    begin = token.end()
            if self.depth == 0 and line[begin:].strip():
                raise ValueError(f"not an array of JSON records: {line[:80]!r}")
            self.open.append(line[begin:])

    def _piece(self, part: int):
        text, self.open = "\n".join(self.open), []
        whole, self.cut = self.cut, True
        return (None if whole else part), False, text

    def rest(self):
        if self.depth:
            yield TAIL if self.cut else THROUGH, False, "\n".join(self.open)


JSON = Cutter((0,), depth_after, _JsonCutting)


def json_elements(lines: DataFrame) -> DataFrame:
    """(record): the text of every element of the array that each file holds, over any lines.

    A file that holds something else, or ends within the array, fails. Files without a line are
    passed over.
    """
    surveyed = lines.mapInArrow(_survey(JSON), SURVEY)
    order = Window.partitionBy("file").orderBy("start")
    deeper = F.sum(F.col("states")[0]).over(order)
    known = surveyed.select("file", "start", (deeper - F.col("states")[0]).alias("depth"), deeper.alias("after"))
    states, ends = {}, {}
    for row in known.collect():  # parts of files, as Spark lists them
        states[row.file, row.start] = row.depth
        ends[row.file] = max(ends.get(row.file, (-1, 0)), (row.start, row.after))
    broken = [file for file, (_, depth) in ends.items() if depth]
    if broken:
        raise ValueError(f"not whole arrays of JSON records: {broken[:5]}")
    return _records(lines, JSON, states, set())
