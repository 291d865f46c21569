"""What was loaded: path, length, time and content of every file, kept beside the bronze tables.

A stream remembers paths only. The ledger tells a file that was replaced under its name, and a copy
under another name.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.sources.store import files

SCHEMA = "path string, length bigint, modified bigint, digest string, copy_of string"


class File(NamedTuple):
    path: str
    length: int
    modified: int


class Changes(NamedTuple):
    """New files, those replaced since they were loaded, and new ones that hold what another file
    holds. ``entries`` is the ledger as it will be when all are loaded, ``loaded`` as it is."""

    new: list[str]
    replaced: list[str]
    copies: dict[str, str]
    entries: dict[str, tuple]
    loaded: dict[str, tuple]


def plain(path: str) -> str:
    """One spelling of a path: a local one may have one or three slashes after ``file:``."""
    return re.sub(r"^file:/+", "file:///", path)


def listed(spark: SparkSession, path: str) -> list[File]:
    """The files that a load of ``path`` (file, folder or pattern) would read, by name."""
    fs, at = files(spark, path)
    found = []
    for top in fs.globStatus(at) or []:
        below = fs.listFiles(top.getPath(), True)
        root = top.getPath().toString()
        while below.hasNext():
            status = below.next()
            name = status.getPath().toString()
            parts = name[len(root) :].split("/")
            if not any(p.startswith(("_", ".")) for p in parts if p):
                found.append(File(plain(name), status.getLen(), status.getModificationTime()))
    return sorted(found)


def contents(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """A digest of what each file holds.

    That is the file system's checksum where it keeps one. Otherwise the files' lines are hashed over
    many tasks, in no order: files that differ in the order of their lines alone count as the same.
    """
    found, unknown = {}, []
    for path in paths:
        fs, at = files(spark, path)
        kept = fs.getFileChecksum(at)
        if kept is None:
            unknown.append(path)
        else:
            found[path] = kept.toString()
    if not unknown:
        return found
    lines = spark.read.option("lineSep", "\n").text(unknown)
    hashed = F.sum(F.xxhash64("value").cast("decimal(28,0)")).cast("decimal(38,0)")
    sums = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("n"), hashed.alias("h"), F.bit_xor(F.xxhash64("value", F.lit(7))).alias("x")
    )
    read = {plain(r.path): f"{r.n}:{r.h}:{r.x}" for r in sums.collect()}  # a row per file
    return found | {path: read.get(path, "") for path in unknown}


class Ledger:
    """The loaded files of one generation of a bronze table, in numbered versions below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _newest(self) -> str | None:
        fs, path = files(self.spark, self.folder)
        if not fs.exists(path):
            return None
        names = sorted(s.getPath().getName() for s in fs.listStatus(path))
        whole = [n for n in names if fs.exists(files(self.spark, f"{self.folder}/{n}/_SUCCESS")[1])]
        return whole[-1] if whole else None

    def table(self) -> DataFrame:
        """path, length, modified, digest, copy_of."""
        newest = self._newest()
        if newest is None:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/{newest}")

    def entries(self) -> dict[str, tuple]:
        return {r.path: tuple(r) for r in self.table().collect()}  # as many as the listing has files

    def changes(self, now: list[File]) -> Changes:
        """What ``now`` has that was not loaded yet. Only files that are new, or changed in length or
        time, are read; one that was only touched is no change."""
        known = self.entries()
        new = [f for f in now if f.path not in known]
        touched = [f for f in now if f.path in known and tuple(f)[1:] != known[f.path][1:3]]
        digests = contents(self.spark, [f.path for f in (*new, *touched)])
        replaced = [f.path for f in touched if digests[f.path] != known[f.path][3]]
        holders = {}
        for path, (_, length, _, digest, _) in sorted(known.items()):
            if path not in replaced:
                holders.setdefault((length, digest), path)
        entries, copies = dict(known), {}
        for f in sorted((*new, *touched)):
            holder = holders.setdefault((f.length, digests[f.path]), f.path)
            if f in new and holder != f.path and f.length:
                copies[f.path] = holder
            entries[f.path] = (*f, digests[f.path], copies.get(f.path, known.get(f.path, [None] * 5)[4]))
        return Changes([f.path for f in new], replaced, copies, entries, known)

    def write(self, entries: dict[str, tuple]) -> None:
        newest = self._newest()
        number = int(newest[:8]) + 1 if newest else 1
        path = f"{self.folder}/{number:08d}-{uuid.uuid4().hex[:8]}"
        rows = self.spark.createDataFrame(sorted(entries.values()), SCHEMA)
        rows.coalesce(1).write.parquet(path)
