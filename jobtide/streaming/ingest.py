"""Bronze loads: a file that was loaded once is not loaded again, unless it was replaced.

Full and incremental loads are the same stream over an input's files. A full load starts a new
version of the table with a new record of loaded files, and takes its place when complete; later
loads add the files that have come since, each load as a partition of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.schemas import CSV_TABLES, JSON_TABLES, text_schema
from jobtide.sources.readers import (
    WITH_LINE_BREAKS,
    bronze_schema,
    csv_options,
    cut_by_records,
    parsed_array,
    parsed_csv,
    parsed_lines,
    record_schema,
)
from jobtide.sources.records import lines_of
from jobtide.sources.store import TableStore, files
from jobtide.streaming.ledger import Ledger, listed


def _reader(spark: SparkSession, max_files_per_trigger: int | None):
    # Files in folders below the input's own count as well.
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader


def stream_csv(
    spark: SparkSession,
    path: str,
    table: str,
    max_files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """Streaming rows of the CSV files of one input; ``options`` as in ``readers.read_csv``."""
    options.setdefault("multiline", table in WITH_LINE_BREAKS)
    reader = _reader(spark, max_files_per_trigger).schema(text_schema(CSV_TABLES[table]))
    return reader.options(**csv_options(**options)).csv(path)


def stream_json(
    spark: SparkSession,
    path: str,
    table: str,
    max_files_per_trigger: int | None = None,
    layout: str = "lines",
) -> DataFrame:
    """Streaming rows of the JSON files of one input, in any of the readers' layouts.

    ``lines`` splits files over tasks; ``records`` and ``document`` take a file to a task.
    """
    reader = _reader(spark, max_files_per_trigger)
    if layout == "lines":
        return parsed_lines(reader.text(path))
    reader = reader.option("multiLine", True)
    if layout == "records":
        return reader.schema(record_schema(table)).option("mode", "FAILFAST").json(path)
    if layout == "document":
        return reader.option("singleVariantColumn", "data").json(path)
    raise ValueError(f"unknown layout {layout!r}")


def input_path(spark: SparkSession, base: str, table: str) -> str:
    """``<base>/<table>`` or ``<base>/<table>.csv`` / ``.json``, a file or a folder of files.

    Batch and incremental loads read the same place. None or both of them is an error.
    """
    ending = "csv" if table in CSV_TABLES else "json"
    found = []
    for path in (f"{base}/{table}", f"{base}/{table}.{ending}"):
        fs, at = files(spark, path)
        if fs.exists(at):
            # A stream lists folders or patterns: a single file is a pattern that matches it.
            single = fs.getFileStatus(at).isFile()
            found.append(f"{path[:-1]}[{path[-1]}]" if single else path)
    if len(found) != 1:
        raise ValueError(f"expected one input for {table} below {base}, found {found}")
    return found[0]


def append_new_files(
    stream: DataFrame,
    store: TableStore,
    table: str,
    checkpoint: str,
    version: str | None = None,
    parse: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Load what has arrived since the last call into a bronze table, and return.

    ``checkpoint`` remembers the loaded files. Each micro-batch writes a partition under its own
    number and writes it anew when it is repeated after a failure, so rows are neither repeated
    nor lost, and rows that were in the table before stay. Numbers never clash, as a new version
    of the table starts a new checkpoint. Keep the checkpoint on shared storage. ``parse`` makes
    rows of the stream's lines, batch by batch.
    """

    def add(batch: DataFrame, number: int) -> None:
        rows = parse(batch) if parse else batch
        store.append_batch("bronze", table, rows, number, version)

    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def checkpoint_root(store: TableStore) -> str:
    """Where loads are remembered unless told otherwise: beside the tables."""
    if store.root is not None:
        return f"{store.root}/checkpoints"
    warehouse = store.spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/{store.namespace}_checkpoints"


def ledger(store: TableStore, table: str, checkpoints: str | None = None) -> Ledger:
    """The files loaded into a bronze table as it is now."""
    return _ledger(store, table, store.generation("bronze", table), checkpoints)


def _ledger(store: TableStore, table: str, generation: str | None, checkpoints: str | None) -> Ledger:
    folder = f"{checkpoints or checkpoint_root(store)}/{table}-ledger/{generation}"
    return Ledger(store.spark, folder)


def load_table(
    store: TableStore,
    base: str,
    table: str,
    full: bool = False,
    checkpoints: str | None = None,
    json_layout: str = "lines",
    max_files_per_trigger: int | None = None,
    on_replaced: str = "reload",
    on_copy: str = "load",
    **csv,
) -> None:
    """Bring one bronze table up to date, or load it anew from all files (``full``).

    ``json_layout`` is one of ``readers.JSON_LAYOUTS``; ``csv`` are the options of
    ``readers.read_csv``. A table that does not exist yet is loaded in full. A failing full load
    leaves the old table.

    The table's ledger tells files whose content was replaced under their name: the table is then
    loaded anew from all files, rows written directly staying (``on_replaced="reload"``), the load
    fails before it changes anything (``"refuse"``), or they are left as loaded (``"keep"``). A new
    file with the content of another one is loaded (``on_copy="load"``) or not (``"skip"``); the
    ledger names the file it is a copy of.
    """
    if on_replaced not in ("reload", "refuse", "keep") or on_copy not in ("load", "skip"):
        raise ValueError("on_replaced is reload, refuse or keep, and on_copy load or skip")
    spark = store.spark
    path = input_path(spark, base, table)
    files_now = listed(spark, path)
    now = store.generation("bronze", table)
    kept = None
    if now is not None and not full:
        known = _ledger(store, table, now, checkpoints)
        changes = known.changes(files_now)
        if changes.replaced and on_replaced == "refuse":
            raise ValueError(f"files of {table} were replaced after they were loaded: {changes.replaced[:5]}")
        if changes.replaced and on_replaced == "reload":
            full, kept = True, store.written_directly(table)
    version = store.begin("bronze", table) if now is None or full else None
    if version is not None:
        known = _ledger(store, table, version, checkpoints)
        changes = known.changes(files_now)
    skipped = sorted(changes.copies) if on_copy == "skip" else []

    parse = None
    if table in CSV_TABLES:
        if cut_by_records(spark, path, table, csv):
            stream = lines_of(_reader(spark, max_files_per_trigger), path)
            parse = partial(parsed_csv, table=table, **csv)
        else:
            stream = stream_csv(spark, path, table, max_files_per_trigger, **csv)
    elif json_layout == "array":
        stream = lines_of(_reader(spark, max_files_per_trigger), path)
        parse = parsed_array
    else:
        stream = stream_json(spark, path, table, max_files_per_trigger, json_layout)
    schema = bronze_schema(table) if parse else stream.schema
    if skipped:
        stream, parse = _without(stream, parse, skipped)

    checkpoint = f"{checkpoints or checkpoint_root(store)}/{table}/{version or now}"
    if version is not None:
        first = spark.createDataFrame([], schema) if kept is None else kept
        store.append_batch("bronze", table, first, -1, version)  # the schema, if no file has come yet
    append_new_files(stream, store, table, checkpoint, version, parse)
    if version is not None:
        store.finish("bronze", table, version)
    entries = changes.entries
    if version is None:  # what was left as loaded is still seen as replaced the next time
        entries = entries | {path: changes.loaded[path] for path in changes.replaced}
    if entries != changes.loaded:
        known.write(entries)


def _without(stream: DataFrame, parse, skipped: list[str]):
    """A stream that tells the file of each row, and a parser that drops those of ``skipped`` files."""
    place = F.regexp_replace("_metadata.file_path", "^file:/+", "file:///")
    marked = stream.select("*", place.alias("__file"))

    def kept(batch: DataFrame) -> DataFrame:
        rows = batch.where(~F.col("__file").isin(skipped)).drop("__file")
        return parse(rows) if parse else rows

    return marked, kept


def load_new_files(store: TableStore, base: str, checkpoints: str | None = None, **options) -> None:
    """Bring all eight bronze tables up to date; ``options`` as in ``load_table``."""
    for table in (*CSV_TABLES, *JSON_TABLES):
        load_table(store, base, table, checkpoints=checkpoints, **options)
