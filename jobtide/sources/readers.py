"""Bronze readers: CSV as declared text columns, JSON as variant.

Large files are read by many tasks, whatever their form: CSV with one record per line, CSV with line
breaks inside quoted fields (``multiline``, the default of postings alone, whose descriptions have
them), JSON with one object or one whole array per line, and a JSON array over any lines (``array``).
Where records may span lines, files too large for one task are cut by ``records`` if they do, which
one pass over their lines tells, and by Spark itself if each is a line; smaller ones, and the JSON
layouts ``records`` and ``document``, are read by Spark directly, a file per task. A file in another
form than declared fails the load; it is never read wrongly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.schemas import CSV_TABLES, DOCUMENT, JSON_TABLES, text_schema
from jobtide.sources.records import csv_records, files_to_cut, json_elements, lines_of, worth_splitting

#: Inputs whose fields may hold line breaks.
WITH_LINE_BREAKS = ("job_postings",)


def csv_options(
    multiline: bool = False, record_separator: str | None = None, mode: str = "FAILFAST"
) -> dict[str, str]:
    """Reader options: one header line, optional double quotes, three kinds of "nothing".

    Unquoted nothing and ``\\N`` are NULL, quoted nothing is an empty text. Columns are taken by
    position; a record with too few or too many fields fails the load (``mode``).
    """
    options = {
        "header": "true",
        "enforceSchema": "true",
        "quote": '"',
        "escape": '"',
        "nullValue": "\\N",
        "mode": mode,
        "multiLine": str(multiline and record_separator is None).lower(),
    }
    if record_separator is not None:
        options["lineSep"] = record_separator
    return options


def cut_by_records(spark: SparkSession, path: str | list[str], table: str, options: dict) -> bool:
    """Whether CSV files are cut by ``records``; takes ``split`` out of ``options``.

    By default where records may span lines and a file is larger than Spark gives to one task.
    ``split`` decides otherwise: True or False for all files.
    """
    options.setdefault("multiline", table in WITH_LINE_BREAKS)
    split = options.pop("split", None)
    if not options["multiline"] or options.get("record_separator") is not None:
        return False
    return worth_splitting(spark, path) if split is None else split


def read_csv(spark: SparkSession, path: str | list[str], table: str, **options) -> DataFrame:
    """Rows of one of the CSV inputs, every column text. ``options`` as in ``csv_options``, and
    ``split`` as in ``cut_by_records``; ``multiline`` is on for ``WITH_LINE_BREAKS`` unless given."""
    schema = text_schema(CSV_TABLES[table])
    reader = spark.read.schema(schema)
    if not cut_by_records(spark, path, table, options):
        return reader.options(**csv_options(**options)).csv(path)
    lines = lines_of(spark.read, path)
    # Every field is read whichever columns are asked for, so that no malformed record passes.
    by_line = csv_options(**options | {"multiline": False}) | {"columnPruning": "false"}
    rows = reader.options(**by_line).csv(path)
    to_cut = files_to_cut(lines)
    if not to_cut:
        return rows.select(*schema.names)
    # Files are told apart as they are listed, so none is opened by both.
    cut = parsed_csv(lines.where(F.col("file").isin(to_cut)), table, **options)
    return rows.where(~F.col("_metadata.file_path").isin(to_cut)).select(*schema.names).unionByName(cut)


def parsed_csv(lines: DataFrame, table: str, **options) -> DataFrame:
    """Text lines of CSV files (``records.lines_of``) as rows, for batches and streams alike."""
    schema = ", ".join(f"`{c}` string" for c in CSV_TABLES[table])
    options = {k: v for k, v in csv_options(**options).items() if k not in ("header", "enforceSchema")}
    rows = csv_records(lines).select(F.from_csv("record", schema, options).alias("row"))
    return rows.select("row.*")


def read_json_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file, the whole document as one variant in ``data``.

    Keeps everything the file holds, but a document must fit one variant value; larger inputs
    go through ``read_json_records`` or ``read_json_lines``.
    """
    return (
        spark.read.option("multiLine", True).option("singleVariantColumn", "data").json(path)
    )


def read_json_records(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """One row per array element, declared fields as variants; Spark opens the outer array itself.

    Variants, not text: returning JSON numbers as text was measured over twenty times slower.
    """
    schema = record_schema(table)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def record_schema(table: str) -> T.StructType:
    """Declared fields of a JSON input, each a variant."""
    return T.StructType([T.StructField(c, T.VariantType()) for c in JSON_TABLES[table]])


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, as a one-element variant array; files are split over many tasks.

    Takes one object per line, bare or as a line of an array (``[``, ``]`` and the commas
    between lines are ignored).
    """
    return parsed_lines(spark.read.text(path))


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Text lines of JSON as one-element variant arrays, for batches and streams alike."""
    line = F.btrim(F.col("value"), F.lit("[], \t\r"))
    return (
        lines.select(line.alias("line"))
        .where(F.col("line") != "")
        .select(F.parse_json(F.concat(F.lit("["), F.col("line"), F.lit("]"))).alias("data"))
    )


def read_json_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per element of the array in each file, as a one-element variant array; an array over
    several lines is cut over many tasks, so neither a file nor an array must fit one value."""
    return parsed_array(lines_of(spark.read, path))


def parsed_array(lines: DataFrame) -> DataFrame:
    """Text lines of JSON arrays (``records.lines_of``) as one-element variant arrays."""
    element = F.concat(F.lit("["), F.col("record"), F.lit("]"))
    return json_elements(lines).select(F.parse_json(element).alias("data"))


JSON_LAYOUTS = {
    "array": lambda spark, path, table: read_json_array(spark, path),
    "document": lambda spark, path, table: read_json_documents(spark, path),
    "records": read_json_records,
    "lines": lambda spark, path, table: read_json_lines(spark, path),
}


def bronze_schema(table: str) -> T.StructType:
    """Declared columns of a bronze table."""
    return text_schema(CSV_TABLES[table]) if table in CSV_TABLES else DOCUMENT
