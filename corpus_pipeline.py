"""From raw documents to token files, in five stages.

Every stage works on all that the one before kept, is written as Parquet and read again. All but
the last return the columns of documents, whatever other columns these have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import decontamination, mixing, ngram_join, quality_classifier, queries, token_files
from jobtide.llm.common import documents, packed, quoted, stored
from jobtide.sources.store import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carried(docs: DataFrame, *names: str) -> DataFrame:
    """Columns a stage reads, and the whole row besides the text beside them."""
    return docs.select(*map(quoted, names), packed(docs, "text").alias("__row"))


def _documents(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(
        *[
            F.col("text") if c == "text" else F.col("__row").getField(c).alias(c)
            for c in columns
        ]
    )


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier takes for good; it learns from labelled ones among them."""
    model = queries.quality_model(spark, sf_dir, docs)
    scored = quality_classifier.with_score(_carried(docs, "text"), model)
    return _documents(scored.where(F.col("score") >= queries.QUALITY_FROM), docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id, and all others."""
    return ngram_join.keep_one_row(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_contamination(_carried(docs, "text"), benchmark)
    return _documents(found.where(~F.col("contaminated")), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    sized = _carried(docs, "doc_id", "source", "text").withColumn("size", queries.word_count())
    mixed = mixing.mix_sources(sized)
    return _documents(mixing.repeated(mixed, ["text", "__row"]), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and where each document lies in them."""
    folder = scratch_path(spark, "token-files")
    files = token_files.write_token_files(docs, folder, queries.TOKENIZER)
    return token_files.read_token_files(files)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("n-gram jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_clean),
    ("mixing sources", mix),
    ("token ids", encode),
]

#: SQL cannot express the trained classifier; tests/llm compares the run with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``: doc_id, start, n_tokens, ids_crc32."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
