"""Registered queries of the corpus operators, with their production parameters.

Each runs its operator over the whole of its table and derives the digest columns from what the
operator returns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import (
    conversation_repair,
    decontamination,
    language_id,
    mixing,
    near_vectors,
    ngram_join,
    oracles,
    phrases,
    quality_classifier,
    quality_rules,
    secrets,
    sharding,
    token_files,
    toxicity,
)
from jobtide.llm.common import documents, key_text, labelled_sample, stored
from jobtide.sources.store import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = oracles.ORACLES

SHARDS = 40
QUALITY_FROM = 0.3
TOXIC_FROM = 0.7
WORD = r"[^\x20\x09-\x0D]+"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(plan):
    QUERIES[plan.__name__] = plan
    return plan


def word_count() -> F.Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id",
        "source",
        (F.octet_length(text).cast("bigint") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.assign_shards(rows, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        documents(spark, sf_dir).select("doc_id", "text"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
        keep_text=False,
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        decontamination.items_digest(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "posterior",
    )


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = documents(spark, sf_dir).select("doc_id", "source", word_count().alias("size"))
    mixed = mixing.mix_sources(stored(sized, "sized-documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def remainder(n: int) -> F.Column:
    """CRC-32 of doc_id as text, modulo n; the folds of the classifiers."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % n


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality_classifier.Model:
    sample = labelled_sample(
        docs, labels_of(spark, sf_dir), "quality", remainder(5) != 0, quality_classifier.SAMPLE
    )
    return quality_classifier.train(*sample)


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality_model(spark, sf_dir, docs)
    return quality_classifier.with_score(docs, model).select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_FROM).cast("int").alias("predicted"),
    )


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    learned = language_id.dictionaries(docs, remainder(4) != 2)
    return language_id.identify(docs.select("doc_id", "text"), learned).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secrets.digest("base").cast("binary"), 256).alias("base_sha256"),
        secrets.digest("spans").alias("spans"),
    )


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    sample = labelled_sample(
        docs, labels_of(spark, sf_dir), "toxic", remainder(3) != 1, toxicity.SAMPLE
    )
    return toxicity.with_score(docs, toxicity.train(*sample)).select(
        "doc_id",
        (remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


@query
def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_files.read_token_files(token_files.write_token_files(docs, folder, TOKENIZER))


@query
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return ngram_join.jaccard_join(docs).withColumnRenamed("id", "doc_id")


@query
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found = near_vectors.near_vectors(rows)
    return found.links.select(
        F.col("id").alias("vec_id"),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations as op12 repairs them: a twentieth of the rows each is dropped, emptied, stripped
    of sentence ends, repeated or given to the user. NULL roles and texts are one space."""
    space = F.lit(" ")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text, role = shown("text"), shown("role")
    return (
        rows.select(
            "conv_id",
            "turn",
            F.when(fault == 4, "user").otherwise(role).alias("role"),
            F.when(fault == 1, "")
            .when(fault == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            fault.alias("fault"),
        )
        .where("fault <> 0")
        .withColumn("nth", F.explode(F.sequence(F.lit(0), (F.col("fault") == 3).cast("int"))))
        .drop("fault", "nth")
    )


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired(rows)


def repaired(rows: DataFrame, **options) -> DataFrame:
    """What op12 returns for conversations: one row per id, also of those that lost all rows."""
    found = conversation_repair.repair(damaged(rows), **options)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = hashlib.sha256(b"").hexdigest()
    return (
        rows.select("conv_id", key_text(F.col("conv_id")).alias("key"))
        .distinct()
        .join(found.report, "key", "left")
        .join(conversation_repair.digests(found.turns), "key", "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.lit(none)).alias("repaired_sha256"),
        )
    )


@query
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir).select("text", "lang"))
