"""The registered queries: names, columns, SQL, and the pipeline against its parts by brute force."""

import pathlib
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from jobtide.llm import queries

from .test_decontamination import brute as contaminated
from .test_ngram_join import brute as near

COLUMNS = {
    "op1_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op2_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op3_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                          "n_repeat_words", "base_failed", "kept"],
    "op4_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op5_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op6_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op7_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_token_ids": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op10_ngram_jaccard_join": ["doc_id", "class_id", "n_links"],
}
#: Queries whose rows are not those of documents.
OTHERS = {
    "op11_embedding_near_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op12_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal",
                                 "cost", "audit", "repaired_sha256"],
    "op13_phrase_mining": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


def test_registered():
    assert {*COLUMNS, *OTHERS} == set(queries.QUERIES)
    assert {*COLUMNS, *OTHERS, "pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert set(COLUMNS[name]) <= set(df.columns)
    ids = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id"])["doc_id"].to_pylist()
    assert sorted(r.doc_id for r in df.select("doc_id").collect()) == sorted(ids)


@pytest.mark.parametrize("name", OTHERS)
def test_columns(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert df.columns[: len(OTHERS[name])] == OTHERS[name]


@pytest.mark.parametrize("name", queries.ORACLES)
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    df = queries.QUERIES[name](spark, sf_dir).select(*columns)
    assert sorted(map(tuple, df.collect())) == sorted(result.fetchall())


def test_pipeline(spark, sf_dir):
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = list(map(dict, (r.asDict() for r in docs.collect())))
        out = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs = out.cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    ids = {n: [d["doc_id"] for d in kept[n]] for n in names}

    texts = [d["text"] for d in sorted(kept[names[1]], key=lambda d: d["doc_id"])]
    order = sorted(ids[names[1]])
    _, classes = near(texts)
    assert sorted(ids[names[2]]) == sorted({order[k] for k in classes})

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()]
    clean = [d["doc_id"] for d in kept[names[2]] if not contaminated(d["text"], items)[1]]
    assert sorted(clean) == sorted(ids[names[3]]) and len(clean) < len(ids[names[2]])

    words = {d["doc_id"]: len(d["text"].split()) for d in kept[names[3]]}
    assert sum(words[i] for i in ids[names[4]]) == pytest.approx(1.5 * sum(words.values()), rel=0.1)

    plain = Tokenizer.from_file(queries.TOKENIZER)
    start, found = 0, sorted(out.collect(), key=lambda r: r.start)
    for row, doc in zip(found, sorted(kept[names[4]], key=lambda d: d["doc_id"]), strict=True):
        encoded = plain.encode(doc["text"], add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(encoded, "<u4").tobytes())
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc["doc_id"], start, len(encoded), crc)
        start += len(encoded)
    assert corpus_pipeline.run(spark, sf_dir).count() == len(found)
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()}
    good = [i for i in ids[names[0]] if labels.get(i) == 1]
    assert sum(i in set(ids[names[1]]) for i in good) >= 0.97 * len(good)


ODD = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, `a b` string, score int, row string"


def test_pipeline_odd_rows(spark, table, sf_dir):
    long = " ".join(f"word{i}" for i in range(60_000))
    rest = ("en", "s", 1, 2, "x", 3, "y")
    rows = [(1, None, *rest), (2, "", *rest), (None, "some words to keep here", *rest), (4, long, *rest)]
    rows += [(5, "twice the same row", *rest)] * 2 + [(6, "no source", None, None, None, None, None, None, None)]
    for docs in (table(rows, ODD), table([], ODD)):
        for name, stage in corpus_pipeline.STAGES:
            if name == "quality classifier":
                out = stage(spark, docs, sf_dir)
                assert out.columns == docs.columns and out.count() <= docs.count()
                continue  # whichever it keeps, the others get all
            out = stage(spark, docs, sf_dir)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            if name == "n-gram jaccard join" and docs.count():
                assert sorted((r.doc_id for r in out.collect()), key=repr) == [1, 2, 4, 5, 6, None]
            if name == "benchmark decontamination":
                assert out.count() == docs.count()
