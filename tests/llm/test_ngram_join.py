"""Links, classes and copies against all pairs; bands; components; blocks in many cells."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from jobtide.llm import byte_text
from jobtide.llm import ngram_join as j
from jobtide.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def gram_set(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(texts):
    sets = [gram_set(t) for t in texts]
    root, links = list(range(len(sets))), [0] * len(sets)

    def top(x):
        return x if root[x] == x else top(root[x])

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return links, [top(x) for x in range(len(sets))]


def corpus(seed=3):
    rng = random.Random(seed)
    line = lambda k: [f"w{rng.randint(0, 400)}" for _ in range(k)]
    texts = []
    for size in (3, 8, 60, 200):
        for _ in range(6):
            own = line(size)
            texts.append(" ".join(own))
            for _ in range(rng.randint(0, 5)):
                other = list(own)
                for _ in range(rng.randint(0, max(1, size // 40))):
                    other[rng.randrange(size)] = "new"
                texts.append("\n".join(other))
    texts += [texts[0], texts[-1], None, "", " \n", "one", "one", "two words"]
    shared = line(100)  # a large group of near copies
    texts += [" ".join([*shared, f"end{i}"]) for i in range(40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("chunk", "sent"), [(1_024, 32 << 20), (7, 0)])
def test_same_as_all_pairs(docs_of, chunk, sent, monkeypatch):
    monkeypatch.setattr(j, "BROADCAST_BYTES", sent)
    texts = corpus()
    found = {r.id: r for r in j.jaccard_join(docs_of(texts), chunk_rows=chunk).collect()}
    links, classes = brute(texts)
    assert [found[i].n_links for i in range(len(texts))] == links
    assert [found[i].class_id for i in range(len(texts))] == classes
    sets = [gram_set(t) for t in texts]
    first = [min(k for k, s in enumerate(sets) if s == sets[i]) if sets[i] else i for i in range(len(sets))]
    assert [found[i].copy_of for i in range(len(texts))] == first


def test_missing_and_repeated_ids(table):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (None, text), (5, text + " x"), (5, text + " x"), (6, "other words here"), (None, None)]
    found = j.jaccard_join(table(rows, "doc_id long, text string"))
    by = {}
    for r in found.collect():
        by.setdefault(r.id, []).append((r.n_links, r.class_id < 0 if r.class_id is not None else None))
    assert by[5] == [(3, True), (3, True)] and by[6] == [(0, False)]
    assert sorted(by[None], key=repr)[:2] != [] and sum(n for n, _ in by[None]) == 6



def one_row_of_each(spark, docs):
    import corpus_pipeline

    return corpus_pipeline.keep_one_of_each(spark, docs, "")


def test_pipeline_keeps_one_row_of_each_class(spark, table, docs_of):
    text = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(30))
    rows = [(None, text), (None, text), (5, text + " x"), (5, text + " x"), (5, other), (3, other + " y"),
            (5, "quite different words"), (7, "lone"), (7, "lone"), (8, "lone"), (None, "nameless"), (None, "nameless"),
            (None, None), (None, None), (9, None), (9, ""), (10, None), (10, None), (None, " ")]
    kept = one_row_of_each(spark, table(rows, "doc_id long, text string"))
    expected = [(5, text + " x"), (3, other + " y"), (5, "quite different words"), (7, "lone"), (None, "nameless"),
                (None, None), (9, None), (9, ""), (10, None), (None, " ")]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(expected, key=repr)

    texts = corpus()
    kept = one_row_of_each(spark, docs_of(texts))
    assert kept.columns == docs_of(texts).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(texts)[1]))
    assert one_row_of_each(spark, docs_of([])).collect() == []


def test_empty_table(docs_of):
    assert j.jaccard_join(docs_of([])).collect() == []


def chained(n, seed=4, step=12, size=300):
    """Windows that slide over one long text: each is linked to its next few, all are one class."""
    rng = random.Random(seed)
    words = [f"w{rng.randint(0, 3_000)}" for _ in range(n * step + size)]
    return [" ".join(words[i * step : i * step + size]) for i in range(n)]


def test_chain_is_not_one_block(docs_of, monkeypatch):
    rows = {}
    verified = j.verified

    def counted(cells, threshold):
        rows[len(rows)] = cells.count()
        return verified(cells, threshold)

    monkeypatch.setattr(j, "verified", counted)
    for n in (60, 240):
        texts = chained(n)
        found = {r.id: r for r in j.jaccard_join(docs_of(texts), chunk_rows=16).collect()}
        links, classes = brute(texts)
        assert [found[i].n_links for i in range(n)] == links and max(links) < 8
        assert [found[i].class_id for i in range(n)] == classes
    assert rows[1] < 5 * rows[0] and rows[1] < 240 * 30


def test_recall_against_all_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r.id: r for r in j.jaccard_join(docs).collect()}
    sets = {r.doc_id: gram_set(r.text) for r in docs.collect()}
    asked = [i for i in sets if i % 100 == 0 or found[i].n_links][:60]
    for i in asked:
        near = [k for k, s in sets.items() if k != i and len(s & sets[i]) * 5 >= 4 * len(s | sets[i]) > 0]
        assert found[i].n_links == len(near)
        assert all(found[k].class_id == found[i].class_id for k in near)


def test_links_are_owned_once():
    linked = np.ones((4, 4), bool)
    np.fill_diagonal(linked, False)
    owned = j._owned(linked, [[1, 5], [5], [1, 3, 5], [3, 5]], 5)
    assert not owned[0, 2] and not owned[2, 3] and owned[0, 1] and owned[0, 3] and owned[1, 2] and (owned == owned.T).all()


def test_bands():
    bands, rows = j.choose_bands(0.8, 0.999)
    assert bands * rows <= 256 and 1 - (1 - 0.8**rows) ** bands >= 0.999
    assert j.choose_bands(0.8, 0.999, 512)[1] >= rows
    with pytest.raises(ValueError):
        j.choose_bands(0.1, 0.9999, 8)


def test_long_texts_in_pieces(monkeypatch):
    texts = pa.array(corpus()[:60] + ["w " * 4_000 + "end", "x" * 5_000])
    whole = j.gram_sets(texts)
    small = byte_text.pieces.__defaults__
    monkeypatch.setattr(byte_text.pieces, "__defaults__", (700, *small[1:]))
    cut = j.gram_sets(texts)
    assert all(np.array_equal(a, b) for a, b in zip(whole[:-1], cut[:-1]))


def test_components(table):
    chain = [(i, i + 1) for i in range(60)] + [(200, 199), (200, 201), (201, 200), (7, 7), (300, 300)]
    found = {r.node: r.root for r in components(table(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {200: 199, 201: 199}
