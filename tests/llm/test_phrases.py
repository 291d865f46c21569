"""Phrase counts and collocations against a plain count of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from jobtide.llm import phrases

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def counts_of(docs):
    counts = {}
    for text, lang in docs:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for words in pieces_of(text):
            own[()] += len(words)
            for size in range(1, 5):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return counts


def brute(docs, least, top=2000):
    out = []
    for lang, f in counts_of(docs).items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            cuts = [(2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and 100 * b >= 80 * a
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items()
            )
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, f[()], -score))
    return sorted(out)


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    names = ["New York", "state of the art", "é à", "of the", "Ünder ÄRA", "日本 語", "a a a"]
    docs = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 60)):
            words.append(rng.choice(names) if rng.random() < 0.5 else f"w{int(rng.expovariate(0.3))}")
            words.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\x0c\r", "! ?"]))
        docs.append(("".join(words), rng.choice(["en", "en", "de", None])))
    docs += [(None, "en"), ("", None), ("new york " * 40, "fr"), ("x" * 3000, "fr"), (" . , ", "de"), ("NEW YORK", "en")]
    return docs + docs[:15]


DDL = "text string, lang string, n long, phrase string"


def rows_of(table, docs):
    return table([(t, x, 1, "p") for t, x in docs], DDL)


def test_same_as_plain_counts(table):
    docs = corpus()
    found = phrases.collocations(rows_of(table, docs), least=5)
    expected = brute(docs, 5)
    assert sorted(map(tuple, found.collect())) == expected and len(expected) > 30
    assert [t for _, t in found.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]


@pytest.mark.parametrize(
    "how",
    [
        {"chunk_bytes": 50, "bucket_suffixes": 100},
        {"word_bytes": 0},
        {"least_heavy": 1e-9, "bucket_suffixes": 50},
        {"least_heavy": 0.05, "bucket_suffixes": 50, "chunk_bytes": 2_000},
    ],
)
def test_cut_routed_and_unpruned_alike(table, how):
    docs = corpus(2, 60)
    found = phrases.collocations(rows_of(table, docs), least=4, top=50, **how)
    assert sorted(map(tuple, found.collect())) == brute(docs, 4, 50)


def test_empty(table):
    assert phrases.collocations(rows_of(table, [])).collect() == []
    assert phrases.collocations(rows_of(table, [(None, None), ("", "en")])).collect() == []


@pytest.mark.parametrize("leading", [2, 3, 4])
@pytest.mark.parametrize("small", [1, 8, 1_024])
def test_quicksort_counts(monkeypatch, leading, small):
    monkeypatch.setattr(phrases, "SMALL", small)
    rng = np.random.default_rng(small)
    n = 3_000
    columns = [rng.integers(0, 2, n), *[np.floor(rng.exponential(1.5, n)).astype(int) for _ in range(4)]]
    for k in range(3, 5):  # a suffix may end after two words or more
        columns[k][(columns[k - 1] < 0) | (rng.random(n) < 0.2)] = -1
    weight = rng.integers(1, 4, n)
    counts = Counter()
    for i in range(n):
        for k in range(2, 5):
            if columns[k][i] >= 0:
                counts[tuple(int(c[i]) for c in columns[: k + 1])] += int(weight[i])
    expected = {p: c for p, c in counts.items() if c >= 20 or len(p) - 1 < leading}
    found = {}
    for i, k, count in phrases.frequent_phrases(columns, weight, 20, leading):
        assert found.setdefault(tuple(int(c[i]) for c in columns[: k + 1]), count) == count
    assert found == expected


def test_chunks_cover_every_suffix_once():
    text = "aa b, cc dd ee ff. " * 50 + "z" * 500 + " end of it"
    whole = [w.dictionary.take(pa.array(w.codes)).to_pylist() for w in phrases.chunks(pa.array([text, None, "x y"]))]
    cut = []
    for w in phrases.chunks(pa.array([text, None, "x y"]), limit=37):
        cut += [x for x, own in zip(w.dictionary.take(pa.array(w.codes)).to_pylist(), w.own, strict=True) if own]
    assert cut == sum(whole, [])
