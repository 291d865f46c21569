"""Wu-Manber against plain search, in one pass and in several, with odd rows and long texts."""

import random
import re

from jobtide.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items):
    words, hit, found = WORD.findall(lower(text)), set(), set()
    for item, own in items:
        pattern = WORD.findall(lower(own))
        size = min(10, len(pattern))
        windows = {tuple(pattern[i : i + size]) for i in range(len(pattern) - size + 1) if size}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def case(seed=4, n=60):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "été", "the", "x1", "Über", "of"]
    line = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    items = [(i, line(rng.choice([3, 9, 10, 25]))) for i in range(8)] + [(8, ""), (9, None)]
    texts = [line(rng.randint(0, 80)) for _ in range(n)]
    for i in range(0, n, 3):
        texts[i] += " -- " + items[i % 8][1].replace(" ", "\n* ").upper()
    return items, [*texts, None, "", "...", texts[0], "A" * 50_000]


def run(docs_of, table, items, texts, **options):
    found = d.find_contamination(docs_of(texts), table(items, "item_id long, text string"), **options)
    return {r.doc_id: r for r in found.collect()}


def test_same_as_plain_search(docs_of, table):
    items, texts = case()
    for options in ({}, {"pass_bytes": 64}):
        found = run(docs_of, table, items, texts, **options)
        assert len(found) == len(texts)
        for i, text in enumerate(texts):
            r = found[i]
            # upper-casing turned É into É, not é: only A-Z are folded
            assert (r.n_words, r.n_hit, r["items"]) == brute(text, items), text
            assert r.n_items == len(r["items"]) and r.contaminated == (r.n_hit > 0)
            assert r.text == text and r.row == "x"


def test_empty_tables(docs_of, table):
    _, texts = case(n=4)
    assert not any(r.contaminated for r in run(docs_of, table, [], texts).values())
    assert run(docs_of, table, [(1, "a b")], []) == {}


def test_item_without_id(docs_of, table):
    found = run(docs_of, table, [(None, "a b c")], ["x a b c", "a b"])
    assert found[0].contaminated and found[0].n_items == 0 and not found[1].contaminated


def test_long_texts_in_runs():
    items, texts = case()
    pairs = [(str(i), t.encode()) for i, t in items if t]
    for text in texts[:20]:
        n, flat, found = d.scan(text.encode(), d.tables(pairs), run_bytes=40)
        hits = sum(b - a for a, b in zip(flat[::2], flat[1::2]))
        assert (n, hits, sorted(found)) == brute(text, items)


def test_texts_together_or_apart():
    items, texts = case(n=80)
    built = d.tables([(str(i), t.encode()) for i, t in items if t])
    data = [(t or "").encode() for t in texts]
    for run_bytes in (60, 500, 1 << 20):
        found = d.scan_all(data, built, run_bytes)
        hits = [(n, sum(b - a for a, b in zip(flat[::2], flat[1::2])), sorted(own)) for n, flat, own in found]
        assert hits == [brute(t, items) for t in texts]
    assert d.scan_all([], built) == [] and d.scan_all([b"a b"], d.tables([])) == [(2, [], set())]


def test_odd_column_names(table):
    rows = [(1, "x a b c y", 2, 3, 4), (2, None, 2, 3, 4)]
    docs = table(rows, "doc_id long, text string, `a.b` int, `a b` int, `a-b` int")
    for options in ({}, {"pass_bytes": 1}):
        found = d.find_contamination(docs, table([(1, "a b c"), (2, "b c y")], "item_id long, text string"), **options)
        by = {r.doc_id: r for r in found.collect()}
        assert found.columns[:5] == ["doc_id", "a.b", "a b", "a-b", "text"]
        assert (by[1].n_hit, by[1]["items"], by[2].contaminated) == (4, ["1", "2"], False)


def test_large_benchmark_is_compact():
    import tracemalloc

    rng = random.Random(1)
    words = [f"word{i}" for i in range(30_000)]
    pairs = [(str(i), " ".join(rng.choices(words, k=200)).encode()) for i in range(1_500)]
    tracemalloc.start()
    built = d.tables(pairs * 2)
    used, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    size = 2 * sum(len(t) for _, t in pairs)
    assert used < 20 * size  # 16 MiB of benchmark take less than 350 MB
    text = b"other words " + pairs[7][1][:400] + b" and more"
    n, hits, found = d.scan(text, built)
    assert found == {"7"} and 0 < hits[1] - hits[0] < n
