"""Base spans against Python's own regular expressions, entropy against plain windows."""

import math
import random
import re
from collections import Counter

from jobtide.llm import secrets as s

KINDS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]
KEY = "q7Rz2LkX9vB4nT1wYc8P"


def base(text):
    found = [
        (m.start(), i, kind, m.end())
        for i, (kind, pattern, group, least) in enumerate(KINDS)
        for m in pattern.finditer(text or "")
        if len(m.group(group)) >= least
    ]
    return sorted(found)


def texts():
    rng = random.Random(7)
    parts = ["password", "TOKEN", "api_key", "secret", "=", ":", "'", '"', " ", "abc", "9f" * 12,
             "AKIA", "ABCDEFGH12345678", "é", "😀", "deadbeef" * 3, "\n", KEY, "x"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(150)]
    return [None, "", "secret=token:abcdefgh", "Password : 'hunter2x'", *made, made[0], "ab " * 20_000 + "token=abcdef"]


def test_base_spans(docs_of):
    found = {r.doc_id: r for r in s.find_secrets(docs_of(texts())).collect()}
    for i, text in enumerate(texts()):
        expected = base(text)
        assert [tuple(x) for x in found[i].base] == expected, repr(text)[:90]
        assert {tuple(x) for x in found[i].spans} >= set(expected)
        counts = Counter(kind for _, _, kind, _ in expected)
        assert (found[i].n_assign, found[i].n_access, found[i].n_hex) == tuple(counts[k] for k, *_ in KINDS)


def windows(value, limit, size=20):
    """(start, end) of what windows with enough entropy cover, counted afresh."""
    runs = []
    for i in range(len(value) - size + 1):
        counts = Counter(value[i : i + size])
        if -sum(c / size * math.log2(c / size) for c in counts.values()) >= limit - 1e-9:
            if runs and i <= runs[-1][1]:
                runs[-1] = (runs[-1][0], i + size)
            else:
                runs.append((i, i + size))
    return runs


def test_entropy_spans(docs_of):
    low = "a" * 12
    dashes = "-" * 60
    strings = [KEY + "Z3", low + KEY + low, "k3" * 15, "HhJ8" + KEY + KEY[::-1] + "aaaaaaaaaa1B",
               dashes.join([KEY + "Z3", KEY[::-1], "B7" + KEY]), KEY + dashes, "_" * 41 + KEY]
    found = s.find_secrets(docs_of([f"see {x} end" for x in strings])).orderBy("doc_id").collect()
    for x, row in zip(strings, found):
        got = [(r.start - 4, r.end - 4) for r in row.spans if r.name == "entropy"]
        assert got == windows(x, 3.8), x
    assert [len(r.spans) for r in found][4] == 3  # separate secrets are separate spans


def test_planted_secrets(docs_of):
    """Recall and precision among prose, paths, identifiers and numbers."""
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    words = ["internationalization", "src/main/resources/app", "snake_case_identifier_name", "2024-01-01",
             "GetElementsByClassName", "====================", "some", "prose", "999999999999999999999999"]
    texts, planted = [], []
    for _ in range(300):
        parts = rng.choices(words, k=12)
        key = "".join(rng.choices(letters, k=rng.randint(28, 44))) if rng.random() < 0.5 else None
        if key:
            parts.insert(rng.randint(0, 12), key)
        text = " ".join(parts)
        texts.append(text)
        planted.append((text.index(key), text.index(key) + len(key)) if key else None)
    rows = s.find_secrets(docs_of(texts)).orderBy("doc_id").collect()
    hits = wrong = 0
    for row, place in zip(rows, planted):
        spans = [(r.start, r.end) for r in row.spans if r.name == "entropy"]
        hits += bool(place and any(a < place[1] and place[0] < b for a, b in spans))
        wrong += sum(not place or b <= place[0] or place[1] <= a for a, b in spans)
    total = sum(p is not None for p in planted)
    assert hits >= 0.98 * total and wrong <= 0.02 * hits


def test_many_matches_in_one_text(docs_of):
    import time

    n = 20_000
    text = f"token=abcdef0 {KEY}Z3 x/token=abcdef/{KEY}/ " * n
    one = len(text) // n
    begin = time.time()
    row = s.find_secrets(docs_of([text])).first()
    assert time.time() - begin < 100  # 1.3 MB; each further match costs as much as the first
    assert row.n_assign == 2 * n and len(row.spans) == 3 * n
    first = [tuple(x) for x in row.spans[:3]]
    assert [(x.start - one * (n - 1), x.kind, x.name, x.end - one * (n - 1)) for x in row.spans[-3:]] == first
    long = "/".join(["token=abcdef", KEY] * 3_000)  # one candidate over many blocks
    row = s.find_secrets(docs_of([long])).first()
    assert row.n_assign == len(base(long)) and [tuple(x) for x in row.base] == base(long)


def test_allowed_and_known_strings(docs_of):
    fine = ["internationalization_of_words", "12345678901234567890123", "EXAMPLE" + KEY,
            "123e4567-e89b-12d3-a456-426614174000", "abcdefgh" + KEY]
    assert not any(r.spans for r in s.find_secrets(docs_of(fine)).collect())
    row = s.find_secrets(docs_of([f"token={KEY}"])).first()
    assert [r.name for r in row.spans] == ["assign"]


def test_secrets_beside_base_spans_and_placeholders(docs_of):
    long = KEY + KEY[::-1]
    inside = "9f" * 12  # a hex span
    placed = "EXAMPLE" + KEY
    cases = {  # text -> stretches of it to be read
        f"{long}/token=abcdef": [f"{long}/"],
        f"é😀 {long}_{inside}+{KEY}Z {KEY}": [f"{long}_", f"+{KEY}Z", KEY],
        f"token=abcdef. {KEY}/password=hunter2x": [f"{KEY}/"],
        f"srv/sample/{long}/dir": [f"/{long}/dir"],
        f"{KEY}=/{placed}/{long}/xxxx": [f"{KEY}=/", f"/{long}/"],
        f"a/{placed}/b/{placed}/readme": [],
        f"internationalization/token={KEY}": [],
        "A9" + "x" * 200_000 + "/token=abcdef": [],
    }
    found = s.find_secrets(docs_of(list(cases))).orderBy("doc_id").collect()
    for (text, parts), row in zip(cases.items(), found):
        expected, at = [], 0
        for part in parts:
            at = text.index(part, at)
            expected += [(at + low, at + high) for low, high in windows(part, 3.8)]
            at += len(part)
        got = [(r.start, r.end) for r in row.spans if r.name == "entropy"]
        assert got == expected, text[:90]
        assert not any(b.start < hi and lo < b.end for b in row.base for lo, hi in got)


def test_empty_and_plan(docs_of):
    assert s.find_secrets(docs_of([])).collect() == []
    plan = s.find_secrets(docs_of(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
