"""Measures against plain counting, estimation on made votes, no Python in the plan."""

import random
import re
from collections import Counter

import pytest

from jobtide.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "n_letters": sum(map(str.isalpha, text)),
        "n_lines": len(lines),
        "n_distinct": len(set(words)),
    }


def texts():
    rng = random.Random(2)
    made = [
        rng.choice([" ", "\n", "\t", "\x0b "]).join(rng.choice("a b é # ab% 😀 x|y".split()) for _ in range(k))
        for k in (0, 1, 2, 3, 4, 9, 40, 200)
        for _ in range(6)
    ]
    return [None, "", " \n\t ", " ", "a a a a a", "a\na\n\n\n a\na", "w " * 30_000, *made, made[-1]]


def test_measures(docs_of):
    found = {r.doc_id: r for r in q.measure(docs_of(texts())).collect()}
    for i, text in enumerate(texts()):
        expected = brute(text)
        assert {k: found[i][k] for k in expected} == expected, repr(text)[:80]
        assert found[i].row == "x"


def test_verdicts(docs_of):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    good = [" ".join(word() for _ in range(150)) for _ in range(300)]
    junk = [" ".join(word() + "$%|" for _ in range(150)) for _ in range(40)]
    copied = [" ".join([word()] * 150) for _ in range(40)]
    judged = q.judge(docs_of([*good, *junk, *copied, "short", None]))
    found = [r.kept for r in judged.orderBy("doc_id").collect()]
    assert all(found[:300]) and not any(found[300:])
    assert "vote_symbols" in judged.columns and judged.columns.count("row") == 1


def test_empty_table(docs_of):
    assert q.judge(docs_of([])).collect() == []


def made_votes(good, right_good, right_bad, n, seed):
    rng = random.Random(seed)
    found = Counter()
    for _ in range(n):
        is_good = rng.random() < good
        vote = []
        for g, b in zip(right_good, right_bad):
            right = rng.random() < (g if is_good else b)
            vote.append(0 if rng.random() < 0.2 else 1 if right == is_good else -1)
        found[tuple(vote)] += 1
    return sorted(found.items())


@pytest.mark.parametrize("start", [((0.99, 50), (0.4, 50)), ((0.8, 20), (0.9, 20)), ((0.7, 5), (0.35, 5))])
def test_planted_accuracies_are_recovered(start):
    right_good = [0.97, 0.92, 0.99, 0.88, 0.95, 0.9, 0.98]
    right_bad = [0.8, 0.6, 0.9, 0.5, 0.7, 0.85, 0.4]
    patterns = made_votes(0.8, right_good, right_bad, 30_000, 3)
    model = q.estimate(patterns, on_good=start[0], on_bad=start[1], least_right_on_good=0)
    assert model["good"] == pytest.approx(0.8, abs=0.02)
    assert model["right_good"] == pytest.approx(right_good, abs=0.02)
    assert model["right_bad"] == pytest.approx(right_bad, abs=0.04)


def test_estimation_bounds():
    patterns = made_votes(0.8, [0.9] * 5, [0.7] * 5, 5_000, 1)
    assert min(q.estimate(patterns)["right_good"]) >= q.LEAST_RIGHT_ON_GOOD
    assert q.estimate([])["good"] == pytest.approx(0.8, abs=0.1)


def test_verdicts_by_brute_force(docs_of):
    """Votes from plain measures, the whole posterior by Bayes' rule, every verdict."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    made = [" ".join(word() + rng.choice(["", "", "", "#", "$%", "9"][: rng.randint(1, 6)]) for _ in range(rng.randint(1, 200)))
            for _ in range(120)]
    made += [" ".join(rng.choice(["same", "two", "three"][: rng.randint(1, 3)]) for _ in range(90)) for _ in range(20)]
    all_texts = [*texts(), *made]

    def ratio(measure, name):
        over, _, under = name.partition(" / ")
        return measure[over] if not under else measure[over] / measure[under] if measure[under] else None

    cast = []
    for text in all_texts:
        measure, vote = brute(text), []
        for tests in q.RULES.values():
            each = []
            for name, bad_above, good_below, bad_below, good_above in tests:
                x = ratio(measure, name)
                bad = x is not None and (bad_above is not None and x > bad_above or bad_below is not None and x < bad_below)
                good = x is not None and (good_below is not None and x < good_below or good_above is not None and x > good_above)
                each.append(-1 if bad else 1 if good else 0)
            vote.append(min(each))
        cast.append((measure, tuple(vote)))
    model = q.estimate(sorted(Counter(v for _, v in cast).items()))
    rows = q.judge(docs_of(all_texts)).orderBy("doc_id").collect()
    for row, (measure, vote) in zip(rows, cast, strict=True):
        assert tuple(row[f"vote_{n}"] for n in q.RULES) == vote
        like_good, like_bad = model["good"], 1 - model["good"]
        for v, g, b in zip(vote, model["right_good"], model["right_bad"]):
            like_good *= {1: g, -1: 1 - g, 0: 1}[v]
            like_bad *= {1: 1 - b, -1: b, 0: 1}[v]
        chance = like_good / (like_good + like_bad)
        failed = measure["n_words"] < 50 or 100 * measure["n_repeat_words"] > 50 * measure["n_words"]
        assert row.posterior == pytest.approx(chance, abs=1e-9)
        assert (row.base_failed, row.kept) == (failed, not failed and chance >= 0.5)


def test_no_python_in_the_plan(docs_of):
    plan = q.measure(docs_of(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_measures_of_texts_that_begin_or_end_in_f_or_form_feed(docs_of):
    odd = ["first half", "f", "ff f ff", " \f\nf of\t", "\fword\f", "\f", "a\fb\f \x0b", "\\f x \\f", "f\nf\nf f f f"]
    found = {r.doc_id: r for r in q.measure(docs_of(odd)).collect()}
    for i, text in enumerate(odd):
        expected = brute(text)
        assert {k: found[i][k] for k in expected} == expected, repr(text)
