"""Repairs against a search of all edits, cuts into chunks, odd rows, hashes of the repaired texts."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from jobtide.llm import conversation_repair as c
from jobtide.llm import queries

SOLID = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")


def damage(rows):
    for conv, turn, role, text in rows:
        shown = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            row = (conv, turn, "user" if fault == 4 else role, text)
            yield from [row, row] if fault == 3 else [row]


def cheapest(rows):
    """(cost, audit, repaired lines) by Dijkstra over (row, initials so far reduced to a state)."""
    roles = {"u": "user", "a": "assistant"}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, out = heapq.heappop(heap)
        state = (i, initials if len(initials) < 2 else initials[-1:] + "+")
        if state in seen:
            continue
        seen.add(state)
        if i == len(rows) and GOOD.fullmatch(initials):
            return cost, audit, [f"{r}:{t}" for r, t in out]
        steps = []
        for x in "ua":
            steps.append((5, "I", i, x, (roles[x], "")))
        if i < len(rows):
            fault, role, text = rows[i]
            steps.append((2, "D", i + 1, "", None))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                steps.append((extra, "K", i + 1, role[:1] or "?", (role, text)))
                steps += [(1 + extra, "R", i + 1, x, (roles[x], text)) for x in "ua"]
        for paid, letter, j, x, row in steps:
            now = initials + x
            if re.fullmatch(r"|s|s?(ua)*u?", now):
                heapq.heappush(heap, (cost + paid, audit + letter, j, now, (*out, row) if row else out))


def brute(rows):
    original = {r[0] for r in rows}
    convs = defaultdict(list)
    for r in damage(rows):
        convs[r[0]].append(r)
    out = {}
    for conv in original:
        own = sorted(convs[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, _, role, text in own:
            solid = SOLID.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else None
            fault = fault or ("truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append((fault, role, text))
        n = Counter(f for f, _, _ in faults)
        illegal = sum(
            a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:])
        )
        cost, audit, lines = cheapest(faults)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest)
    return out


def corpus(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        at = 0
        for _ in range(rng.randint(1, longest)):
            role = rng.choices(["system", "user", "assistant", "tool", "", None, "usher"], [2, 9, 9, 1, 1, 1, 1])[0]
            text = rng.choices(["fine.", f"text {rng.random()}!", "cut", "", " \n", None, "ok? \t", "ünï"], [6, 6, 4, 1, 1, 1, 3, 1])[0]
            rows.append((conv if conv else None, at if rng.random() < 0.95 else None, role, text))
            at += rng.choice([0, 1, 1, 1, 2])
    return rows + rows[:7]


DDL = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("seed", "convs", "longest", "chunk"), [(1, 40, 9, 4_096), (2, 8, 60, 3), (3, 1, 300, 7), (4, 30, 6, 1)])
def test_same_as_search(table, seed, convs, longest, chunk):
    rows = corpus(seed, convs, longest)
    found = {tuple(r)[0]: tuple(r)[1:] for r in queries.repaired(table(rows, DDL), chunk_rows=chunk).collect()}
    assert found == brute(rows)


@pytest.mark.parametrize("passes", [0, 1, 3, 100])
def test_costs_that_never_converge(table, passes):
    rows = [(1, i, "user", f"never ends {i}") for i in range(60)]
    rows += [(2, i, ["user", "assistant", "tool"][i * i % 3], f"{i}." if i % 4 else "open") for i in range(30)]
    found = queries.repaired(table(rows, DDL), chunk_rows=4, passes=passes).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == brute(rows)


def test_turn_repeated_very_often(table):
    rows = [(1, 5, "user", "hello.")] * 500 + [(1, 6, "assistant", "hi.")]
    found = c.repair(table(rows, DDL), chunk_rows=2)
    report = found.report.first()
    assert (report.duplicate, report.illegal, report.cost) == (499, 499, 998)
    assert report.audit == "K" + "D" * 499 + "K"
    assert [(t.role, t.text) for t in found.turns.orderBy("place", "nth").collect()] == [
        ("user", "hello."), ("assistant", "hi.")
    ]


def test_empty_and_clashing_columns(spark, table):
    assert queries.repaired(table([], DDL)).collect() == []
    rows = [(7, 0, "user", "a" * 300_000 + ".", 1, 2, "x"), (7, 1, "assistant", "b.", 1, 2, "x")]
    found = c.repair(table(rows, DDL + ", key int, place int, `a.b` string"))
    assert found.report.first().audit == "KK"
    assert sorted(len(t.text) for t in found.turns.collect()) == [2, 300_001]


def test_steps_keep_differences():
    for kind in range(4):
        for status in range(3):
            for after in [(0, 0, 0, 0), c.END, (3, 9, 0, 2)]:
                lifted = tuple(x + 11 for x in after)
                low, high = c.step(after, kind, status), c.step(lifted, kind, status)
                assert low[0] == high[0] and high[1] == low[1] + 11
