"""The mix: targets, whole copies, Pareto order, unequal odds and odd rows."""

import hashlib

import pytest

from jobtide.llm.mixing import mix_sources, repeated, source_targets

DDL = "doc_id long, source string, size long, target string"


def water(sizes, share=1.5, cap=2):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= full
    return target


SIZES = {"a": 500, "b": 4000, "B": 100, None: 900, "ä": 3000, "z": 0}


def test_targets(table):
    found = source_targets(table(list(SIZES.items()), "source string, source_size long"))
    expected = water(SIZES)
    for row in found.collect():
        assert row.target == pytest.approx(expected[row.source])


def rows():
    return [
        (i, [None, "a", "b", "hot", "hot", "hot"][i % 6], (i * 37) % 90, "x") for i in range(1200)
    ]


def test_same_as_brute_force(table):
    found = {r.doc_id: r for r in mix_sources(table(rows(), DDL), seed=9).collect()}
    sizes = {}
    for _, source, size, _ in rows():
        sizes[source] = sizes.get(source, 0) + size
    targets = water(sizes)
    for source, total in sizes.items():
        whole = int(targets[source] // total)
        rest, order = targets[source] - whole * total, []
        for doc, own, size, _ in rows():
            if own == source:
                number = int(hashlib.md5(f"9:{doc}".encode()).hexdigest()[:13], 16)
                u = (number + 0.5) / 2**52
                order.append((u / (1 - u) / ((size + 1) / (size + 50)), number, size, doc))
        upto = 0
        for _, _, size, doc in sorted(order):
            before, upto = upto, upto + size
            extra = rest > 0 and (upto <= rest or before < rest and upto - rest <= rest - before)
            assert found[doc].copies == whole + extra, (source, doc)
            assert found[doc].taken == size * found[doc].copies <= 2 * size
        taken = sum(found[d].taken for d, s, _, _ in rows() if s == source)
        assert abs(taken - targets[source]) <= 45


def test_short_texts_have_lower_odds(table):
    part = [(i, "ab"[i % 2], 5 if i % 4 < 2 else 500, "") for i in range(4000)]
    mixed = mix_sources(table(part, DDL), share=1.2).where("source = 'b'").collect()
    extra = {size: [r.copies for r in mixed if r["size"] == size] for size in (5, 500)}
    assert 0.05 < sum(extra[5]) / 1000 < sum(extra[500]) / 1000 - 0.2


def test_odd_rows(table):
    odd = [(None, None, None, None)] * 3 + [(7, "a", 40, "x")] * 4 + [(8, "a", 0, None)]
    found = mix_sources(table(odd, DDL))
    assert found.columns == ["doc_id", "source", "size", "source_size", "target", "copies", "taken"]
    taken = [r for r in found.collect()]
    assert len(taken) == 8 and sum(r.taken for r in taken if r.source == "a") == 240
    assert all(r.taken == 0 for r in taken if r.source is None)
    assert mix_sources(table([], DDL)).collect() == []
    assert repeated(found, ["doc_id"]).where("doc_id = 7").count() == 6


def test_many_rows_of_one_id(table):
    part = [(5, "hot", 10, str(i % 700)) for i in range(1400)] + [(None, "hot", 10, str(i)) for i in range(600)]
    part += [(i, "b", 7, "") for i in range(100)]
    found = mix_sources(table(part, DDL.replace("target", "note"))).where("source = 'hot'").collect()
    assert {r.copies for r in found} <= {0, 1, 2} and len(found) == 2000
    assert abs(sum(r.taken for r in found) - found[0].target) <= 5
    assert sorted(r.note for r in found if r.doc_id == 5) == sorted(str(i % 700) for i in range(1400))
    nulls = [r.copies for r in found if r.doc_id is None]
    assert 0.3 < sum(nulls) / 600 / (found[0].target / 20000) < 3  # they draw apart from each other


def test_equal_rows_partly_taken(table):
    part = [(1, "a", 10, "same")] * 50 + [(1, "b", 10, "same")] * 10
    found = mix_sources(table(part, DDL.replace("target", "note"))).collect()
    for source in "ab":
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 5
        assert len({r.copies for r in own}) <= 2


def test_many_sources_share_alike(table):
    sizes = {f"host{i}": (i * 7919) % 501 for i in range(2000)} | {None: 5}
    found = source_targets(table(list(sizes.items()), "source string, source_size long"))
    expected = water(sizes)
    assert {r.source: pytest.approx(r.target) for r in found.collect()} == expected
