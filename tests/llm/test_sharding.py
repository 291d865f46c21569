"""Shards: counts, gapless slots, the mixture, reruns and odd rows."""

from collections import Counter

from jobtide.llm.sharding import assign_shards, write_shards

DDL = "doc_id long, source string, shard string"


def rows(n=400):
    return [(i, "hot" if i % 3 else f"s{i % 7}", "old") for i in range(n)]


def check(found, n, shards):
    sizes = Counter(r.shard for r in found)
    assert len(found) == n and set(sizes) <= set(range(shards))
    assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(shards)) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(size))


def test_shards_are_even_and_mixed(table):
    found = assign_shards(table(rows(), DDL), 7).collect()
    check(found, 400, 7)
    share = Counter(r.source for r in found)
    for shard in range(7):
        own = Counter(r.source for r in found if r.shard == shard)
        # half a row of each of the seven sources, at most, shifts a cut
        assert all(abs(own[s] - share[s] / 7) <= 4 for s in share)


def test_same_as_brute_force(table):
    import hashlib

    found = {r.doc_id: (r.shard, r.slot) for r in assign_shards(table(rows(), DDL), 7, seed=3).collect()}
    by_source = {}
    for doc, source, _ in rows():
        key = int(hashlib.md5(f"3:{doc}".encode()).hexdigest()[:13], 16)
        by_source.setdefault(source, []).append((key, doc))
    line = []
    for source, own in by_source.items():
        line += [((k + 0.5) / len(own), "=" + source, doc) for k, (_, doc) in enumerate(sorted(own))]
    for at, (_, _, doc) in enumerate(sorted(line)):
        shard = at * 7 // 400
        assert found[doc] == (shard, at - -(-shard * 400 // 7))


def test_reruns_agree_on_other_partitions(table):
    first = assign_shards(table(rows(), DDL), 5)
    again = assign_shards(table(rows()[::-1], DDL).repartition(2), 5)
    assert {(r.doc_id, r.shard, r.slot) for r in first.collect()} == {
        (r.doc_id, r.shard, r.slot) for r in again.collect()
    }


def test_odd_rows(table):
    odd = [(None, None, None)] * 5 + [(1, "a", "x")] * 6 + [(1, None, "y"), (2, "a", None)]
    found = assign_shards(table(odd, DDL), 3)
    assert found.columns == ["doc_id", "source", "shard", "slot"]
    check(found.collect(), 13, 3)
    assert assign_shards(table([], DDL), 3).collect() == []
    check(assign_shards(table(rows(2), DDL), 7).collect(), 2, 7)


def test_written_shards(table, spark, tmp_path):
    write_shards(assign_shards(table(rows(), DDL), 4), str(tmp_path / "out"), 6)
    assert spark.read.parquet(str(tmp_path / "out" / "shard=2")).count() == 100
