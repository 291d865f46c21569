"""Links and components of vectors against all pairs."""

import numpy as np
import pytest

from jobtide.llm import near_vectors as v

DDL = "vec_id long, embedding array<float>, label int, node long"


def brute(rows):
    ok, units = [], []
    for i, (_, x) in enumerate(rows):
        if x is not None and None not in x and len(x):
            y = np.array(x, np.float32).astype(np.float64)
            if np.isfinite(y).all() and y.any():
                ok.append(i)
                units.append(y / np.linalg.norm(y))
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ok)):
        for b in range(a):
            if len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95:
                links[ok[a]] += 1
                links[ok[b]] += 1
                root[top(ok[a])] = top(ok[b])
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return sorted(((key, links[i], least.get(top(i))) for i, (key, _) in enumerate(rows)), key=repr)


def clumps(seed, sizes, dim=24, noise=0.02, alone=200):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(alone, dim))]
    for size in sizes:
        x = rng.normal(size=dim)
        parts.append(x + noise * np.linalg.norm(x) / np.sqrt(dim) * rng.normal(size=(size, dim)))
    rows = np.concatenate(parts).astype(np.float32)
    rng.shuffle(rows)
    return [(i, x.tolist()) for i, x in enumerate(rows)]


def chain(seed, n, dim=24):
    """Vectors along an arc: each is linked to its next few only, and all are connected."""
    rng = np.random.default_rng(seed)
    a, b = np.linalg.qr(rng.normal(size=(dim, 2)))[0].T
    angles = np.linspace(0, 3, n)
    return [(10_000 + i, (np.cos(t) * a + np.sin(t) * b).astype(np.float32).tolist()) for i, t in enumerate(angles)]


def found(table, rows, ddl=DDL, **how):
    result = v.near_vectors(table([(k, x, 1, 2) for k, x in rows], ddl), **how)
    return sorted((tuple(r) for r in result.links.collect()), key=repr), result.recall


def test_pairs_and_clumps(table):
    rows = clumps(1, [2, 2, 3, 5, 9, 11, 12, 40, 150], noise=0.1)
    got, recall = found(table, rows, cell=64)
    assert got == brute(rows) and recall == 1


def test_chain_of_dense_groups(table):
    rows = chain(2, 300) + clumps(3, [30], alone=50)
    got, recall = found(table, rows, neighbours=6, cell=50)
    assert got == brute(rows) and recall == 1


def test_odd_vectors(table):
    base = [float(i + 1) for i in range(8)]
    rows = [
        (1, base), (2, base), (None, base), (None, None), (4, None), (5, [0.0] * 8), (6, []),
        (7, [1.0, None] + base[:6]), (8, [float("nan")] + base[:7]), (9, [float("inf")] + base[:7]),
        (10, [2 * x for x in base]), (10, [2 * x for x in base]), (11, base[:4]), (12, [-x for x in base]),
        (13, [-0.0, 1.0]), (14, [0.0, 1.0]), (None, [3.0, -1.0]), (None, [3.0, -1.0]), (3, [3e38] * 8),
    ]
    got, _ = found(table, rows)
    assert got == brute(rows)


def test_hot_copies_and_doubles(table):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [(500, [1.0, 2.0, 3.1]), (501, [3.0, 0.0, -1.0])]
    got, _ = found(table, rows, DDL.replace("float", "double"))
    assert got == brute(rows)
    assert found(table, []) == ([], None)


@pytest.mark.parametrize("most", [None, 3])
def test_runs(most):
    import pyarrow as pa

    keys = [1, 1, 2, 2, 2, 2, 2, 3, 5, 5, 5]
    batches = [pa.record_batch({"k": pa.array(keys[a:b], pa.int64())}) for a, b in ((0, 1), (1, 4), (4, 4), (4, 9), (9, 11))]
    runs = [r.column("k").to_pylist() for r in v._runs(iter(batches), ["k"], most)]
    assert sum(runs, []) == keys and all(len(set(r)) == 1 for r in runs)
    assert [len(r) for r in runs if r] == ([2, 5, 1, 3] if most is None else [2, 3, 2, 1, 3])
