import numpy as np
import pytest

from tidemart.llm import embedding_dedup as dedup
from tidemart.llm.common import Workspace

COLUMNS = "vec_id long, embedding array<double>, label int"
MORE = f"{COLUMNS}, node string, filter int, `count` int, clique string"


def brute(rows, least=dedup.LEAST_COSINE):
    usable = {}
    for at, (ident, vector, label) in enumerate(rows):
        if ident is not None and label is not None and vector and None not in vector:
            x = np.array(vector, float)
            if np.isfinite(x).all() and x.any():
                x = x / np.abs(x).max()
                usable[at] = x / np.linalg.norm(x)
    links, root = {at: set() for at in range(len(rows))}, list(range(len(rows)))
    for i, x in usable.items():
        for j, y in usable.items():
            if i < j and rows[i][2] == rows[j][2] and x.size == y.size and x @ y >= least:
                links[i].add(j)
                links[j].add(i)
                old, new = root[j], root[i]
                root = [new if r == old else r for r in root]
    ids = {}
    for at, (ident, _, _) in enumerate(rows):
        if ident is not None:
            ids[root[at]] = min(ident, ids.get(root[at], ident))
    return sorted(((ident, len(links[at]), None if ident is None else ids[root[at]],
                    ident is not None and ids[root[at]] == ident) for at, (ident, _, _) in enumerate(rows)), key=repr)


def near(rng, base, spread, n):
    return [base + spread * rng.standard_normal(base.size) for _ in range(n)]


def vectors(seed, size=64):
    rng = np.random.default_rng(seed)
    out = []
    for label in range(3):
        out += [(x, label) for x in rng.standard_normal((150, size))]
        for spread, n in [(0.02, 60), (0.15, 25), (0.25, 25)]:
            out += [(x, label) for x in near(rng, rng.standard_normal(size), spread, n)]
    out += [out[5]] * 40 + [out[200]] * 3
    order = rng.permutation(len(out))
    return [(int(i) + 100, out[o][0].tolist(), out[o][1]) for i, o in enumerate(order)]


def test_recall_at_the_threshold():
    """Pairs of exactly the least cosine share a filter nearly always, at small and large codes."""
    rng = np.random.default_rng(11)
    for classes in (300, 5_000, 500_000):
        code = dedup.ProductCode(64, dedup.directions_for(classes), dedup.filters_for(classes))
        x = rng.standard_normal((400, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.standard_normal((400, 64))
        y -= (x * y).sum(axis=1, keepdims=True) * x
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        c = dedup.LEAST_COSINE
        z = c * x + np.sqrt(1 - c * c) * y
        shared = [bool(np.intersect1d(a, b).size) for a, b in zip(code.decode(x), code.decode(z), strict=True)]
        assert np.mean(shared) >= 0.95, (classes, np.mean(shared))


@pytest.mark.parametrize("unit", [dedup.UNIT, 15])
def test_recall_and_no_false_link(spark, unit):
    rows = vectors(1)
    frame = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], MORE).repartition(3)
    got = sorted((tuple(r) for r in dedup.link_vectors(frame, Workspace(spark, "vectors"), unit=unit).collect()), key=repr)
    want = brute(rows)
    assert [r[0] for r in got] == [w[0] for w in want]
    assert all(r[1] <= w[1] and r[2] >= w[2] for r, w in zip(got, want, strict=True))
    assert sum(r[1] for r in got) >= 0.98 * sum(w[1] for w in want)
    assert sum(r[2] == w[2] for r, w in zip(got, want, strict=True)) >= 0.98 * len(want)


def test_cliques_count_exactly(spark):
    """A third of the rows in one tight group, near but distinct vectors around it: every link is counted once."""
    rng = np.random.default_rng(21)
    base = rng.standard_normal(64)
    rows = near(rng, base, 0.05, 300) + near(rng, base, 0.22, 40) + near(rng, base, 0.3, 40) + near(rng, rng.standard_normal(64), 0.1, 200)
    rows += list(rng.standard_normal((320, 64))) + [rows[3]] * 5
    rows = [(i, x.tolist(), 1) for i, x in enumerate(rows)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in dedup.link_vectors(
        spark.createDataFrame(rows, COLUMNS), Workspace(spark, "vectors"), unit=100).collect()}
    want = {r[0]: (r[1], r[2]) for r in brute(rows)}
    assert all(got[i][0] <= want[i][0] for i in want)
    # Members of a clique link with each other exactly; others miss a link now and then.
    assert [got[i] for i in range(300, 340)] and sum(got[i][0] for i in want) >= 0.99 * sum(n for n, _ in want.values())
    assert all(got[i][1] == want[i][1] for i in range(300)) and sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)


def test_lower_shared_filters():
    rng = np.random.default_rng(4)
    filters = [np.sort(rng.choice(9_000, rng.integers(1, 900), replace=False)) for _ in range(40)]
    a, b = np.triu_indices(40, 1)
    for number in (0, 500, 8_999):
        want = [bool({*filters[i][filters[i] < number]} & {*filters[j][filters[j] < number]}) for i, j in zip(a, b, strict=True)]
        assert dedup._lower_shared(filters, number, a, b).tolist() == want


def test_cases(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, one, 1), (2, [2.0, 4.0, 6.0, 8.0], 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1),
            (7, [0.0] * 4, 1), (8, [1.0, None, 3.0, 4.0], 1), (9, [1.0, float("nan"), 3.0, 4.0], 1),
            (10, [float("inf"), 2.0, 3.0, 4.0], 1), (None, one, 1), (1, one, 1), (11, [1.0, 2.0, 3.0], 1),
            (12, [1e200, 2e200, 3e200, 4e200], 1), (13, [4.0, -3.0, 2.0, -1.0], 1), (14, [7.0], 5), (15, [2.0], 5), (16, [-1.0], 5)]
    got = sorted((tuple(r) for r in dedup.link_vectors(spark.createDataFrame(rows, COLUMNS), Workspace(spark, "vectors")).collect()), key=repr)
    assert got == brute(rows)


def test_empty(spark):
    assert dedup.link_vectors(spark.createDataFrame([], COLUMNS), Workspace(spark, "vectors")).count() == 0
