import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import hamming_search as search
from tidemart.llm.common import Workspace

COLUMNS = "vec_id long, embedding array<double>, score int, slot string, `row` string, size int"


def usable(vector):
    x = None if not vector or None in vector else np.array(vector, float)
    return x if x is not None and np.isfinite(x).all() and x.any() else None


def brute(rows, k=5):
    """Sorted (query_id, rank, vec_id, cosine)."""
    vectors = [(i, r[0], usable(r[1])) for i, r in enumerate(rows) if r[0] is not None and usable(r[1]) is not None]
    out = []
    for i, ident, x in vectors:
        if ident % 50 == 0:
            x = x / np.abs(x).max()
            scored = []
            for j, other, y in vectors:
                if j != i and y.size == x.size:
                    y = y / np.abs(y).max()
                    scored.append((-(x * y).sum() / np.sqrt((x * x).sum()) / np.sqrt((y * y).sum()), other))
            out += [(ident, rank, other, -minus) for rank, (minus, other) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(spark, rows, **more):
    frame = spark.createDataFrame([(*r, 1, "s", "r", 2) for r in rows], COLUMNS).repartition(3)
    got = search.nearest(frame, Workspace(spark, "nearest"), F.col("vec_id") % 50 == 0, **more).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def same(got, want):
    return len(got) == len(want) and all(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-12 for a, b in zip(got, want, strict=True))


def made(kind, n=6_000, size=64, seed=3):
    rng = np.random.default_rng(seed)
    if kind == "even":
        return rng.standard_normal((n, size))
    if kind == "skewed":  # a third in one tight group, far from the origin's symmetry, and few strong directions
        x = rng.standard_normal((n, size)) * np.linspace(3, 0.1, size) + 0.5
        x[:n // 3] = rng.standard_normal(size) + 0.08 * rng.standard_normal((n // 3, size))
        return x
    centres = rng.standard_normal((200, size))
    return centres[rng.integers(0, 200, n)] + 0.3 * rng.standard_normal((n, size))


@pytest.mark.parametrize("kind", ["even", "skewed", "clustered"])
@pytest.mark.parametrize("size", [12, 64, 300])
def test_recall_of_a_block(kind, size):
    x = made(kind, size=size)
    units = search._scaled(x)
    units /= search._norms(units)[:, None]
    block = search.Block(search.Codes(size, units[::3]), 5, np.arange(len(x)), np.arange(len(x)), x)
    hits = 0
    for i in range(0, len(x), 100):
        cosines = units @ units[i]
        cosines[i] = -2
        hits += len({r[0] for r in block.nearest(i, x[i])} & set(np.argsort(-cosines)[:5].tolist()))
    assert hits >= 0.97 * 5 * 60, hits


def test_probing_retrieves_every_code_within_the_radius():
    x = made("clustered", 3_000)
    codes = search.Codes(64, None)
    block = search.Block(codes, 5, np.arange(3_000), np.arange(3_000), x)
    parts = codes.encode(search._scaled(x[:1]))[0]
    apart = np.bitwise_count(block.words ^ parts.view(np.uint64)).sum(axis=1)
    retrieved = set()
    for a in range(4):
        retrieved |= {int(i) for part, value in enumerate(parts.tolist()) for i in block._ring(part, value, a)}
        assert set(np.flatnonzero(apart <= search.SUBSTRINGS * (a + 1) - 1).tolist()) <= retrieved


@pytest.mark.parametrize("block_bytes", [search.BLOCK_BYTES, 20_000])
def test_search_equals_brute_force(spark, block_bytes):
    x = made("skewed", 1_500)
    x[700:760] = x[50]  # copies
    rows = [(i, x[i].tolist()) for i in range(len(x))]
    got, want = found(spark, rows, block_bytes=block_bytes), brute(rows)
    assert len(got) == len(want)
    assert len({r[:3] for r in got} & {r[:3] for r in want}) >= 0.97 * len(want)
    # Copies of a query come first, the smallest ids before others.
    assert [r[2] for r in got if r[0] == 50] == [700, 701, 702, 703, 704]


def test_cases(spark):
    one, other = [1.0, 2.0, 3.0, 4.0], [4.0, -3.0, 2.0, -1.0]
    rows = [(0, one), (50, other), (50, one), (1, one), (1, one), (None, one), (2, None), (100, []), (150, [0.0] * 4),
            (200, [1.0, None, 3.0, 4.0]), (250, [1.0, float("nan"), 3.0, 4.0]), (3, [float("inf"), 2.0, 3.0, 4.0]),
            (300, [1e200, 2e200, 3e200, 3e200]), (4, [-1.0, -2.0, -3.0, -4.0]), (350, [1.0, 2.0, 3.0]), (-50, [1e-200, 2e-200, 3e-200, 5e-200]),
            (400, [7.0]), (5, [-2.0]), (6, [3.0] * 3)]
    assert same(found(spark, rows), brute(rows))


def test_few_and_none(spark):
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0, 2.0])]) == []
    assert same(found(spark, [(50, [1.0, 2.0]), (51, [2.0, 1.0])]), [(50, 1, 51, 0.8)])
