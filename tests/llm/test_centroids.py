"""Nearest centroids and rounds against plain arithmetic on Python's whole numbers."""

import hashlib
from math import floor

import numpy as np
import pytest

from sievelog.llm.centroids import cluster_vectors, limbs, nearest


def plain(rows, k=16, rounds=3, dims=64):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    whole = lambda x: int(x) * 64 if abs(x) >= 2.0**53 else floor(x * 64)
    kept = [(i, [whole(x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    cents = [g for _, _, g in sorted((i is None, sha(f"1:{i}"), g) for i, g in kept)[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((apart(g, c), n) for n, c in enumerate(cents)) for _, g in kept]
    for _ in range(rounds):
        where = assign()
        for n in range(len(cents)):
            mine = [g for (_, g), (_, c) in zip(kept, where) if c == n]
            if mine:
                cents[n] = [sum(col) // len(mine) for col in zip(*mine)]
    where = assign()
    inertia = [sum(d for d, c in where if c == n) for n in range(len(cents))]
    return sorted((-1 if i is None else i, c, d, inertia[c], sum(inertia), sha(",".join(map(str, cents[c])))) for (i, _), (d, c) in zip(kept, where))


def clustered(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS cluster", "2L AS distance", "'x' AS id", "0 AS vector")
    return sorted(tuple(-1 if x is None else x for x in r) for r in cluster_vectors(df).collect())


def test_rounds(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=64) + i % 5)]) for i in range(700)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (701, None), (702, [1.0] * 63), (703, [1.0] * 65), (704, [None] + [1.0] * 63), (705, [float("nan")] + [1.0] * 63), (706, [float("-inf")] + [1.0] * 63), (707, [])]
    got = clustered(spark, rows)
    assert got == plain(rows) and len(got) == 703


def test_ties_and_few_vectors(spark):
    """Equal centroids: the smaller number wins, the others stay where they are; fewer vectors than centroids."""
    same = [(i, [0.5] * 64) for i in range(40)] + [(50, [0.25] * 64), (51, [-0.26] * 64)]
    assert clustered(spark, same) == plain(same)
    few = [(i, [i / 8] * 64) for i in range(5)]
    assert clustered(spark, few) == plain(few)
    assert clustered(spark, [(1, [1.0])]) == []


def test_large_components(spark):
    """Components beyond 64-bit squares are exact; distances beyond a long are null."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(rng.integers(-200_000_000, 200_000_000)) / 64, *(float(x) for x in rng.normal(size=63))]) for i in range(36)]
    assert clustered(spark, rows, "double") == plain(rows)
    huge = [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)]
    assert [r[:2] for r in clustered(spark, huge, "double")] == [r[:2] for r in plain(huge)]
    far = [(i, [(-1.0) ** i * 1e300] * 64) for i in range(40)]
    assert all(r[2:5] == (0, 0, 0) or r[2] == -1 for r in clustered(spark, far, "double"))


def test_the_walk_finds_the_nearest():
    rng = np.random.default_rng(3)
    for dims, k, width in ((1, 16, 4), (2, 5, 3), (3, 16, 50), (64, 16, 100), (7, 1, 9), (4, 16, 2)):
        x, c = rng.integers(-width, width + 1, (500, dims)), rng.integers(-width, width + 1, (k, dims))
        all_distances = ((x[:, None] - c[None]) ** 2).sum(2)
        who, best = nearest(x, c.tolist())
        assert (who == all_distances.argmin(1)).all() and (best == all_distances.min(1)).all()


def test_limbs():
    for total in (0, 5, -5, 2**90 - 1, 2**90, -(2**90), 3**300, -(3**300)):
        assert sum(part << (90 * place) for place, part in limbs(total)) == total


def test_key_named_like_a_result(spark):
    with pytest.raises(ValueError):
        cluster_vectors(spark.createDataFrame([(1, [1.0])], "cluster long, embedding array<float>"), key="cluster")
