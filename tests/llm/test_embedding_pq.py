"""Links and components against all cosines."""

import numpy as np
import pytest

from sievelog.llm.embedding_pq import near_vectors


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    links = {i: [] for i in range(len(good))}
    for i, (_, x) in enumerate(good):
        for j, (_, y) in enumerate(good):
            if i != j and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                links[i].append(j)
    for i, (k, _) in enumerate(good):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.setdefault(k, []).append((len(links[i]), min(good[j][0] for j in seen)))
    for k, _ in rows:
        out.setdefault(k, [(0, k)])
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_against_all_pairs(spark, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, 16))
    rows = []
    for i in range(700):
        c = centres[i % 12] if i % 3 else draw.normal(size=16)
        rows.append((i * 2 + 5, [float(x) for x in (c + draw.normal(size=16) * draw.choice([0.02, 0.2, 0.35])).astype("f4")]))
    rows += [(2000 + i, rows[7][1]) for i in range(40)] + [(3000, [2 * x for x in rows[7][1]])]
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [1.0, None] + [0.0] * 14), (6, [float("nan")] * 16), (8, [float("inf")] * 16), (5000, [1.0, 2.0]), (5001, [1.0, 2.0, 0.0]), (5002, [2.0, 4.0]), (5003, [1e30] * 16)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, list string")
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df, lists=17).collect()}
    assert len(got) == len(rows)
    assert all(want[k][0] == g[:2] and g[2] == (k == g[1]) for k, g in got.items())


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("lists", [1, 25, 60])
def test_differences_along_centres(spark, lists):
    """Vectors of few directions in 64 dimensions, beside one longer vector: near pairs differ along the lines between centres."""
    draw = np.random.default_rng(4)
    frame = np.linalg.qr(draw.normal(size=(64, 3)))[0]
    rows = [(i, [float(x) for x in frame @ draw.normal(size=3)]) for i in range(500)] + [(1000, [1.0] * 100)]
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lists=lists).collect()}
    assert all(want[k][0] == g for k, g in got.items())
