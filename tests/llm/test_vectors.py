"""Embedding links against all pairs."""

import numpy as np
import pytest

from loadcast.llm import vectors
from loadcast.llm.components import components


def brute(rows, cosine):
    """(vec_id, n_links, component, kept) by comparing all pairs."""
    def sound(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [vectors.unit(np.array([v]))[0] if sound(v) else None for _, v in rows]
    near = [
        [j for j, y in enumerate(unit) if j != i and x is not None and y is not None and len(x) == len(y) and x @ y >= cosine]
        for i, x in enumerate(unit)
    ]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((vec_id, len(near[i]), low, not near[i] if vec_id is None else vec_id == low))
    return sorted(out, key=str)


def run(spark, rows, cosine=0.9):
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<float>, id string, cell int")
    return sorted([tuple(r) for r in vectors.near_vectors(df, cosine).collect()], key=str)


def made(n, d, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 4, d))
    v = np.concatenate([base, base + 0.2 * rng.standard_normal(base.shape), base + 0.5 * rng.standard_normal(base.shape), base[: n // 8]])
    return [(k * 3 + 1, v[p].astype(np.float32).tolist()) for k, p in enumerate(rng.permutation(len(v)))]


@pytest.mark.parametrize("d,cell,block", [(3, 20, 4096), (16, 20, 30), (64, 10**6, 4096)])
def test_links_of_all_pairs(spark, monkeypatch, d, cell, block):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = made(240, d)
    assert run(spark, rows) == brute(rows, 0.9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [2.0, 0.0]),
        (8, [2.0, 0.0]), (None, [3.0, 0.1]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e30, 1e29]), (12, [1e-30, 0.0]),
        (None, [0.0, 1.0]), (None, None), (13, [-1.0, 0.0]), (13, [0.0, -1.0]), (14, [0.1, -1.0]),
    ]
    assert run(spark, rows) == brute(rows, 0.9)
    assert run(spark, []) == []


def test_cells_are_fewer_where_vectors_cluster():
    """Clusters far apart are not copied to each other's cells."""
    rng = np.random.default_rng(1)
    centers = vectors.unit(np.eye(8) + 0)
    u = vectors.unit(np.repeat(centers, 50, axis=0) + 0.02 * rng.standard_normal((400, 8)))
    home, inside = vectors.cells_of(u, centers, 0.98)
    assert inside.sum() == len(u) and (home == np.repeat(np.arange(8), 50)).all()


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(100, 164)]
    star = [(7, k) for k in range(1000, 1400)]
    df = spark.createDataFrame([*chain, *[(b, a) for a, b in star], (5, 5), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {**{k: 100 for k in range(100, 165)}, 7: 7, **{k: 7 for k in range(1000, 1400)}}
    assert components(df.limit(0)).count() == 0
