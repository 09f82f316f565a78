"""Near-duplicate vectors against all cosines, hot buckets in chunks, edges."""

import math

import numpy as np
from pyspark.sql import functions as F

from ledgerspark.llm import embed_dedup as ed


def brute(ids, vectors, threshold=0.9):
    n = len(ids)
    links, comp = [0] * n, list(ids)
    near = [[False] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            a, b = vectors[i], vectors[j]
            if i != j and a is not None and b is not None and len(a) == len(b) and len(a):
                x, y = np.array(a, float), np.array(b, float)
                if np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any():
                    near[i][j] = x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold
        links[i] = sum(near[i])
    for _ in range(n):
        comp = [min([comp[i]] + [comp[j] for j in range(n) if near[i][j]]) for i in range(n)]
    return links, comp


def cluster_vectors():
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((6, 16))
    v = [(centres[rng.integers(6)] + 0.12 * rng.standard_normal(16)).tolist() for _ in range(120)]
    return v + [v[0]] * 5 + [(np.array(v[1]) * 1e-30).tolist()]


def test_against_all_cosines(spark):
    v = cluster_vectors()
    want = brute(range(len(v)), v)
    rows = spark.createDataFrame([(i, x, "l") for i, x in enumerate(v)], "vec_id long, embedding array<double>, links string")
    for kw in ({}, {"chunk": 8, "per_bucket": 40}):
        got = {r.vec_id: r for r in ed.near_vectors(rows, recall=0.9999, **kw).collect()}
        assert [got[i].n_links for i in range(len(v))] == want[0]
        assert [got[i].component_id for i in range(len(v))] == want[1]
        assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [1.0, None], [1.0, 0.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.0, 0.0], [-1.0, 0.0], [1e300, 1e300], [3.0, 3.0]]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(v)] + [(6, [1.0, 0.0]), (None, [-2.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.near_vectors(rows).collect()), key=str)
    want = [(i, 0, i, True) for i in (0, 1, 2, 3, 4, 5, 9)] + [(6, 3, 6, True)] * 2 + [(7, 3, 6, False), (8, 3, 6, False), (10, 1, 10, True), (11, 1, 11, True), (12, 1, 11, False), (None, 1, 10, False)]
    assert got == sorted(want, key=str)
    assert ed.near_vectors(rows.limit(0)).count() == 0


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(9)
    v = [x[:n] for n in (16, 5) for x in cluster_vectors()[:60]] + [rng.standard_normal(3).tolist() for _ in range(30)]
    rows = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>").repartition(3)
    links, comp = brute(range(len(v)), v)
    for kw in ({}, {"chunk": 8, "per_bucket": 40}):
        got = {r.vec_id: r for r in ed.near_vectors(rows, recall=0.9999, **kw).collect()}
        assert [got[i].n_links for i in range(len(v))] == links
        assert [got[i].component_id for i in range(len(v))] == comp


def test_tables_reach_the_recall():
    for n in (10, 10_000, 10_000_000):
        planes, tables = ed.table_sizes(n, 0.9, 256, 0.98)
        meet = (1 - math.acos(0.9) / math.pi) ** planes
        assert 1 - (1 - meet) ** tables >= 0.98


def test_recall_on_the_table(spark, sf_small):
    d = spark.read.parquet(f"{sf_small}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.stack(d.embedding.to_list()).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    got = ed.query(spark, sf_small).orderBy("vec_id").toPandas()
    links = near.sum(axis=1) - 1
    assert (got.n_links.to_numpy() <= links).all() and got.n_links.sum() >= 0.9 * links.sum()
