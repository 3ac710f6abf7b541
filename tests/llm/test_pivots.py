import numpy as np
import pytest
from pyspark.sql import functions as F

from orestrata.llm import pivots, queries


def brute(rows, is_query, k=10):
    """rows: (id, vector) of usable rows; {(query, rank): (id, score)}."""
    out = {}
    for q, v in rows:
        if is_query(q):
            near = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x in rows if i != q)[:k]
            out |= {(q, n + 1): (i, d) for n, (d, i) in enumerate(near)}
    return out


def test_recall_and_scores(spark):
    folder = "/root/testdata/sf0.1"
    data = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in pivots.usable(data).withColumnRenamed("v", "embedding").collect()]
    wanted = brute(rows, lambda i: i % 100 == 0)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in queries.op4_pivots(spark, folder).collect()}
    assert got.keys() == wanted.keys()
    true = {(q, i) for (q, _), (i, _) in wanted.items()}
    found = {(q, i) for (q, _), (i, _) in got.items()}
    assert len(true & found) / len(true) >= 0.9
    vectors = {i: np.array(v) for i, v in rows}
    for (q, _), (i, score) in got.items():
        assert score == pytest.approx(np.linalg.norm(vectors[q] - vectors[i]), rel=1e-12)
    whole = pivots.nearest(data, F.col("vec_id") % 100 == 0, share=1.0).collect()
    assert {(r.query_id, r["rank"]): r.vec_id for r in whole} == {key: i for key, (i, _) in wanted.items()}


def test_odd_vectors_ties_and_blocks(spark, monkeypatch):
    inf, nan = float("inf"), float("nan")
    rows = [(k, [1.0, float(k % 3)], 7) for k in range(40)]
    rows += [(100, None, 0), (200, [0.0, 0.0], 0), (300, [1.0, None], 0), (400, [nan, 1.0], 0), (500, [inf, 1.0], 0), (600, [1.0], 0), (None, [1.0, 1.0], 0)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    usable = [(i, v) for i, v, mark in rows if mark == 7]
    monkeypatch.setattr(pivots, "QUERY_BLOCK", 2)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in pivots.nearest(data, F.col("vec_id") % 10 == 0).collect()}
    assert got == brute(usable, lambda i: i % 10 == 0)
    few = pivots.nearest(data.where("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert [(r["rank"], r.vec_id) for r in few] == [(1, 3), (2, 1), (3, 2)]
    assert pivots.nearest(data.limit(0), F.col("vec_id") == 0).count() == 0
    assert pivots.nearest(data, F.col("vec_id") == -1).count() == 0
