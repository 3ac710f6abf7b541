import numpy as np
import pytest
from pyspark.sql import functions as F

from orestrata.llm import quality, queries


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in queries.op7_quality(spark, folder).collect()}
    assert len(rows) == 10_000
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null")
    held = labels.where(quality.held_out(F.col("doc_id"), 5)).collect()
    right = np.mean([rows[r.doc_id].kept == bool(r.quality) for r in held])
    assert right > max(0.93, np.mean([r.quality for r in held]) + 0.03)
    assert np.mean([rows[r.doc_id].kept for r in held if r.quality]) > 0.97


def test_sites_shrink_to_their_parents(spark):
    rows = [("good", "good/a", 0.95)] * 400 + [("bad", "bad/a", 0.1)] * 400 + [("bad", "bad/b", 0.9)] + [(None, None, 0.5)]
    scored = spark.createDataFrame(rows, "host string, path string, evidence double")
    sites, rate = quality.site_rates(scored)
    got = {r.path: r for r in sites.collect()}
    assert rate == pytest.approx((400 * 0.95 + 400 * 0.1 + 0.9 + 0.5 + 0.5) / 803)
    assert got["good/a"].path_rate > 0.9 and got["bad/a"].path_rate < 0.12
    assert got["bad/b"].path_rate < 0.35  # one document against its host
    assert got["bad/b"].path_rate > got["bad/a"].path_rate and got[None].host_rate is not None


def test_odd_input(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([(k, k % 3 and 1, 0) for k in range(300)] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    for docs, marks in ((odd_docs, labels), (odd_docs, labels.limit(0)), (empty_docs, labels)):
        rows = quality.score(docs, quality.fit(docs, marks), F.col("source"), F.col("lang")).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
