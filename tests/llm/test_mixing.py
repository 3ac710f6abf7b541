from collections import Counter

import duckdb
import pytest

from orestrata.llm import mixing, queries


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    wanted = connection.execute(mixing.oracle()).fetchall()
    got = [tuple(r) for r in queries.op10_mixing(spark, folder).collect()]
    assert sorted(got) == sorted(wanted)


def test_counts_follow_the_weights(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "concat('t', id) as text", "if(id % 10 < 6, 'big', if(id % 10 < 9, 'mid', null)) as source")
    got = Counter(r.source for r in mixing.mixture(docs, {"big": 1, "mid": 2, None: 1}).collect())
    for source, share in (("big", 0.25), ("mid", 0.5), (None, 0.25)):
        assert got[source] == pytest.approx(20_000 * share, rel=0.04)
    assert "big" not in Counter(r.source for r in mixing.mixture(docs, {"mid": 1}).collect())


def test_large_means_are_drawn_whole(spark):
    docs = spark.createDataFrame([(k, "x", "rare" if k == 0 else "many") for k in range(3000)], "doc_id long, text string, source string")
    got = Counter(r.source for r in mixing.mixture(docs, {"rare": 1, "many": 1}).collect())
    assert got["rare"] == pytest.approx(1500, abs=200)


def test_order_is_global_and_columns_stay(spark, odd_docs, empty_docs):
    mixed = mixing.mixture(odd_docs)
    assert mixed.columns == [*odd_docs.columns, "copy", "mix_key"]
    keys = [r.mix_key for r in mixed.collect()]
    assert keys == sorted(keys)
    assert mixing.mixture(empty_docs).count() == 0


def test_no_python_on_the_executors(spark):
    plan = queries.op10_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
