"""Surrogate keys, lookups, calendar, profiling helpers and reconciliation."""

import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orestrata import dim_date, dim_date_spanning, surrogate_key
from orestrata.operators.lookup import optional_lookup, required_lookup
from orestrata.operators.profiling import (
    RowCheck,
    distinct_count,
    distinct_values,
    is_missing,
    orphan_count,
    predicate_checks,
)
from orestrata.operators.reconcile import reconcile, sample


def ranks(df, key="k"):
    return {row[key]: row["SK"] for row in df.collect()}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(-(2**31), 2**31 - 1), min_size=1, max_size=60))
def test_surrogate_key_is_the_rank_of_an_int_key(frame, keys):
    df = frame([(key,) for key in keys], "k int")
    expected = {key: n for n, key in enumerate(sorted(keys), 1)}
    assert ranks(surrogate_key(df, "k", "SK")) == expected


def test_surrogate_key_around_range_borders(spark):
    keys = [n for n in range(-350, 351) if n % 7]
    df = spark.createDataFrame([(key,) for key in keys], "k int")
    expected = {key: n for n, key in enumerate(keys, 1)}
    for width in (1000, 100_000):
        assert ranks(surrogate_key(df, "k", "SK", width)) == expected


def test_surrogate_key_of_64_bit_keys(frame):
    random.seed(1)
    keys = sorted({random.randint(-(2**63), 2**63 - 1) for _ in range(300)} | set(range(50)))
    df = frame([(key,) for key in keys], "k bigint")
    assert ranks(surrogate_key(df, "k", "SK")) == {key: n for n, key in enumerate(keys, 1)}


def test_surrogate_key_equals_row_number_at_size(spark):
    df = spark.range(1, 300_000).select((F.col("id") * 3 + F.col("id") % 3).cast("int").alias("k"))
    numbered = surrogate_key(df, "k", "SK")
    differing = numbered.where(F.col("SK") != F.floor(F.col("k") / 3)).count()
    assert numbered.count() == 299_999 and differing == 0


def test_lookups(frame):
    child = frame([(1, 10), (2, None), (3, 99), (20, None)], "id int, fk int")
    parent = frame([(10, "x"), (20, "y"), (None, "z")], "pk int, name string")
    found = sorted(rows(optional_lookup(child, "fk", parent, "pk", spread_by="id")))
    # The child 20 has no reference: its own id must not match the parent 20.
    assert found == [(1, 10, "x"), (2, None, None), (3, 99, None), (20, None, None)]
    assert rows(required_lookup(child, "fk", parent, "pk")) == [(1, 10, "x")]


def test_default_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 5844
    first = days.orderBy("DateKey").first()
    assert tuple(first)[2:] == (2010, 1, 1, "January", 1, 6, "Friday")
    assert first.DateKey == 20100101
    assert days.agg(F.max("DateKey"), F.count_distinct("DateKey")).first()[:] == (20251231, 5844)


def test_calendar_spans_the_data(spark):
    df = spark.sql("SELECT DATE '2000-05-06' AS a, CAST(NULL AS DATE) AS b")
    assert dim_date_spanning(df, ["a", "b"]).count() == 366
    assert dim_date_spanning(df, ["a"]).count() == 366
    assert dim_date_spanning(df, ["b"]).count() == 0


def test_orphans(frame):
    child = frame([(1,), (1,), (2,), (None,)], "fk int")
    parent = frame([(2,), (2,), (None,)], "pk int")
    assert rows(orphan_count(child, "fk", parent, "pk")) == [(3,)]
    assert rows(orphan_count(child, "fk", parent, "pk", nullable=True)) == [(2,)]
    texts = frame([("ab ",), ("AB",), ("c",)], "fk string")
    codes = frame([("Ab",)], "pk string")
    assert rows(orphan_count(texts, "fk", codes, "pk", collation="ci")) == [(1,)]
    assert rows(orphan_count(texts, "fk", codes, "pk")) == [(3,)]
    assert rows(orphan_count(codes, "pk", codes, "pk")) == [(0,)]


def test_hot_references_are_counted_before_the_join(spark):
    child = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("fk"))
    parent = spark.range(100, 40_000).withColumnRenamed("id", "pk")
    # 10,000 rows share the reference 7; below 100 some 66 more are missing.
    missing = sum(1 for n in range(100) if n % 3)
    assert rows(orphan_count(child, "fk", parent, "pk")) == [(10_000 + missing,)]


def test_distinct_text(frame):
    df = frame([("Red ",), ("RED",), (" red",), (None,), ("",)], "c string")
    assert rows(distinct_count(df, "c", "T", "A"))[0][2] == 3
    assert rows(distinct_count(df, "c", "T", "A", collation="binary"))[0][2] == 4
    assert rows(distinct_count(df, "c", "T", "A", approximate=True))[0][2] == 3
    assert rows(distinct_values(df, "c")) == [(None,), ("",), (" red",), ("RED",)]


def test_single_pass_checks(frame):
    df = frame([(1, " "), (-2, None), (None, "x")], "v int, s string")
    checks = [
        RowCheck("T", "negative", F.col("v") < 0, F.col("v")),
        RowCheck("T", "missing", is_missing(["s"])),
    ]
    found = rows(predicate_checks(df, checks))
    assert [(row[1], row[2]) for row in found] == [("negative", 1), ("missing", 2)]
    assert float(found[0][3]) == -2 and found[1][3] is None


def test_reconcile_and_sample(frame):
    two, three = frame([(2,), (1,)], "k int"), frame([(3,), (2,), (1,)], "k int")
    compared = reconcile({"bronze": {"A": two, "B": two}, "silver": {"A": two, "B": three}})
    assert compared.columns == ["TableName", "BronzeRows", "SilverRows", "RowsMatch"]
    assert sorted(rows(compared)) == [("A", 2, 2, True), ("B", 2, 3, False)]
    assert rows(sample(three, "k", 2)) == [(1,), (2,)]
