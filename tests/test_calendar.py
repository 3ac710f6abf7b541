"""The calendar from bitmaps of days: whole years, far-off dates, coverage."""

from datetime import date, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orestrata import dim_date, dim_date_spanning
from orestrata.operators.calendar import calendar_coverage, day_bitmaps, days_of


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dates(), min_size=1, max_size=40))
def test_bitmaps_hold_the_days_and_no_other(frame, days):
    df = frame([(day, None if n % 3 else day) for n, day in enumerate(days)], "a date, b date")
    found = rows(days_of(day_bitmaps(df, ["a", "b"])))
    assert len(found) == len(set(found))
    assert set(found) == {("a", d) for d in days} | {("b", d) for n, d in enumerate(days) if n % 3 == 0}


def test_bitmaps_are_few_however_many_rows(spark):
    df = spark.range(200_000).select(F.date_add(F.lit("1990-01-01"), (F.col("id") % 9000).cast("int")).alias("a"))
    bitmaps = day_bitmaps(df, ["a"])
    assert bitmaps.count() <= 2
    assert days_of(bitmaps).count() == 9000


def test_a_far_date_does_not_stretch_the_calendar(frame):
    days = [date(1999, 5, 1), date(2001, 2, 3), date(9999, 12, 31), date(1, 1, 1), None]
    df = frame([(d, date(2000, 1, 1)) for d in days], "a date, b date")
    calendar = dim_date_spanning(df, ["a", "b"], 1900, 2100)
    found = {r.Date for r in calendar.collect()}
    years = {date(1999, 1, 1) + timedelta(n) for n in range(365 + 366 + 365)}
    assert found == years | {date(9999, 12, 31), date(1, 1, 1)} and calendar.count() == len(found)
    coverage = {r.Column: tuple(r)[1:] for r in calendar_coverage(df, ["a", "b"], calendar, 1900, 2100).collect()}
    assert coverage == {
        "a": (4, 0, 2, date(1, 1, 1), date(9999, 12, 31)),
        "b": (1, 0, 0, None, None),
    }
    missing = calendar_coverage(df, ["a"], dim_date(df.sparkSession, "2001-01-01", "2001-12-31"))
    assert rows(missing.select("Days", "DaysMissing", "Outliers")) == [(4, 3, 0)]
    assert calendar.agg(F.count_distinct("DateKey")).first()[0] == len(found)


def test_years_are_dealt_one_by_one(spark):
    df = spark.sql("SELECT DATE '1800-01-01' AS a, DATE '2200-01-01' AS b")
    calendar = dim_date_spanning(df, ["a", "b"])
    assert calendar.count() == (date(2200, 12, 31) - date(1800, 1, 1)).days + 1
    assert dim_date_spanning(df.limit(0), ["a"], 1900, 2100).count() == 0
    only_far = dim_date_spanning(df, ["a"], 1900, 2100)
    assert rows(only_far.select("DateKey", "DayName")) == [(18000101, "Wednesday")]


@pytest.mark.parametrize("first, last", [("2010-01-01", "2025-12-31")])
def test_published_range(spark, first, last):
    assert dim_date(spark, first, last).exceptAll(dim_date(spark)).isEmpty()
