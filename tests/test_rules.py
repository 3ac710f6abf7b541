"""Cleansing rules and declared types on hand-made values."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.functions import rules
from orestrata.functions.keys import comparable, date_key, last_characters
from orestrata.functions.stored_types import (
    INT,
    MONEY,
    SMALLINT,
    TINYINT,
    decimal,
    fixed_text,
    text,
)


def apply(frame, kind, rule, values):
    df = frame([(n, value) for n, value in enumerate(values)], f"n int, v {kind}")
    return [row[0] for row in df.orderBy("n").select(rule(F.col("v"))).collect()]


def test_trim_strips_spaces_only(frame):
    values = ["  a b ", "\ta ", "", None]
    assert apply(frame, "string", rules.trim, values) == ["a b", "\ta", "", None]
    assert apply(frame, "string", rules.upper_trim, [" aB "]) == ["AB"]


def test_blank_to_default(frame):
    values = [None, "", "   ", " x ", "\t"]
    known = rules.blank_to_default("Unknown")
    assert apply(frame, "string", known, values) == ["Unknown", "Unknown", "Unknown", "x", "\t"]
    upper = rules.blank_to_default("Unknown", rules.upper_trim)
    assert apply(frame, "string", upper, values[:4]) == ["Unknown", "Unknown", "Unknown", "X"]


def test_negative_amounts(frame):
    values = [Decimal("-1.50"), Decimal("0.00"), Decimal("2.25"), None]
    zero = Decimal("0.00")
    assert apply(frame, "decimal(9,2)", rules.negative_to_zero, values) == [
        zero,
        zero,
        Decimal("2.25"),
        None,
    ]
    assert apply(frame, "decimal(9,2)", rules.null_or_negative_to_zero, values) == [
        zero,
        zero,
        Decimal("2.25"),
        zero,
    ]


def test_to_date(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2001-02-03 23:59:59' AS v")
    assert str(df.select(rules.to_date(F.col("v"))).first()[0]) == "2001-02-03"


def test_raw_text_compares_without_case_and_trailing_blanks(frame):
    values = ["Red ", "RED", " red", None]
    assert apply(frame, "string", comparable, values) == ["RED", "RED", " RED", None]
    binary = apply(frame, "string", lambda c: comparable(c, "binary"), values)
    assert binary == values
    with pytest.raises(ValueError):
        comparable(F.col("v"), "other")


def test_date_key_and_last_characters(frame, spark):
    df = spark.sql("SELECT explode(array(DATE '2001-02-03', NULL)) AS d")
    assert rows(df.select(date_key(F.col("d")))) == [(20010203,), (None,)]
    last = apply(frame, "string", lambda c: last_characters(c, 4), ["12345678", "123", None])
    assert last == ["5678", "123", None]


@pytest.mark.parametrize(
    ("stored", "source", "values", "expected"),
    [
        (text(3), "string", ["abc", "abcd", None], [True, False, None]),
        (fixed_text(2), "string", ["a", "abc"], [True, False]),
        (SMALLINT, "int", [32767, 32768, None], [True, False, True]),
        (TINYINT, "int", [0, 255, 256, -1], [True, True, False, False]),
        (TINYINT, "smallint", [255, 256], [True, False]),
        (INT, "bigint", [2**31 - 1, 2**31], [True, False]),
        (MONEY, "decimal(38,6)", [Decimal("1.5"), Decimal(10) ** 16], [True, False]),
        (decimal(8, 2), "decimal(12,2)", [Decimal("999999.99"), Decimal(10**6)], [True, False]),
    ],
)
def test_fits(frame, stored, source, values, expected):
    kind = T._parse_datatype_string(source)
    assert apply(frame, source, lambda c: stored.fits(c, kind), values) == expected


def test_a_type_that_always_fits_needs_no_test():
    assert INT.fits(None, T.IntegerType()) is None


def test_store(frame):
    assert apply(frame, "string", fixed_text(3).store, ["a", "abc", "abcd", None]) == [
        "a  ",
        "abc",
        "abcd",
        None,
    ]
    halves = [Decimal("0.00005"), Decimal("-0.00005"), Decimal("1.00004")]
    assert apply(frame, "decimal(38,6)", MONEY.store, halves) == [
        Decimal("0.0001"),
        Decimal("-0.0001"),
        Decimal("1.0000"),
    ]
    assert apply(frame, "int", SMALLINT.store, [40000]) == [None]
