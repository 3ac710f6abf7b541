"""Policies, checks with NULL, keys, and the conforming of whole tables."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orestrata.functions.rules import trim
from orestrata.functions.stored_types import INT, MONEY, SMALLINT, text
from orestrata.operators.conform import Check, Contract, Field, conform
from orestrata.operators.expectations import (
    FAIL,
    QUARANTINE,
    WARN,
    ConstraintViolation,
    Expectation,
    enforce,
    repeated_keys,
    unique_rows,
)

NUMBERS = [(1, 5), (2, -5), (3, None), (4, -1)]


def positive():
    return [Expectation("positive", F.col("v") > 0), Expectation("small", F.col("v") > -3)]


def test_quarantine_splits_and_null_passes(frame):
    result = enforce(frame(NUMBERS, "k int, v int"), positive(), QUARANTINE, "T")
    assert sorted(rows(result.good)) == [(1, 5), (3, None)]
    assert sorted(rows(result.rejects)) == [(2, -5, ["positive", "small"]), (4, -1, ["positive"])]
    assert rows(result.report) == [("T", "positive", 2), ("T", "small", 1)]


def test_warn_keeps_all(frame):
    result = enforce(frame(NUMBERS, "k int, v int"), positive(), WARN, "T")
    assert result.good.count() == 4 and result.rejects.count() == 2


def test_fail_raises_and_names_the_constraints(frame):
    with pytest.raises(ConstraintViolation, match="T violates positive: 2, small: 1"):
        enforce(frame(NUMBERS, "k int, v int"), positive(), FAIL, "T")
    good = enforce(frame(NUMBERS[:1], "k int, v int"), positive(), FAIL, "T")
    assert rows(good.good) == [(1, 5)] and good.rejects.isEmpty()


def test_unknown_policy(frame):
    with pytest.raises(ValueError):
        enforce(frame(NUMBERS, "k int, v int"), positive(), "ignore")


def test_repeated_keys(frame):
    df = frame([(1,), (2,), (2,), (None,), (None,)], "k int")
    keys, count = repeated_keys(df, ["k"])
    assert rows(keys) == [(2,)] and count == 1
    assert repeated_keys(df.where("k = 1"), ["k"])[1] == 0


def test_copies_collapse_and_conflicts_are_flagged(frame):
    df = frame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (3, "d"), (3, "d")], "k int, v string")
    assert sorted(rows(unique_rows(df, ["k"], True, "ok"))) == [
        (1, "a", True),
        (2, "b", True),
        (3, "c", False),
        (3, "d", False),
    ]
    copies_only = unique_rows(df.where("k < 3"), ["k"], True, "ok")
    assert sorted(rows(copies_only)) == [(1, "a", True), (2, "b", True)]
    flagged = rows(unique_rows(df, ["k"], False, "ok"))
    assert len(flagged) == 6 and sum(ok for *_, ok in flagged) == 1


CONTRACT = Contract(
    "T",
    "k",
    (
        Field("k", INT),
        Field("name", text(4), trim),
        Field("qty", SMALLINT),
        Field("cost", MONEY, required=True),
    ),
    checks=(Check("CK_qty", lambda: F.col("qty") > 0),),
)
ONE = Decimal("1.000000")
RAW = [
    (1, " ab ", 1, ONE, "dropped"),
    (1, "ab", 1, ONE, "also"),  # a copy once cleansed
    (2, "toolong", 1, ONE, ""),
    (3, "x", 70000, ONE, ""),
    (4, "x", 0, None, ""),
    (5, "x", None, ONE, ""),
    (6, "x", 1, ONE, ""),
    (6, "x", 1, Decimal("1.000001"), ""),  # equal only once stored
    (None, "x", 1, ONE, ""),
]
SCHEMA = "k int, name string, qty int, cost decimal(38,6), extra string"


def test_conform(frame):
    raw = frame(RAW, SCHEMA)
    result = conform(raw, CONTRACT, QUARANTINE)
    assert result.good.columns == ["k", "name", "qty", "cost"]
    money = Decimal("1.0000")
    assert sorted(rows(result.good)) == [(1, "ab", 1, money), (5, "x", None, money)]
    failed = sorted((row[0] or 0, tuple(row[-1])) for row in rows(result.rejects))
    assert failed == [
        (0, ("PK_T",)),
        (2, ("FIT_T_name",)),
        (3, ("FIT_T_qty",)),
        (4, ("NN_T_cost", "CK_qty")),
        (6, ("PK_T",)),
        (6, ("PK_T",)),
    ]
    assert {name: count for _, name, count in rows(result.report) if count} == {
        "PK_T": 3,
        "FIT_T_name": 1,
        "FIT_T_qty": 1,
        "NN_T_cost": 1,
        "CK_qty": 1,
    }
    assert result.good.count() + result.rejects.count() == len(RAW) - 1


def test_conform_fails_as_a_whole(frame):
    with pytest.raises(ConstraintViolation, match="PK_T: 3"):
        conform(frame(RAW, SCHEMA), CONTRACT, FAIL)


def test_values_that_do_not_fit_are_kept_for_the_reader(frame):
    raw = frame(RAW, SCHEMA)
    for policy in (QUARANTINE, WARN):
        lost = rows(conform(raw, CONTRACT, policy).rejects.where("k = 3").select("qty", "UnfitValues"))
        assert lost == [(None, [("qty", "70000")])]
    kept = {row.k for row in conform(raw, CONTRACT, WARN).good.collect()}
    assert kept == {None, 1, 2, 4, 5, 6}  # 3 would have lost its quantity


def test_copies_without_a_key_collapse(frame):
    df = frame([(None, "a")] * 3 + [(None, "b"), (1, "a"), (2, "a"), (2, "b")], "k int, v string")
    found = rows(unique_rows(df, ["k"], True, "ok"))
    assert sorted(found, key=str) == sorted(
        [(None, "a", True), (None, "b", True), (1, "a", True), (2, "a", False), (2, "b", False)], key=str
    )
    assert len(rows(unique_rows(df, ["k"], False, "ok"))) == 7


def test_only_what_is_asked_is_read(frame):
    asked = conform(frame(RAW, SCHEMA), CONTRACT, QUARANTINE).only("NN_")
    assert rows(asked.report) == [("T", "NN_T_cost", 1)]


def test_copies_are_conflicts_where_rows_do_not_compare(frame):
    contract = Contract("T", "k", CONTRACT.fields[:2], distinct=False)
    raw = frame([(1, "a"), (1, "a"), (2, "b")], "k int, name string")
    result = conform(raw, contract, QUARANTINE)
    assert rows(result.good) == [(2, "b")] and result.rejects.count() == 2


def test_wider_key_types(frame):
    from orestrata.functions.stored_types import BIGINT

    raw = frame([(2**40, "a", 1, ONE)], "k bigint, name string, qty int, cost decimal(38,6)")
    assert conform(raw, CONTRACT, QUARANTINE).good.isEmpty()
    assert conform(raw, CONTRACT.retyped(k=BIGINT), QUARANTINE).good.first()[0] == 2**40
