"""Ranks by keys of several columns and any orderable type, and sources that number their tables."""

import random
from datetime import date
from decimal import Decimal

import duckdb
import pytest
from conftest import SMALL, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orestrata import FrameSource, NumberedSource, Numbering, surrogate_key
from orestrata.functions.stored_types import BIGINT, INT, text
from orestrata.operators.conform import Contract, Field, conform
from orestrata.operators.ranks import ranked, row_numbers
from orestrata.operators.reconcile import sample
from orestrata_checks import catalog
from orestrata_checks.compare import connect


def expected_ranks(keys):
    ordered = sorted(keys)
    return {key: ordered.index(key) + 1 for key in set(keys)}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-3, 3), st.text("abé ", max_size=2)), min_size=1, max_size=80))
def test_rank_equals_the_place_of_the_first_equal_key(frame, keys):
    df = frame([(*key, n) for n, key in enumerate(keys)], "a int, b string, other int")
    found = ranked(df, ["a", "b"], "R").collect()
    wanted = expected_ranks([(a, b.encode()) for a, b in keys])
    assert {(r.a, r.b, r.other, r.R) for r in found} == {
        (a, b, n, wanted[a, b.encode()]) for n, (a, b) in enumerate(keys)
    }


def test_types_and_nulls(frame):
    schema = "d date, x double, m decimal(9,2), `odd.name` string"
    draw = random.Random(3)
    values = [
        (date(2000, 1, draw.randint(1, 3)), draw.choice([0.5, -1.0]), Decimal(draw.randint(0, 1)), draw.choice("pq"))
        for _ in range(200)
    ]
    df = frame(values, schema)
    key = ["d", "x", "m", "odd.name"]
    wanted = expected_ranks(values)
    assert {(tuple(r)[:4], r.R) for r in ranked(df, key, "R").collect()} == set(wanted.items())
    with_null = frame([(2,), (None,), (1,), (None,)], "k int")
    assert sorted(rows(ranked(with_null, ["k"], "R")), key=str) == [(1, 3), (2, 4), (None, 1), (None, 1)]
    assert ranked(frame([], "k int"), ["k"], "R").collect() == []


def test_rank_equals_sql_where_a_key_holds_a_third(spark, shuffled):
    """A hot composite key fills several ranges; its rows still share one rank."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 977).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise((F.col("id") % 13).cast("string")).alias("b"),
        "id",
    )
    found = ranked(df, ["a", "b"], "R")
    given_rows = df.toArrow()  # noqa: F841  (read by the query)
    wanted = duckdb.sql('SELECT id, rank() OVER (ORDER BY a, b) AS "R" FROM given_rows').fetchall()
    assert sorted(rows(found.select("id", "R"))) == sorted(wanted)
    numbers = row_numbers(df, ["a", "b"], "N")
    assert sorted(r.N for r in numbers.collect()) == list(range(1, 30_001))
    dealt = numbers._jdf.queryExecution().toString()
    assert "Window" not in dealt
    sizes = [r[1] for r in rows(spark.read.parquet(*numbers.inputFiles()).groupBy(F.input_file_name()).count())]
    assert max(sizes) < 3 * 30_000 / len(sizes)


def test_surrogate_key_of_several_columns_and_of_text(frame):
    pairs = [(a, b) for a in range(5) for b in "zyx"]
    numbered = surrogate_key(frame(pairs, "a int, b string"), ["a", "b"], "SK")
    assert {(r.a, r.b): r.SK for r in numbered.collect()} == expected_ranks(pairs)
    names = [("b",), ("a",), ("c",)]
    assert sorted(rows(surrogate_key(frame(names, "k string"), "k", "SK"))) == [("a", 1), ("b", 2), ("c", 3)]
    with pytest.raises(PySparkException, match="without a key"):
        surrogate_key(frame([(1, None)], "a int, b string"), ["a", "b"], "SK").collect()


def test_contract_with_a_composite_key(frame):
    contract = Contract("T", ("a", "b"), (Field("a", INT), Field("b", text(3)), Field("c", BIGINT)))
    raw = frame([(1, "x", 1), (1, "y", 1), (2, "x", 1), (2, "x", 1), (3, "x", 1), (3, "x", 2), (None, "x", 1)], "a int, b string, c bigint")
    result = conform(raw, contract, "quarantine")
    assert sorted(rows(result.good)) == [(1, "x", 1), (1, "y", 1), (2, "x", 1)]
    assert {row[0]: row[-1] for row in rows(result.rejects)} == {3: ["PK_T"], None: ["PK_T"]}
    assert rows(sample(result.good, contract.keys, 2)) == [(1, "x", 1), (1, "y", 1)]


def test_numbered_source(spark, frame):
    raw = frame([(2, "b", 9), (1, "z", 8), (2, "b", 7)], "o int, p string, v int")
    source = NumberedSource(FrameSource({"T": raw, "U": raw}), {"T": Numbering("ID", ("o", "p"), drop=("p",))})
    assert sorted(rows(source(spark, "T").select("ID", "o", "v"))) == [(1, 1, 8), (2, 2, 7), (2, 2, 9)]
    assert source(spark, "T").columns == ["o", "v", "ID"] and source(spark, "U").columns == raw.columns


def test_lines_are_numbered_and_their_key_check_can_fail(spark):
    lines = catalog.Bronze(spark, SMALL)["SalesOrderDetail"]
    assert dict(lines.dtypes)["SalesOrderDetailID"] == "bigint"
    repeated = connect(SMALL).sql(
        "SELECT count(*) FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber,"
        " CASE WHEN l_orderkey % 211 = 17 THEN 0 ELSE l_partkey END) AS n FROM lineitem) WHERE n > 1"
    ).fetchall()[0][0]
    found = catalog.queries()["expect_unique_key"](spark, SMALL).where("TableName = 'SalesOrderDetail'").first()
    assert found.Violations == repeated > 0
