"""Keys beyond 32 bits and orders of any length lose nothing."""

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orestrata import PathLayers, surrogate_key
from orestrata.fixed_values import TABLES
from orestrata.operators.lookup import optional_lookup
from orestrata.plans.contracts import CONTRACTS, wide_keys
from orestrata.plans.silver import silver_tables
from orestrata.plans.warehouse import build_gold, build_silver
from orestrata_checks.bindings import GIVEN, bound_table
from orestrata_checks.contracts import BOUND

BEYOND = 3_000_000_000
KEYS = ("SalesOrderID", "CustomerID", "ShipToAddressID", "BillToAddressID", "CreditCardID", "AddressID")


@pytest.fixture(scope="module")
def moved(spark, bronze):
    """The raw tables, and the same with the keys of orders, customers, addresses and cards moved."""
    tables = {table: bronze[table] for table in TABLES}
    changed = {}
    for table, df in tables.items():
        own = [key for key in KEYS if key in df.columns]
        changed[table] = df.withColumns({key: F.col(key) + BEYOND * 1009 for key in own})
    return tables, changed


@pytest.mark.parametrize("policy", ["quarantine", "warn"])
def test_moved_keys_give_the_same_counts(spark, moved, policy, tmp_path):
    counts = []
    for name, tables in zip("ab", moved, strict=True):
        layers = PathLayers(spark, str(tmp_path / name))
        silver, violations = build_silver(tables, layers, policy, BOUND)
        gold = build_gold(silver, layers)
        found = {table: df.count() for table, df in {**silver, **gold}.items()}
        counts.append((found, sorted(rows(violations))))
    assert counts[0] == counts[1]
    assert counts[0][0]["FactSales"] > 5000


def test_long_order_beyond_32_bits_keeps_its_lines(spark, tmp_path):
    """One order of 10,000 lines whose key no 32-bit integer holds, next to the given ones."""
    given = "/root/testdata/sf0.001"
    for name in GIVEN:
        df = spark.read.parquet(f"{given}/{name}.parquet")
        if name == "lineitem":
            one = df.orderBy("l_orderkey", "l_linenumber", "l_partkey").limit(1).drop("l_linenumber")
            lines = one.withColumn("l_linenumber", F.explode(F.sequence(F.lit(1), F.lit(10_000))))
            # not one of the keys for which the bindings seed a bad quantity or price
            df = df.unionByName(lines.withColumn("l_orderkey", F.lit(BEYOND + 3).cast("bigint")))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    raw = bound_table(spark, str(tmp_path), "SalesOrderDetail")
    assert "Window" not in raw._jdf.queryExecution().executedPlan().toString()
    silver = silver_tables({"SalesOrderDetail": raw}, ["SalesOrderDetail"], "quarantine", BOUND)
    assert silver["SalesOrderDetail"].where(F.col("SalesOrderID") == BEYOND + 3).count() == 10_000


def test_wide_keys_leave_other_types(spark):
    wide = {field.name: field.type.label for field in wide_keys()["SalesOrderDetail"].fields}
    narrow = {field.name: field.type.label for field in CONTRACTS["SalesOrderDetail"].fields}
    assert {name for name in wide if wide[name] != narrow[name]} == {
        "SalesOrderDetailID",
        "SalesOrderID",
        "ProductID",
        "SpecialOfferID",
    }


def test_lookup_spreads_by_a_key_wider_than_the_reference(frame):
    child = frame([(BEYOND, None), (1, 2)], "id bigint, fk int")
    parent = frame([(2, "x")], "pk int, name string")
    found = rows(optional_lookup(child, "fk", parent, "pk", spread_by="id"))
    assert sorted(found) == [(1, 2, "x"), (BEYOND, None, None)]


def test_surrogate_key_refuses_a_missing_key(frame):
    df = frame([(None,), (1,)], "k int")
    with pytest.raises(PySparkException, match="without a key"):
        surrogate_key(df, "k", "SK").collect()
