"""Each query against its SQL counterpart, and the counts known from the seeded defects."""

from decimal import Decimal

import pytest
from conftest import MEDIUM, SMALL, rows

import __spark_entry__
from orestrata_checks import catalog, oracle
from orestrata_checks.compare import connect, differences

# Of the warehouse; queries on training data have tests of their own.
QUERIES = catalog.queries()
SQL = oracle.oracle_sql()


def test_every_query_has_a_counterpart():
    assert list(QUERIES) == list(SQL)
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert SQL.keys() <= __spark_entry__.oracle_sql().keys()


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, database, name):
    assert differences(QUERIES[name](spark, SMALL), database, SQL[name]) == []


def test_entry(spark):
    assert rows(__spark_entry__.entry(spark))


COUNTS = {
    "prof_dup_product": 20,
    "prof_dup_customer": 0,
    "prof_dup_sales_order": 0,
    "prof_nonpositive_qty": 138,
    "prof_negative_unit_price": 134,
    "prof_bad_list_price": 80,
    "prof_negative_standard_cost": 40,
    "prof_ship_before_order": 155,
    "prof_due_before_order": 149,
    "prof_missing_person_name": 200,
    "prof_missing_city_postal": 220,
    "prof_missing_color": 510,
    "prof_distinct_color": 10,
    "prof_orphan_detail_product": 163,
    "prof_orphan_header_customer": 50,
    "prof_orphan_header_territory": 48,
    "prof_orphan_product_subcategory": 10,
    "prof_orphan_subcategory_category": 1,
    "prof_orphan_address_state": 20,
    "prof_orphan_state_country": 1,
    "prof_orphan_customer_person": 33,
    "prof_orphan_customer_store": 12,
}


def test_seeded_defects_are_counted(spark):
    found = {}
    for name in COUNTS:
        row = QUERIES[name](spark, MEDIUM).first()
        found[name] = row[2]
    assert found == COUNTS


def test_seeded_rejects_and_losses(spark):
    assert QUERIES["silver_sales_order_header_rejects"](spark, MEDIUM).count() == 302
    assert QUERIES["silver_sales_order_detail_rejects"](spark, MEDIUM).count() == 400
    assert dict(rows(QUERIES["fact_join_loss"](spark, MEDIUM))) == {
        "SalesOrderHeader": 1175,
        "DimCustomer": 194,
        "DimProduct": 159,
        "DimGeography": 959,
        "DimShipMethod": 0,
    }
    assert dict(rows(QUERIES["val_gold_row_counts"](spark, MEDIUM)))["Gold FactSales Rows"] == 57120


def test_business_answers(spark):
    def answer(name):
        return rows(QUERIES[name](spark, MEDIUM))

    assert answer("bq_total_revenue") == [(Decimal("2993738657.4091"),)]
    assert answer("bq_distinct_orders") == [(14069,)]
    assert answer("bq_unique_customers") == [(1499,)]
    assert answer("bq_avg_order_value")[0][0] == pytest.approx(212789.7262, abs=1e-4)
    top = answer("bq_top5_territories")
    assert len(top) == 5 and top[0] == ("ASIA", Decimal("607212499.2980"))
    assert answer("bq_top_category") == [("SMALL", Decimal("460322270.9645"))]
