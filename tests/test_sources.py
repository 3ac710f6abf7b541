"""Readers, layers, isolated loads and settled results."""

from datetime import datetime, timedelta

import pytest
from conftest import rows

from orestrata import (
    CatalogLayers,
    CatalogSource,
    FileSource,
    FrameSource,
    JdbcRanges,
    JdbcSource,
    JdbcSplit,
    PathLayers,
    UnsplitTable,
    ingest,
    load_isolated,
)
from orestrata.__main__ import arguments, source
from orestrata.fixed_values import SOURCE_SCHEMAS, TABLES
from orestrata.plans.bronze import bronze_table
from orestrata.sources.overlap import overlap
from orestrata.sources.shared import settle, settle_counting, shared_folder


@pytest.fixture
def table(frame):
    return frame([(1, "a"), (2, None)], "id int, name string")


@pytest.mark.parametrize(
    ("format", "options"),
    [
        ("parquet", {}),
        ("orc", {}),
        ("json", {}),
        ("csv", {"header": "true", "inferSchema": "true"}),
    ],
)
def test_file_source(spark, table, tmp_path, format, options):
    written = {"header": "true"} if format == "csv" else {}
    table.write.format(format).options(**written).save(f"{tmp_path}/T.dir")
    source = FileSource(str(tmp_path), format, options, suffix=".dir")
    found = ingest(spark, source, "T").select("id", "name")
    assert sorted(rows(found)) == [(1, "a"), (2, None)]


def test_ingest_columns_and_casts(spark, table):
    source = FrameSource({"T": table})
    df = ingest(spark, source, "T", columns=["id"], casts={"id": "string"})
    assert df.dtypes == [("id", "string")]
    assert ingest(spark, source, "T").schema == table.schema


def test_documents_travel_as_text(spark):
    raw = spark.sql(
        "SELECT 1 AS BusinessEntityID, 's' AS Name, 2 AS SalesPersonID, 'r' AS rowguid,"
        " DATE '2001-01-01' AS ModifiedDate, CAST('<a/>' AS BINARY) AS Demographics, 9 AS Other"
    )
    df = bronze_table(spark, FrameSource({"Store": raw}), "Store")
    assert "Other" not in df.columns and df.schema["Demographics"].dataType.typeName() == "string"
    assert df.first().Demographics == "<a/>"


def test_jdbc_options():
    source = JdbcSource(
        "jdbc:x:y",
        properties={"user": "u"},
        schemas={"SalesOrderHeader": "Sales"},
        splits={"SalesOrderHeader": JdbcSplit("SalesOrderID", "1", "1000", 16)},
    )
    assert source.options("SalesOrderHeader") == {
        "url": "jdbc:x:y",
        "dbtable": "Sales.SalesOrderHeader",
        "fetchsize": "10000",
        "user": "u",
        "partitionColumn": "SalesOrderID",
        "lowerBound": "1",
        "upperBound": "1000",
        "numPartitions": "16",
    }
    assert "partitionColumn" not in source.options("Customer")
    assert source.options("Customer")["dbtable"] == "Customer"


def test_command_line_sources():
    given = arguments(["in", "out", "--suffix", ".parquet"])
    assert source(given) == FileSource("in", "parquet", suffix=".parquet")
    line = ["jdbc:x:y", "out", "--property", "user=a=b", "--split", "SalesOrderDetail=SalesOrderDetailID,1,900,9"]
    found = source(arguments([*line, "--small", "ShipMethod", "Store"]))
    assert found.options("SalesOrderDetail") == {
        "url": "jdbc:x:y",
        "dbtable": "Sales.SalesOrderDetail",
        "fetchsize": "10000",
        "user": "a=b",
        "partitionColumn": "SalesOrderDetailID",
        "lowerBound": "1",
        "upperBound": "900",
        "numPartitions": "9",
    }
    assert found.options("ShipMethod")["dbtable"] == "Purchasing.ShipMethod" and "Store" in found.small
    assert SOURCE_SCHEMAS.keys() == set(TABLES)
    with pytest.raises(SystemExit):
        arguments([*line, "--split", "Nothing=a,1,2,3"])


def test_unsplit_tables_are_refused(spark):
    source = JdbcSource("jdbc:x:y", small=["SalesTerritory"])
    with pytest.raises(UnsplitTable, match="Customer has no split"):
        source(spark, "Customer")
    with pytest.raises(Exception, match="(?i)driver|url"):  # only now is a database looked for
        source(spark, "SalesTerritory")
    split = JdbcSource("jdbc:x:y", splits={"Customer": JdbcRanges("CustomerID", (5,))})
    with pytest.raises(Exception, match="(?i)driver|url"):
        split(spark, "Customer")


@pytest.mark.parametrize(
    "values",
    [
        [(None if n % 9 == 0 else 7 if n % 3 == 0 else n * n,) for n in range(900)],
        [(f"k'{n:04d}" if n % 3 else "hot",) for n in range(900)],
        [(datetime(2000, 1, 1) + timedelta(hours=n * n % 5000),) for n in range(900)],
    ],
)
def test_ranges_between_quantiles_hold_each_row_once(spark, values):
    df = spark.createDataFrame(values, ["k"])
    ranges = JdbcRanges.from_keys(df, "k", 8)
    predicates = ranges.predicates()
    assert 4 <= len(predicates) <= 8
    counts = [df.where(each).count() for each in predicates]
    assert sum(counts) == 900
    alone = df.where("k IS NOT NULL").groupBy("k").count().agg({"count": "max"}).first()[0]
    assert max(counts) <= alone + 3 * 900 / 8
    assert JdbcRanges.from_keys(df.limit(0), "k", 8).predicates() == ["1 = 1"]


@pytest.mark.parametrize("kind", ["catalog", "path"])
def test_layers_replace_tables(spark, table, tmp_path, kind):
    layers = (
        CatalogLayers(spark, str(tmp_path), prefix="replace_")
        if kind == "catalog"
        else PathLayers(spark, str(tmp_path))
    )
    assert len(layers.create()) == 3
    layers.create()  # again: nothing happens to what is there
    for _ in range(2):
        stored = layers.write(table, "gold", "T")
    assert sorted(rows(stored)) == [(1, "a"), (2, None)]
    other = table.selectExpr("id * 10 AS tens", "id % 2 AS part")
    replaced = layers.write(other, "gold", "T", partition_by=["part"])
    assert sorted(rows(replaced)) == [(10, 1), (20, 0)]
    if kind == "catalog":
        assert spark.sql("SELECT count(*) FROM replace_gold.T").first()[0] == 2
        assert CatalogSource("replace_gold")(spark, "T").count() == 2


def test_isolated_loads(spark, table):
    def broken():
        raise OSError("no such source")

    report = load_isolated(spark, {"A": lambda: table, "B": broken, "C": lambda: table.limit(1)})
    assert rows(report) == [
        ("A", "loaded", 2, None),
        ("B", "failed", None, "OSError: no such source"),
        ("C", "loaded", 1, None),
    ]


def test_overlap_keeps_order_and_raises():
    assert list(overlap({"b": lambda: 1, "a": lambda: 2}).items()) == [("b", 1), ("a", 2)]
    with pytest.raises(ZeroDivisionError):
        overlap({"a": lambda: 1 / 0})


def test_settle(spark, table):
    settled = settle(table)
    assert settled.schema == table.schema and sorted(rows(settled)) == sorted(rows(table))
    path = settled.inputFiles()[0]
    assert shared_folder(spark).removeprefix("file:") in path
    for condition, count in (("id > 5", 0), ("id > 1", 1)):
        settled, counted = settle_counting(table.where(condition))
        assert counted == settled.count() == count
