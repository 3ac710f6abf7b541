"""Loads that replace tables all at once or not at all, and store, reject and count in one pass."""

import os

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from orestrata import CatalogLayers, ConstraintViolation, PathLayers
from orestrata.fixed_values import SILVER, TABLES
from orestrata.operators.conform import conform, violations
from orestrata.operators.expectations import FAIL, KEPT, PART, QUARANTINE, REJECTED, WARN
from orestrata.plans import warehouse
from orestrata.plans.warehouse import REJECTS, build_silver
from orestrata.sources.shared import lasting, new_folder, scratch, settle, shared_folder
from orestrata_checks import catalog
from orestrata_checks.contracts import BOUND


@pytest.fixture
def jobs(spark):
    """Runs a step and counts the jobs it started."""
    context = spark.sparkContext

    def count(step):
        group = os.urandom(4).hex()
        context.setJobGroup(group, "counted")
        try:
            result = step()
        finally:
            context._jsc.clearJobGroup()
        return result, len(context.statusTracker().getJobIdsForGroup(group))

    return count


def loads(folder):
    return sorted(name for name in os.listdir(folder) if name.startswith("load-"))


def test_a_commit_puts_all_staged_tables_in_place_at_once(spark, tmp_path):
    layers = PathLayers(spark, str(tmp_path))
    old = {name: layers.write(spark.range(n), "silver", name) for n, name in ((1, "A"), (2, "B"))}
    staged = [layers.stage(spark.range(10 * n), "silver", name) for n, name in ((1, "A"), (2, "B"))]
    reader = PathLayers(spark, str(tmp_path))
    assert {name: reader.read("silver", name).count() for name in old} == {"A": 1, "B": 2}
    log = [name for name in os.listdir(tmp_path / "silver" / "_log") if name.endswith(".parquet")]
    found = layers.commit(staged)
    assert {name: df.count() for name, df in found.items()} == {"A": 10, "B": 20}
    after = [name for name in os.listdir(tmp_path / "silver" / "_log") if name.endswith(".parquet")]
    assert len(after) == len(log) + 1
    # who has looked already stays with what was there, until they look again
    assert {name: reader.read("silver", name).count() for name in old} == {"A": 1, "B": 2}
    reader.refresh()
    assert {name: reader.read("silver", name).count() for name in old} == {"A": 10, "B": 20}


def test_only_the_last_two_loads_of_a_table_stay(spark, tmp_path):
    layers = PathLayers(spark, str(tmp_path))
    for n in range(4):
        layers.write(spark.range(n), "gold", "T")
    assert len(loads(tmp_path / "gold" / "T")) == 2
    assert layers.read("gold", "T").count() == 3
    with pytest.raises(LookupError, match="no table U"):
        layers.read("gold", "U")


def test_a_load_cut_off_midway_leaves_all_old_tables(spark, bronze, tmp_path, monkeypatch):
    layers = PathLayers(spark, str(tmp_path))
    silver, _ = build_silver(bronze, layers, QUARANTINE, BOUND)
    before = {table: sorted(map(str, rows(df))) for table, df in silver.items()}

    class Cut(PathLayers):
        def stage(self, df, layer, table, partition_by=()):
            if table == "Address":
                raise KeyboardInterrupt("killed")
            return super().stage(df, layer, table, partition_by)

    with pytest.raises(KeyboardInterrupt):
        build_silver(bronze, Cut(spark, str(tmp_path)), WARN, BOUND)
    again = PathLayers(spark, str(tmp_path))
    assert {table: sorted(map(str, rows(again.read(SILVER, table)))) for table in TABLES} == before
    # a violation under ``fail`` leaves them as they are, too
    with pytest.raises(ConstraintViolation, match="SalesOrderHeader violates CK_.*; SalesOrderDetail|SalesOrderDetail violates"):
        build_silver(bronze, layers, FAIL, BOUND)
    again.refresh()
    assert again.read(SILVER, "Address").count() == len(before["Address"])
    assert len(loads(tmp_path / SILVER / "SalesOrderHeader")) <= 3


def test_a_catalog_is_repaired_from_the_log(spark, tmp_path, monkeypatch):
    layers = CatalogLayers(spark, str(tmp_path), prefix="mend_")
    layers.create()
    layers.write(spark.range(2), "gold", "T")

    def cut(self, staged):
        raise KeyboardInterrupt("killed")

    with monkeypatch.context() as patched:
        patched.setattr(CatalogLayers, "_point", cut)
        with pytest.raises(KeyboardInterrupt):
            layers.write(spark.range(5), "gold", "T")
    assert spark.table("mend_gold.T").count() == 2
    mended = CatalogLayers(spark, str(tmp_path), prefix="mend_")
    assert mended.recover() == ["mend_gold.T"] and mended.recover() == []
    assert spark.table("mend_gold.T").count() == 5
    parted = mended.write(spark.range(4).selectExpr("id", "id % 2 AS p"), "gold", "T", ["p"])
    assert parted.where("p = 1").count() == 2 and spark.table("mend_gold.T").count() == 4


@pytest.mark.parametrize("policy", [QUARANTINE, WARN])
def test_one_pass_stores_rejects_and_counts(spark, bronze, tmp_path, jobs, policy):
    raw = settle(bronze["SalesOrderHeader"])
    each = conform(raw, BOUND["SalesOrderHeader"], policy)
    layers = PathLayers(spark, str(tmp_path))

    def store():
        df, seen = each.laid_out()
        return layers.stage(df, SILVER, "T", [PART]), each.counted(seen), seen.get

    (staged, counts, seen), started = jobs(store)
    assert started == 1
    assert sorted(counts) == sorted(rows(each.report)) and sum(n for *_, n in counts) > 0
    stored = staged.read(spark)
    assert "Sort " not in each.laid_out()[0]._jdf.queryExecution().executedPlan().toString()
    parts = {part: stored.where(F.col(PART) == part).drop(PART) for part in (KEPT, REJECTED)}
    assert {part: df.count() for part, df in parts.items()} == {part: seen[part] for part in parts}
    assert sorted(map(str, rows(parts[KEPT].select(*each.columns)))) == sorted(map(str, rows(each.good)))
    assert sorted(map(str, rows(parts[REJECTED]))) == sorted(map(str, rows(each.rejects)))


def test_tables_without_rejects_or_rows_can_be_read(spark, bronze, tmp_path):
    layers = PathLayers(spark, str(tmp_path))
    empty = {table: bronze[table].limit(0 if table == "Store" else 10**9) for table in TABLES}
    silver, _ = build_silver(empty, layers, QUARANTINE, BOUND)
    assert silver["Store"].count() == 0 and silver["Store"].columns == BOUND["Store"].columns
    for table in TABLES:
        assert layers.read(SILVER, f"{table}{REJECTS}").columns[-2:] == ["UnfitValues", "FailedConstraints"]


def test_a_build_leaves_nothing_behind(spark, bronze, tmp_path):
    bronze["SalesOrderDetail"]  # stored for the session
    settle(spark.range(1))
    shared = shared_folder(spark).removeprefix("file:") + "/orestrata"
    before = sorted(os.listdir(shared))
    warehouse.build_warehouse(spark, bronze.source, PathLayers(spark, str(tmp_path)), QUARANTINE, contracts=BOUND)
    assert sorted(os.listdir(shared)) == before
    with scratch(spark):
        within = new_folder(spark).removeprefix("file:")
        assert settle(spark.range(3)).count() == 3
        with lasting():
            kept = settle(spark.range(4))
    assert not os.path.exists(os.path.dirname(within))
    assert kept.count() == 4


def test_constraints_of_rows_need_no_job_on_keys(spark, bronze, jobs):
    for table, constraint in (("SalesOrderDetail", "CK_SalesOrderDetail_OrderQty"), ("Product", "NN_"), ("Product", "FIT_")):
        raw = bronze[table]
        report, started = jobs(lambda: violations(raw, BOUND[table], constraint))
        assert started == 0
        assert sorted(rows(report)) == sorted(rows(conform(raw, BOUND[table], QUARANTINE).only(constraint).report))


def test_copies_of_a_violating_row_count_once(frame):
    from orestrata.functions.stored_types import INT
    from orestrata.operators.conform import Check, Contract, Field

    contract = Contract("T", "k", (Field("k", INT), Field("v", INT)), checks=(Check("CK_v", lambda: F.col("v") > 0),))
    raw = frame([(1, -1), (1, -1), (2, -1), (3, 1), (None, 0), (None, 0)], "k int, v int")
    assert rows(violations(raw, contract, "CK_")) == [("T", "CK_v", 3)]
    assert rows(violations(raw, contract, "PK_")) == [("T", "PK_T", 1)]


def test_profile_report_scans_each_table_once_and_joins_nothing(spark):
    plan = catalog.queries()["profile_report"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert 0 < final.count("FileScan") <= 14
    assert "Anti" not in plan and "SortMergeJoin" not in plan
