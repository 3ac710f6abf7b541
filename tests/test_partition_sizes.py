"""Ranges of a rank follow the rows, not the number of partitions which a session happens to have."""

import random

import pytest
from pyspark.sql import functions as F

from orestrata.operators import ranks
from orestrata_checks import bindings


@pytest.mark.parametrize("range_rows", [1_000, 100])
def test_ranges_follow_the_rows(spark, monkeypatch, range_rows):
    monkeypatch.setattr(ranks, "RANGE_ROWS", range_rows, raising=False)
    keys = [(random.Random(n).randint(0, 9_000), n) for n in range(30_000)]
    df = spark.createDataFrame(keys, "k int, v int").withColumn("k", F.when(F.col("v") % 5 > 0, F.col("k")))
    found = ranks.ranked(df, ["k"], "R")
    numbers = ranks.row_numbers(df, ["k"], "N")
    sizes = [r[1] for r in spark.read.parquet(*numbers.inputFiles()).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 3 * range_rows * (2 if range_rows == 100 else 1)
    keyed = sorted((r.k is not None, r.k or 0) for r in df.collect())
    first = {key: n + 1 for n, key in reversed(list(enumerate(keyed)))}
    assert all(r.R == first[r.k is not None, r.k or 0] for r in found.collect())


def test_lines_are_numbered_as_they_are_given(spark, monkeypatch):
    """What is exchanged for the rank are the given columns, not the wider ones made of them."""
    seen = []
    numbered = bindings.NumberedSource.__call__

    def looked_at(source, session, table):
        seen.append(dict(source.source(session, table).dtypes))
        return numbered(source, session, table)

    monkeypatch.setattr(bindings.NumberedSource, "__call__", looked_at)
    lines = bindings._numbered(spark, "/root/testdata/sf0.001", "SalesOrderDetail")
    assert lines.columns == list(bindings.BINDINGS["SalesOrderDetail"].columns)
    assert not any(kind.startswith("decimal") for kind in seen[0].values()) and "l_shipdate" not in seen[0]
