import pytest

from orestrata.llm import jaccard
from orestrata.llm.components import components
from tests.llm import brute


@pytest.mark.parametrize("size,num,den", [(3, 90, 100), (5, 80, 100), (2, 50, 100)])
def test_equals_brute_force(odd_docs, odd_rows, size, num, den):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(odd_docs, size, num, den).collect()}
    assert got == brute.jaccard_components(odd_rows, size, num, den)


@pytest.mark.parametrize("size,num", [(3, 90), (5, 80)])
def test_small_table_equals_brute_force(spark, size, num):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, size, num, 100).collect()}
    assert got == brute.jaccard_components(rows, size, num, 100)


def test_null_ids_and_empty_table(spark, empty_docs):
    rows = [(None, "a b c d"), (7, "A b c  d"), (None, "x y z"), (8, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 3).collect()), key=str)
    assert got == sorted([(None, 2, 7), (7, 2, 7), (None, 1, None), (8, 0, 8), (None, 0, None)], key=str)
    assert jaccard.jaccard_components(empty_docs).count() == 0
    assert jaccard.drop_near_duplicates(docs).count() == 5  # rows without an id stay
    assert jaccard.drop_near_duplicates(empty_docs).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(1, 40)] + [(203, 201), (201, 202), (202, 203), (5, 5)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(51)} | {100 + k: 100 for k in range(40)} | {k: 201 for k in (201, 202, 203)}
