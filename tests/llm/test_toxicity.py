import numpy as np

from orestrata.llm import queries, toxicity


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op1_toxicity(spark, "/root/testdata/sf0.1").collect()}
    assert len(rows) == 10_000
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic is not null").collect()
    held = [(rows[r.doc_id].predicted, r.toxic) for r in labels if rows[r.doc_id].held_out]
    assert np.mean([p == t for p, t in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())
    # As probabilities: the squared error is far below that of the base rate.
    scored = np.array([(rows[r.doc_id].score, r.toxic) for r in labels if rows[r.doc_id].held_out])
    assert ((scored[:, 0] - scored[:, 1]) ** 2).mean() < 0.3 * scored[:, 1].var()


def test_neighbours_are_exact(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    index = toxicity.fit(docs, labels)
    assert len(index.vectors) > 3 * toxicity.BLOCK
    draw = np.random.default_rng(1)
    for _ in range(200):
        at = draw.choice(len(index.terms), size=draw.integers(1, 6), replace=False)
        query = index.vector(at, draw.integers(1, 4, len(at)))
        places, cosines = index.nearest(query)
        every = index.vectors @ query
        best = np.lexsort((np.arange(len(every)), -every))[: toxicity.NEIGHBOURS]
        best = best[every[best] > 0]
        assert np.allclose(every[best], cosines)
        assert np.allclose(every[places], cosines)


def test_odd_input(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([(k, 1, k % 2 if k % 5 else None) for k in range(300)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for docs, marks in ((odd_docs, labels), (odd_docs, none), (empty_docs, labels)):
        index = toxicity.fit(docs, marks)
        rows = toxicity.score(docs, index).collect()
        assert len(rows) == docs.count()
        assert all(r.score is not None and 0 <= r.score <= 1 for r in rows)
    nulls = spark.createDataFrame([(None, "a"), (None, None)], "doc_id long, text string")
    assert toxicity.score(nulls, index).count() == 2
