import numpy as np
from pyspark.sql import functions as F

from orestrata.llm import dedup, fuse
from tests.llm import brute


def found(df):
    return sorted(
        [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()], key=str
    )


def test_equals_brute_force(odd_docs, odd_rows):
    assert found(dedup.exact_duplicates(odd_docs)) == sorted(brute.exact_duplicates(odd_rows), key=str)


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a"), (None, "a"), (1, "a  b"), (1, "a b"), (1, "a\nb"), (2, "a b"), (None, "c"), (None, "c"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(dedup.exact_duplicates(docs)) == sorted(brute.exact_duplicates(rows), key=str)
    assert dedup.drop_duplicates(docs).count() == 4


def test_unequal_texts_of_one_digest_are_told_apart(spark):
    rows = [(k, f"text {k % 5}") for k in range(20)] + [(50, "other"), (51, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weak = dedup.exact_duplicates(docs, digest=lambda text: F.encode(F.length(text).cast("string"), "utf-8"))
    wanted = sorted((a, b, c, d) for a, b, c, d, _ in brute.exact_duplicates(rows))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in weak.collect()) == wanted


def test_empty_table(empty_docs):
    assert dedup.exact_duplicates(empty_docs).count() == 0
    assert dedup.drop_duplicates(empty_docs).count() == 0


def test_dropped_rows_keep_columns(odd_docs, odd_rows):
    kept = dedup.drop_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    wanted = {x[0] for x in brute.exact_duplicates(odd_rows) if x[3]}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)


def test_filters_deny_no_key_and_few_others():
    draw = np.random.default_rng(3)
    for count in (0, 1, 2, 3, 10, 100, 5000, 200_000):
        keys = draw.integers(0, 2**63, count).astype(np.uint64)
        image = fuse.build(keys)
        assert fuse.contains(image, keys).all()
        others = draw.integers(2**63, 2**64, 20_000, dtype=np.uint64)
        assert fuse.contains(image, others).mean() < 0.02
        assert count < 5000 or len(image) < 1.4 * count + 100


def test_screen_denies_new_digests(spark):
    groups = spark.range(2000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("copies"))
    snapshot = dedup.Snapshot.build(groups.where("keep_id < 1000"))
    counts = snapshot.screen(groups).groupBy(F.col("keep_id") < 1000, "maybe").count().collect()
    known = {(r[0], r[1]): r[2] for r in counts}
    assert known[True, True] == 1000 and (True, False) not in known and known[False, False] > 950
