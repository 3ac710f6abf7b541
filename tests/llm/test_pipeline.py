import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from orestrata.llm import mixing, pseudonyms, toxicity
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"


def test_stages_equal_brute_force(spark, tmp_path):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        means = {r.source: r["mean"] for r in mixing.repetitions(docs).collect()} if name == "mixing" else {}
        sources = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()} if means else {}
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = [r.doc_id for r in docs.select("doc_id").collect()]
        assert k == 4 or docs.columns == columns
        if name == "toxicity":
            assert sorted(after) == sorted(i for i, _ in before if scores[i] < 0.5)
            assert 0.85 * len(before) < len(after) < len(before)
        elif name == "exact_dedup":
            assert sorted(after) == sorted(x[0] for x in brute.exact_duplicates(before) if x[3])
        elif name == "ngram_jaccard":
            linked = brute.jaccard_components(before, 5, 80, 100)
            assert sorted(after) == sorted(i for i, (_, c) in linked.items() if c == i)
        elif name == "mixing":
            assert Counter(after) == Counter(_copies(before, sources, means))
        else:
            _check_tokens(docs, dict(before), after)


def _copies(before, sources, means):
    import math

    for doc_id, _ in before:
        mean = means[sources[doc_id]]
        u = int(hashlib.md5(f"{mixing.SEED}:{doc_id}/1".encode()).hexdigest()[:13], 16) / 16**13
        term = total = math.exp(-mean)
        k = 0
        while total <= u:
            k += 1
            term = term * mean / k
            total += term
        yield from [doc_id] * k


def _check_tokens(docs, texts, after):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert len(after) > 0
    for r in docs.collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids


def test_run_on_odd_tables(spark, odd_docs, empty_docs, tmp_path):
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, empty_docs):
        docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        count = corpus_pipeline.run(spark, str(tmp_path)).count()
        assert (count > 0) == (docs is odd_docs)


def test_columns_named_like_helpers_are_carried(spark, empty_docs):
    names = ["__gone", "__digest", "__ID", "__of", "__source", "__mean", "__count", "copy", "mix_key", "pii", "__found", "__new"]
    same = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(k, text, "en", "s", 1, *range(len(names))) for k, text in enumerate([same, same, same + " x", None, "", "other words"])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{name}` int" for name in names)
    given = spark.createDataFrame([*rows, rows[0]], schema)
    docs = given
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == given.columns, name
        for row in docs.collect():
            assert tuple(row)[5:] == tuple(range(len(names)))
    assert {row.doc_id for row in docs.collect()} <= {0, 3, 4, 5}
    mixed = mixing.mixture(given)
    assert mixed.columns == [*given.columns, "copy_", "mix_key_"]
    found = pseudonyms.pseudonymised(given)
    assert found.columns == [*given.columns, "pii_"] and found.count() == 7
