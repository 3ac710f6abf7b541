import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orestrata.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("head", [0, 20, 100_000])
def test_equals_the_tokenizer(odd_docs, odd_rows, head):
    tokenizer = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(odd_docs, PATH, head), PATH).collect()}
    assert len(got) == len(odd_rows)
    for doc_id, text in odd_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        row = got[doc_id]
        assert np.frombuffer(row.ids, "<u4").tolist() == ids, (doc_id, (text or "")[:80])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.text == tokenizer.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def test_small_table_equals_the_tokenizer(spark):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in bpe.encode(docs, PATH, 500).collect():
        assert np.frombuffer(row.ids, "<u4").tolist() == tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids


def test_repeated_rows_null_ids_and_empty_table(spark, empty_docs):
    docs = spark.createDataFrame([(1, "some words"), (1, "some words"), (None, None), (None, "zzxy")], "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs, PATH, 0), PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens > 0) for r in rows) == [("1", True), ("1", True), ("None", False), ("None", True)]
    assert len({r.ids_sha256 for r in rows}) == 3
    assert bpe.encode(empty_docs, PATH).count() == 0


def test_known_words_are_numbered_once():
    encoder = bpe.Encoder(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["one two one", None, "two three", "", "one <|endoftext|> four"]
    for _ in range(2):
        ids, bounds = encoder.encode(texts)
        for k, text in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
    words = [w for text in texts for w in encoder._splitter.split(text or "")]
    assert len(encoder._number) == len(set(words)) and not encoder._number.new


@pytest.mark.parametrize("count", [40, 200])
def test_words_left_to_the_join_grow_as_the_words_do(spark, count):
    rows = [(k, f"one two three four five six seven eight nine own{'abcdefghij'[k % 10]}{chr(0x4E00 + k)}") for k in range(count)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = bpe.word_table(docs, PATH)
    occurrences = {r.word: r.n for r in words.collect()}
    head = bpe.Head(words, 180)
    total = sum(occurrences.values())
    assert total == 10 * count
    assert total - sum(occurrences[w] for w in head.words) == total // bpe.REST
    assert head.least == min(occurrences[w] for w in head.words) == 1
    assert max(n for w, n in occurrences.items() if w not in head.words) <= head.least


def test_head_size_of_classes_and_bounds(spark, monkeypatch):
    monkeypatch.setattr(bpe, "CLASSES", 10)
    words = spark.createDataFrame([("a", 300), ("b", 20), ("c", 10), ("d", 9), ("e", 9), ("f", 1), ("g", 1)], "word string, n long")
    assert bpe.head_size(words, 100, 50) == (5, 9)  # 350 occurrences, 7 are left
    assert bpe.head_size(words, 100, 18) == (4, 9)
    assert bpe.head_size(words, 100, 300) == (6, 1)
    assert bpe.head_size(words, 2, 50) == (2, 10)
    assert bpe.head_size(words, 0, 50)[0] == 0
    assert bpe.head_size(words.limit(0), 100, 50)[0] == 0


def test_texts_are_split_twice_at_most(spark, odd_docs):
    encoded = bpe.encode(odd_docs, PATH, 20)
    encoded.collect()
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0]
