import numpy as np
import pyarrow as pa
import pytest

from orestrata.llm import pitman_yor, queries
from tests.llm import brute


def check(got, rows):
    wanted = brute.base_scores(rows)
    assert got.keys() == wanted.keys()
    for doc_id, (n, known, total, base) in wanted.items():
        row = got[doc_id]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n, known, total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.held_out == brute.held_out(doc_id, 10)
        assert row.score < 0 and row.perplexity > 1


@pytest.mark.parametrize("head", [1100, pitman_yor.HEAD])
def test_small_table(spark, monkeypatch, head):
    monkeypatch.setattr(pitman_yor, "HEAD", head)
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.op9_pitman_yor(spark, folder).collect()}
    check(got, rows)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one(spark, odd_docs):
    model, words = pitman_yor.fit(odd_docs)
    assert np.allclose((10.0**model.steps).sum(axis=1), 1)
    classes = set(model.classes.view(np.int64).tolist())
    own = [r for r in words.collect() if r.h not in classes]
    # Every known word, and all unknown ones as one dish.
    unseen = model.distinct + 1 - len(own)
    assert sum(10.0**r.score for r in own) + unseen * 10.0**model.unknown == pytest.approx(1)


def test_seating():
    draw = np.random.default_rng(1)
    customers = np.array([0, 1, 2, 10, 1000, 1_000_000])
    tables = pitman_yor.seat(customers, np.full(6, 50), np.full(6, 0.01), 0.5, draw)
    assert tables[0] == 0 and tables[1] == 1 and (tables <= customers).all() and (np.diff(tables[2:]) >= 0).all()
    # The mean number of tables follows the sum of the chances of a new one.
    many = pitman_yor.seat(np.full(4000, 40), np.full(4000, 20), np.full(4000, 0.1), 0.5, draw)
    mean, expected = many.mean(), 1.0
    for seated in range(1, 40):
        new = (1 + 0.5 * (20 + expected)) * 0.1
        expected += new / (new + seated - 0.5 * expected)
    assert mean == pytest.approx(expected, rel=0.05)


def test_odd_input(spark, odd_docs, odd_rows, empty_docs):
    got = {r.doc_id: r for r in pitman_yor.score(odd_docs, *pitman_yor.fit(odd_docs)).collect()}
    check(got, odd_rows)
    assert pitman_yor.score(empty_docs, *pitman_yor.fit(empty_docs)).count() == 0
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (5, None)], "doc_id long, text string")
    assert pitman_yor.score(docs, *pitman_yor.fit(docs)).count() == 3
    words, bounds = pitman_yor.tokens(pa.array(["a b", None, " c"]))
    assert np.diff(bounds).tolist() == [3, 1, 2] and (words[bounds[1:] - 1] == pitman_yor.END).all()


def test_what_follows_a_rare_word_is_learned(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "CLASSES", 2)
    for head in (3, pitman_yor.HEAD):  # most words outside the head, and none
        monkeypatch.setattr(pitman_yor, "HEAD", head)
        train = [(k, " ".join(f"the left{k % 5} right{k % 5}" for _ in range(4))) for k in range(60)]
        model, words = pitman_yor.fit(spark.createDataFrame(train, "doc_id long, text string"))
        asked = [(1, "the left1 right1"), (2, "the left1 right2"), (3, "the left1 right3"), (4, "the left1 never"), (5, "right1 left1")]
        docs = spark.createDataFrame(asked, "doc_id long, text string")
        got = {r.doc_id: r.score for r in pitman_yor.score(docs, model, words).collect()}
        assert got[1] > got[2] + 1 and got[1] > got[3] + 1 and got[2] > got[4], head
        # Of every place: what follows the first word, all words of the table and one never seen.
        every = sorted({w for _, text in train for w in text.split()})
        docs = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string")
        assert pitman_yor.score(docs, model, words).count() == len(every)


def test_lower_restaurants_sum_to_one():
    draw = np.random.default_rng(3)
    base = draw.dirichlet(np.ones(50))
    houses, words = np.repeat(np.arange(4), 50), np.tile(np.arange(50), 4)
    met = draw.integers(0, 2000)  # customers, besides one question per word
    at = draw.choice(200, 3000, p=np.repeat([0.6, 0.3, 0.1, 0.0], 50) / 50)
    restaurant, word = np.concatenate([houses, houses[at]]), np.concatenate([words, words[at]])
    training = np.arange(len(word)) >= 200
    gain, order = pitman_yor.seated(int(met), restaurant, word, training, base[word])
    value = np.empty(len(word))
    value[order] = gain
    p = 10.0 ** value[:200] * base[words]
    assert np.allclose(np.bincount(houses, weights=p), 1)
    assert np.allclose(value[150:200], 0)  # nobody sits in the last
    shares = np.bincount(at, minlength=200)[:50] / np.count_nonzero(at < 50)
    assert np.abs(p[:50] - shares).max() < 0.02


def test_scores_do_not_depend_on_what_else_is_scored(spark, odd_docs):
    """Pairs are learned from the fitted rows, whichever rows are scored."""
    model, words = pitman_yor.fit(odd_docs)
    whole = {r.doc_id: r for r in pitman_yor.score(odd_docs, model, words).collect()}
    part = pitman_yor.score(odd_docs.where("doc_id % 3 = 0").repartition(3), model, words).collect()
    assert part
    for row in part:
        assert row.score == pytest.approx(whole[row.doc_id].score, rel=1e-9)
        assert (row.n_tokens, row.n_known) == (whole[row.doc_id].n_tokens, whole[row.doc_id].n_known)
