import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from orestrata.llm import kdtree, queries, spelling
from tests.llm.brute import lower


def word_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def without_one(word):
    return {word[:k] + word[k + 1 :] for k in range(len(word))}


def brute(rows):
    """{word: (form, root, n, n_near, form_n)}: near words by the wildcards they share."""
    counts = word_counts(rows)
    near = {word: set() for word in counts}
    holes = {}
    for word in counts:
        for k in range(len(word)):
            holes.setdefault((word[:k], word[k + 1 :]), []).append(word)
        for other in without_one(word) & counts.keys():
            near[word].add(other)
            near[other].add(word)
    for group in holes.values():
        for word in group:
            near[word] |= set(group) - {word}
    out = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda x: (-counts[x], x), default=None)
        formed = best is not None and counts[best] >= 10 * n
        out[word] = (best if formed else None, n, len(near[word]), counts[best] if formed else None)
    result = {}
    for word, (form, n, n_near, form_n) in out.items():
        root = word
        while out[root][0] is not None:
            root = out[root][0]
        result[word] = (form, root, n, n_near, form_n)
    return result


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def invented(draw, count):
    """Words of few letters, with variants, so that many are near each other."""
    words = set()
    while len(words) < count:
        word = "".join(draw.choices("abcdeéÿ", k=draw.randint(7, 11)))
        words.add(word)
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(word))
            word = word[:at] + draw.choice(["", "x", "ab"]) + word[at + draw.randrange(2) :]
            words.add(word)
    return sorted(words)[:count]


def test_tree_search_finds_every_pair_one_edit_apart():
    draw = random.Random(2)
    words = [w for w in invented(draw, 1500) if len(w) >= 7]
    for size in (7, 8, 9):
        own = [w for w in words if len(w) == size]
        tree = kdtree.Words(own)
        for asked in (own, [w for w in words if len(w) == size + 1]):
            a, b = tree.near(asked)
            got = {(asked[i], own[j]) for i, j in zip(a.tolist(), b.tolist())}
            assert len(got) == len(a)
            if asked is own:
                wanted = {(x, y) for x in own for y in own if sum(p != q for p, q in zip(x, y)) == 1}
            else:
                wanted = {(x, y) for x in asked for y in set(own) & without_one(x)}
            assert got == wanted
    one = kdtree.Words(["aaaaaaa", "aaaaaab"])
    assert [x.tolist() for x in one.near(["aaaaaaa"])] == [[0], [1]]


def test_boxes_prune_but_lose_nothing():
    draw = random.Random(3)
    values = kdtree.vectors(kdtree.codes(["".join(draw.choices("abcdefgh", k=9)) for _ in range(800)]))
    for tight in (True, False):
        tree = kdtree.Tree(values, leaf=20, tight=tight)
        homes = tree.home(values)
        met = set()
        for leaf, rows in tree.reached(values, kdtree.SAME_LENGTH):
            met |= {(int(k), leaf) for k in rows}
        assert all((k, int(leaf)) in met for k, leaf in enumerate(homes))
        assert len(met) < 0.7 * len(values) * len(tree.members)
        for k in range(0, 800, 40):
            for j in range(800):
                if len(kdtree.within(values[k : k + 1], values[j], values[j], kdtree.SAME_LENGTH)):
                    assert (k, int(homes[j])) in met
    same = kdtree.Tree(np.tile(values[:1], (50, 1)), leaf=4)
    assert len(same.members) == 1 and len(same.members[0]) == 50


@pytest.mark.parametrize("sample, box_words", [(65_536, 4_000), (200, 30)])
def test_invented_words_equal_brute_force(spark, sample, box_words):
    draw = random.Random(11)
    words = invented(draw, 700)
    weights = [draw.choice([1, 1, 2, 20, 400]) for _ in words]
    rows = [(k, " ".join(draw.choices(words, weights, k=120))) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = brute(rows)
    assert sum(form is not None for form, *_ in wanted.values()) > 20
    assert found(spelling.variants(docs, sample, box_words)) == wanted


def test_forms_are_followed_to_the_root(spark):
    chain = [("aaaaaaab", 2), ("aaaaaabb", 20), ("aaaaabbb", 200), ("aaaabbbb", 2000)]
    rows = [(None, " ".join([word] * n)) for word, n in chain]
    wanted = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(spelling.variants(docs)) == wanted
    assert {root for _, root, *_ in wanted.values()} == {"aaaabbbb"} and len(wanted) == 4


def test_odd_rows(spark, odd_docs, odd_rows, empty_docs):
    assert found(spelling.variants(odd_docs)) == brute(odd_rows)
    assert spelling.variants(empty_docs).count() == 0
    long = "z" * 400
    rows = [(1, f"{long}a {long}A {long} {long}"), (1, f"Éléphant éléphant Éléphants-éléphants ÉLÉPHANT {long}"), (2, None), (2, ""), (2, "short")]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id int, text string, n int, word string")
    assert found(spelling.variants(docs)) == brute(rows)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_table_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.op12_spelling(spark, folder)) == brute(rows)
