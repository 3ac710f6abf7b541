import random
import re

import pytest

from orestrata.llm import notices, queries
from orestrata.llm.notices import NOTICES, PHRASES, Finder, Notice
from tests.llm.brute import lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_base(text):
    words = WORD.findall(lower(text))
    starts, labels = [], set()
    for phrase, label in PHRASES:
        size = len(phrase.split(" "))
        at = [k for k in range(len(words) - size + 1) if words[k : k + size] == phrase.split(" ")]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def least_edits(pattern, text):
    """The fewest edits of the pattern against any part of the text (Sellers)."""
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for letter in text:
        before, column = column, [0]
        for k, wanted in enumerate(pattern, 1):
            column.append(min(before[k] + 1, column[k - 1] + 1, before[k - 1] + (letter != wanted)))
        best = min(best, column[-1])
    return best


def altered(draw, text, edits):
    for _ in range(edits):
        at, kind = draw.randrange(len(text)), draw.randrange(3)
        text = text[:at] + ("" if kind == 0 else draw.choice("abcxyz ")) + text[at + (kind < 2) :]
    return text


def test_every_notice_within_its_edits_is_found_and_no_other():
    draw = random.Random(7)
    plain = [Notice(str(k), each.text) for k, each in enumerate(NOTICES)]  # without cores
    finder = Finder(plain)
    found_altered = 0
    for trial in range(400):
        words = [draw.choice(["the", "license", "under", "a", "public", "software", "zebra", "to"]) for _ in range(12)]
        wanted = draw.choice(plain)
        words.insert(draw.randrange(12), altered(draw, wanted.text, draw.randint(0, wanted.edits_allowed + 2)))
        text = " ".join(" ".join(words).split())
        spans = finder.spans(text)
        found = {finder.notices[number].label: edits for number, _, _, edits in reversed(spans)}
        for each in plain:
            least = least_edits(each.text, text)
            assert (each.label in found) == (least <= each.edits_allowed), (text, each, least, spans)
            found_altered += 0 < least <= each.edits_allowed
        for number, start, end, edits in spans:
            assert least_edits(finder.notices[number].text, text[start:end]) <= edits
    assert found_altered > 100


def test_pieces_are_one_more_than_edits():
    for each in NOTICES:
        assert "".join(piece for _, piece in each.pieces) == each.text
        assert len(each.pieces) == each.edits_allowed + 1
        assert each.text == " ".join(WORD.findall(each.text))


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licenced under the Apache Licence", "apache"),
        ("GNU Genral Public Licence", "gpl"),
        ("GNU Lesser General Public License", "lgpl"),
        ("released under the MPL license", ""),
        ("Released under the MIT-License.", "mit"),
        ("released under the mit licence", "mit"),
        ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc"),
        ("licensed under cc by sa", "cc-by,cc-by-sa"),
        ("permission is hereby granted, free of charge, to any persons", "mit"),
        ("a permit", ""),
    ],
)
def test_labels(text, labels):
    assert notices._scanned(text, Finder(NOTICES), PHRASES)[5] == labels


def test_spans_point_into_the_text():
    text = "Ünïcode -- (GNU  Genral\nPublic Licence), and the MIT licence under the M.I.T. or GNU General Public License."
    *_, score, spans = notices._scanned(text, Finder(NOTICES), PHRASES)
    assert score == 1
    assert [(text[s[2] : s[3]], s[4], s[5], s[6]) for s in spans] == [
        ("GNU  Genral\nPublic Licence", 1, 4, 2),
        ("GNU General Public License", 15, 4, 0),
    ]


def test_odd_rows(spark, odd_docs, odd_rows, empty_docs):
    got = {r.doc_id: r for r in notices.scan(odd_docs).collect()}
    assert got.keys() == {i for i, _ in odd_rows}
    for doc_id, text in odd_rows:
        assert tuple(got[doc_id])[1:6] == brute_base(text)
    assert notices.scan(empty_docs).count() == 0
    text = "cc by cc by. CC-BY " + "word " * 30_000 + "the MIT license; mit licensee"
    rows = [(None, text), (None, text), (1, None)]
    got = notices.scan(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int")).collect()
    assert sorted((r.doc_id is None, r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score) for r in got) == [
        (False, 0, 0, None, None, "", 0.0),
        (True, 30_011, 4, 0, 30_007, "cc-by,mit", 1.0),
        (True, 30_011, 4, 0, 30_007, "cc-by,mit", 1.0),
    ]


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op11_notices(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(texts[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert sum(r.n_base > 0 for r in got) > 10
