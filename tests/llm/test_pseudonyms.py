import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from orestrata.llm import pseudonyms as P
from orestrata.llm import queries


def permuted(text, key, alphabets):
    """The network over strings, character by character."""
    left, right = text[: len(text) // 2], text[len(text) // 2 :]
    for number in range(1, P.ROUNDS + 1):
        stream = hashlib.sha512(f"{key}:{number}:{right}".encode()).hexdigest()
        moved = ""
        for place, char in enumerate(left):
            by = int(stream[2 * (place % 64) : 2 * (place % 64) + 2], 16)
            for alphabet in alphabets:
                if char in alphabet:
                    char = alphabet[(alphabet.index(char) + by) % len(alphabet)]
                    break
            moved += char
        left, right = right, moved
    return left + right


def luhn(digits):
    numbers = [int(x) for x in reversed(digits)]
    return (sum(numbers[0::2]) + sum(sum(divmod(2 * x, 10)) for x in numbers[1::2])) % 10 == 0


def out(spark, texts, key=P.KEY):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in P.pseudonymised(docs, key).collect()}


CARD = "4111 1111-1111 1111"
TEXTS = [
    f"pay {CARD} now", "4111111111111111", "4111111111111112 is no card", "call +1 (017) 555-7713, or 017-555-7713.",
    "mail Ann.7@mail7.example.com!", "at 10.0.255.1. and 10.0.256.1", "born 1999-02-28, 28.02.1999, 1999/02/28; not 1999-02-30",
    "id 078-05-1120", "token = \"9233A8ECF7C5B09FE5949719B6B82BC439E9329B\"", "7536784127813050 4845168114407329", "", None, "x" * 200_000,
]


def test_values_and_links(spark):
    rows = out(spark, TEXTS)
    digits = re.sub(r"\D", "", rows[0].text)
    assert re.fullmatch(r"pay \d{4} \d{4}-\d{4} \d{4} now", rows[0].text) and luhn(digits)
    assert digits[:15] == permuted("411111111111111", f"{P.KEY}/card", ["0123456789"])
    assert rows[1].text == digits and digits != "4111111111111111"
    assert rows[2].text == TEXTS[2] and rows[2].pii == []
    number = permuted("0175557713", f"{P.KEY}/phone", ["0123456789"])
    assert rows[3].text == f"call +1 ({number[:3]}) {number[3:6]}-{number[6:]}, or {number[:3]}-{number[3:6]}-{number[6:]}."
    assert rows[4].text == f"mail {permuted('ann.7', P.KEY + '/email', [P._DIGITS, P._LOWER])}@mail7.example.com!"
    found = re.fullmatch(r"at (\d+\.\d+\.\d+\.\d+)\. and 10\.0\.256\.1", rows[5].text)
    assert found and found[1] != "10.0.255.1" and all(0 <= int(x) <= 255 for x in found[1].split("."))
    a, b, c = re.fullmatch(r"born (.*), (.*), (.*); not 1999-02-30", rows[6].text).groups()
    days = [datetime.datetime.strptime(x, f) for x, f in ((a, "%Y-%m-%d"), (b, "%d.%m.%Y"), (c, "%Y/%m/%d"))]
    assert days[0] == days[1] == days[2] != datetime.datetime(1999, 2, 28)
    assert re.fullmatch(r"id \d{3}-\d{2}-\d{4}", rows[7].text) and rows[7].text != TEXTS[7]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', rows[8].text) and rows[8].text.lower() != TEXTS[8].lower()
    assert all(luhn(x) for x in rows[9].text.split(" ")) and len(rows[9].text) == 33
    assert rows[10].text == "" and rows[11].text is None and rows[12].text == TEXTS[12]
    assert out(spark, TEXTS[:2], "another key")[1].text != rows[1].text


def test_permutations_are_bijections(spark):
    days = spark.range(0, P._DAYS, 7).select(P._permuted_day(F.col("id"), "k").alias("d"))
    assert days.distinct().count() == days.count() and days.where(~F.col("d").between(0, P._DAYS - 1)).count() == 0
    small = spark.range(1000).select(P.permuted(F.lpad(F.col("id").cast("string"), 3, "0"), "k", ["0123456789"]).alias("s"))
    assert small.distinct().count() == 1000
    bits = spark.range(0, 2**32, 2_000_003).select(P._permuted_bits(F.col("id"), "k").alias("b"))
    assert bits.distinct().count() == bits.count() and bits.where(~F.col("b").between(0, 2**32 - 1)).count() == 0


def test_table_and_plan(spark, odd_docs, empty_docs):
    frame = queries.op3_pseudonyms(spark, "/root/testdata/sf0.01")
    plan = frame._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    found = 0
    for row in frame.collect():
        old = texts[row.doc_id]
        cards = re.findall(r"(?<!\d)\d{16}(?!\d)", old)
        assert not any(card in row.text for card in cards if luhn(card))
        assert not any(mail in row.text for mail in re.findall(r"[\w.]{3,}@mail\d\.example\.com", old))
        found += len(row.pii)
        assert (row.text == old) == (not row.pii)
    assert found > 50
    assert P.pseudonymised(odd_docs).columns == [*odd_docs.columns, "pii"]
    assert P.pseudonymised(odd_docs).count() == odd_docs.count()
    assert P.pseudonymised(empty_docs).count() == 0
    with pytest.raises(AssertionError):
        assert luhn("4111111111111112")
