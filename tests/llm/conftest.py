import random

import pytest


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text) with nulls, empties, ties, repeats, copies, near copies and a very long text."""
    draw = random.Random(5)
    vocabulary = ["a", "Über", "naïve", "ΣΟΦΟΣ", "İstanbul", "x9", "don't", "日本語", "éte", "½", "_", "--", "Straße"]
    vocabulary += ["".join(draw.choices("abcdefgh", k=draw.randint(1, 7))) for _ in range(400)]

    def text(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    base = text(300)
    rows = [(k, text(draw.randint(0, 60))) for k in range(60)]
    rows += [(100 + k, base) for k in range(12)]
    near = base.split(" ")
    for k in range(30):
        changed = list(near)
        for _ in range(k // 3):
            changed[draw.randrange(len(changed))] = draw.choice(vocabulary)
        rows.append((200 + k, " ".join(changed)))
    rows += [(300, None), (301, None), (302, ""), (303, " \t\n"), (304, "one"), (305, "one two"), (306, "One  two"), (307, "one\ttwo")]
    rows += [(308, "a <|endoftext|> b <|ENDOFTEXT|> <|startoftext|>"), (309, "\x1c\x85    x"), (310, text(20_000))]
    rows += [(311, base.upper()), (312, "I'LL we've 'T 'tis it's"), (313, "퟿￿ \U0001f600\U0001f600 !?!"), (314, "don’t é É ê")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, tmp_path_factory):
    """The rows as a stored table with further columns, one of them with an awkward name."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or ""), i, "x") for i, t in odd_rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shingle long, `a.b` string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
