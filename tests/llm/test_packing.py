import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orestrata.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 32])
def test_round_trip_and_random_access(width):
    draw = np.random.default_rng(width)
    ids = draw.integers(0, 2**width, 1000).astype(np.uint32)
    data = packing.pack(ids, width)
    assert len(data) == (1000 * width + 7) // 8
    for first, count in ((0, 1000), (0, 0), (999, 1), (3, 17), (500, 400)):
        assert (packing.unpack(data, width, first, count) == ids[first : first + count]).all()
    found = packing.Block(packing.block(ids, np.array([10, 10, 1000]), width, 77))
    assert found.before == 77 and (found.all() == ids).all()
    assert [len(found.document(k)) for k in range(3)] == [10, 0, 990]
    assert (found.document(2) == ids[10:]).all()


def test_width_is_the_least():
    assert [packing.width_of(n) for n in (1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_odd_rows(spark, odd_docs, odd_rows, empty_docs):
    path = packing.write(odd_docs, PATH)
    got = packing.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(odd_rows)
    assert packing.read(spark, packing.write(empty_docs, PATH)).count() == 0
    rows = [(None, "b"), (None, None), (3, "x y"), (3, "x y"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.read(spark, packing.write(docs, PATH)).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start")
    assert [tuple(r) for r in got.collect()] == expected(rows)


def test_small_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert [tuple(r) for r in queries.op6_packing(spark, folder).orderBy("start").collect()] == expected(rows)
