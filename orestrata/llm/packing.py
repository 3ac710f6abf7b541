"""Token ids in fixed-width bit packing, in ascending order of documents.

An id takes the fewest bits which hold any id of the vocabulary. The file is a sequence of blocks of whole
documents: a header (magic, width, documents, ids, ids of its segment before it), the end of each
document in the block, and the packed ids, most significant bit first. Every block is decoded by
itself, as a few numpy steps, and one document or one range of ids by reading only its bits. Blocks are rows of
a Parquet table in the shared folder, so any store Spark writes will do and lost tasks are repeated; a segment is
what one task wrote, and segments follow each other in the order of ids.

A null text counts as empty and has the end id only. Rows with a null id come first. Rows repeated with an id follow
each other by their texts. Extra columns are not looked at. An empty table makes no block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm.bpe import encoder, splitter
from orestrata.llm.text import chunks
from orestrata.sources.shared import new_folder

END_ID = 1
_MAGIC = b"OTB1"
_HEAD = struct.Struct("<4sHxxIQQ")


def width_of(vocabulary: int) -> int:
    """Bits which hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f">u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8)).reshape(-1, 32)[:, 32 - width :]
    return np.packbits(bits).tobytes()


def unpack(data: bytes, width: int, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of packed ids; reads only the bytes which hold them."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(data, dtype=f">u{size}", count=count, offset=first * size).astype(np.uint32)
    start = first * width
    there = np.frombuffer(data, dtype=np.uint8, offset=start // 8, count=(start + count * width + 7) // 8 - start // 8)
    bits = np.unpackbits(there)[start % 8 : start % 8 + count * width].reshape(count, width)
    wide = np.zeros((count, 32), dtype=np.uint8)
    wide[:, 32 - width :] = bits
    return np.packbits(wide).view(">u4").astype(np.uint32)


def block(ids: np.ndarray, ends: np.ndarray, width: int, before: int) -> bytes:
    head = _HEAD.pack(_MAGIC, width, len(ends), len(ids), before)
    return head + ends.astype("<u8").tobytes() + pack(ids, width)


class Block:
    """Random access to the documents of one block."""

    def __init__(self, image: bytes) -> None:
        magic, self.width, documents, self.ids, self.before = _HEAD.unpack_from(image)
        if magic != _MAGIC:
            raise ValueError("not a block of packed ids")
        ends = np.frombuffer(image, dtype="<u8", count=documents, offset=_HEAD.size).astype(np.int64)
        self.bounds = np.concatenate([[0], ends])
        self._data = memoryview(image)[_HEAD.size + 8 * documents :]

    def document(self, k: int) -> np.ndarray:
        return unpack(self._data, self.width, int(self.bounds[k]), int(self.bounds[k + 1] - self.bounds[k]))

    def all(self) -> np.ndarray:
        return unpack(self._data, self.width, 0, self.ids)


def write(docs: DataFrame, path: str, folder: str | None = None, end_id: int = END_ID) -> str:
    """Encode all texts and write the blocks (segment, block, doc_ids, n_ids, image); the folder."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark)
    width = width_of(splitter(path).whole.get_vocab_size())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId()
        number = before = 0
        for batch in batches:
            for first, part in chunks(batch.column("text")):
                ids, bounds = encoder(path).encode(part.to_pylist())
                # One more id behind each document.
                ends = bounds[1:] + np.arange(1, len(part) + 1)
                whole = np.full(len(ids) + len(part), end_id, dtype=np.uint32)
                whole[np.arange(len(ids)) + np.repeat(np.arange(len(part)), np.diff(bounds))] = ids
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment], pa.int32()),
                        pa.array([number], pa.int32()),
                        pa.array([batch.column("doc_id").slice(first, len(part)).to_pylist()], pa.list_(pa.int64())),
                        pa.array([len(whole)], pa.int64()),
                        pa.array([block(whole, ends, width, before)], pa.binary()),
                    ],
                    names=["segment", "block", "doc_ids", "n_ids", "image"],
                )
                number, before = number + 1, before + len(whole)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text")
    schema = "segment int, block int, doc_ids array<long>, n_ids long, image binary"
    ordered.mapInArrow(blocks, schema).write.parquet(folder)
    return folder


def segment_starts(blocks: DataFrame) -> dict[int, int]:
    """Ids before each segment. There are as many segments as the writing job had tasks."""
    totals = blocks.groupBy("segment").agg(F.sum("n_ids").alias("n")).orderBy("segment").collect()
    starts, total = {}, 0
    for row in totals:
        starts[row.segment] = total
        total += row.n
    return starts


def read(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (binary, 4 bytes each) of every document of the file."""
    blocks = spark.read.parquet(folder)
    starts = segment_starts(blocks)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = Block(row["image"])
                ids = found.all().astype("<u4")
                packed = [ids[a:b].tobytes() for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(found.bounds[:-1] + (starts[row["segment"]] + found.before)),
                        pa.array(np.diff(found.bounds)),
                        pa.array([zlib.crc32(x) for x in packed], pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return blocks.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
