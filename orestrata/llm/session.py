"""Session settings of the operators in this package, and what their Python workers keep between tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

from orestrata.session import adaptive

#: Rows which go to a Python worker at once: a few megabytes of texts.
BATCH_ROWS = "2000"


def prepared(spark: SparkSession) -> SparkSession:
    """``adaptive``, and batches whose memory a worker can hold next to its arrays."""
    spark = adaptive(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, or the first of name_, name__, ... which no column has; letter case does not count."""
    known = {each.lower() for each in taken}
    while name.lower() in known:
        name += "_"
    return name


def release() -> None:
    """Give freed memory back to the system: a worker lives on, and the next stage's stand beside it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Step = Callable[[Iterator], Iterator]


def releasing(step: Step) -> Step:
    """A step over batches which gives back, at its end, what it has held."""

    @wraps(step)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from step(batches)
        finally:
            release()

    return run
