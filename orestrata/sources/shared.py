"""Intermediate results kept in the folder which the cluster shares.

A settled result survives the loss of executors, is computed once however
often it is read, and has a size Spark knows: whether a later join may
broadcast it is then decided by ``spark.sql.autoBroadcastJoinThreshold`` on
the size of real files, not on an estimate.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orestrata.sources.files import remove

CHECKPOINT_DIR = "spark.checkpoint.dir"

_SETTING = Lock()
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; in local mode where none is set a temporary one, gone with the process."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder which all executors can reach")
    with _SETTING:  # independent tables are stored side by side
        if not spark.sparkContext.getCheckpointDir():
            own = tempfile.mkdtemp(prefix="orestrata-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession) -> str:
    return f"{_SCRATCH.get() or f'{shared_folder(spark)}/orestrata'}/{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is settled within is removed at the end; no result that outlives it may read it."""
    folder = new_folder(spark)
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        remove(spark, folder)


@contextmanager
def lasting() -> Iterator[None]:
    """What is settled within stays, also inside a ``scratch``."""
    token = _SCRATCH.set(None)
    try:
        yield
    finally:
        _SCRATCH.reset(token)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_counting(df: DataFrame) -> tuple[DataFrame, int]:
    """``settle``, and the number of rows as counted by the same job."""
    seen = Observation()
    settled = settle(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return settled, seen.get["rows"]
