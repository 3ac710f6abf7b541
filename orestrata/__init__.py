"""A layered sales warehouse on Spark: bronze copies, profiling, silver contracts, a gold star."""

from orestrata.operators.calendar import dim_date, dim_date_spanning
from orestrata.operators.conform import Check, Contract, Field, conform
from orestrata.operators.expectations import ConstraintViolation, Expectation, enforce
from orestrata.operators.ingest import ingest, load_isolated
from orestrata.operators.surrogate import surrogate_key
from orestrata.plans.warehouse import build_gold, build_silver, build_warehouse
from orestrata.session import local_session, tune
from orestrata.sources.layers import CatalogLayers, PathLayers
from orestrata.sources.numbered import Numbering, NumberedSource
from orestrata.sources.readers import (
    CatalogSource,
    FileSource,
    FrameSource,
    JdbcRanges,
    JdbcSource,
    JdbcSplit,
    UnsplitTable,
)

__all__ = [
    "CatalogLayers",
    "CatalogSource",
    "Check",
    "ConstraintViolation",
    "Contract",
    "Expectation",
    "Field",
    "FileSource",
    "FrameSource",
    "JdbcRanges",
    "JdbcSource",
    "JdbcSplit",
    "NumberedSource",
    "Numbering",
    "PathLayers",
    "UnsplitTable",
    "build_gold",
    "build_silver",
    "build_warehouse",
    "conform",
    "dim_date",
    "dim_date_spanning",
    "enforce",
    "ingest",
    "load_isolated",
    "local_session",
    "surrogate_key",
    "tune",
]
