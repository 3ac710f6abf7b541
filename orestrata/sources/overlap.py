"""Independent jobs submitted side by side, so that none leaves the cluster idle."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

Result = TypeVar("Result")

PARALLELISM = 8


def overlap(
    steps: Mapping[str, Callable[[], Result]], parallelism: int = PARALLELISM
) -> dict[str, Result]:
    """Run all steps and return their results by name; the first error is raised."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = {name: pool.submit(copy_context().run, step) for name, step in steps.items()}
        return {name: future.result() for name, future in futures.items()}
