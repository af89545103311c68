"""Intermediate tables that several aggregations read: cached (memory, then disk) so that they are computed once.

``with holding() as hold`` gives a function that caches a table; what it cached is freed at the end, so results must be computed
by then.  Each call owns its tables; lost blocks are recomputed from their lineage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

Hold = Callable[[DataFrame], DataFrame]


def as_it_is(df: DataFrame) -> DataFrame:
    """No caching: what a plan reads twice is left to Spark's reuse of exchanges."""
    return df


@contextmanager
def holding() -> Iterator[Hold]:
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        if df.is_cached:
            return df
        held.append(df.persist())
        return held[-1]

    try:
        yield hold
    finally:
        for df in reversed(held):
            df.unpersist()
