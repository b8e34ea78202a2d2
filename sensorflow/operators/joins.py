"""Fact-to-dimension joins with a checked broadcast.

A side is broadcast only if the optimizer's size estimate of it (file and
column sizes; derived tables are estimated high) is below a bound in bytes.
The check reads the plan and runs no job. Above the bound the join is left to
the planner: a shuffle join on the keys, whose hot keys AQE splits and which
AQE may still turn into a broadcast when the real size allows. Either strategy
returns the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df``, in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    return plan_bytes(df) <= max_bytes


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
             max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, fits: bool | None = None) -> DataFrame:
    """Join a large fact to a dimension, broadcasting the dimension when its size is bounded.

    ``how`` is from the fact's point of view (inner / left / left_anti / left_semi),
    so the broadcast side is always the build side. ``fits`` passes a size
    verdict for the table ``dim`` is projected from.
    """
    if fits is None:
        fits = fits_broadcast(dim, max_bytes)
    return fact.join(F.broadcast(dim) if fits else dim, on=on, how=how)


__all__ = ["plan_bytes", "fits_broadcast", "dim_join", "DEFAULT_MAX_BROADCAST_BYTES"]
