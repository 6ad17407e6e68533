"""Join strategies.

Every join here is an equi-join of facts, counted per key beforehand where a key may be
hot, with a dimension. ``auto`` leaves the choice to Spark: it broadcasts a side by the
bytes it knows, at planning or, adaptively, at run time, and beyond that limit sorts and
merges, splitting skewed partitions. No function here runs a job.
"""

from __future__ import annotations

import logging
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

Strategy = Literal["auto", "broadcast", "merge", "shuffle_hash"]
STRATEGIES: tuple[str, ...] = ("auto", "broadcast", "merge", "shuffle_hash")

# Bytes that a side asked to be broadcast may have by Spark's estimate.
BROADCAST_BYTES = 256 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the table's size, from file sizes and the plan (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def with_strategy(small: DataFrame, strategy: str | None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark the small (build) side of a join with a strategy.

    ``auto``: Spark's choice by bytes. ``broadcast``: broadcast if the estimate
    allows, else Spark's choice. ``merge``: sort-merge join. ``shuffle_hash``:
    shuffled hash join that builds its table from this side. Pairwise
    strategies (shuffle-replicate nested loop, cartesian) are refused: every
    join here is an equi-join.
    """
    strategy = strategy or "auto"
    if strategy == "broadcast":
        size = estimated_bytes(small)
        if size <= max_bytes:
            return F.broadcast(small)
        log.warning("side has about %d bytes: left to the planner instead of broadcast", size)
        return small
    if strategy in ("merge", "shuffle_hash"):
        return small.hint(strategy)
    if strategy == "auto":
        return small
    raise ValueError(f"unknown or refused join strategy {strategy!r}; use one of {STRATEGIES}")


def join_dim(facts: DataFrame, dim: DataFrame, on: list[str] | Column, how: str = "inner",
             strategy: str | None = "auto", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join facts to a dimension under a strategy, whose hint goes on the dimension."""
    return facts.join(with_strategy(dim, strategy, max_bytes), on, how)
