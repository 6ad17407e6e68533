"""Grouping sets, rollup and cube from the finest level up.

The rows are aggregated once, by all dimensions. Then one dimension after the other is
given up: each row of the level so far goes on as it is, and once more without that dimension, and
both are merged by what is left. A step at most doubles rows that are already aggregated, where
expanding the facts would multiply all of them by the number of sets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a measure is taken from the rows, and how two parts of it are merged.
MEASURES = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def rollup_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dims[:k]) for k in range(len(dims), -1, -1)]


def cube_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for k in range(len(dims), -1, -1) for s in combinations(dims, k)]


def grouping_levels(facts: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]],
                    measures: Mapping[str, tuple[str, str | Column]] | None = None, level: str = "level") -> DataFrame:
    """``dims`` (NULL where a set leaves one out), ``level`` (bits of the left-out dimensions, the last one the lowest, as
    SQL's GROUPING has it) and the measures, a row for each group of each set.

    ``measures``: name -> (count, sum, min or max; column), by default crime_count. A NULL value of a dimension is a group of
    its own, told apart by ``level``. A repeated set counts once. Without rows there are no groups, the total included."""
    measures = dict(measures or {"crime_count": ("count", F.lit(1))})
    unknown = {d for s in sets for d in s} - set(dims)
    if unknown:
        raise ValueError(f"no dimensions: {sorted(unknown)}")
    bit = {d: 1 << i for i, d in enumerate(reversed(dims))}
    wanted = {sum(bit[d] for d in dims if d not in s) for s in sets}
    out = facts.groupBy(*dims).agg(*[MEASURES[kind][0](c).alias(m) for m, (kind, c) in measures.items()])
    out = out.withColumn(level, F.lit(0).cast("long"))
    done = 0
    for d in reversed(dims):
        done |= bit[d]
        ways = {w & done for w in wanted}  # the levels on the way to a set, as far as the dimensions are decided
        gone = F.explode(F.array(F.lit(0).cast("long"), F.lit(bit[d]).cast("long")))
        halves = out.withColumn("__gone", gone).withColumn(level, F.col(level) + F.col("__gone")).where(F.col(level).isin(*ways))
        kept = [F.when(F.col("__gone") == 0, F.col(d)).alias(d) if c == d else F.col(c) for c in dims]
        out = halves.select(*kept, level, *measures).groupBy(*dims, level).agg(
            *[MEASURES[kind][1](m).alias(m) for m, (kind, _) in measures.items()])
    return out.select(*dims, level, *measures)
