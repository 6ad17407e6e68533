"""What changed between two releases of a table, and bringing a stored copy up to date.

Each row gets a digest of all its values in which NULL differs from every text; each release is
summed by key to the number of its rows and two sums over their digests, so a key with repeated rows is compared
without listing them and whatever their order. One full outer equi-join of these narrow rows tells the changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ADDED, REMOVED, ALTERED = "added", "removed", "altered"


def _value_text(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(c)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"column {field.name}: only plain types can be compared")
    return c.cast("string")


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-256 (hex) over the values, each with its length, so that neither NULLs nor neighbouring columns mix."""
    fields = [df.schema[c] for c in (df.columns if columns is None else columns)]
    texts = [_value_text(f) for f in fields]
    return F.sha2(F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]), 256)


def _state(df: DataFrame, key: Sequence[str], columns: Sequence[str], side: str) -> DataFrame:
    digest = row_digest(df, columns)
    halves = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(19,0)") for at in (1, 16)]
    return df.select(*[F.col(f"`{k}`").alias(f"{side}{i}") for i, k in enumerate(key)], *[h.alias(f"__h{j}") for j, h in enumerate(halves)]).groupBy(
        *[f"{side}{i}" for i in range(len(key))]).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum("__h0").alias("h0"), F.sum("__h1").alias("h1")).alias(f"{side}state"))


def change_set(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """``key`` and ``change`` (added, removed, altered) of each key whose rows are not the same in both releases.

    Columns are compared by name and both releases must have the same ones. A NULL in a key equals a NULL. Several
    rows of one key are compared as a bag: their order doesn't matter, their number does."""
    columns = sorted(old.columns)
    if columns != sorted(new.columns):
        raise ValueError(f"releases differ in columns: {sorted(set(old.columns) ^ set(new.columns))}")
    a, b = _state(old, key, columns, "__old"), _state(new, key, columns, "__new")
    same = F.lit(True)
    for i in range(len(key)):
        same = same & F.col(f"__old{i}").eqNullSafe(F.col(f"__new{i}"))
    change = (F.when(F.col("__oldstate").isNull(), ADDED).when(F.col("__newstate").isNull(), REMOVED)
              .when(F.col("__oldstate") != F.col("__newstate"), ALTERED))
    met = a.join(b, same, "full").withColumn("change", change).where("change IS NOT NULL")
    return met.select(*[F.when(F.col("__newstate").isNull(), F.col(f"__old{i}")).otherwise(F.col(f"__new{i}")).alias(k)
                        for i, k in enumerate(key)], "change")


def touched_values(old: DataFrame, new: DataFrame, changes: DataFrame, key: Sequence[str], part: Column) -> DataFrame:
    """The distinct values of ``part`` that a changed row has had or has now, as ``part``."""
    both = old.select(*key, part.alias("part")).unionByName(new.select(*key, part.alias("part")))
    on = [F.col(f"__c{i}").eqNullSafe(F.col(f"`{k}`")) for i, k in enumerate(key)]
    return both.join(changes.select(*[F.col(f"`{k}`").alias(f"__c{i}") for i, k in enumerate(key)]), on, "left_semi").select("part").distinct()
