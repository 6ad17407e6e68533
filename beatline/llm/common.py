"""What the operators share: tables cut off in the shared folder, folds, Arrow columns."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import beatline
from beatline.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()
BATCH_BYTES = 8 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, as ``--py-files`` does.

    Also bounds the bytes of an Arrow batch, so that a batch of very long texts stays small."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(beatline.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="beatline-"), "beatline.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("beatline", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder below the one that the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/beatline-llm/{what}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run meanwhile leave no shuffle files: these go when a query ends, not when the driver happens to
    collect its garbage, which in a loop of many small queries comes late."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, what: str) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back: its lineage ends
    there, and a lost executor costs only the tasks that it was running."""
    path = shared_folder(df.sparkSession, what)
    with shuffles_freed(df.sparkSession):
        df.select("*").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table made by :func:`cut` that nothing reads any more."""
    spark, files = df.sparkSession, df.inputFiles()
    path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent() if files else None
    if path is not None:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def _marked(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` with __hit: whether a filter of 2 ** 24 bits, in 2 ** 18 masks of 64 at most that are
    broadcast, has the row's id. False says that the id is not in ``ids``; true that it may be."""
    def place(df: DataFrame) -> DataFrame:
        h = F.xxhash64(key)
        return df.withColumn("__mask", F.pmod(h, F.lit(1 << 18))).withColumn(
            "__bit", F.pmod(F.shiftright(h, 20), F.lit(64)).cast("int"))

    masks = place(ids.select(key).where(F.col(key).isNotNull())).groupBy("__mask").agg(
        F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    hit = F.expr("coalesce((shiftrightunsigned(__bits, __bit) & 1L) = 1, false)")
    return place(rows).join(F.broadcast(masks), "__mask", "left").withColumn("__hit", hit & F.col(key).isNotNull()).drop(
        "__mask", "__bit", "__bits")


def maybe_in(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be in ``ids``, so that most others need no shuffle before an exact join."""
    return _marked(rows, ids, key).where("__hit").drop("__hit")


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not in ``ids`` (null is in none). Only rows that may be in ``ids`` are shuffled."""
    marked = _marked(rows, ids, key)
    sure = marked.where("NOT __hit").drop("__hit")
    return sure.unionByName(marked.where("__hit").drop("__hit").join(ids.select(key), key, "left_anti").select(*rows.columns))


def add_arrays(df: DataFrame, reads: list[str], adds: T.StructType,
               make: Callable[[], Callable[..., list[pa.Array]]], rows: int = 256,
               done: Callable[[], None] | None = None) -> DataFrame:
    """``df`` plus the columns ``adds`` (which replace columns of the same name).

    ``make()`` runs once a task and returns the function that maps the columns ``reads``, at
    most ``rows`` rows of them at a time, to the new columns; ``done()`` runs at its end."""
    ship(df.sparkSession)
    keep = [f for f in df.schema.fields if f.name.lower() not in {a.lower() for a in adds.names}]
    source = df.select(*[F.col(f"`{f.name}`") for f in keep],
                       *[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(reads)])
    schema = T.StructType([*keep, *adds.fields])
    arrow = to_arrow_schema(schema)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                b = batch.slice(i, rows)
                new = each(*b.columns[n:])
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip([*b.columns[:n], *new], arrow)], schema=arrow)
        if done is not None:
            done()
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return source.mapInArrow(run, schema)


def add_columns(df: DataFrame, reads: list[str], adds: T.StructType,
                make: Callable[[], Callable[..., Iterable]]) -> DataFrame:
    """As :func:`add_arrays`, where the function maps lists of values to a row of the new
    columns for each."""
    types = [f.type for f in to_arrow_schema(adds)]

    def make_arrays() -> Callable[..., list[pa.Array]]:
        each = make()

        def arrays(*columns: pa.Array) -> list[pa.Array]:
            made = list(each(*(c.to_pylist() for c in columns)))
            return [pa.array([r[k] for r in made], t) for k, t in enumerate(types)]

        return arrays

    return add_arrays(df, reads, adds, make_arrays)
