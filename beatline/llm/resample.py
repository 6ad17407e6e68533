"""Importance resampling towards a target corpus by hashed n-grams.

Features are the runs of 1 to ``grams`` consecutive words, put into buckets by their crc32. Where the
target's share of a bucket is above the source's, the bucket's gain is positive, and a document's
weight is the mean gain of its features. With one Gumbel variate a document, made from its id by a hash, the
highest sums of weight and variate are a sample without replacement in proportion to
exp(weight); a share of the documents that are long enough is drawn so.

The counts of a task are one array of buckets, added up by Spark; the gains are one array that goes
to every task (as long as the number of buckets, a parameter), and a document's weight is a sum over it.

The cutoff comes from a quantile sketch of the scores: two quantiles around the wanted share are a
bracket. The exact number of documents above it and in it tells whether it holds the cutoff; if
not, or if the sketch was off, the bracket is widened and counted again. Only the bracket is
sorted to find the last document that is drawn. Ranks come from a distributed
sort of the drawn documents: range partitions, counted one by one, and the places in them.

Defined results: null and empty texts have no features, weight 0, and are too short to be drawn; a null
id is hashed as empty text and comes last among ties; rows with equal score and id are drawn in
the order of an arbitrary number that they get once; an empty table stays empty; an empty target gives gains
from the added ones alone; columns with the names of the new ones are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.llm.common import add_arrays, cut, ship

GRAMS, BUCKETS, LEAST_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7
#: Accuracy of the sketch (its error is 1 / this, as a share of the rows) and half the bracket's width.
ACCURACY, MARGIN = 1000, 0.004
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text: bytes | None, grams: int, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every feature."""
    words = _WORD.findall((text or b"").lower())  # lower() of bytes changes A-Z only
    n = len(words)
    joined, found = b" ".join(words), []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]) if n else ends
    starts, ends = starts.tolist(), ends.tolist()
    crc = zlib.crc32
    for k in range(min(grams, n)):
        parts = words if k == 0 else [joined[a:b] for a, b in zip(starts, ends[k:])]
        found.append(np.fromiter(map(crc, parts), np.int64, n - k))
    return n, np.concatenate(found) % buckets if found else np.zeros(0, np.int64)


def _raw(df: DataFrame, text: str) -> Column:
    return F.col(f"`{text}`").cast("binary")


def bucket_counts(df: DataFrame, text: str, grams: int, buckets: int) -> DataFrame:
    """bucket and n: how many features of all texts fall into each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            for t in b.column(0):
                n += np.bincount(features(t.as_py(), grams, buckets)[1], minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["bucket", "n"])

    ship(df.sparkSession)
    made = df.select(_raw(df, text).alias("text")).mapInArrow(run, "bucket int, n long")
    return made.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, text: str, grams: int, buckets: int) -> np.ndarray:
    """floor(1000 * ln(target share / source share)) of each bucket, with one added to each."""
    s = bucket_counts(source, text, grams, buckets).withColumnRenamed("n", "s")
    t = bucket_counts(target, text, grams, buckets).withColumnRenamed("n", "t")
    both = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(s, "bucket", "left").join(
        t, "bucket", "left").select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"])
    out = np.zeros(buckets, np.int64)
    rows = both.collect()  # a row for each bucket
    big_s, big_t = (sum(r[c] for r in rows) + buckets for c in "st")
    for r in rows:
        out[r["bucket"]] = int(np.floor(1000 * np.log((r["t"] + 1) * big_s / ((r["s"] + 1) * big_t))))
    return out


NEW = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")])


def weighed(df: DataFrame, gain: np.ndarray, text: str, grams: int) -> DataFrame:
    """Adds n_words, n_features and weight, the floored mean of the gains of the features."""
    buckets = len(gain)
    handed = df.sparkSession.sparkContext.broadcast(gain)  # as long as the number of buckets

    def make():
        own = handed.value

        def each(texts: pa.Array) -> list[pa.Array]:
            made = []
            for t in texts:
                n, found = features(t.as_py(), grams, buckets)
                made.append((n, len(found), int(own[found].sum()) // max(1, len(found))))
            return [pa.array([m[i] for m in made], pa.int64()) for i in range(3)]

        return each

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in NEW.names]
    return add_arrays(df.select(*kept, _raw(df, text).alias("__raw")), ["__raw"], NEW, make).drop("__raw")


def gumbel(doc_id: str, seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))), u from the first 32 bits of the sha256 of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(float(1 << 32)))))


ORDER = (F.desc, "score"), (F.asc_nulls_last, "id"), (F.asc, "row")


def numbered(rows: DataFrame, what: str) -> DataFrame:
    """``rows`` with their place (1, 2, ...) by score downwards, then id, then row: sorted in range
    partitions, written with a number that holds partition and place, and counted by partition."""
    order = [f(c) for f, c in ORDER]
    laid = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "at", F.monotonically_increasing_id()), what)
    laid = laid.withColumn("part", F.shiftright("at", 33))
    sizes = laid.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row for each partition
    return laid.join(F.broadcast(before), "part").select(
        *rows.columns, (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).alias("place"))


def bracket(scores: DataFrame, wanted: int, total: int, margin: float = MARGIN) -> tuple[int | None, int | None, int]:
    """low, high (null: none) and how many scores lie above high, so that the ``wanted``-th highest
    score lies between them: quantiles of a sketch, held against exact counts and widened until they do."""
    share = 1 - wanted / total
    while True:
        a, b = max(0.0, share - margin), min(1.0, share + margin)
        low, high = scores.agg(F.percentile_approx("score", [a, b], ACCURACY).alias("q")).first()["q"]
        low, high = None if a == 0 else low, None if b == 1 else high
        above = F.lit(False) if high is None else F.col("score") > high
        inside = ~above & (F.lit(True) if low is None else F.col("score") >= low)
        n_above, n_inside = scores.agg(F.count_if(above), F.count_if(inside)).first()
        if n_above < wanted <= n_above + n_inside:
            return low, high, n_above
        margin *= 4


def drawn(scored: DataFrame, wanted: int, total: int) -> DataFrame:
    """The ``wanted`` first rows of ``scored`` (score, id, row) by score downwards, then id, then row."""
    if wanted <= 0:
        return scored.limit(0)
    low, high, above = bracket(scored, wanted, total)
    inside = scored
    if low is not None:
        inside = inside.where(F.col("score") >= low)
    if high is not None:
        inside = inside.where(F.col("score") <= high)
    last = numbered(inside, "bracket").where(F.col("place") == wanted - above).select("score", "id", "row").first()
    same_id = F.lit(last["id"]).cast("long")
    later = F.when(same_id.isNull(), F.lit(False)).otherwise(F.coalesce(F.col("id") > same_id, F.lit(True)))
    here = F.col("id").eqNullSafe(same_id)
    return scored.where((F.col("score") > last["score"]) | (F.col("score") == last["score"]) & (
        here & (F.col("row") <= last["row"]) | ~here & ~later))


def resample(df: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, text: str = "text",
             doc_id: str = "doc_id", grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null for rows that are not drawn) of all rows:
    of those with ``least_words`` words ``percent`` are drawn to look like the texts of ``target``."""
    gain = gains(df, target, text, grams, buckets)
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    scored = weighed(rows, gain, "text", grams).select(
        "id", "n_words", "n_features", "weight", (F.col("weight") + gumbel("id", seed)).alias("score"))
    scored = cut(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    able = scored.where(F.col("n_words") >= least_words).select("score", "id", "row")
    total = able.count()
    ranks = numbered(drawn(able, percent * total // 100, total), "drawn").select("row", F.col("place").alias("rank"))
    return scored.join(ranks, "row", "left").select(
        F.col("id").alias("doc_id"), "n_words", "n_features", "weight", "score", "rank")
