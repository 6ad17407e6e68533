"""Exact top-k search by inner product with the three-phase uniform threshold method.

The components of the vectors are cut into LISTS slices. A slice is a list: it gives each
candidate a local score, the inner product of its slice, and the scores of all lists add up to the
candidate's score.

1. Gather: of each list the k best local scores of each query are taken, and the candidates found
   so are scored whole. The k-th best of their scores is the query's threshold: at least k
   candidates reach it, so no result lies below it.
2. Cutoff: a candidate whose lists all stay below threshold / LISTS can't reach the threshold,
   whatever the signs. The thresholds travel with the queries, and each list gives the entries that
   reach this cutoff.
3. Resolve: an entry's lists that have not given it are bounded by the cutoff. Where the
   bound reaches the best threshold known by then, the missing local scores are added and the
   score is exact.

Queries and candidates are laid out in blocks. A cell holds all pairs of some blocks of queries and some of
candidates, and is an equi-join by its number; each block is copied to the cells of its row or
column only. Pairs of blocks become one matrix product a list, in a task that keeps the k
best of each query and gives no more than these for each cell. What cells give is merged by a
window with a limit of k, which Spark applies before its shuffle. Nothing is broadcast or
collected but the number of blocks of each length.

Scores are exact integers: products in double precision as long as they stay below 2 ** 53,
in Python's integers beyond; scores outside 64 bits become the nearest 64-bit value.

Defined results: vectors that are null or empty, or hold null or non-finite components, and
rows without id take no part; vectors meet those of their own length only; a query finds all rows but
its own, so a repeated row finds its twin; repeated queries have results each; ties go to
the smaller id; with fewer than k candidates all are found; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.llm.common import cut, ship

LISTS = 4
#: Numbers in a block of candidates and of queries, and pairs of blocks in a cell (some minutes of work).
CANDIDATES, QUERIES, CELL = 1 << 17, 1 << 15, 1 << 13
EXACT = float(1 << 53)
NONE = int(np.iinfo(np.int64).min)


def whole(vec: str, scale: float) -> Column:
    """The components as whole numbers, floor(scale * x), in doubles; null if the vector takes no part."""
    v = F.col(f"`{vec}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    # floor() of a double is a long in Spark; beyond 2 ** 53 doubles have no fractions.
    return F.when(fine & (F.size(v) > 0), F.transform(v, lambda x: F.when(
        F.abs(x * scale) < EXACT, F.floor(x * scale).cast("double")).otherwise(x * scale)))


def blocks(rows: DataFrame, numbers: int, extra: bool) -> DataFrame:
    """length, rows, ids, vectors (and bounds, with ``extra``) of blocks of neighbouring rows of one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(d: int) -> pa.RecordBatch:
            part = held.pop(d)
            made = {"length": pa.array([d], pa.int32()), "rows": pa.array([[r[0] for r in part]], pa.list_(pa.int64())),
                    "ids": pa.array([[r[1] for r in part]], pa.list_(pa.int64())),
                    "vectors": pa.array([np.array([r[2] for r in part], float).tobytes()], pa.binary())}
            if extra:
                made["bounds"] = pa.array([[NONE if r[3] is None else r[3] for r in part]], pa.list_(pa.int64()))
            return pa.RecordBatch.from_pydict(made)

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                d = len(r[2])
                held.setdefault(d, []).append(r)
                if len(held[d]) * d >= numbers:
                    yield out(d)
        for d in list(held):
            yield out(d)

    columns = ["row", "id", "vec"] + ["bound"] * extra
    return rows.select(*columns).mapInArrow(run, "length int, rows array<long>, ids array<long>, vectors binary"
                                            + ", bounds array<long>" * extra)


def counts(made: DataFrame) -> dict[int, int]:
    """The number of blocks for each length of vectors."""
    return {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}


def cells(queries: DataFrame, candidates: DataFrame, q: dict[int, int], c: dict[int, int], tasks: int) -> DataFrame:
    """All pairs of blocks of one length: a join of cells, of which each block is in one row or column.
    Cells hold at most CELL pairs, and are so many that ``tasks`` tasks have work."""
    sides = []
    for d in q:
        pairs = q[d] * c.get(d, 0)
        size = max(1, min(CELL, pairs // (2 * tasks)))
        wide = max(1, min(c.get(d, 1), round((size * QUERIES / CANDIDATES) ** 0.5)))  # about as many numbers from both sides
        sides.append((d, -(-c.get(d, 1) // wide), -(-q[d] // max(1, size // wide))))
    if not sides:
        sides = [(0, 1, 1)]
    shape = F.create_map(*[x for d, across, down in sides for x in (
        F.lit(d), F.struct(F.lit(across).alias("across"), F.lit(down).alias("down")))])
    of = F.try_element_at(shape, F.col("length"))
    spread = F.xxhash64("rows")
    left = queries.withColumn("of", of).select("*", F.pmod(spread, "of.down").cast("int").alias("y"), F.explode(
        F.sequence(F.lit(0), F.col("of.across") - 1)).alias("x")).drop("of")
    right = candidates.withColumn("of", of).where("of IS NOT NULL").select(
        "length", F.col("rows").alias("rows2"), F.col("ids").alias("ids2"), F.col("vectors").alias("vectors2"),
        F.pmod(spread, "of.across").cast("int").alias("x"), F.explode(F.sequence(F.lit(0), F.col("of.down") - 1)).alias("y"), "of").drop("of")
    return left.join(right.hint("merge"), ["length", "x", "y"])  # the pairs of a cell come one after the other


def slices(d: int, lists: int) -> list[slice]:
    edge = [round(i * d / lists) for i in range(lists + 1)]
    return [slice(a, b) for a, b in zip(edge, edge[1:]) if a < b]


def local_scores(a: np.ndarray, b: np.ndarray, lists: int) -> list[np.ndarray]:
    """A matrix of local scores for each list, whole numbers: int64, or objects where these could overflow."""
    top = [max(1.0, np.abs(m).max()) for m in (a, b)]
    size = top[0] * top[1] * a.shape[1]
    parts = slices(a.shape[1], lists)
    if size < EXACT:
        return [(a[:, s] @ b[:, s].T).astype(np.int64) for s in parts]
    a, b = (np.array([[int(x) for x in r] for r in m], object) for m in (a, b))
    return [a[:, s] @ b[:, s].T for s in parts]


class Best:
    """The k best candidates (score, id, row) of each query of one block, as far as it has been scored."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, n
        self.query = np.zeros(0, np.int64)
        self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, i: np.ndarray, row: np.ndarray) -> None:
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        i, row = np.concatenate([self.id, i]), np.concatenate([self.row, row])
        order = np.lexsort((row, i, ~score, query))
        query, score, i, row = query[order], score[order], i[order], row[order]
        again = np.zeros(len(query), bool)  # the same candidate from several lists
        again[1:] = (query[1:] == query[:-1]) & (row[1:] == row[:-1])
        query, score, i, row = query[~again], score[~again], i[~again], row[~again]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        self.query, self.score, self.id, self.row = query[kept], score[kept], i[kept], row[kept]

    def bound(self) -> np.ndarray:
        """For each query the k-th best score, or the least number if there are fewer."""
        out = np.full(self.n, NONE)
        last = np.searchsorted(self.query, np.arange(self.n), side="left") + self.k - 1
        has = last < len(self.query)
        has[has] = self.query[last[has]] == np.flatnonzero(has)
        out[has] = self.score[last[has]]
        return out


def gathered(parts: list[np.ndarray], own: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: query and candidate numbers of the k best of each list."""
    n, m = parts[0].shape
    rows, cols = [], []
    for local in parts:
        local = local.astype(float)
        local[own] = -np.inf
        top = np.argpartition(-local, k - 1, axis=1)[:, :k] if k < m else np.broadcast_to(np.arange(m), (n, m))
        rows.append(np.repeat(np.arange(n), top.shape[1]))
        cols.append(top.ravel())
    at = np.unique(np.concatenate(rows) * m + np.concatenate(cols))
    own_at = own[0] * m + own[1]
    at = at[~np.isin(at, own_at)]
    return at // m, at % m


def sufficient(parts: list[np.ndarray], own: tuple[np.ndarray, np.ndarray], cutoff: np.ndarray,
               now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phases 2 and 3: the pairs of which a list reaches ``cutoff`` / lists, and whose bound reaches ``now``."""
    m = len(parts)
    all_of = cutoff == NONE  # fewer candidates than asked for: each of them is a result
    share = -(-np.where(all_of, 0, cutoff) // m)  # whole numbers: at least cutoff / m, rounded up
    given = np.repeat(all_of[:, None], parts[0].shape[1], axis=1)
    for local in parts:
        given |= (local >= share[:, None]).astype(bool)
    given[own] = False
    rows, cols = np.nonzero(given)
    each = np.array([local[rows, cols] for local in parts])
    upper = np.where(each >= share[rows], each, share[rows] - 1).sum(axis=0)  # without an entry a list stays below
    left = all_of[rows] | (upper >= now[rows]).astype(bool)
    return rows[left], cols[left]


def searched(pairs: DataFrame, k: int, lists: int, final: bool) -> DataFrame:
    """row (of the query), id, row2 and score: the k best that each cell knows of after phase 1, or,
    with the queries' bounds, after all phases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, kept = None, {}

        def out() -> Iterator[pa.RecordBatch]:
            for rows, ids, best in kept.values():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    rows[best.query], ids[best.query], best.id, best.row, best.score)], ["row", "query_id", "id", "row2", "score"])

        for batch in batches:
            for j in range(batch.num_rows):
                r = {name: batch.column(i)[j] for i, name in enumerate(batch.schema.names)}
                now = tuple(r[c].as_py() for c in ("length", "x", "y"))
                if now != cell:
                    yield from out()
                    cell, kept = now, {}
                d = now[0]
                rows, ids, rows2, ids2 = (np.asarray(r[c].values) for c in ("rows", "ids", "rows2", "ids2"))
                a, b = (np.frombuffer(r[c].as_py(), float).reshape(-1, d) for c in ("vectors", "vectors2"))
                _, _, best = kept.setdefault(int(rows[0]), (rows, ids, Best(len(rows), k)))
                _, qi, ci = np.intersect1d(rows, rows2, return_indices=True)
                parts = local_scores(a, b, lists)
                if final:
                    bounds = np.asarray(r["bounds"].values)
                    at = sufficient(parts, (qi, ci), bounds, np.maximum(bounds, best.bound()))
                else:
                    at = gathered(parts, (qi, ci), k)
                score = sum(local[at] for local in parts)
                if score.dtype == object:
                    score = np.array([min(max(s, NONE), -NONE - 1) for s in score], np.int64)
                if final:  # what stays below the threshold is no result
                    reach = score >= bounds[at[0]]
                    at, score = (at[0][reach], at[1][reach]), score[reach]
                best.add(at[0], score, ids2[at[1]], rows2[at[1]])
        yield from out()

    return pairs.mapInArrow(run, "row long, query_id long, id long, row2 long, score long")


def leading(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, with their rank."""
    order = Window.partitionBy("row").orderBy(F.desc("score"), "id", "row2")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(df: DataFrame, queries: Column, k: int = 5, scale: float = 1.0, vec_id: str = "vec_id", vec: str = "embedding",
           lists: int = LISTS) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` best of all other rows for each row that ``queries``
    (a condition on ``df``) picks, by the inner product of floor(``scale`` * components)."""
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), whole(vec, scale).alias("vec"),
                     F.coalesce(queries, F.lit(False)).alias("asks")).where("id IS NOT NULL AND vec IS NOT NULL")
    table = cut(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asking = table.where("asks")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidates = cut(blocks(table, CANDIDATES, False), "candidates")
    first = cut(blocks(asking.withColumn("bound", F.lit(None).cast("long")), QUERIES, True), "queries")
    c, q = counts(candidates), counts(first)
    seen = leading(searched(cells(first, candidates, q, c, tasks), k, lists, False), k)
    bounds = cut(seen.groupBy("row").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).where(
        F.col("n") == k).drop("n"), "bounds")
    second = cut(blocks(asking.join(bounds, "row", "left"), QUERIES, True), "queries")
    found = leading(searched(cells(second, candidates, counts(second), c, tasks), k, lists, True), k)
    return found.select("query_id", F.col("rank").cast("int"), F.col("id").alias("vec_id"), "score")
