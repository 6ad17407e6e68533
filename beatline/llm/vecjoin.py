"""Near-duplicates of vectors by an epsilon grid order join.

Vectors of one label link when their cosine reaches the threshold, which for unit vectors
is a distance of at most epsilon. Equal vectors become one node with a number of copies.
The leading principal directions of all nodes (their second moments are summed over the
whole table) give each node a cell of a grid of width epsilon; the nodes are sorted by
cell, dimension by dimension, and cut into blocks of neighbours. The sequence of blocks is
joined with itself by recursion over intervals of it: intervals whose bounding boxes
are further apart than epsilon are skipped with all they hold, the others are split until
blocks remain. Each pair of blocks left is compared in one matrix product in double
precision, and gives for each node its number of links and the smallest node it is tied
to, never the pairs themselves. Components come from those ties.

Defined results: vectors that are null, empty or zero, or hold null, NaN or infinite parts, and
those without label, link with nothing; vectors of different length don't link; a row
without vec_id takes no part, is kept and has no component; repeated rows link with each
other; an empty table stays empty; columns with the names of the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import cut, ship
from beatline.llm.components import components

#: Principal dimensions of the grid, vectors of a block, and children of an interval (a power of two).
AXES, BLOCK, FAN_BITS = 8, 512, 3


def usable(vec: str) -> Column:
    v = F.col(f"`{vec}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def unit(rows: list) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square overflows."""
    x = np.array(rows, float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def axes_of(nodes: DataFrame) -> dict[int, np.ndarray]:
    """The leading principal directions, for each length of vectors, from sums over all nodes."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            by: dict[int, list] = {}
            for v in b.column(0).to_pylist():
                by.setdefault(len(v), []).append(v)
            for d, rows in by.items():
                x = np.column_stack([unit(rows), np.ones(len(rows))])
                held[d] = held.get(d, 0) + x.T @ x
        for d, m in held.items():
            yield pa.RecordBatch.from_pydict({"length": pa.array([d] * m.size, pa.int32()),
                                              "place": pa.array(np.arange(m.size), pa.int32()), "value": m.ravel()})

    parts = nodes.select("vec").mapInArrow(sums, "length int, place int, value double")
    found: dict[int, np.ndarray] = {}
    # (length + 1) squared numbers for each length of vectors, whatever their number.
    for d, place, value in parts.groupBy("length", "place").agg(F.sum("value")).collect():
        found.setdefault(d, np.zeros((d + 1) ** 2))[place] = value
    out = {}
    for d, m in found.items():
        m = m.reshape(d + 1, d + 1)
        mean = m[d, :d] / m[d, d]
        values, vectors = np.linalg.eigh(m[:d, :d] / m[d, d] - np.outer(mean, mean))
        out[d] = np.ascontiguousarray(vectors[:, ::-1][:, :AXES])
    return out


def placed(nodes: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """Adds spot (coordinates on the axes) and cell (of the grid)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spots = []
            for v in b.column(0).to_pylist():
                spot = (unit([v]) @ axes[len(v)])[0]
                spots.append(np.pad(spot, (0, AXES - len(spot))))
            x = np.array(spots).reshape(len(spots), AXES)
            yield pa.RecordBatch.from_pydict({
                "vec": b.column(0), "label": b.column(1), "id": b.column(2), "copies": b.column(3),
                "spot": pa.array(x.tolist(), pa.list_(pa.float64())),
                "cell": pa.array(np.floor(x / eps).astype(int).tolist(), pa.list_(pa.int32()))})

    return nodes.select("vec", "label", "id", "copies").mapInArrow(
        run, "vec array<double>, label string, id long, copies long, spot array<double>, cell array<int>")


LOW, HIGH = [f"low{k}" for k in range(AXES)], [f"high{k}" for k in range(AXES)]
BLOCKS = ("length int, label string, p int, q int, ids array<long>, copies array<long>, vectors binary, "
          + ", ".join(f"{c} double" for c in LOW + HIGH))


def blocks(spots: DataFrame) -> DataFrame:
    """The nodes in grid order, cut into blocks: p is the range partition, q the place in it."""
    order = [F.size("vec").alias("length"), "label", "cell", "id"]
    ordered = spots.select("*", order[0]).repartitionByRange("length", "label", "cell", "id").sortWithinPartitions(
        "length", "label", "cell", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, q, held, kind = TaskContext.get().partitionId(), 0, [], None

        def out() -> pa.RecordBatch:
            x = np.array([r[4] for r in held])
            box = {c: [v] for c, v in zip(LOW + HIGH, [*x.min(axis=0).tolist(), *x.max(axis=0).tolist()])}
            return pa.RecordBatch.from_pydict({
                "length": pa.array([kind[0]], pa.int32()), "label": [kind[1]], "p": pa.array([p], pa.int32()),
                "q": pa.array([q], pa.int32()), "ids": [[r[2] for r in held]], "copies": [[r[3] for r in held]],
                "vectors": pa.array([unit([r[0] for r in held]).tobytes()], pa.binary()), **box})

        for b in batches:
            for vec, label, i, n, spot, length in zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 6))):
                if held and ((length, label) != kind or len(held) == BLOCK):
                    yield out()
                    q, held = q + 1, []
                kind = (length, label)
                held.append((vec, label, i, n, spot))
        if held:
            yield out()

    return ordered.mapInArrow(run, BLOCKS)


def near_blocks(made: DataFrame, eps: float) -> DataFrame:
    """The pairs of blocks (p, q, p2, q2), the first not after the second, whose boxes are within
    epsilon: a join of the sequence with itself, interval by interval from the top."""
    heads = made.select("length", "label", "p", "q", *LOW, *HIGH)
    last = heads.agg(F.max("p").alias("p"), F.max("q").alias("q")).first()
    if last["p"] is None:
        return made.sparkSession.createDataFrame([], "length int, label string, p int, q int, p2 int, q2 int")
    within = -(-max(1, last["q"].bit_length()) // FAN_BITS)
    above = -(-max(1, last["p"].bit_length()) // FAN_BITS)

    def interval(level: int) -> tuple[Column, Column]:
        """The interval of a block: by its place in the partition first, then by partition."""
        if level <= within:
            return F.col("p"), F.shiftright("q", level * FAN_BITS)
        return F.shiftright("p", (level - within) * FAN_BITS), F.lit(0)

    def boxes(level: int) -> DataFrame:
        (p, q), (up, uq) = interval(level), interval(level + 1)
        return heads.groupBy("length", "label", p.alias("p_"), q.alias("q_"), up.alias("up"), uq.alias("uq")).agg(
            *[F.min(c).alias(c) for c in LOW], *[F.max(c).alias(c) for c in HIGH])

    def side(level: int, mark: str) -> DataFrame:
        b = boxes(level)
        return b.select("length", "label", F.col("p_").alias(f"p{mark}"), F.col("q_").alias(f"q{mark}"),
                        F.col("up").alias(f"up{mark}"), F.col("uq").alias(f"uq{mark}"),
                        *[F.col(c).alias(c + mark) for c in LOW + HIGH])

    top = within + above
    p, q = interval(top)
    pairs = heads.select("length", "label", p.alias("up1"), q.alias("uq1"), p.alias("up2"), q.alias("uq2")).distinct()
    for level in range(top - 1, -1, -1):
        gap = sum((F.greatest(F.lit(0.0), F.col(f"{lo}1") - F.col(f"{hi}2"), F.col(f"{lo}2") - F.col(f"{hi}1")) ** 2
                   for lo, hi in zip(LOW, HIGH)), F.lit(0.0))
        ahead = (F.col("p1") < F.col("p2")) | (F.col("p1") == F.col("p2")) & (F.col("q1") <= F.col("q2"))
        kept = (pairs.join(side(level, "1"), ["length", "label", "up1", "uq1"])
                .join(side(level, "2"), ["length", "label", "up2", "uq2"])
                .where(ahead & (gap <= eps * eps * (1 + 1e-9) + 1e-12)))
        pairs = kept.select("length", "label", F.col("p1").alias("up1"), F.col("q1").alias("uq1"),
                            F.col("p2").alias("up2"), F.col("q2").alias("uq2"))
    return pairs.select("length", "label", F.col("up1").alias("p"), F.col("uq1").alias("q"),
                        F.col("up2").alias("p2"), F.col("uq2").alias("q2"))


def compare(a: np.ndarray, b: np.ndarray, same: bool, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of ``a`` and ``b`` link, and the smallest index (those of ``b`` after those of ``a``)
    that each of both is tied to."""
    link = a @ b.T >= least
    if same:
        np.fill_diagonal(link, False)
    n = len(a)
    tie = np.arange(n + len(b))
    if same:
        tie[n:] = tie[:n]
    rows, cols = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
    part = link[np.ix_(rows, cols)]
    far = len(tie)
    while len(rows):
        before = tie.copy()
        tie[rows] = np.minimum(tie[rows], np.where(part, tie[n + cols][None], far).min(axis=1))
        tie[n + cols] = np.minimum(tie[n + cols], np.where(part, tie[rows][:, None], far).min(axis=0))
        if same:
            tie[:n] = tie[n:] = np.minimum(tie[:n], tie[n:])
        if (tie == before).all():
            break
    return link, tie[:n], tie[n:]


def joined(made: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """id, links (vectors of other nodes, copies counted) and tie (a node of the same component)
    for each node of each pair of blocks that links."""
    parts = ["ids", "copies", "vectors"]
    first = made.select("length", "label", "p", "q", *parts)
    second = made.select("length", "label", F.col("p").alias("p2"), F.col("q").alias("q2"),
                         *[F.col(c).alias(c + "2") for c in parts])
    both = pairs.join(first, ["length", "label", "p", "q"]).join(second, ["length", "label", "p2", "q2"]).select(
        "length", *parts, *[c + "2" for c in parts], ((F.col("p") == F.col("p2")) & (F.col("q") == F.col("q2"))).alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {name: batch.column(j)[k] for j, name in enumerate(batch.schema.names)}
                same, d = r["same"].as_py(), r["length"].as_py()
                a, b = (np.frombuffer(r[c].as_py(), float).reshape(-1, d) for c in ("vectors", "vectors2"))
                ids = [np.asarray(r[c].values) for c in ("ids", "ids2")]
                copies = [np.asarray(r[c].values) for c in ("copies", "copies2")]
                link, tie_a, tie_b = compare(a, b, same, least)
                every = np.concatenate(ids)
                out = [(ids[0], link @ copies[1], every[tie_a])]
                if not same:
                    out.append((ids[1], link.T @ copies[0], every[tie_b]))
                for i, n, t in out:
                    has = n > 0
                    yield pa.RecordBatch.from_arrays([pa.array(x[has]) for x in (i, n, t)], ["id", "links", "tie"])

    return both.mapInArrow(run, "id long, links long, tie long")


def near_vectors(df: DataFrame, least: float = 0.98, vec_id: str = "vec_id", vec: str = "embedding",
                 label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept for each row."""
    ship(df.sparkSession)
    eps = float(np.sqrt(2 - 2 * least))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"),
                     F.col(f"`{vec}`").cast("array<double>").alias("vec"))
    able = rows.select("vec_id", F.when(usable("vec") & F.col("vec_id").isNotNull(), F.col("label")).alias("label"), "vec")
    nodes = cut(able.where("label IS NOT NULL").groupBy("label", "vec").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors")
    made = cut(blocks(placed(nodes, axes_of(nodes), eps)), "blocks")
    ties = cut(joined(made, cut(near_blocks(made, eps), "block-pairs"), least), "ties")
    found = components(ties, "id", "tie")
    links = ties.groupBy("id").agg(F.sum("links").alias("links"))
    named = found.select(F.col("node").alias("id"), "component")
    result = nodes.join(links, "id", "left").join(named, "id", "left").select(
        "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component"))
    component = F.coalesce("component", "vec_id")
    return able.withColumn("hash", F.xxhash64("vec")).join(
        result.withColumn("hash", F.xxhash64("vec")), ["label", "hash", "vec"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
