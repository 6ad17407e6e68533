"""Near-duplicates of texts by MinHash: many universal hash minima, banding, verification
of signatures and of full sets, and connected components.

A text's set holds the hashes of its distinct word shingles. Texts with the same set are
one node. The minima of BANDS * ROWS universal hash functions are a node's signature, and
nodes that agree in all rows of a band share a bucket. A pair at the threshold of 0.8
misses all buckets in about 3 of a million cases.

No bucket is expanded into all its pairs. First every node of a bucket is compared with the
bucket's center, the node whose buckets have most nodes in all: in a group of near copies that is the
text that the others were made from, or the one most like it. The links found make components; only in buckets
that still hold different components are the nodes outside the bucket's largest component compared with the
others, in blocks of bounded size, where sizes and finer sketches rule pairs out: each of them with the
most alike of another component as long as that ties any, then with all that are left and were not compared
before, so a pair that could tie two components is never left out. The work in a bucket grows with its
nodes times the few that are outside its largest component. A pair is a link when its full sets, made again
from the whole texts, reach the threshold.

Defined results: null texts and texts without words have an empty set and link with
nothing; a text with fewer words than a shingle has one shingle, all its words; rows
without an id take no part and are kept; rows with one id are one node (any of their texts
may link it); equal sets link whatever their size; an empty table stays empty; other
columns of the input are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import cut, discard, maybe_in, shared_folder, ship, shuffles_freed
from beatline.llm.components import components

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Minima of the finer sketches, of which a byte each is kept.
FINE = 2048
#: Nodes of a bucket that are compared in one block, and pairs verified beside one text.
BLOCK, BESIDE = 1024, 256
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def universal(n: int = HASHES, seed: int = 20240) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``n`` hash functions x -> (a * x + b) mod 2**64 >> 32; of their
    minima the low 16 bits are kept, which differ for different minima but for one in 65536."""
    r = np.random.Generator(np.random.PCG64(seed + n))
    a = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, r.integers(0, 1 << 63, n, dtype=np.uint64)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(size, n)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = out * _MIX[0] + h[i:n - k + 1 + i]
        out ^= out >> np.uint64(29)
    return np.unique(out * _MIX[1])


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max)
    step = max(1, 81920 // len(a))
    for i in range(0, len(hashes), step):
        np.minimum(low, (hashes[None, i:i + step] * a[:, None] + b[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype("<u2")


SIGNED = "doc_id long, n_shingles long, set_key binary, minima binary"


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the set, null if empty) and minima of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = universal()
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                sets = [shingles(t, size) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_key": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    "minima": pa.array([signature(s, a, b).tobytes() if len(s) else None for s in sets], pa.binary())})

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SIGNED)


def in_buckets(nodes: DataFrame, *keep: str) -> DataFrame:
    """A row for each node and band: the bucket and the columns ``keep``."""
    width = 2 * ROWS
    key = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(
        i.cast("short").alias("band"), F.xxhash64(F.substring(F.col("minima"), i * width + 1, F.lit(width))).alias("key")))
    return nodes.select(F.explode(key).alias("at"), *keep).select("at.band", "at.key", *keep)


def alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow the threshold; ids of several sets count all."""
    least = agreements(HASHES, percent)
    left = nodes.select(F.col("id").alias("a"), F.col("minima").alias("x"), F.col("n_shingles").alias("m"))
    right = nodes.select(F.col("id").alias("b"), F.col("minima").alias("y"), F.col("n_shingles").alias("n"))
    both = pairs.join(left, "a").join(right, "b").where(100 * F.least("m", "n") >= percent * F.greatest("m", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in batches:
            x, y = (np.frombuffer(b"".join(p.column(k).to_pylist()), "<u2").reshape(-1, HASHES) for k in (2, 3))
            yield p.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= least))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


class Texts:
    """The texts of some ids (id, texts) as a table bucketed by id in the shared folder: they are
    shuffled once, and later joins by id move the other side only."""

    def __init__(self, docs: DataFrame, ids: DataFrame):
        self.spark = spark = docs.sparkSession
        self.name = f"beatline_texts_{uuid.uuid4().hex}"
        rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
        rows = maybe_in(rows, ids, "id").join(ids, "id", "left_semi")
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # grouping deals the rows out as the buckets do
        with shuffles_freed(spark):
            (rows.groupBy("id").agg(F.collect_set("text").alias("texts")).write
             .bucketBy(n, "id").sortBy("id").option("path", shared_folder(spark, "texts")).saveAsTable(self.name))

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forgets the name and deletes the files, which dropping a table with a path of its own leaves."""
        discard(self.table())
        self.spark.sql(f"DROP TABLE {self.name}")


def verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold, made from the ``texts`` (id, texts) of both.

    The text of ``a`` travels once for every BESIDE of its pairs, so a node with very many
    pairs is dealt out; a task reads its rows in order and holds one text's set at a time."""
    salted = pairs.join(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BESIDE).cast("int").alias("parts")), "a").withColumn(
        "salt", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    heads = salted.select("a", "salt").distinct().join(texts.withColumnRenamed("id", "a"), "a").select(
        "a", "salt", F.lit(None).cast("long").alias("b"), "texts")
    tails = salted.select("a", "salt", "b").join(texts.withColumnRenamed("id", "b"), "b").select("a", "salt", "b", "texts")
    dealt = heads.unionByName(tails).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: list[np.ndarray] = []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for a, b, texts in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                sets = [shingles(t, size) for t in texts]
                if b is None:
                    head = sets
                elif any(linked(x, y, percent) for x in head for y in sets):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return dealt.select("a", "salt", "b", "texts").mapInArrow(run, "a long, b long")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(x) + len(y) - common)


def with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (with id) plus the component of each node, which is itself if it has no link."""
    known = found.select(F.col("node").alias("id"), "component")
    return rows.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))


def shared_buckets(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """band, key and id of the nodes of all buckets of several, and band, key and center of these buckets."""
    sizes = in_buckets(nodes, "id").groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut(in_buckets(nodes, "id").join(sizes, ["band", "key"]), "members")
    weight = members.groupBy("id").agg(F.sum("size").alias("weight"))
    centers = members.join(weight, "id").groupBy("band", "key").agg(
        F.max(F.struct("weight", (-F.col("id")).alias("id"))).alias("most")).select(
        "band", "key", (-F.col("most.id")).alias("center"))
    return members.select("band", "key", "id"), cut(centers, "centers")


def unsettled(members: DataFrame, centers: DataFrame, found: DataFrame) -> DataFrame:
    """band, key and id of the nodes, but for its center, of each bucket that holds
    several components; the center has been compared with the others."""
    rows = with_component(members, found)
    mixed = rows.groupBy("band", "key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return rows.join(mixed, ["band", "key"]).join(centers, ["band", "key"]).where("id != center").select("band", "key", "id")


def sketches(rows: DataFrame, nodes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """id, minima, n_shingles and sketch (a byte of each of FINE minima) of the nodes in ``rows``."""
    each = texts.join(rows.select("id").distinct(), "id", "left_semi").select("id", F.explode("texts").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = universal(FINE)
        for batch in batches:
            sets = [shingles(t, size) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0), "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "sketch": [signature(s, a, b).astype(np.uint8).tobytes() for s in sets]})

    made = each.mapInArrow(run, "id long, set_key binary, n_shingles long, sketch binary")
    return made.dropDuplicates(["id", "set_key"]).join(nodes.drop("n_shingles"), ["id", "set_key"]).select(
        "id", "minima", "n_shingles", "sketch")


def across(rows: DataFrame, fine: DataFrame, found: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs of nodes of different components that share a bucket of ``rows``, if sizes and sketches
    allow the threshold; with ``best`` only the most alike, in a block, of each node outside its bucket's
    largest component. A pair comes from the first bucket that it shares."""
    now = with_component(rows, found)
    parts = now.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("components"), F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("most")).where(
        "components > 1").select("band", "key", F.col("most.component").alias("largest"),
                                 F.ceil((F.col("all") - F.col("most.n")) / BLOCK).cast("int").alias("few"),
                                 F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"))
    # The few outside the largest component go to each block of all, and all to each block of the few.
    h = F.xxhash64("id")
    small = F.col("component") != F.col("largest")
    dealt = now.join(mixed, ["band", "key"]).select("band", "key", "id", "component", small.alias("small"), "few", "blocks")

    def blocks(first: bool, i: Column, j: Column) -> Column:
        return F.struct(F.lit(first).alias("first"), i.cast("int").alias("i"), j.cast("int").alias("j"))

    asked = F.transform(F.sequence(F.lit(0), F.col("few") - 1), lambda i: blocks(False, i, F.pmod(h, F.col("blocks"))))
    asking = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: blocks(True, F.pmod(h, F.col("few")), j))
    sent = dealt.select("band", "key", "id", "component", "small", F.explode(
        F.when(F.col("small"), F.concat(asked, asking)).otherwise(asked)).alias("to")).select(
        "band", "key", "id", "component", "small", "to.*")
    groups = sent.join(fine, "id").groupBy("band", "key", "i", "j").agg(F.collect_list(
        F.struct("id", "component", "n_shingles", "first", "small", "minima", "sketch")).alias("rows"))
    least = agreements(FINE, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for band, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                flat = rows.values
                ids, comps, n = (np.asarray(flat.field(k)) for k in (0, 1, 2))
                first, few = (np.array(flat.field(k).to_pylist(), bool) for k in (3, 4))
                keys = np.frombuffer(b"".join(flat.field(5).to_pylist()), "<u2").reshape(-1, BANDS, ROWS)[:, :band]
                x = np.frombuffer(b"".join(flat.field(6).to_pylist()), np.uint8).reshape(-1, FINE)
                a, b = [], []
                for k in np.flatnonzero(first):
                    may = ~first & (comps != comps[k]) & (100 * np.minimum(n, n[k]) >= percent * np.maximum(n, n[k]))
                    if not best:
                        may &= ~few | (ids > ids[k])  # of two of the few one asks
                    at = np.flatnonzero(may)
                    if band:
                        at = at[~(keys[at] == keys[k]).all(axis=2).any(axis=1)]
                    same = (x[at] == x[k]).sum(axis=1)
                    at, same = at[same >= least], same[same >= least]
                    if best and len(at):
                        at = at[np.argmax(same)][None]
                    a.append(np.minimum(ids[at], ids[k]))
                    b.append(np.maximum(ids[at], ids[k]))
                none = [np.zeros(0, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c + none)) for c in (a, b)], ["a", "b"])

    return groups.select("band", "rows").mapInArrow(run, "a long, b long").where("a != b").distinct()


def agreements(hashes: int, percent: int) -> int:
    """Minima in which a pair at the threshold agrees, but for one in 10 ** 8 pairs."""
    share = percent / 100
    return int(np.floor(hashes * share - 5.6 * np.sqrt(hashes * share * (1 - share))))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text)."""
    signed = cut(signatures(docs, size), "signatures")
    sets = (signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL").groupBy("set_key")
            .agg(F.min("doc_id").alias("id"), F.any_value("minima").alias("minima"), F.any_value("n_shingles").alias("n_shingles")))
    nodes = cut(sets, "sets")
    members, centers = shared_buckets(nodes)
    first = cut(members.join(centers, ["band", "key"]).where("id != center").select(
        F.least("center", "id").alias("a"), F.greatest("center", "id").alias("b")).distinct(), "first")
    stored = Texts(docs, first.select(F.col("a").alias("id")).union(first.select("b")).distinct())
    texts = stored.table()
    tested = cut(alike(first, nodes, percent).distinct(), "pairs")
    discard(first)
    links = verify(tested, texts, size, percent)
    # An id with several sets ties them together.
    rows = signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL").select("doc_id", "set_key")
    several = rows.groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y")).where("x != y")
    own = rows.join(several.select("doc_id"), "doc_id", "left_semi").join(nodes.select("id", "set_key"), "set_key")
    links = cut(links.union(own.select("id", "doc_id")).distinct(), "links")
    found = components(links, "a", "b")
    discard(links)
    rest = cut(unsettled(members, centers, found), "unsettled")
    discard(members)
    discard(centers)
    fine = cut(sketches(rest, nodes, texts, size), "sketches")
    # The most alike first, as long as that ties components; few pairs are left for the last, full round.
    best = True
    while True:
        pairs = cut(across(rest, fine, found, percent, best).join(tested, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            discard(pairs)
            if not best:
                break
            best = False
            continue
        before, tested = tested, cut(tested.unionByName(pairs), "tested")
        discard(before)
        links = cut(verify(pairs, texts, size, percent).distinct(), "links")
        discard(pairs)
        linked_more = not links.isEmpty()
        if linked_more:
            before, found = found, components(
                links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b")
            discard(before)
        discard(links)
        if best and not linked_more:
            best = False
            continue
        if not best:
            break
    stored.drop()
    for made in (rest, fine, tested):
        discard(made)
    # A set belongs to the component of its smallest id.
    of_set = nodes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component_id"))
    component = F.coalesce("component_id", "doc_id")
    return signed.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
