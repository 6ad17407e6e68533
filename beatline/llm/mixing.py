"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

The rows of a source, in an order that a hash of their ids deals out, are cut into blocks, and
a slot serves one block. The ideal mix serves all sources at once, each at a rate in proportion
to its target weight; when a source is used up, the others go on in their proportions. Block j of a source
is released in the slot in which the ideal mix begins it, and due at the end of that in which the
ideal mix ends it, from the exact weights: floor(j / w) and ceil((j + 1) / w) with a share w of the weights as long as no
source is used up. Slot by slot, of the released blocks the one that is due first is
served (ties: by source). All blocks meet their windows, so before any slot a source has had less than one
block more or less than in the ideal mix, however many slots there are. No row is dropped or repeated.

The slots are dealt out in chunks, each a fold over its slots in a row of its own that holds the codes of the
released blocks (at most one a source beside the new ones). What a chunk finds released at its start
depends on the one before: it is first guessed (of the blocks that cross the border the first due ones are
served), and chunks whose guess differs from what the chunk before hands over are
done again with that, until none differs. The schedule is then that of one long fold. Guesses are mostly
right or soon forgotten, so two or three rounds do; each round settles a further chunk at least.

No window or group holds a whole source: the order within a source is found in 4096 parts
of it, by the first three hex digits of the hash, and blocks are numbered by arithmetic. A chunk has
as many slots as there are sources at least, so all guesses together are no longer than the schedule.

Defined results: rows whose source is null form a source of their own; sources without a given weight, or of
weight zero, come after all others, in proportion to their rows; texts play no part; rows
that are alike in all columns take neighbouring places; an empty table stays empty;
columns with the names of the new ones are replaced; more than 2 ** 20 sources are an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.llm.common import cut

#: Rows of a block, slots of a chunk at least, and the power of a source's rows that is its default weight.
BLOCK_ROWS, CHUNK, POWER = 64, 2048, 0.5
NEW = ("mix_block", "mix_slot", "mix_position")
#: Bits of a source's number in a code, blocks that one row unfolds, and what times may be off by.
SOURCE_BITS, UNFOLD, SLACK = 20, 1024, 1e-6


def _key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("-"))


def _bin(x: Column) -> Column:
    """A number that grows with x: 16 of them from each x to twice x."""
    return F.when(x > 0, F.floor(F.log2(x) * 16)).otherwise(-100_000).cast("int")


def windows(sizes: DataFrame, block_rows: int) -> DataFrame:
    """key, i (the source's number), block, release and due of every block, and rows, how many it has.
    ``sizes`` has a row for each source: key, n (rows) and wish (its weight, or null)."""
    sources = sizes.select(
        "key", "n", (F.col("wish").isNull() | (F.col("wish") <= 0)).cast("int").alias("tier"),
        F.when(F.col("wish") > 0, F.col("wish")).otherwise(F.col("n")).cast("double").alias("w"),
        F.ceil(F.col("n") / block_rows).cast("long").alias("blocks"),
        (F.row_number().over(Window.orderBy("key")) - 1).cast("long").alias("i"))
    sources = sources.withColumn("end", F.col("blocks") / F.col("w"))
    # A source is used up at the moment blocks / w; from there on the rest share the slots.
    knots = sources.groupBy("tier", "end").agg(F.sum("blocks").alias("blocks"), F.sum("w").alias("w"))
    so_far = Window.partitionBy("tier").orderBy("end")
    start = knots.groupBy("tier").agg(F.lit(0.0).alias("end"), F.lit(0).cast("long").alias("served"), F.sum("w").alias("rate"))
    later = knots.select("tier", "end", F.sum("blocks").over(so_far).alias("served"), F.coalesce(F.sum("w").over(
        so_far.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0)).alias("rate"))
    first = F.coalesce(knots.where("tier = 0").agg(F.sum("blocks")).scalar(), F.lit(0))
    pieces = start.union(later).withColumn("bin", _bin(F.col("end")))

    unfold = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / UNFOLD)))
    parts = sources.where("blocks > 0").withColumn("part", unfold).repartition("key", "part")
    block = F.explode(F.sequence(F.col("part") * UNFOLD, F.least("blocks", (F.col("part") + 1) * UNFOLD) - 1))
    each = parts.withColumn("block", block).select(
        "key", "i", "tier", "block", F.least(F.lit(block_rows), F.col("n") - F.col("block") * block_rows).alias("rows"),
        (F.col("block") / F.col("w")).alias("x0"), ((F.col("block") + 1) / F.col("w")).alias("x1"))

    # The piece of the ideal mix that a moment lies in: those that begin in its bin, and the last one before.
    bins = each.select("tier", _bin(F.col("x0")).alias("bin")).union(each.select("tier", _bin(F.col("x1")).alias("bin"))).distinct()
    mark = F.struct("end", "served", "rate")
    last = pieces.groupBy("tier", "bin").agg(F.max(mark).alias("last"))
    before = Window.partitionBy("tier").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.join(last, ["tier", "bin"], "full").withColumn("p", F.last("last", ignorenulls=True).over(before)).where(
        "p IS NOT NULL").select("tier", "bin", "p.*")
    inside = Window.partitionBy("tier", "bin").orderBy("end")
    known = carried.unionByName(pieces.select("tier", "bin", "end", "served", "rate")).withColumn(
        "until", F.coalesce(F.lead("end").over(inside), F.lit(float("inf"))))

    def moment(rows: DataFrame, x: str, out: str) -> DataFrame:
        here = known.select(F.col("tier").alias("tier_"), F.col("bin").alias("bin_"), "end", "until", "served", "rate")
        met = rows.join(here, (F.col("tier") == F.col("tier_")) & (_bin(F.col(x)) == F.col("bin_"))
                        & (F.col(x) >= F.col("end")) & (F.col(x) < F.col("until")))
        at = F.col("served") + F.col(x) * F.col("rate") + F.when(F.col("tier") == 1, first).otherwise(F.lit(0))
        return met.select(*rows.columns, at.alias(out))

    timed = moment(moment(each, "x0", "t0"), "x1", "t1")
    return timed.select("key", "i", "block", "rows", F.floor(F.col("t0") + SLACK).alias("release"),
                        F.ceil(F.col("t1") - SLACK).alias("due"))


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def served(chunks: DataFrame) -> DataFrame:
    """Adds picks (the codes served, slot by slot) and rest (those released and left) to chunks that have
    fresh (the codes released in each slot) and ready (those released before)."""
    none = F.array().cast("array<bigint>")

    def slot(state: Column, new: Column) -> Column:
        def pick(ready: Column) -> Column:
            return _let(F.array_min(ready), lambda p: F.struct(
                F.array_remove(ready, p).alias("ready"), F.concat(state["picks"], F.array(p)).alias("picks")))

        return _let(F.concat(state["ready"], new), pick)

    start = F.struct(F.col("ready").alias("ready"), none.alias("picks"))
    done = chunks.withColumn("done", F.aggregate("fresh", start, slot))
    return done.select("chunk", "ready", F.col("done.picks").alias("picks"), F.array_sort("done.ready").alias("rest"))


def slots(jobs: DataFrame, total: int, length: int) -> DataFrame:
    """chunk, at (slot within the chunk), i and due of every served block: earliest deadline first."""
    spark = jobs.sparkSession
    base = 1 << SOURCE_BITS

    def code(chunk: Column) -> Column:
        return (F.col("due") - chunk * length) * base + F.col("i")

    released = F.floor(F.col("release") / length)
    new = jobs.select(released.alias("chunk"), (F.col("release") % length).alias("at"), code(released).alias("code"))
    every = spark.range(total).select(F.floor(F.col("id") / length).alias("chunk"), (F.col("id") % length).alias("at"),
                                      F.lit(None).cast("long").alias("code"))
    fresh = new.unionByName(every).groupBy("chunk", "at").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    chunks = fresh.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("at", "codes"))).alias("each")).select(
        "chunk", F.transform("each", lambda x: x["codes"]).alias("fresh"))
    chunks = cut(chunks, "mix-chunks")
    # The blocks that cross a chunk's start, of which so many are served before as slots aren't taken by others.
    after = F.ceil(F.col("due") / length) - 1
    crossing = jobs.where(after > released).withColumn("chunk", F.explode(F.sequence(released + 1, after))).groupBy("chunk").agg(
        F.sort_array(F.collect_list(code(F.col("chunk")))).alias("crossing"))
    due = jobs.groupBy(F.ceil(F.col("due") / length).alias("chunk")).agg(F.count(F.lit(1)).alias("n"))
    ended = due.select("chunk", F.sum("n").over(Window.orderBy("chunk")).alias("ended"))  # a row for each chunk
    left = F.col("chunk") * length - F.coalesce("ended", F.lit(0))
    starts = chunks.select("chunk").join(crossing, "chunk", "left").join(ended, "chunk", "left").select(
        "chunk", F.coalesce(F.slice("crossing", left.cast("int") + 1, F.greatest(F.size("crossing"), F.lit(1))),
                            F.array().cast("array<bigint>")).alias("ready"))
    done = cut(served(chunks.join(starts, "chunk")), "mix-served")
    while True:
        handed = done.select((F.col("chunk") + 1).alias("chunk"), F.transform(
            "rest", lambda c: c - F.lit(length * base)).alias("handed"))
        wrong = cut(handed.join(done.select("chunk", "ready"), "chunk").where("handed != ready").select(
            "chunk", F.col("handed").alias("ready")), "mix-wrong")
        if wrong.isEmpty():
            break
        again = served(chunks.join(wrong, "chunk"))
        done = cut(done.join(wrong.select("chunk"), "chunk", "left_anti").unionByName(again), "mix-served")
    picked = done.select("chunk", F.posexplode("picks").alias("at", "code"))
    return picked.select("chunk", "at", (F.col("code") % base).alias("i"),
                         (F.floor(F.col("code") / base) + F.col("chunk") * length).alias("due"))


def plan(sizes: DataFrame, block_rows: int) -> DataFrame:
    """key, block, slot and position (the rows of all earlier slots) of every block."""
    sizes = cut(sizes, "mix-sizes")
    count, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.ceil(F.col("n") / block_rows)), F.lit(0))).first()
    if count > 1 << SOURCE_BITS:
        raise ValueError(f"{count} sources are too many to mix")
    jobs = cut(windows(sizes, block_rows), "mix-windows")
    length = max(CHUNK, count)
    taken = slots(jobs, int(total), length).join(jobs, ["i", "due"])
    chunk = taken.groupBy("chunk").agg(F.sum("rows").alias("sum"))
    before = chunk.select("chunk", (F.sum("sum").over(Window.orderBy("chunk")) - F.col("sum")).alias("before"))  # a row for each chunk
    within = F.sum("rows").over(Window.partitionBy("chunk").orderBy("at")) - F.col("rows")
    return taken.withColumn("within", within).join(before, "chunk").select(
        "key", "block", (F.col("chunk") * length + F.col("at")).alias("slot"), (F.col("before") + F.col("within")).alias("position"))


def schedule(df: DataFrame, weights: Mapping[str, float] | None = None, source: str = "source",
             doc_id: str = "doc_id", block_rows: int = BLOCK_ROWS, power: float = POWER) -> DataFrame:
    """``df`` with mix_block (the row's block within its source), mix_slot (the block's slot) and
    mix_position (0, 1, ... without gaps: the row's place in the mix).

    ``weights`` are target weights by source; None takes each source's number of rows to the
    ``power``, so that small sources get more than their share at first."""
    kept = [f for f in df.schema.fields if f.name not in NEW]
    hashed = [F.col(f"`{f.name}`") for f in kept if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    digest = F.md5(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary"))
    rows = df.select(*[F.col(f"`{f.name}`") for f in kept], _key(source).alias("__key"), digest.alias("__digest"),
                     F.substring(digest, 1, 3).alias("__part"), F.xxhash64(*hashed).alias("__tie"))

    parts = (df.select(_key(source).alias("__key"), F.substring(digest, 1, 3).alias("__part"))
             .groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("n")))
    sizes = parts.groupBy(F.col("__key").alias("key")).agg(F.sum("n").alias("n"))
    if weights is None:
        wish = F.pow(F.col("n").cast("double"), F.lit(float(power)))
    elif weights:
        given = F.create_map(*[F.lit(v) for k, w in weights.items() for v in ("=" + k, float(w))])
        wish = F.try_element_at(given, F.col("key"))
    else:
        wish = F.lit(None).cast("double")
    blocks = plan(sizes.withColumn("wish", wish), block_rows)

    earlier = F.sum("n").over(Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("__key", "__part", "n", F.coalesce(earlier, F.lit(0)).alias("__before"))
    # The blocks of a part, which has a 4096th of its source's rows: they come with its offset.
    low, high = F.floor(F.col("__before") / block_rows), F.floor((F.col("__before") + F.col("n") - 1) / block_rows)
    held = (offsets.withColumn("block", F.explode(F.sequence(low, high)))
            .join(blocks.withColumnRenamed("key", "__key"), ["__key", "block"])
            .groupBy("__key", "__part").agg(F.any_value("__before").alias("__before"), F.sort_array(F.collect_list(
                F.struct("block", "slot", "position"))).alias("__blocks")))
    within = F.row_number().over(Window.partitionBy("__key", "__part").orderBy("__digest", "__tie"))
    ranked = (rows.withColumn("__within", within).join(held, ["__key", "__part"])
              .withColumn("__rank", F.col("__before") + F.col("__within") - 1)
              .withColumn("mix_block", F.floor(F.col("__rank") / block_rows))
              .withColumn("__at", F.get("__blocks", (F.col("mix_block") - F.floor(F.col("__before") / block_rows)).cast("int"))))
    return ranked.select(*[F.col(f"`{f.name}`") for f in kept], "mix_block", F.col("__at.slot").alias("mix_slot"),
                         (F.col("__at.position") + F.col("__rank") % block_rows).alias("mix_position"))


def mix(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` in the order of the mix: range partitions of neighbouring places,
    each sorted, so files written from it hold the mix in the order of their names."""
    placed = schedule(df, **options).repartitionByRange("mix_position").sortWithinPartitions("mix_position")
    return placed.select(*[F.col(f"`{c}`") for c in df.columns])


#: The same schedule over ``documents`` with the default options, all slots in one recursion.
SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, '-') AS k, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY h) - 1 AS rank FROM d),
s AS (SELECT k, n, w, b, b / w AS e, row_number() OVER (ORDER BY k) - 1 AS i FROM (
  SELECT k, count(*) AS n, pow(count(*)::DOUBLE, {POWER}) AS w, ceil(count(*) / {BLOCK_ROWS})::BIGINT AS b FROM d GROUP BY k)),
x AS (SELECT k, i, n, unnest(range(b)) AS j, w FROM s),
t AS (
  SELECT k, i, j, least({BLOCK_ROWS}, n - j * {BLOCK_ROWS}) AS rows,
    (SELECT sum(CASE WHEN s.e <= j / x.w THEN s.b ELSE j / x.w * s.w END) FROM s) AS t0,
    (SELECT sum(CASE WHEN s.e <= (j + 1) / x.w THEN s.b ELSE (j + 1) / x.w * s.w END) FROM s) AS t1 FROM x),
w AS (SELECT k, i, j, rows, floor(t0 + {SLACK}::DOUBLE)::BIGINT AS release, ceil(t1 - {SLACK}::DOUBLE)::BIGINT AS due FROM t),
c AS (SELECT release, list(due * 1048576 + i) AS codes FROM w GROUP BY release),
f AS (
  SELECT 0::BIGINT AS slot, list_min(codes) AS pick, codes AS ready FROM c WHERE release = 0
  UNION ALL
  SELECT slot + 1, list_min(now), now FROM (
    SELECT slot, list_concat(list_filter(ready, lambda y: y <> pick), coalesce(c.codes, []::BIGINT[])) AS now
    FROM f LEFT JOIN c ON c.release = slot + 1) WHERE len(now) > 0),
p AS (SELECT k, j, slot, sum(rows) OVER (ORDER BY slot) - rows AS position FROM f JOIN w ON pick = due * 1048576 + i)
SELECT doc_id, source, rank // {BLOCK_ROWS} AS mix_block, slot AS mix_slot, (position + rank % {BLOCK_ROWS})::BIGINT AS mix_position
FROM r JOIN p ON r.k = p.k AND r.rank // {BLOCK_ROWS} = p.j
"""
