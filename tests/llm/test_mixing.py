"""The schedule against a plain simulation slot by slot, and the bound on its deviation from the exact weights."""

import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from beatline.llm import mixing
from beatline.llm.mixing import schedule


def ideal(blocks, weights):
    """moment -> blocks of each source that the ideal mix has served, in exact numbers."""
    def at(slot):
        served, left, free = [Fraction(0)] * len(blocks), set(range(len(blocks))), Fraction(slot)
        while free and left:
            rate = sum(weights[i] for i in left)
            step = min(min((blocks[i] - served[i]) / weights[i] for i in left), free / rate)
            for i in left:
                served[i] += step * weights[i]
            free -= step * rate
            left = {i for i in left if served[i] < blocks[i]}
        return served
    return at


def simulated(blocks, weights):
    """Earliest deadline first over released blocks, from the ideal mix at every slot."""
    at, total = ideal(blocks, weights), sum(blocks)
    moments = [at(t) for t in range(total + 1)]
    done, out = [0] * len(blocks), []
    for t in range(total):
        due = [(min(u for u in range(total + 1) if moments[u][i] >= done[i] + 1), i) for i in range(len(blocks))
               if done[i] < blocks[i] and moments[t + 1][i] > done[i]]
        i = min(due)[1]
        out.append(i)
        done[i] += 1
    return out


def sizes(spark, blocks, wishes):
    return spark.createDataFrame([(f"={i:04d}", int(b) * 10, float(w)) for i, (b, w) in enumerate(zip(blocks, wishes))],
                                 "key string, n long, wish double")


def order_of(spark, blocks, wishes):
    rows = mixing.plan(sizes(spark, blocks, wishes), 10).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(sum(blocks))) and [r.position for r in rows] == [10 * r.slot for r in rows]
    seen = {}
    for r in rows:  # the blocks of a source come in their order
        assert seen.get(r.key, -1) == r.block - 1
        seen[r.key] = r.block
    return [int(r.key[1:]) for r in rows]


@pytest.mark.parametrize("blocks,wishes", [
    ([5], [1]), ([4, 4, 4], [1, 1, 1]), ([10, 6, 4], [5, 3, 2]), ([40, 2, 30], [0.5, 0.25, 0.25]), ([1, 50, 7], [8, 1, 1]),
    ([9, 11, 13, 5, 3, 2], [7, 11, 13, 17, 19, 23])])
@pytest.mark.parametrize("chunk", [3, 2048])
def test_order(spark, monkeypatch, blocks, wishes, chunk):
    """One chunk or many: the same schedule, also when sources are used up."""
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    assert order_of(spark, blocks, wishes) == simulated(blocks, [Fraction(w) for w in wishes])


def deviation(order, blocks, weights):
    """The largest distance of any source from the ideal mix before any slot in which a source has a block or
    another is used up (in between the distances change evenly)."""
    order, weights = np.array(order), np.array(weights, float)
    ends = np.array(blocks) / weights
    at = np.sort(ends)
    knots = np.array([np.minimum(x * weights, blocks).sum() for x in at])  # slots at which sources are used up
    most = 0.0
    for i in range(len(blocks)):
        slots = np.flatnonzero(order == i)
        assert len(slots) == blocks[i]
        x = np.interp(np.concatenate([slots, slots + 1]), np.concatenate([[0.0], knots]), np.concatenate([[0.0], at]))
        served = np.concatenate([np.arange(blocks[i]), np.arange(blocks[i]) + 1])
        most = max(most, np.abs(np.minimum(x * weights[i], blocks[i]) - served).max())
    return most


def test_less_than_a_block_off(spark):
    """200,000 slots: small weights stay exact, however many slots there are."""
    blocks, wishes = [180_000, 19_960, 40], [0.9, 0.0998, 0.0002]
    assert deviation(order_of(spark, blocks, wishes), blocks, wishes) < 1


def test_a_thousand_sources(spark):
    """Uneven weights and lengths over 200,000 slots in many chunks, of which some are done again."""
    r = np.random.default_rng(2)
    wishes = 1 / (1 + np.arange(1000))
    blocks = np.maximum(1, (wishes / wishes.sum() * 200_000 * r.uniform(0.5, 1.5, 1000)).astype(int)).tolist()
    assert deviation(order_of(spark, blocks, wishes.tolist()), blocks, wishes.tolist()) < 1


def test_all_rows_in_proportion(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 2 == 0, "small").alias("source"))
    out = schedule(df, {"big": 3, "small": 1}, block_rows=10).toPandas().sort_values("mix_position")
    assert out.mix_position.tolist() == list(range(3000)) and sorted(out.doc_id) == list(range(3000))
    slots = out.groupby("mix_slot").source.agg(["nunique", "size"])
    assert slots["size"].max() <= 10
    head = out[out.mix_slot < 100]  # a source without a weight comes last
    assert (head.source == "big").sum() == 750 and (head.source == "small").sum() == 250
    assert out.source.isna().tolist() == [False] * 2500 + [True] * 500


def test_hot_ids_and_partial_blocks(spark):
    """A third of all rows without an id, one source with most rows, sources of a single row."""
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(
        F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 250).cast("string"))).alias("source"))
    out = schedule(df, block_rows=7).toPandas().sort_values("mix_position")
    assert out.mix_position.tolist() == list(range(5000)) and out.mix_slot.is_monotonic_increasing
    sizes = out.groupby(["source", "mix_block"]).size()
    assert sizes.max() == 7 and out.mix_slot.nunique() == sum(math.ceil(n / 7) for n in out.groupby("source").size())


def test_edges(spark):
    rows = [(1, "a", "t", "x"), (1, "a", "t", "x"), (None, None, None, "x"), (2, None, "u", None), (2, "", "u", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, mix_slot string")
    out = schedule(df).collect()
    assert sorted(r.mix_position for r in out) == [0, 1, 2, 3, 4]
    assert [f.name for f in schedule(df).schema] == ["doc_id", "source", "text", "mix_block", "mix_slot", "mix_position"]
    assert schedule(df.limit(0)).count() == 0
    assert mixing.mix(df).columns == df.columns and mixing.mix(df).count() == 5


def test_mixed_files_hold_the_order(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    expect = [r.doc_id for r in schedule(df).orderBy("mix_position").collect()]
    mixing.mix(df).write.parquet(str(tmp_path / "mix"))
    import glob
    files = sorted(glob.glob(str(tmp_path / "mix" / "*.parquet")))
    assert [i for f in files for (i,) in duckdb.sql(f"select doc_id from '{f}'").fetchall()] == expect


def test_plan_is_native(spark):
    df = spark.range(10).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("source"))
    plan = schedule(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
