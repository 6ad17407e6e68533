"""What cutting a table off leaves on the disk."""

import glob
import itertools
import os
import time

from pyspark.sql import functions as F

from beatline.llm import common, minhash
from beatline.llm.common import cut, discard


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    """Files of all shuffles that Spark's block manager holds."""
    folders = [d.toString() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}


def until(true, seconds=10):
    end = time.time() + seconds
    while not true() and time.time() < end:
        time.sleep(0.1)
    return true()


def test_cut_leaves_no_shuffle_files(spark):
    setting = spark.conf.get(CLEANUP)
    before = shuffle_files(spark)
    df = spark.range(0, 10_000, 1, 8).groupBy((F.col("id") % 100).alias("k")).count()
    counted = cut(df.join(spark.range(0, 200, 1, 5).withColumnRenamed("id", "k"), "k").orderBy("k"), "test")
    assert until(lambda: not shuffle_files(spark) - before)
    assert counted.count() == 100 and df.count() == 100
    assert spark.conf.get(CLEANUP) == setting


def test_discard_deletes_an_empty_table_too(spark):
    for made in (cut(spark.range(3), "test"), cut(spark.range(0), "test"), cut(spark.range(3).where("id > 5"), "test")):
        files = made.inputFiles()
        discard(made)
        assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_near_duplicates_leaves_only_what_its_result_reads(spark, tmp_path, monkeypatch):
    made = itertools.count()
    for module in (common, minhash):
        monkeypatch.setattr(module, "shared_folder", lambda spark, what: f"file://{tmp_path}/{what}-{next(made)}")
    base = [" ".join(f"w{g}x{i}" for i in range(40)) for g in range(6)]
    rows = [(10 * g + k, t + f" tail{k}" * (k > 1)) for g, t in enumerate(base) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df)
    left = {f.name.rsplit("-", 1)[0] for f in tmp_path.iterdir()}
    rows = got.collect()
    assert left == {"signatures", "sets", "edges"}
    assert {(r.doc_id, r.component_id) for r in rows} == {(10 * g + k, 10 * g) for g in range(6) for k in range(4)}
