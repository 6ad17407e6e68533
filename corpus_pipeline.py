"""From raw documents to token ids: toxicity, near-duplicates, personal data, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``, for every document that they keep.

1. toxicity: documents that the classifier, trained on the labels, finds toxic go.
2. near_duplicates: of each group of texts that share 0.8 of their five-word shingles, one
   document stays, that with the smallest doc_id (ties: the first row of the files).
3. personal_data: personal data in the texts is replaced by its kind; n_chars follows.
4. mix: the documents in the order in which the sources' target weights interleave them.
5. tokens: each document's place in the mix, its token ids, and the text they decode to.

Defined results: null and empty texts are clean, are duplicates of nothing and have no ids; rows
without doc_id are documents like others, and the last choice of their group; rows with the same doc_id are
documents of their own: exact repeats and near copies go, other texts stay; an empty table gives an
empty result; columns that documents doesn't have are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatline.llm import bpe, minhash, mixing, pii, toxicity
from beatline.llm.common import cut, fold, maybe_in, shared_folder, without

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the documents whose id's crc32 leaves a remainder by 5."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id())  # the same in each scan of the files
    return toxicity.reject(rows, labels, rows.where(fold("doc_id", 5) != 0), key="row").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row is a document of its own, so rows of one id are held against each other by their sets."""
    rows = docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id())  # the same in each scan of the files
    found = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), size=5, percent=80)
    members = found.select(F.col("doc_id").alias("row"), "component_id")
    several = members.where("row != component_id").select("component_id").distinct()
    groups = cut(members.join(several, "component_id", "left_semi"), "groups")
    ids = maybe_in(rows.select("row", "doc_id"), groups, "row").join(groups, "row")
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    gone = cut(groups.join(first.select(F.col("first.row").alias("row")), "row", "left_anti").select("row"), "gone")
    return without(rows, gone, "row").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, mix_position, n_tokens, ids and decoded. The place in the mix is the place in
    the files that the stage before has written; they hold the mix in the order of their names."""
    rows = docs.select("doc_id", "source", "text", F.col("_metadata.file_name").alias("file"),
                       F.col("_metadata.row_index").alias("row"))
    files = docs.select(F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    # A row for each file, so a small table to broadcast.
    before = files.select("file", F.coalesce(F.sum("n").over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    # Workers that come from the stages before have memory in use.
    coded = bpe.encode_decode(rows, public_tokenizers.path("byte_bpe_50k.json"), memory=bpe.FEW)
    return coded.join(F.broadcast(before), "file").select(
        "doc_id", "source", (F.col("before") + F.col("row")).alias("mix_position"),
        F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mix", mix), ("tokens", tokens)]

#: Classifier, MinHash and tokenizer have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
