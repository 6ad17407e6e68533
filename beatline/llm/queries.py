"""The registered queries of the operators: whole tables in, the contract's columns out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from beatline.llm import (
    bpe, langid, lm, minhash, mixing, pii, quality, resample, runs, tokenfile, topk, toxicity, vecjoin,
)
from beatline.llm.common import fold, shared_folder

VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode_decode(docs, path))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.score(docs, labels, docs.where(fold("doc_id", 5) != 0))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vecjoin.near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, public_tokenizers.path(VOCABULARY), fold("doc_id", 10) == 0)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = tokenfile.write(docs, shared_folder(spark, "token-files"), public_tokenizers.path(VOCABULARY))
    return tokenfile.read(files).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.assess(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality_probability")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = langid.identify(docs.select("doc_id", "text"), docs.where(fold("doc_id", 4) != 2))
    return named.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, percent=80)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digests(pii.find(docs))


def periodic(text: Column, key: Column) -> Column:
    """The input of ``op11_runs``: the texts, a tenth of them with a periodic end. Where h, the crc32 of the
    key as text, divides by 10, word i from a = (h / 10) % n on becomes word a + (i - a) % p, with
    p = 1 + (n - a) / (3 + (h / 10) % 8)."""
    h = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def changed(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.try_mod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(at, " "))

    # An array of one, so that the words are split once and not for each of them.
    split = F.array(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return F.when((h % 10 == 0) & text.isNotNull(), F.get(F.transform(split, changed), 0)).otherwise(text)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return runs.digests(runs.find(docs.withColumn("text", periodic(F.col("text"), F.col("doc_id")))))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = resample.resample(docs, table(spark, sf_dir, "benchmark"))
    return made.select("doc_id", "n_features", "weight", "score", "rank")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_vectors": op3_vectors,
    "op4_mixing": op4_mixing,
    "op5_lm": op5_lm,
    "op6_token_files": op6_token_files,
    "op7_quality": op7_quality,
    "op8_language": op8_language,
    "op9_minhash": op9_minhash,
    "op10_pii": op10_pii,
    "op11_runs": op11_runs,
    "op12_resample": op12_resample,
    "op13_topk": op13_topk,
    "pipeline": corpus_pipeline.run,
}

#: Links and reachability by plain SQL, for small tables: ``links`` has both directions.
REACH = """
reach(a, b) AS (SELECT a, a FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
component AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
"""

VECTORS_SQL = f"""
WITH RECURSIVE fine AS (
  SELECT vec_id AS a, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
nodes AS (SELECT DISTINCT vec_id AS a FROM embeddings WHERE vec_id IS NOT NULL),
links AS (SELECT x.a, y.a AS b FROM fine x JOIN fine y ON x.label = y.label AND x.a <> y.a AND len(x.v) = len(y.v)
          WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
{REACH}
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, least AS component_id, e.vec_id = least AS kept
FROM embeddings e JOIN component c ON c.a = e.vec_id
"""

NEAR_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	

]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    generate_series(1, greatest(1, len(w) - 3)), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
nodes AS (SELECT DISTINCT doc_id AS a FROM documents),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS m, any_value(y.n) AS n, count(*) AS k
           FROM each x JOIN each y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * k >= 80 * (m + n - k)),
{REACH}
SELECT s.doc_id, len(s) AS n_shingles, least AS component_id, s.doc_id = least AS kept
FROM sets s JOIN component c ON c.a = s.doc_id
"""

#: crc32 goes half a byte at a time over a table of 16 fixed values.
RESAMPLE_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, words FROM (
    SELECT doc_id, 's' AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
    UNION ALL
    SELECT NULL, 't', regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark)),
f AS (
  SELECT r, source, feature, count(*) AS n FROM (
    SELECT r, source, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature
    FROM w WHERE len(words) > 0) GROUP BY ALL),
d AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, 2 * strlen(feature)),
      lambda i: instr('0123456789ABCDEF', substr(hex(encode(feature)), (i + 1 - 2 * (i % 2) + 1)::BIGINT, 1)) - 1)),
    lambda c, b: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
      3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][(xor(c, b) & 15) + 1])),
    4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM f)),
g AS (
  SELECT bucket, sum(n) FILTER (source = 's') AS s, sum(n) FILTER (source = 't') AS t FROM f JOIN d USING (feature) GROUP BY bucket),
b AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce((SELECT sum(s) FROM g), 0) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM g), 0) + 10000)::DOUBLE)))::BIGINT AS gain FROM g),
m AS (SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
      FROM f JOIN d USING (feature) JOIN b USING (bucket) WHERE source = 's' GROUP BY r),
x AS (
  SELECT w.r, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN m USING (r) WHERE source = 's'),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place FROM x WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 25 * (SELECT count(*) FROM k) // 100 THEN place END AS rank
FROM x LEFT JOIN k USING (r)
"""

TOPK_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, v.vec_id, v.r AS other, list_inner_product(q.w, v.w)::BIGINT AS score
      FROM v q JOIN v ON q.r <> v.r AND len(q.w) = len(v.w) WHERE q.vec_id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""

#: The other operators (models, a vocabulary, parsers) have no SQL form; tests hold them against plain Python.
ORACLE: dict[str, str] = {"op3_vectors": VECTORS_SQL, "op4_mixing": mixing.SQL, "op9_minhash": NEAR_SQL,
                          "op12_resample": RESAMPLE_SQL, "op13_topk": TOPK_SQL}
