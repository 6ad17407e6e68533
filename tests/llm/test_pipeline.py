"""The stages against plain Python over the same rows, one after the other."""

import duckdb
import public_tokenizers
import pytest
from cases import TEXTS
from test_minhash import brute
from tokenizers import Tokenizer

import corpus_pipeline as P
from beatline.llm import mixing, pii, toxicity
from beatline.llm.common import fold

SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def through(spark, docs, sf_dir, folder):
    """Each stage written and read again, as the driver does; returns every stage's rows."""
    out = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def expect_stages(spark, sf_dir, given, safe, near, masked, mixed, coded):
    rows = {r.doc_id: r for r in given.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    predicted = toxicity.score(given.select("doc_id", "text"), labels, given.where(fold("doc_id", 5) != 0))
    toxic = {r.doc_id for r in predicted.where("predicted = 1").collect()}
    assert {r.doc_id for r in safe.collect()} == rows.keys() - toxic
    components = brute([(r.doc_id, r.text) for r in safe.collect()], 5)
    assert {r.doc_id for r in near.collect()} == {i for i, c in components.items() if i == c} | ({None} & rows.keys())
    for r in masked.collect():
        text = rows[r.doc_id].text
        assert r.text == (None if text is None else pii.masked(text, pii.Finder()(text)))
        assert r.n_chars == (None if r.text is None else len(r.text))
    for part in (safe, near, masked, mixed):
        assert part.columns == list(P.COLUMNS)
    order = [r.doc_id for r in mixing.schedule(masked).orderBy("mix_position").collect()]
    assert mixed.count() == masked.count()
    got = sorted(coded.collect(), key=lambda r: r.mix_position)
    assert [r.doc_id for r in got] == order and [r.mix_position for r in got] == list(range(len(order)))
    texts = {r.doc_id: r.text or "" for r in masked.collect()}
    for r in got:
        assert r.ids == LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids and r.decoded == texts[r.doc_id]
    return toxic


def test_whole_table(spark, tmp_path):
    stages = through(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF, tmp_path)
    expect_stages(spark, SF, *stages)
    one = {tuple(r) for r in P.run(spark, SF).select("doc_id", "n_tokens", "mix_position").collect()}
    assert one == {tuple(r) for r in stages[-1].select("doc_id", "n_tokens", "mix_position").collect()}


@pytest.fixture
def small(spark, tmp_path):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, 0, "extra") for i, t in enumerate(TEXTS)]
    rows += [(5, TEXTS[5], "en", "s1", 0, None), (None, "no id here at all", None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string").write.parquet(
        str(tmp_path / "sf" / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "sf" / "labels.parquet"))
    return str(tmp_path / "sf")


def test_odd_rows(spark, small, tmp_path):
    stages = through(spark, spark.read.parquet(f"{small}/documents.parquet"), small, tmp_path)
    expect_stages(spark, small, *stages)
    final = [r.doc_id for r in stages[-1].collect()]
    assert final.count(5) == 1 and None in final and 12 not in final and 11 in final


def test_rows_of_one_id(spark, tmp_path):
    """Rows of one id are documents of their own: repeats and near copies go, other texts stay."""
    one, two = (" ".join(f"{c}{i}" for i in range(200)) for c in "pq")
    rows = [(7, one), (7, two), (7, one), (7, None), (7, None), (3, one + " end"), (9, two), (None, two), (None, None), (8, "short")]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(
        3).write.parquet(str(tmp_path / "d"))
    kept = P.near_duplicates(spark, spark.read.parquet(str(tmp_path / "d")), SF).collect()
    assert sorted(((r.doc_id or -1, r.text or "") for r in kept)) == sorted(
        [(3, one + " end"), (7, two), (7, ""), (7, ""), (-1, ""), (8, "short")])


def test_empty_table(spark, small, tmp_path):
    none = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    assert through(spark, none, small, tmp_path)[-1].count() == 0


def test_mixing_stage_is_the_order_of_the_files(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    P.mix(spark, docs, SF).write.parquet(str(tmp_path / "m"))
    files = sorted(str(p) for p in (tmp_path / "m").glob("*.parquet"))
    ids = [i for f in files for (i,) in duckdb.sql(f"select doc_id from '{f}'").fetchall()]
    assert ids == [r.doc_id for r in mixing.schedule(docs).orderBy("mix_position").collect()]
