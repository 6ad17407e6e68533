"""The registered queries: names, and what runs without the subpackage."""

import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from beatline.llm.queries import ORACLE, QUERIES


def test_names():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", ["op4_mixing", "op12_resample", "op13_topk"])
def test_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    cur = con.execute(ORACLE[key])
    df = QUERIES[key](spark, "/root/testdata/sf0.01")
    columns = [d[0] for d in cur.description]
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, cur.fetchall()))


def test_entry_without_the_subpackage(tmp_path):
    """The entry module and the other queries work when the folders are gone."""
    import os
    import shutil
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(os.path.join(root, "beatline"), tmp_path / "beatline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"],
                         cwd=tmp_path, capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    n, m = map(int, out.stdout.split())
    assert n == m == len(E.queries()) - len(QUERIES)
