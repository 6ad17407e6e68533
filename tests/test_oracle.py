"""Every registered question against its DuckDB oracle, on the smallest scale,
plus the entry smoke check."""

import math
import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from beatline.functions import DESCENT_LABELS
from beatline.plans.catalog import QUERIES
from beatline.plans.oracle import ORACLE

TABLES = ["orders", "nation", "customer", "supplier"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(float(v))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_oracle_is_independent():
    """It imports nothing of the package, so a wrong value on either side shows."""
    import ast
    import beatline.plans.oracle as O
    names = [n for node in ast.walk(ast.parse(open(O.__file__).read())) if isinstance(node, (ast.Import, ast.ImportFrom))
             for n in ([node.module] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names])]
    assert not any(n and n.startswith("beatline") for n in names)


@pytest.mark.parametrize("key,change", [
    ("day_segments", lambda m: m.setattr("beatline.functions.time.DAY_SEGMENTS", (("Morning", ((500, 1200),)), ("Afternoon", ((1200, 1659),)),
                                         ("Evening", ((1700, 2059),)), ("Night", ((2100, 2360), (0, 459)))))),
    ("category_labels", lambda m: m.setitem(DESCENT_LABELS, "W", "Wight")),
])
def test_a_wrong_value_is_seen(spark, con, monkeypatch, key, change):
    change(monkeypatch)
    df = QUERIES[key](spark, SF_SMALL)
    cur = con.execute(ORACLE[key])
    assert _rows(df.columns, df.collect()) != _rows([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "crime_count", "rank"]
    assert df.count() > 0
