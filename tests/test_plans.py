"""Physical plans: join strategy per variant, pushdown, pruning, no Python or
pairwise operators in the questions."""

import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from beatline.operators import in_year
from beatline.plans import queries as Q
from beatline.plans.catalog import QUERIES
from beatline.sources import standins as S


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for k, fn in QUERIES.items():
        out[k] = _final_plan(fn(spark, SF_SMALL))
    return out


@pytest.mark.parametrize("base", ["division_distance", "extreme_areas"])
def test_join_strategy_variants(plans, base):
    assert "BroadcastHashJoin" in plans[f"{base}_broadcast"]
    assert "SortMergeJoin" in plans[f"{base}_merge"]
    assert "BroadcastHashJoin" not in plans[f"{base}_merge"]
    assert "ShuffledHashJoin" in plans[f"{base}_shuffle_hash"]


def test_no_python_or_pairwise_operators(plans):
    for k, p in plans.items():
        assert "CartesianProduct" not in p, k
        assert "BroadcastNestedLoopJoin" not in p, k
        if k != "custom_row_function":
            assert "EvalPython" not in p, k
    assert "ArrowEvalPython" in plans["custom_row_function"]


@pytest.mark.parametrize("key", ["nearest_station", "nearest_division_stats", "yearly_nearest_distance", "nearest_post", "post_workload"])
def test_nearest_goes_by_cells(plans, key):
    """Equi-joins by cell, grid after grid; no array of stations, no lambda that searches them."""
    p = plans[key].split("== Initial Plan ==")[0]
    assert "lambda" not in p and "transform(" not in p and "Subquery" not in p
    assert len(re.findall(r"Join \[(?:cast\()?parent#\d+.*\], \[.*\], LeftOuter", p)) >= 4
    if key not in ("nearest_station", "nearest_post"):  # incidents are counted by place below the exchange
        assert re.search(r"Exchange hashpartitioning\((year#\d+, )?lat.*\n.*Aggregate\(keys=.*functions=\[partial_", p)


def test_filter_and_projection_reach_a_parquet_table(spark, tmp_path):
    S.incidents(spark, SF_SMALL).write.parquet(str(tmp_path / "inc"))
    inc = spark.read.parquet(str(tmp_path / "inc"))
    p = _final_plan(in_year(inc, "occurred_at", 1997))
    assert "GreaterThanOrEqual(occurred_at" in p and "LessThan(occurred_at" in p
    p = _final_plan(Q.top_months_by_count(inc))
    assert "ReadSchema: struct<occurred_at:timestamp_ntz>" in p
    assert "WindowGroupLimit" in p


def test_projection_pruned(plans):
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plans["top_months_by_count"]


def test_facts_are_counted_before_the_join(plans):
    """The shuffled side of the shuffle strategies is a partial count, not the incidents."""
    for k in ("extreme_areas_merge", "extreme_areas_shuffle_hash", "division_distance_merge", "division_distance_shuffle_hash"):
        p = plans[k].split("== Initial Plan ==")[0]
        assert re.search(r"Exchange hashpartitioning\((lat|area_name).*\n.*HashAggregate\(keys=\[.*functions=\[partial_", p), k


def test_no_job_while_planning(spark):
    """Only the keys about CSV files and streams run jobs (they write the files) before their result is asked for."""
    files = {"top_months_by_count_csv", "day_segment_counts_csv", "day_segment_counts_lines", "incident_profile",
             "incident_row_count", "scan_incidents_csv", "typed_incidents", "scan_stations", "scan_incomes",
             "scan_geocodes", "scan_lines", "all_incidents", "weekly_area_counts_stream", "sliding_counts_stream", "late_counts_stream"}
    sc = spark.sparkContext
    store = sc._jsc.sc().statusStore()
    # listing a Parquet table's schema is a job of its own; do that once before counting
    seen = {}
    for k in sorted(set(QUERIES) - files):
        before = store.jobsList(None).size()
        QUERIES[k](spark, SF_SMALL)
        seen[k] = store.jobsList(None).size() - before
    # at most the schema of each table read
    assert all(n <= 3 for n in seen.values()), seen
    assert seen["day_segments"] == seen["incidents_per_month"] == seen["custom_row_function"]


def test_sql_and_dataframe_forms_agree(spark):
    q = QUERIES
    a = sorted(tuple(r) for r in q["top_months_by_count"](spark, SF_SMALL).collect())
    b = sorted(tuple(r) for r in q["top_months_by_count_sql"](spark, SF_SMALL).collect())
    assert a == b and a


@pytest.mark.parametrize("base,variants", [
    ("division_distance_stats", ["division_distance_broadcast", "division_distance_merge",
                                 "division_distance_shuffle_hash"]),
    ("category_counts_extreme_areas", ["extreme_areas_broadcast", "extreme_areas_merge",
                                       "extreme_areas_shuffle_hash"]),
])
def test_variants_agree_with_base(spark, base, variants):
    q = QUERIES
    ref = sorted(tuple(r) for r in q[base](spark, SF_SMALL).collect())
    assert ref
    for v in variants:
        assert sorted(tuple(r) for r in q[v](spark, SF_SMALL).collect()) == ref, v


def test_refused_strategy(spark):
    from beatline.operators import with_strategy
    with pytest.raises(ValueError):
        with_strategy(spark.range(3), "shuffle_replicate_nl")


def _hot_incidents(spark):
    """A third of 300,000 incidents at one place of one area."""
    return spark.range(300_000).select(
        F.col("id").alias("incident_id"), F.lit(100).alias("weapon_code"), F.lit("W").alias("category"),
        F.lit("1997-05-05 00:00:00").cast("timestamp_ntz").alias("occurred_at"),
        F.when(F.col("id") % 3 == 0, "Area 1").otherwise(F.concat(F.lit("Area "), (F.col("id") % 25 + 1).cast("string"))).alias("area_name"),
        F.when(F.col("id") % 3 == 0, F.lit(34.0)).otherwise(33.5 + (F.col("id") % 64) / 64.0).alias("lat"),
        F.lit(-118.25).alias("lon"))


@pytest.mark.parametrize("strategy", ["merge", "shuffle_hash"])
def test_hot_key_travels_as_counts(spark, strategy):
    """At default thresholds a hot place or area crosses the shuffle as one row a task."""
    inc, st = _hot_incidents(spark), S.build_stations(spark, SF_SMALL)
    geo = spark.range(64).select((33.5 + F.col("id") / 64.0).alias("lat"), F.lit(-118.25).alias("lon"),
                                 (F.col("id") + 90000).cast("string").alias("zip_text"))
    incomes = spark.range(64).select((F.col("id") + 90000).cast("int").alias("zip"), F.lit("$1").alias("income_text"))
    for df, ref in ((Q.division_distance_stats(inc, st, strategy=strategy), Q.division_distance_stats(inc, st)),
                    (Q.category_counts_extreme_areas(inc, geo, incomes, 1997, strategy=strategy),
                     Q.category_counts_extreme_areas(inc, geo, incomes, 1997))):
        rows = sorted(tuple(r) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan()
        assert rows == sorted(tuple(r) for r in ref.collect()) and rows
        text = plan.toString().split("== Initial Plan ==")[0]
        assert re.search(r"Exchange hashpartitioning\((lat|area_name).*\n.*functions=\[partial_count", text)


def test_zip_first_join_order_equals_reference_order(spark):
    """Joining the selected ZIPs to the geocodes first gives the same rows as
    incidents ⟕ geocodes, then ⋈ selected ZIPs (the written order)."""
    from beatline.functions import first_list_item, label_of, to_int
    inc, geo, incomes = (S.incidents(spark, SF_SMALL), S.build_geocodes(spark, SF_SMALL),
                         S.build_incomes(spark, SF_SMALL))
    facts = inc.filter(F.year("occurred_at") == S.STANDIN_YEAR).filter(F.col("category").isNotNull())
    j = facts.join(geo, ["lat", "lon"], "left").withColumn("zip_head", first_list_item("zip_text"))
    sel = Q.extreme_areas(incomes)
    written = (j.join(sel, to_int("zip_head") == sel["zip"])
               .groupBy(label_of("category").alias("category")).agg(F.count(F.lit(1)).alias("crime_count")))
    ours = Q.category_counts_extreme_areas(inc, geo, incomes, S.STANDIN_YEAR)
    assert sorted(tuple(r) for r in ours.collect()) == sorted(tuple(r) for r in written.collect())
