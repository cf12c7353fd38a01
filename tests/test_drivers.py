"""Driver strength, drift of all columns and distinct reach against plain counting."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vidlake.functions.drift import PROFILE_SCHEMA, _counts, drift_report, reference_profile
from vidlake.functions.quality import population_stability
from vidlake.operators import gold
from vidlake.operators.drivers import average_ranks, driver_strength

SCHEMA = "publish_hour int, publish_day_of_week int, tag_count int, title_length int, category_id int, engagement_rate double"


def _videos(n: int) -> pd.DataFrame:
    """A third of the rows share a rate of 0, another column has as many values as rows."""
    rng = np.random.default_rng(7)
    rate = np.where(rng.random(n) < 0.35, 0.0, rng.random(n).round(3))
    return pd.DataFrame({
        "publish_hour": rng.integers(0, 24, n), "publish_day_of_week": rng.integers(1, 8, n),
        "tag_count": np.where(rng.random(n) < 0.5, 0, (rate * 20 + rng.integers(0, 9, n)).astype(int)),
        "title_length": rng.permutation(n), "category_id": rng.choice([10, 20, 22], n, p=[0.7, 0.2, 0.1]),
        "engagement_rate": rate})


def _expected(rows: pd.DataFrame) -> dict:
    y = rows["engagement_rate"]
    out = {}
    for c in rows.columns[:-1]:
        means = y.groupby(rows[c]).transform("mean")
        rho = np.corrcoef(rows[c].rank(), y.rank())[0, 1] if c != "category_id" else None
        out[c] = (len(rows), rows[c].nunique(), rho, ((means - y.mean()) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    return out


@pytest.mark.parametrize("max_rows", [500_000, 3])
def test_driver_strength_equals_plain_ranks(spark, max_rows):
    """With rank tables broadcast, and (3 rows at most) joined in salted parts."""
    rows = _videos(900)
    got = driver_strength(spark.createDataFrame(rows, SCHEMA).repartition(7), max_rows=max_rows).collect()
    want = _expected(rows)
    assert {r["driver"] for r in got} == set(want)
    for r in got:
        n, values, rho, share = want[r["driver"]]
        assert (r["n_videos"], r["n_values"]) == (n, values)
        assert (r["spearman"] is None) if rho is None else math.isclose(r["spearman"], rho, abs_tol=1e-9)
        assert math.isclose(r["variance_share"], share, abs_tol=1e-9)


def test_driver_strength_of_nulls_constants_and_nothing(spark):
    rows = [(1, 1, 1, 1, 10, 0.5), (2, 1, 2, 3, 10, 0.5), (None, 1, 2, 3, 10, 0.9), (2, 2, 2, 2, None, 0.9)]
    got = {r["driver"]: r for r in driver_strength(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["publish_hour"]["n_videos"] == 2 and got["publish_hour"]["n_values"] == 2
    assert all(r["spearman"] is None and r["variance_share"] is None for r in got.values())
    none = driver_strength(spark.createDataFrame([], SCHEMA)).collect()
    assert len(none) == 5 and all(r["n_videos"] == 0 and r["spearman"] is None for r in none)


def test_average_ranks_across_slices(spark):
    values = spark.range(500).select(F.lit("a").alias("k"), F.col("id").alias("v"), (F.col("id") % 3 + 1).alias("n"))
    values = values.unionByName(spark.createDataFrame([("b", 5, 4), ("b", 9, 1)], "k string, v long, n long"))
    got = average_ranks(values, ["k"], "v", "n", "r").toPandas()
    for key, part in got.groupby("k"):
        spread = np.repeat(part["v"].values, part["n"].values)
        want = pd.Series(spread).rank().groupby(spread).first()
        assert part.set_index("v")["r"].sort_index().tolist() == want.sort_index().tolist(), key


def test_drift_report_equals_one_column_at_a_time(spark):
    old = spark.range(3000).select((F.col("id") % 700).alias("x"), F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("c"))
    new = spark.range(2000).select((F.col("id") % 350).alias("x"), F.when(F.col("id") % 2 > 0, "a").otherwise("z").alias("c"))
    report = {r["column"]: r for r in drift_report(reference_profile(old, ["x"], ["c"]), new).collect()}
    one = population_stability(old, new, "x").first()
    assert math.isclose(report["x"]["psi"], one["psi"], rel_tol=1e-9) and report["x"]["drifted"] == one["drifted"]
    shares = [(2 / 3, 0.5), (1 / 3, 1e-4), (1e-4, 0.5)]
    assert math.isclose(report["c"]["psi"], sum((q - p) * math.log(q / p) for p, q in shares), rel_tol=1e-9)
    assert report["c"]["new_labels"] == 1 and report["c"]["n_current"] == 2000
    same = drift_report(reference_profile(old, ["x"], ["c"]), old).collect()
    assert all(r["psi"] == 0 and not r["drifted"] for r in same)


def test_drift_of_nulls_and_empty_sides(spark):
    schema = "x double, c string"
    old = spark.createDataFrame([(1.0, "a"), (2.0, None), (None, "a"), (4.0, "a")], schema)
    profile = reference_profile(old, ["x"], ["c"])
    assert profile.columns == [f.split()[0] for f in PROFILE_SCHEMA.split(", ")]
    gone = {r["column"]: r for r in drift_report(profile, spark.createDataFrame([(None, None)] * 4, schema)).collect()}
    assert gone["x"]["drifted"] and gone["x"]["new_labels"] == 0 and gone["c"]["drifted"]
    nothing = drift_report(profile, spark.createDataFrame([], schema)).collect()
    assert len(nothing) == 2 and all(r["psi"] is None and not r["drifted"] and r["n_current"] == 0 for r in nothing)
    assert drift_report(reference_profile(old.limit(0), ["x"], ["c"]), old).count() == 0
    only_null = reference_profile(spark.createDataFrame([(None, "a")], schema), ["x"])
    assert [(r["label"], r["n"], r["edges"]) for r in only_null.collect()] == [(None, 1, [])]


def test_drift_counts_all_columns_in_one_scan(spark, scratch):
    path = scratch("drift_rows")
    spark.range(1000).select("id", (F.col("id") % 5).alias("g"), F.lit("long text").alias("t")).write.parquet(path)
    rows = spark.read.parquet(path)
    plan = _counts(rows, {"id": [500.0], "g": None})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<id:bigint,g:bigint>" in plan
    assert plan.index("partial_count") > plan.index("Exchange")  # counted before the exchange
    report = drift_report(reference_profile(rows, ["id"], ["g"]), rows)
    assert path not in " ".join(report.inputFiles())


def test_reach_of_any_range_of_days_from_daily_sketches(spark):
    rows = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")).alias("publish_date"),
        F.when(F.col("id") % 3 > 0, 10).alias("category_id"), F.concat(F.lit("v"), F.col("id") % 20_000).alias("video_id"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id") % 50)).alias("channel_title"))
    daily = gold.daily_reach(rows)
    for days in (1, 10, 60):
        until = F.date_add(F.lit("2024-01-01").cast("date"), days)
        got = gold.distinct_reach(daily.filter(F.col("publish_date") < until), []).first()
        want = rows.filter(F.col("publish_date") < until).agg(
            F.countDistinct("video_id"), F.countDistinct("channel_title"), F.count(F.lit(1))).first()
        assert abs(got["videos_estimate"] - want[0]) <= max(1, gold.REACH_BOUND * want[0])
        assert abs(got["channels_estimate"] - want[1]) <= max(1, gold.REACH_BOUND * want[1])
        assert got["video_rows"] == want[2]
    assert gold.distinct_reach(gold.daily_reach(rows.limit(0)), ["category_id"]).count() == 0
