"""Properties and brute-force checks on random fixtures."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vidlake.functions.metrics import engagement_category
from vidlake.operators import gold
from vidlake.operators.features import channel_history_features

SILVER_MIN = ("video_id string, channel_title string, publish_timestamp timestamp, publish_date date, "
              "views long, likes long, comment_count long, engagement_rate double")


def random_silver(spark, seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ch = "hot" if rnd.random() < 0.4 else f"c{rnd.randint(0, 6)}"  # one channel holds ~40%
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.choice([0, 0, 1, 3, 9, 10, 17, 40, 41]))
        ts = dt.datetime.combine(day, dt.time(rnd.choice([0, 5, 5, 12]), 0))  # many equal timestamps
        v = rnd.choice([None, 0, 10, 500, 999])
        e = None if v is None else rnd.choice([0.0, 0.01, 0.05, 0.2])
        rows.append((f"v{i:04d}", ch, ts, day, v, rnd.randint(0, 50), rnd.randint(0, 9), e))
    return spark.createDataFrame(rows, SILVER_MIN)


def brute_force(pdf, windows=(7, 14, 30)):
    out = {}
    for _, g in pdf.groupby("channel_title"):
        g = g.sort_values(["publish_timestamp", "video_id"]).reset_index(drop=True)
        gaps = []
        prev_date = None
        prev_eng = None
        for i, r in g.iterrows():
            hist = g.iloc[:i]
            v = hist["views"].dropna()
            e = hist["engagement_rate"].dropna()
            gap = None if prev_date is None else (r.publish_date - prev_date).days
            known = [x for x in gaps if x is not None]
            sd = statistics_stdev(known)
            res = {
                "channel_avg_views_historical": v.mean() if len(v) else None,
                "channel_avg_engagement_historical": e.mean() if len(e) else None,
                "channel_video_count_historical": len(hist),
                "days_since_last_upload": gap,
                "channel_consistency_score": None if sd is None else 1 / (sd + 1),
                "engagement_growth_rate": None if (prev_eng is None or pd.isna(prev_eng) or prev_eng == 0
                                                   or pd.isna(r.engagement_rate))
                else (r.engagement_rate - prev_eng) / prev_eng,
            }
            for n in windows:
                lo = r.publish_date - dt.timedelta(days=n)
                w = g[(g.publish_date >= lo) & (g.publish_date < r.publish_date)]
                wv = w["views"].dropna()
                res[f"rolling_avg_views_{n}d"] = wv.mean() if len(wv) else None
                res[f"rolling_sum_views_{n}d"] = wv.sum() if len(wv) else None
                res[f"rolling_max_views_{n}d"] = wv.max() if len(wv) else None
                res[f"rolling_video_count_{n}d"] = len(w)
            out[r.video_id] = res
            gaps.append(gap)
            prev_date, prev_eng = r.publish_date, r.engagement_rate
    return out


def statistics_stdev(xs):
    if len(xs) < 2:
        return None
    m = sum(xs) / len(xs)
    return math.sqrt(sum((x - m) ** 2 for x in xs) / (len(xs) - 1))


def _same(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    if b is None:
        return False
    return a == pytest.approx(b, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("seed,parts", [(1, None), (2, 13), (3, 40)])
def test_channel_history_equals_brute_force(spark, seed, parts):
    # parts=13/40: a hot (channel, day) spans several ordered slices
    s = random_silver(spark, seed)
    got = {r.video_id: r.asDict() for r in channel_history_features(s, num_partitions=parts).collect()}
    pdf = s.toPandas()
    pdf["views"] = pdf["views"].astype("float")
    want = brute_force(pdf)
    assert set(got) == set(want)
    for vid, exp in want.items():
        for k, v in exp.items():
            assert _same(got[vid][k], v), (vid, k, got[vid][k], v)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(min_value=0, max_value=1, allow_nan=False)), min_size=1, max_size=20))
def test_engagement_category_agrees_with_rate(spark, rates):
    df = spark.createDataFrame([(r,) for r in rates], "r double")
    for r in df.select("r", engagement_category(F.col("r")).alias("c")).collect():
        exp = "high" if r.r is not None and r.r >= 0.05 else ("medium" if r.r is not None and r.r >= 0.02 else "low")
        assert r.c == exp


def test_percent_rank_bounds_and_optimal_flag(spark, sf_small):
    from vidlake.plans.catalog import silver_of
    p = gold.posting_time_analysis(silver_of(spark, sf_small)).collect()
    assert all(0.0 <= r.views_percentile <= 1.0 and 0.0 <= r.engagement_percentile <= 1.0 for r in p)
    assert all(r.is_optimal_time == (r.views_percentile >= 0.8 and r.engagement_percentile >= 0.8) for r in p)


def test_row_number_dense_from_one(spark, sf_small):
    from vidlake.plans.catalog import silver_of
    t = gold.trending_videos(silver_of(spark, sf_small)).groupBy("category_id").agg(
        F.count("*").alias("n"), F.max("trending_rank_in_category").alias("mx"),
        F.count_distinct("trending_rank_in_category").alias("d"))
    assert all(r.n == r.mx == r.d for r in t.collect())


@pytest.mark.parametrize("batch", [3, 10000])
def test_row_number_within_matches_window(spark, batch):
    from pyspark.sql import Window

    from vidlake.operators.ranking import row_number_within

    rnd = random.Random(batch)
    rows = [(("hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])), rnd.choice([1.0, 2.0, 3.0, None]), i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "k string, x double, id int")
    order = [F.col("x").desc_nulls_last(), F.col("id").asc()]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = {r.id: r.rn for r in row_number_within(df, ["k"], order, "rn", num_partitions=7).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
            .collect()}
    assert got == want


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_exact_percentile_matches_quantile_disc(spark, seed):
    import duckdb

    from vidlake.operators.ranking import exact_percentile

    rnd = random.Random(seed)
    vals = [rnd.choice([0.0, 0.0, 0.0, None]) if rnd.random() < 0.3 else rnd.lognormvariate(3, 2) * rnd.choice([1, -1])
            for _ in range(3000)]
    vals += [7.5] * 500  # a hot value
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in vals])
    for p in (0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0):
        want = con.sql(f"SELECT quantile_disc(x, {p}) FROM t").fetchall()[0][0]
        assert exact_percentile(df, "x", p, buckets=8) == want, p
        assert exact_percentile(df, "x", p) == want, p


def test_exact_percentiles_shared_pass(spark):
    import duckdb

    from vidlake.operators.ranking import exact_percentiles

    rnd = random.Random(5)
    vals = [rnd.randint(0, 50) for _ in range(700)] + [None] * 20
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    ps = [0.75, 0.5, 0.75, 0.9, 0.0, 1.0]
    con = duckdb.connect()
    want = [con.execute(f"SELECT quantile_disc(x, {p}) FROM (SELECT unnest(?) AS x)", [vals]).fetchall()[0][0]
            for p in ps]
    assert exact_percentiles(df, "x", ps) == want
    assert exact_percentiles(df, "x", ps, buckets=4) == want


@pytest.mark.parametrize("buckets,bands", [(1024, 4096), (4, 4096), (1024, 0), (4, 0)])
def test_grouped_percentiles_match_quantile_disc(spark, buckets, bands):
    import duckdb

    from vidlake.operators.ranking import grouped_percentiles

    rnd = random.Random(11)
    rows = []
    for i in range(2500):
        g = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", "c", None])
        v = None if rnd.random() < 0.05 else rnd.choice([rnd.randint(-50, 50), rnd.randint(0, 10**6), 7])
        rows.append((g, v))
    rows.append(("solo", 3))
    df = spark.createDataFrame(rows, "g string, v long")
    ps = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.g: tuple(r[n] for n in ps) for r in grouped_percentiles(df, ["g"], "v", ps, buckets, bands).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (g VARCHAR, v BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    sel = ", ".join(f"quantile_disc(v, {p})" for p in ps.values())
    want = {r[0]: tuple(r[1:]) for r in con.sql(f"SELECT g, {sel} FROM t WHERE v IS NOT NULL GROUP BY g").fetchall()}
    assert got == want


@pytest.mark.parametrize("bands", [4096, 0])
@pytest.mark.parametrize("rows_on_driver", [1 << 18, 100])
def test_percentiles_outside_their_brackets_are_found(spark, monkeypatch, bands, rows_on_driver):
    """With the smallest sketches and no margin many ranks lie outside their brackets; results stay exact, also
    where the values inside are narrowed in the scratch folder."""
    from vidlake.operators import ranking

    monkeypatch.setattr(ranking, "SKETCH", 8)
    monkeypatch.setattr(ranking, "GROUP_SKETCH", 8)
    monkeypatch.setattr(ranking, "MARGIN", 1e-9)
    monkeypatch.setattr(ranking, "PASS_ROWS", rows_on_driver)
    rnd = random.Random(3)
    rows = [(rnd.choice("aaab"), rnd.choice([rnd.gauss(0, 1), 0.25])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    ps = {f"p{i}": i / 4 for i in range(5)}
    disc = lambda vs, p: sorted(vs)[max(1, math.ceil(p * len(vs))) - 1]
    every = [v for _, v in rows]
    assert ranking.exact_percentiles(df, "v", list(ps.values())) == [disc(every, p) for p in ps.values()]
    for r in ranking.grouped_percentiles(df, ["g"], "v", ps, 16, bands).collect():
        mine = [v for g, v in rows if g == r.g]
        assert [r[n] for n in ps] == [disc(mine, p) for p in ps.values()]


@pytest.mark.parametrize("bands", [4096, 0])
def test_percentiles_scan_their_rows_twice(spark, bands, scratch):
    """Rows are read by one scan for the sketches and one for the brackets, whatever the percentiles."""
    from pyspark.sql.functions import udf

    from vidlake.operators.ranking import grouped_percentiles

    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x

    n = 20_000
    df = spark.range(n, numPartitions=4).select(F.col("id") % 2, udf(look, "double")(F.rand(7) * 1e6)).toDF("g", "v")
    grouped_percentiles(df, ["g"], "v", {"a": 0.1, "b": 0.5, "c": 0.99}, 64, bands).collect()
    assert n <= seen.value <= 2 * n


@pytest.mark.parametrize("bands", [4096, 0])
def test_percentiles_keep_type_and_value_at_the_ends_of_a_type(spark, bands):
    from vidlake.operators.ranking import exact_percentiles, grouped_percentiles

    near = 2**60
    for kind, values in (("long", [near + i for i in (0, 1, 3, 4)]), ("long", [-2**63, -1, 0, 2**63 - 1]),
                         ("int", [-2**31, 5, 6, 2**31 - 1]), ("double", [-1.7e308, -0.0, 5e-324, 1.7e308]),
                         ("double", [5e-324, 1e-323, 1.5e-323, 2e-323])):
        df = spark.createDataFrame([("g", v) for v in values] + [("g", None)], f"g string, x {kind}")
        assert exact_percentiles(df, "x", [0.25, 0.5, 0.75, 1.0], buckets=2) == sorted(values)
        out = grouped_percentiles(df, ["g"], "x", {"a": 0.25, "b": 0.5, "c": 0.75, "d": 1.0}, 2, bands)
        assert out.schema["a"].dataType == df.schema["x"].dataType
        assert list(out.first())[1:] == sorted(values)
    nothing = spark.createDataFrame([], "g string, x double")
    assert exact_percentiles(nothing, "x", [0.5]) == [None]
    assert grouped_percentiles(nothing, ["g"], "x", {"a": 0.5}, driver_bands=bands).count() == 0
    odd = spark.createDataFrame([("g", float("nan")), ("g", 1.0)], "g string, x double")
    assert exact_percentiles(odd, "x", [1.0]) == [1.0]
