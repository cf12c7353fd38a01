"""Linear and logistic models, conformal intervals and the registry's commit marker against numpy and counting."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidlake.operators import linear, ml

FEATURES = ("a", "b", "c", "k")


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(4)
    n = 3000
    x = np.column_stack([rng.normal(100, 3, n), rng.normal(0, 1, n), rng.integers(0, 2, n), np.full(n, 7.0)])
    y = 5 + 2 * x[:, 0] - 3 * x[:, 1] + x[:, 2] + rng.normal(0, 1, n)
    t = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 1] - x[:, 2])))).astype(float)
    g = rng.choice(["p", "p", "p", "q"], n)
    rows = [(f"v{i}", *map(float, x[i]), float(y[i]), float(t[i]), str(g[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "video_id string, a double, b double, c double, k double, y double, t double, g string").repartition(4)
    return df, x, y, t


def test_ridge_equals_least_squares(sample):
    df, x, y, _ = sample
    sums = linear.product_sums(df.withColumn("_one", F.lit(1.0)), ["_one", *FEATURES, "y"])[0]
    m = linear.ridge(sums, FEATURES)
    want = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x[:, :3]]), y, rcond=None)[0]
    assert np.allclose([m.intercept, *m.weights[:3]], want, rtol=1e-7) and m.weights[3] == 0      # k is constant
    left = y - want[0] - x[:, :3] @ want[1:]
    assert linear.r2_of(sums, m) == pytest.approx(1 - (left @ left) / ((y - y.mean()) @ (y - y.mean())), rel=1e-7)
    strong = linear.ridge(sums, FEATURES, 10.0)
    assert abs(strong.weights[0]) < abs(m.weights[0])


def test_tuning_equals_refitting_every_fold(sample):
    df, x, y, _ = sample
    model, best, scores = linear.tune_ridge(df, FEATURES, "y")
    folds = {r.video_id: r.f for r in df.select("video_id", linear.fold_number().alias("f")).collect()}
    of = np.array([folds[f"v{i}"] for i in range(len(y))])
    r2 = []
    for f in range(linear.FOLDS):
        a = np.column_stack([np.ones(len(y)), x[:, :3]])
        w = np.linalg.lstsq(a[of != f], y[of != f], rcond=None)[0]
        e = y[of == f] - a[of == f] @ w
        r2.append(1 - (e @ e) / ((y[of == f] - y[of == f].mean()) ** 2).sum())
    assert scores[0.0] == pytest.approx(np.mean(r2), rel=1e-7) and scores[best] == max(scores.values())
    got = df.select(F.avg((model.score() - F.col("y")) ** 2)).first()[0]
    assert got < 1.2


def test_folds_need_no_further_scan(sample, spark):
    """All folds and penalties come from one aggregate."""
    df = sample[0]
    seen = spark.sparkContext.accumulator(0)
    look = F.udf(lambda v: seen.add(1) or v, "double").asNondeterministic()      # evaluated once a row
    linear.tune_ridge(df.withColumn("y", look("y")), FEATURES, "y", strengths=(0.0, 0.1, 1.0, 10.0))
    assert seen.value == df.count()


def test_logistic_has_no_gradient_left(sample):
    df, x, _, t = sample
    m = linear.logistic(df, FEATURES, "t", penalty=0.0)
    p = 1 / (1 + np.exp(-(m.intercept + x @ np.array(m.weights))))
    assert np.abs((t - p) @ np.column_stack([np.ones(len(t)), x[:, :3]])).max() < 1e-4 and m.weights[3] == 0
    r = linear.binary_metrics(df.withColumn("prediction", m.score()), "t").first()
    said = p >= 0.5
    assert r.rows == len(t) and r.accuracy == pytest.approx((said == t).mean()) and r.precision == pytest.approx(t[said].mean())
    assert r.log_loss == pytest.approx(-np.mean(t * np.log(p) + (1 - t) * np.log(1 - p)), rel=1e-6)


def test_conformal_intervals(spark):
    rng = np.random.default_rng(9)
    scale = {"p": 1.0, "q": 10.0, None: 3.0}
    draw = lambda n: [(g, float(rng.normal(0, scale[g])), 0.0) for g in rng.choice(["p", "p", "q", None], n)]
    cal = draw(4000) + [("few", 1.0, 0.0)] * 3
    frame = lambda rows: spark.createDataFrame(rows, "g string, y double, prediction double")
    widths, pooled = linear.conformal_widths(frame(cal), "g", "y", coverage=0.9)
    got = {r.grp: r.width for r in widths.collect()}
    at = lambda rs: sorted(rs)[math.ceil((len(rs) + 1) * 0.9) - 1]
    assert set(got) == {"p", "q", None} and pooled == at([abs(y) for _, y, _ in cal])
    for g in got:
        assert got[g] == at([abs(y) for h, y, _ in cal if h == g])
    new = linear.with_intervals(frame(draw(4000) + [("few", 0.0, 0.0), ("unseen", 0.0, 0.0)]), widths, pooled, "g")
    shares = {r.g: r for r in new.groupBy("g").agg(F.avg(F.col("y").between(F.col("lo"), F.col("hi")).cast("int")).alias("in"),
                                                  F.max("own_group").alias("own"), F.max("hi").alias("hi")).collect()}
    assert all(shares[g]["in"] > 0.87 and shares[g].own for g in ("p", "q", None))
    assert shares["few"].hi == shares["unseen"].hi == pooled and not shares["few"].own
    none, nothing = linear.conformal_widths(frame(cal).limit(0), "g", "y")
    assert none.count() == 0 and nothing is None


def test_a_torn_version_is_passed_over(spark, scratch):
    rows = [(f"v{i}", float(i), *([float(i % 5)] * len(ml.MODEL_FEATURES))) for i in range(60)]
    df = spark.createDataFrame(rows, "video_id string, label_views double, " + ", ".join(f"{c} double" for c in ml.MODEL_FEATURES))
    model = ml.fit(ml.regressors()["linear_regression"], df)
    reg = scratch("torn")
    ml.save_model(spark, model, reg, "m", {"r2": 0.5}, version="20240101_000000")
    model.write().save(f"{reg}/m/20240301_000000/model")                     # no metadata, no marker: its writer was lost
    ml.save_model(spark, model, reg, "m", {"r2": 0.6}, version="20240201_000000")
    fs, marker = ml._fs(spark, f"{reg}/m/20240201_000000/{ml.COMMITTED}")
    assert ml.load_latest(spark, reg, "m")[1]["timestamp"] == "20240201_000000"
    fs.delete(marker, False)                                                 # as while it is written anew
    assert ml.load_latest(spark, reg, "m")[1]["timestamp"] == "20240101_000000"
    only = scratch("torn_only")
    model.write().save(f"{only}/m/20240301_000000/model")
    with pytest.raises(FileNotFoundError, match="committed"):
        ml.load_latest(spark, only, "m")
