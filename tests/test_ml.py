"""Model split, registry, scoring features, retrain decision."""

import pytest
from pyspark.sql import functions as F

from vidlake.operators import ml
from vidlake.plans.catalog import silver_of


def test_split_is_disjoint_complete_and_stable(spark, sf_small):
    frame = ml.training_frame(silver_of(spark, sf_small))
    parts = ml.split_frame(frame)
    ids = [set(r.video_id for r in p.select("video_id").collect()) for p in parts]   # a video stays in one split
    assert not (ids[0] & ids[1]) and not (ids[0] & ids[2]) and not (ids[1] & ids[2])
    assert sum(p.count() for p in parts) == frame.count() == silver_of(spark, sf_small).count()
    assert 0.7 < parts[0].count() / frame.count() < 0.9
    again = ml.split_frame(frame.repartition(3))
    assert ids[1] == set(r.video_id for r in again[1].select("video_id").collect())


def test_training_frame_keeps_one_row_per_silver_row(spark, sf_small):
    silver = silver_of(spark, sf_small)
    assert silver.count() > silver.select("video_id").distinct().count()      # repeated ids are there
    frame = ml.training_frame(silver)
    assert frame.count() == silver.count()
    assert "Join" not in frame._jdf.queryExecution().optimizedPlan().toString()
    back = frame.join(silver.select("video_id", "publish_time", "views"), ["video_id", "publish_time"])
    assert back.filter(F.col("views").cast("double") != F.col("label_views")).count() == 0


def test_scoring_defaults(spark):
    df = spark.createDataFrame([("x", None, None, None, None, None, None, None)], ml.SCORING_INPUT_SCHEMA
                               if hasattr(ml, "SCORING_INPUT_SCHEMA") else
                               "video_id string, title string, description string, tags array<string>, "
                               "category_id int, publish_hour int, publish_day_of_week int, publish_month int")
    r = ml.scoring_features(df).collect()[0]
    assert (r.publish_hour, r.publish_day_of_week, r.publish_month, r.category_id) == (12, 3, 6, 24)
    assert r.tag_count == 0 and r.title_length == 0 and r.is_weekend == 0
    assert r.hour_sin == pytest.approx(0.0, abs=1e-12) and r.hour_cos == pytest.approx(-1.0)


def test_registry_gate_latest_and_batch_scoring(spark, sf_small, scratch):
    train, valid, test = ml.split_frame(ml.training_frame(silver_of(spark, sf_small)))
    model = ml.fit(ml.regressors()["linear_regression"], train)
    metrics = ml.regression_metrics(model.transform(valid)).first().asDict()
    reg = scratch("registry")
    assert ml.save_model(spark, model, reg, "m", metrics, gate=("r2", 2.0)) is None  # unreachable bar
    ml.save_model(spark, model, reg, "m", metrics, version="20240101_000000")
    ml.save_model(spark, model, reg, "m", metrics, version="20240201_000000")
    loaded, meta = ml.load_latest(spark, reg, "m")
    assert meta["timestamp"] == "20240201_000000" and meta["features"] == ml.MODEL_FEATURES
    inputs = ml.scoring_input_from_silver(silver_of(spark, sf_small))
    preds = ml.predict(loaded, inputs, meta["timestamp"], ml.residual_interval(loaded, valid))
    r = preds.agg(F.count("*").alias("n"),
                  F.min(F.col("predicted_views_hi") - F.col("predicted_views_lo")).alias("w")).first()
    assert r.n == inputs.count() and r.w >= 0
    with pytest.raises(FileNotFoundError):
        ml.load_latest(spark, reg, "missing")


def test_retrain_decision():
    assert ml.retrain_decision({"r2": 0.5}, {"r2": 0.7}, 0.1)["retrain"]
    assert ml.retrain_decision({"r2": 0.69}, {"r2": 0.7}, 0.5)["drifted"]
    assert not ml.retrain_decision({"r2": 0.69}, {"r2": 0.7}, 0.1)["retrain"]


def test_cross_validated_tuning(spark, sf_small):
    train, _, _ = ml.split_frame(ml.training_frame(silver_of(spark, sf_small)))
    best = ml.tune(train, folds=2, num_trees=(5,), max_depth=(3, 4))
    assert best.stages[-1].getNumTrees == 5
    assert len(ml.feature_importances(best)) == len(ml.MODEL_FEATURES)


def test_classifier_scores_after_an_observation(spark, sf_small):
    # a session that has served an Observation must still score a fitted
    # logistic regression (its training summary would drag the session along)
    from pyspark.sql import Observation
    obs = Observation("probe")
    spark.range(5).observe(obs, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert obs.get["n"] == 5
    train, valid, _ = ml.split_frame(ml.training_frame(silver_of(spark, sf_small)))
    m = ml.classification_metrics(ml.fit(ml.classifiers()["logistic_regression"], train).transform(valid))
    assert 0.0 <= m["accuracy"] <= 1.0
