"""Model features, training, registry and batch scoring (ML-1..ML-12).

Training and serving share one feature function (``scoring_features``), so a
model never sees differently computed inputs at scoring time.  Everything is
Spark ML: ``VectorAssembler -> StandardScaler -> estimator`` saved as one
``PipelineModel`` (no pickles).  Scoring is a batch ``transform`` over a
DataFrame of any size.
"""

from __future__ import annotations

import datetime as dt
import json
import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, LogisticRegressionModel,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlake.functions import text as tx
from vidlake.operators.joins import join_checked_broadcast
from vidlake.operators.ranking import exact_percentiles
from vidlake.session import materialize, scratch_path

# Fixed defaults for missing scoring inputs.
DEFAULTS = {"publish_hour": 12, "publish_day_of_week": 3, "publish_month": 6, "category_id": 24}
# The columns of the scoring contract.
MODEL_FEATURES = ["publish_hour", "publish_day_of_week", "publish_month", "is_weekend", "title_length",
                  "title_word_count", "title_has_question", "title_has_exclamation", "description_length",
                  "tag_count", "category_id", "hour_sin", "hour_cos"]
SPLIT_WEIGHTS = (0.8, 0.1, 0.1)
SEED = 42
ENGAGEMENT_LABEL_THRESHOLD = 0.05
DEGRADATION_THRESHOLD = 0.1
COMMITTED = "_COMMITTED"


# ---------------------------------------------------------------- features

def scoring_input_from_silver(silver: DataFrame, *more: Column) -> DataFrame:
    """Scoring-input shape (``SCORING_INPUT_SCHEMA``) from silver rows, with
    ``more`` columns beside it.  Silver rows without descriptions give their
    ``description_length`` instead."""
    return silver.select(
        "video_id", "title", "description" if "description" in silver.columns else "description_length",
        F.when(F.col("tags").isNotNull(), F.split("tags", r"\|")).alias("tags"),
        "category_id", "publish_hour", "publish_day_of_week", "publish_month", *more)


def scoring_features(inputs: DataFrame, carry=()) -> DataFrame:
    """ML-1: defaults for missing fields, text and time features, nulls -> 0;
    the columns in ``carry`` pass through.  Inputs without ``description`` may
    have its ``description_length``, the one thing that is read of it."""
    def opt(c, default):
        return F.coalesce(F.col(c), F.lit(default)) if c in inputs.columns else F.lit(default)
    title = opt("title", "")
    length = F.length(opt("description", "")) if "description" in inputs.columns else opt("description_length", 0).cast("int")
    tags = F.col("tags") if "tags" in inputs.columns else F.lit(None).cast("array<string>")
    hour = opt("publish_hour", DEFAULTS["publish_hour"]).cast("int")
    dow = opt("publish_day_of_week", DEFAULTS["publish_day_of_week"]).cast("int")
    out = inputs.select(
        (F.col("video_id") if "video_id" in inputs.columns else F.lit(None).cast("string")).alias("video_id"),
        hour.alias("publish_hour"),
        dow.alias("publish_day_of_week"),
        opt("publish_month", DEFAULTS["publish_month"]).cast("int").alias("publish_month"),
        F.when(dow.isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.length(title).alias("title_length"),
        tx.word_count(title).alias("title_word_count"),
        tx.has_question(title).alias("title_has_question"),
        tx.has_exclamation(title).alias("title_has_exclamation"),
        length.alias("description_length"),
        F.when(tags.isNull(), F.lit(0)).otherwise(F.size(tags)).alias("tag_count"),
        opt("category_id", DEFAULTS["category_id"]).cast("int").alias("category_id"),
        F.sin(F.lit(2 * math.pi) * hour / F.lit(24)).alias("hour_sin"),
        F.cos(F.lit(2 * math.pi) * hour / F.lit(24)).alias("hour_cos"),
        *[F.col(c) for c in carry],
    )
    return out.fillna(0, subset=MODEL_FEATURES)


def training_frame(silver: DataFrame) -> DataFrame:
    """Features + targets for training: views (regression) and high engagement
    (classification), one row per silver row, in a single projection."""
    labels = {"publish_time": F.col("publish_time"), "label_views": F.col("views").cast("double"),
              "label_engaged": (F.col("engagement_rate") >= ENGAGEMENT_LABEL_THRESHOLD).cast("double")}
    inputs = scoring_input_from_silver(silver, *(c.alias(n) for n, c in labels.items()))
    return scoring_features(inputs, carry=list(labels))


# ---------------------------------------------------------------- splits

def split_number(key: str = "video_id", weights=SPLIT_WEIGHTS, seed: int = SEED) -> Column:
    """ML-4: 0 (train), 1 (validation) or 2 (test) from the first 32 bits of
    the MD5 of key and seed.  Unlike a sampler over partition order, a
    recomputed partition (lost executor, different partitioning) lands every
    row in the same split, all rows of one video in one, and any engine can
    tell a row's split."""
    digest = F.md5(F.concat_ws(":", F.col(key), F.lit(str(seed))).cast("binary"))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000
    bounds = [round(10_000 * sum(weights[:i + 1]) / sum(weights)) for i in range(len(weights) - 1)]
    return sum(((share >= b).cast("int") for b in bounds), F.lit(0))


def split_frame(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int = SEED, key: str = "video_id"):
    """The train, validation and test rows."""
    number = split_number(key, weights, seed)
    return [df.filter(number == i) for i in range(len(weights))]


# ---------------------------------------------------------------- estimators

def _pipeline(estimator) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=MODEL_FEATURES, outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        estimator,
    ])


def fit(estimator, train: DataFrame) -> PipelineModel:
    """Fit ``assembler -> scaler -> estimator``.

    A fitted logistic-regression model keeps its training summary, which
    holds the session; once the session has served an ``Observation`` it no
    longer serialises, and scoring tasks fail.  Such models are saved to the
    shared checkpoint folder and loaded back (a loaded model has no summary).
    """
    model = _pipeline(estimator).fit(train)
    if any(getattr(st, "hasSummary", False) and isinstance(st, LogisticRegressionModel) for st in model.stages):
        path = scratch_path(train.sparkSession, "fitted_model")
        model.write().overwrite().save(path)
        model = PipelineModel.load(path)
    return model


def regressors(label: str = "label_views") -> dict:
    """ML-5 (gradient boosting stands in for the XGBoost entry)."""
    return {
        "linear_regression": LinearRegression(labelCol=label, featuresCol="features", regParam=0.0),
        "random_forest": RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=50, seed=SEED),
        "gradient_boosting": GBTRegressor(labelCol=label, featuresCol="features", maxIter=30, seed=SEED),
    }


def classifiers(label: str = "label_engaged") -> dict:
    """ML-6."""
    n = len(MODEL_FEATURES)
    return {
        "logistic_regression": LogisticRegression(labelCol=label, featuresCol="features"),
        "gradient_boosting": GBTClassifier(labelCol=label, featuresCol="features", maxIter=30, seed=SEED),
        "neural_network": MultilayerPerceptronClassifier(labelCol=label, featuresCol="features",
                                                         layers=[n, 16, 2], seed=SEED, maxIter=100),
    }


def regression_metrics(pred: DataFrame, label: str = "label_views") -> DataFrame:
    """ML-7 (regression) in one aggregate pass: RMSE, MAE, R2, MAPE."""
    y, p = F.col(label), F.col("prediction")
    err = p - y
    agg = pred.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
                   F.sum(err * err).alias("_sse"), F.var_pop(y).alias("_var"), F.count(y).alias("_n"),
                   F.avg(F.abs(F.try_divide(err, F.nullif(y, F.lit(0.0))))).alias("mape"))
    r2 = F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("_n"))
    return agg.select("rmse", "mae", r2.alias("r2"), "mape")


def classification_metrics(pred: DataFrame, label: str = "label_engaged") -> dict:
    """ML-7 (classification): accuracy, weighted precision/recall, F1, AUC."""
    mc = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction")
    out = {m: mc.setMetricName(m).evaluate(pred)
           for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1")}
    if "rawPrediction" in pred.columns:
        out["auc"] = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction").evaluate(pred)
    return out


def train_and_select(train: DataFrame, valid: DataFrame, test: DataFrame, candidates: dict | None = None,
                     label: str = "label_views"):
    """ML-8: fit every candidate, pick the best validation R2, evaluate the
    winner once on test.  Returns (best_name, model, metrics rows)."""
    candidates = candidates or regressors(label)
    rows, best = [], None
    for name, est in candidates.items():
        model = fit(est, train)
        m = regression_metrics(model.transform(valid), label).first().asDict()
        rows.append({"model": name, "split": "validation", **m})
        if best is None or (m["r2"] is not None and m["r2"] > best[2]):
            best = (name, model, m["r2"] if m["r2"] is not None else float("-inf"))
    tm = regression_metrics(best[1].transform(test), label).first().asDict()
    rows.append({"model": best[0], "split": "test", **tm})
    return best[0], best[1], rows


def feature_importances(model: PipelineModel) -> list[tuple[str, float]]:
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray().tolist()
    elif hasattr(last, "coefficients"):
        vals = [abs(v) for v in last.coefficients.toArray().tolist()]
    else:
        return []
    return sorted(zip(MODEL_FEATURES, vals), key=lambda kv: -kv[1])


def tune(train: DataFrame, label: str = "label_views", folds: int = 5, parallelism: int = 2,
         num_trees=(20, 50), max_depth=(5, 8)) -> PipelineModel:
    """ML-9: k-fold cross validation over a grid for the forest."""
    rf = RandomForestRegressor(labelCol=label, featuresCol="features", seed=SEED)
    grid = ParamGridBuilder().addGrid(rf.numTrees, list(num_trees)).addGrid(rf.maxDepth, list(max_depth)).build()
    cv = CrossValidator(estimator=_pipeline(rf), estimatorParamMaps=grid, numFolds=folds, seed=SEED,
                        evaluator=RegressionEvaluator(labelCol=label, metricName="r2"), parallelism=parallelism)
    return cv.fit(train).bestModel


# ---------------------------------------------------------------- registry

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def save_model(spark: SparkSession, model: PipelineModel, registry: str, name: str, metrics: dict,
               gate: tuple[str, float] | None = None, version: str | None = None) -> str | None:
    """ML-10: ``registry/name/version/{model,metadata}``; skipped (None) when
    ``gate=(metric, minimum)`` is not met.  A version counts once its marker
    ``_COMMITTED`` is there, which is written after all else."""
    if gate is not None:
        metric, minimum = gate
        if metrics.get(metric) is None or metrics[metric] < minimum:
            return None
    version = version or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    base = f"{registry.rstrip('/')}/{name}/{version}"
    fs, marker = _fs(spark, f"{base}/{COMMITTED}")
    if fs.exists(marker):                      # a version that is written again does not count meanwhile
        fs.delete(marker, False)
    model.write().overwrite().save(f"{base}/model")
    meta = {"timestamp": version, "model_name": name, "features": MODEL_FEATURES,
            "metrics": {k: (None if v is None else float(v)) for k, v in metrics.items()}}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{base}/metadata")
    fs, marker = _fs(spark, f"{base}/{COMMITTED}")
    fs.create(marker, True).close()
    return base


def load_latest(spark: SparkSession, registry: str, name: str):
    """ML-3: newest committed version (lexicographic max), its model and
    metadata.  Versions without a marker (a writer that is still at work, or
    was lost) are passed over."""
    fs, p = _fs(spark, f"{registry.rstrip('/')}/{name}")
    if not fs.exists(p):
        raise FileNotFoundError(f"no model named {name!r} in {registry}")
    marker = lambda at: _fs(spark, f"{at.toString()}/{COMMITTED}")[1]
    versions = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and fs.exists(marker(s.getPath())))
    if not versions:
        raise FileNotFoundError(f"no committed versions of {name!r} in {registry}")
    base = f"{registry.rstrip('/')}/{name}/{versions[-1]}"
    meta = json.loads(spark.read.text(f"{base}/metadata").first()[0])
    return PipelineModel.load(f"{base}/model"), meta


# ---------------------------------------------------------------- scoring

def predict(model: PipelineModel, inputs: DataFrame, model_version: str, interval: DataFrame | None = None) -> DataFrame:
    """ML-2 (+ ML-12 when ``interval`` holds the residual quantiles)."""
    scored = model.transform(scoring_features(inputs))
    out = scored.select("video_id", F.col("prediction").alias("predicted_views"),
                        F.current_timestamp().alias("prediction_timestamp"),
                        F.lit(model_version).alias("model_version"))
    if interval is not None:
        bounds = interval.first()
        out = out.withColumns({"predicted_views_lo": F.col("predicted_views") + F.lit(bounds["residual_lo"]),
                               "predicted_views_hi": F.col("predicted_views") + F.lit(bounds["residual_hi"])})
    return out


def residual_interval(model: PipelineModel | DataFrame, valid: DataFrame | None = None, label: str = "label_views",
                      coverage: float = 0.9) -> DataFrame:
    """ML-12: empirical interval from validation residuals (one-row frame),
    exact quantiles.  ``model`` scores ``valid``, or is a frame of predictions
    itself."""
    a = (1 - coverage) / 2
    scored = model if isinstance(model, DataFrame) else model.transform(valid)
    residuals = scored.select((F.col(label) - F.col("prediction")).alias("r"))
    if not isinstance(model, DataFrame):
        residuals = materialize(residuals, "residuals")       # score once, not once a pass
    lo, hi = exact_percentiles(residuals, "r", [a, 1 - a])
    return residuals.sparkSession.createDataFrame([(lo, hi)], "residual_lo double, residual_hi double")


def category_mean_model(train: DataFrame, rows: DataFrame, label: str = "label_views") -> DataFrame:
    """A deterministic baseline: predict the training mean of the row's
    category (of all rows for a category not seen)."""
    mean = train.groupBy(F.col("category_id").alias("_c")).agg(F.avg(label).alias("_m"))
    overall = train.agg(F.avg(label)).first()[0]
    return (join_checked_broadcast(rows, mean, F.col("category_id").eqNullSafe(F.col("_c")))
            .withColumn("prediction", F.coalesce("_m", F.lit(overall))).drop("_c", "_m"))


def retrain_decision(current: dict, previous: dict | None, drift_psi: float | None,
                     metric: str = "r2", degradation: float = DEGRADATION_THRESHOLD,
                     drift: float = 0.3) -> dict:
    """ML-11: retrain when the metric fell by more than ``degradation`` or the
    input drifted beyond ``drift`` (population stability index, DQ-11)."""
    drop = None
    if previous and previous.get(metric) is not None and current.get(metric) is not None:
        drop = previous[metric] - current[metric]
    degraded = drop is not None and drop > degradation
    drifted = drift_psi is not None and drift_psi > drift
    return {"metric_drop": drop, "degraded": degraded, "drifted": drifted, "retrain": degraded or drifted}
