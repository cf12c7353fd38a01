"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each builds from the driver's parquet tables (events x documents through the
bronze adapter), so its work grows with the tables.  Double columns are
rounded to 6 places for the cross-engine comparison only; the library
operators themselves return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.operators import gold
from vidlake.plans.silver import LINEAGE_COLUMNS, SILVER_COLUMNS, bronze_to_silver
from vidlake.schemas import SILVER_PARTITION_KEYS
from vidlake.session import SHUFFLES_FREED, configure, materialize, scratch_path, settings
from vidlake.sources.adapter import load_bronze
from vidlake.sources.files import read_table
from vidlake.sources.sinks import write_silver

# Fixed reference date of the test adapter (FIXTURES.md section 2).
AS_OF = "2024-01-31"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), places).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


# Columns of silver that the operators of a query read, besides the partition columns: what its silver table holds.
# The choice comes after the whole job (de-duplication compares whole rows), so rows and values are those of full silver.
READS = {name: columns.split() for name, columns in {
    "trending_videos": "video_id publish_time title channel_title publish_date views likes comment_count engagement_rate "
                       "viral_score days_since_publish",
    "daily_metrics": "video_id channel_title publish_date views likes comment_count engagement_rate like_ratio",
    "channel_performance": "video_id channel_title publish_date views likes comment_count engagement_rate viral_score",
    "category_analysis": "video_id channel_title publish_date views engagement_rate viral_score",
    "posting_time_analysis": "video_id publish_hour publish_day_of_week views engagement_rate viral_score",
    "category_performance": "publish_date views likes comment_count",
    "engagement_drivers": "video_id publish_hour publish_day_of_week tag_count title_length engagement_rate",
    "driver_strength": "publish_hour publish_day_of_week tag_count title_length engagement_rate",
    "distinct_reach": "video_id channel_title publish_date",
    "analytics": "video_id publish_time title channel_title publish_date publish_hour publish_day_of_week days_since_publish "
                 "views likes comment_count title_length description_length tag_count engagement_rate like_ratio comment_ratio "
                 "viral_score",
    "channel_slots": "video_id channel_title publish_timestamp publish_date views engagement_rate viral_score",
    "time_of_day": "video_id publish_time publish_date publish_hour publish_day_of_week",
    "features": "video_id publish_time channel_title publish_timestamp publish_date publish_hour publish_day_of_week "
                "days_since_publish views likes comment_count engagement_rate title_word_count title_char_count "
                "title_has_question title_has_exclamation title_has_numbers title_all_caps_ratio description_word_count "
                "description_char_count description_has_link tag_count",
    "models": "video_id publish_time publish_date title description_length tags publish_hour publish_day_of_week views "
              "engagement_rate",
    "quality_dimensions": "video_id title channel_title publish_time publish_date views likes dislikes comment_count",
    "drift": "publish_date views likes comment_count engagement_rate title_length engagement_category",
    "retained_masked": "video_id channel_title publish_date views",
    "weekday_reach": "channel_title publish_day_of_week views engagement_rate",
    "first_rows": "video_id publish_time title views",
    "lineage": "processing_job processed_timestamp",
}.items()}


def write_silver_of(spark: SparkSession, sf_dir: str, path: str, reads=None, derive=None) -> None:
    """Silver derived from the raw tables and written to ``path``: whole, or the columns in ``reads``, so that whole
    descriptions are neither exchanged nor written where nothing reads them.  ``derive`` adds columns computed row by
    row before that."""
    configure(spark)
    silver = bronze_to_silver(load_bronze(spark, sf_dir), as_of=AS_OF)
    silver = derive(silver) if derive else silver
    write_silver(silver if reads is None else silver.select(*reads, *SILVER_PARTITION_KEYS), path)


def silver_of(spark: SparkSession, sf_dir: str, reads=None, derive=None) -> DataFrame:
    """Silver as the jobs see it: derived from the raw tables, written, and read
    back, so that operators with several passes do not derive it again."""
    path = scratch_path(configure(spark), "silver")
    write_silver_of(spark, sf_dir, path, reads, derive)
    return read_table(spark, path)


@register("silver")
def q_silver(spark, sf_dir):
    configure(spark)
    return round_doubles(bronze_to_silver(load_bronze(spark, sf_dir), as_of=AS_OF).drop(*LINEAGE_COLUMNS))


@register("silver_lineage")
def q_silver_lineage(spark, sf_dir):
    """CLN-13: the job that wrote the rows; one time for all of them, none without."""
    return silver_of(spark, sf_dir, READS["lineage"]).groupBy("processing_job").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("processed_timestamp").alias("n_times"),
        F.count_if(F.col("processed_timestamp").isNull()).alias("n_without_time"))


@register("gold_trending_videos")
def q_trending(spark, sf_dir):
    return round_doubles(gold.trending_videos(silver_of(spark, sf_dir, READS["trending_videos"])))


@register("gold_daily_metrics")
def q_daily(spark, sf_dir):
    return round_doubles(gold.daily_metrics(silver_of(spark, sf_dir, READS["daily_metrics"])))


@register("gold_channel_performance")
def q_channel_perf(spark, sf_dir):
    return round_doubles(gold.channel_performance(silver_of(spark, sf_dir, READS["channel_performance"]), as_of=AS_OF))


@register("gold_category_analysis")
def q_category_analysis(spark, sf_dir):
    return round_doubles(gold.category_analysis(silver_of(spark, sf_dir, READS["category_analysis"])))


@register("gold_posting_time_analysis")
def q_posting_time(spark, sf_dir):
    return round_doubles(gold.posting_time_analysis(silver_of(spark, sf_dir, READS["posting_time_analysis"])))


@register("gold_category_performance")
def q_category_performance(spark, sf_dir):
    return round_doubles(gold.category_performance(silver_of(spark, sf_dir, READS["category_performance"])))


@register("gold_engagement_drivers")
def q_engagement_drivers(spark, sf_dir):
    return round_doubles(gold.engagement_drivers(silver_of(spark, sf_dir, READS["engagement_drivers"])))


@register("gold_driver_strength")
def q_driver_strength(spark, sf_dir):
    """AGG-13: rank correlations and shares of variance."""
    from vidlake.operators.drivers import driver_strength
    return round_doubles(driver_strength(silver_of(spark, sf_dir, READS["driver_strength"])))


@register("gold_distinct_reach")
def q_distinct_reach(spark, sf_dir):
    """BLK-5, AGG-4, AGG-8: distinct videos and channels of months and categories from daily sketches, beside the exact
    counts; the estimates themselves have no counterpart in SQL, so that they keep their bound is returned."""
    silver = silver_of(spark, sf_dir, READS["distinct_reach"])
    keys = ["category_id", "year", "month"]
    daily = gold.daily_reach(silver)
    told = gold.distinct_reach(daily.withColumns({"year": F.year("publish_date"), "month": F.month("publish_date")}), keys)
    exact = silver.groupBy("category_id", F.year("publish_date").alias("year"), F.month("publish_date").alias("month")).agg(
        F.countDistinct("video_id").alias("n_videos"), F.countDistinct("channel_title").alias("n_channels"))
    t, e = told.alias("t"), exact.alias("e")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"t.{k}").eqNullSafe(F.col(f"e.{k}"))
    near = lambda est, n: F.abs(F.col(est) - F.col(n)) <= F.greatest(F.lit(1.0), gold.REACH_BOUND * F.col(n))
    return t.join(e, same).select(*[f"e.{k}" for k in keys], "n_videos", "n_channels",
                                  near("videos_estimate", "n_videos").alias("videos_within"),
                                  near("channels_estimate", "n_channels").alias("channels_within"))


def _analytic(name, fn):
    def run(spark, sf_dir):
        return round_doubles(fn(silver_of(spark, sf_dir, READS["analytics"])))
    run.__name__ = name
    register(name)(run)


from vidlake.operators.analytics import ANALYTIC_QUERIES  # noqa: E402

for _n, _f in ANALYTIC_QUERIES.items():
    _analytic(_n, _f)


@register("features")
def q_features(spark, sf_dir):
    from vidlake.operators.features import build_features, text_features
    return round_doubles(build_features(silver_of(spark, sf_dir, READS["features"], text_features)))


def _posting(spark, sf_dir):
    return gold.posting_time_analysis(silver_of(spark, sf_dir, READS["posting_time_analysis"]))


@register("rec_category_top_slots")
def q_rec_category(spark, sf_dir):
    from vidlake.operators.recommend import category_recommendations
    return round_doubles(category_recommendations(_posting(spark, sf_dir), top_n=5))


@register("rec_channel_slots")
def q_rec_channel_slots(spark, sf_dir):
    from vidlake.operators.recommend import channel_slots
    return round_doubles(channel_slots(silver_of(spark, sf_dir, READS["channel_slots"])))


@register("rec_channel_top_slots")
def q_rec_channel_top(spark, sf_dir):
    from vidlake.operators.recommend import channel_recommendations
    return round_doubles(channel_recommendations(silver_of(spark, sf_dir, READS["channel_slots"]), top_n=5))


@register("rec_posting_schedule")
def q_rec_schedule(spark, sf_dir):
    from vidlake.operators.recommend import posting_schedule
    return round_doubles(posting_schedule(_posting(spark, sf_dir), videos_per_week=3))


@register("rec_posting_schedule_diverse")
def q_rec_schedule_diverse(spark, sf_dir):
    from vidlake.operators.recommend import posting_schedule
    return round_doubles(posting_schedule(_posting(spark, sf_dir), videos_per_week=3, diversify=True))


@register("rec_strategy_comparison")
def q_rec_strategy(spark, sf_dir):
    from vidlake.operators.recommend import strategy_comparison
    return round_doubles(strategy_comparison(_posting(spark, sf_dir)))


GENERATED_AT = "2024-01-31T00:00:00"


@register("rec_bundle")
def q_rec_bundle(spark, sf_dir):
    """REC-11, as rows."""
    from vidlake.operators.recommend import flat_bundle, recommendation_bundle
    return round_doubles(flat_bundle(recommendation_bundle(_posting(spark, sf_dir), generated_at=GENERATED_AT)))


SILVER_OUT_ORDER = [c for c in SILVER_COLUMNS if c not in LINEAGE_COLUMNS]


def _landed(spark, sf_dir, base, run_ts="fixed"):
    from vidlake.plans.pipelines import ingest
    configure(spark)
    return ingest(load_bronze(spark, sf_dir), f"{base}/landing", run_ts=run_ts, source="driver tables")


def _silver_job(spark, sf_dir, base, table=None):
    from vidlake.plans.pipelines import bronze_to_silver_job
    landed = _landed(spark, sf_dir, base).outputs["landed"]
    bronze_to_silver_job(spark, landed, f"{base}/silver", as_of=AS_OF, table=table)
    return f"{base}/silver"


@register("pip_ingest")
def q_pip_ingest(spark, sf_dir):
    """PIP-1, SNK-1, SNK-2: validation verdict, landed rows read back, the manifest's own count and columns."""
    from vidlake.sources.files import read_bronze_csv
    configure(spark)
    base = scratch_path(spark, "ingest")
    rep = _landed(spark, sf_dir, base)
    manifest = spark.read.json(f"{base}/landing/_manifests/video_stats_fixed")
    landed = read_bronze_csv(spark, rep.outputs["landed"])
    counted = landed.agg(F.count(F.lit(1)).alias("landed_rows"), F.sum(F.length("description")).alias("description_chars"))
    return counted.withColumns({
        "manifest_rows": manifest.select(F.col("record_count").cast("long")).scalar(),
        "manifest_columns": manifest.select("columns").scalar(), "manifest_source": manifest.select("source").scalar(),
        "is_valid": F.lit(bool(rep.counts["validation"]["is_valid"]))})


@register("pip_landed_csv_to_silver")
def q_csv_silver(spark, sf_dir):
    """SNK-1 -> SRC-1 -> PIP-2 -> SNK-3 -> SRC-2 through files in the shared
    scratch folder; the result must equal the in-memory silver."""
    configure(spark)
    silver = read_table(spark, _silver_job(spark, sf_dir, scratch_path(spark, "csv_silver")))
    return round_doubles(silver.select(*SILVER_OUT_ORDER))


@register("src_csv_by_name")
def q_csv_by_name(spark, sf_dir):
    """SRC-1: a landing whose columns come in another order, with a further
    one among them, gives the same silver."""
    from vidlake.plans.pipelines import LANDED_ROWS, bronze_to_silver_job
    from vidlake.sources import sinks
    configure(spark)
    base = scratch_path(spark, "csv_by_name")
    bronze = load_bronze(spark, sf_dir)
    mixed = bronze.select(F.col("video_id").alias("Video ID"), F.lit("24.01.01").alias("trending_date"),
                          *sorted(c for c in bronze.columns if c != "video_id"))
    landed, _ = sinks.write_bronze_csv(mixed, f"{base}/landing", run_ts="fixed", compression="gzip", rows_per_file=LANDED_ROWS)
    bronze_to_silver_job(spark, landed, f"{base}/silver", as_of=AS_OF)
    return round_doubles(read_table(spark, f"{base}/silver").select(*SILVER_OUT_ORDER))


@register("pip_catalog_silver")
def q_catalog_silver(spark, sf_dir):
    """SNK-6: the silver job registers its table; read by name."""
    import uuid
    configure(spark)
    name = f"silver_{uuid.uuid4().hex[:8]}"
    _silver_job(spark, sf_dir, scratch_path(spark, "catalog"), table=name)
    return round_doubles(spark.table(name).select(*SILVER_OUT_ORDER))


def _pip_gold(name):
    def run(spark, sf_dir):
        from vidlake.plans.pipelines import silver_to_gold_job
        configure(spark)
        base = scratch_path(spark, "gold")
        write_silver_of(spark, sf_dir, f"{base}/silver", READS[name])
        out = silver_to_gold_job(spark, f"{base}/silver", f"{base}/gold", as_of=AS_OF, only=[name])
        return round_doubles(read_table(spark, out.outputs[name]))
    run.__doc__ = f"PIP-3, SNK-4: {name}, written by the job and read back."
    register(f"pip_gold_{name}")(run)


for _n in gold.GOLD_BUILDERS:
    _pip_gold(_n)


@register("pip_features")
def q_pip_features(spark, sf_dir):
    """PIP-4, SNK-5: the feature table, written by the job and read back."""
    from vidlake.operators.features import text_features
    from vidlake.plans.pipelines import features_job
    configure(spark)
    base = scratch_path(spark, "features_job")
    write_silver_of(spark, sf_dir, f"{base}/silver", READS["features"], text_features)
    return round_doubles(read_table(spark, features_job(spark, f"{base}/silver", f"{base}/features").outputs["features"]))


@register("pip_recommendations")
def q_pip_recommendations(spark, sf_dir):
    """PIP-5, SNK-7: the recommendation records, written as JSON by the job and read back."""
    from vidlake.operators.recommend import flat_bundle, recommendation_bundle
    from vidlake.plans.pipelines import recommendations_job, silver_to_gold_job
    configure(spark)
    base = scratch_path(spark, "recommendations_job")
    name = "posting_time_analysis"
    write_silver_of(spark, sf_dir, f"{base}/silver", READS[name])
    posting = silver_to_gold_job(spark, f"{base}/silver", f"{base}/gold", only=[name]).outputs[name]
    out = recommendations_job(spark, posting, f"{base}/out", run_ts="fixed", generated_at=GENERATED_AT)
    schema = recommendation_bundle(read_table(spark, posting), generated_at=GENERATED_AT).schema
    return round_doubles(flat_bundle(spark.read.schema(schema).json(out.outputs["recommendations"])))


@register("src_api_flatten")
def q_api_flatten(spark, sf_dir):
    """SRC-6: API-shaped JSON landed from the driver tables, read back and
    flattened to bronze rows."""
    from vidlake.sources.api import bronze_to_api_responses, land_api_responses, read_api_responses

    configure(spark)
    path = scratch_path(spark, "api_json")
    land_api_responses(bronze_to_api_responses(load_bronze(spark, sf_dir)), path)
    return read_api_responses(spark, path)


@register("stream_incremental_silver")
def q_stream_silver(spark, sf_dir):
    """SRC-7: three runs over four landings.  Early uploads; the others; then
    early uploads again with changed counters, a changed category, and with an
    unparsable time, the last landed once more in a fourth landing.  Silver
    must equal the batch job over all landed rows."""
    from vidlake.plans.pipelines import LANDED_ROWS
    from vidlake.sources import sinks
    from vidlake.streaming.incremental import incremental_silver

    configure(spark)
    base = scratch_path(spark, "stream")
    with settings(spark, SHUFFLES_FREED):
        bronze = materialize(load_bronze(spark, sf_dir), "stream_bronze", **sinks.STAGED)
    early = F.col("publish_time") < F.lit("2024-01-01")
    number = F.substring("video_id", 5, 20).cast("long")
    views = F.col("views").cast("long")
    changed = (bronze.filter(early)
               .withColumn("views", F.when(number % 4 == 0, views + 900).when(number % 4 == 1, views - 1)
                           .otherwise(views).cast("string"))
               .withColumn("category_id", F.when(number % 8 == 0, F.lit("10")).otherwise(F.col("category_id")))
               .withColumn("title", F.when(number % 16 == 4, F.lit("")).otherwise(F.col("title"))))
    junk = bronze.filter(early & (number % 4 == 2)).withColumn("publish_time", F.lit("yesterday"))

    def land(rows, ts):
        sinks.write_bronze_csv(rows, f"{base}/landing", run_ts=ts, compression="gzip", rows_per_file=LANDED_ROWS)

    def run():
        incremental_silver(spark, f"{base}/landing", f"{base}/silver", f"{base}/ckpt", as_of=AS_OF)

    land(bronze.filter(early), "1")
    run()
    land(bronze.filter(~early | early.isNull()), "2")
    land(changed.unionByName(junk), "3")
    run()
    land(junk, "4")
    run()
    return round_doubles(read_table(spark, f"{base}/silver").select(*SILVER_OUT_ORDER))


@register("features_time_of_day")
def q_time_of_day(spark, sf_dir):
    """FEA-5, which the feature table's column list leaves out."""
    from vidlake.operators.features import temporal_features
    return temporal_features(silver_of(spark, sf_dir, READS["time_of_day"])).select("video_id", "publish_time", "publish_hour", "time_of_day")


@register("ml_scoring_features")
def q_ml_features(spark, sf_dir):
    from vidlake.operators.ml import scoring_features, scoring_input_from_silver
    return round_doubles(scoring_features(scoring_input_from_silver(silver_of(spark, sf_dir, READS["models"]))))


def _ml_frames(spark, sf_dir, silver=None):
    from vidlake.operators.ml import split_frame, training_frame
    if silver is None:
        silver = silver_of(spark, sf_dir, READS["models"])
    return split_frame(materialize(training_frame(silver), "training_frame"))


@register("ml_split_membership")
def q_ml_split(spark, sf_dir):
    """ML-4: every silver row with its split."""
    from vidlake.operators.ml import split_number, training_frame
    return training_frame(silver_of(spark, sf_dir, READS["models"])).select("video_id", "publish_time", "label_views", "label_engaged",
                                                           split_number().alias("split"))


@register("ml_baseline_metrics")
def q_ml_metrics(spark, sf_dir):
    """ML-7 and ML-12 on a deterministic predictor (the training mean of the
    category): regression metrics and the residual interval per split."""
    from vidlake.operators.ml import category_mean_model, regression_metrics, residual_interval
    train, valid, test = _ml_frames(spark, sf_dir)
    out = None
    for name, rows in (("validation", valid), ("test", test)):
        scored = materialize(category_mean_model(train, rows), "baseline")
        bounds = residual_interval(scored).first()
        line = regression_metrics(scored).select(
            F.lit(name).alias("split"), "rmse", "mae", "r2", "mape", F.lit(bounds["residual_lo"]).alias("residual_lo"),
            F.lit(bounds["residual_hi"]).alias("residual_hi"))
        out = line if out is None else out.unionByName(line)
    return round_doubles(out)


@register("ml_retrain_decision")
def q_ml_retrain(spark, sf_dir):
    """ML-11: the baseline's error on the test split against validation, and
    the drift of views between early and late uploads."""
    from vidlake.functions.quality import population_stability
    from vidlake.operators.ml import category_mean_model, regression_metrics, retrain_decision
    silver = silver_of(spark, sf_dir, READS["models"])
    train, valid, test = _ml_frames(spark, sf_dir, silver)
    scores = [regression_metrics(category_mean_model(train, rows)).first().asDict() for rows in (valid, test)]
    early = F.col("publish_date") < F.lit("2024-01-01").cast("date")
    psi = population_stability(silver.filter(early), silver.filter(~early), "views").first()["psi"]
    d = retrain_decision(scores[1], scores[0], psi)
    return round_doubles(spark.createDataFrame([(d["metric_drop"], d["degraded"], d["drifted"], d["retrain"])],
                                               "metric_drop double, degraded boolean, drifted boolean, retrain boolean"))


@register("ml_regressor_selection")
def q_ml_selection(spark, sf_dir):
    """ML-4, ML-5, ML-7, ML-8: candidates on validation, winner on test."""
    from vidlake.operators.ml import train_and_select
    _, _, rows = train_and_select(*_ml_frames(spark, sf_dir))
    return spark.createDataFrame(rows, "model string, split string, rmse double, mae double, r2 double, mape double")


@register("ml_engagement_classifiers")
def q_ml_classifiers(spark, sf_dir):
    """ML-6, ML-7: the three engagement classifiers on the validation split."""
    from vidlake.operators.ml import classification_metrics, classifiers, fit
    train, valid, _ = _ml_frames(spark, sf_dir)
    rows = []
    for name, est in classifiers().items():
        m = classification_metrics(fit(est, train).transform(valid))
        rows.append((name, m["accuracy"], m["weightedPrecision"], m["weightedRecall"], m["f1"], m.get("auc")))
    return spark.createDataFrame(rows, "model string, accuracy double, precision double, recall double, "
                                       "f1 double, auc double")


@register("ml_batch_scoring")
def q_ml_scoring(spark, sf_dir):
    """ML-10 save (quality gate), ML-3 load latest, ML-2 + ML-12 score every
    silver row with an interval, SNK-8 write, read back."""
    from vidlake.operators.ml import (fit, load_latest, predict, regression_metrics, regressors,
                                      residual_interval, save_model, scoring_input_from_silver)
    from vidlake.sources.sinks import write_predictions

    silver = silver_of(spark, sf_dir, READS["models"])
    train, valid, _ = _ml_frames(spark, sf_dir, silver)
    model = fit(regressors()["linear_regression"], train)
    metrics = regression_metrics(model.transform(valid)).first().asDict()
    registry = scratch_path(spark, "models")
    save_model(spark, model, registry, "views_regressor", metrics, version="20240131_000000")
    loaded, meta = load_latest(spark, registry, "views_regressor")
    preds = predict(loaded, scoring_input_from_silver(silver), meta["timestamp"], residual_interval(loaded, valid))
    out = scratch_path(spark, "predictions")
    write_predictions(preds, out, mode="overwrite")
    return round_doubles(spark.read.parquet(out).drop("prediction_timestamp"), 3)


def _ridge(spark, sf_dir):
    from vidlake.operators.linear import tune_ridge
    from vidlake.operators.ml import MODEL_FEATURES
    train, valid, test = _ml_frames(spark, sf_dir)
    return valid, test, *tune_ridge(train, MODEL_FEATURES, "label_views")


@register("ml_ridge_tuning")
def q_ml_ridge(spark, sf_dir):
    """ML-5, ML-8, ML-9: five-fold scores of every penalty from one scan's sums, and the chosen model's metrics on
    validation and test."""
    from vidlake.operators.ml import regression_metrics
    valid, test, model, best, scores = _ridge(spark, sf_dir)
    out = spark.createDataFrame([(float(s), r, s == best) for s, r in scores.items()], "strength double, cv_r2 double, chosen boolean")
    for name, part in (("validation", valid), ("test", test)):
        m = regression_metrics(part.withColumn("prediction", model.score())).select(
            *(F.col(c).alias(f"{name}_{c}") for c in ("rmse", "mae", "r2", "mape"))).withColumn("chosen", F.lit(True))
        out = out.join(m, "chosen", "left")
    return round_doubles(out)


@register("ml_conformal_scoring")
def q_ml_conformal(spark, sf_dir):
    """ML-2, ML-12: the test rows with the ridge model's prediction and the interval of their category."""
    from vidlake.operators.linear import conformal_widths, with_intervals
    valid, test, model, _, _ = _ridge(spark, sf_dir)
    widths, pooled = conformal_widths(valid.withColumn("prediction", model.score()), "category_id", "label_views")
    scored = with_intervals(test.withColumn("prediction", model.score()), widths, pooled, "category_id")
    return round_doubles(scored.select("video_id", "publish_time", "category_id", "label_views", "prediction", "lo", "hi", "own_group",
                                       (F.col("label_views").between(F.col("lo"), F.col("hi"))).alias("covered")), 3)


@register("ml_logistic_newton")
def q_ml_logistic(spark, sf_dir):
    """ML-6, ML-7: logistic regression of high engagement by Newton steps, measured on validation and test."""
    from vidlake.operators.linear import binary_metrics, logistic
    from vidlake.operators.ml import MODEL_FEATURES
    train, valid, test = _ml_frames(spark, sf_dir)
    model = logistic(train, MODEL_FEATURES, "label_engaged")
    out = None
    for name, part in (("validation", valid), ("test", test)):
        m = binary_metrics(part.withColumn("prediction", model.score()), "label_engaged").withColumn("split", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return round_doubles(out)


@register("dq_validation_report")
def q_dq_validation(spark, sf_dir):
    """DQ-1..3 and DQ-8 on the landed (bronze) rows."""
    from vidlake.functions.quality import validation_report
    configure(spark)
    r = validation_report(load_bronze(spark, sf_dir))
    return r.withColumn("n_missing_columns", F.size("missing_columns")).drop("missing_columns")


@register("dq_ingestion_summary")
def q_dq_summary(spark, sf_dir):
    from vidlake.functions.quality import ingestion_summary
    configure(spark)
    return ingestion_summary(load_bronze(spark, sf_dir))


@register("dq_duplicate_keys")
def q_dq_duplicates(spark, sf_dir):
    from vidlake.functions.quality import duplicate_keys
    configure(spark)
    return duplicate_keys(load_bronze(spark, sf_dir))


@register("dq_quality_dimensions")
def q_dq_dimensions(spark, sf_dir):
    from vidlake.functions.quality import quality_dimensions
    return round_doubles(quality_dimensions(silver_of(spark, sf_dir, READS["quality_dimensions"]), as_of=AS_OF))


@register("dq_drift_psi")
def q_dq_drift(spark, sf_dir):
    """DQ-11: views of 2024 uploads against the earlier uploads."""
    from vidlake.functions.quality import population_stability
    s = silver_of(spark, sf_dir, READS["drift"])
    early = F.col("publish_date") < F.lit("2024-01-01").cast("date")
    return round_doubles(population_stability(s.filter(early), s.filter(~early), "views"))


@register("dq_drift_report")
def q_dq_drift_report(spark, sf_dir):
    """DQ-11, ML-11: every watched column of 2024 uploads against the stored profile of the earlier ones."""
    from vidlake.functions.drift import drift_report, reference_profile
    s = silver_of(spark, sf_dir, READS["drift"])
    early = F.col("publish_date") < F.lit("2024-01-01").cast("date")
    profile = materialize(reference_profile(s.filter(early), numeric=["views", "likes", "comment_count", "engagement_rate", "title_length"],
                                            categories=["category_id", "engagement_category"]), "drift_profile")
    return round_doubles(drift_report(profile, s.filter(~early)))


@register("dq_observed_filter_counts")
def q_dq_observed(spark, sf_dir):
    """DQ-7: kept/removed counts observed during the (here: no-op) write."""
    from vidlake.functions.clean import clean_and_standardize
    from vidlake.functions.metrics import add_derived_metrics
    from vidlake.functions.quality import apply_data_quality_filters
    configure(spark)
    cleaned = add_derived_metrics(clean_and_standardize(load_bronze(spark, sf_dir), as_of=AS_OF))
    kept, obs = apply_data_quality_filters(cleaned, observe=True)
    kept.write.format("noop").mode("overwrite").save()
    m = obs.get
    return spark.createDataFrame([(m["input_rows"], m["kept_rows"], m["input_rows"] - m["kept_rows"])],
                                 "input_rows long, kept_rows long, removed_rows long")


@register("dq_retained_masked")
def q_dq_retention_mask(spark, sf_dir):
    """DQ-12 + DQ-13: a 90-day retention window, channel names hashed."""
    from vidlake.functions.quality import mask_columns, retain_recent
    s = retain_recent(silver_of(spark, sf_dir, READS["retained_masked"]), as_of=AS_OF, days=90)
    return mask_columns(s.select("video_id", "channel_title", "publish_date", "views"))


@register("sql_weekday_reach")
def q_sql_reach(spark, sf_dir):
    """REC-10: a SQL text with bound parameters over silver."""
    from vidlake.plans.sql import WEEKDAY_REACH, run_sql
    return round_doubles(run_sql(spark, WEEKDAY_REACH, {"least_engagement": 0.01, "least_uploads": 2},
                                 silver=silver_of(spark, sf_dir, READS["weekday_reach"])))


@register("sql_first_rows")
def q_sql_first(spark, sf_dir):
    """SRC-8: a look at the first rows in order."""
    from vidlake.plans.sql import FIRST_ROWS, run_sql
    return run_sql(spark, FIRST_ROWS, {"n": 10}, table=silver_of(spark, sf_dir, READS["first_rows"]))
