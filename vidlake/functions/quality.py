"""Validation and data-quality rules (DQ-1..DQ-13).

Every check is one aggregate pass or a filter; results come back as small
DataFrames (one row, or one row per offending key), never as driver loops
over data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.functions.clean import as_of_date
from vidlake.schemas import REQUIRED_COLUMNS

NUMERIC_TYPES = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType, T.ShortType, T.DecimalType)
DEFAULT_QUALITY_THRESHOLD = 0.8
RETENTION_DAYS = 365
DRIFT_THRESHOLD = 0.3


def missing_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> list[str]:
    """DQ-1: schema-only check (no job)."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def views_type_ok(df: DataFrame) -> bool:
    """DQ-3 (schema part): typed views must be numeric; text views are checked
    row-wise by ``validation_report``."""
    t = df.schema["views"].dataType
    return isinstance(t, NUMERIC_TYPES + (T.StringType,))


def validation_report(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """DQ-1..3 and DQ-8 in one aggregate pass: row count, null count per
    required column, unparsable views, missing columns, and a verdict."""
    missing = missing_columns(df, required)
    present = [c for c in required if c not in missing]
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present]
    if "views" in df.columns:
        raw = F.col("views")
        bad = F.expr("try_cast(views AS DOUBLE)").isNull() & raw.isNotNull()
        aggs.append(F.count_if(bad).alias("non_numeric_views"))
    else:
        aggs.append(F.lit(0).cast("long").alias("non_numeric_views"))
    out = df.agg(*aggs)
    out = out.withColumn("missing_columns", F.array(*[F.lit(c) for c in missing]).cast("array<string>"))
    type_ok = F.lit("views" in df.columns and views_type_ok(df))
    return out.withColumn(
        "is_valid",
        (F.size("missing_columns") == 0) & (F.col("row_count") > 0)
        & (F.col("non_numeric_views") == 0) & type_ok)


def ingestion_summary(df: DataFrame) -> DataFrame:
    """DQ-4: rows, distinct categories and channels, publish-time range."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("category_id").alias("unique_categories"),
        F.count_distinct("channel_title").alias("unique_channels"),
        F.min("publish_time").alias("min_publish_time"),
        F.max("publish_time").alias("max_publish_time"),
    )


def quality_filter_condition(threshold: float = DEFAULT_QUALITY_THRESHOLD) -> Column:
    return ((F.col("data_quality_score") >= threshold)
            & (F.col("views") >= 0) & (F.col("likes") >= 0)
            & F.col("video_id").isNotNull() & F.col("title").isNotNull())


def apply_data_quality_filters(df: DataFrame, threshold: float = DEFAULT_QUALITY_THRESHOLD,
                               observe: bool = False):
    """DQ-6, and DQ-7 when ``observe``: kept/removed counts are gathered by
    ``Observation`` during whatever action consumes the result (the write),
    instead of extra count jobs.  Returns ``(df, observation)`` then."""
    if not observe:
        return df.filter(quality_filter_condition(threshold))
    obs = Observation("quality_filter")
    keep = quality_filter_condition(threshold)
    flagged = df.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    flagged = flagged.observe(obs, F.count(F.lit(1)).alias("input_rows"),
                              F.count_if(F.col("_keep")).alias("kept_rows"))
    return flagged.filter("_keep").drop("_keep"), obs


def duplicate_keys(df: DataFrame, keys=("video_id", "publish_time")) -> DataFrame:
    """DQ-9: keys landed more than once, with their copy count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def quality_dimensions(silver: DataFrame, as_of=None) -> DataFrame:
    """DQ-10 in one pass: freshness (days from newest publish date to as_of),
    completeness (non-null share of each required column), accuracy
    (share of rows with a negative counter) and consistency (share with
    likes + comments above views, or published after as_of)."""
    ref = as_of_date(as_of)
    n = F.count(F.lit(1))
    neg = (F.col("views") < 0) | (F.col("likes") < 0) | (F.col("dislikes") < 0) | (F.col("comment_count") < 0)
    incons = ((F.col("likes") + F.col("comment_count")) > F.col("views")) | (F.col("publish_date") > ref)
    aggs = [n.alias("row_count"),
            F.datediff(ref, F.max("publish_date")).alias("freshness_days")]
    aggs += [F.try_divide(F.count(c), n).alias(f"completeness_{c}")
             for c in REQUIRED_COLUMNS if c in silver.columns]
    aggs += [F.try_divide(F.count_if(F.coalesce(neg, F.lit(False))), n).alias("accuracy_violation_rate"),
             F.try_divide(F.count_if(F.coalesce(incons, F.lit(False))), n).alias("consistency_violation_rate")]
    return silver.agg(*aggs)


def population_stability(baseline: DataFrame, current: DataFrame, column: str,
                         buckets: int = 10, floor: float = 1e-4) -> DataFrame:
    """DQ-11: population stability index of ``column``.

    Bucket edges are the baseline's exact quantiles (distributed selection);
    each side is bucketed by counting the edges strictly below the
    value, counted per bucket (partial aggregation), and the two count tables
    (at most ``buckets`` rows each) are joined.  Empty buckets take ``floor``.
    """
    from vidlake.operators.ranking import exact_percentiles

    qs = [i / buckets for i in range(1, buckets)]
    edges = F.array(*[F.lit(v) for v in exact_percentiles(baseline, column, qs)])
    v = F.col(column)
    bucket = F.aggregate(F.col("_edges"), F.lit(0), lambda acc, e: acc + F.when(v > e, 1).otherwise(0))

    def dist(df: DataFrame, name: str) -> DataFrame:
        c = df.filter(v.isNotNull()).select(v, edges.alias("_edges")).select(bucket.alias("bucket"))
        c = c.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        return c.select("bucket", (F.col("n") / F.sum("n").over(_whole())).alias(name))

    ids = baseline.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    j = ids.join(dist(baseline, "p_base"), "bucket", "left").join(dist(current, "p_cur"), "bucket", "left")
    pb = F.greatest(F.coalesce("p_base", F.lit(0.0)), F.lit(floor))
    pc = F.greatest(F.coalesce("p_cur", F.lit(0.0)), F.lit(floor))
    psi = j.agg(F.sum((pc - pb) * F.ln(pc / pb)).alias("psi"))
    return psi.withColumn("drifted", F.col("psi") > DRIFT_THRESHOLD)


def _whole():
    from pyspark.sql import Window
    return Window.partitionBy()


def retain_recent(df: DataFrame, as_of=None, days: int = RETENTION_DAYS, date_col: str = "publish_date") -> DataFrame:
    """DQ-12: keep rows inside the retention window."""
    return df.filter(F.col(date_col) >= F.date_sub(as_of_date(as_of), days))


def mask_columns(df: DataFrame, columns=("channel_title",), bits: int = 256) -> DataFrame:
    """DQ-13: replace sensitive text by its SHA-2 digest (joins stay possible)."""
    return df.withColumns({c: F.sha2(F.col(c).cast("string"), bits) for c in columns if c in df.columns})
