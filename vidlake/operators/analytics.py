"""The twelve analytic queries over silver (Q1..Q12), as DataFrame plans.

Literal parameters of the original SQL (year, thresholds, limits) are keyword
arguments.  Percentiles are exact (``PERCENTILE_DISC``): global thresholds by
``exact_percentile``, grouped ones by ``grouped_percentiles``.  Every LIMIT is a
top-k report (TakeOrderedAndProject), with a deterministic tie-break.  Windows run on aggregated rows or on the k rows of a
top-k, never on a whole unpartitioned table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlake.functions.text import day_name, title_class
from vidlake.operators.ranking import desc_then, grouped_percentiles, percentile_of, row_number_within


def _with(agg: DataFrame, pct: DataFrame, keys: list[str]) -> DataFrame:
    """Attach per-group percentiles (one row per group on both sides)."""
    return agg.join(pct, keys, "left")


def _pct_change(cur, prev):
    return F.when(prev > 0, (cur - prev) / prev * 100)


def top_videos_by_views(silver: DataFrame, year: int = 2024, limit: int = 100) -> DataFrame:
    """Q1.  RANK over all rows of the year equals RANK over the top ``limit``
    rows (a row's rank counts only rows above it), so the sort-limit runs
    first, distributed, and the rank window sees ``limit`` rows."""
    top = (silver.filter(F.col("publish_year") == year)
           .select("video_id", "title", "channel_title", "category_id", "views", "likes",
                   "comment_count", "engagement_rate", "publish_date", "publish_time")
           .orderBy(*desc_then("views")).limit(limit).drop("publish_time"))
    return top.withColumn("view_rank", F.rank().over(Window.orderBy(F.col("views").desc())))


def channel_metrics(silver: DataFrame, min_videos: int = 10, limit: int = 50) -> DataFrame:
    """Q2."""
    g = silver.groupBy("channel_title").agg(
        F.count_distinct("video_id").alias("total_videos"),
        F.sum("views").alias("total_views"),
        F.avg("views").alias("avg_views_per_video"),
        F.sum("likes").alias("total_likes"),
        F.avg("engagement_rate").alias("avg_engagement_rate"),
        F.min("publish_date").alias("first_video_date"),
        F.max("publish_date").alias("latest_video_date"),
    )
    return g.filter(F.col("total_videos") >= min_videos).orderBy(*desc_then("total_views", tie="channel_title")).limit(limit)


def daily_trending(silver: DataFrame, max_days: int = 7, percentile: float = 0.9) -> DataFrame:
    """Q3: strict ``>`` against the global percentile, rank per publish day."""
    p = percentile_of(silver, "viral_score", percentile)
    t = silver.filter((F.col("days_since_publish") <= max_days) & (F.col("viral_score") > p))
    t = t.select("publish_date", "video_id", "title", "channel_title", "category_id", "views",
                 "engagement_rate", "viral_score", "publish_time")
    # one day may hold most of the last week's uploads: skew-safe numbering
    t = row_number_within(t, ["publish_date"], desc_then("viral_score"), "daily_rank")
    return t.orderBy(F.col("publish_date").desc(), "daily_rank").drop("publish_time")


def category_comparison(silver: DataFrame, year: int = 2024) -> DataFrame:
    """Q4."""
    base = silver.filter(F.col("publish_year") == year)
    g = base.groupBy("category_id").agg(
        F.count("video_id").alias("video_count"),
        F.avg("views").alias("avg_views"),
        F.avg("likes").alias("avg_likes"),
        F.avg("comment_count").alias("avg_comments"),
        F.avg("engagement_rate").alias("avg_engagement"),
        F.stddev_samp("views").alias("views_stddev"),
    )
    pct = grouped_percentiles(base, ["category_id"], "views", {"median_views": 0.5, "p90_views": 0.9})
    return _with(g, pct, ["category_id"]).orderBy(F.col("avg_views").desc(), "category_id")


def weekly_growth(silver: DataFrame, limit: int = 52) -> DataFrame:
    """Q5.  The unpartitioned LAG runs on one row per week."""
    wk = F.date_trunc("week", F.col("publish_date")).cast("date")
    g = silver.groupBy(wk.alias("week_start")).agg(
        F.count("video_id").alias("videos_published"),
        F.sum("views").alias("total_views"),
        F.avg("engagement_rate").alias("avg_engagement"),
    )
    w = Window.orderBy("week_start")
    g = g.withColumns({"_pv": F.lag("total_views").over(w), "_pe": F.lag("avg_engagement").over(w)})
    out = g.select("week_start", "videos_published", "total_views", "avg_engagement",
                   _pct_change(F.col("total_views"), F.col("_pv")).alias("views_growth_pct"),
                   _pct_change(F.col("avg_engagement"), F.col("_pe")).alias("engagement_growth_pct"))
    return out.orderBy(F.col("week_start").desc()).limit(limit)


def posting_slots(silver: DataFrame, limit: int = 50) -> DataFrame:
    """Q6."""
    slot = ["publish_hour", "publish_day_of_week"]
    g = silver.groupBy(*slot).agg(
        F.count("video_id").alias("videos_published"),
        F.avg("views").alias("avg_views"),
        F.avg("engagement_rate").alias("avg_engagement"),
        F.avg("viral_score").alias("avg_viral_score"),
    )
    g = _with(g, grouped_percentiles(silver, slot, "views", {"p75_views": 0.75}), slot)
    g = g.withColumn("day_name", day_name(F.col("publish_day_of_week"), unknown=None))
    return g.orderBy(F.col("avg_viral_score").desc(), "publish_hour", "publish_day_of_week").limit(limit)


def high_engagement(silver: DataFrame, percentile: float = 0.9, min_views: int = 10000,
                    limit: int = 100) -> DataFrame:
    """Q7."""
    p = percentile_of(silver, "engagement_rate", percentile)
    t = silver.filter((F.col("engagement_rate") >= p) & (F.col("views") >= min_views))
    t = t.select("video_id", "title", "channel_title", "category_id", "views", "likes", "comment_count",
                 "engagement_rate", "like_ratio", "comment_ratio", "title_length", "description_length",
                 "tag_count", "publish_hour", "publish_day_of_week", "publish_time")
    return t.orderBy(*desc_then("engagement_rate")).limit(limit).drop("publish_time")


def channel_consistency(silver: DataFrame, min_videos: int = 10, limit: int = 100) -> DataFrame:
    """Q8.  Gap statistics between consecutive uploads of a channel.

    The gaps of a channel's date-sorted uploads are: one gap per distinct date
    (distance to the previous distinct date) and a zero for every extra upload
    on the same date.  So the statistics follow from per-(channel, date)
    counts: the LAG window runs over distinct dates (bounded by the calendar)
    instead of over every video of a channel, and a channel holding a third
    of all rows is pre-aggregated map-side like any other.
    """
    per_day = silver.groupBy("channel_title", "publish_date").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("channel_title").orderBy("publish_date")
    per_day = per_day.withColumns({
        "gap": F.datediff("publish_date", F.lag("publish_date").over(w)).cast("long"),
        "first_day": F.row_number().over(w) == 1,
    })
    c = per_day.groupBy("channel_title").agg(
        (F.sum("n") - 1).alias("_k"),  # rows with a previous row
        F.sum(F.coalesce("gap", F.lit(0))).alias("_s"),
        F.sum(F.coalesce(F.col("gap") * F.col("gap"), F.lit(0))).alias("_ss"),
        (F.count(F.lit(1)) - F.max(F.when(F.col("first_day") & (F.col("n") == 1), 1).otherwise(0))).alias("posting_days"),
    ).filter(F.col("_k") >= 1)
    k, s, ss = F.col("_k").cast("double"), F.col("_s").cast("double"), F.col("_ss").cast("double")
    var = F.when(k > 1, F.greatest((ss - s * s / k) / (k - 1), F.lit(0.0)))
    c = c.select("channel_title", (s / k).alias("avg_days_between_posts"),
                 F.sqrt(var).alias("stddev_days_between_posts"), "posting_days")
    v = silver.groupBy("channel_title").agg(F.count("video_id").alias("total_videos"),
                                            F.avg("views").alias("avg_views"))
    j = c.join(v.filter(F.col("total_videos") >= min_videos), "channel_title", "inner")
    sd = F.col("stddev_days_between_posts")
    j = j.withColumn("consistency_score",
                     F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(1.0 / (1.0 + sd)))
    j = j.select("channel_title", "avg_days_between_posts", "stddev_days_between_posts", "posting_days",
                 "consistency_score", "total_videos", "avg_views")
    return j.orderBy(F.col("consistency_score").desc(), F.col("avg_views").desc(), "channel_title").limit(limit)


def title_characteristics(silver: DataFrame, min_length: int = 20, max_length: int = 100) -> DataFrame:
    """Q9 (title flags derived inline; silver does not store them)."""
    base = (silver.filter(F.col("title_length").between(min_length, max_length))
            .select(title_class(F.col("title")).alias("title_type"), "video_id", "views", "engagement_rate"))
    g = base.groupBy("title_type").agg(
        F.count("video_id").alias("video_count"),
        F.avg("views").alias("avg_views"),
        F.avg("engagement_rate").alias("avg_engagement"))
    pct = grouped_percentiles(base, ["title_type"], "views", {"median_views": 0.5, "p90_views": 0.9})
    return _with(g, pct, ["title_type"]).orderBy(F.col("avg_views").desc())


def monthly_category_growth(silver: DataFrame, year: int = 2024) -> DataFrame:
    """Q10: LAG over all months, year filter applied above the window."""
    g = silver.groupBy("category_id", "publish_year", "publish_month").agg(
        F.count("video_id").alias("video_count"),
        F.sum("views").alias("total_views"),
        F.avg("engagement_rate").alias("avg_engagement"),
    )
    w = Window.partitionBy("category_id").orderBy("publish_year", "publish_month")
    g = g.withColumn("_prev", F.lag("total_views").over(w))
    g = g.filter(F.col("publish_year") == year).select(
        "category_id", "publish_year", "publish_month", "video_count", "total_views", "avg_engagement",
        _pct_change(F.col("total_views"), F.col("_prev")).alias("mom_growth_pct"))
    return g.orderBy("category_id", F.col("publish_year").desc(), F.col("publish_month").desc())


def viral_videos(silver: DataFrame, percentile: float = 0.95, max_days: int = 30,
                 min_ratio: float = 2.0, limit: int = 50) -> DataFrame:
    """Q11: candidate filter first (pushed below the join), then an inner
    join to the per-channel average (one row per channel).  Adaptive execution
    knows both sides' sizes by then: it broadcasts small averages, and splits a
    hot channel's candidates otherwise."""
    p = percentile_of(silver, "viral_score", percentile)
    c = silver.groupBy("channel_title").agg(F.avg("views").alias("channel_avg_views"))
    v = silver.filter((F.col("viral_score") > p) & (F.col("days_since_publish") <= max_days))
    j = v.join(c, "channel_title")
    perf = F.try_divide(F.col("views"), F.nullif(F.col("channel_avg_views"), F.lit(0.0)))
    j = j.filter(perf >= min_ratio).select(
        "video_id", "title", "channel_title", "category_id", "views", "engagement_rate", "viral_score",
        "days_since_publish",
        F.try_divide(F.col("views"), F.nullif(F.col("days_since_publish"), F.lit(0))).alias("views_per_day"),
        "channel_avg_views", perf.alias("performance_vs_channel_avg"), "publish_time")
    return j.orderBy(*desc_then("viral_score")).limit(limit).drop("publish_time")


def channel_benchmark(silver: DataFrame, min_videos: int = 5, limit: int = 100) -> DataFrame:
    """Q12: channel aggregates, category percentiles of those, tiering."""
    cm = silver.groupBy("channel_title", "category_id").agg(
        F.count("video_id").alias("total_videos"),
        F.avg("views").alias("avg_views"),
        F.avg("engagement_rate").alias("avg_engagement"),
        F.avg("viral_score").alias("avg_viral_score"),
    ).filter(F.col("total_videos") >= min_videos)
    # both metrics in one set of passes: the metric name is an extra group key
    stacked = cm.select("category_id", F.explode(F.array(
        F.struct(F.lit("views").alias("m"), F.col("avg_views").alias("x")),
        F.struct(F.lit("engagement").alias("m"), F.col("avg_engagement").alias("x")))).alias("s"))
    pct = grouped_percentiles(stacked.select("category_id", "s.m", "s.x"), ["category_id", "m"], "x",
                              {"p25": 0.25, "p50": 0.5, "p75": 0.75})

    def pick(metric, p):
        return F.max(F.when(F.col("m") == metric, F.col(p)))
    cb = pct.groupBy("category_id").agg(pick("views", "p25").alias("p25_views"),
                                        pick("views", "p50").alias("p50_views"),
                                        pick("views", "p75").alias("p75_views"),
                                        pick("engagement", "p50").alias("p50_engagement"))
    j = cm.join(cb, "category_id", "inner")
    tier = (F.when(F.col("avg_views") >= F.col("p75_views"), F.lit("Top Performer"))
            .when(F.col("avg_views") >= F.col("p50_views"), F.lit("Above Average"))
            .when(F.col("avg_views") >= F.col("p25_views"), F.lit("Average"))
            .otherwise(F.lit("Below Average")))
    j = j.select("channel_title", "category_id", "total_videos", "avg_views",
                 F.col("p50_views").alias("category_median_views"), "avg_engagement",
                 F.col("p50_engagement").alias("category_median_engagement"), tier.alias("performance_tier"))
    return j.orderBy(F.col("avg_views").desc(), "channel_title", "category_id").limit(limit)


ANALYTIC_QUERIES = {
    "q01_top_videos": top_videos_by_views,
    "q02_channel_metrics": channel_metrics,
    "q03_daily_trending": daily_trending,
    "q04_category_comparison": category_comparison,
    "q05_weekly_growth": weekly_growth,
    "q06_posting_slots": posting_slots,
    "q07_high_engagement": high_engagement,
    "q08_channel_consistency": channel_consistency,
    "q09_title_characteristics": title_characteristics,
    "q10_monthly_category_growth": monthly_category_growth,
    "q11_viral_videos": viral_videos,
    "q12_channel_benchmark": channel_benchmark,
}
