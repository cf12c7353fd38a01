"""Posting-time recommender (REC-1..REC-11).

The reference loops over one category or channel at a time in pandas.  Here
each function answers for *all* categories (or channels) in one Spark job;
pass ``category_id`` / ``channel_title`` to narrow it.  Inputs are the gold
``posting_time_analysis`` table (slots per category) or silver (slots per
channel); both are aggregates with at most 24 x 7 rows per key, so the
per-key windows below are bounded and ``row_number() <= n`` is planned as a
WindowGroupLimit that trims before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidlake.functions.text import day_name

# Fixed weights of the composite slot score.
W_VIEWS, W_ENGAGEMENT, W_VIRAL = 0.4, 0.3, 0.3
MIN_CHANNEL_SLOT_VIDEOS = 2


def composite_score(keys: list[str]) -> Column:
    """REC-2: each metric divided by its maximum inside the key; a zero
    maximum gives null instead of a division error."""
    w = Window.partitionBy(*keys)

    def part(c):
        return F.try_divide(F.col(c), F.max(c).over(w))
    return (F.lit(W_VIEWS) * part("avg_views") + F.lit(W_ENGAGEMENT) * part("avg_engagement_rate")
            + F.lit(W_VIRAL) * part("avg_viral_score"))


def _rank_order():
    return [F.col("composite_score").desc_nulls_last(), F.col("hour").asc(), F.col("day_of_week").asc()]


def _top_slots(slots: DataFrame, keys: list[str], top_n: int) -> DataFrame:
    scored = slots.withColumn("composite_score", composite_score(keys))
    scored = scored.select(*keys, F.col("publish_hour").alias("hour"),
                           F.col("publish_day_of_week").alias("day_of_week"),
                           day_name(F.col("publish_day_of_week")).alias("day_name"),
                           "avg_views", F.col("avg_engagement_rate").alias("avg_engagement"),
                           "composite_score", F.coalesce(F.col("video_count"), F.lit(0)).cast("long").alias("video_count"))
    w = Window.partitionBy(*keys).orderBy(*_rank_order())
    return scored.withColumn("slot_rank", F.row_number().over(w)).filter(F.col("slot_rank") <= top_n)


def category_recommendations(posting: DataFrame, top_n: int = 5, category_id=None) -> DataFrame:
    """REC-1..3: best ``top_n`` slots of every category (or of one)."""
    if category_id is not None:
        posting = posting.filter(F.col("category_id") == F.lit(category_id))
    return _top_slots(posting, ["category_id"], top_n)


def channel_slots(silver: DataFrame, min_videos: int = MIN_CHANNEL_SLOT_VIDEOS, channel_title=None) -> DataFrame:
    """REC-4: per (channel, hour, day of week) with at least ``min_videos``."""
    if channel_title is not None:
        silver = silver.filter(F.col("channel_title") == F.lit(channel_title))
    g = silver.groupBy("channel_title", F.hour("publish_timestamp").alias("publish_hour"),
                       F.dayofweek("publish_date").alias("publish_day_of_week")).agg(
        F.count("video_id").alias("video_count"),
        F.avg("views").alias("avg_views"),
        F.avg("engagement_rate").alias("avg_engagement_rate"),
        F.avg("viral_score").alias("avg_viral_score"))
    return g.filter(F.col("video_count") >= min_videos)


def channel_recommendations(silver: DataFrame, top_n: int = 5, channel_title=None) -> DataFrame:
    """REC-5: best ``top_n`` slots of every channel (or of one)."""
    return _top_slots(channel_slots(silver, channel_title=channel_title), ["channel_title"], top_n)


def posting_schedule(posting: DataFrame, videos_per_week: int = 3, diversify: bool = False,
                     category_id=None) -> DataFrame:
    """REC-6: weekly schedule per category.

    From the best ``2 * videos_per_week`` slots take ``videos_per_week``.  The
    reference's "avoid the same day" test never fires, so by default this is
    the top slots by score; ``diversify=True`` takes each day's best slot
    first.  Output is ordered by day of week.
    """
    cands = category_recommendations(posting, top_n=2 * videos_per_week, category_id=category_id)
    if diversify:
        per_day = Window.partitionBy("category_id", "day_of_week").orderBy("slot_rank")
        cands = cands.withColumn("_day_rank", F.row_number().over(per_day))
        pick = Window.partitionBy("category_id").orderBy("_day_rank", "slot_rank")
    else:
        pick = Window.partitionBy("category_id").orderBy("slot_rank")
    chosen = cands.withColumn("_pick", F.row_number().over(pick)).filter(F.col("_pick") <= videos_per_week)
    return chosen.select(
        "category_id", "day_of_week", "day_name", "hour",
        F.format_string("%s at %d:00", F.col("day_name"), F.col("hour")).alias("time_slot"),
        F.col("avg_views").alias("expected_views"),
        F.col("avg_engagement").alias("expected_engagement"),
        F.col("composite_score").alias("recommendation_score"),
    )


def _mean_or_zero(cond: Column, c: str) -> Column:
    return F.coalesce(F.avg(F.when(cond, F.col(c))), F.lit(0.0))


def strategy_comparison(posting: DataFrame, category_id=None) -> DataFrame:
    """REC-7..8: mean of slot averages for weekday vs weekend and for
    morning / afternoon / evening (night is not reported); 0 when empty."""
    if category_id is not None:
        posting = posting.filter(F.col("category_id") == F.lit(category_id))
    dow, h = F.col("publish_day_of_week"), F.col("publish_hour")
    groups = {
        "weekday": ~dow.isin(1, 7), "weekend": dow.isin(1, 7),
        "morning": h.between(6, 11), "afternoon": h.between(12, 17), "evening": h.between(18, 22),
    }
    aggs = []
    for name, cond in groups.items():
        cond = F.coalesce(cond, F.lit(False))
        aggs += [_mean_or_zero(cond, "avg_views").alias(f"{name}_avg_views"),
                 _mean_or_zero(cond, "avg_engagement_rate").alias(f"{name}_avg_engagement")]
    return posting.groupBy("category_id").agg(*aggs)


def recommendation_bundle(posting: DataFrame, top_n: int = 5, videos_per_week: int = 3,
                          generated_at: str | None = None, category_id=None) -> DataFrame:
    """REC-11: one nested record per category (top times, schedule, strategy
    comparison, timestamp), ready for the JSON sink.  Arrays hold at most
    ``top_n`` / ``videos_per_week`` elements."""
    gen = generated_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
    top = category_recommendations(posting, top_n, category_id).groupBy("category_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "slot_rank", "hour", "day_of_week", "day_name", "avg_views", "avg_engagement",
            "composite_score", "video_count"))).alias("top_posting_times"))
    sched = posting_schedule(posting, videos_per_week, category_id=category_id).groupBy("category_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "day_of_week", "hour", "day_name", "time_slot", "expected_views", "expected_engagement",
            "recommendation_score"))).alias("recommended_schedule"))
    strat = strategy_comparison(posting, category_id)

    def pair(prefix):
        return F.struct(F.col(f"{prefix}_avg_views").alias("avg_views"),
                        F.col(f"{prefix}_avg_engagement").alias("avg_engagement"))
    strat = strat.select("category_id", F.struct(
        F.struct(pair("weekday").alias("weekday"), pair("weekend").alias("weekend")).alias("weekday_vs_weekend"),
        F.struct(pair("morning").alias("morning"), pair("afternoon").alias("afternoon"),
                 pair("evening").alias("evening")).alias("time_of_day"),
    ).alias("strategy_comparison"))
    out = top.join(sched, "category_id", "left").join(strat, "category_id", "left")
    return out.withColumn("generated_at", F.lit(gen))


def flat_bundle(bundle: DataFrame) -> DataFrame:
    """The bundle as rows: one per recommended time, scheduled slot and
    strategy, numbered inside its section (times by rank, slots by day and
    hour, strategies by name)."""
    def rows(section, items, name, number, views, engagement, score):
        return bundle.select("category_id", "generated_at", F.posexplode(items).alias("_p", "_x")).select(
            "category_id", "generated_at", F.lit(section).alias("section"), number.cast("int").alias("number"),
            name.alias("name"), views.alias("avg_views"), engagement.alias("avg_engagement"), score.alias("score"))
    x, none = F.col("_x"), F.lit(None).cast("double")
    place = F.concat_ws(" ", x["day_name"], x["hour"].cast("string"))
    s = F.col("strategy_comparison")
    named = [(n, s[g][n]) for g, ns in (("weekday_vs_weekend", ("weekday", "weekend")),
                                        ("time_of_day", ("morning", "afternoon", "evening"))) for n in ns]
    strategies = F.array(*(F.struct(F.lit(n).alias("name"), c["avg_views"].alias("v"), c["avg_engagement"].alias("e"))
                           for n, c in sorted(named, key=lambda p: p[0])))
    return (rows("time", "top_posting_times", place, x["slot_rank"], x["avg_views"], x["avg_engagement"], x["composite_score"])
            .unionByName(rows("schedule", "recommended_schedule", x["time_slot"], F.col("_p") + 1, x["expected_views"],
                              x["expected_engagement"], x["recommendation_score"]))
            .unionByName(rows("strategy", strategies, x["name"], F.col("_p") + 1, x["v"], x["e"], none)))
