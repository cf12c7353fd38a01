"""ML feature table (FEA-1..FEA-31) from silver, one row per video.

Channel history features are per-row windows over a channel's uploads in time
order.  Written naively (``Window.partitionBy(channel)``) a channel holding a
third of all videos lands in one task.  Every one of them decomposes:

* the 7/14/30-day rolling frames end *yesterday*, so they depend only on
  (channel, day): computed on per-(channel, day) partial aggregates;
* running averages/counts/stddevs over all earlier uploads are prefix sums:
  (sum over earlier days, from the daily table) + (sum over earlier uploads
  of the same day, from a window partitioned by (channel, day));
* the previous upload is either earlier the same day (within-day LAG) or the
  last upload of the previous active day (LAG over the daily table).

So the only windows over raw rows are partitioned by (channel, day), and the
per-channel windows run over one row per active day.  The daily table joins
back on (channel, day); AQE broadcasts it when small and otherwise uses a
sort-merge join (with skew splitting) on the same key the within-day window
needs, so silver is shuffled once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidlake.functions import text as tx
from vidlake.functions.clean import tag_count
from vidlake.operators.joins import join_checked_broadcast
from vidlake.operators.ranking import exact_percentiles, ordered_slices

ROLLING_WINDOWS = (7, 14, 30)
# Fixed month-day holidays used when no calendar table is given (FEA-30).
DEFAULT_HOLIDAYS = ("01-01", "07-04", "11-11", "12-25")

# The columns of the feature table, by group.
ID_COLUMNS = ["video_id", "channel_title", "publish_timestamp"]
TEMPORAL = ["publish_hour", "publish_day_of_week", "publish_month", "hour_sin", "hour_cos", "dow_sin",
            "dow_cos", "month_sin", "month_cos", "is_weekend", "days_since_publish"]
TEXT = ["title_word_count", "title_char_count", "title_has_question", "title_has_exclamation",
        "title_has_numbers", "title_all_caps_ratio", "description_word_count", "description_char_count",
        "description_has_link", "tag_count"]
CHANNEL = ["channel_avg_views_historical", "channel_avg_engagement_historical",
           "channel_video_count_historical", "days_since_last_upload", "channel_consistency_score"]
ENGAGEMENT = ["likes_per_view", "comments_per_view", "like_comment_ratio", "engagement_velocity",
              "viral_coefficient"]
CATEGORY = ["category_id", "category_avg_views", "category_avg_engagement", "views_vs_category_avg",
            "engagement_vs_category_avg"]
TARGETS = ["views", "likes", "comment_count", "engagement_rate", "high_performance", "performance_category"]
DECLARED = ["week_of_year", "is_holiday", "engagement_growth_rate"]
PARTITION = ["publish_year", "publish_month"]


def _cyc(col: str, period: int, fn) -> Column:
    return fn(F.lit(2 * math.pi) * F.col(col) / F.lit(period))


def temporal_features(df: DataFrame) -> DataFrame:
    """FEA-1..5 (+ FEA-29 week of year)."""
    h = F.col("publish_hour")
    return df.withColumns({
        "hour_sin": _cyc("publish_hour", 24, F.sin), "hour_cos": _cyc("publish_hour", 24, F.cos),
        "dow_sin": _cyc("publish_day_of_week", 7, F.sin), "dow_cos": _cyc("publish_day_of_week", 7, F.cos),
        "month_sin": _cyc("publish_month", 12, F.sin), "month_cos": _cyc("publish_month", 12, F.cos),
        "is_weekend": F.when(F.col("publish_day_of_week").isin(1, 7), 1).otherwise(0),
        "time_of_day": (F.when(h.between(6, 11), "morning").when(h.between(12, 17), "afternoon")
                        .when(h.between(18, 22), "evening").otherwise("night")),
        "week_of_year": F.weekofyear("publish_date"),
    })


def text_features(df: DataFrame) -> DataFrame:
    """FEA-6..14."""
    t, d = F.col("title"), F.col("description")
    return df.withColumns({
        "title_word_count": tx.word_count(t),
        "title_char_count": F.length(t),
        "title_has_question": tx.has_question(t),
        "title_has_exclamation": tx.has_exclamation(t),
        "title_has_numbers": tx.has_numbers(t),
        "title_all_caps_ratio": tx.caps_ratio(t),
        "description_word_count": tx.word_count(d),
        "description_char_count": F.length(d),
        "description_has_link": tx.has_link(d),
        "tag_count": tag_count(F.col("tags")),
    })


def channel_history_features(df: DataFrame, windows=ROLLING_WINDOWS, num_partitions: int | None = None) -> DataFrame:
    """FEA-15..20 and FEA-31 through the (channel, day) decomposition."""
    ch, day = "channel_title", "publish_date"
    v, e = F.col("views"), F.col("engagement_rate")
    daily = df.groupBy(ch, day).agg(
        F.count(F.lit(1)).alias("d_rows"),
        F.count("video_id").alias("d_vid"),
        F.sum(v).alias("d_sv"), F.count(v).alias("d_cv"), F.max(v).alias("d_mv"),
        F.sum("likes").alias("d_sl"), F.count("likes").alias("d_cl"),
        F.sum("comment_count").alias("d_sc"), F.count("comment_count").alias("d_cc"),
        F.sum(e).alias("d_se"), F.count(e).alias("d_ce"),
        F.max_by(e, F.struct("publish_timestamp", "video_id")).alias("d_last_eng"),
    )

    # --- per-channel windows over one row per active day
    wd = Window.partitionBy(ch).orderBy(day)
    before = wd.rowsBetween(Window.unboundedPreceding, -1)

    def prefix(c):
        return F.coalesce(F.sum(c).over(before), F.lit(0))
    cols = {
        "day_gap": F.datediff(F.col(day), F.lag(day).over(wd)),
        "prev_last_eng": F.lag("d_last_eng").over(wd),
        "c_vid": prefix("d_vid"), "c_sv": F.sum("d_sv").over(before), "c_cv": prefix("d_cv"),
        "c_se": F.sum("d_se").over(before), "c_ce": prefix("d_ce"),
    }
    udays = F.unix_date(F.col(day))
    rolling = []
    for n in windows:
        wr = Window.partitionBy(ch).orderBy(udays).rangeBetween(-n, -1)

        def avg_of(s_, c_):
            return F.try_divide(F.sum(s_).over(wr), F.nullif(F.sum(c_).over(wr), F.lit(0)))
        r = {
            f"rolling_avg_views_{n}d": avg_of("d_sv", "d_cv"),
            f"rolling_avg_likes_{n}d": avg_of("d_sl", "d_cl"),
            f"rolling_avg_comments_{n}d": avg_of("d_sc", "d_cc"),
            f"rolling_avg_engagement_{n}d": avg_of("d_se", "d_ce"),
            f"rolling_sum_views_{n}d": F.sum("d_sv").over(wr),
            f"rolling_video_count_{n}d": F.coalesce(F.sum("d_vid").over(wr), F.lit(0)),
            f"rolling_max_views_{n}d": F.max("d_mv").over(wr),
        }
        cols.update(r)
        rolling += list(r)
    daily = daily.select(ch, day, "d_rows", *[c.alias(k) for k, c in cols.items()])
    # gaps of earlier days: each day adds its first upload's gap (none for the
    # channel's first day) and a zero for every other upload that day
    g_s = F.coalesce(F.col("day_gap"), F.lit(0)).cast("long")
    g_n = F.when(F.col("day_gap").isNotNull(), F.col("d_rows")).otherwise(F.col("d_rows") - 1)
    daily = daily.select(
        ch, day, "day_gap", "prev_last_eng", "c_vid", "c_sv", "c_cv", "c_se", "c_ce", *rolling,
        F.coalesce(F.sum(g_n).over(before), F.lit(0)).alias("cg_n"),
        F.coalesce(F.sum(g_s).over(before), F.lit(0)).alias("cg_s"),
        F.coalesce(F.sum(g_s * g_s).over(before), F.lit(0)).alias("cg_ss"))

    # --- back to videos.  Each (channel, day) is cut into ordered slices
    # (range partitioning), so even one channel-day holding a third of all
    # rows spreads over many tasks: windows run per slice, and per-slice
    # prefix statistics carry the running sums across slices.
    # Only the columns the history needs are sliced and windowed; the wide
    # rows (titles, descriptions) are joined to the result once, on the row key.
    order = [F.col("publish_timestamp").asc_nulls_first(), F.col("video_id").asc_nulls_first()]
    row_key = [c for c in ("video_id", "publish_timestamp", "publish_time") if c in df.columns]
    narrow_cols = list(dict.fromkeys([ch, day, *row_key, "views", "engagement_rate"]))
    sliced = ordered_slices(df.select(*narrow_cols), [ch, day], order, num_partitions)
    slice_stats = sliced.groupBy(ch, day, "_pid").agg(
        F.min("_mid").alias("s_first"), F.count(F.lit(1)).alias("s_rows"),
        F.count("video_id").alias("s_vid"), F.sum(v).alias("s_sv"), F.count(v).alias("s_cv"),
        F.sum(e).alias("s_se"), F.count(e).alias("s_ce"), F.max_by(e, F.col("_mid")).alias("s_last_eng"))
    ws = Window.partitionBy(ch, day).orderBy("_pid")
    ws_before = ws.rowsBetween(Window.unboundedPreceding, -1)
    slice_stats = slice_stats.select(
        F.col(ch).alias("_sc"), F.col(day).alias("_sd"), F.col("_pid").alias("_sp"), "s_first",
        *[F.coalesce(F.sum(c).over(ws_before), F.lit(0)).alias(f"o{c[1:]}")
          for c in ("s_rows", "s_vid", "s_cv", "s_ce")],
        F.sum("s_sv").over(ws_before).alias("o_sv"), F.sum("s_se").over(ws_before).alias("o_se"),
        F.lag("s_last_eng").over(ws).alias("prev_slice_last_eng"))
    # day-level features ride on the (small) slice table, so the rows are
    # joined once, on (channel, day, slice)
    slice_stats = slice_stats.join(
        daily, F.col("_sc").eqNullSafe(F.col(ch)) & F.col("_sd").eqNullSafe(F.col(day)), "left").drop(ch, day)

    wl = Window.partitionBy(ch, day, "_pid").orderBy("_mid")
    wl_before = wl.rowsBetween(Window.unboundedPreceding, -1)
    rows = sliced.select("*", *[c.alias(k) for k, c in {
        "_l_vid": F.coalesce(F.count("video_id").over(wl_before), F.lit(0)),
        "_l_sv": F.sum(v).over(wl_before), "_l_cv": F.coalesce(F.count(v).over(wl_before), F.lit(0)),
        "_l_se": F.sum(e).over(wl_before), "_l_ce": F.coalesce(F.count(e).over(wl_before), F.lit(0)),
        "_l_prev_eng": F.lag(e).over(wl),
    }.items()])
    cond = (F.col(ch).eqNullSafe(F.col("_sc")) & F.col(day).eqNullSafe(F.col("_sd"))
            & (F.col("_pid") == F.col("_sp")))
    j = rows.join(slice_stats, cond, "inner")
    first_in_slice = F.col("_mid") == F.col("s_first")
    j = j.select("*", *[c.alias(k) for k, c in {
        "_pos": F.col("o_rows") + (F.col("_mid") - F.col("s_first")) + F.lit(1),
        "_i_vid": F.col("o_vid") + F.col("_l_vid"),
        "_i_sv": F.coalesce(F.col("o_sv"), F.lit(0)) + F.coalesce(F.col("_l_sv"), F.lit(0)),
        "_i_cv": F.col("o_cv") + F.col("_l_cv"),
        "_i_se": F.coalesce(F.col("o_se"), F.lit(0.0)) + F.coalesce(F.col("_l_se"), F.lit(0.0)),
        "_i_ce": F.col("o_ce") + F.col("_l_ce"),
        "_prev_eng_same_day": F.when(first_in_slice, F.col("prev_slice_last_eng")).otherwise(F.col("_l_prev_eng")),
    }.items()])

    def z(c):
        return F.coalesce(F.col(c), F.lit(0))
    sv, cv = z("c_sv") + z("_i_sv"), F.col("c_cv") + F.col("_i_cv")
    se, ce = z("c_se") + z("_i_se"), F.col("c_ce") + F.col("_i_ce")
    first_of_day = F.col("_pos") == 1
    # gaps of the earlier uploads of this day: the first upload's day gap
    # (absent on the channel's first day) and zeros for the rest
    k_before = F.col("_pos") - 1
    day_gap_known = F.col("day_gap").isNotNull()
    i_gn = F.when(k_before == 0, F.lit(0)).when(day_gap_known, k_before).otherwise(k_before - 1)
    i_gs = F.when((k_before > 0) & day_gap_known, F.col("day_gap")).otherwise(F.lit(0)).cast("long")
    gn = (F.col("cg_n") + i_gn).cast("double")
    gs = (F.col("cg_s") + i_gs).cast("double")
    gss = (F.col("cg_ss") + i_gs * i_gs).cast("double")
    gap_sd = F.when(gn > 1, F.sqrt(F.greatest((gss - gs * gs / gn) / (gn - 1), F.lit(0.0))))
    prev_eng = F.when(first_of_day, F.col("prev_last_eng")).otherwise(F.col("_prev_eng_same_day"))
    out = {
        "channel_avg_views_historical": F.try_divide(sv, F.nullif(cv, F.lit(0))),
        "channel_avg_engagement_historical": F.try_divide(se, F.nullif(ce, F.lit(0))),
        "channel_video_count_historical": (F.col("c_vid") + F.col("_i_vid")).cast("long"),
        "days_since_last_upload": F.when(first_of_day, F.col("day_gap")).otherwise(F.lit(0)),
        "channel_consistency_score": F.try_divide(F.lit(1.0), gap_sd + F.lit(1.0)),
        "engagement_growth_rate": F.try_divide(e - prev_eng, F.nullif(prev_eng, F.lit(0.0))),
    }
    hist = j.select(*[F.col(c).alias(f"_rk_{c}") for c in row_key], *rolling,
                    *[c.alias(k) for k, c in out.items()])
    cond = None
    for c in row_key:
        eq = F.col(c).eqNullSafe(F.col(f"_rk_{c}"))
        cond = eq if cond is None else cond & eq
    back = df.join(hist, cond, "left")
    return back.select(*df.columns, *rolling, *out)


def engagement_features(df: DataFrame) -> DataFrame:
    """FEA-21..23."""
    v, lk, cc, e, d = (F.col(c) for c in ("views", "likes", "comment_count", "engagement_rate",
                                           "days_since_publish"))
    return df.withColumns({
        "likes_per_view": F.when(v > 0, lk / v).otherwise(F.lit(0.0)),
        "comments_per_view": F.when(v > 0, cc / v).otherwise(F.lit(0.0)),
        "like_comment_ratio": F.when(cc > 0, lk / cc).otherwise(F.lit(0.0)),
        "engagement_velocity": F.when(d > 0, e / d).otherwise(e),
        "viral_coefficient": F.try_divide(v * e, d + F.lit(1)),
    })


def category_features(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """FEA-24..25: per-category aggregate (partial aggregation, one row per
    category) joined back with a size-checked broadcast, instead of an
    unordered window that would put each category's rows into one task.
    ``source`` holds the same rows before other features were added, so that
    the aggregate does not run their plan."""
    cat = (source or df).groupBy(F.col("category_id").alias("_cat")).agg(
        F.avg("views").alias("category_avg_views"),
        F.avg("engagement_rate").alias("category_avg_engagement"),
        F.count("video_id").alias("category_video_count"),
    )
    j = join_checked_broadcast(df, cat, F.col("category_id").eqNullSafe(F.col("_cat")), "left").drop("_cat")
    return j.withColumns({
        "views_vs_category_avg": F.try_divide(F.col("views"), F.col("category_avg_views")),
        "engagement_vs_category_avg": F.try_divide(F.col("engagement_rate"), F.col("category_avg_engagement")),
    })


def target_variables(df: DataFrame, target_col: str = "views", high_threshold_percentile: float = 0.75) -> DataFrame:
    """FEA-26..27: exact thresholds at the high-performance percentile and at
    0.5 / 0.75 / 0.9."""
    qs = [F.lit(v) for v in exact_percentiles(df, target_col, [high_threshold_percentile, 0.5, 0.75, 0.9])]
    t = F.col(target_col)
    return df.withColumns({
        "high_performance": F.when(t >= qs[0], 1).otherwise(0),
        "performance_category": (F.when(t >= qs[3], "excellent").when(t >= qs[2], "good")
                                 .when(t >= qs[1], "average").otherwise("poor")),
    })


def holiday_flag(df: DataFrame, holidays=None) -> DataFrame:
    """FEA-30: 1 when the publish date is a holiday.  ``holidays`` is either a
    list of 'MM-dd' strings or a DataFrame with a ``holiday_date`` column
    (a calendar: one row per date, joined on the date)."""
    if holidays is None or isinstance(holidays, (list, tuple)):
        md = list(holidays or DEFAULT_HOLIDAYS)
        return df.withColumn("is_holiday", F.date_format("publish_date", "MM-dd").isin(md).cast("int"))
    cal = holidays.select(F.col("holiday_date").cast("date").alias("_hd")).distinct().withColumn("_h", F.lit(1))
    j = join_checked_broadcast(df, cal, F.col("publish_date") == F.col("_hd"), "left")
    return j.withColumn("is_holiday", F.coalesce("_h", F.lit(0))).drop("_hd", "_h")


def select_feature_columns(df: DataFrame, include_declared: bool = True) -> DataFrame:
    """FEA-28: feature groups in order, only columns that exist, partition
    columns carried through (the sink partitions by them)."""
    rolling = [c for c in df.columns if "rolling_" in c]
    wanted = ID_COLUMNS + TEMPORAL + TEXT + CHANNEL + rolling + ENGAGEMENT + CATEGORY + TARGETS
    if include_declared:
        wanted += DECLARED
    wanted += PARTITION
    seen, cols = set(), []
    for c in wanted:
        if c in df.columns and c not in seen:
            seen.add(c)
            cols.append(c)
    return df.select(*cols)


def build_features(silver: DataFrame, windows=ROLLING_WINDOWS, target_col: str = "views",
                   high_threshold_percentile: float = 0.75, holidays=None,
                   include_declared: bool = True) -> DataFrame:
    # thresholds first: they read one column of silver, not the feature plan
    df = target_variables(silver, target_col, high_threshold_percentile)
    df = temporal_features(df)
    if not set(TEXT) <= set(df.columns):  # else derived where the texts were read
        df = text_features(df)
    df = channel_history_features(df, windows)
    df = engagement_features(df)
    df = category_features(df, silver)
    df = holiday_flag(df, holidays)
    return select_feature_columns(df, include_declared)
