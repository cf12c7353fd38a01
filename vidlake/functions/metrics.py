"""Derived engagement metrics (MET-1..MET-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed thresholds of the engagement classes.
HIGH_ENGAGEMENT = 0.05
MEDIUM_ENGAGEMENT = 0.02


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def engagement_rate(views: Column, likes: Column, comments: Column) -> Column:
    return ratio_or_zero(likes + comments, views)


def viral_score(views: Column, rate: Column, days: Column) -> Column:
    # try_divide: a video published the day after as_of gives days + 1 = 0 -> null
    return F.try_divide(views * rate, days + F.lit(1))


def engagement_category(rate: Column) -> Column:
    return (F.when(rate >= HIGH_ENGAGEMENT, F.lit("high"))
            .when(rate >= MEDIUM_ENGAGEMENT, F.lit("medium"))
            .otherwise(F.lit("low")))


def add_derived_metrics(df: DataFrame) -> DataFrame:
    """MET-1..6 in one projection."""
    v, lk, dk, cc, d = (F.col(c) for c in ("views", "likes", "dislikes", "comment_count", "days_since_publish"))
    rate = engagement_rate(v, lk, cc)
    return df.select("*", *[e.alias(n) for n, e in {
        "engagement_rate": rate,
        "like_ratio": ratio_or_zero(lk, lk + dk),
        "comment_ratio": ratio_or_zero(cc, v),
        "views_per_day": F.when(d > 0, v / d).otherwise(v.cast("double")),
        "viral_score": viral_score(v, rate, d),
        "engagement_category": engagement_category(rate),
    }.items()])
