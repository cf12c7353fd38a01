"""SQL-text entry point (REC-10, SRC-8).

``run_sql`` binds DataFrames as relations (``{silver}``) and values as named
parameters (``:channel``) -- no string interpolation of values, so a channel
name with a quote is data, not SQL.  The analytic queries themselves are
DataFrame plans (``operators/analytics.py``), whose percentiles are exact and
whose windows never run over raw rows; the two texts below serve ad-hoc use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """REC-10: parse, analyse, optimise and plan ``text``; returns a lazy DataFrame."""
    return spark.sql(text, args=args or None, **frames)


# Reach of each weekday within a category: share of the category's views, best upload, distinct channels.
WEEKDAY_REACH = """
SELECT category_id, publish_day_of_week, uploads, channels, best_views,
       try_divide(day_views, sum(day_views) OVER (PARTITION BY category_id)) AS share_of_views
FROM (SELECT category_id, publish_day_of_week, count(*) AS uploads,
             count(DISTINCT channel_title) AS channels, max(views) AS best_views, sum(views) AS day_views
      FROM {silver} WHERE engagement_rate >= :least_engagement GROUP BY category_id, publish_day_of_week)
WHERE uploads >= :least_uploads"""

# The first rows of a table in a given order (a look at the data, so the limit is the point).
FIRST_ROWS = """
SELECT video_id, publish_time, title, views FROM {table} ORDER BY video_id, publish_time LIMIT :n"""
