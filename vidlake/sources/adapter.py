"""Derive bronze video-statistics rows from the driver's ``events`` and
``documents`` tables (the specification lives in FIXTURES.md section 2).

The output has the landed-CSV shape: every column is text, exactly what
``spark.read.schema(BRONZE_SCHEMA).csv`` returns, so the cleaning step is
exercised with real casts and timestamp parsing.

Plan shape: one scan of each table, one equi-join on ``doc_id`` with whole
texts (the description of a video is the whole text of its document).  It is a
merge join: no task holds all texts, events are exchanged before they carry a
text, and rows come out document by document, so that what is written or
exchanged next compresses where videos share a text.  The
document count is a scalar subquery (no driver round trip).  The second landing
of every 50th event is produced with ``explode`` in the same pass instead of a
second scan + union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlake.schemas import BRONZE_COLUMNS

# Fixed values of the adapter specification (FIXTURES.md section 2).
EVENT_TYPE_TO_CATEGORY = {"signup": 10, "error": 20, "click": 22, "view": 24, "purchase": 28}
TITLE_SUFFIXES = {0: " why?", 1: " wow!", 2: " 2024"}
TAG_VALUES = {1: "howto|learning|fun", 2: "[none]"}
PUBLISH_TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
SHIFT_DAYS = 30
DUPLICATE_EVERY = 50
PUBLISH_TIME_SHORT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
SHORT_TIME_EVERY = 13
CHANGED_COPY_EVERY, CHANGED_COPY_VIEWS = 100, 7
REPEATED_ID = (89, 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _when_map(key: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def bronze_from_events(events: DataFrame, documents: DataFrame) -> DataFrame:
    e = F.col("event_id")
    n_docs = documents.select(F.count(F.lit(1))).scalar()
    ev = events.select(
        "event_id", "user_id", "event_type", "value",
        F.col("ts").cast("timestamp").alias("ts"),
        (e % n_docs).alias("doc_key"),
    )
    docs = documents.select(F.col("doc_id").alias("doc_key"), "text")
    joined = ev.join(docs.hint("merge"), "doc_key", "inner")

    # every 89th event is another upload (another publish time) of its predecessor's video
    every, rest = REPEATED_ID
    video_id = F.format_string("vid_%06d", F.when(e % every == rest, e - 1).otherwise(e))
    title_body = F.col("text").substr(F.lit(1) + (e * 7) % 40, F.lit(10) + e % 70)
    title = F.when(e % 107 == 0, F.lit("")).otherwise(
        F.concat(title_body, _when_map(e % 5, TITLE_SUFFIXES, "")))
    publish_ts = F.timestamp_add("DAY", -(e % 4) * SHIFT_DAYS, F.col("ts"))
    views = (F.when(e % 101 == 0, F.lit(None))
             .when(e % 103 == 0, F.lit(-1))
             .otherwise(F.floor(F.col("value") * 1000)))
    likes = F.when(e % 97 == 0, F.lit(None)).otherwise(F.floor(F.col("value") * 10 * (e % 11)))

    bronze = joined.select(
        video_id.alias("video_id"),
        title.alias("title"),
        F.when(e % 109 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("Channel_"), F.col("user_id").cast("string"))).alias("channel_title"),
        _when_map(F.col("event_type"), EVENT_TYPE_TO_CATEGORY).cast("string").alias("category_id"),
        F.when(e % SHORT_TIME_EVERY == 0, F.date_format(publish_ts, PUBLISH_TIME_SHORT))
        .otherwise(F.date_format(publish_ts, PUBLISH_TIME_TEXT)).alias("publish_time"),
        _when_map(e % 3, TAG_VALUES).alias("tags"),
        views.cast("string").alias("views"),
        likes.cast("string").alias("likes"),
        F.floor(F.col("value") * (e % 4)).cast("string").alias("dislikes"),
        F.floor(F.col("value") * (e % 7)).cast("string").alias("comment_count"),
        F.concat(F.lit("http://img/"), video_id).alias("thumbnail_link"),
        F.lit("false").alias("comments_disabled"),
        F.lit("false").alias("ratings_disabled"),
        F.lit("false").alias("video_error_or_removed"),
        F.col("text").alias("description"),
        # copies: 2 for every 50th event (landed twice), else 1; every other second copy has more views
        F.explode(F.sequence(F.lit(1), F.when(e % DUPLICATE_EVERY == 0, 2).otherwise(1))).alias("_copy"),
        ((e % CHANGED_COPY_EVERY == 0) & (views >= 0)).alias("_grows"),
    )
    grown = (F.col("views").cast("bigint") + CHANGED_COPY_VIEWS).cast("string")
    return bronze.withColumn("views", F.when((F.col("_copy") == 2) & F.col("_grows"), grown).otherwise(F.col("views"))
                             ).select(*BRONZE_COLUMNS)


def load_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_events(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "documents"))
