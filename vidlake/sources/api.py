"""Landed video-API responses -> bronze rows (SRC-6).

Network calls are out of scope; a fetcher lands the JSON responses as files
and this reads them.  Each line is one response ``{"items": [...]}``; items
are exploded and flattened with the reference's defaults: missing tags -> '',
missing counters -> 0, dislikes 0, comments disabled when the comment count
is missing or empty, ratings/error flags false.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.schemas import API_RESPONSE_SCHEMA, BRONZE_COLUMNS

# Responses of one gzipped landing file, which is one task for its readers.
LANDED_PAGES = 400


def _count(c):
    return F.coalesce(F.expr(f"try_cast({c} AS BIGINT)"), F.lit(0)).cast("string")


def flatten_api_items(responses: DataFrame) -> DataFrame:
    items = responses.select(F.explode_outer("items").alias("it")).filter(F.col("it").isNotNull())
    s, st = "it.snippet", "it.statistics"
    comments = F.col(f"{st}.commentCount")
    out = items.select(
        F.col("it.id").alias("video_id"),
        F.col(f"{s}.title").alias("title"),
        F.col(f"{s}.channelTitle").alias("channel_title"),
        F.expr(f"try_cast({s}.categoryId AS INT)").cast("string").alias("category_id"),
        F.col(f"{s}.publishedAt").alias("publish_time"),
        F.array_join(F.coalesce(F.col(f"{s}.tags"), F.array().cast("array<string>")), "|").alias("tags"),
        _count(f"{st}.viewCount").alias("views"),
        _count(f"{st}.likeCount").alias("likes"),
        F.lit("0").alias("dislikes"),
        _count(f"{st}.commentCount").alias("comment_count"),
        F.col(f"{s}.thumbnails.default.url").alias("thumbnail_link"),
        F.when(comments.isNull() | (comments == ""), "true").otherwise("false").alias("comments_disabled"),
        F.lit("false").alias("ratings_disabled"),
        F.lit("false").alias("video_error_or_removed"),
        F.col(f"{s}.description").alias("description"),
    )
    return out.select(*BRONZE_COLUMNS)


def read_api_responses(spark: SparkSession, path: str) -> DataFrame:
    return flatten_api_items(spark.read.schema(API_RESPONSE_SCHEMA).json(path))


def land_api_responses(responses: DataFrame, path: str, pages_per_file: int = LANDED_PAGES) -> None:
    """Responses landed as gzipped JSON lines.  Such a file is one task for its readers, so it ends after
    ``pages_per_file`` responses."""
    responses.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", pages_per_file).json(path)


def bronze_to_api_responses(bronze: DataFrame, page_size: int = 50) -> DataFrame:
    """Shape bronze rows as API responses of at most ``page_size`` items -- used
    to land test responses from the driver tables.  Consecutive rows of a task
    are cut into pages where they are: no row is exchanged or written for it,
    and a page is bounded whatever the ids look like and however often they
    repeat.  A page ends with its Arrow batch, so one may be shorter."""
    item = F.struct(
        F.col("video_id").alias("id"),
        F.struct(
            F.col("title").alias("title"), F.col("channel_title").alias("channelTitle"),
            F.col("category_id").alias("categoryId"), F.col("publish_time").alias("publishedAt"),
            F.when(F.col("tags").isNotNull(), F.split("tags", r"\|")).alias("tags"),
            F.struct(F.struct(F.col("thumbnail_link").alias("url")).alias("default")).alias("thumbnails"),
            F.col("description").alias("description"),
        ).alias("snippet"),
        F.struct(F.col("views").alias("viewCount"), F.col("likes").alias("likeCount"),
                 F.col("comment_count").alias("commentCount")).alias("statistics"),
    )

    def pages(batches):  # nested, so that workers get it by value and need not import this package
        import pyarrow as pa
        for batch in batches:
            items, n = batch.column(0), batch.num_rows
            if n:
                starts = pa.array([*range(0, n, page_size), n], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(starts, items)], ["items"])

    rows = bronze.select(item.alias("item"))
    return rows.mapInArrow(pages, T.StructType([T.StructField("items", T.ArrayType(rows.schema["item"].dataType))]))
