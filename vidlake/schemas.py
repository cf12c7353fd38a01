"""Declared schemas for every layer (the reference declares none)."""

from pyspark.sql import types as T

# Bronze columns in landed-file order.  Everything is text at this layer: a CSV
# is read without inference and the cleaning step casts.
BRONZE_COLUMNS = [
    "video_id", "title", "channel_title", "category_id", "publish_time", "tags",
    "views", "likes", "dislikes", "comment_count", "thumbnail_link",
    "comments_disabled", "ratings_disabled", "video_error_or_removed", "description",
]

BRONZE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in BRONZE_COLUMNS])

# Columns a landed batch must carry (ingestion validation).
REQUIRED_COLUMNS = [
    "video_id", "title", "channel_title", "category_id",
    "publish_time", "views", "likes", "comment_count",
]

COUNTER_COLUMNS = ["views", "likes", "dislikes", "comment_count"]
FLAG_COLUMNS = ["comments_disabled", "ratings_disabled", "video_error_or_removed"]

SILVER_SCHEMA = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("channel_title", T.StringType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("publish_time", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("dislikes", T.LongType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("thumbnail_link", T.StringType()),
    T.StructField("comments_disabled", T.BooleanType()),
    T.StructField("ratings_disabled", T.BooleanType()),
    T.StructField("video_error_or_removed", T.BooleanType()),
    T.StructField("description", T.StringType()),
    T.StructField("publish_timestamp", T.TimestampType()),
    T.StructField("publish_date", T.DateType()),
    T.StructField("publish_year", T.IntegerType()),
    T.StructField("publish_month", T.IntegerType()),
    T.StructField("publish_day", T.IntegerType()),
    T.StructField("publish_hour", T.IntegerType()),
    T.StructField("publish_day_of_week", T.IntegerType()),
    T.StructField("days_since_publish", T.IntegerType()),
    T.StructField("title_length", T.IntegerType()),
    T.StructField("description_length", T.IntegerType()),
    T.StructField("tag_count", T.IntegerType()),
    T.StructField("data_quality_score", T.DoubleType()),
    T.StructField("processed_timestamp", T.TimestampType()),
    T.StructField("processing_job", T.StringType()),
    T.StructField("engagement_rate", T.DoubleType()),
    T.StructField("like_ratio", T.DoubleType()),
    T.StructField("comment_ratio", T.DoubleType()),
    T.StructField("views_per_day", T.DoubleType()),
    T.StructField("viral_score", T.DoubleType()),
    T.StructField("engagement_category", T.StringType()),
])

SILVER_PARTITION_KEYS = ["publish_year", "publish_month", "category_id"]

# Gold table -> partition keys of its sink.
GOLD_PARTITION_KEYS = {
    "daily_metrics": ["year", "month"],
    "channel_performance": ["category_id"],
    "category_analysis": ["year", "month", "category_id"],
    "trending_videos": ["publish_year", "publish_month"],
    "posting_time_analysis": ["category_id"],
}

FEATURE_PARTITION_KEYS = ["publish_year", "publish_month"]

# Nested video resource of the public video-listing API (landed JSON only).
API_ITEM_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("snippet", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("channelTitle", T.StringType()),
        T.StructField("categoryId", T.StringType()),
        T.StructField("publishedAt", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("thumbnails", T.StructType([
            T.StructField("default", T.StructType([T.StructField("url", T.StringType())])),
        ])),
        T.StructField("description", T.StringType()),
    ])),
    T.StructField("statistics", T.StructType([
        T.StructField("viewCount", T.StringType()),
        T.StructField("likeCount", T.StringType()),
        T.StructField("commentCount", T.StringType()),
    ])),
])

API_RESPONSE_SCHEMA = T.StructType([T.StructField("items", T.ArrayType(API_ITEM_SCHEMA))])

# Batch scoring input (one row per video to score).
SCORING_INPUT_SCHEMA = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("publish_hour", T.IntegerType()),
    T.StructField("publish_day_of_week", T.IntegerType()),
    T.StructField("publish_month", T.IntegerType()),
])
