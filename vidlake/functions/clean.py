"""Bronze -> silver cleaning (CLN-1..CLN-13)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidlake.schemas import COUNTER_COLUMNS, FLAG_COLUMNS
from vidlake.session import materialize

PUBLISH_TIME_PATTERNS = ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'")
DEDUP_KEYS = ("video_id", "publish_time")
# Hashes of keys landed more than once that are broadcast (8 bytes each, some 100 MB as a hash table).
SHARED_KEYS_MAX = 4_000_000


def as_of_date(as_of) -> Column:
    """Reference date for age columns; a fixed date keeps results reproducible."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.to_date(F.lit(str(as_of)))


def normalize_name(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")


def standardize_column_names(df: DataFrame) -> DataFrame:
    """CLN-2: lower case, space and hyphen to underscore; one projection.

    Runs before de-duplication so headers such as ``Video ID`` resolve.
    Two source columns that normalise to the same name are an error.
    """
    new = [normalize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def deduplicate(df: DataFrame, keys=DEDUP_KEYS, prefer: str = "views", max_shared: int = SHARED_KEYS_MAX) -> DataFrame:
    """CLN-1: one row per key.  Survivor: largest numeric ``prefer`` (nulls
    lose), then the largest remaining row, so the result is deterministic.

    A first pass counts the rows of every key by the key's 64-bit hash alone
    and writes the hashes found more than once.  Only rows with such a hash
    are exchanged and compared; all others (whole texts among them) stay where
    they were read.  Unequal keys of one hash are compared needlessly, never
    merged.  The hashes are broadcast up to ``max_shared`` of them; with more,
    every row is exchanged.
    """
    keys = list(keys)
    shared = materialize(df.select(F.xxhash64(*keys).alias("_hash")).groupBy("_hash")
                         .agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash"), "shared_keys")
    n = shared.count()
    if n == 0:
        return df
    if n > max_shared:
        return survivors(df, keys, prefer)
    same, shared = F.xxhash64(*keys) == F.col("_hash"), F.broadcast(shared)
    return df.join(shared, same, "left_anti").unionByName(survivors(df.join(shared, same, "left_semi"), keys, prefer))


def survivors(df: DataFrame, keys, prefer: str) -> DataFrame:
    """One row per key, by an exchange of all rows.

    Expressed as ``groupBy(keys).agg(max(struct))``: the aggregate combines
    map-side, so a key landed millions of times ships one row per task to the
    shuffle instead of every copy (a window would shuffle and sort them all).
    """
    others = [c for c in df.columns if c not in keys]
    order = []
    if prefer in others:
        order.append(F.expr(f"try_cast(`{prefer}` AS BIGINT)").alias("_prefer"))
    rank_key = F.struct(*order, *[F.col(f"`{c}`").alias(c) for c in others])
    out = df.groupBy(*keys).agg(F.max(rank_key).alias("_row"))
    cols = {c: F.col(f"`{c}`") for c in keys}
    cols.update({c: F.col("_row").getField(c).alias(c) for c in others})
    return out.select(*[cols[c] for c in df.columns])


def parse_publish_time(col: Column) -> Column:
    """CLN-5: ISO text with or without milliseconds; anything else -> null."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(p)) for p in PUBLISH_TIME_PATTERNS])


def tag_count(tags: Column) -> Column:
    """CLN-12 / FEA-14: pieces between pipes; null -> 0, '' -> 1."""
    return F.when(tags.isNotNull(), F.size(F.split(tags, r"\|"))).otherwise(F.lit(0))


def quality_score(views: Column, title: Column, channel: Column) -> Column:
    """DQ-5 ladder."""
    return (F.when(views.isNull() | (views < 0), F.lit(0.0))
            .when(title.isNull() | (F.length(title) == 0), F.lit(0.3))
            .when(channel.isNull(), F.lit(0.5))
            .otherwise(F.lit(1.0)))


def clean_and_standardize(df: DataFrame, as_of=None, job_name: str = "bronze_to_silver") -> DataFrame:
    """CLN-1..13 + DQ-5: a projection (casts, null fills, trims), the
    de-duplication of the typed rows, and a projection of the columns derived
    from them.  The survivor is chosen among typed values, so rows read back
    from silver and newly landed ones follow the same rule (SRC-7)."""
    return derive_columns(deduplicate(typed_columns(df)), as_of, job_name)


def typed_columns(df: DataFrame) -> DataFrame:
    """CLN-2..4, CLN-10: normalised names, casts, null fills and trims."""
    df = standardize_column_names(df)
    fills = {"likes": 0, "dislikes": 0, "comment_count": 0}
    first = {}
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in COUNTER_COLUMNS:
            col = F.expr(f"try_cast(`{c}` AS BIGINT)")
            if c in fills:
                col = F.coalesce(col, F.lit(fills[c]).cast("bigint"))
        elif c in FLAG_COLUMNS:
            col = F.coalesce(F.expr(f"try_cast(`{c}` AS BOOLEAN)"), F.lit(False))
        elif c == "category_id":
            col = F.expr("try_cast(category_id AS INT)")
        elif c in ("title", "channel_title", "description"):
            col = F.trim(col)
        first[c] = col.alias(c)
    return df.select(*first.values())


def derive_columns(df: DataFrame, as_of=None, job_name: str = "bronze_to_silver") -> DataFrame:
    """CLN-5..9, CLN-11..13 and DQ-5 from typed rows."""
    df = df.withColumn("publish_timestamp", parse_publish_time(F.col("publish_time")))
    ts, pd_ = F.col("publish_timestamp"), F.to_date("publish_timestamp")
    return df.select("*", *[e.alias(n) for n, e in {
        "publish_date": pd_,
        "publish_year": F.year(ts),
        "publish_month": F.month(ts),
        "publish_day": F.dayofmonth(ts),
        "publish_hour": F.hour(ts),
        "publish_day_of_week": F.dayofweek(ts),
        "days_since_publish": F.datediff(as_of_date(as_of), pd_),
        "title_length": F.length("title"),
        "description_length": F.length("description"),
        "tag_count": tag_count(F.col("tags")),
        "data_quality_score": quality_score(F.col("views"), F.col("title"), F.col("channel_title")),
        "processed_timestamp": F.current_timestamp(),
        "processing_job": F.lit(job_name),
    }.items()])
