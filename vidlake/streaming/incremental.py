"""Incremental bronze -> silver (SRC-7).

The reference relies on job bookmarks so that each run only processes newly
landed files.  The Spark form: a file stream over the landing folder with
``trigger(availableNow=True)`` -- each run consumes exactly the files not yet
recorded in the checkpoint, then stops -- and ``foreachBatch`` merging each
micro-batch into silver.

Silver after any number of runs equals the batch job over all landed files: a
key's survivor is chosen by the batch rule (CLN-1) among what was landed
before and what lands now, and only then filtered by quality.  Survivors that
fail the filter are kept beside silver (``<silver>_rejected``), because a
later copy of the same key must still be compared with them.

A key fixes its publish time, hence its year and month, and the hash of a key
its *bucket*, one more partition level below the category.  A batch reads and
rewrites only the (year, month, bucket) folders that its own keys fall into,
whatever their categories (a later copy may have another one), so its cost
follows the batch and not the months it touches.  The number of buckets is
fixed when the table is first written (a month's bytes divided by the bytes a
batch may rewrite per key) and recorded in ``_layout``; a silver table that was
written without buckets is brought into this layout by ``bucket_silver``.
Folders that its rows have left are removed.  A retried micro-batch arrives at
the same survivors, so the sink is idempotent.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.functions.clean import DEDUP_KEYS, deduplicate, derive_columns, typed_columns
from vidlake.functions.metrics import add_derived_metrics
from vidlake.functions.quality import DEFAULT_QUALITY_THRESHOLD, quality_filter_condition
from vidlake.plans.silver import SILVER_COLUMNS
from vidlake.schemas import SILVER_PARTITION_KEYS
from vidlake.session import SHUFFLES_FREED, scratch_path, settings
from vidlake.sources.files import delete_folder, folder_bytes, hadoop_path, leaf_folders, path_exists, read_bronze_csv
from vidlake.sources.sinks import SHARED_TEXTS, STAGED, write_partitioned

MONTH = ["publish_year", "publish_month"]
BUCKET = "key_bucket"
FOLDERS = [*SILVER_PARTITION_KEYS, BUCKET]
BUCKETS = 8
# Least bytes, staged and in silver, of the buckets that are merged together.
MERGE_BYTES = 256 << 20
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def key_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*DEDUP_KEYS), F.lit(buckets)).cast("int")


def _folder(names: list[str], values) -> str:
    return "/".join(f"{n}={NULL_FOLDER if v is None else v}" for n, v in zip(names, values))


def layout(spark: SparkSession, silver_path: str, buckets: int | None = None) -> int:
    """The table's number of buckets; recorded (``buckets``, else BUCKETS) where there is no table yet."""
    path = f"{silver_path.rstrip('/')}/_layout"
    if path_exists(spark, path):
        had = json.loads(spark.read.text(path).first()[0])["buckets"]
        if buckets and buckets != had:
            raise ValueError(f"{silver_path} has {had} buckets, not {buckets}")
        return had
    if path_exists(spark, silver_path):
        raise ValueError(f"{silver_path} is not bucketed by key; write it anew with bucket_silver")
    had = buckets or BUCKETS
    spark.createDataFrame([(json.dumps({"buckets": had}),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return had


def bucket_silver(silver: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """A silver table (say, of the batch job) written in the layout that batches are merged into."""
    had = layout(silver.sparkSession, path, buckets)
    write_partitioned(silver.select(*SILVER_COLUMNS).withColumn(BUCKET, key_bucket(had)), path, FOLDERS)


def _folders(spark: SparkSession, path: str, touched: list) -> list[tuple]:
    """Existing folders (year, month, category, bucket) of the touched (year, month, bucket).  Names only; as many as
    Spark itself lists to read them."""
    found, months = [], {}
    for r in touched:
        months.setdefault((r[0], r[1]), set()).add(str(r[2]))
    for (year, month), buckets in months.items():
        fs, at = hadoop_path(spark, f"{path.rstrip('/')}/{_folder(MONTH, (year, month))}")
        if not fs.exists(at):
            continue
        for category in (s.getPath() for s in fs.listStatus(at) if s.isDirectory()):
            name = category.getName().split("=", 1)[1]
            for status in fs.listStatus(category):
                bucket = status.getPath().getName().split("=", 1)[1]
                if bucket in buckets:
                    found.append((year, month, None if name == NULL_FOLDER else int(name), int(bucket)))
    return found


def _rounds(sizes: dict[int, int]) -> list[list[int]]:
    """Buckets merged together: a sixteenth of the bytes, MERGE_BYTES at least, or one bucket that holds more."""
    most, rounds, held = max(MERGE_BYTES, sum(sizes.values()) // 16), [], 0
    for b, size in sorted(sizes.items()):
        if not rounds or held + size > most:
            rounds.append([])
            held = 0
        rounds[-1].append(b)
        held += size
    return rounds


def merge_batch(bronze: DataFrame, silver_path: str, as_of=None, threshold: float = DEFAULT_QUALITY_THRESHOLD,
                buckets: int | None = None) -> None:
    """Merge newly landed rows into silver and the rejected survivors beside it.

    The landed rows are read once and written by bucket, without an exchange.  A key's copies share a bucket, so
    buckets are merged one round after another (``_rounds``); what a round exchanges and writes aside is deleted
    when it ends, so next to silver there lies about one copy of the batch, however much of silver it touches."""
    spark = bronze.sparkSession
    buckets = layout(spark, silver_path, buckets)
    paths = (silver_path.rstrip("/"), f"{silver_path.rstrip('/')}_rejected")
    new = (add_derived_metrics(derive_columns(typed_columns(bronze), as_of)).select(*SILVER_COLUMNS)
           .withColumn(BUCKET, key_bucket(buckets)))
    schema = T.StructType(new.schema.fields)
    staged = scratch_path(spark, "stream_new")
    keep = F.coalesce(quality_filter_condition(threshold), F.lit(False))
    with settings(spark, SHUFFLES_FREED):
        new.write.options(**STAGED).partitionBy(BUCKET).parquet(staged)
        mine = {int(f.rsplit("=", 1)[1]): f for f in leaf_folders(spark, staged)}
        if mine:
            touched = (spark.read.schema(schema).option("basePath", staged).parquet(*mine.values())
                       .select(*MONTH, BUCKET).distinct().collect())     # folders, not rows
            before = {p: _folders(spark, p, touched) if path_exists(spark, p) else [] for p in paths}
            sizes = {b: folder_bytes(spark, f) for b, f in mine.items()}
            for path in paths:
                for f in before[path]:
                    sizes[f[-1]] += folder_bytes(spark, f"{path}/{_folder(FOLDERS, f)}")
            for group in _rounds(sizes):
                rows = spark.read.schema(schema).option("basePath", staged).parquet(*(mine[b] for b in group))
                old = {p: [f for f in before[p] if f[-1] in group] for p in paths}
                _merge_round(rows, schema, old, keep)
                for b in group:
                    delete_folder(spark, mine[b])
        delete_folder(spark, staged)


def _merge_round(rows: DataFrame, schema: T.StructType, before: dict[str, list[tuple]], keep: Column) -> None:
    """New rows of some buckets merged with the folders ``before`` of silver and of the rejected survivors."""
    spark = rows.sparkSession
    for path, folders in before.items():
        if folders:
            old = spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/{_folder(FOLDERS, f)}" for f in folders))
            rows = rows.unionByName(old)
    merged = scratch_path(spark, "stream_merged")
    deduplicate(rows).write.options(**STAGED).parquet(merged)
    rows = spark.read.schema(schema).parquet(merged)
    now = rows.select(*FOLDERS, keep.alias("keep")).distinct().collect()      # folders, not rows
    for path, kept in zip(before, (True, False)):
        mine = {tuple(r)[:-1] for r in now if r["keep"] is kept}
        if mine:
            write_partitioned(rows.filter(keep if kept else ~keep), path, FOLDERS, **SHARED_TEXTS)
        for gone in set(before[path]) - mine:
            delete_folder(spark, f"{path}/{_folder(FOLDERS, gone)}")
    delete_folder(spark, merged)


def incremental_silver(spark: SparkSession, landing_dir: str, silver_path: str, checkpoint: str,
                       as_of=None, max_files_per_trigger: int | None = None, buckets: int | None = None):
    """Process every landed CSV not seen by ``checkpoint``; returns the query
    after it terminated.  The stream only tells which files are new; their
    rows are read by header names, as in the batch job."""
    # Paths only: the content column is not asked for, so no file is read here.
    reader = (spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
              .schema("path string, modificationTime timestamp, length long, content binary"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing_dir).select("path")

    def merge(batch: DataFrame, epoch_id: int) -> None:
        files = [r["path"] for r in batch.filter(F.col("path").rlike(r"\.csv(\.gz)?$")).collect()]
        if files:
            merge_batch(read_bronze_csv(batch.sparkSession, sorted(files)), silver_path, as_of, buckets=buckets)

    q = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
