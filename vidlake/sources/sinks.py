"""Sinks (SNK-1..SNK-8).

Partitioned Parquet writes use the REBALANCE hint on the partition keys: rows
of one output directory are co-located (few files per directory), and AQE
splits an oversized key across several tasks instead of one task writing a
third of the table.  Rows that carry whole texts are regrouped through files
instead (``write_staged``): an exchange would hold them all once more.
Overwrites are dynamic: a rerun replaces only the partitions it produces, so
jobs are idempotent and safe to retry.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vidlake.schemas import FEATURE_PARTITION_KEYS, GOLD_PARTITION_KEYS, SILVER_PARTITION_KEYS
from vidlake.session import SHUFFLES_FREED, scratch_path, settings
from vidlake.sources.files import delete_folder, escape_breaks, folder_bytes, hadoop_path, leaf_folders

# write_staged: staged bytes of a written file; least staged bytes, and most folders, of the rounds they are moved in.
FILE_BYTES, ROUND_BYTES, ROUND_FOLDERS = 32 << 20, 256 << 20, 64
# A text that rows of a file share is held once, also where the distinct ones exceed the usual dictionary of 1 MB; Parquet
# leaves the dictionary by itself after the first page where values hardly repeat.
SHARED_TEXTS = {"parquet.dictionary.page.size": 32 << 20}
STAGED = {"compression": "zstd", "parquet.compression.codec.zstd.level": 1, **SHARED_TEXTS}
# A union of parts of one task each would otherwise be one task.
TASKS_KEPT = {"spark.sql.unionOutputPartitioning": "false"}


def _stamp(ts: str | None = None) -> str:
    return ts or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")


def write_partitioned(df: DataFrame, path: str, partition_keys, mode: str = "overwrite", **options) -> None:
    """SNK-3 / SNK-4 / SNK-5 writer: Snappy Parquet, dynamic partition overwrite."""
    keys = list(partition_keys)
    _save(df.hint("rebalance", *keys) if keys else df, path, keys, mode, **options)


def _save(df: DataFrame, path: str, keys: list[str], mode: str, **options) -> None:
    (df.write.mode(mode).options(compression="snappy", **options)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


def write_staged(df: DataFrame, path: str, partition_keys) -> None:
    """The files and rows of ``write_partitioned`` without an exchange: every task writes its rows of a partition to
    files of its own in the shared scratch folder (zstd), and then folder after folder is written anew as files of
    about ``FILE_BYTES`` staged bytes, each by a task that reads that folder alone.  Rounds of a sixteenth of the
    bytes (``ROUND_BYTES`` at least) are deleted from scratch once written, so the rows lie there and in the table
    about once together."""
    spark, keys = df.sparkSession, list(partition_keys)
    staged = scratch_path(spark, "staged")
    with settings(spark, SHUFFLES_FREED):
        df.write.options(**STAGED).partitionBy(*keys).parquet(staged)
    sizes = {f: folder_bytes(spark, f) for f in leaf_folders(spark, staged)}
    most = max(ROUND_BYTES, sum(sizes.values()) // 16)
    rounds, held = [], 0
    for f, size in sizes.items():
        if not rounds or held + size > most or len(rounds[-1]) == ROUND_FOLDERS:
            rounds.append([])
            held = 0
        rounds[-1].append(f)
        held += size
    for folders in rounds or [[]]:
        rows = None if folders else spark.createDataFrame([], df.schema)
        for f in folders:
            part = (spark.read.schema(df.schema).option("basePath", staged).parquet(f)
                    .coalesce(max(1, -(-sizes[f] // FILE_BYTES))))
            rows = part if rows is None else rows.union(part)
        with settings(spark, TASKS_KEPT):
            _save(rows, path, keys, "overwrite", **SHARED_TEXTS)
        for f in folders:
            delete_folder(spark, f)
    delete_folder(spark, staged)


def write_silver(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-3."""
    write_partitioned(df, path, SILVER_PARTITION_KEYS, mode)


def write_gold(df: DataFrame, base: str, table_name: str, partition_keys=None, mode: str = "overwrite") -> str:
    """SNK-4: one gold table under ``base/table_name``."""
    keys = partition_keys if partition_keys is not None else GOLD_PARTITION_KEYS.get(table_name, [])
    path = f"{base.rstrip('/')}/{table_name}"
    write_partitioned(df, path, keys, mode)
    return path


def write_features(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-5 (partition columns are carried by the feature selection)."""
    write_partitioned(df, path, FEATURE_PARTITION_KEYS, mode)


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = True) -> None:
    """SNK-6: catalog entry over the written files, partitions discovered.  A
    table of that name at another location is an error, not kept silently."""
    if spark.catalog.tableExists(name):
        there = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
        fs, p = hadoop_path(spark, path)
        if fs.makeQualified(p).toString().rstrip("/") != there.rstrip("/"):
            raise ValueError(f"table {name} lies at {there}, not at {path}")
    else:
        spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def write_bronze_csv(df: DataFrame, base: str, run_ts: str | None = None, source: str = "landed",
                     compression: str = "none", rows_per_file: int = 0):
    """SNK-1 + SNK-2: land rows as CSV with a header under
    ``base/video_stats_{ts}`` and a one-row JSON manifest under
    ``base/_manifests``.  Values are written verbatim (no whitespace trim) but
    for line breaks, which are escaped, so that a file of any size splits into
    tasks.  The record count is observed during the CSV write (no second
    pass).  A ``compression`` whose files cannot be split (gzip) goes with
    ``rows_per_file``, which ends a file after so many rows."""
    ts = _stamp(run_ts)
    path = f"{base.rstrip('/')}/video_stats_{ts}"
    obs = Observation(f"landing_{ts}")
    lines = df.select(*(escape_breaks(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns))
    observed = lines.observe(obs, F.count(F.lit(1)).alias("record_count"))
    (observed.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("compression", compression).option("maxRecordsPerFile", rows_per_file)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    count = obs.get["record_count"]
    spark = df.sparkSession
    manifest = spark.createDataFrame(
        [(str(count), dt.datetime.now(dt.timezone.utc).isoformat(), ",".join(df.columns), source)],
        "record_count string, upload_timestamp string, columns string, source string")
    # underscore folder: hidden from file listings, so readers of the landing
    # folder never mistake a manifest for data
    manifest.coalesce(1).write.mode("overwrite").json(f"{base.rstrip('/')}/_manifests/video_stats_{ts}")
    return path, count


def write_json(df: DataFrame, base: str, name: str, run_ts: str | None = None) -> str:
    """SNK-7 / SNK-8: timestamped JSON output (recommendations, predictions)."""
    path = f"{base.rstrip('/')}/{_stamp(run_ts)}_{name}"
    df.write.mode("overwrite").json(path)
    return path


def write_predictions(df: DataFrame, path: str, mode: str = "append") -> None:
    """SNK-8: predictions to the curated area (Parquet, appended per run)."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)
