"""SparkSession helpers.

Library code never creates a session: every operator receives DataFrames.
``local_session`` is for tests, the bench and the smoke entry only.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators rely on for deterministic results.  The session time
# zone must be UTC: bronze publish times carry a literal 'Z' and are parsed as
# UTC wall clock.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Runtime planning: AQE re-plans joins from real shuffle sizes (a size-checked
# broadcast with a sort-merge fallback), coalesces small shuffle partitions and
# splits skewed ones.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "vidlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**REQUIRED_CONF, **ADAPTIVE_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in ADAPTIVE_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared file
    system); without the setting a session on a cluster fails here, because a
    folder of the driver's machine is invisible to executors.  Only a local
    master (tests) gets a temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the conf is all there is
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="vidlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is None:
        return current
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


SHUFFLES_FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, conf: dict):
    """``conf`` while the block runs, and what was set before afterwards.  With SHUFFLES_FREED shuffle files go when
    the command that wrote them ends; else they lie on disk until the driver happens to collect garbage."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(df, name: str, **options):
    """``df`` written as Parquet (with the writer's ``options``) into the shared scratch folder and read back:
    computed once, lineage cut, independent of any executor's memory."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20,
               max_partition_bytes: int = 512 << 20) -> dict:
    """Settings to start from for a given input volume and cluster size.

    Initial shuffle partitions are sized so each holds about
    ``target_partition_bytes`` of the input (and at least 3 waves of the
    cluster's cores); AQE then coalesces small ones to the advisory size and
    splits skewed ones.  Scan splits stay at ``max_partition_bytes``.  E.g.
    100 TB on 1000 executors x 8 cores -> ~400k initial shuffle partitions.
    """
    parts = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_partition_bytes // 8),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        **ADAPTIVE_CONF, **REQUIRED_CONF,
    }
