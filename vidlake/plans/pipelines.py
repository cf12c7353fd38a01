"""Job compositions (PIP-1..PIP-5).  Each reads its inputs, runs the
operators and writes its outputs; counts come from Observations gathered
during the writes, so no job re-runs its lineage just to log a number."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from vidlake.functions.quality import ingestion_summary, validation_report
from vidlake.operators import gold
from vidlake.operators.features import build_features
from vidlake.operators.recommend import recommendation_bundle
from vidlake.plans.silver import bronze_to_silver
from vidlake.schemas import SILVER_PARTITION_KEYS
from vidlake.sources import sinks
from vidlake.sources.files import read_bronze_csv, read_table

# Rows of one gzipped landing file, which is one task for its readers.
LANDED_ROWS = 20_000


@dataclass
class RunReport:
    outputs: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)


def ingest(bronze: DataFrame, landing_dir: str, run_ts: str | None = None, source: str = "landed") -> RunReport:
    """PIP-1: validate -> land CSV + manifest -> summary.  Invalid batches
    are not landed.  Files are gzipped, each of at most LANDED_ROWS rows, so
    that a landing of any size is read by many tasks."""
    rep = RunReport()
    verdict = validation_report(bronze).first()
    rep.counts["validation"] = verdict.asDict()
    if not verdict["is_valid"]:
        return rep
    path, n = sinks.write_bronze_csv(bronze, landing_dir, run_ts, source, compression="gzip", rows_per_file=LANDED_ROWS)
    rep.outputs["landed"] = path
    rep.counts["landed_rows"] = n
    rep.counts["summary"] = ingestion_summary(read_bronze_csv(bronze.sparkSession, path)).first().asDict()
    return rep


def bronze_to_silver_job(spark: SparkSession, bronze_path: str, silver_path: str, as_of=None,
                         threshold: float = 0.8, table: str | None = None) -> RunReport:
    """PIP-2: SRC-1 -> CLN -> MET -> DQ-6/7 -> SNK-3 (+ SNK-6)."""
    silver, obs = bronze_to_silver(read_bronze_csv(spark, bronze_path), as_of=as_of, threshold=threshold,
                                   observe=True)
    sinks.write_staged(silver, silver_path, SILVER_PARTITION_KEYS)
    rep = RunReport(outputs={"silver": silver_path}, counts=dict(obs.get))
    if table:
        sinks.register_table(spark, table, silver_path)
    return rep


def silver_to_gold_job(spark: SparkSession, silver_path: str, gold_base: str, as_of=None, only=None) -> RunReport:
    """PIP-3: the five gold tables (or those named in ``only``) from one silver read.  Each builder is an
    independent aggregate over the (pruned) Parquet scan, so there is nothing
    worth caching: every table reads only the columns it needs."""
    silver = read_table(spark, silver_path)
    rep = RunReport()
    for name, fn in gold.GOLD_BUILDERS.items():
        if only is not None and name not in only:
            continue
        df = fn(silver, as_of=as_of) if name == "channel_performance" else fn(silver)
        rep.outputs[name] = sinks.write_gold(df, gold_base, name)
    return rep


def features_job(spark: SparkSession, silver_path: str, features_path: str, **kw) -> RunReport:
    """PIP-4: silver -> FEA-1..31 -> SNK-5."""
    sinks.write_features(build_features(read_table(spark, silver_path), **kw), features_path)
    return RunReport(outputs={"features": features_path})


def recommendations_job(spark: SparkSession, posting_path: str, out_base: str, top_n: int = 5,
                        videos_per_week: int = 3, run_ts: str | None = None, generated_at: str | None = None) -> RunReport:
    """PIP-5: every category's recommendation record -> JSON (SNK-7)."""
    bundle = recommendation_bundle(read_table(spark, posting_path), top_n, videos_per_week, generated_at)
    return RunReport(outputs={"recommendations": sinks.write_json(bundle, out_base, "posting_recommendations",
                                                                   run_ts)})
