"""Bronze -> silver composition (PIP-2 without its sink)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vidlake.functions.clean import clean_and_standardize
from vidlake.functions.metrics import add_derived_metrics
from vidlake.functions.quality import DEFAULT_QUALITY_THRESHOLD, apply_data_quality_filters
from vidlake.schemas import SILVER_SCHEMA

SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]
# Lineage columns differ per run; equality checks leave them out.
LINEAGE_COLUMNS = ["processed_timestamp", "processing_job"]


def bronze_to_silver(bronze: DataFrame, as_of=None, threshold: float = DEFAULT_QUALITY_THRESHOLD,
                     job_name: str = "bronze_to_silver", observe: bool = False):
    df = add_derived_metrics(clean_and_standardize(bronze, as_of=as_of, job_name=job_name))
    if observe:
        df, obs = apply_data_quality_filters(df, threshold, observe=True)
        return df.select(*SILVER_COLUMNS), obs
    return apply_data_quality_filters(df, threshold).select(*SILVER_COLUMNS)
