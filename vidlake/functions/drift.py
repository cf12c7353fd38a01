"""Drift of many columns against a stored reference profile (DQ-11, ML-11).

A profile is a small table: for every watched column its labels (numbers of
quantile buckets, or the values of a category; null is a label of its own)
with their counts, and the bucket edges.  It is written once, for the data
that a model was trained on; later data are compared with it in one scan, for
all columns together, by counts that are aggregated before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidlake.functions.quality import DRIFT_THRESHOLD
from vidlake.operators.ranking import grouped_percentiles
from vidlake.session import materialize

PROFILE_SCHEMA = "column string, label string, n long, edges array<double>"


def _pairs(df: DataFrame, entries: list[Column], *names: str) -> DataFrame:
    return df.select(F.explode(F.array(*entries)).alias("_e")).select(*[f"_e.{n}" for n in names])


def _counts(df: DataFrame, edges: dict[str, list | None]) -> DataFrame:
    """(column, label, n) of all columns in one scan; the edges are a few numbers per column that the caller names."""
    def label(c: str) -> Column:
        if edges[c] is None:
            return F.col(c).cast("string")
        v = F.col(c).cast("double")
        above = F.lit(0)
        for e in edges[c]:
            above = above + F.when(v > F.lit(float(e)), 1).otherwise(0)
        return F.when(v.isNotNull(), above).cast("string")

    entries = [F.struct(F.lit(c).alias("column"), label(c).alias("label")) for c in edges]
    return _pairs(df, entries, "column", "label").groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))


def reference_profile(df: DataFrame, numeric=(), categories=(), buckets: int = 10) -> DataFrame:
    """Profile of ``df``, to be written.  Numeric columns (compared as
    doubles) are cut at the exact quantiles 1/buckets, 2/buckets, ...; a column
    that holds only nulls has one label, null.  Of an empty table the profile
    is empty."""
    numeric, categories = list(numeric), list(categories)
    edges: dict[str, list | None] = {}
    if numeric:
        ps = {f"p{i}": i / buckets for i in range(1, buckets)}
        long = _pairs(df, [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in numeric],
                      "column", "value").filter(F.col("value").isNotNull())
        found = {r["column"]: r for r in grouped_percentiles(long, ["column"], "value", ps).collect()}
        edges = {c: [found[c][p] for p in ps] if c in found else [] for c in numeric}
    edges |= dict.fromkeys(categories)
    cut = F.lit(None).cast("array<double>")
    for c in numeric:
        cut = F.when(F.col("column") == c, F.array(*[F.lit(float(e)) for e in edges[c]]).cast("array<double>")).otherwise(cut)
    return _counts(df, edges).withColumn("edges", cut)


def drift_report(profile: DataFrame, current: DataFrame, floor: float = 1e-4, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """One row per column of the profile: ``column``, ``n_base``, ``n_current``,
    ``new_labels`` (labels the profile lacks), ``psi``, ``drifted``.

    A share below ``floor`` counts as ``floor``.  A column of the profile that
    ``current`` lacks raises; with no current rows ``psi`` is null and
    ``drifted`` false.
    """
    columns = profile.groupBy("column").agg(F.any_value("edges").alias("edges")).collect()
    zero = F.lit(0).cast("long")
    base = profile.select("column", "label", F.col("n").alias("b"), zero.alias("c"))
    both = base
    if columns:
        now = _counts(current, {r["column"]: r["edges"] for r in columns})
        both = base.unionByName(now.select("column", "label", zero.alias("b"), F.col("n").alias("c")))
    # Written: one row per label, read twice below, so that the rows are scanned once.
    labels = materialize(both.groupBy("column", "label").agg(F.sum("b").alias("b"), F.sum("c").alias("c")), "drift_counts")
    # One row per watched column: bounded by the columns that the profile names.
    totals = labels.groupBy("column").agg(F.sum("b").alias("n_base"), F.sum("c").alias("n_current"))
    share = lambda part, all_: F.greatest(F.col(part) / F.col(all_), F.lit(floor))
    there = labels.join(F.broadcast(totals), "column").filter("n_base > 0")
    there = there.withColumns({
        "_b": F.when(F.col("n_current") > 0, share("b", "n_base")),
        "_c": F.when(F.col("n_current") > 0, share("c", "n_current")),
    })
    out = there.groupBy("column").agg(
        F.any_value("n_base").alias("n_base"), F.any_value("n_current").alias("n_current"),
        F.count_if(F.col("b") == 0).alias("new_labels"),
        F.sum((F.col("_c") - F.col("_b")) * F.ln(F.col("_c") / F.col("_b"))).alias("psi"))
    return out.withColumn("drifted", F.coalesce(F.col("psi") > threshold, F.lit(False)))
