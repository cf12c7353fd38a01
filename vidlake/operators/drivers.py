"""What drives engagement (AGG-13): rank correlation and share of variance.

One scan of the videos gives a narrow table of distinct (drivers, target)
combinations with their counts; everything else reads that table.

* Spearman's rho is the correlation of average ranks.  Ranks of values come
  from their counts: the values are range-partitioned, summed within their
  slice, and the slices' totals are added up, so neither a frequent value nor
  a column of as many values as rows ends up in one task.
* The share of variance between the values of a driver (eta squared) holds
  for drivers without an order too, such as the category.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlake.operators.joins import BROADCAST_MAX_ROWS
from vidlake.operators.ranking import ordered_slices
from vidlake.session import materialize

TARGET = "engagement_rate"
ORDERED_DRIVERS = ("publish_hour", "publish_day_of_week", "tag_count", "title_length")
NAMED_DRIVERS = ("category_id",)
# Parts into which the combinations of one value go when its rank table is too large to broadcast.
SALTS = 32


def average_ranks(values: DataFrame, keys: list[str], value: str, count: str, name: str) -> DataFrame:
    """Adds the average rank, from 1, that the rows of a value have among the
    rows of their key.  ``values`` has one row per (keys, value) and their
    number of rows in ``count``; nulls come first and are a value."""
    slices = ordered_slices(values, keys, [F.col(value).asc_nulls_first()])
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = (slices.groupBy(*keys, "_pid").agg(F.sum(count).alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_pid").alias("_of"), "_start"))
    inside = Window.partitionBy(*keys, "_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_pid") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    counted = slices.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    rank = F.col("_start") + F.col("_inside") + (F.col(count) + F.lit(1)) / F.lit(2.0)
    return counted.join(starts, same).withColumn(name, rank).select(*values.columns, name)


def _with_ranks(rows: DataFrame, ranks: DataFrame, column: str, target: str, fits: bool) -> DataFrame:
    """``rows`` with the rank of ``column``: a broadcast if it ``fits``, or a
    join in which the rows of a frequent value go to SALTS tasks."""
    if fits:
        return rows.join(F.broadcast(ranks), column)
    salted = ranks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    part = F.pmod(F.xxhash64(target), F.lit(SALTS)).cast("int")
    return rows.withColumn("_salt", part).join(salted, [column, "_salt"]).drop("_salt")


def driver_strength(silver: DataFrame, ordered=ORDERED_DRIVERS, named=NAMED_DRIVERS, target: str = TARGET,
                    max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """AGG-13, one row per driver: ``driver``, ``n_videos``, ``n_values``,
    ``spearman`` (null for drivers without an order) and ``variance_share``.

    The ranks of a driver of at most ``max_rows`` values (counted; two numbers
    each) are broadcast, those of others joined.
    Videos in which a driver or the target is null are left out.  Both measures
    are null where nothing varies, and for a table without videos
    (``n_videos`` 0 then).
    """
    spark = silver.sparkSession
    ordered, drivers = list(ordered), [*ordered, *named]
    rows = silver.select(*[F.col(c).cast("double").alias(c) for c in ordered],
                         *[F.col(c).cast("string").alias(c) for c in named], F.col(target).cast("double").alias(target))
    rows = materialize(rows.dropna().groupBy(*drivers, target).agg(F.count(F.lit(1)).alias("n")), "driver_rows")
    size = rows.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col(target)) / F.sum("n")).alias("mean")).first()
    n, mean = size["n"] or 0, size["mean"] or 0.0

    # Each driver's values, with the number of videos and the mean of the target; the target's own values as well.
    text = F.array(*[F.struct(F.lit(c).alias("driver"), F.col(c).cast("string").alias("label"),
                              (F.col(c) if c in [*ordered, target] else F.lit(None).cast("double")).alias("value"))
                     for c in [*drivers, target]])
    values = (rows.select(F.explode(text).alias("d"), "n", (F.col("n") * F.col(target)).alias("s")).select("d.*", "n", "s")
              .groupBy("driver", "label", "value").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    values = materialize(values, "driver_values")
    apart = F.col("n") * (F.col("s") / F.col("n") - F.lit(mean)) ** 2
    spread = {r["driver"]: r for r in values.groupBy("driver").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum(apart).alias("between")).collect()}

    ranked = average_ranks(values.filter(F.col("value").isNotNull()).select("driver", "value", "n"),
                           ["driver"], "value", "n", "rank")
    # The mean rank is (n + 1) / 2 whatever the ties; sums of deviations keep their digits at any size.
    ranked = materialize(ranked.withColumn("dev", F.col("rank") - F.lit((n + 1) / 2)), "driver_ranked")
    squares = {r["driver"]: r["q"] for r in ranked.groupBy("driver").agg(F.sum(F.col("n") * F.col("dev") ** 2).alias("q")).collect()}
    wide = rows
    for i, c in enumerate(ordered):
        wide = _with_ranks(wide, ranked.filter(F.col("driver") == c).select(F.col("value").alias(c), F.col("dev").alias(f"_d{i}")),
                           c, target, c not in spread or spread[c]["n_values"] <= max_rows)
    # One row per value of the target on both sides of the last join.
    sums = wide.groupBy(target).agg(*[F.sum(F.col("n") * F.col(f"_d{i}")).alias(f"_s{i}") for i in range(len(ordered))])
    own = ranked.filter(F.col("driver") == target).select(F.col("value").alias(target), "dev")
    products = sums.join(own, target).agg(*[F.sum(F.col(f"_s{i}") * F.col("dev")).alias(c) for i, c in enumerate(ordered)]).first()

    total = spread[target]["between"] if target in spread else 0.0
    out = []
    for c in drivers:
        both = squares.get(c, 0.0) * squares.get(target, 0.0) if c in ordered else 0.0
        out.append((c, n, spread[c]["n_values"] if c in spread else 0, products[c] / math.sqrt(both) if both else None,
                    spread[c]["between"] / total if total else None))
    return spark.createDataFrame(out, "driver string, n_videos long, n_values long, spearman double, variance_share double")
