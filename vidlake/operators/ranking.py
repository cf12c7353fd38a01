"""Exact percentiles and skew-safe row numbers.

Percentiles are ``PERCENTILE_DISC``: the value of rank ceil(p * n) among the
non-null values.  They take two scans of the rows at any size:

1. a mergeable quantile sketch (KLL) per group, with the count and the least
   and greatest value.  Around the wanted rank, MARGIN times the sketch's rank
   error on both sides, it gives a *bracket* of values;
2. per bracket, the number of rows below it and the values inside it with their
   counts (partial aggregation).  The value of the wanted rank follows from
   them exactly.

Few values inside brackets are finished on the driver.  More are written to
the shared scratch folder, a few thousandths of the rows, and narrowed there by
histograms of value buckets.  A rank outside its bracket (a sketch's bound
holds with a probability) is noticed by the counts, and the bracket is replaced
by the values on the side where the rank must be: a further scan, never another
result.

Values keep their type; doubles (or whole numbers for integral columns) serve
for sketches and buckets only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.session import materialize

BUCKETS = 1024
# Size of a sketch over all rows and of one per group (a group's sketch holds
# about three times as many values), and the safety factor on its rank error.
SKETCH, GROUP_SKETCH, MARGIN = 4096, 512, 3
# Rows of the band table (groups x percentiles) that are kept on the driver and
# sent to every task; with more groups the bands stay a table and are joined.
DRIVER_BANDS = 4096
# Values with counts that a pass may send to the driver.
PASS_ROWS = 1 << 18


def _bucket(x: Column, lo: Column, hi: Column, buckets: int, integral: bool) -> Column:
    """Number (0..buckets-1) of the value's bucket between ``lo`` and ``hi``."""
    if integral:
        # Halved where the range itself would not fit into a long.
        far = F.shiftright(hi, 1) - F.shiftright(lo, 1) >= F.lit(2**62)
        step = F.when(far, F.shiftright(x, 1) - F.shiftright(lo, 1)).otherwise(x - lo)
        span = F.when(far, F.shiftright(hi, 1) - F.shiftright(lo, 1)).otherwise(hi - lo)
        width = F.call_function("div", span, F.lit(buckets)) + 1
        return F.least(F.call_function("div", step, width), F.lit(buckets - 1)).cast("int")
    half = lambda c: c.cast("double") / 2  # noqa: E731  no range of doubles overflows
    width = (half(hi) - half(lo)) / buckets
    number = F.floor((half(x) - half(lo)) / F.when(width > 0, width))
    return (F.when(width > 0, F.least(number, F.lit(buckets - 1)).cast("int"))
            .otherwise(F.when(x == lo, 0).otherwise(1)))


def _values(df: DataFrame, keys: list[str], column: str) -> tuple[DataFrame, bool]:
    """The keys, the value ``_x``, and ``_y``, its image for the sketch (of the same order)."""
    kind = df.schema[column].dataType
    integral = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    x = F.col(column).cast("long") if integral else F.col(column)
    values = df.select(*keys, x.alias("_x")).filter(F.col("_x").isNotNull())
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        values = values.filter(~F.isnan("_x"))          # not a number, like null, has no rank
    return values.withColumn("_y", F.col("_x") if integral else F.col("_x").cast("double")), integral


def rank_error(sketch: int) -> float:
    """Share of the rows by which a KLL sketch's ranks are off at most, with 99 percent probability (the published
    fit of the error to the sketch's size)."""
    return 2.296 / sketch ** 0.9021


def _brackets(values: DataFrame, keys: list[str], ps: list[float], integral: bool, sketch: int) -> DataFrame:
    """Per group: n, least, most (of ``_y``), and ``at``, a bracket [lo, hi] for every percentile.  One scan."""
    kind = "bigint" if integral else "double"
    near = MARGIN * rank_error(sketch)
    stats = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_y").alias("least"), F.max("_y").alias("most"),
        F.call_function(f"kll_sketch_agg_{kind}", F.col("_y"), F.lit(sketch)).alias("s")).filter("n > 0")

    def quantile(share: float) -> Column:
        return F.call_function(f"kll_sketch_get_quantile_{kind}", F.col("s"), F.lit(share))

    # The wanted rank is between p * n and p * n + 1; few rows are taken whole.
    few = F.col("n") * near < 2

    def bracket(p: float) -> Column:
        lo = quantile(p - near) if p > near else F.col("least")
        hi = quantile(p + near) if p + near < 1 else F.col("most")
        return F.struct(F.when(few, F.col("least")).otherwise(lo).alias("lo"), F.when(few, F.col("most")).otherwise(hi).alias("hi"))

    return stats.select(*keys, "n", "least", "most", F.array(*(bracket(p) for p in ps)).alias("at"))


def _tagged(rows: DataFrame, keys: list[str], bands: dict, fields: list[T.StructField]) -> DataFrame:
    """``rows`` with ``_b``, the bands (i, lo, hi) of their group; bands are broadcast."""
    band_type = T.ArrayType(T.StructType([T.StructField("i", T.IntegerType()), *fields]))
    per_group: dict[tuple, list] = {}
    for (group, i), (lo, hi) in bands.items():
        per_group.setdefault(group, []).append((i, lo, hi))
    if not keys:
        return rows.withColumn("_b", F.array(*(
            F.struct(F.lit(i).alias("i"), *(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip((lo, hi), fields)))
            for i, lo, hi in per_group[()])))
    table = rows.sparkSession.createDataFrame(
        [(*g, b) for g, b in per_group.items()],
        T.StructType([*(T.StructField(f"_g_{k}", rows.schema[k].dataType) for k in keys), T.StructField("_b", band_type)]))
    return rows.join(F.broadcast(table), _same(keys)).drop(*(f"_g_{k}" for k in keys))


def _same(keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return same


def _range(rows: DataFrame, column: str) -> list[T.StructField]:
    return [T.StructField(n, rows.schema[column].dataType) for n in ("lo", "hi")]


def _within(values: DataFrame, keys: list[str], brackets: dict) -> DataFrame:
    """keys, i, x, c: the values inside each bracket with their counts, and a null x for all rows below.  One scan."""
    inside = F.filter("_b", lambda b: F.col("_y") <= b["hi"])
    return (_tagged(values, keys, brackets, _range(values, "_y")).select(*keys, "_x", "_y", F.explode(inside).alias("_b"))
            .groupBy(*keys, F.col("_b.i").alias("i"), F.when(F.col("_y") >= F.col("_b.lo"), F.col("_x")).alias("x"))
            .agg(F.count(F.lit(1)).alias("c")))


def _narrowed(table: DataFrame, keys: list[str], bands: dict, integral: bool, buckets: int) -> dict:
    """{band: value} for bands (rank, least x, greatest x) over a table of values with counts."""
    kind = table.schema["x"].dataType
    while open_ := {b: v for b, v in bands.items() if v[1] != v[2]}:
        tagged = _tagged(table, keys, {b: v[1:] for b, v in open_.items()}, _range(table, "x"))
        mine = F.filter("_b", lambda b: (b["i"] == F.col("i")) & (F.col("x") >= b["lo"]) & (F.col("x") <= b["hi"]))
        n = max(2, min(buckets, PASS_ROWS // len(open_)))
        number = _bucket(F.col("x"), F.col("_b.lo"), F.col("_b.hi"), n, integral)
        counts = (tagged.select(*keys, "i", "x", "c", F.explode(mine).alias("_b")).groupBy(*keys, "i", number.alias("b"))
                  .agg(F.sum("c").alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        found: dict[tuple, list] = {}
        for r in counts:
            found.setdefault((tuple(r[k] for k in keys), r["i"]), []).append((r["b"], r["c"], r["lo"], r["hi"]))
        for band, hist in found.items():
            rank = open_[band][0]
            for _, c, lo, hi in sorted(hist):
                if rank <= c:
                    bands[band] = (rank, lo, hi)
                    break
                rank -= c
    return {b: v[1] for b, v in bands.items()}


def _passes(values: DataFrame, keys: list[str], ps: list[float], integral: bool, buckets: int, stats: DataFrame, most: int):
    """{group: [value per percentile]} on the driver, or None if there are more than ``most`` bands."""
    sketch = GROUP_SKETCH if keys else SKETCH
    rows = stats.limit(most // len(ps) + 1).collect()
    if len(rows) * len(ps) > most:
        return None
    ranks, brackets, ends, out = {}, {}, {}, {}
    for r in rows:
        group = tuple(r[k] for k in keys)
        out[group] = [None] * len(ps)
        for i, (p, b) in enumerate(zip(ps, r["at"])):
            ranks[group, i] = max(1, math.ceil(p * r["n"]))
            brackets[group, i], ends[group, i] = (b["lo"], b["hi"]), (r["least"], r["most"])
    likely = sum(r["n"] for r in rows) * len(ps) * 2 * MARGIN * rank_error(sketch)
    while brackets:
        counts, seen = _within(values, keys, brackets), {}
        few = counts.limit(PASS_ROWS + 1).collect() if likely <= PASS_ROWS // 2 else None
        if few is None or len(few) > PASS_ROWS:
            counts, few = materialize(counts, "brackets"), None
            below = F.sum(F.when(F.col("x").isNull(), F.col("c")).otherwise(0))
            for r in counts.groupBy(*keys, "i").agg(below.alias("below"), F.sum("c").alias("n"), F.min("x").alias("lo"),
                                                    F.max("x").alias("hi")).collect():
                seen[tuple(r[k] for k in keys), r["i"]] = (r["below"], r["n"], (r["lo"], r["hi"]))
        else:
            per: dict[tuple, list] = {}
            for r in few:
                per.setdefault((tuple(r[k] for k in keys), r["i"]), []).append((r["x"], r["c"]))
            for band, found in per.items():
                inside = sorted(xc for xc in found if xc[0] is not None)
                seen[band] = (sum(c for x, c in found if x is None), sum(c for _, c in found), inside)
        hit, missed = {}, {}
        for band, (lo, hi) in brackets.items():
            below, upto, inside = seen.get(band, (0, 0, None))
            if below < ranks[band] <= upto:
                hit[band] = (ranks[band] - below, inside)
            else:  # the rank is below the bracket, or above it
                missed[band] = (ends[band][0], lo) if ranks[band] <= below else (hi, ends[band][1])
        if few is None:
            values_of = _narrowed(counts.filter("x is not null"), keys, {b: (k, *at) for b, (k, at) in hit.items()}, integral, buckets)
        else:
            values_of = {}
            for band, (k, inside) in hit.items():
                for x, c in inside:
                    k -= c
                    if k <= 0:
                        values_of[band] = x
                        break
        for (group, i), x in values_of.items():
            out[group][i] = x
        brackets = missed
        likely = math.inf
    return out


def exact_percentiles(df: DataFrame, column: str, ps, buckets: int = BUCKETS) -> list:
    """The global percentiles ``ps`` as Python values (None without values), all in shared passes."""
    values, integral = _values(df, [], column)
    if not ps:
        return []
    stats = _brackets(values, [], list(ps), integral, SKETCH)
    found = _passes(values, [], list(ps), integral, buckets, stats, max(DRIVER_BANDS, len(ps)))
    return found.get((), [None] * len(ps))


def exact_percentile(df: DataFrame, column: str, p: float, buckets: int = BUCKETS):
    return exact_percentiles(df, column, [p], buckets)[0]


def percentile_of(df: DataFrame, column: str, p: float) -> Column:
    """A global threshold (BLK-2) as a literal for the outer plan."""
    return F.lit(exact_percentile(df, column, p))


def desc_then(*cols: str, tie=("video_id", "publish_time")) -> list[Column]:
    """Sort keys: the given columns descending, then the ``tie`` columns (a
    unique key) ascending, so that ranks and cuts are determined."""
    ties = [tie] if isinstance(tie, str) else list(tie)
    return [F.col(c).desc() for c in cols] + [F.col(c).asc() for c in ties]


def ordered_slices(df: DataFrame, keys: list[str], order: list[Column],
                   num_partitions: int | None = None) -> DataFrame:
    """Range-partition on (keys, order), sort inside each partition, and tag
    rows with ``_mid`` (partition index << 33 | position in sorted order) and
    ``_pid`` (the partition index).  A key's rows inside one partition form a
    contiguous *slice*; a hot key spans many slices.  Written to the shared
    scratch folder, so every consumer sees one assignment even if an executor
    is lost.  Unless ``num_partitions`` is given, adaptive execution merges
    ranges that turn out small, so a few rows do not become as many tasks as a
    large shuffle would have."""
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    ranged = (df.repartitionByRange(num_partitions, *sort_cols) if num_partitions
              else df.repartitionByRange(*sort_cols))
    return materialize(ranged.sortWithinPartitions(*sort_cols)
                       .withColumn("_mid", F.monotonically_increasing_id())
                       .withColumn("_pid", F.shiftright("_mid", 33)), "slices")


def row_number_within(df: DataFrame, keys: list[str], order: list[Column], name: str,
                      num_partitions: int | None = None, kind: str = "int") -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)`` that stays
    balanced when one key holds most rows.

    A window partitioned by a low-cardinality key (5 categories, one day)
    sends each key to one task.  Instead:

    1. range-partition on (keys, order): Spark samples the sort key, so a hot
       key is cut into many consecutive partitions, each sorted;
    2. ``monotonically_increasing_id`` after the in-partition sort encodes
       (partition index, position in sorted order); a key's rows inside one
       partition are contiguous, so position - first position of the key in
       that partition is its local rank;
    3. per (key, partition): first position and row count; a running sum of
       counts over partition index gives each slice's offset (at most
       partitions + keys rows, joined back by AQE's broadcast);
    4. rank = offset + local rank.

    All JVM-side.  ``order`` must be a total order (end with a unique column).  ``kind`` is the rank's type: ``long``
    where one key can hold more rows than an int counts.
    """
    numbered = ordered_slices(df, keys, order, num_partitions)
    stats = numbered.groupBy(*keys, "_pid").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_pid").alias("_opid"), "_first",
                         F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    cond = F.col("_pid") == F.col("_opid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    j = numbered.join(stats, cond, "inner")
    rank = F.col("_off") + (F.col("_mid") - F.col("_first")) + F.lit(1)
    return j.withColumn(name, rank.cast(kind)).drop(
        "_mid", "_pid", "_opid", "_first", "_off", *[f"_k_{k}" for k in keys])


def grouped_percentiles(df: DataFrame, keys: list[str], column: str, ps: dict[str, float],
                        buckets: int = BUCKETS, driver_bands: int = DRIVER_BANDS) -> DataFrame:
    """Exact percentiles per group: one row per group with a column per entry
    of ``ps`` (name -> p), in the column's type.

    With at most ``driver_bands`` bands (groups x percentiles; checked) the
    brackets are broadcast and each scan is partially aggregated, so rows
    are never exchanged on the group key, whatever share of them one group
    holds.  With more groups the brackets stay a table in the shared scratch
    folder, joined by key."""
    names = list(ps)
    values, integral = _values(df, keys, column)
    kind = df.schema[column].dataType
    stats = materialize(_brackets(values, keys, list(ps.values()), integral, GROUP_SKETCH), "brackets")
    found = _passes(values, keys, list(ps.values()), integral, buckets, stats, driver_bands)
    if found is not None:
        schema = T.StructType([*(T.StructField(k, df.schema[k].dataType) for k in keys),
                               *(T.StructField(n, kind) for n in names)])
        return df.sparkSession.createDataFrame([(*g, *v) for g, v in found.items()], schema)
    return _table_percentiles(values, keys, ps, integral, buckets, kind, stats)


def _table_percentiles(values: DataFrame, keys: list[str], ps: dict[str, float], integral: bool, buckets: int,
                       kind: T.DataType, stats: DataFrame) -> DataFrame:
    """The same search with the brackets as a table, for any number of groups."""
    names = list(ps)
    shares = F.array(*(F.lit(float(ps[n])) for n in names))
    open_ = materialize(stats.select(*keys, "n", "least", "most", F.posexplode(F.arrays_zip(shares.alias("p"), F.col("at").alias("b")))
                                     .alias("i", "w"))
                        .select(*keys, "i", F.greatest(F.lit(1), F.ceil(F.col("w.p") * F.col("n"))).cast("long").alias("k"),
                                F.col("w.b.lo").alias("lo"), F.col("w.b.hi").alias("hi"), "least", "most"), "brackets")
    named = lambda df: df.select(*(F.col(k).alias(f"_g_{k}") for k in keys), *(c for c in df.columns if c not in keys))
    done = []
    while not open_.isEmpty():
        # Sort-merge, so that neither side is built in memory.
        table = materialize(
            values.hint("merge").join(named(open_), _same(keys) & (F.col("_y") <= F.col("hi")))
            .groupBy(*keys, "i", F.when(F.col("_y") >= F.col("lo"), F.col("_x")).alias("x")).agg(F.count(F.lit(1)).alias("c")), "inside")
        seen = table.groupBy(*keys, "i").agg(F.sum(F.when(F.col("x").isNull(), F.col("c")).otherwise(0)).alias("below"),
                                             F.sum("c").alias("upto"), F.min("x").alias("mn"), F.max("x").alias("mx"))
        at = materialize(named(open_).withColumnRenamed("i", "_i").join(seen, _same(keys) & (F.col("i") == F.col("_i")), "left")
                         .select(*(F.col(f"_g_{k}").alias(k) for k in keys), F.col("_i").alias("i"), "k", "lo", "hi", "least", "most",
                                 F.coalesce("below", F.lit(0)).alias("below"), F.coalesce("upto", F.lit(0)).alias("upto"), "mn", "mx"),
                         "brackets")
        hit = (F.col("below") < F.col("k")) & (F.col("k") <= F.col("upto"))
        bands = materialize(at.filter(hit).select(*keys, "i", (F.col("k") - F.col("below")).alias("k"), F.col("mn").alias("lo"),
                                                  F.col("mx").alias("hi")), "bands")
        table = table.filter("x is not null").withColumnRenamed("i", "_i")
        while True:
            done.append(bands.filter("lo = hi"))
            bands = bands.filter("lo <> hi")
            if bands.isEmpty():
                break
            mine = _same(keys) & (F.col("i") == F.col("_i")) & (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))
            counts = (table.hint("merge").join(named(bands), mine)
                      .groupBy(*keys, "i", "k", _bucket(F.col("x"), F.col("lo"), F.col("hi"), buckets, integral).alias("b"))
                      .agg(F.sum("c").alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx")))
            before = Window.partitionBy(*keys, "i").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
            counts = counts.withColumn("seen", F.coalesce(F.sum("c").over(before), F.lit(0)))
            bands = materialize(
                counts.filter((F.col("seen") < F.col("k")) & (F.col("seen") + F.col("c") >= F.col("k")))
                .select(*keys, "i", (F.col("k") - F.col("seen")).alias("k"), F.col("mn").alias("lo"), F.col("mx").alias("hi")),
                "bands")
        low = F.col("k") <= F.col("below")      # a rank below its bracket, or above it
        open_ = materialize(at.filter(~hit).select(
            *keys, "i", "k", F.when(low, F.col("least")).otherwise(F.col("hi")).alias("lo"),
            F.when(low, F.col("lo")).otherwise(F.col("most")).alias("hi"), "least", "most"), "brackets")
    if not done:
        done = [open_.select(*keys, "i", F.lit(None).cast(kind).alias("lo"))]
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    return every.groupBy(*keys).agg(*(F.max(F.when(F.col("i") == i, F.col("lo"))).cast(kind).alias(n)
                                      for i, n in enumerate(names)))
