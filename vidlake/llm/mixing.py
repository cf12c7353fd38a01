"""Mixing sources to target weights by Pfair scheduling (operator 9).

Time runs in slots, each taken by one block of documents of one source.  A source with weight w (of a total of 1)
releases its block j at slot floor(j / w) with the deadline ceil((j + 1) / w); of the released blocks the one
with the earliest deadline takes the slot.  As the weights add up to 1, every deadline can be met, so after any
number of slots each source has had its target within less than one block.  Releases and deadlines come from
the weights themselves, unrounded, for any number of sources, however small their weights.

The schedule is made in segments of SEGMENT slots, each in one task, from the blocks that belong to it: before
slot T the sources up to the k-th (in a fixed order, with weights adding up to W) have had floor(T W) blocks, so
each source has had its target rounded up or down, all together T, and a block's segment follows from its number.
The bound of one block holds within a segment (a million blocks); at the border between two, where the counts
are set that way, a block may be up to one further block off, which does not add up over segments.

Every document is placed exactly once.  The guarantee holds until the first source runs out; its slots then
stay empty and the others keep their proportions.

Documents are numbered within their source by range partitioning on a hash of the row, so a source with most of
the rows is cut into many tasks, in one order at every size; the number tells the block, the block the slot.
Only single numbers reach the driver.

Defined cases: documents without a source form a source of their own.  Sources that the weights do not name
share the weight ``others`` equally.  Rows that repeat are placed each for itself, null ids like any other.
An empty table gives an empty result; all columns pass through, whatever their names (a column of the name of
``slot`` or ``place`` is replaced).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlake.llm.common import small_side, written
from vidlake.operators.ranking import row_number_within

SEGMENT = 1 << 20
BLOCK = 16
# Sources, and blocks with their slots, that are sent to every worker at most; beyond, they are joined.
BROADCAST_SOURCES, BROADCAST_BLOCKS = 100_000, 1_000_000


def earliest_deadline_first(weight: np.ndarray, first: np.ndarray, last: np.ndarray, start: int, end: int) -> list[np.ndarray]:
    """Slots of the blocks first..last-1 of every source from ``start`` to ``end``: in each slot, of the released blocks
    the one with the earliest deadline.  A slot stays empty only while the remaining ones are enough for all."""
    left = int((last - first).sum())
    slots = [np.empty(int(b - a), np.int64) for a, b in zip(first, last)]
    # (release, deadline, source, block); small allowances keep quotients that are whole from being rounded away
    coming = [(max(start, math.floor(a / w + 1e-9)), k, int(a)) for k, (w, a, b) in enumerate(zip(weight, first, last)) if a < b]
    heapq.heapify(coming)
    ready: list[tuple[int, int, int]] = []
    t = start
    while coming or ready:
        if not ready:
            t = max(t, min(coming[0][0], end - left))
        while coming and (coming[0][0] <= t or not ready):
            _, k, j = heapq.heappop(coming)
            heapq.heappush(ready, (math.ceil((j + 1) / weight[k] - 1e-9), k, j))
        _, k, j = heapq.heappop(ready)
        slots[k][j - int(first[k])] = t
        if j + 1 < last[k]:
            heapq.heappush(coming, (max(t + 1, math.floor((j + 1) / weight[k] + 1e-9)), k, j + 1))
        t, left = t + 1, left - 1
    return slots


def _segment_slots(segment: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        m = int(rows["segment"].iloc[0])
        slots = earliest_deadline_first(rows["weight"].to_numpy(float), rows["first"].to_numpy(), rows["last"].to_numpy(),
                                        m * segment, (m + 1) * segment)
        return pd.DataFrame({"of": rows["of"], "segment": rows["segment"], "first": rows["first"], "slots": slots})
    return run


def sources(docs: DataFrame, weights: Mapping[str | None, float] | float, others: float = 0.01) -> DataFrame:
    """of (the source), n (documents), weight (its share), below and upto (shares added up before and with it)."""
    sizes = written(docs.groupBy(F.col("source").alias("of")).agg(F.count(F.lit(1)).alias("n")), "mixing_sizes")
    if isinstance(weights, (int, float)):
        raw = sizes.withColumn("raw", F.pow(F.col("n").cast("double"), F.lit(float(weights))))
    else:
        given = [(k, float(v)) for k, v in weights.items() if v]
        named = docs.sparkSession.createDataFrame(given, "name string, given double")      # as many as the caller names
        raw = sizes.join(F.broadcast(named), F.col("of").eqNullSafe(F.col("name")), "left").drop("name")
        unnamed = raw.filter("given is null").count()
        rest = others * (sum(w for _, w in given) or 1.0) / max(unnamed, 1)
        raw = raw.select("of", "n", F.coalesce("given", F.lit(rest)).alias("raw"))
    # Shares are added up within groups of sources, then over the groups.
    raw = written(raw.withColumn("grp", F.pmod(F.xxhash64("of"), F.lit(256))), "mixing_raw")
    groups = raw.groupBy("grp").agg(F.sum("raw").alias("sum"))
    groups = groups.withColumn("upto", F.sum("sum").over(Window.orderBy("grp")))               # at most 256 rows
    total = groups.agg(F.max("upto")).first()[0] or 1.0
    inside = Window.partitionBy("grp").orderBy(F.col("of").asc_nulls_first())
    return written(
        raw.withColumn("inside", F.sum("raw").over(inside))
        .join(F.broadcast(groups.select("grp", (F.col("upto") - F.col("sum")).alias("before"))), "grp")
        .select("of", "n", (F.col("raw") / total).alias("weight"), F.lag("inside", 1, 0.0).over(inside).alias("under"), "inside", "before")
        .select("of", "n", "weight", ((F.col("before") + F.col("under")) / total).alias("below"),
                ((F.col("before") + F.col("inside")) / total).alias("upto")), "mixing_sources")


def mix(docs: DataFrame, weights: Mapping[str | None, float] | float = 0.5, block: int = BLOCK, others: float = 0.01,
        slot: str = "slot", place: str = "place", segment: int = SEGMENT) -> DataFrame:
    """``docs`` with the slot of each document's block and its place there.  ``weights`` are target weights by
    source, or the power of the sources' sizes to take as weights."""
    names = [c for c in docs.columns if c not in (slot, place)]
    known = sources(docs, weights, others)
    # The rows as one value, so that no helper's name meets one of theirs.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("source").alias("of"),
                       F.xxhash64("doc_id").alias("h1"), F.xxhash64(*docs.columns).alias("h2"),
                       F.monotonically_increasing_id().alias("h3"))
    ranked = row_number_within(rows, ["of"], [F.col("h1"), F.col("h2"), F.col("h3")], "number", kind="long")
    ranked = ranked.select("row", "of", (F.col("number") - 1).alias("number"))
    had = lambda m: F.floor(m * segment * F.col("upto") + 1e-9) - F.floor(m * segment * F.col("below") + 1e-9)
    j = F.floor(F.col("number") / block)
    side = known.select(F.col("of").alias("_of"), "weight", "below", "upto")
    near = F.floor(j / (F.col("weight") * segment))
    # The segment whose first blocks are j's: the one that the weight gives, or its neighbour.
    at = ranked.join(small_side(side, BROADCAST_SOURCES), F.col("of").eqNullSafe(F.col("_of"))).withColumns({"j": j, "near": near})
    at = at.withColumn("segment", F.greatest(F.when(F.col("j") < had(F.col("near")), F.col("near") - 1)
                                             .when(F.col("j") >= had(F.col("near") + 1), F.col("near") + 1)
                                             .otherwise(F.col("near")), F.lit(0)).cast("long"))
    at = at.select("row", "of", "number", "j", "segment", "weight")
    blocks = at.groupBy("of", "segment", "weight").agg(F.min("j").alias("first"), (F.max("j") + 1).alias("last"))
    schema = "of string, segment long, first long, slots array<long>"
    made = written(blocks.groupBy("segment").applyInPandas(_segment_slots(segment), schema), "mixing_slots")
    taken = made.agg(F.coalesce(F.sum(F.size("slots")), F.lit(0))).first()[0]
    made = made.select(F.col("of").alias("_of"), F.col("segment").alias("_segment"), F.col("first").alias("from"), "slots")
    placed = at.join(F.broadcast(made) if taken <= BROADCAST_BLOCKS else made,
                     F.col("of").eqNullSafe(F.col("_of")) & (F.col("segment") == F.col("_segment")))
    return placed.select(
        *(F.col("row").getField(c).alias(c) for c in names),
        F.get("slots", (F.col("j") - F.col("from")).cast("int")).alias(slot), (F.col("number") % block).cast("long").alias(place))


def in_order(mixed: DataFrame, slot: str = "slot", place: str = "place") -> DataFrame:
    """Rows in the order of the mixture: ranges of slots over partitions, sorted inside."""
    return mixed.repartitionByRange(slot, place).sortWithinPartitions(slot, place)
