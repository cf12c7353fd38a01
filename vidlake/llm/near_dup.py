"""Near-duplicate documents by SetSketch registers (operator 8).

A document is the set of its distinct word shingles.  Its sketch has M registers: register i is the minimum of
an exponential hash over the set, spaced exponentially and truncated to 16 bits, floor(1 - log_B min) within
0..Q+1.  Sketches of two sets merge into the sketch of their union by the greater register, and registers of
similar sets tend to be equal, so bands of ROWS registers serve as bucket keys: at a similarity of 0.8 a pair
shares none of the M / ROWS bands with a probability below 1e-7.

Documents with equal sets form one class; only classes are compared.  In every bucket the classes of a round
are compared with one centre, not with each other: first with the class that meets most others in its buckets
(the original of a group of copies), then with others by a hash.  Those joined already fall together, and the
next round takes up buckets that still hold more than one component.  Classes that are still apart in a bucket
after STAR_ROUNDS share registers without being similar, as texts with a long common passage do; pairs among
them are found exactly by their rarest shingles: sets of n <= m shingles whose similarity reaches t share at least
t (n + m) / (1 + t), which is 2 t n / (1 + t) at least, and t m at least.  So in ascending order of frequency the
first one they share is among the first n - 2 t n / (1 + t) + 1 of the smaller set (11 % of it at 0.8) and the
first m - t m + 1 of the larger (20 %), and has as many as they must share from its place on in each.  Texts with
a passage of 80 to 89 % in common therefore probe for it, but do not offer it, and meet no one.  A candidate pair is first judged from the sketches: the joint likelihood of
the numbers of greater, equal and lesser registers, given both cardinalities, rules out pairs for which a
similarity at the threshold is out of reach; the others are confirmed on their full sets.  Links are joined to
components by random contraction; those of a later round are contracted between the components of the earlier ones.

A class is named by the 128-bit hash of its set, so it needs no doc_id; a component takes the least doc_id of all
its rows at the end.

Defined cases: null texts and texts without words have an empty set and are linked with nothing.  Rows that
repeat a doc_id are one document, linked wherever any of its texts is; a row without doc_id is linked like
any other, bridges others, and shares their component's least doc_id (null if no row of it has one); it is never
``kept``.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.llm.common import at_most, fresh, small_side, written
from vidlake.llm.components import components
from vidlake.llm.textscan import chunks, mix64, shingles, slices, words_of

M, ROWS = 128, 4
B, RATE, Q = 1.001, 20.0, 2**16 - 2
STAR_ROUNDS = 1
# A pair is ruled out by its sketches only if its likelihood ratio against the threshold exceeds this
# (twice the log; 36 is six standard deviations).
RULED_OUT = 36.0
# Allowance for rounding where a similarity or a size stands exactly at the threshold.
ROUNDING = 1e-9
# Ids that are sent to every worker at most when texts of candidates are read again; beyond, they are joined.
BROADCAST_IDS = 500_000
# Candidate pairs, with the sketch of one side, that are sent to every worker at most; beyond, they are joined.
BROADCAST_PAIRS = 100_000

_seeds = np.random.default_rng(808)
_MULTIPLY = _seeds.integers(0, 2**31, M, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _seeds.integers(0, 2**32, M, dtype=np.uint32)


def registers(minima: np.ndarray) -> np.ndarray:
    """Registers for the least 32-bit hash per permutation: -log(1 - u) is the least exponential value."""
    least = -np.log1p(-(minima.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(least) / np.log(B)), 0, Q + 1).astype(np.uint16)


def sketch(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers (sets x M) of consecutive runs of element hashes; an empty run has registers 0."""
    filled = np.flatnonzero(np.diff(first) > 0)
    out = np.zeros((len(first) - 1, M), np.uint16)
    if len(filled):
        h = (hashes >> np.uint64(32)).astype(np.uint32)
        at = first[filled]
        minima = np.empty((len(filled), M), np.uint32)
        for i in range(M):
            minima[:, i] = np.minimum.reduceat(h * _MULTIPLY[i] + _ADD[i], at)
        out[filled] = registers(minima)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def set_hash(elements: np.ndarray) -> bytes | None:
    """128 bits that name a set of element hashes, None for the empty set."""
    if not len(elements):
        return None
    return b"".join(mix64(x).sum(dtype=np.uint64).tobytes() for x in (elements, elements ^ np.uint64(0x9E3779B97F4A7C15)))


def _sets(column: pa.Array, k: int):
    """Per chunk of documents lo..hi: for each its sorted distinct shingle hashes, and all shingles with their
    bounds."""
    for lo, hi, data, offsets in chunks(column):
        h, first = shingles(words_of(data, offsets), k)
        yield lo, hi, [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:])], h, first


def sketches(docs: DataFrame, k: int = 4) -> DataFrame:
    """doc_id, n_shingles, set (its 128-bit hash, null for the empty set) and sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for lo, hi, sets, h, first in _sets(batch.column("text"), k):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_hash(s) for s in sets], pa.binary()),
                     pa.array([r.tobytes() for r in sketch(h, first)], pa.binary())],
                    ["doc_id", "n_shingles", "set", "sketch"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("set", T.BinaryType()),
                           T.StructField("sketch", T.BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def likely_jaccard(n_a: np.ndarray, n_b: np.ndarray, more: np.ndarray, less: np.ndarray, threshold: float,
                   steps: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """(most likely similarity, twice the log-likelihood ratio of it against the best one at or above the
    threshold) from the numbers of registers in which a exceeds b (``more``) and falls short of it (``less``)."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    top = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    # The threshold itself (or what the sizes allow, if that is all but the threshold) is always judged.
    grid = np.column_stack([np.linspace(0, 1, steps + 1)[None, :] * top[:, None], np.minimum(top, threshold)])
    # Probability that a register of one set exceeds that of the other, for x the share of the former's own elements.
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)
    up, down = p(u[:, None] - v[:, None] * grid), p(v[:, None] - u[:, None] * grid)
    tiny = 1e-12
    ll = (more[:, None] * np.log(np.maximum(up, tiny)) + less[:, None] * np.log(np.maximum(down, tiny))
          + (M - more - less)[:, None] * np.log(np.maximum(1 - up - down, tiny)))
    best = ll.argmax(1)
    above = np.where(grid >= threshold - ROUNDING, ll, -np.inf).max(1)
    return grid[np.arange(len(best)), best], 2 * (ll.max(1) - above)


def _plausible(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            if not len(p):
                continue
            a = np.frombuffer(b"".join(p["sketch_a"]), np.uint16).reshape(-1, M)
            b = np.frombuffer(b"".join(p["sketch_b"]), np.uint16).reshape(-1, M)
            est, against = likely_jaccard(p["n_a"].to_numpy(float), p["n_b"].to_numpy(float), (a > b).sum(1).astype(float),
                                          (a < b).sum(1).astype(float), threshold)
            yield p.loc[(est >= threshold - ROUNDING) | (against <= RULED_OUT), ["a", "b"]]
    return run


class NearDuplicates:
    """Links between the classes of equal sets of ``docs`` (doc_id, text)."""

    def __init__(self, docs: DataFrame, k: int = 4, threshold: float = 0.8) -> None:
        self.docs, self.k, self.threshold = docs, k, threshold
        self.rows = written(sketches(docs, k), "nd_sketches")
        filled = self.rows.filter("set is not null")
        # One class per set; ``doc_id`` is one of its documents, where it has any.
        self.members = written(filled.groupBy(F.col("set").alias("class")).agg(F.min("doc_id").alias("doc_id")), "nd_members")
        self.classes = written(filled.groupBy(F.col("set").alias("class")).agg(
            F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "nd_classes")
        width = 2 * ROWS
        keys = F.transform(F.sequence(F.lit(0), F.lit(M // ROWS - 1)),
                           lambda i: F.xxhash64(i, F.substring(F.col("sketch"), i * width + 1, F.lit(width))))
        banded = self.classes.select("class", F.explode(keys).alias("bucket"))
        shared = (banded.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi"),
                                               F.count(F.lit(1)).alias("size"))
                  .filter("lo <> hi").select("bucket", "size"))
        met = written(banded.join(shared, "bucket").distinct(), "nd_met")
        mates = met.groupBy("class").agg(F.sum("size").alias("mates"))
        self.buckets = written(met.select("bucket", "class").join(mates, "class"), "nd_buckets")
        self.tested: list[DataFrame] = []
        self.levels: list[DataFrame] = []

    def settled(self, rows: DataFrame, column: str) -> DataFrame:
        """``rows`` with the class in ``column`` replaced by its component under all links so far."""
        for level in self.levels:
            to = fresh(rows.columns, "to")
            rows = (rows.join(level.select(F.col("node").alias(column), F.col("component").alias(to)), column, "left")
                    .withColumn(column, F.coalesce(to, column)).drop(to))
        return rows

    def link(self, links: DataFrame) -> None:
        """Join the components of the classes a and b of each link."""
        level = written(components(self.settled(self.settled(links, "a"), "b")), "nd_level")
        self.levels.append(small_side(level, BROADCAST_IDS))

    def _judged(self, pairs: DataFrame, name: str) -> None:
        """Test candidate pairs (a < b) not tested before; join the components of those that are links."""
        for old in self.tested:
            pairs = pairs.join(old, ["a", "b"], "left_anti")
        pairs = written(pairs, f"nd_pairs_{name}")
        self.tested.append(pairs)
        if pairs.isEmpty():
            return
        side = lambda c: self.classes.select(F.col("class").alias(c), F.col("n").alias(f"n_{c}"),
                                             F.col("sketch").alias(f"sketch_{c}"))
        kind = self.classes.schema["class"].dataType
        hint = F.broadcast if at_most(pairs, BROADCAST_PAIRS) else lambda df: df
        likely = written(
            side("b").join(hint(side("a").join(hint(pairs), "a")), "b")
            .filter(F.least("n_a", "n_b") >= self.threshold * F.greatest("n_a", "n_b") - ROUNDING)
            .mapInPandas(_plausible(self.threshold), T.StructType([T.StructField("a", kind), T.StructField("b", kind)])),
            f"nd_likely_{name}")
        self.link(written(self._confirmed(likely), f"nd_links_{name}"))

    def _elements(self, classes: DataFrame) -> DataFrame:
        """(class, elements) of the given classes: their full sets, from the text of one of their documents.  For
        classes without any doc_id, all rows without doc_id are read."""
        wanted = small_side(written(classes.select("class").distinct(), "nd_ids"), BROADCAST_IDS)
        ids = written(self.members.join(wanted, "class").select("doc_id").distinct(), "nd_ids")
        docs = self.docs.select("doc_id", "text")
        chosen = docs.join(small_side(ids, BROADCAST_IDS), "doc_id", "left_semi")
        if not ids.filter("doc_id is null").isEmpty():
            chosen = chosen.unionByName(docs.filter("doc_id is null"))
        k = self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                for _, _, sets, _, _ in _sets(batch.column("text"), k):
                    bounds = np.cumsum([0, *map(len, sets)])
                    values = np.concatenate(sets).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([set_hash(s) for s in sets], pa.binary()),
                         pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))], ["class", "elements"])

        # An id may have several texts, and rows without id many copies.
        return chosen.mapInArrow(run, "class binary, elements array<long>").join(wanted, "class", "left_semi").dropDuplicates(["class"])

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets reach the threshold."""
        ids = pairs.select(F.col("a").alias("class")).union(pairs.select("b"))
        sets = written(self._elements(ids), "nd_sets")
        both = (sets.withColumnsRenamed({"class": "a", "elements": "x"}).join(small_side(pairs, BROADCAST_PAIRS), "a")
                .join(sets.withColumnsRenamed({"class": "b", "elements": "y"}), "b"))
        shared = F.size(F.array_intersect("x", "y"))
        percent = round(100 * self.threshold)
        return both.filter(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b")

    def _rare_shingles(self, left: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What the classes in ``left`` offer as the smaller of a pair, and what they probe for as the larger: rows
        (e, class, n, comp, place).  Shingles of one set only cannot be shared but count for its first ones."""
        t = self.threshold
        ids = left.select("class", "comp").distinct()
        sets = self._elements(ids).withColumn("n", F.size("elements")).filter("n > 0")
        held = written(sets.select("class", "n", F.explode("elements").alias("e")), "nd_held")
        often = held.groupBy("e").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
        common = held.join(often, "e")
        place = F.row_number().over(Window.partitionBy("class", "n").orderBy("df", "e"))
        several = F.count(F.lit(1)).over(Window.partitionBy("class", "n"))
        longest = F.col("n") - F.ceil(t * F.col("n") - ROUNDING) + 1
        probes = written(common.withColumn("place", place + F.col("n") - several).filter(F.col("place") <= longest)
                         .join(ids, "class").select("e", "class", "n", "comp", "place"), "nd_probes")
        # What a set offers as the smaller of a pair (of equal sizes, the one with the lesser name).
        shortest = F.col("n") - F.ceil(2 * t / (1 + t) * F.col("n") - ROUNDING) + 1
        return probes.filter(F.col("place") <= shortest), probes

    def _rare_pairs(self, left: DataFrame) -> DataFrame:
        """Pairs (a < b) of different components among the classes in ``left`` that may reach the threshold,
        found by shared rare shingles."""
        t = self.threshold
        offered, probes = self._rare_shingles(left)
        other = probes.withColumnsRenamed({"class": "b", "n": "n_b", "comp": "comp_b", "place": "place_b"})
        room = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b")) + 1
        smaller = (F.col("n") < F.col("n_b")) | ((F.col("n") == F.col("n_b")) & (F.col("a") < F.col("b")))
        return (offered.withColumnRenamed("class", "a").join(other, "e")
                .filter(smaller & (F.col("comp") != F.col("comp_b")) & (F.col("n") >= t * F.col("n_b") - ROUNDING)
                        & (room >= F.ceil(t / (1 + t) * (F.col("n") + F.col("n_b")) - ROUNDING)))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    def _unsettled(self) -> DataFrame:
        """(bucket, class, mates, comp) of the buckets that hold more than one component."""
        rows = self.settled(self.buckets.withColumn("comp", F.col("class")), "comp")
        if not self.levels:  # every bucket kept holds several classes
            return rows
        mixed = (rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .filter("lo <> hi").select("bucket"))
        return written(rows.join(mixed, "bucket"), "nd_unsettled")

    def run(self) -> None:
        """Find links between classes, enough to join every component."""
        for r in range(STAR_ROUNDS):
            left = self._unsettled()
            if left.isEmpty():
                return
            wish = F.struct(F.lit(0) if r else F.col("mates"), F.xxhash64("class", F.lit(r)))
            centres = (left.groupBy("bucket").agg(F.max_by(F.struct("class", "comp"), wish).alias("c"))
                       .select("bucket", F.col("c.class").alias("centre"), F.col("c.comp").alias("centre_comp")))
            pairs = (left.join(centres, "bucket").filter("comp <> centre_comp")
                     .select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct())
            self._judged(pairs, f"star{r}")
        left = self._unsettled()
        if not left.isEmpty():
            self._judged(self._rare_pairs(left), "rare")


def near_duplicates(docs: DataFrame, k: int = 4, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, set, component_id, kept per row of ``docs``."""
    found = NearDuplicates(docs, k, threshold)
    named = found.rows.filter("set is not null and doc_id is not null")
    # An id with several texts joins the classes it is in.
    several = named.groupBy("doc_id").agg(F.min("set").alias("lo"), F.max("set").alias("hi")).filter("lo <> hi")
    joined = written(named.join(several, "doc_id").select(F.col("lo").alias("a"), F.col("set").alias("b")), "nd_joined")
    found.run()
    if not joined.isEmpty():
        found.link(joined)
    members = written(found.settled(found.members.withColumn("component", F.col("class")), "component"), "nd_components")
    least = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    classes = written(members.join(least, "component").select(F.col("class").alias("set"), "component_id"), "nd_components")
    rows = found.rows.join(small_side(classes, BROADCAST_IDS), "set", "left")
    own = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", "set", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
