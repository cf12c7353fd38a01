"""Quality classifier: histogram gradient-boosted trees over document statistics (operator 3).

Statistics of every whole text are computed once, vectorised over chunks of documents, into a narrow table.
The trees are grown with numpy on a sample of labelled rows whose size is bounded by ``sample_rows`` (a
parameter, 50,000 unless given): features are cut into at most 64 bins at sample quantiles, gradients and
Hessians of the logistic loss are summed per node and bin, and the best cut of every node is taken level by
level.  A trained model is three flat arrays (feature, cut, leaf) of complete trees, walked for all rows at
once: at every level the node index becomes 2i + 1 or 2i + 2.

Defined cases: a null text is the empty text, whose statistics are all 0; it gets a score like any other.
Labels that are null or of unknown documents teach nothing; without usable labels every score is 0.5.  A
document labelled several times counts each time; rows that repeat are scored each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.llm.common import written
from vidlake.llm.textscan import _GRAM_CODE, chunks, slices, words_of

FEATURES = (
    "log_bytes", "log_words", "mean_word", "sd_word", "longest_word", "distinct_words", "top_word", "word_repeats_last",
    "symbols_per_word", "bars_per_word", "marks_per_word", "stops_per_word", "commas_per_word", "upper_share",
    "digit_share", "non_ascii_share", "blank_share", "log_lines", "words_per_line", "repeated_lines",
    "capital_words", "short_words",
)
BINS = 64


def _byte_class(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_CLASSES = (_byte_class(b"#*$%&<>@~^_={}[]\\"), _byte_class(b"|"), _byte_class(b"!?"), _byte_class(b"."),
            _byte_class(b",;:"), _byte_class(bytes(range(65, 91))), _byte_class(bytes(range(48, 58))),
            _byte_class(bytes(range(128, 256))), _byte_class(b" \t\n\x0b\x0c\r"), _byte_class(b"\n"))


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(total[offsets]).astype(float)


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, count of the most frequent) of ``h`` per document."""
    bits = np.uint64(max(1, int(n).bit_length()))
    keys = np.sort((doc.astype(np.uint64) << (np.uint64(64) - bits)) | (h >> bits))
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    of = (keys[at] >> (np.uint64(64) - bits)).astype(int)
    top = np.zeros(n)
    np.maximum.at(top, of, np.diff(np.append(at, len(keys))).astype(float))
    return np.bincount(of, minlength=n).astype(float), top


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """FEATURES of a chunk of documents, one row each."""
    n = len(offsets) - 1
    w = words_of(data, offsets, lower=False)
    h, doc, size = w.hashes(), w.doc, (w.ends - w.starts).astype(float)
    count = np.diff(w.first).astype(float)
    some = np.maximum(count, 1)
    length = np.diff(offsets).astype(float)
    mass = np.maximum(length, 1)
    symbols, bars, marks, stops, commas, upper, digits, other, blanks, breaks = (
        _per_doc(c[data], offsets) for c in _CLASSES)
    total = np.bincount(doc, size, n)
    mean = total / some
    deviation = np.sqrt(np.maximum(np.bincount(doc, size * size, n) / some - mean * mean, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, doc, size)
    distinct, top = _distinct(doc, h, n)
    again = np.zeros(n)
    if len(h) > 1:
        again = np.bincount(doc[1:], (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]), n)
    # Lines with words: a line's hash is the sum of its words' hashes, each with a code of its place.
    line = np.searchsorted(np.flatnonzero(data == 10), w.starts)
    lines, repeated = np.zeros(n), np.zeros(n)
    if len(h):
        at = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])]))
        place = np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))
        line_hash = np.add.reduceat(h * _GRAM_CODE[place % 61], at)
        lines = np.bincount(doc[at], minlength=n).astype(float)
        repeated = lines - _distinct(doc[at], line_hash, n)[0]
    capital = np.bincount(doc, (w.text[w.starts] >= 65) & (w.text[w.starts] <= 90), n) if len(h) else np.zeros(n)
    short = np.bincount(doc, size <= 3, n)
    return np.column_stack([
        np.log1p(length), np.log1p(count), mean, deviation, longest, distinct / some, top / some, again / some,
        symbols / some, bars / some, marks / some, stops / some, commas / some, upper / mass, digits / mass,
        other / mass, blanks / mass, np.log1p(lines), count / np.maximum(lines, 1), repeated / np.maximum(lines, 1),
        capital / some, short / some])


def statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``stats``, the array of FEATURES of the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [statistics_of(data, offsets) for _, _, data, offsets in chunks(batch.column("_text"))]
            flat = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
            stats = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * len(FEATURES), pa.int32()),
                                             pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [stats], [*keep, "stats"])

    source = docs.select(*keep, F.col("text").alias("_text"))
    return source.mapInArrow(run, T.StructType([*source.select(*keep).schema.fields,
                                                T.StructField("stats", T.ArrayType(T.DoubleType()))]))


@dataclass
class Trees:
    """Complete binary trees: inner nodes (feature, cut) and leaves, one row per tree."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            margin += leaf[node - inner]
        return 1 / (1 + np.exp(-margin))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, ridge: float = 1.0,
         least_weight: float = 2.0) -> Trees:
    """Boosted trees for 0/1 labels ``y``."""
    n, width = x.shape
    inner = 2**depth - 1
    prior = (y.sum() + 1) / (n + 2)
    start = float(np.log(prior / (1 - prior)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.column_stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)]).astype(np.int64)
    out = Trees(start, np.zeros((trees, inner), np.int32), np.full((trees, inner), np.inf),
                np.zeros((trees, inner + 1)))
    margin = np.full(n, start)
    rows = np.arange(n)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            best = np.full(nodes, 1e-6)
            local = (node - first) * BINS
            gt, ht = np.bincount(node - first, g, nodes), np.bincount(node - first, h, nodes)
            whole = gt * gt / (ht + ridge)
            for f in range(width):
                if not len(cuts[f]):
                    continue
                key = local + binned[:, f]
                gl = np.bincount(key, g, nodes * BINS).reshape(nodes, BINS).cumsum(1)[:, :len(cuts[f])]
                hl = np.bincount(key, h, nodes * BINS).reshape(nodes, BINS).cumsum(1)[:, :len(cuts[f])]
                gr, hr = gt[:, None] - gl, ht[:, None] - hl
                gain = gl * gl / (hl + ridge) + gr * gr / (hr + ridge) - whole[:, None]
                gain[(hl < least_weight) | (hr < least_weight)] = 0
                at = gain.argmax(1)
                better = gain[np.arange(nodes), at] > best
                best[better] = gain[np.arange(nodes), at][better]
                out.feature[t, first:first + nodes][better] = f
                out.cut[t, first:first + nodes][better] = cuts[f][at[better]]
            node = 2 * node + 1 + (x[rows, out.feature[t][node]] > out.cut[t][node])
        where = node - inner
        value = -rate * np.bincount(where, g, inner + 1) / (np.bincount(where, h, inner + 1) + ridge)
        out.leaf[t] = value
        margin += value[where]
    return out


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 50_000) -> Trees | None:
    """A model from rows (doc_id, stats) and 0/1 labels; None if there are none.  Beyond ``sample_rows`` labelled
    rows, a share of them chosen by a hash of the id is used, so that about that many remain."""
    known = (labels.select("doc_id", F.col(label).cast("double").alias("y")).filter("y in (0, 1)")
             .join(stats.select("doc_id", "stats"), "doc_id"))
    n = known.count()
    if not n:
        return None
    if n > sample_rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(sample_rows / n * (1 << 20)))
    rows = known.orderBy("doc_id").select("stats", "y").toArrow()
    x = np.array(rows.column("stats").combine_chunks().flatten()).reshape(-1, len(FEATURES))
    return grow(x, np.array(rows.column("y")))


def score(stats: DataFrame, model: Trees | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``score``, the probability of label 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array(batch.column("stats").flatten()).reshape(-1, len(FEATURES))
            s = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(s)], [*keep, "score"])

    return stats.select(*keep, "stats").mapInArrow(
        run, T.StructType([*stats.select(*keep).schema.fields, T.StructField("score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, learns: Column, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Score every row of ``docs``; labels are used only of documents where ``learns`` holds."""
    stats = written(statistics(docs, keep), "quality_stats")
    model = train(stats.filter(learns), labels)
    return score(stats, model, keep)
