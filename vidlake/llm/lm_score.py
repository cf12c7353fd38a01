"""Language-model scoring with a log-frequency Bloom filter (operator 10).

Tokens are the A-Z-lower-cased words of a text and one end.  Counts of words and of pairs of neighbouring
tokens are quantised on a log scale, level(c) = 1 + floor(log_BASE c), and an n-gram is entered in the filter
once per level from 1 to its own; its level is found again by probing 1, 2, 4, ... until one is missing and
halving the gap.  The filter is made of segments, one per range of n-gram
hashes; a segment is counted and built in one task from packed sorted hashes, so no task sees more than its
range.  A filter of at most ``max_bytes`` is broadcast.  A larger one stays a table: the distinct n-grams of each
chunk of texts go to their segments by a shuffle, are probed there, and their levels go back to the chunk, so all
n-grams count at every size and the scores are the same both ways.

The probability of a token w after v interpolates the pair with the token alone, PAIRS (low(vw) - DISCOUNT) /
high(v) + (1 - PAIRS) p(w) with p(w) = (mean(w) + 1) / (N + V + 1), and is p(w) after an unknown v.  low and high
are the least and greatest count of a level, mean that of the words on the level, so that the means of all
words add up to N.  Hence the p(w) of all words and one unknown add up to 1, and the pairs of v to PAIRS at most:
no context has more than 1.  (The filter finds a missing n-gram by mistake once in 2^ERROR_BITS probes; the
discount leaves more than these add for any vocabulary that a test can sum over.)  All n-grams count, those seen
once too.  The exact base score needs exact counts of all words: the most frequent words (a bounded number) are sent along with the filter,
rarer words are joined with their counts.

Defined cases: a null text is empty: one end.  Nothing to learn from gives N = V = 0 and probability 1 for
every token.  Rows that repeat are learned and scored each for itself; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.llm.common import written
from vidlake.llm.textscan import Words, chunks, mix64, slices, words_of

BASE = 2.0
PAIRS = 0.3                   # weight of the pair in a token's probability
DISCOUNT = 0.5                # taken from every pair's count
ERROR_BITS = 17               # a missing n-gram is found by mistake once in 2^17 probes
BITS_PER_ENTRY = ERROR_BITS / np.log(2)
MAX_BYTES = 256 << 20         # of a filter that is broadcast
HOT_WORDS = 250_000           # words whose exact counts are broadcast
SEGMENT_TOKENS = 2 << 20      # training tokens per segment of the filter

LEVELS = 64                   # levels of 64-bit counts

END = np.uint64(0x243F6A8885A308D3)
START = np.uint64(0x13198A2E03707344)
_FIRST, _SECOND, _LEVEL = (np.uint64(x) for x in (0xA4093822299F31D1, 0x082EFA98EC4E6C89, 0x9E3779B97F4A7C15))


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(v * _FIRST + w * _SECOND)


def tokens_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of a chunk's tokens, first token of each document): words, then an end each."""
    n = len(words.first) - 1
    h = np.insert(words.hashes(), words.first[1:], END) if n else np.zeros(0, np.uint64)
    return h, words.first + np.arange(n + 1)


def pairs_of(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it (START before a document's first)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = START
    return pair_hash(before, tokens)


def _counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.sort(h)
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
    return h[at], np.diff(np.append(at, len(h)))


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def bounds_of(levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest count of a level; 0 for level 0."""
    low, high = np.ceil(BASE ** (levels - 1.0) - 1e-9), np.ceil(BASE ** levels - 1e-9) - 1
    return np.where(levels > 0, low, 0.0), np.where(levels > 0, np.maximum(high, low), 0.0)


# ---- counting -------------------------------------------------------------------------------------------

def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) per chunk of documents, and a null word for the number of documents."""
    for batch in slices(batches):
        for lo, hi, data, offsets in chunks(batch.column("text")):
            w = words_of(data, offsets)
            h, at, n = np.unique(w.hashes(), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*w.strings(at), None], pa.string()), pa.array([*n.tolist(), hi - lo], pa.int64())], ["word", "n"])


WORD, PAIR = 0, 1


def _segment_rows(segments: int):
    """(kind, segment, once, often, counts): n-gram hashes of a few chunks, summed up, sorted and packed by
    segment; those of single occurrences (``once``) need no counts."""
    def packed(kind: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h, c = _summed([p[0] for p in held], [p[1] for p in held])
        c = np.minimum(c, 2**32 - 1).astype(np.uint32)
        cut = np.searchsorted(_segment(h, segments), np.arange(segments + 1))
        rows = []
        for s in np.flatnonzero(np.diff(cut)).tolist():
            hs, cs = h[cut[s]:cut[s + 1]], c[cut[s]:cut[s + 1]]
            rows.append((s, hs[cs == 1].tobytes(), hs[cs > 1].tobytes(), cs[cs > 1].tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()),
             *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3))],
            ["kind", "segment", "once", "often", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {WORD: [], PAIR: []}
        for batch in slices(batches):
            for _, _, data, offsets in chunks(batch.column("text")):
                t, first = tokens_of(words_of(data, offsets))
                for kind, h in ((WORD, t), (PAIR, pairs_of(t, first))):
                    held[kind].append(_counted(h))
                    if sum(len(p[0]) for p in held[kind]) > 1_000_000:
                        yield packed(kind, held[kind])
                        held[kind] = []
        for kind, parts in held.items():
            if parts:
                yield packed(kind, parts)
    return run


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, with the sums of their counts."""
    h = np.concatenate([*hashes, np.zeros(0, np.uint64)])
    c = np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64)
    if not len(h):
        return h, c
    order = np.argsort(h)
    h, c = h[order], c[order]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[at], np.add.reduceat(c, at)


def _segment(h: np.ndarray, segments: int) -> np.ndarray:
    """Segment of a hash: equal ranges of its upper 32 bits, so sorted hashes have sorted segments."""
    return ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


# ---- the filter -----------------------------------------------------------------------------------------

@dataclass
class LogBloom:
    """Segmented Bloom filter over (n-gram, level)."""

    words: np.ndarray        # uint64 words of all segments
    begin: np.ndarray        # first word of each segment; one more entry than segments

    def _has(self, h: np.ndarray, lev) -> np.ndarray:
        seg = _segment(h, len(self.begin) - 1)
        bits = ((self.begin[seg + 1] - self.begin[seg]) * 64).astype(np.uint64)
        alive = np.flatnonzero(bits > 0)
        base = (self.begin[seg] * 64).astype(np.uint64)
        a, b = _probe_hashes(h, lev)
        for i in range(ERROR_BITS):
            if not len(alive):
                break
            at = base[alive] + _place(a[alive], b[alive], i, bits[alive])
            hit = (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
            alive = alive[hit.astype(bool)]
        found = np.zeros(len(h), bool)
        found[alive] = True
        return found

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The highest level present: all below it are present too."""
        low, high = np.zeros(len(h), np.int64), np.full(len(h), 256)
        todo, lev = np.arange(len(h)), 1
        while len(todo) and lev < 256:
            there = self._has(h[todo], lev)
            high[todo[~there]] = lev
            todo = todo[there]
            low[todo] = lev
            lev *= 2
        while len(todo := np.flatnonzero(high - low > 1)):
            middle = (low[todo] + high[todo]) // 2
            there = self._has(h[todo], middle)
            low[todo[there]] = middle[there]
            high[todo[~there]] = middle[~there]
        return low


@dataclass
class Levels:
    """Levels found before, by sorted hashes; knows those only."""

    hashes: np.ndarray
    found: np.ndarray

    def levels(self, h: np.ndarray) -> np.ndarray:
        return self.found[np.searchsorted(self.hashes, h)].astype(np.int64)


def _probe_hashes(h: np.ndarray, lev) -> tuple[np.ndarray, np.ndarray]:
    a = mix64(h + np.asarray(lev, np.uint64).reshape(-1) * _LEVEL)
    return a, mix64(a ^ _SECOND) | np.uint64(1)


def _place(a: np.ndarray, b: np.ndarray, i: int, bits: np.ndarray) -> np.ndarray:
    # The upper half of the hash, scaled to the segment's bits (fewer than 2^32).
    return ((a + np.uint64(i) * b) >> np.uint64(32)) * bits >> np.uint64(32)


def build_segment(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The 64-bit words of one segment."""
    if not len(h):
        return np.zeros(0, np.uint64)
    top = level(counts)
    entries = int(top.sum())
    size = -(-int(entries * BITS_PER_ENTRY + 1) // 64)
    bits = np.zeros(size * 64, bool)
    of = np.repeat(np.arange(len(h)), top)
    lev = np.arange(entries) - np.repeat(np.cumsum(top) - top, top) + 1
    a, b = _probe_hashes(h[of], lev)
    for i in range(ERROR_BITS):
        bits[_place(a, b, i, np.uint64(size * 64)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _built(rows: pa.Table) -> pa.Table:
    """A segment's filter, with the number and the sum of the counts on every level."""
    kind, segment = rows.column("kind")[0].as_py(), rows.column("segment")[0].as_py()
    read = lambda c, t: [np.frombuffer(x, t) for x in rows.column(c).to_pylist()]
    once = read("once", np.uint64)
    h, c = _summed([*once, *read("often", np.uint64)],
                   [*(np.ones(len(x), np.int64) for x in once), *read("counts", np.uint32)])
    on = level(c)
    lists = pa.list_(pa.int64())
    return pa.table({"kind": pa.array([kind], pa.int32()), "segment": pa.array([segment], pa.int32()),
                     "bits": pa.array([build_segment(h, c).tobytes()], pa.binary()),
                     "sizes": pa.array([np.bincount(on, minlength=LEVELS).tolist()], lists),
                     "sums": pa.array([np.bincount(on, c, LEVELS).astype(np.int64).tolist()], lists)})


@dataclass
class Model:
    """What scoring needs: the two filters, the mean count of the words on each level, N, V and the number of
    documents."""

    filters: dict[int, LogBloom | Levels]
    means: np.ndarray
    n: int
    v: int
    docs: int


class Scorer:
    """Scores chunks with a model; remembers the levels of words met before in the same task."""

    REMEMBERED = 500_000

    def __init__(self, model: Model) -> None:
        self.model = model
        self.words, self.found = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _word_levels(self, word: np.ndarray) -> np.ndarray:
        """Levels of sorted distinct word hashes."""
        at = np.minimum(np.searchsorted(self.words, word), max(len(self.words) - 1, 0))
        known = self.words[at] == word if len(self.words) else np.zeros(len(word), bool)
        new = word[~known]
        found = self.model.filters[WORD].levels(new)
        out = np.empty(len(word), np.int64)
        out[known], out[~known] = self.found[at[known]], found
        if len(self.words) + len(new) > self.REMEMBERED:
            self.words, self.found = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        place = np.searchsorted(self.words, new)
        self.words, self.found = np.insert(self.words, place, new), np.insert(self.found, place, found)
        return out

    def chances(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of every token of a chunk after the one before it."""
        m = self.model
        word, at = np.unique(tokens, return_inverse=True)
        levels = self._word_levels(word)
        own, most = m.means[levels][at], bounds_of(levels)[1][at]
        before = np.empty(len(tokens))
        before[1:] = most[:-1]
        before[first[:-1]] = m.docs
        # A pair is no more frequent than its parts, so pairs with an unknown part need no probe.
        least = np.minimum(before, most)
        asked = np.flatnonzero(least > 0)
        pair, pair_at = np.unique(pairs_of(tokens, first)[asked], return_inverse=True)
        both = np.zeros(len(tokens))
        both[asked] = np.minimum(bounds_of(m.filters[PAIR].levels(pair))[0][pair_at], least[asked])
        alone = (own + 1) / (m.n + m.v + 1)
        paired = np.maximum(both - DISCOUNT, 0) / np.maximum(before, 1)
        return np.where(before > 0, PAIRS * paired + (1 - PAIRS) * alone, alone)

    def log10(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probability of every document of a chunk (each has at least its end)."""
        if not self.model.n:
            return np.zeros(len(first) - 1)
        return np.add.reduceat(np.log10(self.chances(tokens, first)), first[:-1])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; a null word stands for the ends, one for each document."""
    return (docs.select("text").mapInArrow(_word_rows, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def filter_table(docs: DataFrame, segments: int) -> tuple[DataFrame, int]:
    """The segments of the filters of words and pairs of ``docs``, written, and their bytes in all."""
    rows = (docs.select("text").mapInArrow(_segment_rows(segments),
                                           "kind int, segment int, once binary, often binary, counts binary")
            .groupBy("kind", "segment").applyInArrow(
                _built, "kind int, segment int, bits binary, sizes array<long>, sums array<long>"))
    rows = written(rows, "lm_filter")
    return rows, rows.agg(F.coalesce(F.sum(F.length("bits")), F.lit(0))).first()[0]


def word_means(rows: DataFrame) -> np.ndarray:
    """Mean count of the words on each level."""
    total = lambda c: F.array(*(F.coalesce(F.sum(F.col(c)[i]), F.lit(0)) for i in range(LEVELS)))
    r = rows.filter(F.col("kind") == WORD).agg(total("sizes").alias("n"), total("sums").alias("s")).first()
    return np.array(r["s"], float) / np.maximum(np.array(r["n"], float), 1)


def segments_for(n: int) -> int:
    return max(16, -(-n // SEGMENT_TOKENS))


def gathered(rows: DataFrame, segments: int) -> dict[int, LogBloom]:
    """The filters of a table of segments, on the driver."""
    filters = {}
    for kind in (WORD, PAIR):
        parts = {r["segment"]: np.frombuffer(r["bits"], np.uint64)
                 for r in rows.filter(F.col("kind") == kind).select("segment", "bits").toLocalIterator()}
        whole = [parts.get(s, np.zeros(0, np.uint64)) for s in range(segments)]
        filters[kind] = LogBloom(np.concatenate(whole), np.cumsum([0, *map(len, whole)]))
    return filters


def _hot_least(counts: DataFrame, most: int) -> int:
    """The least n such that at most ``most`` words have a count of n or more, from a histogram of log counts."""
    bins = counts.groupBy(F.floor(F.log("n") / np.log(1.02)).alias("b")).agg(
        F.count(F.lit(1)).alias("k"), F.min("n").alias("lo")).collect()
    total, least = 0, 2**62
    for r in sorted(bins, key=lambda r: -r["b"]):
        total += r["k"]
        if total > most:
            break
        least = r["lo"]
    return least


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for lo, hi, data, offsets in chunks(batch.column("word")):
            h = words_of(data, offsets).hashes()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("n").slice(lo, hi - lo)], ["h", "n"])


def _scored(model, hot, keep: list[str], apart: bool):
    """``apart``: the score is left open, and the text goes along with the number of its chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # Broadcasts hold plain arrays and numbers: their objects are unpickled before this function's code is there.
        filters, means, n, v, n_docs = model.value
        hot_hash, hot_n = hot.value
        m = Model({k: LogBloom(*f) for k, f in filters.items()}, means, n, v, n_docs)
        scorer = Scorer(m)
        floor = np.log10(1 / (m.n + m.v + 1)) if m.n else 0.0
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            for lo, hi, data, offsets in chunks(batch.column("text")):
                w = words_of(data, offsets)
                h = w.hashes()
                tokens, first = tokens_of(w)
                at = np.minimum(np.searchsorted(hot_hash, h), max(len(hot_hash) - 1, 0))
                known = (hot_hash[at] == h) if len(hot_hash) else np.zeros(len(h), bool)
                doc = w.doc
                gain = np.zeros(len(h))
                gain[known] = np.log10(hot_n[at[known]] + 1)
                base = np.bincount(doc, gain, hi - lo) + floor * np.diff(w.first)
                base += floor + np.log10(m.docs + 1)                       # the end
                n_known = np.bincount(doc, known, hi - lo).astype(np.int64) + (m.docs > 0)
                rare = np.flatnonzero(~known)
                keys = np.lexsort((h[rare], doc[rare]))
                rare = rare[keys]
                new = np.concatenate([[True], (h[rare][1:] != h[rare][:-1]) | (doc[rare][1:] != doc[rare][:-1])])[:len(rare)]
                head = np.flatnonzero(new)
                times = np.diff(np.append(head, len(rare)))
                bounds = np.searchsorted(doc[rare[head]], np.arange(hi - lo + 1))
                cold = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(w.strings(rare[head]), pa.string()), pa.array(times, pa.int64())], ["word", "times"]))
                last = ([pa.array(np.full(hi - lo, row)), batch.column("text").slice(lo, hi - lo)] if apart
                        else [pa.array(scorer.log10(tokens, first))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in keep]
                    + [pa.array(row + np.arange(hi - lo)), pa.array(np.diff(first)), pa.array(n_known), pa.array(base),
                       cold, *last],
                    [*keep, "row", "n_tokens", "hot_known", "hot_base", "cold", *(["chunk", "_text"] if apart else ["score"])])
                row += hi - lo
    return run


def _asked(segments: int, parts: int):
    """(chunk, kind, segment, part, hashes): the distinct n-grams of a chunk of texts by segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chunk = batch.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = int(mix64(chunk[a:a + 1].view(np.uint64))[0] % np.uint64(parts)) if a < b else 0
                for _, _, data, offsets in chunks(batch.column("_text").slice(a, b - a)):
                    t, first = tokens_of(words_of(data, offsets))
                    rows = []
                    for kind, h in ((WORD, np.unique(t)), (PAIR, np.unique(pairs_of(t, first)))):
                        cut = np.searchsorted(_segment(h, segments), np.arange(segments + 1))
                        rows += [(kind, s, h[cut[s]:cut[s + 1]].tobytes()) for s in np.flatnonzero(np.diff(cut)).tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(chunk[a])] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                         pa.array([r[1] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int32()),
                         pa.array([r[2] for r in rows], pa.binary())], ["chunk", "kind", "segment", "part", "hashes"])
    return run


def _probed(asked: pa.Table, segment: pa.Table) -> pa.Table:
    """(chunk, kind, hashes, levels) of what is asked of one segment."""
    bits = np.frombuffer(b"".join(segment.column("bits").to_pylist()), np.uint64)
    bloom = LogBloom(bits, np.array([0, len(bits)]))
    levels: list[bytes] = []
    for batch in asked.select(["hashes"]).to_batches(max_chunksize=1000):
        hashes = [np.frombuffer(x, np.uint64) for x in batch.column(0).to_pylist()]
        found = bloom.levels(np.concatenate(hashes)).astype(np.uint8)
        levels += [x.tobytes() for x in np.split(found, np.cumsum([len(x) for x in hashes])[:-1])]
    return asked.select(["chunk", "kind", "hashes"]).append_column("levels", pa.array(levels, pa.binary()))


def _scored_chunk(means: list[float], n: int, v: int, n_docs: int):
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        filters = {}
        for kind in (WORD, PAIR):
            mine = found.filter(pc.equal(found.column("kind"), kind))
            h = np.frombuffer(b"".join(mine.column("hashes").to_pylist()), np.uint64)
            h, at = np.unique(h, return_index=True)
            filters[kind] = Levels(h, np.frombuffer(b"".join(mine.column("levels").to_pylist()), np.uint8)[at])
        scorer = Scorer(Model(filters, np.array(means), n, v, n_docs))
        scores = [scorer.log10(*tokens_of(words_of(data, offsets))) for _, _, data, offsets in chunks(texts.column("_text"))]
        return pa.table({"row": texts.column("row"), "score": pa.array(np.concatenate([*scores, np.zeros(0)]))})
    return run


def _scores_by_segments(rows: DataFrame, bits: DataFrame, segments: int, means: np.ndarray, n: int, v: int,
                        n_docs: int) -> DataFrame:
    """(row, score) of ``rows`` (chunk, row, _text), with the filter left where it is.  Segments are sized by the
    training tokens; where far more are scored, what is asked of a segment is dealt to several parts."""
    tokens = rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    parts = max(1, -(-tokens // (2 * segments * SEGMENT_TOKENS)))
    keys = ["kind", "segment", "part"]
    asked = rows.select("chunk", "_text").mapInArrow(
        _asked(segments, parts), "chunk long, kind int, segment int, part int, hashes binary")
    held = bits.select("kind", "segment", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "bits")
    found = (asked.groupBy(*keys).cogroup(held.groupBy(*keys))
             .applyInArrow(_probed, "chunk long, kind int, hashes binary, levels binary"))
    return (rows.select("chunk", "row", "_text").groupBy("chunk").cogroup(found.groupBy("chunk"))
            .applyInArrow(_scored_chunk(means.tolist(), n, v, n_docs), "row long, score double"))


def score(docs: DataFrame, learns: Column, keep: tuple[str, ...] = ("doc_id",), max_bytes: int = MAX_BYTES,
          hot_words: int = HOT_WORDS) -> DataFrame:
    """The ``keep`` columns with n_tokens, n_known, train_tokens, base_score and score of every whole text; learned
    from the rows where ``learns`` holds."""
    sc = docs.sparkSession.sparkContext
    train = docs.filter(learns).select("text")
    counts = written(word_counts(train), "lm_words")
    n, v, n_docs = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)),
                              F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0))).first()
    words = counts.filter("word is not null")
    least = _hot_least(words, hot_words)
    hot_rows = words.filter(F.col("n") >= least).mapInArrow(_hashed, "h long, n long").toArrow()
    h = np.asarray(hot_rows.column("h")).view(np.uint64)
    order = np.argsort(h)
    hot = sc.broadcast((h[order], np.asarray(hot_rows.column("n")).astype(np.float64)[order]))
    segments = segments_for(n)
    bits, size = filter_table(train, segments)
    apart, means = size > max_bytes, word_means(bits)
    filters = {} if apart else {k: (f.words, f.begin) for k, f in gathered(bits, segments).items()}
    model = sc.broadcast((filters, means, n, v, n_docs))
    source = docs.select(*keep, "text")
    schema = T.StructType([*docs.select(*keep).schema.fields]).add("row", "long").add("n_tokens", "long").add(
        "hot_known", "long").add("hot_base", "double").add(
        "cold", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("times", T.LongType())])))
    schema = schema.add("chunk", "long").add("_text", "string") if apart else schema.add("score", "double")
    rows = written(source.mapInArrow(_scored(model, hot, list(keep), apart), schema), "lm_rows")
    rare = (rows.select("row", F.inline("cold")).join(words.filter(F.col("n") < least), "word", "left")
            .withColumn("n", F.coalesce("n", F.lit(0)))
            .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_base"),
                                F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known")))
    if apart:
        rows = rows.drop("_text").join(_scores_by_segments(rows, bits, segments, means, n, v, n_docs), "row")
    return rows.drop("cold").join(rare, "row", "left").select(
        *keep, "n_tokens", (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("hot_base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score")
