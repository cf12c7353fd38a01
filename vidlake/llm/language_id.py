"""Language identification by rank-order profiles (operator 6).

A language's profile is the ranked list of its most frequent letter n-grams (one to three letters, words
padded at both ends).  A document's own ranked list is compared to each profile by the out-of-place distance:
the sum over its n-grams of how far the ranks differ, a fixed penalty where the profile lacks the n-gram.

Counting is vectorised in Python workers over chunks of whole documents; counts per language are summed in
Spark, and only the profiles (languages x PROFILE rows) reach the driver and the workers.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text if nothing
could be learned.  Ties between n-grams go to the lesser code points, between languages to the lesser name.
Rows that repeat are scored each for itself and counted each time; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.llm.textscan import chunks, slices

PROFILE = 300
_CHUNK = 1 << 18    # bytes of text at a time; a letter takes about 200 bytes in the arrays of a chunk
_PAD = 1            # code of the word boundary; 0 fills the front of shorter n-grams
_BITS = 21          # a code point has 21 bits, so three pack into one signed 64-bit integer


class _Letters:
    """Code point -> lower-case letter code point, or 0; filled as characters are met."""

    def __init__(self) -> None:
        self.code = np.full(0x110000, -1, np.int32)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        out = self.code[points]
        if (out < 0).any():
            for p in np.unique(points[out < 0]).tolist():
                c = chr(p)
                low = c.lower()
                self.code[p] = 0 if not c.isalpha() else ord(low) if len(low) == 1 else p
            out = self.code[points]
        return out


def _points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a chunk and the documents' offsets in them."""
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    if len(points) != starts[-1]:  # bytes that are no UTF-8: decode document by document
        parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        points = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), np.uint32)
    return points, starts


def _grams(letters: _Letters, data: np.ndarray, offsets: np.ndarray):
    """Per n-gram of a chunk: its three codes (0 in front if shorter) and its document."""
    points, starts = _points(data, offsets)
    s = np.insert(letters(points), starts, 0).astype(np.int64)
    doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts + np.arange(len(starts)), len(s))))
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    s, doc = s[keep], doc[keep]
    s[s == 0] = _PAD
    letter = s != _PAD
    one = np.flatnonzero(letter)
    two = np.flatnonzero(letter[:-1] | letter[1:])
    three = np.flatnonzero(letter[1:-1])
    zero = lambda n: np.zeros(n, np.int64)
    c1 = np.concatenate([zero(len(one)), zero(len(two)), s[three]])
    c2 = np.concatenate([zero(len(one)), s[two], s[three + 1]])
    c3 = np.concatenate([s[one], s[two + 1], s[three + 2]])
    of = np.concatenate([doc[one], np.where(letter[two], doc[two], doc[two + 1]), doc[three + 1]])
    return c1, c2, c3, of


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array with their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.diff(np.append(at, len(keys)))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters, found = _Letters(), {}
    for batch in slices(batches):
        langs = batch.column("lang").to_pylist()
        for lo, hi, data, offsets in chunks(batch.column("text"), _CHUNK):
            c1, c2, c3, of = _grams(letters, data, offsets)
            packed = (c1 << (2 * _BITS)) | (c2 << _BITS) | c3
            names = sorted(set(langs[lo:hi]))
            number = np.array([names.index(x) for x in langs[lo:hi]])
            for k, name in enumerate(names):
                parts = found.setdefault(name, [])
                parts.append(_runs(np.sort(packed[number[of] == k])))
                if sum(len(p[0]) for p in parts) > 1_000_000:
                    found[name] = [_summed(parts)]
    for name, parts in found.items():
        codes, counts = _summed(parts)
        for a in range(0, len(codes), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(codes[a:a + 100_000]), pa.string()), pa.array(codes[a:a + 100_000]),
                 pa.array(counts[a:a + 100_000])], ["lang", "gram", "n"])


def learn(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles {language: packed n-grams by rank} of the rows of ``docs`` (text, lang) that have a lang."""
    counts = (docs.select("lang", "text").filter("lang is not null")
              .mapInArrow(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = (counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size)
            .select("lang", "gram", "rank").collect())
    profiles: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


def _identify(letters: _Letters, names: list[str], grams: np.ndarray, ranks: np.ndarray, size: int,
              data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best language or -1, score) per document of a chunk.  ``grams`` is sorted; ranks[g, l] is the rank of
    n-gram g in profile l, or -1."""
    n = len(offsets) - 1
    best, score = np.full(n, -1), np.zeros(n)
    c1, c2, c3, of = _grams(letters, data, offsets)
    if not len(c1) or not names:
        return best, score
    alphabet = np.flatnonzero(np.bincount(c3, minlength=2))
    alphabet = np.union1d(alphabet, [0, _PAD])
    small = np.zeros(int(alphabet[-1]) + 1, np.int64)
    small[alphabet] = np.arange(len(alphabet))
    base = len(alphabet)
    cube = base ** 3
    step = max(1, (2**62) // cube)       # documents whose keys fit into 64 bits at once
    for d0 in range(0, n, step):
        mine = slice(None) if step >= n else (of >= d0) & (of < d0 + step)
        keys = np.sort((of[mine] - d0) * cube + (small[c1[mine]] * base + small[c2[mine]]) * base + small[c3[mine]])
        keys, counts = _runs(keys)
        doc, code = keys // cube, keys % cube
        order = np.lexsort((-counts, doc))          # stable: equal counts stay in order of code
        first = np.searchsorted(doc, np.arange(doc[-1] + 2)) if len(doc) else np.zeros(1, int)
        rank = np.arange(len(order)) - first[doc[order]]
        top = rank < size
        rank, doc, code = rank[top], doc[order][top], code[order][top]
        packed = ((alphabet[code // base**2] << (2 * _BITS)) | (alphabet[code // base % base] << _BITS)
                  | alphabet[code % base])
        at = np.minimum(np.searchsorted(grams, packed), len(grams) - 1)
        known = grams[at] == packed
        own = ranks[at]
        gap = np.where(known[:, None] & (own >= 0), np.abs(own - rank[:, None]), size)
        docs_here, starts = np.unique(doc, return_index=True)
        total = np.add.reduceat(gap, starts, axis=0)
        width = np.diff(np.append(starts, len(doc)))
        best[d0 + docs_here] = total.argmin(axis=1)
        score[d0 + docs_here] = 1 - total.min(axis=1) / (width * size)
    return best, score


def identify(docs: DataFrame, profiles: dict[str, list[int]], keep: Sequence[str] = ("doc_id",),
             names_out: tuple[str, str] = ("lang_pred", "score"), size: int = PROFILE) -> DataFrame:
    """The ``keep`` columns with the predicted language and a score (0 to 1, one less the mean out-of-place
    distance over the penalty) of each whole text."""
    names = sorted(profiles)
    grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
    ranks = np.full((len(grams), len(names)), -1, np.int32)
    for k, name in enumerate(names):
        ranks[np.searchsorted(grams, profiles[name]), k] = np.arange(len(profiles[name]))
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _Letters()
        for batch in slices(batches):
            pred, score = [], [np.zeros(0)]
            for _, _, data, offsets in chunks(batch.column("text"), _CHUNK):
                b, s = _identify(letters, names, grams, ranks, size, data, offsets)
                pred += [names[k] if k >= 0 else "und" for k in b]
                score.append(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(pred, pa.string()), pa.array(np.concatenate(score))],
                [*keep, *names_out])

    source = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(names_out[0], T.StringType()),
                           T.StructField(names_out[1], T.DoubleType())])
    return source.mapInArrow(run, schema)


def identify_learning(docs: DataFrame, learns: Column, keep: Sequence[str] = ("doc_id",),
                      names_out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Learn from the rows where ``learns`` holds, identify all rows."""
    return identify(docs, learn(docs.filter(learns)), keep, names_out)
