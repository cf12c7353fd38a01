"""Best-fit packing of tokenised documents with exact complements (operator 2).

Documents become token ids, each ended by one closing id, and are cut into pieces of at most ``capacity`` (the
remainder first, then full ones).  Which pieces share a sequence depends on lengths alone, so packing is
planned on the histogram of lengths (at most ``capacity`` counts, the only thing the driver sees): from the
longest down, an open sequence's gap is filled exactly by one, two or three available lengths, found in an
index of single, pair and triple sums, as often as the counts allow; where no combination fits exactly, the
longest length that fits is added and the search goes on with the smaller gap.  The plan is a short list of
patterns with multiplicities.

Pieces are then numbered within their length in Spark (per salted group, with offsets from the groups'
counts), and a piece's number tells its pattern, its sequence and its place there.

Where an order is to be kept (a mixture), pieces are ranked in it over all rows and each window of WINDOW
consecutive pieces has a histogram and a plan of its own, so a piece moves by less than a window at any size of
the input; sequences are numbered by their first piece.

Defined cases: a null or empty text is the closing id alone.  The string of a token that the
tokenizer's file adds (``<|endoftext|>``) is that token.  Rows that repeat, also with a null doc_id, are packed each for itself.  An empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.llm.common import numbered, written
from vidlake.llm.textscan import slices
from vidlake.operators.ranking import ordered_slices

CAPACITY = 1024
CLOSE = 2
WINDOW = 4096                 # consecutive pieces that are planned together where an order is kept


class Pattern(NamedTuple):
    """``times`` sequences that each hold these lengths (length, how many), longest first."""

    lengths: tuple[tuple[int, int], ...]
    times: int


def tokenizer(ranks: str, reserve: str):
    """text -> ids as the tokenizers file ``reserve`` gives them without adding special tokens: strings of its added
    tokens become their ids.  ``ranks`` holds the same vocabulary as byte strings with their ids, which is faster;
    texts with an added token's string, and those that the faster form cannot take (very long runs without a
    break), are left to the file itself."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    whole = Tokenizer.from_file(reserve)
    added = [t.content for t in whole.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if not any(t in text for t in added):
            try:
                return fast.encode_ordinary(text)
            except (KeyboardInterrupt, SystemExit, MemoryError):
                raise
            except BaseException as e:  # the regular expression engine gives up by a panic, which is no Exception
                if not isinstance(e, Exception) and type(e).__name__ != "PanicException":
                    raise
        return whole.encode(text, add_special_tokens=False).ids

    return encode


def pieces(docs: DataFrame, capacity: int = CAPACITY, close: int = CLOSE, keep_ids: bool = False,
           carry: tuple[str, ...] = (), ranks: str | None = None, reserve: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ``ids``) of every piece of every document, with the columns
    in ``carry`` of its document."""
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    reserve = reserve or public_tokenizers.path("byte_bpe_50k.json")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    for c in carry:
        schema = schema.add(docs.schema[c])
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(ranks, reserve)
        for batch in slices(batches):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, text in enumerate(batch.column("text")):
                tokens = encode(text.as_py() or "")
                tokens.append(close)
                whole = np.array(tokens, "<u4")
                cuts = [0, *range(len(whole) % capacity or capacity, len(whole) + 1, capacity)]
                for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    row.append(k)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(whole[a:b].tobytes()))
                    if keep_ids:
                        ids.append(whole[a:b].astype(np.int32))
            of = pa.array(row, pa.int64())
            cols = [batch.column("doc_id").take(of), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), *(batch.column(c).take(of) for c in carry)]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []),
                                             schema.names)

    return docs.select("doc_id", "text", *carry).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up the counted lengths (1..capacity)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    pair_sums = None     # pair_sums[s]: two available lengths add up to s

    def index() -> np.ndarray:
        nonlocal pair_sums
        if pair_sums is None:
            here = (left > 0).astype(np.float64)
            here[0] = 0
            pair_sums = np.convolve(here, here)[:capacity + 1] > 0.5
        return pair_sums

    def fits(add: list[int], open_: list[int]) -> bool:
        return all(left[x] >= (add + open_).count(x) for x in set(add))

    def pair(gap: int, most: int, open_: list[int]) -> list[int] | None:
        a = np.arange(min(gap - 1, most), (gap - 1) // 2, -1)
        for x in a[(left[a] > 0) & (left[gap - a] > 0)].tolist():
            if fits([x, gap - x], open_):
                return [x, gap - x]
        return None

    def complement(gap: int, open_: list[int]) -> list[int] | None:
        """One, two or three available lengths that fill the gap exactly."""
        if fits([gap], open_):
            return [gap]
        if gap > 1 and index()[gap] and (found := pair(gap, gap, open_)):
            return found
        if gap > 2:
            a = np.arange(gap - 2, (gap - 1) // 3, -1)
            for x in a[(left[a] > 0) & index()[gap - a]].tolist():
                if fits([x], open_) and (rest := pair(gap - x, x, [*open_, x])):
                    return [x, *rest]
        return None

    out: list[Pattern] = []
    for longest in range(capacity, 0, -1):
        while left[longest] > 0:
            open_ = [longest]
            gap = capacity - longest
            while gap:
                if found := complement(gap, open_):
                    open_ += found
                    break
                fitting = [x for x in np.flatnonzero(left[:gap + 1])[::-1].tolist() if fits([x], open_)][:1]
                if not fitting:
                    break
                open_ += fitting
                gap -= fitting[0]
            use = {x: open_.count(x) for x in sorted(set(open_), reverse=True)}
            times = int(min(left[x] // n for x, n in use.items()))
            for x, n in use.items():
                left[x] -= n * times
                if not left[x]:
                    pair_sums = None
            out.append(Pattern(tuple(use.items()), times))
    return out


def places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, first sequence, per sequence, offset of the first) for every length of
    every pattern: which numbers of a length go to which sequences."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for p in patterns:
        offset = 0
        for length, n in p.lengths:
            begin = used.get(length, 0)
            used[length] = begin + n * p.times
            rows.append((length, begin, used[length], sequence, n, offset))
            offset += n * length
        sequence += p.times
    return rows


def pack(docs: DataFrame, capacity: int = CAPACITY, close: int = CLOSE, keep_ids: bool = False,
         order: str | None = None, **files: str) -> DataFrame:
    """Every piece with its sequence_id and its offset there; sequences are filled without gaps from 0.  With
    ``order``, a column of the documents, sequences follow it by windows, and ``sequence_order`` is its least
    value in the sequence."""
    carry = (order,) if order else ()
    items = written(pieces(docs, capacity, close, keep_ids, carry, **files), "pack_pieces")
    out = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []), "sequence_id", "offset"]
    if order:
        return _in_windows(items, order, capacity).select(*out, "sequence_order")
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = places(plan(counts, capacity))
    schema = "length long, _first long, _end long, _sequence long, _per long, _offset long"
    table = items.sparkSession.createDataFrame(rows, schema)
    # The places are bounded by the plan (a few rows per length), whatever the number of pieces.
    placed = (numbered(items, "length", ["doc_id", "piece", "ids_crc32"], sum(counts.values()))
              .join(F.broadcast(table), "length")
              .filter((F.col("number") >= F.col("_first")) & (F.col("number") < F.col("_end")))
              .withColumn("_k", F.col("number") - F.col("_first"))
              .withColumn("sequence_id", F.col("_sequence") + F.floor(F.col("_k") / F.col("_per")))
              .withColumn("offset", F.col("_offset") + F.col("_k") % F.col("_per") * F.col("length")))
    return placed.select(*out)


def _in_windows(items: DataFrame, order: str, capacity: int) -> DataFrame:
    """Pieces with sequence_id, offset and sequence_order, planned by windows of consecutive pieces."""
    ranged = ordered_slices(items, [], [F.col(c).asc() for c in (order, "doc_id", "piece", "ids_crc32")])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # a row per partition
    begins = (ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_from"))
              .select("_pid", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    rank = F.col("_before") + F.col("_mid") - F.col("_from")
    ranked = (ranged.join(begins, "_pid").withColumn("_rank", rank)
              .withColumn("_window", F.floor(F.col("_rank") / WINDOW)).drop("_pid", "_mid", "_from", "_before"))
    schema = T.StructType([*ranked.schema.fields, T.StructField("_sequence", T.LongType()), T.StructField("offset", T.LongType()),
                           T.StructField("sequence_order", items.schema[order].dataType)])
    packed = written(ranked.groupBy("_window").applyInArrow(_packed_window(order, capacity), schema), "pack_windows")
    earlier = Window.orderBy("_window").rowsBetween(Window.unboundedPreceding, -1)   # a row per window
    offsets = (packed.groupBy("_window").agg((F.max("_sequence") + 1).alias("_n"))
               .select("_window", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    return packed.join(offsets, "_window").withColumn("sequence_id", F.col("_before") + F.col("_sequence"))


def _packed_window(order: str, capacity: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_rank")
        length = rows.column("length").to_numpy()
        by_length = np.argsort(length, kind="stable")     # within a length in the order
        value, first, n = np.unique(length[by_length], return_index=True, return_counts=True)
        at = dict(zip(value.tolist(), first.tolist()))
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for size, begin, end, seq, per, start in places(plan(dict(zip(value.tolist(), n.tolist())), capacity)):
            k = np.arange(end - begin)
            mine = by_length[at[size] + begin:at[size] + end]
            sequence[mine], offset[mine] = seq + k // per, start + k % per * size
        # Sequences by their first piece; their order is the first that is not null.
        _, head, sequence = np.unique(sequence, return_index=True, return_inverse=True)
        place = np.empty(len(head), np.int64)
        place[np.argsort(head)] = np.arange(len(head))
        sequence = place[sequence]
        known = np.flatnonzero(rows.column(order).is_valid().to_numpy())
        least = np.full(len(head), len(length))
        np.minimum.at(least, sequence[known], known)
        least = least[sequence]
        take = pa.array(least, mask=least == len(length))
        return (rows.append_column("_sequence", pa.array(sequence)).append_column("offset", pa.array(offset))
                .append_column("sequence_order", rows.column(order).take(take)))
    return run
