"""Line deduplication over levelled sorted runs of line hashes (operator 7).

``LineRuns`` holds, in the shared scratch folder, runs of (128-bit key hash, number of documents), each bucketed
and sorted by hash.  A new batch is anti-joined with the keys that some run already settles (counted in at
least ``min_docs`` documents) and its remaining counts become a run of level 0; when a level holds ``fanout``
runs they are merged, counts summed, into one run of the next level.  A key is frequent if its counts over all
runs reach ``min_docs``; its lines are dropped from every document.

A line's key is the line stripped of 0x20 and 0x09-0x0D at both ends with A-Z lower-cased; an empty key is
never dropped.  Each row of the input counts as a document, and once per key however often it holds the line.

Defined cases: a null text counts as one empty line and stays null; a text whose lines all go becomes empty.
Repeated rows each count and each lose the same lines.  An empty table gives an empty result; all columns of
the input pass through, and the two counters can be named so that they clash with none.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.llm.common import BLANKS, at_most, written
from vidlake.llm.textscan import slices
from vidlake.session import scratch_path

_STRIP = BLANKS.encode()
BATCHES = 4
# Frequent keys that are sent to every worker at most (16 bytes each); beyond, lines are joined with them.
BROADCAST_KEYS = 200_000


def _digest(line: bytes) -> bytes | None:
    key = line.strip(_STRIP).lower()
    return blake2b(key, digest_size=16).digest() if key else None


def _texts(column: pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def _key_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(batch, h1, h2, n): documents of this Arrow batch per distinct line key."""
    for rows in slices(batches, 5000):
        counts: dict[tuple[int, bytes], int] = {}
        for which, text in zip(rows.column("batch").to_pylist(), _texts(rows.column("text"))):
            for d in {_digest(line) for line in text.split(b"\n")}:
                if d is not None:
                    counts[which, d] = counts.get((which, d), 0) + 1
        parts = [struct.unpack("<qq", d) for _, d in counts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in counts], pa.int32()), pa.array([p[0] for p in parts], pa.int64()),
             pa.array([p[1] for p in parts], pa.int64()), pa.array(list(counts.values()), pa.int64())],
            ["batch", "h1", "h2", "n"])


def key_counts(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(batch, h1, h2, n) over all documents; a document's batch is a hash of its row."""
    which = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")
    return (docs.select(which.alias("batch"), "text")
            .mapInArrow(_key_counts, "batch int, h1 long, h2 long, n long")
            .groupBy("batch", "h1", "h2").agg(F.sum("n").alias("n")))


class LineRuns:
    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = 3) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        (counts.select("h1", "h2", "n").repartition(self.buckets, "h1", "h2")
         .write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .option("path", scratch_path(self.spark, name)).saveAsTable(name))
        return name

    def _merged(self, runs: list[str]) -> DataFrame:
        """The runs merged pairwise by their sorted keys, counts summed."""
        rows = self.spark.table(runs[0])
        for r in runs[1:]:
            more = self.spark.table(r).withColumnRenamed("n", "more")
            rows = rows.join(more, ["h1", "h2"], "full").select(
                "h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"))
        return rows

    def add(self, counts: DataFrame) -> None:
        """Take in the (h1, h2, n) of a new batch."""
        for runs in self.levels:
            for r in runs:
                settled = self.spark.table(r).filter(F.col("n") >= self.min_docs).select("h1", "h2")
                counts = counts.join(settled, ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(counts))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(self._merged(self.levels[level])))
            for r in self.levels[level]:
                self.spark.sql(f"DROP TABLE {r}")
            self.levels[level] = []
            level += 1

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys found in at least ``min_docs`` documents."""
        runs = [r for level in self.levels for r in level]
        return written(self._merged(runs).filter(F.col("n") >= self.min_docs).select("h1", "h2"), "line_frequent")


def _kept(text: bytes, gone) -> tuple[bytes, int, int]:
    lines = text.split(b"\n")
    keep = [line for i, line in enumerate(lines) if not gone(i, line)]
    return b"\n".join(keep), len(lines), len(lines) - len(keep)


def drop_lines(docs: DataFrame, frequent: DataFrame, n_lines: str = "n_lines", n_dropped: str = "n_dropped",
               broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``docs`` with the lines of frequent keys taken out of ``text``, and two counters."""
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(n_lines, T.LongType()), T.StructField(n_dropped, T.LongType())])

    def rebuilt(rows: pa.RecordBatch, results: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
        given = rows.column("text")
        text = pa.array([r[0] if ok else None for ok, r in zip(given.is_valid().to_pylist(), results)],
                        pa.large_binary()).cast(pa.large_string()).cast(given.type)
        return pa.RecordBatch.from_arrays(
            [text if c == "text" else rows.column(c) for c in columns]
            + [pa.array([r[1] for r in results], pa.int64()), pa.array([r[2] for r in results], pa.int64())],
            [*columns, n_lines, n_dropped])

    if at_most(frequent, broadcast_keys):
        keys = frozenset(struct.pack("<qq", r.h1, r.h2) for r in frequent.collect())

        def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in slices(batches):
                yield rebuilt(rows, [_kept(t, lambda _, line: _digest(line) in keys) for t in _texts(rows.column("text"))])

        return docs.mapInArrow(by_key, schema)

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for row, text in zip(rows.column("row").to_pylist(), _texts(rows.column("text"))):
                out += [(row, i, *struct.unpack("<qq", d)) for i, line in enumerate(text.split(b"\n"))
                        if (d := _digest(line)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(4)],
                                             ["row", "place", "h1", "h2"])

    def by_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            hits = [frozenset(x or ()) for x in rows.column("_gone").to_pylist()]
            yield rebuilt(rows, [_kept(t, lambda i, _, g=g: i in g) for t, g in zip(_texts(rows.column("text")), hits)])

    row = F.xxhash64("doc_id", "text")
    hits = (docs.select(row.alias("row"), "text").mapInArrow(lines_of, "row long, place long, h1 long, h2 long")
            .join(frequent, ["h1", "h2"]).groupBy(F.col("row").alias("_row")).agg(F.collect_set("place").alias("_gone")))
    return docs.withColumn("_row", row).join(hits, "_row", "left").select(*columns, "_gone").mapInArrow(by_place, schema)


def frequent_lines(docs: DataFrame, min_docs: int = 10, batches: int = BATCHES) -> DataFrame:
    """Keys of the lines found in at least ``min_docs`` documents, batch after batch through ``LineRuns``."""
    counts = written(key_counts(docs, batches), "line_counts")
    runs = LineRuns(docs.sparkSession, min_docs)
    for b in range(batches):
        runs.add(counts.filter(F.col("batch") == b).select("h1", "h2", "n"))
    return runs.frequent()


def dedup_lines(docs: DataFrame, min_docs: int = 10, **names: str) -> DataFrame:
    return drop_lines(docs, frequent_lines(docs, min_docs), **names)
