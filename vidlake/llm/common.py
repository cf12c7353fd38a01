"""Shared pieces of the operators: tables, hold-out rule, scratch tables, size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vidlake.session import configure
from vidlake.session import materialize as written  # noqa: F401  the operators take it from here

# Characters that separate words: space and the controls 0x09-0x0D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Rows and bytes that go to a Python worker at once: whole texts can be long, and both sides hold a batch.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep what passes between executors and their Python workers small, whatever the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would fold every script)."""
    return F.translate(c, UPPER, LOWER)


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def fresh(names, base: str) -> str:
    """A column name like ``base`` that is not among ``names`` (compared without case)."""
    taken, name = {n.lower() for n in names}, base
    while name.lower() in taken:
        name += "_"
    return name


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether the frame has at most ``rows`` rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """The frame with a broadcast hint if it is proven to hold at most ``rows`` rows, else unhinted
    (the join then shuffles)."""
    return F.broadcast(df) if at_most(df, rows) else df


def numbered(items: DataFrame, key: str, order: Sequence[str], n: int, name: str = "number",
             group_rows: int = 200_000) -> DataFrame:
    """``items`` with ``name``, 0, 1, ... within each value of ``key``.

    Rows are numbered inside groups of (key, salt), the salt a hash of the ``order`` columns, with about
    ``group_rows`` rows if one key holds all ``n``; offsets come from the groups' counts.  So no task gets all
    rows of a key that holds a large share of them."""
    salts = max(1, -(-n // group_rows))
    items = items.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    group = F.struct(F.col(key).alias("key"), F.col("_salt").alias("salt"))
    sizes = items.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group.key").orderBy("_group.salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_group").orderBy(*order)
    return (items.withColumn("_group", group).withColumn("_inside", F.row_number().over(inside) - 1)
            .join(offsets, "_group").withColumn(name, F.col("_before") + F.col("_inside"))
            .drop("_group", "_salt", "_inside", "_before"))
