"""From raw documents to packed training sequences, five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet into the shared
scratch folder and reads it again for the next.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from vidlake.llm import language_id, line_dedup, mixing, near_dup, packing
from vidlake.llm.common import bounded_batches, fresh, small_side, table, written

# Ids of dropped copies that are sent to every worker at most; beyond, documents are joined with them.
BROADCAST_IDS = 500_000


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told (no letter) go.  Profiles are learned from all rows with a lang."""
    bounded_batches(spark)
    names = tuple(fresh(docs.columns, n) for n in ("_lang_pred", "_lang_score"))
    told = language_id.identify_learning(docs, F.lit(True), docs.columns, names)
    return told.filter(F.col(names[0]) != "und").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; n_chars follows the text."""
    bounded_batches(spark)
    lines, dropped = (fresh(docs.columns, n) for n in ("_n_lines", "_n_dropped"))
    kept = line_dedup.dedup_lines(docs, min_docs=10, n_lines=lines, n_dropped=dropped)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def document_key(doc_id: Column, text: Column) -> Column:
    """Names a row by id and text, ordered by id (ids are 64-bit numbers; rows without one come last)."""
    number = F.lpad((doc_id.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat(F.coalesce(number, F.lit("~")), F.sha2(F.coalesce(text, F.lit("")), 256))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one of the least doc_id (of rows with one id, or without any,
    the one with the least digest of its text).  Only texts count: different texts under one doc_id are apart, and a
    row without doc_id is a copy like any other.  Of rows equal in id and text one stays."""
    bounded_batches(spark)
    key = fresh(docs.columns, "_key")
    keyed = docs.withColumn(key, document_key(F.col("doc_id"), F.col("text")))
    found = written(near_dup.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), k=5, threshold=0.8)
                    .select(F.col("doc_id").alias(key), "kept"), "pipeline_kept")
    gone = found.filter(~F.col("kept")).select(key).distinct()
    several = found.filter("kept").groupBy(key).count().filter("count > 1").select(key)
    again = small_side(several, BROADCAST_IDS)
    single = keyed.join(small_side(gone, BROADCAST_IDS), key, "left_anti").join(again, key, "left_anti")
    row = F.any_value(F.struct(*docs.columns)).alias(key)
    repeated = keyed.join(again, key, "left_semi").groupBy(F.col(key).alias("of")).agg(row).select(f"{key}.*")
    return single.select(*docs.columns).unionByName(repeated)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mixture whose weights follow the root of the sources' sizes."""
    slot, place = (fresh(docs.columns, n) for n in ("_slot", "_place"))
    return mixing.in_order(mixing.mix(docs, 0.5, slot=slot, place=place), slot, place).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens, with the mixture's order of the sequences where the
    documents come from files (their order is the mixture's)."""
    bounded_batches(spark)
    try:
        ordered = docs.select("doc_id", "text", F.concat_ws(
            ":", "_metadata.file_name", F.lpad(F.col("_metadata.row_index").cast("string"), 15, "0")).alias("_order"))
    except AnalysisException:  # rows that were not read from files have no order
        return packing.pack(docs)
    return packing.pack(ordered, order="_order")


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# SQL cannot express rank-order profiles, Pfair schedules and packing; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
