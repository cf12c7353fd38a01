"""Document fingerprints by winnowing (operator 4).  DataFrame functions only.

A text's units are its words, or, where it has fewer than K + W - 1 words or words of over LONG_WORD code points
on average (scripts without blanks, unbroken strings), the code points of its words joined by single blanks.
Every run of K units is hashed (hashes of 1, 2 and 4 units by pairwise combination), and of every W
consecutive hashes the least is chosen, the rightmost among equals.  A hash and its place are packed in one
long, the place complemented, so the least of the longs is that choice; window minima come from two passes
that each double the window.  Two texts of one kind of unit that share at least K + W - 1 units in a row share a
chosen hash, and the places kept beside the hashes say where.

Defined cases: a null text is the empty text, with an empty fingerprint.  Fewer than K units make one hash of
the whole sequence; fewer than W hashes make one window.  The likeness of two fingerprints is the Jaccard
index of their hash sets, 1 for two empty ones.  Rows that repeat a doc_id share one place in the order of
documents; their next document is the next greater id (its row of least text hash, should it repeat; after
the greatest id, the least).  A row without doc_id has no next document: the empty text stands for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidlake.llm.common import written
from vidlake.llm.quality_rules import _shifted_pairs, words

K, W = 4, 4
LONG_WORD = 32
_PLACES = 2**31 - 1


def _shifted_least(name: str, step: int) -> Column:
    a = F.col(name)
    return F.transform(F.slice(a, F.lit(1), F.greatest(F.size(a) - step, F.lit(0))),
                       lambda x, i: F.least(x, F.get(a, i + step)))


def units(w: Column) -> Column:
    """The units of a text with the words ``w``: the words, or code points where words are few or very long."""
    joined = F.array_join(w, " ")
    plain = (F.size(w) == 0) | ((F.size(w) >= K + W - 1) & (F.char_length(joined) <= (LONG_WORD + 1) * F.size(w)))
    return F.when(plain, w).otherwise(F.split(joined, ""))


def with_fingerprint(df: DataFrame, text: str, hashes: str, places: str | None = None) -> DataFrame:
    """``df`` with the sorted distinct chosen hashes (ints) of ``text`` and, if named, every choice with its place:
    structs (hash, place), sorted, the place a number of units from 0."""
    kept = df.columns
    df = df.select(*kept, words(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
    df = df.select(*kept, units(F.col("_words")).alias("_w"))
    df = df.select(*kept, "_w", F.transform("_w", lambda w: F.xxhash64(w)).alias("_h1"))
    df = df.select(*kept, "_w", _shifted_pairs("_h1", 1).alias("_h2"))
    df = df.select(*kept, "_w", _shifted_pairs("_h2", 2).alias("_h4"))
    grams = (F.when(F.size("_w") >= K, F.col("_h4"))
             .when(F.size("_w") > 0, F.array(F.xxhash64("_w"))).otherwise(F.array().cast("array<bigint>")))
    df = df.select(*kept, F.transform(grams, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 33), 31)
                                      .bitwiseOR(F.lit(_PLACES) - i)).alias("_m1"))
    df = df.select(*kept, "_m1", _shifted_least("_m1", 1).alias("_m2"))
    df = df.select(*kept, "_m1", _shifted_least("_m2", 2).alias("_m4"))
    chosen = (F.when(F.size("_m4") > 0, F.array_distinct("_m4"))
              .when(F.size("_m1") > 0, F.array(F.array_min("_m1"))).otherwise(F.col("_m1")))
    df = df.select(*kept, F.sort_array(F.transform(chosen, lambda x: x.bitwiseXOR(F.lit(_PLACES)))).alias("_c"))
    out = [F.array_distinct(F.transform("_c", lambda x: F.shiftright(x, 31).cast("int"))).alias(hashes)]
    if places:
        out.append(F.transform("_c", lambda x: F.struct(
            F.shiftright(x, 31).cast("int").alias("hash"),
            x.bitwiseAND(F.lit(_PLACES)).cast("int").alias("place"))).alias(places))
    return df.select(*kept, *out)


def likeness(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        shared / (F.size(a) + F.size(b) - shared))


def as_text(hashes: Column) -> Column:
    """Eight hex digits for each hash (31 bits, raised by 2^31 so that none is shorter)."""
    return F.array_join(F.transform(hashes, lambda x: F.hex(x.cast("long") + F.lit(2**31))), "")


def places_text(places: Column) -> Column:
    """The places of the choices in the order of their hashes (that of the fingerprint), joined by commas."""
    return F.array_join(F.transform(places, lambda x: x["place"].cast("string")), ",")


def next_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, prev_id, need, pick) per distinct id: the id before it in ascending order (for the least, the
    greatest), the code points which that one's rows replace at most, and the hash of the text that stands for
    the id.  Ids are range-partitioned; a window inside each partition and one over the partitions' ends find
    the neighbours, so no task sees all ids."""
    t = F.coalesce(F.col("text"), F.lit(""))
    ids = (docs.filter("doc_id is not null").select("doc_id", F.xxhash64(t).alias("h"),
                                                    F.floor(F.char_length(t) / 2).alias("half"))
           .groupBy("doc_id").agg(F.min("h").alias("pick"), F.max("half").alias("half")))
    ids = written(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "fp_ids")
    ends = ids.groupBy("part").agg(F.max(F.struct("doc_id", "half")).alias("last"))
    everything = Window.partitionBy(F.lit(0))
    ends = ends.select("part", F.coalesce(F.lag("last").over(everything.orderBy("part")),
                                          F.max("last").over(everything)).alias("before"))
    inside = F.lag(F.struct("doc_id", "half")).over(Window.partitionBy("part").orderBy("doc_id"))
    return (ids.withColumn("inside", inside).join(ends, "part")
            .withColumn("prev", F.coalesce("inside", "before"))
            .select("doc_id", F.col("prev.doc_id").alias("prev_id"), F.col("prev.half").alias("need"), "pick"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, hashes, edited_hashes, places, edited_places, near_edited, near_next per row of
    ``docs``.

    Texts alone are shuffled, once, by doc_id (both joins read that exchange); the next document sends on only the
    prefix that is needed, and its hashes.  Fingerprints are made behind the exchange, so neither they nor their
    places travel with the texts."""
    ids = next_ids(docs)
    plain = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    own = plain.filter("doc_id is not null")
    # pick is the least hash of the id, so <= finds it; as an equality it would become a join key, and the two
    # reads of the exchange of texts would differ.
    picked = own.join(ids, "doc_id").filter(F.xxhash64("text") <= F.col("pick"))
    follower = (with_fingerprint(picked.select("prev_id", "need", "text"), "text", "next_hashes")
                .select(F.col("prev_id").alias("doc_id"), F.expr("substring(text, 1, need)").alias("next_text"), "next_hashes")
                .dropDuplicates(["doc_id"]))
    joined = own.join(follower, "doc_id").unionByName(plain.filter("doc_id is null").withColumns(
        {"next_text": F.lit(""), "next_hashes": F.array().cast("array<int>")}))
    edited = F.expr("concat(substring(text, 1, int(n_chars - floor(n_chars / 2))), "
                    "substring(next_text, 1, int(floor(n_chars / 2))))")
    found = with_fingerprint(joined.withColumn("n_chars", F.char_length("text").cast("long")), "text", "hashes", "places")
    found = found.select("doc_id", "n_chars", "hashes", "places", edited.alias("edited"),
                         likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
    found = with_fingerprint(found.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_hashes", "edited_places")
    return found.withColumn("near_edited", likeness(F.col("hashes"), F.col("edited_hashes"))).drop("edited")
