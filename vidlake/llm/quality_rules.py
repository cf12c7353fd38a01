"""Quality rules as one Spark projection (operator 5).  DataFrame functions only.

Statistics of a text are array and string expressions; a table of thresholds over ratios of them is compiled
into one boolean expression.  Words are runs of characters other than 0x20 and 0x09-0x0D.

Defined cases: a null or empty text has all counts 0 and fails the base rule (fewer than 20 words).  Ratios
over nothing count as 0.  Repeated rows are judged each for itself; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidlake.llm.common import BLANK_CLASS, BLANKS, UPPER

SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "by", "this",
    "are", "or", "from", "at", "an", "not",
    "der", "die", "das", "und", "ist", "von", "den", "zu", "mit", "sich", "auf", "ein", "eine", "nicht", "als", "dem",
    "für", "im", "auch", "es",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "est", "que", "qui", "dans", "pour", "par", "en", "au",
    "sur", "pas", "il", "elle",
    "el", "los", "las", "y", "se", "del", "por", "con", "no", "su", "lo", "para",
)


class Threshold(NamedTuple):
    """Keep a text only if low <= numerator / denominator <= high (ratio 0 where the denominator is 0)."""

    numerator: str
    denominator: str | None
    low: float | None
    high: float | None


THRESHOLDS: tuple[Threshold, ...] = (
    Threshold("word_chars", "n_words", 2.0, 14.0),        # mean word length
    Threshold("n_symbols", "n_words", None, 0.25),        # markup and table debris
    Threshold("n_upper", "word_chars", None, 0.5),        # shouting
    Threshold("n_dup_lines", "n_lines", None, 0.5),       # the same lines over and over
    Threshold("n_stop_words", "n_words", 0.01, None),     # running prose has function words
)


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK_CLASS + "+"), lambda w: w != "")


def _shifted_pairs(name: str, step: int) -> Column:
    """Hash of element i with element i + step: doubles the number of words a hash covers."""
    a = F.col(name)
    return F.transform(F.slice(a, F.lit(1), F.greatest(F.size(a) - step, F.lit(0))),
                       lambda x, i: F.xxhash64(x, F.get(a, i + step)))


def _same_hash(x: Column, other: Column) -> Column:
    return F.coalesce(x["h"] == other["h"], F.lit(False))


def text_statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper and
    n_stop_words of each whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*keep, t.alias("_t"))
    stops = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    df = df.select(*keep, "_t", words(F.col("_t")).alias("_w"), F.split("_t", "\n").alias("_l"),
                   F.char_length(F.translate("_t", BLANKS, "")).alias("word_chars"))
    df = df.select(
        *keep, "_w", F.size("_w").alias("n_words"), "word_chars",
        (F.char_length("_t") - F.char_length(F.translate("_t", SYMBOLS, ""))).alias("n_symbols"),
        (F.char_length("_t") - F.char_length(F.translate("_t", UPPER, ""))).alias("n_upper"),
        F.size(F.filter("_w", lambda w: w.isin(stops))).alias("n_stop_words"),
        F.filter("_l", lambda line: F.translate(line, BLANKS, "") != "").alias("_l"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h1"))
    df = df.withColumn("n_lines", F.size("_l")).withColumn("n_dup_lines", F.size("_l") - F.size(F.array_distinct("_l")))
    df = df.withColumn("_h2", _shifted_pairs("_h1", 1)).withColumn("_h4", _shifted_pairs("_h2", 2))
    df = df.withColumn("_h8", _shifted_pairs("_h4", 4))
    # Windows that occur more than once: neighbours with the same hash after sorting (hash, place).
    some = F.size(F.array_distinct("_h8")) < F.size("_h8")
    df = df.withColumn("_s", F.when(some, F.array_sort(F.transform(
        "_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_s")
    df = df.withColumn("_p", F.array_sort(F.transform(
        F.filter(s, lambda x, i: _same_hash(x, F.get(s, i - 1)) | _same_hash(x, F.get(s, i + 1))), lambda x: x["i"])))
    p = F.col("_p")
    # Words covered by the union of the windows at those places.
    covered = F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                          F.lit(0), lambda a, x: a + x)
    return df.select(*keep, *(F.col(c).cast("long").alias(c) for c in
                              ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_upper", "n_stop_words")),
                     F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def verdict(thresholds: Sequence[Threshold] = THRESHOLDS) -> Column:
    """The threshold table as one boolean expression."""
    passed = F.lit(True)
    for t in thresholds:
        value = F.col(t.numerator)
        if t.denominator:
            value = F.coalesce(value / F.nullif(F.col(t.denominator), F.lit(0)), F.lit(0.0))
        if t.low is not None:
            passed = passed & (value >= t.low)
        if t.high is not None:
            passed = passed & (value <= t.high)
    return passed


def judge(docs: DataFrame, thresholds: Sequence[Threshold] = THRESHOLDS) -> DataFrame:
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (text_statistics(docs).withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & verdict(thresholds)))
