"""The registered queries of the operators and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from vidlake.llm import (fingerprints, language_id, line_dedup, lm_score, manifest, mixing, near_dup, packing, pieces,
                         prefix_trie, quality_model, quality_rules, url_filters)
from vidlake.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

URL_RULES = (
    url_filters.Rule("block", "net/"),
    url_filters.Rule("allow", "example.net/en/"),
    url_filters.Rule("block", "example.com/de/"),
    url_filters.Rule("allow", "org/fr/"),
)


def register(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn
    return add


@register("op1_url_filters")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "decided_by")


@register("op4_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_chars", "edited_sha256", fingerprints.as_text(F.col("hashes")).alias("fingerprint"),
                        fingerprints.as_text(F.col("edited_hashes")).alias("edited_fingerprint"),
                        "near_edited", "near_next", fingerprints.places_text(F.col("places")).alias("places"),
                        fingerprints.places_text(F.col("edited_places")).alias("edited_places"))


@register("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@register("op3_quality_model")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    scored = quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    found = language_id.identify_learning(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op7_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, row, place, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, row, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
        FROM (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), frequent AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (f.key IS NOT NULL) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN frequent f ON l.key = f.key GROUP BY doc_id, row
"""


@register("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op8_minhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=4, threshold=0.8)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@register("op10_lm_score")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    scored = lm_score.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op9_source_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, 0.5).select("doc_id", "source", "slot", "place")


@register("op11_sentence_pieces")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


@register("op12_prefix_trie")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9))
    return prefix_trie.trie(prefix_trie.branches(table(spark, sf_dir, "conversations"), 5, shared))


@register("op13_merkle_manifest")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered, where = manifest.lower_cased_fifth()
    rows = manifest.manifest(table(spark, sf_dir, "documents"), tampered=tampered, where=where)
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


# ---- SQL counterparts -----------------------------------------------------------------------------------

_URL_RULES_SQL = " ".join(
    f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{r.text}'"
    for r in sorted(URL_RULES, key=lambda r: -len(r.text)))
_URL_VERDICT_SQL = " ".join(f"WHEN '{r.text}' THEN '{r.verdict}'" for r in URL_RULES)


def _url_parts(column: str) -> str:
    after = f"substr({column}, strpos({column}, '://') + 3)"
    low = f"translate(regexp_extract({after}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    there = f"{column} IS NOT NULL AND strpos({column}, '://') > 0"
    return (f"CASE WHEN {there} THEN {low} ELSE '' END AS host, "
            f"CASE WHEN {there} THEN regexp_extract({after}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path")


# Aliases by spelling only: the pages of the test tables declare neither canonical links nor redirects (the
# query's tests plant some).
ORACLE["op1_url_filters"] = f"""
WITH parts AS (SELECT page_id, url, {_url_parts('url')} FROM pages),
ruled AS (
  SELECT *, CASE {_URL_RULES_SQL} END AS rule,
    CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '') || coalesce('?' || nullif(array_to_string(list_sort(
      list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(?i)(utm_[a-z0-9_]*|gclid|fbclid|ref)(=|$)'))), '&'), ''), '') END AS alias
  FROM parts),
judged AS (SELECT *, CASE rule {_URL_VERDICT_SQL} END AS own FROM ruled),
shared AS (SELECT alias, min(own) AS verdict FROM judged WHERE alias IS NOT NULL AND own IS NOT NULL GROUP BY alias)
SELECT page_id, host, path, rule, coalesce(own, verdict, 'allow') AS verdict,
       CASE WHEN own IS NOT NULL THEN 'rule' WHEN verdict IS NOT NULL THEN 'alias' ELSE 'default' END AS decided_by
FROM judged LEFT JOIN shared USING (alias)
"""

_STOPS_SQL = ", ".join(f"'{w}'" for w in sorted(
    {*quality_rules.STOP_WORDS, *(w.capitalize() for w in quality_rules.STOP_WORDS)}))


def _threshold_sql(t: quality_rules.Threshold) -> str:
    value = f"coalesce({t.numerator} / nullif({t.denominator}, 0), 0)" if t.denominator else t.numerator
    return " AND ".join([f"{value} >= {t.low}"] * (t.low is not None) + [f"{value} <= {t.high}"] * (t.high is not None))


ORACLE["op5_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT row, i, array_to_string(w[i:i + 7], ' ') AS gram
  FROM (SELECT row, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), again AS (
  SELECT row, gram FROM grams GROUP BY row, gram HAVING count(*) > 1
), covered AS (
  SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + 8)) AS place FROM grams JOIN again USING (row, gram))
  GROUP BY row
), lines AS (
  SELECT row, count(*) AS n, count(DISTINCT line) AS k FROM (SELECT row, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row
), s AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_upper,
    CAST(len(list_filter(w, lambda x: x IN ({_STOPS_SQL}))) AS BIGINT) AS n_stop_words,
    CAST(coalesce(lines.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(lines.n - lines.k, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN lines USING (row) LEFT JOIN covered USING (row)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
  AND {" AND ".join(_threshold_sql(t) for t in quality_rules.THRESHOLDS)} AS kept
FROM s
"""

ORACLE["op8_minhash_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (shingle)
                    WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id,
  doc_id = min(reach.b) AS kept
FROM reach JOIN d ON d.doc_id = reach.a LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a short ASCII text: the reflected polynomial's table, then one step a byte."""
    bit = "xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)"
    steps = f"list_reduce(list_concat([i], range(8)), lambda a, b: {bit})"
    return (f"xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), "
            f"lambda c, x: xor(c >> 8, (list_transform(range(256), lambda i: {steps}))[(xor(c, x) & 255) + 1])))")


ORACLE["op12_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(said ORDER BY k) AS turns FROM t GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, conv_id - conv_id % 5 AS first, {_crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM c
), r AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns
  FROM h LEFT JOIN c b ON b.conv_id = h.first
), p AS (
  SELECT conv_id, turns, d, turns[1:d] AS path FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, sha256(coalesce(
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = d), '')) AS ends FROM p GROUP BY path, d
), kids AS (
  SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), valued AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS kids, CASE WHEN d = 0 THEN 0 ELSE (nodes.n - 1) * strlen(nodes.path[d].t) END AS saved
  FROM nodes LEFT JOIN kids ON kids.path = nodes.path
), sums AS (
  SELECT above, count(*) FILTER (kids = 0) AS leaves, sum(saved) AS saved
  FROM (SELECT kids, saved, path[1:j] AS above FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM valued)) GROUP BY above
)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.n AS n_convs, CAST(v.kids AS BIGINT) AS n_children,
  CAST(sums.leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
FROM valued v JOIN sums ON sums.above = v.path LEFT JOIN nodes u ON v.d > 0 AND u.d = v.d - 1 AND u.path = v.path[1:v.d - 1]
"""


def _manifest_sql(leaf_levels: int = 5, source_levels: int = 4) -> str:
    """Level by level: 16^5 rows a source and 16^4 sources are enough for the test tables."""
    def digest(text: str) -> str:
        fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tables = [f"""l0 AS (
  SELECT doc_id, g, source, leaf AS h, CASE WHEN crc % 5 = 0 THEN changed ELSE leaf END AS folded,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
  FROM (SELECT *, 0 AS g, {digest('text')} AS leaf, {digest(low)} AS changed, coalesce({_crc32_sql("CAST(doc_id AS VARCHAR)")}, 1) AS crc
        FROM documents))"""]

    def level(new: str, old: str, key: str) -> str:
        return f"""{new} AS (SELECT {key}, r // 16 AS r, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY r)) END AS h,
  CASE WHEN any_value(n) > 1 THEN list(h ORDER BY r) END AS kids FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {old}) GROUP BY {key}, r // 16)"""

    for k in range(leaf_levels):
        tables.append(level(f"l{k + 1}", f"l{k}", "source"))
    tables.append(f"""s0 AS (SELECT 0 AS g, source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r FROM l{leaf_levels})""")
    for k in range(source_levels):
        tables.append(level(f"s{k + 1}", f"s{k}", "g"))
    steps = [f"l{k + 1}.source IS NOT DISTINCT FROM l0.source AND l{k + 1}.r = l0.r // {16 ** (k + 1)}" for k in range(leaf_levels)]
    joins = " ".join(f"JOIN l{k + 1} ON {s}" for k, s in enumerate(steps)) + " JOIN s0 ON s0.source IS NOT DISTINCT FROM l0.source "
    joins += " ".join(f"JOIN s{k + 1} ON s{k + 1}.r = s0.r // {16 ** (k + 1)}" for k in range(source_levels))
    at = [(f"l{k + 1}", f"(l0.r // {16 ** k}) % 16") for k in range(leaf_levels)]
    at += [(f"s{k + 1}", f"(s0.r // {16 ** k}) % 16") for k in range(source_levels)]
    path = ", ".join(f"CASE WHEN {t}.kids IS NOT NULL THEN {{'a': array_to_string({t}.kids[1:CAST({i} AS BIGINT)], ''), "
                     f"'b': array_to_string({t}.kids[CAST({i} AS BIGINT) + 2:], '')}} END" for t, i in at)
    tables.append(f"""proofs AS (SELECT l0.doc_id, l0.h AS leaf, l0.folded, s0.h AS subroot, s{source_levels}.h AS root,
  list_filter([{path}], lambda x: x IS NOT NULL) AS path FROM l0 {joins})""")
    tables.append("""folds AS (SELECT *, list_reduce(list_concat([{'a': '', 'b': '', 'x': folded}],
    list_transform(path, lambda s: {'a': s.a, 'b': s.b, 'x': ''})), lambda acc, s: {'a': '', 'b': '', 'x': sha256(s.a || acc.x || s.b)}).x AS folded_root
  FROM proofs)""")
    return "WITH " + ",\n".join(tables) + """
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(path, lambda s: s.a || s.b), ''), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM folds
"""


ORACLE["op13_merkle_manifest"] = _manifest_sql()
