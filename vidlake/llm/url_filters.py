"""URL filters with redirect equivalence (operator 1).

A rule is a host suffix and a path prefix with a verdict; the longest rule that fits a url decides it.  A url
that no rule fits takes the verdict of its aliases: urls joined to it by canonical links or redirects found in
the pages, directly or through others (connected components, also over targets that are no page themselves).
Among aliases an explicit allow wins over any block; without either the url is allowed.

All links that a page declares count, each resolved against the page's ``<base href>`` or url.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and has no aliases
(verdict allow).  Null html declares no links.  Repeated pages each get their row.  An empty table gives an
empty result.  Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidlake.llm.common import ascii_lower, written
from vidlake.llm.components import components

# Query parameters that only track a visit; urls differing in them are the same page.
TRACKING = r"(?i)(?:utm_[a-z0-9_]*|gclid|fbclid|ref)"


class Rule(NamedTuple):
    verdict: str   # "allow" or "block"
    text: str      # host suffix, then path prefix from the first "/"

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1] if "/" in self.text else ""


def host_of(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")),
                  ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))).otherwise("")


def path_of(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(text, verdict) of the longest fitting rule, allow before block among equals; null without one.
    The rule list is compiled into one expression."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def alias_key(url: Column) -> Column:
    """What stays the same over spellings of one address: host, path without a closing slash and the
    parameters that do not track; null without a host."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^" + TRACKING + "(=|$)")))
    host = host_of(url)
    key = F.concat(host, F.regexp_replace(path_of(url), "/+$", ""),
                   F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(host != "", key)


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved; ``..`` at the top is dropped."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: (
        F.when(p == ".", acc)
        .when((p == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .when(p == "..", acc)
        .otherwise(F.concat(acc, F.array(p)))))
    folder = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise("")
    return F.when(F.size(kept) > 0, F.concat(F.array_join(kept, "/"), folder)).otherwise("/")


def absolute(url: Column, target: Column) -> Column:
    """A link target resolved against a url: complete, without scheme, from the root, relative to the folder (with dot
    segments), a query or a fragment of the same page.  Null or blank targets give null, as does a relative target
    if the url itself is none."""
    t = F.trim(F.regexp_replace(target, "&amp;", "&"))
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*((?:/(?:[^?#]*/)?)?)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    page = F.regexp_extract(url, r"(?s)^([^?#]*)", 1)
    whole = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    complete = t.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://")
    joined = (F.when(complete, t)
              .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t))
              .when(t.startswith("#"), whole)
              .when(t.startswith("?"), F.concat(page, t))
              .when(t.startswith("/"), F.concat(origin, t))
              .otherwise(F.concat(origin, folder, t)))
    head = F.regexp_extract(joined, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(joined, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(joined, r"(?s)^[^?#]*(.*)$", 1)
    dotted = path.rlike(r"(^|/)\.\.?(/|$)")
    return (F.when(t == "", None).when(~complete & ~F.contains(url, F.lit("://")), None)
            .when(dotted, F.concat(head, without_dots(path), tail)).otherwise(joined))


def declared_links(html: Column) -> Column:
    """Targets of all canonical links and meta refreshes of a page, as written (null for null html)."""
    def targets(tags: str, target: str) -> Column:
        found = F.regexp_extract_all(html, F.lit(tags), F.lit(0))
        return F.filter(F.transform(found, lambda t: F.regexp_extract(t, target, 1)), lambda t: t != "")
    return F.concat(targets(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"),
                    targets(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"))


def base_of(url: Column, html: Column) -> Column:
    """What relative targets of a page are resolved against: its first ``<base href>``, else its url."""
    tag = F.regexp_extract(html, r"(?is)<base\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    return F.coalesce(absolute(url, tag), url)


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, url, host, path, rule, verdict, decided_by (``rule``, ``alias`` or ``default``) per page."""
    found = rule_of(F.col("host"), F.col("path"), rules)
    seen = written(
        pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                     alias_key(F.col("url")).alias("key"),
                     base_of(F.col("url"), F.col("html")).alias("base"), declared_links(F.col("html")).alias("declared"))
        .withColumn("links", F.when(F.col("host") != "", F.transform("declared", lambda t: absolute(F.col("base"), t))))
        .drop("base", "declared").withColumn("fit", found), "url_pages")
    targets = (seen.select("key", F.explode("links").alias("target")).filter("target is not null")
               .select("key", alias_key(F.col("target")).alias("other"), host_of(F.col("target")).alias("host"),
                       path_of(F.col("target")).alias("path"))
               .filter("other is not null").withColumn("fit", found))
    group_of = components(targets.select("key", "other"), "key", "other")
    named = (seen.select("key", "fit").unionByName(targets.select(F.col("other").alias("key"), "fit"))
             .filter("key is not null and fit is not null")
             .groupBy("key").agg(F.min("fit.verdict").alias("verdict")))       # allow sorts before block
    decided = (named.join(group_of.withColumnRenamed("node", "key"), "key", "left")
               .groupBy(F.coalesce("component", "key").alias("group")).agg(F.min("verdict").alias("alias_verdict")))
    return (seen.join(group_of.withColumnRenamed("node", "key"), "key", "left")
            .withColumn("group", F.coalesce("component", "key"))
            .join(decided, "group", "left")
            .select("page_id", "url", "host", "path", F.col("fit.text").alias("rule"),
                    F.coalesce("fit.verdict", "alias_verdict", F.lit("allow")).alias("verdict"),
                    F.when(F.col("fit").isNotNull(), "rule").when(F.col("alias_verdict").isNotNull(), "alias")
                    .otherwise("default").alias("decided_by")))
