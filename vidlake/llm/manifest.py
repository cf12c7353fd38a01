"""Merkle manifest of a dataset with a proof per row (operator 13).

Every row is a leaf, the digest of its fields.  Leaves are ranked within their source, and the rank's base-16
digits become columns.  Digit columns are grouped away one after the other, lowest first: a group's child structs
are nested into their parent with the parent's digest, until a block of 16^3 ranks is one nested struct.  The
three groupings of a block share one exchange (on source and block number).  Blocks are the leaves of the next
tier, and so on until a source is one node; the sources' nodes are rolled up by the same steps as one more
group.  On the way back, each block meets the siblings above it (one row for a block, by a grouping of the two
kinds of rows, no join), and a transform over the nested struct and an explode emit every child with the siblings
of its own run on each level.

A block holds at most 4096 nested children without their texts, so no task or row grows with a source; ranks are
range-partitioned, so a source with most of the rows is cut into many slices.  Block tables are written to the
shared scratch folder, which cuts the lineage.

Defined cases: a null field is ``-`` in the digest.  Null sources are one source, ordered first; null doc_ids come
first within their source, and rows of one doc_id in the order of their digests.  Rows that repeat are leaves each
for itself.  A source with one leaf has that leaf as its node; one source alone is the root.  An empty table gives
an empty result; columns other than the named fields are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidlake.llm.common import ascii_lower, written
from vidlake.operators.ranking import row_number_within

FAN = 16
DIGITS = 3                     # levels that one block nests
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of the fields, each ``-`` if null, else byte count, colon, value."""
    as_text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in as_text)), 256)


def _digest(hashes: Column) -> Column:
    return F.sha2(F.array_join(hashes, ""), 256)


def _ranked(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``rank`` from 0 within ``group`` and ``size``, the group's number of rows."""
    ranked = row_number_within(rows, [group], order, "rank", kind="long").withColumn("rank", F.col("rank") - 1)
    sizes = ranked.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    sizes = written(sizes.select(F.col(group).alias("size_of"), "size"), "merkle_sizes")
    return ranked.join(sizes, F.col(group).eqNullSafe(F.col("size_of"))).drop("size_of")


def blocks_of(nodes: DataFrame, fan: int, digits: int) -> DataFrame:
    """One row per block (grp, size, block): the nested struct ``node`` of its children, the block's ``hash`` and the
    nodes left of the group, ``size``.

    ``nodes``: grp, size (nodes of the group), rank, hash, body (what a leaf is to emit)."""
    span = fan ** digits
    block = F.call_function("div", F.col("rank"), F.lit(span))
    level = nodes.select("grp", "size", block.alias("block"), *(
        F.pmod(F.call_function("div", F.col("rank"), F.lit(fan ** k)), F.lit(fan)).alias(f"d{k}") for k in range(digits)),
        F.struct("hash", "body").alias("node")).repartition("grp", "block")
    for k in range(digits):
        keys = ["grp", "size", "block", *(f"d{j}" for j in range(k + 1, digits))]
        level = level.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(f"d{k}").alias("digit"), "node"))).alias("kids"))
        kids = F.transform("kids", lambda c: c["node"])
        # a group of one node has reached its top: no digest on this level
        many = F.col("size") > 1
        hashes = F.transform("kids", lambda c: c["node"]["hash"])
        level = level.select(*(c for c in keys if c != "size"), F.ceil(F.col("size") / fan).cast("long").alias("size"),
                             F.struct(F.when(many, _digest(hashes)).otherwise(F.col("kids")[0]["node"]["hash"]).alias("hash"),
                                      many.alias("hashed"), kids.alias("kids")).alias("node"))
    return level.select("grp", "size", "block", F.col("node.hash").alias("hash"), "node")


def _steps(kids: Column, i: Column, hashed: Column) -> Column:
    """Siblings of child ``i`` left and right of it, or null on a level without a digest."""
    side = lambda part: F.array_join(F.transform(part, lambda c: c["hash"]), "")
    return F.when(hashed, F.struct(side(F.slice(kids, F.lit(1), i)).alias("left"),
                                   side(F.slice(kids, i + 2, F.greatest(F.size(kids) - i - 1, F.lit(0)))).alias("right")))


def children_of(blocks: DataFrame, fan: int, digits: int) -> DataFrame:
    """Every leaf of the blocks' nested structs: grp, block, rank in the block (``place``), its ``hash`` and ``body``,
    and ``path``, the siblings of its run on each level of the block from below, with ``up`` after them."""
    def below(node: Column, depth: int, path: list[Column], place: Column) -> Column:
        def one(child: Column, i: Column) -> Column:
            here = [_steps(node["kids"], i, node["hashed"]), *path]
            at = place * F.lit(fan) + i
            if depth == 1:
                return F.array(F.struct(at.alias("place"), child["hash"].alias("hash"), child["body"].alias("body"),
                                        F.filter(F.array(*here), lambda s: s.isNotNull()).alias("path")))
            return below(child, depth - 1, here, at)
        return F.flatten(F.transform(node["kids"], one))

    out = blocks.select("grp", "block", "up", F.explode(below(F.col("node"), digits, [], F.lit(0).cast("long"))).alias("leaf"))
    return out.select("grp", "block", "leaf.place", "leaf.hash", "leaf.body",
                      F.concat("leaf.path", "up.path").alias("path"), "up")


def _tiers(nodes: DataFrame, fan: int, digits: int, name: str) -> list[DataFrame]:
    """Block tables from the leaves up, until each group is one block."""
    tiers = []
    while True:
        tiers.append(written(blocks_of(nodes, fan, digits), name))
        if tiers[-1].filter("size > 1").isEmpty():
            return tiers
        nodes = tiers[-1].select("grp", "size", F.col("block").alias("rank"), "hash", F.lit(None).cast("string").alias("body"))


def _with_up(blocks: DataFrame, up: DataFrame) -> DataFrame:
    """Blocks (one row each) and what lies above them (grp, block, up), brought together by a grouping."""
    a = blocks.select("grp", "block", "node", F.lit(None).cast(up.schema["up"].dataType).alias("up"))
    b = up.select("grp", "block", F.lit(None).cast(blocks.schema["node"].dataType).alias("node"), "up")
    return a.unionByName(b).groupBy("grp", "block").agg(F.first("node", ignorenulls=True).alias("node"),
                                                       F.first("up", ignorenulls=True).alias("up"))


def _down(tiers: list[DataFrame], up: DataFrame, fan: int, digits: int) -> DataFrame:
    """Leaves of the lowest tier with all siblings above them; ``up``: grp, block (0), and the siblings above the top."""
    for k, blocks in reversed(list(enumerate(tiers))):
        leaves = children_of(_with_up(blocks, up), fan, digits)
        if k:
            up = leaves.select("grp", (F.col("block") * fan ** digits + F.col("place")).alias("block"),
                               F.struct("path", "up.subroot", "up.root").alias("up"))
    return leaves


def folded(start: Column, path: Column) -> Column:
    """The digest that ``start`` leads to with the siblings in ``path``."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "source",
             tampered: dict[str, Column] | None = None, where: Column | None = None, fan: int = FAN,
             digits: int = DIGITS) -> DataFrame:
    """key, leaf, subroot, root, proof (an array of (left, right) sibling digests from the leaf to the root),
    proof_sha256 (of those digests in that order), folded_root and verified.

    ``tampered`` replaces fields of the rows that ``where`` names before they are verified against the manifest of
    the original rows."""
    columns = [F.col(f) for f in fields]
    changed = leaf_digest([(tampered or {}).get(f, F.col(f)) for f in fields])
    rows = docs.select(F.col(key).alias("id"), F.col(group).alias("grp"), leaf_digest(columns).alias("hash"),
                       (F.when(where, changed) if where is not None else F.lit(None).cast("string")).alias("changed"))
    ranked = _ranked(rows, "grp", [F.col("id").asc_nulls_first(), F.col("hash")])
    nodes = ranked.select("grp", "size", "rank", "hash", F.struct("id", "changed").alias("body"))
    tiers = _tiers(nodes, fan, digits, "merkle_rows")
    # the sources' nodes, ordered by source, are the leaves of one more group
    tops = tiers[-1].select(F.lit(0).alias("all"), F.col("grp").alias("of"), "hash")
    tops = _ranked(tops, "all", [F.col("of").asc_nulls_first()])
    tops = _tiers(tops.select(F.col("all").alias("grp"), "size", "rank", "hash", F.struct("of").alias("body")), fan, digits, "merkle_groups")
    above = tops[-1].select("grp", "block", F.struct(
        F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.lit(None).cast("string").alias("subroot"),
        F.col("hash").alias("root")).alias("up"))
    above = _down(tops, above, fan, digits).select(F.col("body.of").alias("grp"), F.lit(0).cast("long").alias("block"), F.struct(
        "path", F.col("hash").alias("subroot"), F.col("up.root").alias("root")).alias("up"))
    out = _down(tiers, above, fan, digits).select(
        F.col("body.id").alias(key), F.col("hash").alias("leaf"), "up.subroot", "up.root", F.col("path").alias("proof"),
        F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256).alias("proof_sha256"),
        folded(F.coalesce("body.changed", "hash"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_cased_fifth(key: str = "doc_id") -> tuple[dict[str, Column], Column]:
    """The tampering of the registered query: A-Z of the texts of a fifth of the ids become lower case."""
    return {"text": ascii_lower(F.col("text"))}, F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5)) == 0
