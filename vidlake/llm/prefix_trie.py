"""Trie of conversation prefixes by bursting (operator 12).

A turn is an id of 20 bytes (128 bits of the digest of role and text, then the text's byte length), a conversation
the chain of its turns' ids, its *path*; a prefix of depth d is the first 20 d bytes.  Equal paths become one
sequence with its members' count, least id and the digest of their ids.

The root holds all sequences.  A container of suffixes under a trie head that holds more than LIMIT sequences
*bursts*: its head stays as an inner node, and its sequences move into containers by their next turn.  Rounds
look 1, 2, 4, ... turns ahead, so a long shared beginning takes logarithmically many; sizes are counted with
partial aggregation and only the oversized prefixes (at most sequences / LIMIT on each depth) are joined back.
The remaining containers are dealt out by their prefix, sorted, and swept: a stack of open nodes follows the sorted
paths, and a node leaves it when a path departs.  At last the containers' top nodes are summed over the heads above
them.

A task holds the open nodes of one path and their closed children, at most LIMIT sequences' worth; equal
conversations never meet as such but as ranges of sorted ids, written in chunks of text that one task only
concatenates into the digest.  What must be one value is a conversation's path: 20 bytes a turn, never its texts.

Defined cases: a null role or text is empty.  Turns are ordered by number, null first, and turns of one number by
their id; repeated rows are turns of their own.  Rows without conv_id belong to no conversation and are left out.
A conversation may have no turn and is then a member of the root alone.  An empty table gives an empty result (a
root needs a member).  Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.llm.common import small_side, written

WIDTH = 20                    # bytes of a turn's id, the last four the text's length
LIMIT = 1024                  # sequences that a container holds
CHUNK = 1 << 16               # ids of equal conversations that are written together
HEADS = 500_000               # heads that are sent to every worker at most
NONE = sha256(b"").hexdigest()


def _depth(path: Column) -> Column:
    return F.call_function("div", F.octet_length(path), F.lit(WIDTH)).cast("int")


def _first(path: Column, turns: Column) -> Column:
    return F.substr(path, F.lit(1), turns * WIDTH)


def paths(conversations: DataFrame, near: Column) -> DataFrame:
    """near, conv_id, path of every conversation.  All conversations of one value of ``near`` (an expression over
    conv_id) come into one partition, in one exchange that carries ids of turns, not texts."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    size = F.lpad(F.hex(F.octet_length(text)), 8, "0")
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        near.alias("near"), "conv_id", "turn", F.concat(F.substring(said, 1, 2 * WIDTH - 8), size).alias("id"))
    turns = turns.repartition("near").groupBy("near", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("turns"))
    return turns.select("near", "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("path"))


def branches(conversations: DataFrame, every: int, shared: Column) -> DataFrame:
    """conv_id, path of every conversation c rebuilt: the first ``shared`` turns of conversation c - c % every (all
    if it has fewer, none if there is no such conversation), then its own turns after its first ``shared``."""
    first = F.col("conv_id") - F.col("conv_id") % every
    own = paths(conversations, first)
    whole = F.max(F.when(F.col("conv_id") == F.col("near"), F.col("path"))).over(Window.partitionBy("near"))
    rows = own.select("conv_id", "path", whole.alias("base"), shared.cast("int").alias("h"))
    head = F.coalesce(_first(F.col("base"), F.col("h")), F.lit(b""))
    rest = F.substr(F.col("path"), F.col("h") * WIDTH + 1, F.octet_length("path"))
    return rows.select("conv_id", F.concat(head, rest).alias("path"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (path, conv_id) rows as (path, n, least, ids) with at most CHUNK ids each."""
    path, ids = None, []

    def out():
        return pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([len(ids)], pa.int64()), pa.array([ids[0]], pa.int64()),
                                           pa.array([",".join(map(str, ids))], pa.string())], ["path", "n", "least", "ids"])

    done: list[pa.RecordBatch] = []
    for batch in batches:
        for p, c in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (p != path or len(ids) == CHUNK):
                done.append(out())
                ids = []
                if len(done) == 1000:
                    yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                    done = []
            path = p
            ids.append(c)
    if ids:
        done.append(out())
    if done:
        yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks as one row per path: (path, n, least, ends)."""
    state = None
    rows: list[tuple] = []

    def flush():
        cols = list(zip(*rows))
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["path", "n", "least", "ends"])

    for batch in batches:
        for p, n, least, ids in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "least", "ids"))):
            if state and state[0] == p:
                state[1] += n
                state[3].update(b"," + ids.encode())
                continue
            if state:
                rows.append((*state[:3], state[3].hexdigest()))
            state = [p, n, least, sha256(ids.encode())]
        if len(rows) > 1000:
            yield flush()
            rows = []
    if state:
        rows.append((*state[:3], state[3].hexdigest()))
        yield flush()


def sequences(members: DataFrame) -> DataFrame:
    """Distinct paths of (conv_id, path): path, n (members), least (id), ends (digest of the members' ids)."""
    kind = "path binary, n long, least long, "
    chunks = (members.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
              .mapInArrow(_chunks, kind + "ids string"))
    return (chunks.repartition("path").sortWithinPartitions("path", "least").mapInArrow(_digests, kind + "ends string"))


def burst(seqs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``seqs`` with ``deep``: the depth of the deepest head on the sequence's path.  Heads are the root and every
    prefix of more than ``limit`` sequences; a sequence's container hangs under its deepest head."""
    live, step, at = seqs.withColumn("deep", F.lit(0)), 1, 0
    done = []
    while True:
        further = F.when(_depth(F.col("path")) > at, F.sequence(F.lit(at + 1), F.least(F.lit(at + step), _depth(F.col("path")))))
        ahead = live.select("*", F.explode_outer(further).alias("j"))
        sizes = ahead.filter("j is not null").groupBy(_first(F.col("path"), F.col("j")).alias("key")).count()
        over = written(sizes.filter(F.col("count") > limit).select("key", _depth(F.col("key")).alias("head")), "trie_heads")
        if over.isEmpty():
            break
        deep = F.greatest(F.max("head"), F.first("deep"))
        found = written(ahead.withColumn("key", _first(F.col("path"), F.col("j"))).join(small_side(over, HEADS), "key", "left")
                        .groupBy("path").agg(F.first("n").alias("n"), F.first("least").alias("least"), F.first("ends").alias("ends"),
                                             deep.alias("deep")), "trie_burst")
        at, step = at + step, 2 * step
        done.append(found.filter(F.col("deep") < at))
        live = found.filter(F.col("deep") == at)
    for part in done:
        live = live.unionByName(part)
    return live


NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string, above binary")


class _Open:
    """A node whose subtree is not yet complete."""

    __slots__ = ("least", "n", "kids", "leaves", "saved", "ends", "size")

    def __init__(self, size: int):
        self.least, self.n, self.kids, self.leaves, self.saved, self.ends, self.size = None, 0, [], 0, 0, NONE, size

    def add(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None or least < self.least else self.least

    def row(self, depth: int) -> list:
        return [self.least, depth, None, self.n, len(self.kids), self.leaves, self.saved, self.ends, None]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers, from rows sorted by path.  A container's top has ``above``, the path of the head it hangs
    under; all other nodes have their parent's id."""
    stack: list[_Open] = []           # open nodes of one container, its top first
    path, deep = b"", 0
    rows: list[list] = []

    def close() -> None:
        node = stack.pop()
        depth = deep + 1 + len(stack)
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.size
        for kid in node.kids:
            kid[2] = node.least
        rows.extend(node.kids)
        mine = node.row(depth)
        if stack:
            over = stack[-1]
            over.add(node.n, node.least)
            over.leaves += node.leaves
            over.saved += node.saved
            over.kids.append(mine)
        else:
            mine[-1] = path[:deep * WIDTH]
            rows.append(mine)

    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
    names = [f.split()[0] for f in NODE.split(", ")]

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for p, n, least, ends, d in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "least", "ends", "deep"))):
            same = d if d == deep and p[:WIDTH * d] == path[:WIDTH * d] else -1   # turns shared with the path before
            if same >= 0:
                most = min(len(p), len(path)) // WIDTH
                while same < most and p[same * WIDTH:(same + 1) * WIDTH] == path[same * WIDTH:(same + 1) * WIDTH]:
                    same += 1
            keep = max(same - deep, 0)
            while len(stack) > keep:
                close()
            path, deep = p, d
            for k in range(d + len(stack), len(p) // WIDTH):
                stack.append(_Open(int.from_bytes(p[(k + 1) * WIDTH - 4:(k + 1) * WIDTH], "big")))
            stack[-1].add(n, least)
            stack[-1].ends = ends
        if len(rows) > 5000:
            yield flush()
            rows.clear()
    while stack:
        close()
    if rows:
        yield flush()


def trie(members: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per distinct prefix of the paths of ``members`` (conv_id, path): conv_id (least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree, what all members but one spend on
    the node's turn) and ends_sha256 (of the ids of the members that end there)."""
    seqs = written(sequences(written(members, "trie_members")), "trie_sequences")
    placed = burst(seqs, limit)
    inside = F.col("deep") < _depth(F.col("path"))
    nodes = written(placed.filter(inside).repartition(_first(F.col("path"), F.col("deep") + 1)).sortWithinPartitions("path")
                    .select("path", "n", "least", "ends", "deep").mapInArrow(_sweep, NODE), "trie_nodes")

    # what hangs under the heads: tops of containers and sequences that end at a head, for every head above
    size = F.conv(F.hex(F.substr(F.col("key"), F.octet_length("key") - 3, F.lit(4))), 16, 10).cast("long")
    at = F.explode(F.sequence(F.lit(0), _depth(F.col("key")))).alias("j")
    tops = nodes.filter(F.col("above").isNotNull()).select(
        F.col("above").alias("key"), F.col("n_convs").alias("n"), F.col("conv_id").alias("least"), F.col("n_leaves").alias("leaves"),
        F.col("saved_tokens").alias("saved"), F.lit(1).alias("kids"), F.lit(None).cast("string").alias("ends"))
    ending = placed.filter(~inside).select(F.col("path").alias("key"), "n", "least", F.lit(0).alias("leaves"), F.lit(0).alias("saved"),
                                           F.lit(0).alias("kids"), "ends")
    here = F.col("j") == _depth(F.col("key"))
    heads = written(tops.unionByName(ending).select("*", at).groupBy(_first(F.col("key"), F.col("j")).alias("key")).agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.sum(F.when(here, F.col("kids")).otherwise(0)).alias("kids"), F.max(F.when(here, F.col("ends"))).alias("ends")), "trie_heads")
    own = F.when(_depth(F.col("key")) > 0, (F.col("n") - 1) * size).otherwise(0)
    more = heads.select("key", own.alias("own"), at).groupBy(_first(F.col("key"), F.col("j")).alias("key")).agg(
        F.sum("own").alias("own"), F.sum((F.col("j") == _depth(F.col("key")) - 1).cast("int")).alias("heads"))
    heads = written(heads.join(more, "key").select(
        "key", "n", "least", F.greatest("leaves", F.lit(1)).alias("leaves"), (F.col("saved") + F.col("own")).alias("saved"),
        (F.col("kids") + F.col("heads")).alias("kids"), F.coalesce("ends", F.lit(NONE)).alias("ends")), "trie_heads")

    names = [f.split()[0] for f in NODE.split(", ")][:-1]
    known = small_side(heads.select(F.col("key").alias("above"), F.col("least").alias("parent_conv_id")), HEADS)
    top = nodes.filter(F.col("above").isNotNull()).drop("parent_conv_id").join(known, "above")
    above = F.when(F.octet_length("key") > 0, _first(F.col("key"), _depth(F.col("key")) - 1)).alias("above")
    head = heads.select(
        F.col("least").alias("conv_id"), _depth(F.col("key")).cast("long").alias("depth"), F.col("n").alias("n_convs"),
        F.col("kids").cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"), above).join(known, "above", "left")
    return (nodes.filter(F.col("above").isNull()).select(names).unionByName(top.select(names)).unionByName(head.select(names)))
