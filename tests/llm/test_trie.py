"""Conversation trie against prefixes counted in Python, with containers small enough to burst."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from vidlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, path string, n string"


def turns(seed=2, n=90):
    rng = random.Random(seed)
    first = [[("user", f"hello {i}"), ("assistant", "é" * i), ("user", "")] for i in range(3)]
    made = []
    for c in range(n):
        said = list(first[rng.choice([0, 0, 0, 1, 2])][:rng.randint(0, 3)])
        said += [(rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", None, "", f"t{rng.randint(0, 3)}"]))
                 for _ in range(rng.randint(0, 5))]
        made += [(c, k if k else None, r, t) for k, (r, t) in enumerate(said)]
    for c in range(200, 215):   # equal conversations, and one that shares a long beginning
        made += [(c, k, "user", f"same {k}") for k in range(40 + (c == 214))]
    made += [(300, 1, "user", "a"), (300, 1, "user", "a"), (None, 1, "user", "lost"), (300, None, None, None)]
    return [(*m, 1, "p", "n") for m in made]


def brute(rows, members=None):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + said[h:]
    nodes = {}
    for c, said in built.items():
        for d in range(len(said) + 1):
            nodes.setdefault(tuple(said[:d]), []).append(c)
    out = []
    for p, who in nodes.items():
        sub = [q for q in nodes if q[:len(p)] == p]
        kids = lambda q: sum(len(x) == len(q) + 1 and x[:len(q)] == q for x in nodes)
        ends = sorted(c for c in who if len(built[c]) == len(p))
        out.append((min(who), len(p), min(nodes[p[:-1]]) if p else None, len(who), kids(p), sum(kids(q) == 0 for q in sub),
                    sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in sub if q),
                    sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def shared():
    return F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [1, 3, 20, 1024])
def test_equals_counted_prefixes(spark, limit, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    df = spark.createDataFrame(turns(), SCHEMA).repartition(4)
    out = prefix_trie.trie(prefix_trie.branches(df, 5, shared()), limit)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert found(out) == brute(turns())


def test_containers_hold_no_more_than_their_limit(spark):
    df = spark.createDataFrame(turns(), SCHEMA)
    seqs = prefix_trie.sequences(prefix_trie.branches(df, 5, shared()))
    placed = prefix_trie.burst(seqs, 5).withColumn("d", F.expr("octet_length(path) div 20"))
    assert placed.count() == seqs.count()
    inside = placed.filter("deep < d").groupBy(F.expr("substr(path, 1, (deep + 1) * 20)")).count()
    assert inside.agg(F.max("count")).first()[0] <= 5


def test_rows_without_turns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(prefix_trie.branches(none, 5, shared())).count() == 0
    # a conversation that keeps none of its turns is a member of the root alone
    df = spark.createDataFrame([(c, 0, "user", "x", 0, "", "") for c in (6, 7, 8, 9)], SCHEMA)
    out = prefix_trie.trie(prefix_trie.branches(df, 5, F.lit(3)))
    assert found(out) == [(6, 0, None, 4, 0, 1, 0, sha256(b"6,7,8,9").hexdigest())]
