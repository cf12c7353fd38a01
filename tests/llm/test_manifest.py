"""Merkle manifest against a tree built in Python, with blocks small enough for several tiers."""

import random
import zlib
from hashlib import sha256

import pytest

from vidlake.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, hash string, rank long, size string, block int"


def H(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, source, lang, n_chars, _ = row[:5]
    fields = [str(doc_id) if doc_id is not None else None, source, lang, str(n_chars) if n_chars is not None else None, text]
    return H("-" if f is None else f"{len(f.encode())}:{f}" for f in fields)


def climb(nodes, fan=16):
    """Root of the nodes and, per node, its siblings (left, right) on each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // fan * fan:i // fan * fan + fan]
            paths[k].append(("".join(run[:i % fan]), "".join(run[i % fan + 1:])))
        nodes = [H(nodes[i:i + fan]) for i in range(0, len(nodes), fan)]
        at = [i // fan for i in at]
    return nodes[0], paths


def brute(rows, fan=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, below = [], []
    for s in order:
        rs = sorted(((r[0] is not None, r[0] or 0, leaf(r, r[4])), r) for r in groups[s])
        top, paths = climb([k[2] for k, _ in rs], fan)
        tops.append(top)
        below.append([(r, k[2], p) for (k, r), p in zip(rs, paths)])
    root, above = climb(tops, fan)
    out = []
    for top, part, up in zip(tops, below, above):
        for r, mine, path in part:
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]) if r[4] is not None else None
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            h = leaf(r, low) if bad else mine
            for a, b in path + up:
                h = H([a, h, b])
            out.append((r[0], mine, top, root, H(a + b for a, b in path + up), h, h == root))
    return out


def rows(n, seed=1):
    rng = random.Random(seed)
    made = [(i, rng.choice(["a", "a", "a", "a", "b", "B", "é", None, ""] + [f"s{j}" for j in range(20)] * (i % 3 == 0)),
             rng.choice([None, "en"]), rng.choice([None, 5]), rng.choice([None, "", "Text " * rng.randint(1, 9), "É A"]), "x", 1, "y", 2)
            for i in range(n)]
    return made + [(None, "a", None, None, None, None, None, None, None)] * 2 + made[:3] + [
        (7, "a", "fr", 1, "other text of the same id", None, None, None, None), (10**6, "alone", "en", 1, "Z" * 100_000, "", 0, "", 0)]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize(("n", "fan", "digits"), [(300, 16, 3), (300, 16, 1), (300, 2, 2), (40, 3, 1)])
def test_equals_a_tree_in_python(spark, n, fan, digits):
    df = spark.createDataFrame(rows(n), SCHEMA).repartition(5)
    tampered, where = manifest.lower_cased_fifth()
    out = manifest.manifest(df, tampered=tampered, where=where, fan=fan, digits=digits)
    assert found(out.select(*COLUMNS)) == sorted(brute(rows(n), fan), key=repr)
    assert out.filter("not verified").count() > 0


def test_small_tables(spark):
    one = spark.createDataFrame(rows(1)[:1], SCHEMA)
    got = manifest.manifest(one).first()
    assert got.leaf == got.subroot == got.root == got.folded_root and got.verified and got.proof == []
    assert got.proof_sha256 == sha256(b"").hexdigest()
    assert manifest.manifest(one.limit(0)).count() == 0


def test_a_proof_is_what_the_root_follows_from(spark):
    df = spark.createDataFrame(rows(100), SCHEMA)
    for r in manifest.manifest(df, digits=2).collect():
        h = r.leaf
        for s in r.proof:
            h = H([s.left, h, s.right])
        assert h == r.root and r.verified
