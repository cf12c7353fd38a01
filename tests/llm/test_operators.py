"""Each operator on small tables with nulls, empty texts, repeats, ties and clashing columns, against brute
force written here."""

import collections
import math
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidlake.llm import (common, components, fingerprints, language_id, line_dedup, lm_score, mixing, near_dup,
                         packing, quality_model, quality_rules, textscan, url_filters)
from vidlake.llm.queries import URL_RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, slot string"


def words(t):
    return WORD.findall((t or "").translate(LOW))


@pytest.fixture(scope="module")
def edge_rows():
    """Nulls in every column, empty and blank texts, repeats, ties, one very long text, clashing columns."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(200)] + ["É", "ß", "日本", "a b"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    rows = []
    shared = text(12)
    for i in range(60):
        t = text(rng.randint(1, 80)) + "\n" + (shared if i % 3 == 0 else text(5)) + "\n\n" + text(3)
        rows.append((i, t, "xy"[i % 2], f"s{min(i % 7, 2)}", len(t), 0.5, "x"))
    base = text(300)
    for i in range(60, 75):   # near copies
        w = base.split(" ")
        w[rng.randrange(300)] = f"new{i}"
        rows.append((i, " ".join(w), None, "s0", 0, None, None))
    rows += [(75, None, None, None, None, None, None), (76, "", "x", "s1", 0, 1.0, ""), (77, " \t\n\n ", "x", "s1", 5, 1.0, ""),
             (78, "one", "y", None, 3, 1.0, ""), (79, "One two", "y", "s1", 7, 1.0, ""), (80, "123 456 !!! ###", "y", "s1", 15, 1.0, ""),
             (None, "no id here", "x", "s1", 10, 0.1, ""), (None, None, None, None, None, None, None),
             (81, rows[3][1], "y", "s2", 1, 1.0, ""), (82, text(30_000), "x", "s0", 1, 1.0, ""),
             (83, "x" * 200_000, "x", "s0", 1, 1.0, ""), rows[5], rows[5]]
    return rows


@pytest.fixture(scope="module")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- helpers --------------------------------------------------------------------------------------------

def test_words_and_shingles_equal_plain_splitting():
    import pyarrow as pa

    texts = ["", "a", "A b\tC", None, " x  y ", "one two three four five six", "\n", "q" * 5000 + " z"]
    for limit in (1, 20, 1 << 20):
        got, sizes = [], []
        for _, _, data, offsets in textscan.chunks(pa.array(texts), limit):
            w = textscan.words_of(data, offsets)
            s = w.strings(np.arange(len(w.starts)))
            got += [s[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
            h, first = textscan.shingles(w, 4)
            sizes += [len(set(h[a:b].tolist())) for a, b in zip(first[:-1], first[1:])]
        assert got == [words(t) for t in texts]
        assert sizes == [len({tuple(words(t)[i:i + 4]) for i in range(max(1, len(words(t)) - 3))}) if words(t) else 0 for t in texts]


def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    rng = random.Random(1)
    vocabulary = {"".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(20_000)}
    _, _, data, offsets = next(textscan.chunks(pa.array([" ".join(vocabulary)])))
    assert len(set(textscan.words_of(data, offsets).hashes().tolist())) == len(vocabulary)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "empty", "nulls"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {"chain": [(i, i + 1) for i in range(300)], "star": [(0, i) for i in range(1, 200)] + [(500, 501)],
             "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(110)], "empty": [],
             "nulls": [(None, 1), (2, None), (3, 3), (4, 5), (5, 4)]}[shape]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_numbered_is_dense_within_each_key(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, None).otherwise(
        F.concat(F.lit("k"), F.col("id") % 5)).alias("k"))
    rows = common.numbered(df, "k", ["id"], 1000, group_rows=50).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.k].append(r.number)
    assert len(rows) == 1000 and all(sorted(v) == list(range(len(v))) for v in by.values())


# ---- 1 url filters --------------------------------------------------------------------------------------

def test_urls_rules_and_aliases(spark):
    link = lambda rel: f'<html><head><LINK href="{rel}" rel="canonical"></head></html>'
    fresh = lambda to: f"<meta http-equiv='refresh' content='0; url={to}'>"
    pages = [
        (1, "http://a.net/x", None), (2, "http://a.net?x", ""), (3, "https://EXAMPLE.net/en/1", ""), (4, "http://b.org/fr/2#f", ""),
        (5, "no scheme", link("http://a.net/")), (6, None, None), (7, "http://c.org/de/1", link("http://blocked.net/t")),
        (8, "http://c.org/de/2", fresh("http://c.org/de/1/")), (9, "http://c.org/de/3", link("/de/2")),
        (10, "http://d.org/1", link("http://a.net/y")), (11, "http://d.org/2", link("http://d.org/1")),
        (12, "http://d.org/2?utm_source=z", link("//x.org/fr/ok")), (13, "http://netnet/a", ""), (14, "http://x.comnet/", ""),
        (15, "https://www.example.com/de/", ""), (16, "http://lone.org/", link("")), (1, "http://a.net/x", None), (17, "://", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("verdict", F.lit("clash"))
    got = {r.page_id: r for r in url_filters.judge(df, URL_RULES).collect()}
    assert {k: (r.host, r.path, r.rule) for k, r in got.items() if k in (1, 2, 3, 4, 5, 6, 13, 14, 15, 17)} == {
        1: ("a.net", "/x", "net/"), 2: ("a.net", "", None), 3: ("example.net", "/en/1", "example.net/en/"),
        4: ("b.org", "/fr/2", "org/fr/"), 5: ("", "", None), 6: ("", "", None), 13: ("netnet", "/a", None),
        14: ("x.comnet", "/", None), 15: ("www.example.com", "/de/", "example.com/de/"), 17: ("", "", None)}
    verdicts = {k: r.verdict for k, r in got.items()}
    assert [verdicts[k] for k in (7, 8, 9)] == ["block"] * 3            # through the target, a redirect and a spelling
    assert [verdicts[k] for k in (10, 11, 12)] == ["allow"] * 3         # an explicit allow among the aliases wins
    assert verdicts[1] == "block" and verdicts[16] == "allow" and verdicts[6] == "allow"
    assert url_filters.judge(df, URL_RULES).count() == len(pages)
    assert url_filters.judge(df.limit(0), URL_RULES).count() == 0


# ---- 2 packing ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_length_once_and_fits(seed):
    rng = np.random.default_rng(seed)
    capacity = [16, 64, 1024][seed % 3]
    n = int(rng.integers(0, 3000))
    lengths = rng.integers(1, capacity + 1, n) if seed < 3 else np.minimum(capacity, 1 + rng.geometric(4 / capacity, n))
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    plan = packing.plan(counts, capacity)
    used = collections.Counter()
    for p in plan:
        assert p.times > 0 and sum(a * b for a, b in p.lengths) <= capacity
        for a, b in p.lengths:
            used[a] += b * p.times
    assert used == counts
    sequences, least = sum(p.times for p in plan), -(-int(lengths.sum()) // capacity) if n else 0
    assert least <= sequences <= (1.01 * least + 2 if seed >= 3 else 2 * least)


def test_exact_complements_are_found():
    assert sum(p.times for p in packing.plan({6: 2, 4: 2}, 10)) == 2
    assert sum(p.times for p in packing.plan({5: 1, 3: 1, 2: 1}, 10)) == 1
    assert sum(p.times for p in packing.plan({4: 1, 3: 1, 2: 1, 1: 1}, 10)) == 1


def test_pack_round_trip(spark, edge, edge_rows, none):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    expected = collections.Counter()
    for r in edge_rows:
        expected[(r[0], tuple(t.encode(r[1] or "", add_special_tokens=False).ids + [2]))] += 1
    rows = packing.pack(edge, capacity=64, keep_ids=True).collect()
    sequences = collections.defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) <= 64 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.piece == 0 or r.length == 64
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in rows)
    assert total == sum(len(k[1]) * n for k, n in expected.items()) and len(sequences) <= 1.01 * total / 64 + 2
    single = {k[0]: k[1] for k, n in expected.items() if n == 1 and k[0] not in (None, 5)}
    for doc, ids in single.items():
        mine = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert [x for r in mine for x in r.ids] == list(ids)
        assert [r.start for r in mine] == [sum(m.length for m in mine[:k]) for k in range(len(mine))]
    assert packing.pack(none).count() == 0
    ordered = packing.pack(edge.withColumn("o", F.coalesce(F.col("doc_id"), F.lit(-1))), capacity=64, order="o").collect()
    least = collections.defaultdict(lambda: 10**9)
    for r in ordered:
        least[r.sequence_id] = min(least[r.sequence_id], -1 if r.doc_id is None else r.doc_id)
    assert all(r.sequence_order == least[r.sequence_id] for r in ordered)


def test_packing_keeps_an_order_by_windows(spark, monkeypatch):
    """No sequence joins pieces from further apart than a window, and sequences follow the order."""
    monkeypatch.setattr(packing, "WINDOW", 100)
    rng = random.Random(21)
    # Late documents are long: over all rows, they would be joined with early short ones.
    rows = [(i, " ".join("ab" for _ in range(rng.randint(1, 8 if i < 300 else 100))), f"{i:06d}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, o string").repartition(5, "doc_id")
    got = packing.pack(df, capacity=64, order="o").collect()
    rank = {x: i for i, x in enumerate(sorted((r.doc_id, r.piece) for r in got))}
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((rank[r.doc_id, r.piece], r.offset, r.length, r.sequence_order, f"{r.doc_id:06d}"))
    assert sorted(sequences) == list(range(len(sequences))) and len(rank) == len(got) > 600
    firsts = []
    for k in sorted(sequences):
        parts = sequences[k]
        assert len({p[0] // 100 for p in parts}) == 1 and sum(p[2] for p in parts) <= 64
        assert {p[3] for p in parts} == {min(p[4] for p in parts)}
        firsts.append(min(p[0] for p in parts))
        at = 0
        for _, offset, length, *_ in sorted(parts, key=lambda p: p[1]):
            assert offset == at
            at += length
    assert firsts == sorted(firsts)


# ---- 3 quality model ------------------------------------------------------------------------------------

def test_trees_learn_a_rule_and_walk_alike():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 1] > 0.3) & (x[:, 3] < 0.5)).astype(float)
    model = quality_model.grow(x[:2000], y[:2000], trees=30)
    s = model.score(x[2000:])
    assert ((s > 0.5) == y[2000:]).mean() > 0.97
    one = []
    for row in x[2000:2050]:       # node by node
        margin = model.start
        for f, c, leaf in zip(model.feature, model.cut, model.leaf):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(row[f[k]] > c[k])
            margin += leaf[k - len(f)]
        one.append(1 / (1 + math.exp(-margin)))
    assert np.allclose(one, s[:50])


def test_quality_model_edges(spark, edge, edge_rows, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(70)] + [(75, None, 0), (None, 1, 0), (999, 1, 0), (3, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_model.classify(edge, labels, F.lit(True)).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality_model.classify(edge, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert quality_model.classify(none, labels, F.lit(True)).count() == 0


def test_statistics_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = ["", "a b a\na b a\n", "X! Y? | 1,2.\n\n x", "word " * 50, "é" * 10]
    together = quality_model.statistics_of(*textscan.utf8_buffers(pa.array(texts)))
    alone = np.concatenate([quality_model.statistics_of(*textscan.utf8_buffers(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone)
    assert (together[0] == 0).all()


# ---- 4 fingerprints -------------------------------------------------------------------------------------

def test_winnowing_against_a_plain_scan(spark, edge):
    """Chosen places follow the rule window by window, given the hashes that the operator itself uses."""
    df = edge.filter("doc_id < 30").select("doc_id", "text")
    got = fingerprints.with_fingerprint(df, "text", "hashes", "places")
    grams = df.select("doc_id", "text", fingerprints.units(fingerprints.words(F.coalesce("text", F.lit("")))).alias("w")).withColumn(
        "h1", F.transform("w", lambda w: F.xxhash64(w))).collect()
    two = {}

    def pair(a, b):
        two.setdefault((a, b), None)
        return (a, b)

    need = set()
    for r in grams:
        h = r.h1
        need |= {(a, b) for a, b in zip(h, h[1:])}
    table = spark.createDataFrame(list(need), "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()
    h2 = {(r.a, r.b): r.h for r in table}
    need = {(h2[r.h1[i], r.h1[i + 1]], h2[r.h1[i + 2], r.h1[i + 3]]) for r in grams for i in range(len(r.h1) - 3)}
    table = spark.createDataFrame(list(need), "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()
    h4 = {(r.a, r.b): r.h for r in table}
    expected = {}
    for r in grams:
        h = [((h4[h2[r.h1[i], r.h1[i + 1]], h2[r.h1[i + 2], r.h1[i + 3]]] % 2**64) >> 33) for i in range(len(r.h1) - 3)]
        if not h:
            continue
        places = set()
        for i in range(max(1, len(h) - 3)):
            window = list(enumerate(h))[i:i + 4]
            places.add(max(p for p, x in window if x == min(y for _, y in window)))
        expected.setdefault(r.doc_id, set()).add((tuple(sorted((h[p], p) for p in places)), tuple(sorted({h[p] for p in places}))))
    seen = collections.defaultdict(set)
    for r in got.collect():
        if r.doc_id in expected:
            seen[r.doc_id].add((tuple((p.hash, p.place) for p in r.places), tuple(r.hashes)))
    assert seen == expected and len(expected) > 25


def test_units_of_few_or_long_words_are_code_points(spark):
    texts = ["", " \t", "a bb", "a b c d e f", "a b c d e f g", "x" * 500, "日本語" * 40 + "\n" + "é😀" * 3, "w" * 32 + " " + "v" * 32,
             " ".join("z" * 32 for _ in range(9)), " ".join("z" * 34 for _ in range(9)), "word " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("text", fingerprints.units(fingerprints.words(F.col("text"))).alias("u")).collect():
        w = WORD.findall(r.text)
        few = 0 < len(w) < 7 or len(" ".join(w)) > 33 * len(w)
        assert r.u == (list(" ".join(w)) if few else w)


def test_texts_without_blanks_are_alike_by_code_points(spark):
    rng = random.Random(8)
    long = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400))
    rows = [(1, long), (2, long[:-1] + "x"), (3, long[:200] + long[:200][::-1]), (4, "big red dog"), (5, "big red dogs")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by = {r.doc_id: r for r in fingerprints.with_fingerprint(df, "text", "hashes", "places").collect()}
    like = lambda a, b: len(set(by[a].hashes) & set(by[b].hashes)) / len(set(by[a].hashes) | set(by[b].hashes))
    assert like(1, 2) > 0.95 and 0.2 < like(1, 3) < 0.8 and like(4, 5) > 0.5 and like(1, 4) == 0
    # Every shared run of seven units holds a choice of both texts, at its place in either.
    places = lambda i: {(p.place, p.hash) for p in by[i].places}
    for start in range(0, 393):
        inside = {(p, h) for p, h in places(1) if start <= p <= start + 3}
        assert inside & places(2)


def test_match_guarantee(spark):
    common_run = "one two three four five six seven"        # K + W - 1 words
    df = spark.createDataFrame([(1, "p q r " + common_run + " s t u v"), (2, common_run + " w x y z")], "doc_id long, text string")
    a, b = (set(r.hashes) for r in fingerprints.with_fingerprint(df, "text", "h").withColumnRenamed("h", "hashes").collect())
    assert a & b


def test_fingerprint_edits(spark, edge, edge_rows, none):
    rows = fingerprints.fingerprint_edits(edge).collect()
    assert len(rows) == len(edge_rows)
    ids = sorted({r[0] for r in edge_rows if r[0] is not None})
    text = {r[0]: r[1] or "" for r in edge_rows}
    for r in rows:
        if r.doc_id is None:
            continue
        own, following = text[r.doc_id], text[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        half = len(own) // 2
        assert r.n_chars == len(own)
        assert r.edited_sha256 == sha256((own[:len(own) - half] + following[:half]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[60].near_next > 0.8 and by[20].near_next < 0.3 and by[40].near_edited > by[40].near_next
    assert by[3].hashes == by[81].hashes and by[75].hashes == by[76].hashes == []
    assert all(sorted({p.hash for p in r.places}) == r.hashes and sorted({p.hash for p in r.edited_places}) == r.edited_hashes
               for r in rows)
    assert fingerprints.fingerprint_edits(none).count() == 0
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert fingerprints.fingerprint_edits(one).collect()[0].edited_sha256 == sha256(b"abab").hexdigest()


# ---- 5 quality rules ------------------------------------------------------------------------------------

def plain_statistics(t):
    t = t or ""
    w = WORD.findall(t)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = collections.Counter(grams)
    lines = [line for line in t.split("\n") if WORD.search(line)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
            len({p for i, g in enumerate(grams) if often[g] > 1 for p in range(i, i + 8)}))


def test_quality_rules(spark, edge, edge_rows, none):
    more = [(200, "a b c d e f g h " * 6, None, None, 0, None, None), (201, "the dog # " * 30, None, None, 0, None, None),
            (202, "x\nx\n\n \ny x\ny x", None, None, 0, None, None), (203, "la la " * 40, None, None, 0, None, None),
            (204, "a b c d e f g h i a b c d e f g h the cat sat on a mat", None, None, 0, None, None)]
    df = edge.unionByName(spark.createDataFrame(more, SCHEMA))
    text = {r[0]: r[1] for r in edge_rows + more}
    rows = quality_rules.judge(df).collect()
    assert len(rows) == len(edge_rows) + len(more)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_statistics(text[r.doc_id])
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert not (r.kept and r.base_failed)
    by = {r.doc_id: r for r in rows}
    assert by[200].base_failed and not by[201].kept and by[204].n_repeat_words == 16
    assert quality_rules.judge(none).count() == 0


# ---- 6 language ID --------------------------------------------------------------------------------------

def plain_profile(texts, size):
    n = collections.Counter()
    for t in texts:
        for w in re.split(r"[^\w]|[\d_]", (t or "").lower()):
            if w:
                padded = "\x01" + w + "\x01"
                n.update(w)
                n.update(padded[i:i + 2] for i in range(len(padded) - 1))
                n.update(padded[i:i + 3] for i in range(len(padded) - 2))
    key = lambda g: tuple([0] * (3 - len(g)) + [ord(c) for c in g])
    return sorted(n, key=lambda g: (-n[g], key(g)))[:size]


def test_language_profiles_and_distances_equal_plain_counting(spark):
    rng = random.Random(3)
    make = lambda letters, n: " ".join("".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(n))
    rows = [(i, make("aeiost" if i % 2 else "kqxzwy", 30) + ("!? 12" if i % 5 else ""), "pq"[i % 2]) for i in range(60)]
    rows += [(60, None, "p"), (61, "", "q"), (62, "99 ## !", "p"), (63, "Été ΣΑΩ", None), (64, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language_id.learn(df)
    texts = {x: [t for _, t, lang in rows if lang == x] for x in "pq"}
    plain = {x: plain_profile(t, 300) for x, t in texts.items()}
    unpack = lambda g: "".join(chr(c) for c in (g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF) if c)
    assert {x: [unpack(g) for g in p] for x, p in profiles.items()} == plain
    for r in language_id.identify(df, profiles).collect():
        own = plain_profile([dict((a, b) for a, b, _ in rows)[r.doc_id]], 300)
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        rank = {x: {g: i for i, g in enumerate(p)} for x, p in plain.items()}
        gap = {x: sum(abs(rank[x][g] - i) if g in rank[x] else 300 for i, g in enumerate(own)) for x in plain}
        assert r.lang_pred == min(sorted(gap), key=gap.get)
        assert abs(r.score - (1 - min(gap.values()) / (300 * len(own)))) < 1e-9


def test_language_id_edges(spark, edge, edge_rows, none):
    rows = language_id.identify_learning(edge, F.lit(True), edge.columns, ("p", "q")).collect()
    assert len(rows) == len(edge_rows)
    und = {r.doc_id for r in rows if r.p == "und"}
    assert {75, 76, 77, 80} <= und and 78 not in und
    assert {r.lang_pred for r in language_id.identify_learning(edge, F.lit(False)).collect()} == {"und"}
    assert language_id.identify_learning(none, F.lit(True)).count() == 0


# ---- 7 line dedup ---------------------------------------------------------------------------------------

def plain_line_dedup(texts, least):
    strip = " \t\n\x0b\x0c\r"
    key = lambda line: line.strip(strip).translate(LOW)
    df = collections.Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    return [[x for x in (t or "").split("\n") if not key(x) or df[key(x)] < least] for t in texts]


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_line_dedup(spark, edge, edge_rows, none, broadcast):
    frequent = line_dedup.frequent_lines(edge, 10)
    rows = line_dedup.drop_lines(edge, frequent, "a", "b", broadcast_keys=broadcast).collect()
    plain = plain_line_dedup([r[1] for r in edge_rows], 10)
    expected = collections.Counter((r[0], None if r[1] is None else "\n".join(k), len((r[1] or "").split("\n")),
                                    len((r[1] or "").split("\n")) - len(k), r[3]) for r, k in zip(edge_rows, plain))
    assert collections.Counter((r.doc_id, r.text, r.a, r.b, r.source) for r in rows) == expected
    assert any(r.b for r in rows)
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_runs_count_over_batches(spark):
    runs = line_dedup.LineRuns(spark, min_docs=5, fanout=2)
    total = collections.Counter()
    rng = random.Random(4)
    for _ in range(7):
        batch = collections.Counter(rng.randrange(40) for _ in range(30))
        total.update(batch)
        runs.add(spark.createDataFrame([(k, -k, n) for k, n in batch.items()], "h1 long, h2 long, n long"))
    assert max(len(level) for level in runs.levels) < 2 and len(runs.levels) >= 3
    assert {r.h1 for r in runs.frequent().collect()} == {k for k, n in total.items() if n >= 5}


# ---- 8 near duplicates ----------------------------------------------------------------------------------

def plain_components(rows, k, percent):
    sets = [(i, frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if (w := words(t)) else frozenset())
            for i, t in rows]
    label = {i: i for i, _ in rows}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return {i: root(i) for i in label}, sets


def test_near_duplicates(spark, edge, edge_rows, none):
    rng = random.Random(9)
    extra = []
    chain = [f"w{i}" for i in range(120)]
    for i in range(300, 312):      # a chain: neighbours are similar, the ends are not
        extra.append((i, " ".join(chain)))
        at = rng.randrange(100)
        chain[at:at + 3] = [f"c{i}{x}" for x in range(3)]
    rows = [(r[0], r[1]) for r in edge_rows if r[0] is not None] + extra
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    expected, sets = plain_components(rows, 4, 80)
    size = {i: len(s) for i, s in sets}
    got = near_dup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.component_id, r.n_shingles, r.kept) == (expected[r.doc_id], size[r.doc_id], expected[r.doc_id] == r.doc_id)
    assert len({expected[i] for i in range(60, 75)}) == 1
    assert near_dup.near_duplicates(none).count() == 0
    whole = near_dup.near_duplicates(edge).filter("doc_id is null").collect()
    assert len(whole) == 2 and not any(r.kept for r in whole)


@pytest.mark.parametrize("rounds", [0, 1])
def test_rows_without_id_are_linked_and_bridge(spark, monkeypatch, rounds):
    monkeypatch.setattr(near_dup, "STAR_ROUNDS", rounds)
    words_ = [f"w{i}" for i in range(100)]
    far = " ".join(words_[:-6] + [f"e{i}" for i in range(6)])            # like the middle one, not like the first
    first, middle = " ".join([f"b{i}" for i in range(6)] + words_[6:]), " ".join(words_)
    alone = " ".join(f"z{i}" for i in range(60))
    rows = [(5, first), (None, middle), (None, middle), (8, far), (None, alone), (None, alone + " more"), (9, "x y z w v"), (None, None)]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 5, True), (None, 5, False), (8, 5, False), (None, None, False), (9, 9, True)}


def test_a_passage_below_the_threshold_brings_no_pairs_together(spark):
    """Texts that share 85 % of their words: what they offer each other does not grow with the square of their number."""
    passage = [f"p{i}" for i in range(170)]
    met = []
    for n in (60, 240):
        rows = [(i, " ".join(passage + [f"o{i}x{j}" for j in range(30)])) for i in range(n)]
        found = near_dup.NearDuplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        left = found.classes.select("class", F.col("class").alias("comp"))
        offered, probes = found._rare_shingles(left)
        met.append(offered.join(probes.select("e"), "e").count())
        assert probes.count() >= n and found._rare_pairs(left).count() == 0
    assert met[1] <= 4 * met[0]


@pytest.mark.parametrize("rounds", [0, 1])
def test_rare_shingles_alone_find_every_link(spark, monkeypatch, rounds):
    """Texts with a long common passage share buckets without being similar; some of them are near copies."""
    monkeypatch.setattr(near_dup, "STAR_ROUNDS", rounds)
    rng = random.Random(13)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(40):
        own = [f"o{i}x{j}" for j in range(rng.choice([6, 12, 25, 40]))]
        rows.append((3 * i, " ".join(passage + own)))
        if i % 4 == 0:
            rows.append((3 * i + 1, " ".join(passage + own[:-1] + ["changed"])))
            rows.append((3 * i + 2, " ".join(["begin"] + passage + own)))
    expected, _ = plain_components(rows, 4, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()} == expected
    assert 1 < len(set(expected.values())) < len(rows)


def test_an_id_with_several_texts_joins_their_groups(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(3, a), (5, a), (5, b), (9, b)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_dup.near_duplicates(df).collect()} == {(3, 3), (5, 3), (9, 3)}


@pytest.mark.parametrize("rounds", [0, 1])
def test_a_text_and_its_continuation_at_the_threshold_are_linked(spark, monkeypatch, rounds):
    """Sizes exactly 4:5, the smaller set inside the larger: similarity exactly 0.80."""
    monkeypatch.setattr(near_dup, "STAR_ROUNDS", rounds)
    rows = []
    for n, m in ((4, 5), (80, 100), (400, 500), (79, 100), (399, 500)):
        for i in range(3):
            text = [f"t{n}x{m}x{i}x{j}" for j in range(m + 3)]
            rows += [(len(rows), " ".join(text[:n + 3])), (len(rows) + 1, " ".join(text))]
    expected, _ = plain_components(rows, 4, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()} == expected
    assert len(set(expected.values())) == len(rows) - 9


def test_a_similarity_just_over_the_threshold_is_never_ruled_out():
    """All but containment: one register shows what the smaller set has for itself."""
    _, against = near_dup.likely_jaccard(np.array([805.0, 4.0]), np.array([1000.0, 5.0]), np.array([1.0, 0.0]),
                                         np.array([25.0, 26.0]), 0.8)
    assert (against <= near_dup.RULED_OUT).all()


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[500:2500]
    sa, sb, su = (near_dup.sketch(x, np.array([0, len(x)])) for x in (a, b, pool[:2500]))
    assert (near_dup.merged(sa, sb) == su).all()
    est = near_dup.likely_jaccard(np.array([2000.0]), np.array([2000.0]), (sa > sb).sum(1).astype(float),
                                  (sa < sb).sum(1).astype(float), 0.8)
    assert abs(est[0][0] - 0.6) < 0.15 and near_dup.sketch(a, np.array([0, 0])).max() == 0


# ---- 9 mixing -------------------------------------------------------------------------------------------

@pytest.mark.parametrize(("sources", "slots"), [(1, 50), (7, 5000), (300, 20_000), (20_000, 1_000_000)])
def test_schedule_stays_within_a_block_of_its_targets(sources, slots):
    rng = np.random.default_rng(sources)
    w = rng.lognormal(0, 2, sources)
    if sources == 7:
        w = np.array([1.0, 1, 1, 2, 3, 1e-5, 0.3])
    w /= w.sum()
    last = np.ceil(slots * w).astype(int)
    found = mixing.earliest_deadline_first(w, np.zeros(sources, int), last, 0, 2 * slots + sources)
    every = np.sort(np.concatenate(found))
    assert (np.diff(every) > 0).all()
    for k, s in enumerate(found):       # a block between its release and its deadline is less than one block off
        j = np.arange(len(s))
        assert (s >= np.floor(j / w[k] - 1e-6)).all() and (s < np.ceil((j + 1) / w[k] + 1e-6)).all()


@pytest.mark.parametrize("segment", [1 << 20, 64])
def test_mix_deviates_by_less_than_its_bound(spark, segment):
    """Rows of 30 sources, hundreds of them in one, many without id; targets hold until a source runs out."""
    rng = random.Random(8)
    rows = [(rng.choice([None, i]), "hot" if i % 3 == 0 else f"s{rng.randrange(30)}", i % 5) for i in range(3000)] + [(None, None, 0)] * 50
    df = spark.createDataFrame(rows, "doc_id long, source string, _number int").repartition(4)
    n = collections.Counter(r[1] for r in rows)
    total = sum(x ** 0.5 for x in n.values())
    got = mixing.mix(df, 0.5, block=2, segment=segment).collect()
    assert sorted(((r.doc_id, r.source, r._number) for r in got), key=repr) == sorted(rows, key=repr)
    owner = {}
    for r in got:
        assert owner.setdefault(r.slot, r.source) == r.source
    assert len({(r.slot, r.place) for r in got}) == len(rows)
    until = min(-(-x // 2) / (x ** 0.5 / total) for x in n.values())      # the first source runs out
    done = collections.Counter()
    for t in range(int(until) - 1):
        done[owner.get(t, "empty")] += 1
        assert all(abs(done[s] - (t + 1) * x ** 0.5 / total) < (1 if segment > 64 else 2) for s, x in n.items())
    assert done["empty"] == 0


@pytest.mark.parametrize("name", ["row", "of", "h1", "number", "j", "near", "segment", "weight", "below", "first", "slots", "_of", "from",
                                  "_segment", "h3", "inside"])
def test_mix_passes_columns_of_any_name(spark, name):
    df = spark.createDataFrame([(i, "ab"[i % 2], f"v{i}") for i in range(20)], f"doc_id long, source string, `{name}` string")
    assert {(r.doc_id, r[name]) for r in mixing.mix(df, 0.5).collect()} == {(i, f"v{i}") for i in range(20)}


def test_mix_places_every_row_once_and_keeps_targets(spark, edge, edge_rows, none):
    rows = mixing.mix(edge, {"s0": 2.0, "s1": 1.0}, block=2, slot="m", place="n").collect()
    assert len(rows) == len(edge_rows)
    assert len({(r.m, r.n) for r in rows}) == len(rows) and {r.n for r in rows} <= {0, 1}
    by = collections.defaultdict(set)
    for r in rows:
        by[r.m].add(r.source)
    assert all(len(s) == 1 for s in by.values())
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("source"))
    order = [r.source for r in mixing.in_order(mixing.mix(many, {"a": 1, "b": 1}, block=10)).collect()]
    for t in range(10, 2000, 10):      # until b runs out after 1000 of its documents
        assert abs(order[:t].count("b") - t / 2) <= 10
    assert mixing.mix(none, 0.5, slot="m").count() == 0


# ---- 10 language model ----------------------------------------------------------------------------------

def test_bloom_levels():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2)
    counts = rng.geometric(0.2, len(h))
    seg = lm_score._segment(h, 4)
    parts = [lm_score.build_segment(h[seg == s], counts[seg == s]) for s in range(4)]
    f = lm_score.LogBloom(np.concatenate(parts), np.cumsum([0, *map(len, parts)]))
    got = f.levels(h)
    assert (got >= lm_score.level(counts)).all() and (got == lm_score.level(counts)).mean() > 0.9999
    assert (f.levels(h + np.uint64(1)) > 0).mean() < 1e-3
    low, high = lm_score.bounds_of(lm_score.level(counts))
    assert (low <= counts).all() and (counts <= high).all() and (high < 2 * low).all()


START = object()


def quantised_chances(train):
    """p(token after another), from exact counts brought to their levels: powers of two."""
    one, two = collections.Counter(), collections.Counter()
    for t in train:
        one.update(t)
        two.update(zip([START, *t], t))
    n, v = sum(one.values()), len(one)
    level = lambda c: c.bit_length()
    on = collections.defaultdict(list)
    for c in one.values():
        on[level(c)].append(c)
    mean = {k: sum(x) / len(x) for k, x in on.items()}

    def p(a, b):
        alone = (mean.get(level(one[b]), 0) + 1) / (n + v + 1)
        most = len(train) if a is START else 2 ** level(one[a]) - 1
        if not most:
            return alone
        low = 2 ** (level(two[a, b]) - 1) if two[a, b] else 0
        return lm_score.PAIRS * max(low - lm_score.DISCOUNT, 0) / most + (1 - lm_score.PAIRS) * alone

    return p


@pytest.mark.parametrize("hot", [10**6, 20, 0])
def test_lm_score(spark, edge, edge_rows, none, hot):
    learned = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    got = lm_score.score(edge, common.crc_mod(F.col("doc_id"), 7) != 2, hot_words=hot).collect()
    assert len(got) == len(edge_rows)
    c, docs = collections.Counter(), 0
    for r in edge_rows:
        if learned(r[0]):
            c.update([*words(r[1]), None])
    n, v = sum(c.values()), len(c)
    text = {r[0]: r[1] for r in edge_rows}
    for r in got:
        if r.doc_id is None:
            continue
        t = [*words(text[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[x] > 0 for x in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), abs_tol=1e-6)
        p = quantised_chances([[*words(t), None] for i, t, *_ in edge_rows if learned(i)])
        assert math.isclose(r.score, sum(math.log10(p(a, b)) for a, b in zip([START, *t], t)), rel_tol=1e-6, abs_tol=1e-6)
    assert lm_score.score(none, F.lit(True)).count() == 0
    empty = lm_score.score(edge, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in empty} == {(0, 0, 0.0, 0.0)}


def test_lm_contexts_hold_no_more_than_one(spark, edge, edge_rows):
    """Summed over all learned words and one unknown, after every learned word and at a start."""
    train = [[*words(t), None] for _, t, *_ in edge_rows]
    p = quantised_chances(train)
    known = sorted({x for t in train for x in t}, key=str)
    assert all(sum(p(v, w) for w in [*known, "never seen"]) <= 1 + 1e-9 for v in [START, *known[:80]])
    assert math.isclose(sum(p("never seen", w) for w in [*known, "another"]), 1.0, rel_tol=1e-9)


def test_lm_score_is_the_same_when_the_filter_exceeds_its_bound(spark, edge):
    learns = common.crc_mod(F.col("doc_id"), 7) != 2
    plain = lambda df: sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score)
                               for r in df.collect()))
    got, expected = (plain(lm_score.score(edge, learns, max_bytes=b)) for b in (1, lm_score.MAX_BYTES))
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-12, atol=1e-9)


# ---- links and special strings ---------------------------------------------------------------------------

def test_all_declared_links_count_and_are_resolved(spark):
    from urllib.parse import urljoin
    page = "http://a.org/x/y/z?q=1#f"
    targets = ["http://b.org/t", "//b.org/t", "/t", "t", "./t", "../t", "../../t", "../../../t", "t/../u", "?r=2", "#g", ".", "..", "../", "t/./u/"]
    got = [r.u for r in spark.createDataFrame([(page, t) for t in targets], "p string, t string").select(
        url_filters.absolute(F.col("p"), F.col("t")).alias("u")).collect()]
    want = ["http://a.org/x/y/z?q=1" if t.startswith("#") else urljoin(page, t) for t in targets]
    assert got == want
    link = lambda *hrefs: "<html>" + "".join(f'<link rel="canonical" href="{h}">' for h in hrefs)
    pages = [(1, "http://p.org/1", link("http://free.org/", "http://bad.net/2")),            # the second one is blocked
             (2, "http://p.org/a/b/2", link("../z")), (3, "http://p.org/a/z", link("http://bad.net/9")),
             (4, "http://p.org/4?v=1", link("?v=2")), (5, "http://p.org/4?v=2", '<meta http-equiv="refresh" content="0; url=http://bad.net/5">'),
             (6, "http://p.org/c/6", '<base href="http://bad.net/d/">' + link("k")), (7, "http://p.org/7", None), (8, None, link("http://bad.net/"))]
    got = url_filters.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), URL_RULES).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "block", 7: "allow", 8: "allow"}


def test_special_strings_are_their_tokens():
    import public_tokenizers
    from tokenizers import Tokenizer
    file = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(file)
    encode = packing.tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), file)
    for t in ("a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "plain text", "<|endoftext", "", "é日本 \n\t  x" * 5, "a" * 3000):
        assert encode(t) == whole.encode(t, add_special_tokens=False).ids, t[:30]
    assert 50256 in encode("a <|endoftext|> b")
