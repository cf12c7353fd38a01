"""Sub-word pieces against the library itself: ids, texts, normalisation and places."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceNormalizer, SentencePieceProcessor, sentencepiece_model_pb2

from vidlake.llm import pieces
from vidlake.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a  b ", "\n\n", "a\tb\r\nc", "▁", "▁▁ ▁x", "<s> </s> <unk> <0x41>", "日本語テキスト", "éﬁⅣ ½ ａｂｃ",
       "x" * 5000, "\x00\x01\x02", "🙂🙃 👩‍👩‍👧", "  　​", "don't  stop -- 1,234.5", "ꙮ" * 30, "a\n b\n  c", "﻿bom"]


def texts(n=300):
    rng = random.Random(3)
    chars = "abcdefghij ABC   \n\t.,é日本🙂▁0123ﬁ "
    return ODD + ["".join(rng.choices(chars, k=rng.randint(0, 120))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def test_ids_and_places_equal_the_library(library):
    m = pieces.Model(PATH)
    for t in texts():
        e = m.encode(t.encode())
        assert e.ids.tolist() == library.encode(t), t
        assert m.joined(e.ids) == ",".join(map(str, library.encode(t)))
        raw = t.encode()
        if not t:
            continue
        # spans are gapless from the first to the last byte, and hold what their pieces stand for
        assert e.begin[0] == 0 and e.end[-1] == len(raw) and (e.begin[1:] == e.end[:-1]).all()
        for i, a, b in zip(e.ids.tolist(), e.begin, e.end):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                assert raw[a:b] == bytes([int(piece[3:5], 16)])
            else:
                plain = raw[a:b].decode().replace(" ", "▁")
                assert plain == piece or (a == 0 and "▁" + plain == piece)


def other_model(tmp_path, **rules):
    """The public model with another normalisation (its vocabulary is not trained anew)."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(open(PATH, "rb").read())
    fallback = rules.pop("byte_fallback", True)
    if not fallback:
        proto.trainer_spec.byte_fallback = False
        for p in proto.pieces:
            if p.type == pieces.BYTE:
                p.type = 5  # unused
    if "user" in rules:
        piece = proto.pieces.add()
        piece.piece, piece.type, piece.score = rules.pop("user"), pieces.USER, 0.0
    proto.trainer_spec.treat_whitespace_as_suffix = rules.pop("suffix", False)
    if rules.get("name"):
        n = SentencePieceNormalizer(rule_name=rules["name"])
        given = sentencepiece_model_pb2.ModelProto.FromString(n.serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = given.normalizer_spec.precompiled_charsmap
    for k in ("add_dummy_prefix", "remove_extra_whitespaces", "escape_whitespaces"):
        if k in rules:
            setattr(proto.normalizer_spec, k, rules[k])
    path = str(tmp_path / "other.model")
    open(path, "wb").write(proto.SerializeToString())
    return path


@pytest.mark.parametrize("rules", [
    {"name": "nmt_nfkc", "remove_extra_whitespaces": True}, {"name": "nfkc_cf", "remove_extra_whitespaces": False},
    {"name": "nmt_nfkc", "remove_extra_whitespaces": True, "suffix": True}, {"remove_extra_whitespaces": True},
    {"add_dummy_prefix": False}, {"user": "ab c"}, {"byte_fallback": False},
    {"name": "nmt_nfkc_cf", "byte_fallback": False, "remove_extra_whitespaces": True}])
def test_other_settings_equal_the_library(tmp_path, rules):
    path = other_model(tmp_path, **rules)
    lib, m = SentencePieceProcessor(model_file=path), pieces.Model(path)
    for t in texts(150):
        assert m.encode(t.encode()).ids.tolist() == lib.encode(t), t
        normal, place = m.normalise(t.encode())
        assert normal == lib.normalize(t), t
        assert len(place) == len(normal.encode()) + 1
        if not normal:
            continue  # nothing is left to place
        # the library gives places in characters
        expected = lib.normalize(t, with_offsets=True)[1]
        chars = [len(t.encode()[:place[len(normal[:k].encode())]].decode()) for k in range(len(normal) + 1)]
        assert chars == list(expected), t


def test_bytes_that_are_no_text():
    m = pieces.Model(PATH)
    text, place = m.normalise(b"a \xff\xc3 b\xe2\x82")
    assert text == "▁a▁��▁b��"
    assert place.tolist() == [0] * 4 + [1] * 3 + [2] * 3 + [3] * 3 + [4] * 3 + [5] + [6] * 3 + [7] * 3 + [8]
    assert m.encode(b"\xff").end[-1] == 1


def test_rows(spark, library):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts(40))] + [(None, "no id", 2, "y"), (None, None, None, None), (7, "again", 3, "z"), (7, "again", 3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, ids string").repartition(3)
    out = pieces.encode(df, keep=("ids", "begin", "end", "decoded"))
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.ids_sha256), r) for r in out.collect())
    assert len(got) == len(rows)
    digest = lambda t: sha256(",".join(map(str, library.encode(t or ""))).encode()).hexdigest()
    want = sorted(((r[0] is None, r[0] or 0, digest(r[1])), r[1] or "") for r in rows)
    for (key, r), (wanted, t) in zip(got, want):
        ids = library.encode(t)
        assert key == wanted and r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded == (library.decode(ids) if ids else "")
        assert r.decoded_sha256 == sha256(r.decoded.encode()).hexdigest()
        spans = np.array(r.begin, "<i8").tobytes() + np.array(r.end, "<i8").tobytes()
        assert r.spans_crc32 == pieces.crc32(spans)
    again = pieces.decode(out.withColumnRenamed("decoded", "first"))
    assert again.filter("first <> decoded").count() == 0 and "spans_crc32" in again.columns
    assert pieces.encode(df.limit(0)).count() == 0 and pieces.decode(out.limit(0)).count() == 0


def test_query(spark, sf_small, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()}
    out = QUERIES["op11_sentence_pieces"](spark, sf_small).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = library.encode(docs[r.doc_id])
        assert r.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == sha256((library.decode(ids) if ids else "").encode()).hexdigest()
