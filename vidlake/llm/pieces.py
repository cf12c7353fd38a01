"""Sub-word encoding and decoding with the place of every piece in the original text (operator 11).

A text becomes ids in two steps.  *Normalisation*: from left to right, the longest source string of the model's
compiled character map that fits is replaced (a character outside the map stays as it is), runs of spaces are
squeezed and the word mark is set as the model's settings say; for every normalised byte the place of the
original byte it came from is recorded.  *Segmentation*: the normalised text is split into the model's pieces by
the public library, with a copy of the model whose own normalisation is switched off.  A piece's normalised
bytes, looked up in the recorded places, give its span of original UTF-8 bytes.

Everything runs per row in ``mapInArrow``: no shuffle, a worker holds the ids and places of one text at a time.

Defined cases: a null or empty text has no piece.  Bytes that are not UTF-8 count as U+FFFD, one for each byte.
Texts of any length are encoded whole.  Rows that repeat, also with a null doc_id, are encoded each for itself;
an empty table gives an empty result; further columns are not read, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vidlake.llm.textscan import slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"               # the word mark that stands for a space
UNKNOWN, USER, BYTE = 2, 4, 6      # fixed values of the model format: kinds of pieces


class Encoded(NamedTuple):
    """One text: ids, and the original bytes [begin, end) of every piece."""

    ids: np.ndarray
    begin: np.ndarray
    end: np.ndarray


class CharacterMap:
    """The compiled map of a model: a double array of 32-bit units over source bytes, whose leaves are places in
    a block of zero-terminated replacements."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.block = compiled[4 + size:]

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes of the longest source string at ``at`` and its replacement."""
        units, found = self.units, None
        if not units:
            return None
        place = self._child(units[0])
        for n, byte in enumerate(raw[at:at + 256], 1):
            place ^= byte
            unit = units[place]
            if unit & 0x800000FF != byte:
                break
            place ^= self._child(unit)
            if unit >> 8 & 1:
                found = n, units[place] & 0x7FFFFFFF
        if not found:
            return None
        return found[0], self.block[found[1]:self.block.index(0, found[1])]


class Model:
    """A model file, opened in a worker."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as f:
            proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        rules = proto.normalizer_spec
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.squeeze, self.escape = rules.remove_extra_whitespaces, rules.escape_whitespaces
        self.before = rules.add_dummy_prefix and not proto.trainer_spec.treat_whitespace_as_suffix
        self.after = rules.add_dummy_prefix and proto.trainer_spec.treat_whitespace_as_suffix
        self.space = MARK.encode() if self.escape else b" "
        self.user = sorted((p.piece.encode() for p in proto.pieces if p.type == USER), key=len, reverse=True)
        self.plain = not (self.map.units or self.user or self.squeeze)
        self.size = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.unknown = next((i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN), -1)
        self.whole = SentencePieceProcessor(model_file=path)
        rules.precompiled_charsmap, rules.remove_extra_whitespaces = b"", False
        rules.add_dummy_prefix = rules.escape_whitespaces = False
        self.split = SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.decimals = [str(i) for i in range(len(self.size))]

    def normalise(self, raw: bytes) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the place in ``raw``."""
        if not raw:
            return "", np.zeros(1, np.int64)
        if self.plain:
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                return self._replaced(raw)
            if not self.escape:
                wide = np.ones(len(raw), np.int64)
            else:
                text = text.replace(" ", MARK)
                wide = np.where(np.frombuffer(raw, np.uint8) == 32, len(self.space), 1)
            place = np.repeat(np.arange(len(raw), dtype=np.int64), wide)
            mark = self.space.decode()
            edge = [len(raw)] * (1 + len(self.space) * self.after)
            return (mark * self.before + text + mark * self.after,
                    np.concatenate([np.zeros(len(self.space) * self.before, np.int64), place, edge]))
        return self._replaced(raw)

    def _prefix(self, raw: bytes, at: int) -> tuple[int, bytes]:
        """How many bytes at ``at`` are taken together, and what stands for them."""
        for u in self.user:
            if raw.startswith(u, at):
                return len(u), u
        found = self.map.longest(raw, at)
        if found:
            return found
        lead = raw[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        one = raw[at:at + n]
        try:
            one.decode()
            return n, one
        except UnicodeDecodeError:
            return 1, b"\xef\xbf\xbd"

    def _replaced(self, raw: bytes) -> tuple[str, np.ndarray]:
        out, place, at = [], [], 0

        def put(piece: bytes) -> None:
            out.append(piece)
            place.extend([at] * len(piece))

        taken = []
        while at < len(raw):
            n, new = self._prefix(raw, at)
            taken.append((at, new))
            at += n
        ends = [a for a, _ in taken[1:]] + [len(raw)]
        if self.squeeze:
            first = next((k for k, (_, new) in enumerate(taken) if new != b" "), len(taken))
            taken, ends = taken[first:], ends[first:]
            if not taken:
                return "", np.array([len(raw)], np.int64)
        at = taken[0][0]
        if self.before:
            put(self.space)
        blank = self.squeeze
        for at, new in taken:
            if blank:
                new = new.lstrip(b" ")
            if new:
                blank = self.squeeze and new.endswith(b" ")
                put(new.replace(b" ", self.space) if self.escape else new)
        text, last = b"".join(out), ends[-1]
        while self.squeeze and text.endswith(self.space):
            text = text[:-len(self.space)]
            last = place[len(text)]
        at = last
        del place[len(text):]
        if self.after:
            text += self.space
            place.extend([last] * len(self.space))
        return text.decode("utf-8", "replace"), np.array([*place, last], np.int64)

    def _widths(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes of every piece; an unknown piece is as wide as what it stands for."""
        if not (ids == self.unknown).any():
            return self.size[ids]
        pieces = self.split.encode(text, out_type=str)
        return np.array([len(p.encode()) if i == self.unknown else self.size[i] for i, p in zip(ids, pieces)], np.int64)

    def encode(self, raw: bytes, spans: bool = True) -> Encoded:
        none = np.zeros(0, np.int64)
        text, place = self.normalise(raw)
        if not text:
            return Encoded(none.astype(np.int32), none, none)
        ids = self.split.encode_as_numpy(text)
        if not spans:
            return Encoded(ids, none, none)
        end = place[np.cumsum(self._widths(text, ids))]
        return Encoded(ids, np.concatenate([place[:1], end[:-1]]), end)

    def joined(self, ids: np.ndarray) -> str:
        """The ids as decimals joined by commas."""
        return ",".join([self.decimals[i] for i in ids.tolist()])


def encode(docs: DataFrame, model: str | None = None, spans: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256, spans_crc32 (of begin and end
    of every piece as little-endian 64-bit numbers, all begins first) of every text.

    ``keep`` names what is returned itself as well: ``ids``, ``begin`` and ``end`` (bytes of the original text),
    ``decoded``."""
    path = model or public_tokenizers.path(MODEL)
    numbers = T.ArrayType(T.LongType())
    kinds = {"ids": T.ArrayType(T.IntegerType()), "begin": numbers, "end": numbers, "decoded": T.StringType()}
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType()), T.StructField("spans_crc32", T.LongType()),
                           *(T.StructField(k, kinds[k]) for k in keep)])
    arrow = {"ids": pa.list_(pa.int32()), "begin": pa.list_(pa.int64()), "end": pa.list_(pa.int64()), "decoded": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(path)
        for batch in slices(batches, 200):
            n, ids_sha, decoded_sha, crc = [], [], [], []
            kept = {k: [] for k in keep}
            for text in batch.column("text").cast(pa.binary()):
                e = m.encode(text.as_py() or b"", spans)
                decoded = m.whole.decode(e.ids) if len(e.ids) else ""
                n.append(len(e.ids))
                ids_sha.append(sha256(m.joined(e.ids).encode()).hexdigest())
                decoded_sha.append(sha256(decoded.encode()).hexdigest())
                crc.append(crc32(e.end.astype("<i8").tobytes(), crc32(e.begin.astype("<i8").tobytes())) if spans else None)
                for k in keep:
                    kept[k].append(decoded if k == "decoded" else getattr(e, k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string()),
                 pa.array(crc, pa.int64()), *(pa.array(kept[k], arrow[k]) for k in keep)], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", name: str = "decoded", model: str | None = None) -> DataFrame:
    """``encoded`` with the text of its ``ids`` column; null or no ids give the empty text."""
    path = model or public_tokenizers.path(MODEL)
    schema = T.StructType([f for f in encoded.schema if f.name != name] + [T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(path).whole
        for batch in slices(batches, 200):
            texts = [m.decode(x) if x else "" for x in (x.as_py() for x in batch.column(ids))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema.names[:-1]), pa.array(texts, pa.string())],
                                             schema.names)

    return encoded.mapInArrow(run, schema)
