"""SentencePiece encoding and decoding with byte spans.

The text is first normalised by longest-prefix matching through the model's compiled character map (a
double-array trie); for every normalised byte the source byte is recorded, so that each piece of the
segmentation is projected to a span of the original UTF-8 text. The library segments the normalised
text, with the model's own normaliser switched off.

Defined results: a null text counts as empty; an empty text has the end id only. Only the id and text columns
are read, so other columns of any name do no harm. Rows are handled one by one: order, ties, copies and very
long texts need nothing special, an empty table gives an empty result. The model file is a parameter.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from recolith.llm.runtime import small_batches, trimmed

MARK = "▁"
#: Texts, and bytes of text but for the last, that are encoded before a batch of results leaves.
BATCH_TEXTS, BATCH_BYTES = 256, 1 << 20


class CharMap:
    """The compiled character map of a model: size of the trie, its units, then the replacement strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist() if size else []
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest prefix of data[at:] that the trie holds, and its replacement."""
        units, found = self.units, None
        if not units:
            return None
        node = 0
        node ^= (units[0] >> 10) << ((units[0] & 512) >> 6)
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = k + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]


class Encoding:
    """Ids and, for each, the first and end byte of its source in the original text."""

    __slots__ = ("ends", "ids", "starts")

    def __init__(self, ids: list[int] | np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.ids, self.starts, self.ends = ids, starts, ends


class PieceEncoder:
    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        user = sorted((p.piece for p in proto.pieces if p.type == 4), key=len, reverse=True)
        self.user = re.compile("|".join(map(re.escape, user)).encode()) if user else None
        self.plain = not self.map.units and not self.squeeze and not self.user and self.escape and self.dummy and not self.suffix
        self.fallback = proto.trainer_spec.byte_fallback
        self.width = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces])
        self.names = [str(i) for i in range(len(proto.pieces))]
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec.Clear()
        spec.name, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = "identity", False, False, False
        self.raw = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.eos, self.unk = self.whole.eos_id(), self.whole.unk_id()

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the byte of the original."""
        data = text.encode()
        if self.plain:
            if not data:
                return "", np.zeros(1, np.int64)
            space = np.frombuffer(data, np.uint8) == 32
            kind = np.int32 if len(data) < 2**31 else np.int64
            source = np.repeat(np.arange(len(data), dtype=kind), 1 + 2 * space.astype(np.int8))
            return MARK + text.replace(" ", MARK), np.concatenate([np.zeros(3, kind), source, np.array([len(data)], kind)])
        return self._normalise_by_map(data)

    def _steps(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(first source byte, end, replacement), by the longest prefix that the map or the user's pieces hold."""
        at = 0
        while at < len(data):
            if self.user and (m := self.user.match(data, at)):
                n, new = m.end() - at, m.group()
            elif (hit := self.map.longest(data, at)) is not None:
                n, new = hit
            else:
                n = 1 if data[at] < 128 else 2 if data[at] < 224 else 3 if data[at] < 240 else 4
                new = data[at : at + n]
            yield at, at + n, new
            at += n

    def _normalise_by_map(self, data: bytes) -> tuple[str, np.ndarray]:
        mark = MARK.encode() if self.escape else b" "
        out, source = bytearray(), []

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        steps = list(self._steps(data))
        if self.squeeze:
            while steps and steps[0][2].strip(b" ") == b"":
                steps.pop(0)
        if not steps:
            return "", np.array([len(data)])
        if self.dummy and not self.suffix:
            put(mark, steps[0][0])
        gap = self.squeeze
        end = steps[-1][1]
        for at, _, new in steps:
            if self.squeeze and gap:
                new = new.lstrip(b" ")
            for k in range(len(new)):
                put(mark if new[k] == 32 else new[k : k + 1], at)
            if new:
                gap = self.squeeze and new.endswith(b" ")
        if self.squeeze:
            while out.endswith(mark):
                end = source[-len(mark)]
                del out[-len(mark) :], source[-len(mark) :]
        if self.dummy and self.suffix:
            put(mark, end)
        return out.decode(), np.array([*source, end])

    def encode(self, text: str | None) -> Encoding:
        """Ids with the end id, and their byte spans; the end id spans nothing, at the end of the text."""
        normal, source = self.normalise(text or "")
        ids = self.raw.encode(normal, num_threads=1)
        if not self.fallback and self.unk in ids:
            width = np.array([len(p.surface.encode()) for p in self.raw.encode(normal, out_type="immutable_proto").pieces])
        else:
            width = self.width[np.array(ids, np.int64)]
        at = source[np.concatenate([[0], np.cumsum(width), [-1]])].astype(np.int64)
        ids.append(self.eos)
        return Encoding(ids, at[:-1], at[1:])

    def joined(self, ids: list[int]) -> str:
        """The ids in decimal, joined by one space."""
        names = self.names
        return " ".join([names[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.whole.decode(ids)


_encoders: dict[str, PieceEncoder] = {}


def encoder_of(model_path: str) -> PieceEncoder:
    if model_path not in _encoders:
        with open(model_path, "rb") as f:
            _encoders[model_path] = PieceEncoder(f.read())
    return _encoders[model_path]


def _rows(batches, build):
    for batch in batches:
        upto = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            held = upto[lo - 1] if lo else 0
            hi = min(lo + BATCH_TEXTS, max(lo + 1, int(np.searchsorted(upto, held + BATCH_BYTES, "right"))), batch.num_rows)
            part = batch.slice(lo, hi - lo)
            yield build(part.column(0), part.column(1).to_pylist())
            lo = hi


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    """An Arrow list column of arrays, without a Python object for each element."""
    ends = np.cumsum([0, *(len(x) for x in arrays)])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _named(df: DataFrame, id_col: str, schema: str) -> str:
    return f"{id_col} {df.schema[id_col].dataType.simpleString()}, {schema}"


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, ids, starts and ends (bytes of the original text)."""
    small_batches(df.sparkSession)

    @trimmed
    def run(batches):
        enc = encoder_of(model_path)

        def build(keys, texts):
            done = []
            for text in texts:
                x = enc.encode(text)
                x.ids = np.array(x.ids, np.int32)
                done.append(x)
            columns = [_lists([x.ids for x in done], pa.int32()), _lists([x.starts for x in done], pa.int64()), _lists([x.ends for x in done], pa.int64())]
            return pa.RecordBatch.from_arrays([keys, *columns], [id_col, "ids", "starts", "ends"])

        yield from _rows(batches, build)

    return df.select(id_col, text_col).mapInArrow(run, _named(df, id_col, "ids array<int>, starts array<bigint>, ends array<bigint>"))


def decode(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per sequence: id, text (null ids: empty)."""

    @trimmed
    def run(batches):
        enc = encoder_of(model_path)
        for batch in batches:
            texts = [enc.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return df.select(id_col, ids_col).mapInArrow(run, _named(df, id_col, "text string"))


def digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text, of the encoding, its spans and the text decoded from the ids: counts and digests only."""

    @trimmed
    def run(batches):
        enc = encoder_of(model_path)

        def build(keys, texts):
            n, ids, back, spans = [], [], [], []
            for text in texts:
                x = enc.encode(text)
                n.append(len(x.ids))
                ids.append(hashlib.sha256(enc.joined(x.ids).encode()).hexdigest())
                back.append(hashlib.sha256(enc.decode(x.ids).encode()).hexdigest())
                spans.append(zlib.crc32(np.concatenate([x.starts, x.ends]).astype("<i8").tobytes()))
            return pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64()), pa.array(ids), pa.array(back), pa.array(spans, pa.int64())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])

        yield from _rows(batches, build)

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_crc32 bigint"
    return df.select(id_col, text_col).mapInArrow(run, _named(df, id_col, schema))
