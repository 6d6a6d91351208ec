"""Token ids in a wavelet matrix per shard.

Texts are put in ascending id order, encoded, and their ids concatenated. Every shard is one blob: a header, the
offsets of its documents, and ``width`` bit planes (highest bit first; in each plane the zeros of the plane above
come before its ones, order kept). Each plane has a directory of ones before every 512 bits, so rank is O(1) and
select is a binary search; access, counting and occurrence lookup read the planes only. The payload of a blob is
compressed by the Parquet file that holds it, which lets any store that Spark writes to keep the shards.

The tokenizers library encodes every text. A text goes to it in pieces, cut where white space begins, after a single line
end, and between a letter or digit and a full stop, comma or other mark: its byte-level pattern has no token across these
places and looks at nothing before a token, so no piece depends on another, and the ids of a text are those of its pieces
in order. The places are found in the bytes, some PART of them at once; a place that bytes can't tell to be one stays uncut. Of
equal pieces in these bytes one is looked up, and the ids laid out by the places of all. A worker keeps the ids of up to 2
KNOWN short pieces, those of late use, so a word is not encoded again each time; those it doesn't know go to the library together.

Defined results: a null or empty text has the end id only. Ids of documents are integers; rows that repeat an id follow
each other in the order of their texts (null first), and equal rows are alike. Rows without an id are left out. Only the
id and text columns are read, so other columns of any name do no harm. An empty table gives an empty file set and no
rows. A document is never split over shards, and a very long one has a shard of its own.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recolith.llm.runtime import small_batches, trimmed

MAGIC = b"RLWM1\0\0\0"
BLOCK = 512
#: A shard's tokens and a plane of them stay in a core's cache.
SHARD_TOKENS = 1 << 20
#: Pieces in each of a worker's two generations, bytes of the longest of them, and bytes of text that are cut into pieces
#: at once.
KNOWN, LONG, PART = 1 << 19, 64, 1 << 22


class Wavelet:
    """Reads one blob."""

    def __init__(self, blob: bytes):
        if blob[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        self.n, self.docs, self.width = struct.unpack("<QQI", blob[8:28])
        at = 28
        self.ids = np.frombuffer(blob, "<i8", self.docs, at)
        at += 8 * self.docs
        self.offsets = np.frombuffer(blob, "<i8", self.docs + 1, at)
        at += 8 * (self.docs + 1)
        size, blocks = -(-self.n // BLOCK) * (BLOCK // 8), -(-self.n // BLOCK) + 1
        self.planes, self.ranks = [], []
        for _ in range(self.width):
            self.planes.append(np.frombuffer(blob, np.uint8, size, at))
            self.ranks.append(np.frombuffer(blob, "<u4", blocks, at + size))
            at += size + 4 * blocks

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block, plane = i // BLOCK, self.planes[level]
        lo, hi = block * (BLOCK // 8), i >> 3
        ones = int(self.ranks[level][block]) + int(np.bitwise_count(plane[lo:hi]).sum())
        return ones + (int(plane[hi]) >> (8 - (i & 7))).bit_count() if i & 7 else ones

    def select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of that value in a plane."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self.rank1(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def zeros(self, level: int) -> int:
        return self.n - int(self.ranks[level][-1])

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.width):
            bit, ones = self._bit(level, i), self.rank1(level, i)
            value = value << 1 | bit
            i = self.zeros(level) + ones if bit else i - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.width):
            a, b = self.rank1(level, lo), self.rank1(level, hi)
            lo, hi = (self.zeros(level) + a, self.zeros(level) + b) if token >> (self.width - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in positions lo to hi."""
        if token >> self.width:
            return 0
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th occurrence of a token."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, self.n)[0] + k
        for level in reversed(range(self.width)):
            bit = token >> (self.width - 1 - level) & 1
            i = self.select(level, bit, i - self.zeros(level) if bit else i)
        return i

    def tokens(self) -> np.ndarray:
        """All tokens in order, by undoing the planes from the lowest up."""
        kind = _kind(self.width)
        out = np.zeros(self.n, kind)
        for level in reversed(range(self.width)):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            z = self.zeros(level)
            out[z:] |= kind(1 << (self.width - 1 - level))
            above = np.empty_like(out)
            above[np.flatnonzero(~ones)] = out[:z]
            above[np.flatnonzero(ones)] = out[z:]
            out = above
        return out


def _kind(width: int) -> type:
    return np.uint16 if width <= 16 else np.uint32


def build(doc_ids: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, width: int) -> bytes:
    """The blob of a shard."""
    n = len(tokens)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    parts = [MAGIC, struct.pack("<QQI", n, len(doc_ids), width), np.asarray(doc_ids, "<i8").tobytes(), offsets.tobytes()]
    kind = _kind(width)
    now = tokens.astype(kind)
    padded = -(-n // BLOCK) * BLOCK
    for level in range(width):
        ones = (now & kind(1 << (width - 1 - level))).astype(bool)
        plane = np.zeros(padded // 8, np.uint8)
        plane[: -(-n // 8)] = np.packbits(ones)
        per = np.bitwise_count(plane).reshape(-1, BLOCK // 8).sum(1, dtype=np.uint32)
        parts += [plane.tobytes(), np.concatenate([[0], np.cumsum(per)]).astype("<u4").tobytes()]
        now = np.concatenate([np.compress(~ones, now), np.compress(ones, now)])
    return b"".join(parts)


#: Marks that end a run of letters or digits; the vertical bar, which added tokens hold, is left out.
MARKS = "".join(c for c in string.punctuation if c != "|")
#: Bits for the byte before a place and for the byte after it; a text may be cut where they share one: before a space, tab
#: or line end after what is not white space, and between a letter or digit and a mark.
_BEFORE, _AFTER = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
_BEFORE[0x21:0x7F] = 1
_BEFORE[[c for c in range(0x80) if chr(c).isalnum()]] = 3
_BEFORE[0x80:] = 3  # if the character that ends there allows it
_AFTER[list(b" \t\n\r")] = 1
_AFTER[list(MARKS.encode())] = 2
#: White space of more than one byte, in UTF-8.
_SPACES = [int.from_bytes(chr(c).encode()) for c in [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]
#: Bytes that show a text to go on without white space after a line end (0xC3 begins letters, and two signs, only).
_GOES_ON = np.zeros(256, bool)
_GOES_ON[[*range(0x21, 0x7F), 0xC3]] = True
#: The letter that stands for the byte of a space in a byte-level vocabulary.
SPACE = "\u0120"


def _bounds(buf: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """The places, ascending, where the pieces of a buffer of UTF-8 begin, and its end; ``breaks`` are among them."""
    at = np.flatnonzero(_BEFORE[buf[:-1]] & _AFTER[buf[1:]]) + 1
    mask = np.zeros(len(buf) + 1, bool)
    mask[at] = True
    wide = at[buf[at - 1] >= 0x80]
    if len(wide):
        last, two = buf[wide - 1], buf[wide - 2].astype(np.int64) << 8 | buf[wide - 1]
        letter = (buf[wide - 2] == 0xC3) & (last != 0x97) & (last != 0xB7)
        space = np.isin(two, _SPACES) | np.isin(buf[wide - 3].astype(np.int64) << 16 | two, _SPACES)
        mask[wide] = np.where(_AFTER[buf[wide]] == 1, ~space, letter)
    mask[breaks] = True
    ends = np.flatnonzero(mask[:-2] & (buf[:-1] == 10)) + 1  # a line end that is all white space there is
    mask[ends[_GOES_ON[buf[ends]]]] = True
    return np.flatnonzero(mask)


class Known(dict):
    """Ids, as bytes, of the pieces of late use; others are asked of the library together."""

    def __init__(self, full):
        super().__init__()
        self.full, self.old = full, {}
        self.opens = np.zeros(full.get_vocab_size(with_added_tokens=True), bool)
        self.opens[[i for token, i in full.get_vocab(with_added_tokens=True).items() if token.startswith(SPACE)]] = True

    def _keep(self, pieces: list[bytes], ids: list[bytes]) -> None:
        at = 0
        while at < len(pieces):
            if len(self) >= KNOWN:
                self.old = dict(self)
                self.clear()
            to = at + KNOWN - len(self)
            self.update(zip(pieces[at:to], ids[at:to], strict=True))
            at = to

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each of some different pieces."""
        found = list(map(self.get, pieces))
        if missing := [i for i, ids in enumerate(found) if ids is None]:
            names = [pieces[i] for i in missing]
            ids = list(map(self.old.get, names))
            asked = [k for k, x in enumerate(ids) if x is None]
            for k, x in zip(asked, self._by_library([names[k].decode() for k in asked]), strict=True):
                ids[k] = x
            for i, x in zip(missing, ids, strict=True):
                found[i] = x
            if max(map(len, names)) > LONG:
                short = [k for k, name in enumerate(names) if len(name) <= LONG]
                names, ids = [names[k] for k in short], [ids[k] for k in short]
            self._keep(names, ids)
        return found

    def _by_library(self, pieces: list[str]) -> list[bytes]:
        """Pieces of one space and a word go in one text: the tokens that begin with a space are where they begin."""
        out: list[bytes | None] = [None] * len(pieces)
        words = [i for i, p in enumerate(pieces) if p.rfind(" ") == 0 and len(p) > 1 and not p[1].isspace()]
        if words:
            ids = np.array(self._encode(["".join([pieces[i] for i in words])])[0].ids, "<u4")
            at = (4 * np.flatnonzero(self.opens[ids])).tolist()
            if len(at) == len(words):  # else piece by piece
                held = ids.tobytes()
                for i, a, b in zip(words, at, [*at[1:], len(held)], strict=True):
                    out[i] = held[a:b]
        others = [i for i, ids in enumerate(out) if ids is None]
        for i, encoded in zip(others, self._encode([pieces[i] for i in others]), strict=True):
            out[i] = array("I", encoded.ids).tobytes()
        return out

    def _encode(self, texts: list[str]):
        return self.full.encode_batch_fast(texts, add_special_tokens=False)


class ByteBpe:
    """Ids exactly as the tokenizers library gives them for a whole text with add_special_tokens=False."""

    def __init__(self, json_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.full = tokenizers.Tokenizer.from_file(json_path)
        self.size = self.full.get_vocab_size(with_added_tokens=True)
        added = self.full.get_added_tokens_decoder().values()
        spaced = any(re.search(rf"\s|[^\W_][{re.escape(MARKS)}]", t.content) or t.lstrip or t.rstrip for t in added)
        made = json.loads(self.full.to_str())
        before = made["pre_tokenizer"] or {}
        plain = made["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        self.whole = spaced or not plain
        self.known = Known(self.full)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all(pa.array([text])))

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a column, in order; null is an empty text."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if self.whole:  # another kind of tokenizer, whose tokens may cross the cuts
            yield from (np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4") for text in texts.to_pylist())
            return
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8) if n and texts.buffers()[2] else np.zeros(0, np.uint8)
        lo = 0
        while lo < n:
            hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PART, side="right")) - 1))
            buf = data[offsets[lo] : offsets[hi]]
            if len(buf) > PART:
                yield np.concatenate(list(self._long(buf)))
            else:
                tokens, at = self._ids(buf, offsets[lo : hi + 1] - offsets[lo])
                yield from (tokens[a:b] for a, b in zip(at[:-1], at[1:], strict=True))
            lo = hi

    def _long(self, buf: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of a long text, by parts that end where it may be cut."""
        at, size = 0, PART
        while at < len(buf):
            end = min(len(buf), at + size)
            if end < len(buf):
                end = at + int(_bounds(buf[at:end], np.array([0]))[-1])
            if end > at:
                yield self._ids(buf[at:end], np.array([0, end - at]))[0]
                at, size = end, PART
            else:
                size *= 2

    def _ids(self, buf: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The ids of the texts that lie one after the other in a buffer, and their offsets at its breaks."""
        if not len(buf):
            return np.zeros(0, "<u4"), [0] * len(breaks)
        bounds = _bounds(buf, breaks)
        pieces = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(buf)])
        coded = pieces.dictionary_encode()
        _, ends, held = coded.dictionary.buffers()
        ends, held = np.frombuffer(ends, np.int32, len(coded.dictionary) + 1).tolist(), held.to_pybytes()
        ids = self.known.ids_of([held[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
        index, size = coded.indices.to_numpy(), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, many = np.cumsum(size) - size, size[index]
        ends = np.concatenate([[0], np.cumsum(many)])
        at = np.repeat(first[index] - ends[:-1], many)
        at += np.arange(len(at))
        return np.frombuffer(b"".join(ids), "<u4")[at], ends[np.searchsorted(bounds, breaks)].tolist()


_coders: dict[str, ByteBpe] = {}


def write(df: DataFrame, path: str, json_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes the shards of a table of texts under ``path``, in ascending id order."""
    small_batches(df.sparkSession)

    @trimmed
    def run(batches):
        coder = _coders.get(json_path) or _coders.setdefault(json_path, ByteBpe(json_path))
        width = max(coder.size - 1, end_id).bit_length()
        part, ids, tokens, held, shard, before = None, [], [], 0, 0, 0

        def flush():
            nonlocal ids, tokens, held, shard, before
            lengths = np.array([len(x) for x in tokens])
            blob = build(np.array(ids), lengths, np.concatenate(tokens), width)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([before], pa.int64()), pa.array([held], pa.int64()), pa.array([blob], pa.binary())],
                ["part", "shard", "before", "n_tokens", "blob"],
            )
            ids, tokens, held, shard, before = [], [], 0, shard + 1, before + held
            return row

        for batch in batches:
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            for k, x in zip(batch.column(0).to_pylist(), coder.encode_all(batch.column(1)), strict=True):
                x = np.append(x, np.uint32(end_id)).astype(_kind(width))
                if held and held + len(x) > shard_tokens:
                    yield flush()
                ids.append(k)
                tokens.append(x)
                held += len(x)
        if ids:
            yield flush()

    rows = df.select(F.col(id_col).cast("bigint").alias("k"), F.col(text_col).cast("string").alias("t")).filter("k is not null")
    ordered = rows.repartitionByRange("k").sortWithinPartitions("k", "t").withColumn("p", F.spark_partition_id())
    ordered.mapInArrow(run, "part int, shard int, before bigint, n_tokens bigint, blob binary").write.option("parquet.block.size", 32 << 20).parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): ids in all partitions before. There is one row for each partition that was written, however
    many documents there are, so the sums pass through the driver; within a partition a shard knows its own."""
    sums = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    before, rows = 0, []
    for part, n in sorted(map(tuple, sums)):
        rows.append((part, before))
        before += n
    return spark.createDataFrame(rows, "part int, base bigint")


def read_documents(spark: SparkSession, path: str, with_tokens: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of little-endian unsigned 32-bit ids) and, if wanted, the tokens."""

    @trimmed
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                base, blob = batch.column("base")[i].as_py(), batch.column("blob")[i].as_py()
                w = Wavelet(blob)
                tokens = w.tokens().astype("<u4")
                cut = [tokens[a:b] for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True)]
                columns = [pa.array(w.ids), pa.array(w.offsets[:-1] + base), pa.array(np.diff(w.offsets)), pa.array([zlib.crc32(x.tobytes()) for x in cut], pa.int64())]
                if with_tokens:
                    columns.append(pa.array([x.astype(np.int64) for x in cut], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "tokens"][: len(columns)])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", tokens array<bigint>" * with_tokens
    blobs = spark.read.parquet(path).select("part", "before", "blob")
    return blobs.join(F.broadcast(starts(spark, path)), "part").select((F.col("base") + F.col("before")).alias("base"), "blob").mapInArrow(run, schema)


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, shard, n): occurrences of a token, from the planes only."""

    @trimmed
    def run(batches):
        for batch in batches:
            n = [Wavelet(b).count(token) for b in batch.column("blob").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("shard"), pa.array(n, pa.int64())], ["part", "shard", "n"])

    return spark.read.parquet(path).select("part", "shard", "blob").mapInArrow(run, "part int, shard int, n bigint")
