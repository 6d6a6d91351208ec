"""Stupid-backoff scores of every document against all other documents.

    S(c | a b) = n(a b c) / n(a b)          if n(a b c) > 0
               = 0.4 * n(b c) / n(b)        else if n(b c) > 0
               = 0.16 * n(c) / N            else if n(c) > 0
               = 0.16 / (2 (N + 1))         else

n counts n-grams in all documents but the one scored, N words likewise; at the start of a document the longest
context that exists is used, and each shorter one costs 0.4 only when a longer one was tried. The score is the
sum of natural logarithms over the words, lower-cased runs of non-space.

Documents are coded in chunks (local word numbers and the words' hashes) and kept in the shared folder. One order of
n-grams after another, a chunk's distinct n-grams, with counts, go in 256 pieces, by the first byte of their hash, to the count
table, where equal n-grams are summed; the totals return to the chunks, are joined to the n-grams of their documents, less the
document's own, and summed per document. A frequent n-gram is one entry per chunk, whatever its number of
occurrences. More than FAN chunks are summed in groups of about FAN first, each group's table goes on like a chunk, cut by the next
byte, and so on until one group is left, and the totals come back the same way. So a chunk or group always sends 256
pieces, a task sums the pieces of about FAN, and both the number of pieces and their bytes grow in proportion to the corpus.

Defined results: null and empty texts have no words and score 0. Ids are unique; rows that repeat an id count as
documents of their own, rows without an id are left out. With a single document all words are unseen. Only id and text columns are read. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolith.llm.runtime import Scratch, trimmed
from recolith.llm.text import MIX, SPACES, batches_of_words, mix64

ORDER = 3
BACKOFF = 0.4
CHUNK_WORDS = 2_000_000
#: Chunks or groups whose pieces one task sums, on average.
FAN = 128


def _chunks(docs: DataFrame) -> DataFrame:
    """(chunk, ids, sizes, vocab, codes): words of documents in order, as places in the chunk's vocabulary."""

    @trimmed
    def run(batches):
        ids, sizes, words, held, no, part = [], [], [], 0, 0, None

        def flush():
            nonlocal ids, sizes, words, held, no
            vocab, codes, counts = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")  # frequent words get small numbers, whose high bytes are zero
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            planes = np.ascontiguousarray(rank[codes].astype("<u4").view(np.uint8).reshape(-1, 4).T)
            row = [pa.array([f"{part}-{no}"]), pa.array([np.concatenate(ids)], pa.list_(pa.int64())), pa.array([np.concatenate(sizes)], pa.list_(pa.int64())), pa.array([vocab[order].tobytes()], pa.binary()), pa.array([planes.tobytes()], pa.binary())]
            ids, sizes, words, held, no = [], [], [], 0, no + 1
            return pa.RecordBatch.from_arrays(row, ["chunk", "ids", "sizes", "vocab", "codes"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            for lo, hi, h, at in batches_of_words(batch.column(1), SPACES):
                ids.append(batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False))
                sizes.append(np.diff(at))
                words.append(h)
                held += len(h)
                if held >= CHUNK_WORDS:
                    yield flush()
        if ids:
            yield flush()

    rows = docs.withColumn("p", F.spark_partition_id())
    return rows.mapInArrow(run, "chunk string, ids array<bigint>, sizes array<bigint>, vocab binary, codes binary")


def _grams(vocab: np.ndarray, codes: np.ndarray, sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct hashes of n-grams, counts, places): places[i] is the number of the n-gram that ends at word
    i, or -1 where the document is too short."""
    h = vocab[codes]
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(np.arange(len(h)) - first >= n - 1)
    own = np.full(len(at), n, np.uint64)
    for k in range(n):
        own = mix64(own * MIX[20] + h[at - (n - 1 - k)])
    distinct, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
    places = np.full(len(h), -1, np.int64)
    places[at] = inverse
    return distinct, counts, places


def _pack(sorted_hashes: np.ndarray) -> bytes:
    """Bytes of a difference, first value, then differences in so many bytes each."""
    gaps = np.diff(sorted_hashes)
    width = max(1, -(-int(gaps.max()).bit_length() // 8)) if len(gaps) else 1
    return bytes([width]) + sorted_hashes[:1].astype("<u8").tobytes() + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    if len(blob) == 1:
        return np.zeros(0, np.uint64)
    width = blob[0]
    gaps = np.zeros(((len(blob) - 9) // width, 8), np.uint8)
    gaps[:, :width] = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    return np.cumsum(np.concatenate([np.frombuffer(blob, "<u8", 1, 1), gaps.view("<u8").ravel()]), dtype=np.uint64)


def _row(table, names) -> tuple:
    return tuple(table.column(c)[0].as_py() for c in names)


def _read(vocab: bytes, codes: bytes, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(codes, np.uint8).reshape(4, -1)
    return np.frombuffer(vocab, np.uint64), np.ascontiguousarray(planes.T).view("<u4").ravel(), np.array(sizes, np.int64)


def _pack_counts(x: np.ndarray) -> bytes:
    """A byte for each count; those over 254 follow with their places."""
    big = np.flatnonzero(x >= 255)
    return len(big).to_bytes(8, "little") + big.astype("<i8").tobytes() + x[big].astype("<i8").tobytes() + np.minimum(x, 255).astype(np.uint8).tobytes()


def _unpack_counts(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    out = np.frombuffer(blob, np.uint8, offset=8 + 16 * n).astype(np.int64)
    out[np.frombuffer(blob, "<i8", n, 8)] = np.frombuffer(blob, "<i8", n, 8 + 8 * n)
    return out


def _own_counts(place: np.ndarray, doc: np.ndarray, distinct: int) -> np.ndarray:
    """For each word, occurrences in its document of the n-gram at that place (0 at place -1)."""
    out = np.zeros(len(place), np.int64)
    at = np.flatnonzero(place >= 0)
    _, inverse, counts = np.unique(doc[at] * distinct + place[at], return_inverse=True, return_counts=True)
    out[at] = counts[inverse]
    return out


def score_chunk(vocab: np.ndarray, codes: np.ndarray, sizes: np.ndarray, totals: list[np.ndarray], n_words: int) -> np.ndarray:
    """Score of each document of a chunk, from the corpus totals of the chunk's distinct n-grams, by order."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    left = (n_words - sizes)[doc].astype(float) if len(doc) else np.zeros(0)
    shorter = s = None
    for n in range(1, ORDER + 1):
        distinct, _, places = _grams(vocab, codes, sizes, n)
        others = -_own_counts(places, doc, max(1, len(distinct)))
        there = places >= 0
        others[there] += totals[n - 1][places[there]]
        with np.errstate(divide="ignore", invalid="ignore"):
            if n == 1:
                s = np.where(others > 0, others / left, 1 / (2 * (left + 1)))
            else:
                context = np.zeros_like(others)
                context[1:] = shorter[:-1]
                s = np.where(there, np.where(others > 0, others / context, BACKOFF * s), s)
        shorter = others
    return np.bincount(doc, weights=np.log(s), minlength=len(sizes))


_PIECE = "owner string, g bigint, r string, grams binary, counts binary"


def _pieces(owner: str, g: int, r: str, distinct: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Pieces (owner, group, hash bytes in hexadecimal, n-grams, counts) of a sorted table whose hashes begin with r."""
    byte = distinct >> np.uint64(56 - 4 * len(r)) & np.uint64(255)
    cut = np.searchsorted(byte, np.arange(257, dtype=np.uint64))
    some = np.flatnonzero(np.diff(cut))
    parts = [slice(cut[b], cut[b + 1]) for b in some]
    columns = [pa.array([owner] * len(some), pa.string()), pa.array([g] * len(some), pa.int64()), pa.array([f"{r}{b:02x}" for b in some], pa.string())]
    return pa.RecordBatch.from_arrays([*columns, pa.array([_pack(distinct[x]) for x in parts], pa.binary()), pa.array([_pack_counts(counts[x]) for x in parts], pa.binary())], ["owner", "g", "r", "grams", "counts"])


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(sorted distinct n-grams, sums, for each piece the places of its n-grams)."""
    grams = [_unpack(x) for x in table.column("grams").to_pylist()]
    counts = np.concatenate([_unpack_counts(x) for x in table.column("counts").to_pylist()])
    distinct, inverse = np.unique(np.concatenate(grams), return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, inverse, counts)
    return distinct, sums, np.split(inverse, np.cumsum([len(x) for x in grams])[:-1])


def _totals(pieces: DataFrame, groups: int, scratch: Scratch) -> DataFrame:
    """(owner, r, totals): for each piece the sums, over all owners, of its n-grams; g of the pieces is below ``groups``."""
    if groups == 1:

        @trimmed
        def total(table: pa.Table) -> pa.Table:
            _, sums, places = _summed(table)
            return pa.table([table.column("owner"), table.column("r"), pa.array([_pack_counts(sums[x]) for x in places], pa.binary())], ["owner", "r", "totals"])

        return scratch.save(pieces.groupBy("r").applyInArrow(total, "owner string, r string, totals binary"), "totals")

    @trimmed
    def merge(table: pa.Table) -> pa.Table:
        distinct, sums, places = _summed(table)
        n, g, r = len(places), table.column("g")[0].as_py(), table.column("r")[0].as_py()
        packed = [x.astype("<u4").tobytes() for x in places]
        columns = [pa.array([*table.column("owner").to_pylist(), None], pa.string()), pa.array([g] * (n + 1), pa.int64()), pa.array([r] * (n + 1), pa.string())]
        return pa.table([*columns, pa.array([None] * n + [_pack(distinct)], pa.binary()), pa.array([None] * n + [_pack_counts(sums)], pa.binary()), pa.array([*packed, None], pa.binary())], ["owner", "g", "r", "grams", "counts", "places"])

    both = scratch.save(pieces.groupBy("g", "r").applyInArrow(merge, _PIECE + ", places binary"), "merged")

    @trimmed
    def split(batches):
        for batch in batches:
            for g, r, grams, counts in zip(*(batch.column(c).to_pylist() for c in ("g", "r", "grams", "counts")), strict=True):
                yield _pieces(str(g), g // FAN, r, _unpack(grams), _unpack_counts(counts))

    found = _totals(both.filter("owner is null").select("g", "r", "grams", "counts").mapInArrow(split, _PIECE), -(-groups // FAN), scratch)

    @trimmed
    def back(left: pa.Table, right: pa.Table) -> pa.Table:
        sums = np.concatenate([_unpack_counts(x) for _, x in sorted(zip(right.column("r").to_pylist(), right.column("totals").to_pylist(), strict=True))])
        blobs = [_pack_counts(sums[np.frombuffer(x, "<u4")]) for x in left.column("places").to_pylist()]
        return pa.table([left.column("owner"), left.column("r"), pa.array(blobs, pa.binary())], ["owner", "r", "totals"])

    members = both.filter("owner is not null").select("owner", "g", "r", "places").groupBy("g", "r")
    sums = found.select(F.col("owner").cast("bigint").alias("g"), F.expr("left(r, length(r) - 2)").alias("up"), "r", "totals").groupBy("g", "up")
    return scratch.save(members.cogroup(sums).applyInArrow(back, "owner string, r string, totals binary"), "totals")


def backoff_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, log_score."""
    scratch = Scratch(df.sparkSession)
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    chunks = scratch.save(_chunks(docs), "chunks")
    size = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("words"), F.count("*").alias("chunks")).first()
    n_words, groups = size.words or 0, max(1, -(-size.chunks // FAN))

    def sender(n: int):
        @trimmed
        def send(batches):
            for batch in batches:
                for r in range(batch.num_rows):
                    chunk, vocab, codes, sizes = _row(batch.slice(r, 1), ("chunk", "vocab", "codes", "sizes"))
                    distinct, counts, _ = _grams(*_read(vocab, codes, sizes), n)
                    yield _pieces(chunk, zlib.crc32(chunk.encode()) % groups, "", distinct, counts)

        return send

    totals = None
    for n in range(1, ORDER + 1):  # one at a time: its pieces are gone before those of the next
        part = _totals(chunks.select("chunk", "vocab", "codes", "sizes").mapInArrow(sender(n), _PIECE), groups, scratch)
        part = part.select(F.col("owner").alias("chunk"), F.lit(n).alias("n"), "r", "totals")
        totals = part if totals is None else totals.union(part)

    @trimmed
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, vocab, codes, sizes = _row(left, ("ids", "vocab", "codes", "sizes"))
        parts = sorted(zip(right.column("n").to_pylist(), right.column("r").to_pylist(), right.column("totals").to_pylist(), strict=True))
        sums = [np.concatenate([np.zeros(0, np.int64), *(_unpack_counts(x) for m, _, x in parts if m == n)]) for n in range(1, ORDER + 1)]
        scores = score_chunk(*_read(vocab, codes, sizes), sums, n_words)
        return pa.table([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(scores)], ["id", "n_words", "log_score"])

    scored = chunks.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(score, "id bigint, n_words bigint, log_score double")
    return scratch.last(scored.withColumnRenamed("id", id_col))
