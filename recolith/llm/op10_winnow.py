"""Benchmark decontamination by winnowing.

Words are lower-cased runs of letters and digits. Of every WINDOW - K + 1 consecutive K-gram hashes the rightmost
smallest is kept, in items and documents alike, so a shared span of WINDOW words always has a kept K-gram at the
same place on both sides. Items shorter than WINDOW words are one window each; for their lengths the document's
n-grams of that length are looked up whole.

Of the documents' fingerprints only those that a bitmap of fixed size (built from the items, checked size) lets
pass leave the scan, each with the words around it. They are joined to the items' fingerprints; a hit is extended
both ways over equal words, and counts if at least WINDOW words agree. Overlapping hits of a document are merged.

Defined results: null and empty texts have no words and no hits, in documents and items. Items without words
have no window. Every row of ``docs`` is a document and gives a row, whether its id is null, repeated with the same text or
with another; ids may be of any type. Rows of items that share an id are one item, those without an id are left out. Ties and
copies need nothing special. Only id and text columns are read. An empty table on either side gives empty or clean results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recolith.llm.runtime import Scratch, trimmed
from recolith.llm.text import NON_ALNUM, batches_of_words, ngrams

WINDOW, K = 10, 5
SPAN = WINDOW - K
#: Bits of the bitmap that items' fingerprints set: 8 MB, whatever the number of items.
FILTER_BITS = 1 << 26

#: What a document is inside: its id and a hash of its text.
_DOC = ["id", "of"]


def kept_grams(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the K-grams that winnowing keeps."""
    g = ngrams(h, K)
    w = SPAN + 1
    if len(g) < w:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = g[: len(g) - w + 1].copy(), np.arange(len(g) - w + 1)
    for k in range(1, w):
        new = g[k : k + len(best)]
        better = new <= best
        best = np.where(better, new, best)
        at = np.where(better, np.arange(k, k + len(best)), at)
    at = np.unique(at)
    return at, g[at]


def _around(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words SPAN before a K-gram to SPAN after it; 0 beyond the ends (word hashes are made odd)."""
    padded = np.concatenate([np.zeros(SPAN, np.uint64), h | np.uint64(1), np.zeros(SPAN, np.uint64)])
    return np.lib.stride_tricks.sliding_window_view(padded, K + 2 * SPAN)[at] if len(at) else np.zeros((0, K + 2 * SPAN), np.uint64)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * 8
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])
    return fixed.cast(pa.binary())


def _inputs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("of"))


def _fingerprints(df: DataFrame, lengths: list[int] | None, bitmap) -> DataFrame:
    """A row for each text (hash null), then one for each fingerprint. Items (bitmap None) of fewer than WINDOW
    words give one fingerprint of their own length n, with pos -n; documents give those of the given lengths."""

    @trimmed
    def run(batches):
        bits = np.frombuffer(bitmap.value, np.uint8) if bitmap is not None else None

        def possible(g: np.ndarray) -> np.ndarray:
            slot = (g >> np.uint64(20)) % np.uint64(FILTER_BITS)
            return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

        for batch in batches:
            for lo, hi, h, at in batches_of_words(batch.column(1), NON_ALNUM):
                m = hi - lo
                keys, counts, hashes, places, near = [np.arange(lo, hi)], [np.diff(at)], [np.zeros(m, np.uint64)], [np.zeros(m, np.int64)], [np.zeros((m, K + 2 * SPAN), np.uint64)]

                def put(r, g, pos, around):
                    keys.append(np.full(len(g), lo + r))
                    counts.append(np.zeros(len(g), np.int64))
                    hashes.append(g)
                    places.append(pos)
                    near.append(around)

                for r in range(hi - lo):
                    own = h[at[r] : at[r + 1]]
                    if bits is None:
                        if 0 < len(own) < WINDOW:
                            put(r, ngrams(own, len(own)), np.array([-len(own)]), _around(own, np.array([0])) if len(own) >= K else np.zeros((1, K + 2 * SPAN), np.uint64))
                            continue
                        pos, g = kept_grams(own)
                        put(r, g, pos, _around(own, pos))
                        continue
                    pos, g = kept_grams(own)
                    some = possible(g)
                    pos, g = pos[some], g[some]
                    put(r, g, pos, _around(own, pos))
                    for n in lengths:
                        g = ngrams(own, n)
                        pos = np.flatnonzero(possible(g)) if len(g) else np.zeros(0, np.int64)
                        put(r, g[pos], pos, np.full((len(pos), K + 2 * SPAN), n, np.uint64))
                keys, counts, hashes, places, near = map(np.concatenate, (keys, counts, hashes, places, near))
                first = np.arange(len(keys)) < m
                rows = pa.array(keys, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(counts, pa.int64()), pa.array(hashes.view(np.int64), mask=first), pa.array(places, mask=first), _binary(near)],
                    ["id", "of", "n_words", "hash", "pos", "around"],
                )

    return df.mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, of bigint, n_words bigint, hash bigint, pos bigint, around binary")


def _bitmap(df: DataFrame) -> bytes:
    """Bitmap of the fingerprints in ``df``: at most FILTER_BITS / 64 words reach the driver."""
    slot = F.shiftrightunsigned("hash", 20).bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = F.expr("shiftleft(1L, cast((shiftrightunsigned(hash, 20) & 63) as int))")
    words = df.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, "<i8")
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.tobytes()


def _extend(pairs: DataFrame) -> DataFrame:
    """(id, of, items, lo, hi): words lo to hi of the document, for joined fingerprints that reach a whole window."""

    @trimmed
    def run(batches):
        width = K + 2 * SPAN
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            pos, ipos = batch.column("pos").to_numpy(), batch.column("ipos").to_numpy()
            a = np.frombuffer(b"".join(batch.column("around").to_pylist()), np.uint64).reshape(n, width)
            b = np.frombuffer(b"".join(batch.column("iaround").to_pylist()), np.uint64).reshape(n, width)
            same = (a == b) & (a != 0)
            before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
            left = right = np.ones(n, bool)
            for k in range(SPAN):
                left = left & same[:, SPAN - 1 - k]
                right = right & same[:, SPAN + K + k]
                before += left
                after += right
            core = same[:, SPAN : SPAN + K].all(1)
            short = (ipos < 0) & (a[:, 0] == (-ipos).astype(np.uint64)) & (a == a[:, :1]).all(1)
            long = (ipos >= 0) & core & (before + K + after >= WINDOW)
            lo = np.where(short, pos, pos - before)
            hi = np.where(short, pos - ipos, pos + K + after)
            keep = short | long
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*_DOC, "passage")), pa.array(lo), pa.array(hi)], [*_DOC, "passage", "lo", "hi"]).filter(pa.array(keep))

    kind = pairs.schema["id"].dataType.simpleString()
    return pairs.select(*_DOC, "pos", "around", "passage", "ipos", "iaround").mapInArrow(run, f"id {kind}, of bigint, passage bigint, lo bigint, hi bigint")


def _found(docs: DataFrame, items: DataFrame, scratch: Scratch, id_col: str, text_col: str, item_col: str, item_text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fingerprints of documents, hits by (document, passage, lo, hi), items by passage).

    Items often share a fingerprint with the words around it; each such passage is joined once, and its items are
    looked up for the passages that were hit."""
    spark = docs.sparkSession
    them = _inputs(items, item_col, item_text).filter("id is not null").withColumn("id", F.col("id").cast("string"))
    them = scratch.save(_fingerprints(them, None, None).filter("hash is not null"), "items")
    lengths = sorted(-r.pos for r in them.filter("pos < 0").select("pos").distinct().collect())  # 1 to 9 at most
    bitmap = spark.sparkContext.broadcast(_bitmap(them.select("hash")))
    us = scratch.save(_fingerprints(_inputs(docs, id_col, text_col), lengths, bitmap), "docs")
    bitmap.unpersist()
    them = them.withColumn("ipos", F.least("pos", F.lit(0))).withColumn("passage", F.xxhash64("hash", "ipos", "around"))
    right = them.select("hash", "ipos", F.col("around").alias("iaround"), "passage").distinct()
    hits = _extend(us.filter("hash is not null").select("hash", *_DOC, "pos", "around").join(right, "hash"))
    return us, scratch.save(hits.distinct(), "hits"), them.select("passage", F.col("id").alias("item")).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    scratch = Scratch(docs.sparkSession)
    us, hits, owners = _found(docs, items, scratch, id_col, text_col, item_col, item_text)
    order = Window.partitionBy(*_DOC).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = hits.groupBy(*_DOC, "lo").agg(F.max("hi").alias("hi"))
    fresh = spans.withColumn("new", F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", F.coalesce(reach, F.lit(0)))))
    words = fresh.groupBy(*_DOC).agg(F.sum("new").alias("n_hit"))
    found = hits.select(*_DOC, "passage").distinct().join(owners, "passage").select(*_DOC, "item").distinct()
    found = found.groupBy(*_DOC).agg(F.array_sort(F.collect_list("item")).alias("list"))
    found = found.select(*_DOC, F.size("list").cast("bigint").alias("n_items"), F.sha2(F.array_join("list", ",").cast("binary"), 256).alias("items"))
    words = words.select(F.col("id").alias("own"), F.col("of").alias("own_of"), "n_hit")
    marked = scratch.save(words.join(found, F.col("own").eqNullSafe(F.col("id")) & (F.col("own_of") == F.col("of"))).drop("id", "of"), "marked")
    every = us.filter("hash is null").select(*_DOC, "n_words")
    out = every.join(marked, F.col("id").eqNullSafe(F.col("own")) & (F.col("of") == F.col("own_of")), "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    done = out.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items", nothing).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")
    )
    return scratch.last(done)


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of an item."""
    scratch = Scratch(docs.sparkSession)
    _, hits, _ = _found(docs, items, scratch, id_col, text_col, item_col, item_text)
    hit = scratch.last(hits.select(F.col("id").alias("__rl_id"), F.col("of").alias("__rl_of")).distinct())
    same = docs[id_col].eqNullSafe(hit["__rl_id"]) & (F.xxhash64(docs[text_col].cast("string")) == hit["__rl_of"])
    return docs.join(hit, same, "left_anti")
