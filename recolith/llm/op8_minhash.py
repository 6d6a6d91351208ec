"""Near duplicates by MinHash bands, odd sketches and exact confirmation.

A text's set is its distinct 5-word shingles (fewer words: the whole sequence). Texts with equal sets share a
class, whose smallest id stands for it. Per set, HASHES minima form BANDS keys; classes with a common key are
candidates. The minima are also folded into an odd sketch, a bitmap of parities: the population count of the XOR
of two sketches estimates how many minima differ. A pair is put to the exact test (on the full sets) unless its
sketches lie more than about five standard deviations from what similarity 0.75 gives.

Within a key no set of all pairs is made. First every member is tested against the key's smallest id, and
components are formed from the links. Members of keys that then still hold several components meet by their
rarest shingles (prefix filter, exact), only across components and within neighbouring bands of size, and are paired only if
the places of the shingle in both sets and odd sketches of the whole sets allow it (bounds of the true overlap and
difference, so exact too). Every candidate pair is thus tested, connected
already, or proven too different. A pair at similarity 0.75 is missed with probability below 3e-7 (40 bands of 4).

Defined results: null, empty or blank texts have an empty set (n_shingles 0) and link with nothing. Rows that repeat
an id are one document, whose text is the greatest of theirs, and each of them is returned with its result; rows without an id
are left out. Ties need nothing special: the smallest id of a group is kept. Only the id and text columns are read. An empty table gives an empty result. Long texts are hashed in pieces of a megabyte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recolith.llm.components import components
from recolith.llm.runtime import Scratch, trimmed
from recolith.llm.text import MIX, SPACES, batches_of_words, mix64, ngrams

WORDS = 5
BANDS, ROWS = 40, 4
HASHES = BANDS * ROWS
SKETCH_BITS = 512
#: Differing sketch bits: 68.7 are expected at similarity 0.75, with a standard deviation of about 9.
MAX_BITS = 115
#: Bits of the second sketch, of the whole set.
SET_BITS = 1024

_RNG = np.random.default_rng(0x0DD)
_XOR = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
_MUL = _RNG.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SLOT = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    if len(words) >= WORDS:
        h = ngrams(words, WORDS)
    else:
        h = ngrams(words, len(words)) if len(words) else words
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def minima(sets: np.ndarray) -> np.ndarray:
    h = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(h), 2048):
        np.minimum(out, ((h[None, lo : lo + 2048] ^ _XOR[:, None]) * _MUL[:, None]).min(1), out=out)
    return out


def bands(mins: np.ndarray) -> np.ndarray:
    m = mins.astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64) * MIX[40]
    for k in range(ROWS):
        key = mix64(key + (m[:, k] + np.uint64(1)) * MIX[41 + k])
    return key.view(np.int64)


def odd_sketch(mins: np.ndarray) -> np.ndarray:
    """Parity bitmap of (position, minimum) pairs, as signed 64-bit words."""
    bit = (mix64(mins.astype(np.uint64) ^ _SLOT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(bit, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(">i8").astype(np.int64)


def set_parity(sets: np.ndarray) -> np.ndarray:
    """Odd sketch of the whole set: differing bits of two such sketches never outnumber differing elements."""
    odd = np.bincount((sets % np.uint64(SET_BITS)).astype(np.int64), minlength=SET_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(">i8").astype(np.int64)


def _features(docs: DataFrame) -> DataFrame:
    """(id, n, s1, s2, bands, sketch): s1 and s2 identify the set."""

    @trimmed
    def run(batches):
        for batch in batches:
            for lo, hi, h, at in batches_of_words(batch.column(1), SPACES):
                n, ids, b, sk, par = [], [], [], [], []
                for r in range(hi - lo):
                    s = shingles(h[at[r] : at[r + 1]])
                    n.append(len(s))
                    if len(s):
                        d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                        ids.append((int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)))
                        m = minima(s)
                        b.append(bands(m))
                        sk.append(odd_sketch(m))
                        par.append(set_parity(s))
                    else:
                        ids.append((None, None))
                        b.append(None)
                        sk.append(None)
                        par.append(None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array([x[0] for x in ids], pa.int64()), pa.array([x[1] for x in ids], pa.int64()), pa.array(b, pa.list_(pa.int64())), pa.array(sk, pa.list_(pa.int64())), pa.array(par, pa.list_(pa.int64()))],
                    ["id", "n", "s1", "s2", "bands", "sketch", "parity"],
                )

    return docs.mapInArrow(run, "id bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>, sketch array<bigint>, parity array<bigint>")


def _sets(docs: DataFrame) -> DataFrame:
    """(id, set): the sorted shingle hashes as bytes."""

    @trimmed
    def run(batches):
        for batch in batches:
            for lo, hi, h, at in batches_of_words(batch.column(1), SPACES):
                sets = [shingles(h[at[r] : at[r + 1]]).tobytes() for r in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.large_binary()).cast(pa.binary())], ["id", "set"])

    return docs.mapInArrow(run, "id bigint, set binary")


def _confirm(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, sa, sb) whose full sets are similar enough."""

    @trimmed
    def run(batches):
        for batch in batches:
            a, b = batch.column("sa"), batch.column("sb")
            keep = np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                x, y = np.frombuffer(a[r].as_buffer(), np.uint64), np.frombuffer(b[r].as_buffer(), np.uint64)
                if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                    both = np.concatenate([x, y])
                    both.sort(kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    keep[r] = 100 * common >= percent * (len(both) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _differing(x: str, y: str):
    return sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))


def _rarest(docs: DataFrame, unsure: DataFrame, size: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Pairs (a, b) of unsure sets (rep, component c) of different components that can be similar enough.

    In one order of all shingles, rare ones first, similar sets share one among the first n - ceil(t n) + 1 of
    either. Sets that have just a widespread passage in common share none of those. In the group of a shingle the
    members of the component of its smallest id don't meet each other."""

    @trimmed
    def grams(batches):
        for batch in batches:
            for lo, hi, h, at in batches_of_words(batch.column(1), SPACES):
                sets = [shingles(h[at[r] : at[r + 1]]) for r in range(hi - lo)]
                n = np.array([len(x) for x in sets])
                ids = batch.column(0).slice(lo, hi - lo).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(np.repeat(n, n)), pa.array(np.concatenate(sets).view(np.int64))], ["rep", "n", "g"])

    some = docs.join(unsure.select(F.col("rep").alias("id")), "id", "left_semi")
    rows = scratch.save(some.select("id", "text").mapInArrow(grams, "rep bigint, n bigint, g bigint"), "grams")
    spread = scratch.save(rows.groupBy("g").agg(F.count("*").alias("df")), "spread")
    place = F.row_number().over(Window.partitionBy("rep").orderBy("df", "g"))
    head = rows.join(spread, "g").withColumn("k", place).filter(F.col("k") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    head = scratch.save(head.filter("df > 1").select("g", "rep", "k").join(unsure, "rep"), "head")
    first = head.groupBy("g").agg(F.min(F.struct("rep", "c")).alias("f"), F.min("c").alias("least"), F.max("c").alias("most"))
    first = scratch.save(first.filter("least <> most").select("g", F.col("f.c").alias("cf")), "heads")
    side = scratch.save(head.join(first, "g").join(size.withColumnRenamed("id", "rep"), "rep"), "sides")
    longs = range(SET_BITS // 64)
    # sizes of similar sets lie in the same band or in neighbouring ones
    band = F.col("n") if percent == 100 else F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)))
    near = F.explode(F.array(band - 1, band, band + 1))
    x = side.filter("c <> cf").select("g", near.alias("band"), F.col("k").alias("ia"), F.col("rep").alias("a"), F.col("c").alias("ca"), F.col("n").alias("na"), F.col("sketch").alias("ka"), *[F.col("parity")[k].alias(f"pa{k}") for k in longs])
    y = side.select(F.col("g").alias("gb"), band.alias("band_b"), F.col("k").alias("ib"), F.col("rep").alias("b"), F.col("c").alias("cb"), "cf", F.col("n").alias("nb"), F.col("sketch").alias("kb"), *[F.col("parity")[k].alias(f"pb{k}") for k in longs])
    once = (F.col("cb") == F.col("cf")) | (F.col("a") < F.col("b"))
    differing = sum((F.bit_count(F.col(f"pa{k}").bitwiseXOR(F.col(f"pb{k}"))) for k in longs), F.lit(0))
    # similar sets differ in (100 - percent) / (100 + percent) of the sum of their sizes at most
    close = (F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb")) & (differing * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)) & (_differing("ka", "kb") <= MAX_BITS)
    # a pair's first common shingle leaves room for enough others after it
    close &= (F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) + 1) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    met = x.join(y, (F.col("g") == F.col("gb")) & (F.col("band") == F.col("band_b")) & (F.col("ca") != F.col("cb")) & once & close)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    scratch = Scratch(df.sparkSession)
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    again = scratch.save(docs.groupBy("id").agg(F.count("*").alias("times")).filter("times > 1"), "again")
    repeats = not again.isEmpty()
    if repeats:
        one = docs.join(again, "id", "left_semi").groupBy("id").agg(F.max("text").alias("text"))
        docs = scratch.save(docs.join(again, "id", "left_anti").union(one), "documents")
    rows = scratch.save(_features(docs), "features")
    classes = rows.filter("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("rep"))
    classes = scratch.save(classes, "classes")
    reps = rows.filter("n > 0").join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    reps = scratch.save(reps.select("id", "n", "bands", "sketch", "parity"), "reps")
    size = reps.select("id", "n", "sketch", "parity")

    keys = reps.select(F.col("id").alias("rep"), F.explode("bands").alias("key"))
    first = scratch.save(keys.groupBy("key").agg(F.min("rep").alias("first"), F.count("*").alias("m")).filter("m > 1").select("key", "first"), "first")
    members = scratch.save(keys.join(first, "key"), "members")

    def possible(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and sketches leave open."""
        left = pairs.join(size.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka")), "a")
        both = left.join(size.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb")), "b")
        return both.filter((F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb")) & (_differing("ka", "kb") <= MAX_BITS)).select("a", "b")

    def confirmed(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        sets = scratch.save(_sets(docs.join(scratch.save(wanted, "wanted"), "id", "left_semi")), "sets")
        left = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
        done = scratch.save(_confirm(left.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"), percent), "links")
        return done

    pairs = scratch.save(possible(members.filter("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()), "pairs")
    links = confirmed(pairs)
    root = components(links, scratch)

    named = members.join(root.select(F.col("v").alias("rep"), F.col("root").alias("c")), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    named = named.join(root.select(F.col("v").alias("first"), F.col("root").alias("cf")), "first", "left").withColumn("cf", F.coalesce("cf", "first"))
    named = scratch.save(named.select("key", "rep", "c", "cf"), "named")
    apart = scratch.save(named.filter("c <> cf").select("key").distinct(), "open-keys")
    unsure = scratch.save(named.join(apart, "key", "left_semi").select("rep", "c").distinct(), "unsure")
    if not unsure.isEmpty():
        more = scratch.save(_rarest(docs, unsure, size, scratch, percent), "more")
        more = scratch.save(more.join(pairs, ["a", "b"], "left_anti"), "untested")
        links = links.union(confirmed(more))
        root = components(links, scratch)

    cls = classes.join(root.select(F.col("v").alias("rep"), "root"), "rep", "left").select("s1", "s2", F.coalesce("root", "rep").alias("component"))
    cls = scratch.save(cls, "class-roots")
    out = rows.select("id", "n", "s1", "s2").join(cls, ["s1", "s2"], "left")
    if repeats:
        out = out.join(again, "id", "left").withColumn("time", F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1)))))
    component = F.coalesce("component", "id")
    return scratch.last(out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("id") == component).alias("kept")))
