"""Sharding by histogram sort.

Rows are ordered by (hash of the text, id), so equal texts follow each other. The shards' splitters are found without
sorting: in each round the open intervals of keys are cut into PROBES equal cells, bytes and rows below every
cell boundary are counted exactly over all partitions, and the cells that hold a target are cut again, until the
count below a boundary meets the target within its tolerance, or a cell holds one key. A hash value that many
rows share is cut further by id. Then one exchange brings each row to its place: shards are the ranges between
splitters. Equal steps of the hash cut them into finer pieces, as hashes of texts are spread evenly, so no task has to
hold a shard; a piece that groups of equal texts make too large is cut again by exact counts, OPEN of them at a
time. So the driver holds PROBES cells for each of at most OPEN intervals, and a row for each piece.

Law ``bytes``: size is the UTF-8 length of the text (null: 0) plus 1, and the shards' sizes differ from the mean
by at most a row or TOLERANCE of the mean, whichever is larger. grown_shard is null, as this law does not fix it.

Defined results: null texts lie together and apart from empty ones, which lie together too; rows that repeat an id and
text take successive slots in any order, as they are equal; rows that share an id only are ordered by their texts' hashes; rows
without an id come first among equal texts. Only id and text columns are read; an
empty table gives an empty result; with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recolith.llm.runtime import Scratch, trimmed

SHARDS = 8
PROBES = 4096
TOLERANCE = 0.0005
#: Rows and bytes in a piece of the exchange, and the most pieces (a row of three numbers each).
PIECE_ROWS, PIECE_BYTES, MAX_PIECES = 2_000_000, 256 << 20, 1 << 19
MIN_PIECES = 32
#: Intervals that are cut in one round.
OPEN = 64
LOWEST, HIGHEST = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Interval:
    """Keys with lo <= hash < hi, or, where ``at`` is set, with that hash and lo <= id < hi."""

    lo: int
    hi: int
    at: int | None = None

    @property
    def step(self) -> int:
        return max(1, -(-(self.hi - self.lo) // PROBES))


@dataclass
class Target:
    measure: str
    want: float
    slack: float
    interval: Interval
    below: dict
    found: tuple[int, int] | None = None


def _place(hs: np.ndarray, ids: np.ndarray, h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """How many of the sorted keys (hs, ids) are at or below each key (h, i)."""
    lo, hi = np.searchsorted(hs, h, "left"), np.searchsorted(hs, h, "right")
    for first in np.unique(lo[lo < hi]):  # rows whose hash is that of some of the keys
        some = np.flatnonzero((lo == first) & (hi > first))
        lo[some] += np.searchsorted(ids[first : hi[some[0]]], i[some], "right")
    return lo


def _histogram(keys: DataFrame, intervals: list[Interval]) -> list:
    """(k, cell, bytes, rows) over the cells of each interval; intervals are in key order and don't overlap."""
    start = np.array([i.lo if i.at is None else i.at for i in intervals], np.int64), np.array([LOWEST if i.at is None else i.lo for i in intervals], np.int64)
    lo = np.array([i.lo for i in intervals], np.int64)
    last = np.array([i.hi - 1 for i in intervals], np.int64)
    step = np.array([i.step for i in intervals], np.uint64)
    by_id = np.array([i.at is not None for i in intervals])

    @trimmed
    def count(batches):
        for batch in batches:
            h, i, size = (batch.column(c).to_numpy() for c in ("h", "id", "size"))
            k = _place(*start, h, i) - 1
            v = np.where(by_id[k], i, h)
            inside = (k >= 0) & (v <= last[k]) & (~by_id[k] | (h == start[0][k]))
            k, v, size = k[inside], v[inside], size[inside]
            cell = (v.view(np.uint64) - lo[k].view(np.uint64)) // step[k]
            both, at = np.unique(k.astype(np.int64) * (PROBES + 1) + cell.astype(np.int64), return_inverse=True)
            sums = np.zeros(len(both), np.int64)
            np.add.at(sums, at, size)
            yield pa.RecordBatch.from_arrays([pa.array(both), pa.array(sums), pa.array(np.bincount(at, minlength=len(both)))], ["c", "b", "n"])

    cells = keys.select("h", "id", "size").mapInArrow(count, "c bigint, b bigint, n bigint")
    rows = cells.groupBy("c").agg(F.sum("b").alias("b"), F.sum("n").alias("n")).collect()  # at most PROBES for each interval
    return [(r.c // (PROBES + 1), r.c % (PROBES + 1), r.b, r.n) for r in sorted(rows)]


def splitters(keys: DataFrame, targets: list[Target]) -> list[tuple[tuple[int, int], dict]]:
    """For each target a key (hash, id) such that about ``want`` of the measure lies below it, with exact counts below."""
    while open_ := [t for t in targets if t.found is None]:
        intervals = sorted({t.interval for t in open_}, key=lambda i: (i.lo, LOWEST) if i.at is None else (i.at, i.lo))[:OPEN]
        open_ = [t for t in open_ if t.interval in intervals]
        number = {i: k for k, i in enumerate(intervals)}
        sums: list[dict[str, list]] = [{"cell": [], "bytes": [0], "rows": [0]} for _ in intervals]
        for k, cell, size, n in _histogram(keys, intervals):
            s = sums[k]
            s["cell"].append(cell)
            s["bytes"].append(s["bytes"][-1] + size)
            s["rows"].append(s["rows"][-1] + n)
        for t in open_:
            _narrow(t, t.interval, sums[number[t.interval]])
    return [(t.found, t.below) for t in targets]


def _narrow(t: Target, i: Interval, sums: dict[str, list]) -> None:
    """Takes a boundary that meets the target, or else the cell that holds it as the next interval. Lists have, for
    each cell with rows and for the end, the sums of the cells before."""
    left = t.want - t.below[t.measure]
    before, cells = sums[t.measure], [*sums["cell"], sums["cell"][-1] + 1 if sums["cell"] else 0]
    at = max(0, bisect_right(before, left) - 1)
    k = min((x for x in (at, at + 1) if x < len(before)), key=lambda x: abs(before[x] - left))
    exact = {m: t.below[m] + sums[m][k] for m in ("bytes", "rows")}
    if abs(before[k] - left) <= t.slack or i.step == 1 and i.at is not None or len(before) == 1:
        first = min(i.lo + cells[k] * i.step, HIGHEST)
        t.found, t.below = ((first, LOWEST) if i.at is None else (i.at, first)), exact
        return
    at = min(at, len(before) - 2)
    lo = i.lo + cells[at] * i.step
    t.below = {m: t.below[m] + sums[m][at] for m in ("bytes", "rows")}
    if i.at is None and i.step == 1:
        t.interval = Interval(LOWEST, HIGHEST, lo)
    else:
        t.interval = Interval(lo, min(lo + i.step, i.hi), i.at)


def _pieces(keys: DataFrame, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(rows, bytes) between the sorted cuts, by piece."""
    hs, ids = np.array([c[0] for c in cuts], np.int64), np.array([c[1] for c in cuts], np.int64)

    @trimmed
    def count(batches):
        for batch in batches:
            piece = _place(hs, ids, batch.column("h").to_numpy(), batch.column("id").to_numpy())
            own, at = np.unique(piece, return_inverse=True)
            sums = np.zeros(len(own), np.int64)
            np.add.at(sums, at, batch.column("size").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.bincount(at, minlength=len(own))), pa.array(sums)], ["k", "n", "b"])

    found = keys.select("h", "id", "size").mapInArrow(count, "k bigint, n bigint, b bigint")
    sums = {r.k: (r.n, r.b) for r in found.groupBy("k").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).collect()}  # a row for each piece
    return [sums.get(k, (0, 0)) for k in range(len(cuts) + 1)]


def _finer(cuts: list[tuple[int, int]], sums: list[tuple[int, int]]) -> list[Target]:
    """Targets inside the pieces that are more than twice as large as meant, counted from the piece's start."""
    out = []
    for (lo, first), (hi, end), (n, b) in zip([(LOWEST, LOWEST), *cuts], [*cuts, (HIGHEST, LOWEST)], sums, strict=True):
        for measure, all_, most in (("rows", n, PIECE_ROWS), ("bytes", b, PIECE_BYTES)):
            if all_ > 2 * most:
                if lo == hi or first != LOWEST:  # within one hash value
                    inside = Interval(first, end if lo == hi else HIGHEST, lo)
                else:
                    inside = Interval(lo, hi)
                parts = -(-all_ // most)
                out += [Target(measure, all_ * k / parts, all_ / parts * 0.2, inside, {"bytes": 0, "rows": 0}) for k in range(1, parts)]
    return out


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """The id and the text, then size, shard and slot."""
    scratch = Scratch(df.sparkSession)
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    rows = df.select(F.col(id_col).cast("bigint").alias("own"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(LOWEST)).alias("id"), text.alias("text"), size.alias("size"), F.xxhash64(text).alias("h"))
    keys = scratch.save(rows.select("h", "id", "size"), "keys")
    sums = keys.agg(F.sum("size").alias("b"), F.count("*").alias("n")).first()
    total, n = sums.b or 0, sums.n
    targets = [Target("bytes", total * k / shards, total / shards * TOLERANCE, Interval(LOWEST, HIGHEST), {"bytes": 0, "rows": 0}) for k in range(1, shards)]
    ends = sorted(x for x, _ in splitters(keys, targets)) if n else []
    pieces = min(MAX_PIECES, max(MIN_PIECES, -(-n // PIECE_ROWS), -(-total // PIECE_BYTES)))
    whole = {(h + d, LOWEST) for h, i in ends if i != LOWEST for d in (0, 1) if h < HIGHEST}  # around a hash value that is cut by id
    cuts = sorted({*ends, *whole, *((LOWEST + (k << 64) // pieces, LOWEST) for k in range(1, pieces))})
    held = _pieces(keys, cuts) if n else [(0, 0)] * (len(cuts) + 1)
    if finer := _finer(cuts, held):
        cuts = sorted({*cuts, *(x for x, _ in splitters(keys, finer))})
        held = _pieces(keys, cuts)
    scratch.clear()
    of_shard = [bisect_right(ends, c) for c in [(LOWEST, LOWEST), *cuts]]
    table, before = [], 0
    for k, (s, (rows_in, _)) in enumerate(zip(of_shard, held, strict=True)):
        before = before if k and of_shard[k - 1] == s else 0
        table.append((k, s, before))
        before += rows_in
    hs, ids = np.array([c[0] for c in cuts], np.int64), np.array([c[1] for c in cuts], np.int64)

    @F.pandas_udf("int")
    def piece(h: pd.Series, i: pd.Series) -> pd.Series:
        return pd.Series(_place(hs, ids, h.to_numpy(), i.to_numpy()).astype(np.int32))

    placed = rows.withColumn("piece", piece("h", "id"))
    facts = F.broadcast(df.sparkSession.createDataFrame(table, "piece int, shard int, before bigint"))  # MAX_PIECES rows and SHARDS at most
    slot = F.row_number().over(Window.partitionBy("piece").orderBy("h", "id")) - 1
    where = placed.withColumn("n", slot).join(facts, "piece")
    return where.select(F.col("own").alias(id_col), F.col("text").alias(text_col), "size", "shard", (F.col("before") + F.col("n")).alias("slot"))
