"""Near duplicates among embeddings: spherical k-means cells and blocked cosine products.

Vectors of different lengths are never linked, and each length has centroids of its own. Equal vectors of a label
form one class, which its smallest id stands for. Centroids are fitted on at most SAMPLE vectors of the lengths that need
more than one cell; every vector goes to its nearest centroid's cell, its home, and as a visitor to each cell in which
a vector at cosine >= the threshold could have its home: to the cells whose dividing plane lies within the
angle of the threshold. So no link is lost at a cell's border, and recall is 1. Where MAX_CELLS centroids are too few, a
second set, fitted on other vectors, cuts every cell again: a cell is then a pair of nearest centroids, and a vector visits the
pairs that both sets leave open, so cells grow with the table up to MAX_CELLS squared. Within a (label, length, cell) vectors are
dealt into blocks of about BLOCK; products are made block by block in double precision, and for every home vector
only its number of links and a spanning forest of them leave the task, never the pairs.

Defined results: vectors that are null, zero, or hold null or non-finite components, and rows without a label link with nothing: n_links 0, component_id the own id. Ids are
unique (rows that repeat one are one vector, the greatest of theirs, and each is returned), rows without an id are
left out. Vectors are scaled by their largest component first, so finite ones of any size have a norm. Only the id, vector
and label columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolith.llm.components import components
from recolith.llm.runtime import Scratch, trimmed

THRESHOLD = 0.98
SAMPLE = 8192
#: Vectors in a block, home vectors in a cell on average, and rows multiplied at once.
BLOCK = 4096
CELL = 1024
TILE = 512
MAX_CELLS = 1024
ITERATIONS = 10


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that hold usable vectors, those vectors in double precision)."""
    lists = column.cast(pa.list_(pa.float64()))
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    fit = np.flatnonzero((lengths == width) & (lengths > 0))
    flat = lists.take(pa.array(fit)).flatten().to_numpy(zero_copy_only=False)  # a null component becomes NaN
    x = flat.reshape(len(fit), width)
    good = np.isfinite(x).all(1) & (x != 0).any(1)
    x = x[good]
    # by a power of two, so that no digit is lost and the squares neither overflow nor vanish
    return fit[good], np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None]) + 0.0


def fit_cells(sample: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Unit centroids of spherical k-means."""
    rng = np.random.default_rng(seed)
    u = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    k = max(1, min(k, len(u)))
    c = u[rng.choice(len(u), k, replace=False)].copy()
    for _ in range(ITERATIONS):
        near = (u @ c.T).argmax(1)
        for j in range(k):
            total = u[near == j].sum(0)
            if (size := np.linalg.norm(total)) > 0:
                c[j] = total / size
    return c


def homes(u: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(nearest cell, mask of cells to visit) for unit vectors."""
    s = u @ c.T
    own = s.argmax(1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
    reach = np.sqrt(1 - threshold * threshold) + 1e-9
    visit = s.max(1, keepdims=True) - s <= reach * apart[own] + 1e-12
    visit[np.arange(len(u)), own] = False
    return own, visit


def _links(side: np.ndarray, ids: np.ndarray, mult: np.ndarray, x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home ids and their linked rows, ids, smallest id each is connected to here)."""
    rows, cols = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    norm = np.linalg.norm(x, axis=1)
    near = np.zeros((len(rows), len(cols)), bool)
    for lo in range(0, len(rows), TILE):
        r = rows[lo : lo + TILE]
        near[lo : lo + TILE] = (x[r] @ x[cols].T / (norm[r][:, None] * norm[cols][None, :]) >= threshold) & (ids[r][:, None] != ids[cols][None, :])
    count = near @ mult[cols]
    some, other = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    near = near[np.ix_(some, other)]
    top = np.iinfo(np.int64).max
    left, right = ids[rows][some].copy(), ids[cols][other].copy()
    moved = len(left) > 0
    while moved:
        moved = False
        for lo in range(0, len(left), TILE):
            part = near[lo : lo + TILE]
            down = np.minimum(right, np.where(part, left[lo : lo + TILE, None], top).min(0))
            up = np.minimum(left[lo : lo + TILE], np.where(part, down[None, :], top).min(1))
            moved |= bool((down != right).any() or (up != left[lo : lo + TILE]).any())
            right, left[lo : lo + TILE] = down, up
    a = np.concatenate([ids[rows][some], ids[cols][other]])
    return np.stack([ids[rows], count]), a, np.concatenate([left, right])


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v")).filter("id is not null")

    @trimmed
    def read(batches):
        for batch in batches:
            full, blank = np.zeros((batch.num_rows, 2), np.int64), np.ones(batch.num_rows, bool)
            blobs: list = [None] * batch.num_rows
            for width in pc.unique(pc.list_value_length(batch.column("v")).drop_null()).to_pylist():
                fit, x = _matrix(batch.column("v"), width)
                keys = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in x]
                full[fit], blank[fit] = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2), False
                for k, r in zip(fit, x, strict=True):
                    blobs[k] = r.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(full[:, 0], mask=blank), pa.array(full[:, 1], mask=blank), pa.array(blobs, pa.binary())], ["id", "label", "s1", "s2", "x"])

    again = scratch.save(rows.groupBy("id").agg(F.count("*").alias("times")).filter("times > 1"), "again")
    repeats = not again.isEmpty()
    if repeats:
        one = rows.join(again, "id", "left_semi").groupBy("id").agg(F.max(F.struct("v", "label")).alias("x")).select("id", "x.label", "x.v")
        rows = rows.join(again, "id", "left_anti").union(one)
    all_rows = scratch.save(rows.mapInArrow(read, "id bigint, label string, s1 bigint, s2 bigint, x binary"), "vectors")
    usable = all_rows.filter("label is not null and s1 is not null")
    classes = scratch.save(usable.groupBy("label", "s1", "s2").agg(F.min("id").alias("rep"), F.count("*").alias("m")), "classes")
    vectors = all_rows.select(F.col("id").alias("rep"), "x").join(classes.select("label", "rep", "m"), "rep")
    vectors = scratch.save(vectors.withColumn("d", (F.octet_length("x") / 8).cast("int")), "reps")
    largest = vectors.groupBy("label", "d").count().groupBy("d").agg(F.max("count").alias("n")).collect()  # a row for each length
    if not largest:
        return scratch.last(all_rows.select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")))
    wide = {r.d: r.n // CELL for r in largest if r.n // CELL > 1}  # other lengths have one cell
    centres = {}
    for d, k in wide.items():
        sizes_of = [k] if k <= MAX_CELLS else [MAX_CELLS, min(MAX_CELLS, -(-k // MAX_CELLS))]
        most = max(1, SAMPLE // len(wide))
        sample = vectors.filter(F.col("d") == d).select("x").orderBy(F.xxhash64("rep"), "rep").limit(most * len(sizes_of)).collect()
        x = np.frombuffer(b"".join(bytes(r.x) for r in sample), np.float64).reshape(len(sample), d)
        centres[d] = [fit_cells(x[j :: len(sizes_of)], some, j) for j, some in enumerate(sizes_of)]

    def cells_of(x: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home cell, then rows and cells of visits) of vectors."""
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        own, rows, cells = [], [], []
        for lo in range(0, len(u), TILE):
            part = u[lo : lo + TILE]
            first, visit = homes(part, sets[0], threshold)
            home = first.astype(np.int64)
            visit[np.arange(len(part)), first] = True
            r, c = np.nonzero(visit)
            for more in sets[1:]:
                second, visit = homes(part, more, threshold)
                visit[np.arange(len(part)), second] = True
                home = home * len(more) + second
                again, deeper = np.nonzero(visit[r])
                r, c = r[again], c[again] * len(more) + deeper
            away = c != home[r]
            own.append(home)
            rows.append(r[away] + lo)
            cells.append(c[away])
        return tuple(map(np.concatenate, (own, rows, cells)))

    @trimmed
    def assign(batches):
        for batch in batches:
            widths = batch.column("d").to_numpy()
            for d in np.unique(widths):
                own_rows = batch.take(pa.array(np.flatnonzero(widths == d)))
                n = own_rows.num_rows
                if d in centres:
                    x = np.frombuffer(b"".join(own_rows.column("x").to_pylist()), np.float64).reshape(n, d)
                    own, r, cell = cells_of(x, centres[d])
                else:
                    own = r = cell = np.zeros(0, np.int64)
                    own = np.zeros(n, np.int64)
                pick, cell = np.concatenate([np.arange(n), r]), np.concatenate([own, cell])
                part = own_rows.take(pa.array(pick))
                columns = [part.column("label"), part.column("d"), pa.array(cell, pa.int32()), pa.array(np.arange(len(pick)) < n), part.column("rep"), part.column("m"), part.column("x")]
                yield pa.RecordBatch.from_arrays(columns, ["label", "d", "cell", "home", "rep", "m", "x"])

    dealt = scratch.save(vectors.select("label", "d", "rep", "m", "x").mapInArrow(assign, "label string, d int, cell int, home boolean, rep bigint, m bigint, x binary"), "cells")
    sizes = scratch.save(dealt.groupBy("label", "d", "cell").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / BLOCK)).cast("int").alias("nb")), "sizes")
    placed = dealt.join(sizes, ["label", "d", "cell"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    every = F.sequence(F.lit(0), F.col("nb") - 1)
    left = placed.filter("home").select("label", "d", "cell", F.col("own").alias("i"), F.explode(every).alias("j"), F.lit(0).alias("side"), "rep", "m", "x")
    right = placed.select("label", "d", "cell", F.explode(every).alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "rep", "m", "x")

    @trimmed
    def products(table: pa.Table) -> pa.Table:
        n = table.num_rows
        x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float64).reshape(n, -1)  # of one length
        side, ids, mult = (table.column(c).to_numpy() for c in ("side", "rep", "m"))
        (home, count), a, b = _links(side, ids, mult, x, threshold)
        some = count > 0
        edge = a != b
        columns = [np.concatenate([home[some], a[edge]]), np.concatenate([count[some], np.zeros(edge.sum(), np.int64)]), np.concatenate([home[some], b[edge]])]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["a", "n", "b"])

    out = scratch.save(left.union(right).groupBy("label", "d", "cell", "i", "j").applyInArrow(products, "a bigint, n bigint, b bigint"), "links")
    root = components(out.filter("a <> b").select("a", "b"), scratch)
    counts = out.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    named = classes.join(counts, "rep", "left").join(root.select(F.col("v").alias("rep"), "root"), "rep", "left")
    named = scratch.save(named.select("label", "s1", "s2", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root")), "named")
    done = all_rows.select("id", "label", "s1", "s2").join(named, ["label", "s1", "s2"], "left")
    if repeats:
        done = done.join(again, "id", "left").withColumn("time", F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1)))))
    component = F.coalesce("root", "id")
    return scratch.last(done.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept")))
