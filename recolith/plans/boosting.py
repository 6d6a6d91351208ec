"""Gradient-boosted trees over histograms of all rows, for log loss, grown best leaf first.

Spark's own trees need a job for every level of every tree; here each model is fitted whole in one task, and all folds of
all models at the same time. Rows are bins of features, equal ones kept once with their counts of both classes, so no row
is left out. They are read in chunks, from files where they are many, so a task's memory does not grow with them."""

from __future__ import annotations

import tempfile

import numpy as np

BINS = 64
#: Rows that are worked on at once.
CHUNK = 1 << 18
#: Bytes of an array beyond which it lies in a file.
IN_MEMORY = 1 << 25
#: Cells of a histogram of several features at most.
CELLS = 2048


def _room(shape: tuple[int, ...], kind) -> np.ndarray:
    """An array of zeros; a large one in a file that goes with it."""
    if int(np.prod(shape)) * np.dtype(kind).itemsize <= IN_MEMORY:
        return np.zeros(shape, kind)
    return np.memmap(tempfile.TemporaryFile(), kind, "w+", shape=shape)


def _chunks(n: int) -> list[slice]:
    return [slice(i, min(i + CHUNK, n)) for i in range(0, n, CHUNK)]


def _edges(x: np.ndarray) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature, but the last."""
    return [e[e < column.max()] for column in x.T for e in [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))]]


def encode(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of the features of each row."""
    return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)], axis=1).astype(np.min_scalar_type(max(map(len, edges))))


class Store:
    """Sorted rows of bins and how many of each class they stand for, gathered in files that go with them."""

    def __init__(self, width: int):
        self.width, self.files, self.n = width, [tempfile.TemporaryFile() for _ in range(3)], 0

    def add(self, codes: np.ndarray, positive: np.ndarray) -> None:
        """Runs of equal rows become one row each."""
        if len(codes):
            first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]).any(axis=1)])
            self.n += len(first)
            for file, some in zip(self.files, (codes[first], np.add.reduceat(positive, first, dtype=np.int64), np.add.reduceat(~positive, first, dtype=np.int64)), strict=True):
                file.write(np.ascontiguousarray(some).data)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = []
        for file, kind, shape in zip(self.files, (np.uint8, np.int64, np.int64), ((self.n, self.width), (self.n,), (self.n,)), strict=True):
            file.flush()
            out.append(np.memmap(file, kind, "r", shape=shape) if self.n else np.zeros(shape, kind))
        return tuple(out)


class _Packed:
    """Features in groups whose bins together make few cells, so that one histogram of cells holds those of its features."""

    def __init__(self, cards: list[int], cells: int):
        self.cards, self.groups = cards, []
        sizes: list[int] = []
        for f in sorted(range(len(cards)), key=lambda f: -cards[f]):
            at = next((i for i, size in enumerate(sizes) if size * cards[f] <= cells), None)
            if at is None:
                self.groups.append([f])
                sizes.append(cards[f])
            else:
                self.groups[at].append(f)
                sizes[at] *= cards[f]
        self.groups = [sorted(group, key=lambda f: cards[f]) for group in self.groups]
        self.sizes = sizes

    def cells(self, codes: np.ndarray) -> list[np.ndarray]:
        """The cell of each row, by group."""
        out = []
        for group in self.groups:
            cell = codes[:, group[0]].astype(np.int64)
            for f in group[1:]:
                cell = cell * self.cards[f] + codes[:, f]
            out.append(cell)
        return out

    def features(self, sums: list[np.ndarray]) -> np.ndarray:
        """Histograms of features, of those of groups: the last axis becomes (feature, bin)."""
        out = np.zeros((*sums[0].shape[:-1], len(self.cards), max(self.cards)))
        for group, cells in zip(self.groups, sums, strict=True):
            for f in group:  # the first feature's bins are the outermost
                cells = cells.reshape(*out.shape[:-2], self.cards[f], -1)
                out[..., f, : self.cards[f]] = cells.sum(-1)
                cells = cells.sum(-2)
        return out


class _Grower:
    """One tree: all splits down to the depth, level by level, then the best leaves first."""

    def __init__(self, columns: np.ndarray, leaves: int, depth: int, least: int):
        self.columns, self.leaves, self.depth, self.least = columns, leaves, depth, least
        self.feature, self.bin, self.left, self.value, self.gain = (np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, float, float))

    def add(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Leaves with these sums; their numbers."""
        n, new = len(self.feature), len(g)
        own = np.arange(n, n + new)
        more = {"feature": np.zeros(new, np.int64), "bin": np.full(new, 1 << 30), "left": own, "value": -g / np.maximum(h, 1e-12), "gain": np.zeros(new)}
        for name, some in more.items():
            setattr(self, name, np.concatenate([getattr(self, name), some]))
        return own

    def split(self, nodes: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Splits the nodes, of which sums are the histograms of g, h and counts, where that gains. Gives the places of
        those split, their left children, and which of these hold fewer rows than the right ones."""
        left_g, left_h, count = sums[:, :, self.columns].cumsum(-1)
        total_g, total_h, total = (x[..., -1:] for x in (left_g, left_h, count))
        right_g, right_h, rest = total_g - left_g, total_h - left_h, total - count
        fine = (count >= self.least) & (rest >= self.least) & (left_h > 1e-3) & (right_h > 1e-3)
        gain = np.where(fine, left_g**2 / np.maximum(left_h, 1e-12) + right_g**2 / np.maximum(right_h, 1e-12) - total_g**2 / np.maximum(total_h, 1e-12), 0).reshape(len(nodes), -1)
        best = gain.argmax(1)
        most = np.take_along_axis(gain, best[:, None], 1)[:, 0]
        at = np.flatnonzero(most > 1e-9)
        f, b = np.divmod(best[at], sums.shape[-1])
        sides = [x[at, f, b] for x in (left_g, right_g, left_h, right_h)]
        ids = self.add(np.stack(sides[:2], 1).ravel(), np.stack(sides[2:], 1).ravel())[::2]
        where = nodes[at]
        self.feature[where], self.bin[where], self.left[where], self.gain[where] = self.columns[f], b, ids, most[at]
        return at, ids, count[at, f, b] <= rest[at, f, b]

    def route(self, codes: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Rows of nodes that were split go to the children."""
        own = codes.ravel().take(np.arange(0, codes.size, codes.shape[1]) + self.feature.take(node))
        return self.left.take(node) + (own > self.bin.take(node))

    def pruned(self, edges: list[np.ndarray], step: float) -> tuple[dict, np.ndarray]:
        """The tree with the best leaves split first, and for each of the nodes the value of its leaf."""
        kept: dict[str, list] = {k: [] for k in ("feature", "limit", "left", "right", "value", "gain")}
        values = self.value.copy()
        open_: list[tuple[int, int]] = []

        def leaf(full: int) -> None:
            open_.append((full, len(kept["feature"])))
            for name, v in (("feature", -1), ("limit", 0.0), ("left", open_[-1][1]), ("right", open_[-1][1]), ("value", float(step * self.value[full])), ("gain", 0.0)):
                kept[name].append(v)

        leaf(0)
        split = set()
        while (len(kept["feature"]) + 1) // 2 < self.leaves:
            best = max(range(len(open_)), key=lambda i: self.gain[open_[i][0]])
            full, node = open_[best]
            if self.gain[full] <= 1e-9:
                break
            open_.pop(best)
            split.add(full)
            f, b = int(self.feature[full]), int(self.bin[full])
            kept["feature"][node], kept["limit"][node], kept["gain"][node] = f, float(edges[f][b]), float(self.gain[full])
            for side in (0, 1):
                kept[("left", "right")[side]][node] = len(kept["feature"])
                leaf(int(self.left[full]) + side)
        for full in np.flatnonzero(self.gain > 0).tolist():  # parents come before their children
            if full not in split:
                values[self.left[full] : self.left[full] + 2] = values[full]
        return kept, step * values


def margins(trees: list[dict], base: float, x: np.ndarray) -> np.ndarray:
    """Sum of the trees' leaves for each row."""
    return all_margins([{"trees": trees, "base": base}], x)[0]


def all_margins(models: list[dict], x: np.ndarray) -> list[np.ndarray]:
    """The same of several models."""
    scorer = Scorer([t for m in models for t in m["trees"]], x.shape[1])
    bins = encode(x, scorer.cuts) if len(x) else np.zeros(x.shape, np.uint8)
    return [Scorer(m["trees"], x.shape[1], scorer.cuts).of_bins(m["base"], bins) for m in models]


class Scorer:
    """Margins of rows. Each row meets, for each tree, the sets of leaves that its bins leave open; the first leaf of
    all these sets is its own, so a tree is a few lookups whatever its depth. ``cuts`` bound the bins of each feature."""

    def __init__(self, trees: list[dict], width: int, cuts: list[np.ndarray] | None = None):
        limits: list[set] = [set() for _ in range(width)]
        for t in trees if cuts is None else []:
            for f, limit in zip(t["feature"], t["limit"], strict=True):
                if f >= 0:
                    limits[f].add(limit)
        self.cuts = [np.array(sorted(some), float) for some in limits] if cuts is None else cuts
        self.trees, self.packed = trees, _Packed([len(c) + 1 for c in self.cuts], CELLS)

    def _tables(self, t: dict) -> tuple[list[np.ndarray], np.ndarray]:
        """For each group the open leaves of each cell, as bits, and the leaves' values from left to right."""
        spans, values, todo = {}, [], [(0, False)]
        while todo:
            node, done = todo.pop()
            if t["feature"][node] < 0:
                spans[node] = (len(values), len(values) + 1)
                values.append(t["value"][node])
            elif done:
                spans[node] = (spans[t["left"][node]][0], spans[t["right"][node]][1])
            else:
                todo += [(node, True), (t["right"][node], False), (t["left"][node], False)]
        own = [np.full(c, ~np.uint64(0)) for c in self.packed.cards]
        for node, f in enumerate(t["feature"]):
            if f >= 0:
                a, b = spans[t["left"][node]]
                own[f][np.searchsorted(self.cuts[f], t["limit"][node]) + 1 :] &= ~np.uint64((1 << b) - (1 << a))
        tables = []
        for group in self.packed.groups:
            table = own[group[0]]
            for f in group[1:]:
                table = (table[:, None] & own[f]).ravel()
            tables.append(table)
        return tables, np.array(values)

    def _walk(self, t: dict, bins: np.ndarray) -> np.ndarray:
        """The leaf's value for each row, in a tree of more leaves than a set of bits holds."""
        feature, left, right, value = (np.array(t[k]) for k in ("feature", "left", "right", "value"))
        limit = np.array([np.searchsorted(self.cuts[max(f, 0)], x) for f, x in zip(t["feature"], t["limit"], strict=True)])
        node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(live := row[feature[node] >= 0]):
            at = node[live]
            node[live] = np.where(bins[live, feature[at]] <= limit[at], left[at], right[at])
        return value[node]

    def of_bins(self, base: float, bins: np.ndarray) -> np.ndarray:
        out = _room((len(bins),), float)
        for k in _chunks(len(bins)):
            out[k], cells = base, self.packed.cells(bins[k])
            for t in self.trees:
                if len(t["feature"]) > 2 * 64 - 1:
                    out[k] += self._walk(t, bins[k])
                    continue
                tables, values = self._tables(t)
                left = tables[0].take(cells[0])
                for table, cell in zip(tables[1:], cells[1:], strict=True):
                    left &= table.take(cell)
                first = ((left & -left) * _SPREAD) >> np.uint64(58)
                out[k] += values[_PLACE[first.astype(np.int64)]]
        return out


_SPREAD = np.uint64(0x03F79D71B4CB0A89)
_PLACE = np.zeros(64, np.int64)
_PLACE[[int((int(_SPREAD) << i) % 2**64 >> 58) for i in range(64)]] = range(64)


def fit_trees(x: np.ndarray, y: np.ndarray, settings) -> tuple[list[dict], float]:
    """(trees, base margin) by Newton steps on the weighted log loss."""
    if not len(x):
        return fit_rows(np.zeros((0, 0), np.uint8), np.zeros(0), np.zeros(0), [], settings)
    edges = _edges(x)
    return fit_rows(encode(x, edges), (y == 1).astype(np.int64), (y != 1).astype(np.int64), edges, settings)


def fit_rows(codes: np.ndarray, pos: np.ndarray, neg: np.ndarray, edges: list[np.ndarray], settings) -> tuple[list[dict], float]:
    """The same of rows of bins and how many of each class they stand for."""
    s, rng, n = settings, np.random.default_rng(settings.seed), len(codes)
    n_pos, n_neg = int(pos.sum()), int(neg.sum())
    share = float(np.clip(s.positive_weight * n_pos / max(s.positive_weight * n_pos + n_neg, 1e-12), 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    trees: list[dict] = []
    if not n_pos or not n_neg:
        return trees, base
    packed = _Packed([len(e) + 1 for e in edges], int(np.clip(n // 32, CELLS // 4, CELLS)))
    parts = _chunks(n)
    cells = [_room((n,), np.int16 if size <= 2**15 else np.int64) for size in packed.sizes]
    score, g, h, count, node = (_room((n,), kind) for kind in (float, float, float, float, np.int32))
    for k in parts:
        for to, cell in zip(cells, packed.cells(codes[k]), strict=True):
            to[k] = cell
    score[:] = base
    tree: _Grower | None = None
    for _ in range(s.trees):
        columns = np.sort(rng.choice(len(edges), max(1, round(float(s.columns) * len(edges))), replace=False))
        before, values, tree = tree, values if tree else None, _Grower(columns, s.leaves, s.depth, s.least)
        nodes, sums, pairs = np.zeros(1, np.int64), None, None
        for level in range(s.depth):
            # the histograms of the root, or of those children that hold fewer rows
            slots = np.zeros(1, np.int64) if pairs is None else np.full(len(tree.feature), -1)
            if pairs is not None:
                slots[pairs] = np.arange(len(pairs))
            found = [np.zeros((3, len(pairs) if pairs is not None else 1, size)) for size in packed.sizes]
            for k in parts:
                if level == 0:
                    if before is not None:
                        score[k] += values.take(before.route(codes[k], node[k]))
                    a, b = (pos[k], neg[k]) if s.rows >= 1 else (rng.binomial(pos[k], s.rows), rng.binomial(neg[k], s.rows))
                    p = 1 / (1 + np.exp(-score[k]))
                    w = s.positive_weight * a
                    count[k] = a + b
                    w_all = w + b
                    g[k], h[k], node[k] = w_all * p - w, w_all * p * (1 - p), 0
                    picked, slot = slice(None), None
                else:
                    node[k] = at = tree.route(codes[k], node[k])
                    slot = slots.take(at)
                    picked = np.flatnonzero(slot >= 0)
                    slot = slot[picked]
                weights = [x[k][picked] for x in (g, h, count)]
                for out, cell, size in zip(found, cells, packed.sizes, strict=True):
                    where = cell[k][picked]
                    where = where.astype(np.int64) if slot is None else slot * size + where
                    for row, weight in zip(out, weights, strict=True):
                        row += np.bincount(where, weight, row.size).reshape(row.shape)
            new = packed.features(found)
            if level == 0:
                sums = new
                tree.add(sums[0, :, 0].sum(-1), sums[1, :, 0].sum(-1))
            else:
                other, small = sums[:, split_at] - new, fewer[None, :, None, None]
                sums = np.stack([np.where(small, new, other), np.where(small, other, new)], 2).reshape(3, -1, *new.shape[2:])
            split_at, ids, fewer = tree.split(nodes, sums)
            if not len(ids):
                break
            nodes, pairs = np.stack([ids, ids + 1], 1).ravel(), np.where(fewer, ids, ids + 1)
        kept, values = tree.pruned(edges, s.step)
        if kept["feature"][0] < 0:
            break
        trees.append(kept)
    return trees, base


def fit_scale(margin: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> tuple[float, float]:
    """Platt's sigmoid 1 / (1 + exp(-(a m + b))) by Newton's method; with ``n`` rows of each margin, y of them positive."""
    n = np.ones(len(y)) if n is None else n
    if not 0 < y.sum() < n.sum():
        return 1.0, 0.0
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        slope, curve = 1e-6 * theta, 1e-6 * np.eye(2)
        for k in _chunks(len(y)):
            x = np.stack([margin[k], np.ones(len(margin[k]))], axis=1)
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
            slope = slope + x.T @ (n[k] * p - y[k])
            curve = curve + (x * (n[k] * p * (1 - p))[:, None]).T @ x
        move = np.linalg.solve(curve, slope)
        theta = theta - np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])
