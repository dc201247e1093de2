"""Random forest over the binned store, to any depth.

All trees of a batch grow together. Nodes with many rows are split level by
level from histograms, one pass for all of them. A node with no more than
`local_rows` rows is handed over: its rows meet in one group, and the subtree is
grown there. The features a node may try and the rows a tree draws follow from
hashes of (tree, path) and (tree, row), so where a node is grown doesn't change
the tree.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from math import exp, factorial, prod

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from tabmill.runtime import with_package
from tabmill.trees.boosting import Boosted, Store, residual_grid
from tabmill.trees.growth import Rules, Split, Tree, _added, best_split, in_fold
from tabmill.trees.store import opened

# Rows of a node that one task grows to the end.
LOCAL_ROWS = 50_000
TREES_AT_ONCE = 20
# Histogram cells of a pass; more nodes take several passes.
PASS_CELLS = 4_000_000
# Rows that a task takes at once.
GROUP_BYTES = 24 << 20

# Upper ends of the draws 0, 1, 2, ... of a Poisson variable of mean 1, as shares.
_DRAWS = np.cumsum([exp(-1) / factorial(k) for k in range(12)])
_TWO64 = float(1 << 64)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn_times(hashes: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row: a bootstrap sample by the hash of the row."""
    return np.searchsorted(_DRAWS, _mix(_mix(hashes, seed + 1), tree + 1) / _TWO64)


@dataclass(frozen=True)
class ForestRules:
    rules: Rules
    scale: float
    start: float
    depth: int | None
    min_split: int
    share: float
    seed: int
    fold: tuple[int, int] | None = None

    def at(self, tree: int, path: str) -> Rules:
        """The rules of a node: its features are a sample that follows from its tree and path."""
        every = np.array(self.rules.features)
        n = max(1, int(self.share * len(every)))
        if n < len(every):
            rng = np.random.default_rng([self.seed, tree, len(path), *np.frombuffer(path.encode(), np.uint8).tolist()])
            every = np.sort(rng.choice(every, n, replace=False))
        r = self.rules
        return replace(r, used=tuple(every.tolist()))

    def split(self, hist: np.ndarray, tree: int, path: str) -> Split | None:
        rules = self.at(tree, path)
        if (self.depth is not None and len(path) >= self.depth) or rules.totals(hist)[1] < self.min_split:
            return None
        return best_split(hist, rules, self.scale)

    def kept(self, hashes: np.ndarray) -> np.ndarray:
        return np.ones(len(hashes), bool) if self.fold is None else ~in_fold(hashes, self.fold, self.seed)

    def histogram(self, g: np.ndarray, n: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Of weighted residuals and draws; rows may stand for several alike ones."""
        offsets = self.rules.offsets
        hist = np.zeros((2, offsets[-1]), np.int64)
        for f in self.rules.features:
            at = slice(offsets[f], offsets[f + 1])
            hist[0, at] = np.bincount(bins[f], g, self.rules.sizes[f])
            hist[1, at] = np.bincount(bins[f], n, self.rules.sizes[f])
        return hist


@dataclass
class _Top:
    """A tree above its handed-over nodes: per node split, children, (residuals, rows) and path."""

    splits: list[Split | None] = field(default_factory=lambda: [None])
    children: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    sums: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    paths: list[str] = field(default_factory=lambda: [""])

    def tree(self, scale: float) -> Tree:
        return Tree.from_nodes([(s, *c, g / scale / n if n else 0.0) for s, c, (g, n) in zip(self.splits, self.children, self.sums)])

    def divide(self, i: int, split: Split) -> tuple[int, int]:
        n = len(self.splits)
        self.splits[i], self.children[i] = split, (n, n + 1)
        self.splits += [None, None]
        self.children += [(0, 0), (0, 0)]
        self.sums += [split.left_sum, split.right_sum]
        self.paths += [self.paths[i] + "L", self.paths[i] + "R"]
        return n, n + 1

    def graft(self, i: int, other: _Top) -> None:
        """Put a subtree in the place of leaf i."""
        place = {0: i}
        for k in range(1, len(other.splits)):
            place[k] = len(self.splits) + k - 1
        self.splits[i], self.children[i] = other.splits[0], tuple(place[c] for c in other.children[0])
        self.splits += other.splits[1:]
        self.children += [tuple(place[c] for c in pair) for pair in other.children[1:]]
        self.sums += other.sums[1:]
        self.paths += other.paths[1:]


def _gathered(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(label, hash, bins) of several blocks at once, of about GROUP_BYTES."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            held.append(opened(row, features))
            size += row["rows"] * (16 + features)
            if size >= GROUP_BYTES:
                yield tuple(np.concatenate(x, axis=-1) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x, axis=-1) for x in zip(*held))


@dataclass(frozen=True)
class _Drawn:
    """What a tree draws of some rows. Rows alike in all features are one where that leaves at most half of them.

    `g` is residuals times draws, `n` draws, `low` and `high` the residuals' ends, by row of `bins`.
    """

    g: np.ndarray
    n: np.ndarray
    low: np.ndarray
    high: np.ndarray


class _Rows:
    """Rows of a task, with their runs of alike ones found once for all trees."""

    def __init__(self, forest: ForestRules, y: np.ndarray, hashes: np.ndarray, bins: np.ndarray) -> None:
        self.forest, self.hashes, self.bins, self.starts = forest, hashes, bins, None
        self.r = np.rint((y - forest.start) * forest.scale).astype(np.int64)
        self.kept = forest.kept(hashes)
        sizes = forest.rules.sizes
        if not len(y) or prod(sizes[f] for f in forest.rules.features) >= 1 << 62:
            return
        code = np.zeros(len(y), np.int64)
        for f in forest.rules.features:
            code = code * sizes[f] + bins[f]
        order = np.argsort(code, kind="stable")
        code = code[order]
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        if 2 * len(starts) <= len(y):
            self.starts, self.r, self.hashes, self.kept = starts, self.r[order], hashes[order], self.kept[order]
            self.bins = bins[:, order[starts]]

    def drawn(self, tree: int) -> _Drawn:
        w = drawn_times(self.hashes, tree, self.forest.seed) * self.kept
        if self.starts is None:
            return _Drawn(self.r * w, w, self.r, self.r)
        ends = np.iinfo(np.int64)
        low = np.minimum.reduceat(np.where(w > 0, self.r, ends.max), self.starts)
        high = np.maximum.reduceat(np.where(w > 0, self.r, ends.min), self.starts)
        return _Drawn(np.add.reduceat(self.r * w, self.starts), np.add.reduceat(w, self.starts), low, high)


def _asked_sums(forest: ForestRules, tops: dict[int, Tree], asked: dict[tuple[int, int], int]):
    """Histograms of the asked (tree, node) pairs over a task's rows; each row is added to that of its node alone."""
    rules, offsets = forest.rules, forest.rules.offsets
    slot_of = {t: np.full(len(top.value), -1) for t, top in tops.items()}
    for (t, i), slot in asked.items():
        slot_of[t][i] = slot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = int(offsets[-1])
        sums, times = np.zeros(len(asked) * size, np.int64), np.zeros(len(asked) * size, np.int64)
        for block in _gathered(batches, len(rules.sizes)):
            rows = _Rows(forest, *block)
            for t, top in tops.items():
                drawn = rows.drawn(t)
                slot = slot_of[t][top.nodes(rows.bins)]
                mine = np.flatnonzero((slot >= 0) & (drawn.n > 0))
                first, g, n = slot[mine] * size, drawn.g[mine], drawn.n[mine]
                for f in rules.features:
                    at = first + (offsets[f] + rows.bins[f, mine])
                    np.add.at(sums, at, g)
                    np.add.at(times, at, n)
        cells = [sums[k * size : (k + 1) * size].tobytes() + times[k * size : (k + 1) * size].tobytes() for k in range(len(asked))]
        yield pa.record_batch([pa.array(range(len(asked)), pa.int32()), pa.array(cells, pa.binary())], names=["node", "sums"])

    return run


HANDED = "tree int, node int, bins binary, sums binary, times binary, low binary, high binary"


def _handed_over(forest: ForestRules, tops: dict[int, Tree], wanted: dict[int, list[int]]):
    """The rows of the nodes that are grown in one place, a row for each node and group of blocks.

    Residuals and draws of plain rows, or sums and ends of alike ones.
    """
    is_wanted = {t: np.isin(np.arange(len(tops[t].value)), nodes) for t, nodes in wanted.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.int32(), pa.int32(), *[pa.binary()] * 5
        for block in _gathered(batches, len(forest.rules.sizes)):
            rows = _Rows(forest, *block)
            for t, asked in is_wanted.items():
                drawn = rows.drawn(t)
                node = tops[t].nodes(rows.bins)
                mine = np.flatnonzero(asked[node] & (drawn.n > 0))
                if not len(mine):
                    continue
                mine = mine[np.argsort(node[mine], kind="stable")]
                here = node[mine]
                cuts = [0, *(np.flatnonzero(here[1:] != here[:-1]) + 1).tolist(), len(here)]
                bins = rows.bins[:, mine]
                plain = rows.starts is None
                columns = (rows.r[mine], drawn.n[mine].astype(np.uint8)) if plain else (drawn.g[mine], drawn.n[mine].astype("<i4"), drawn.low[mine], drawn.high[mine])
                out = []
                for a, b in zip(cuts, cuts[1:]):
                    cells = [c[a:b].tobytes() for c in columns]
                    out.append((t, int(here[a]), np.ascontiguousarray(bins[:, a:b]).tobytes(), *cells, *[None] * (4 - len(cells))))
                for at in range(0, len(out), 1024):
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out[at : at + 1024]), types)], names=["tree", "node", "bins", "sums", "times", "low", "high"])

    return run


def _grown(forest: ForestRules, paths: dict[tuple[int, int], str]):
    """(tree, node, nodes): the subtree of each handed-over node."""
    features = len(forest.rules.sizes)

    def opened_part(p: dict) -> tuple[np.ndarray, _Drawn]:
        g, plain = np.frombuffer(p["sums"], "<i8"), p["low"] is None
        n = np.frombuffer(p["times"], np.uint8 if plain else "<i4").astype(np.int64)
        ends = (g, g) if plain else (np.frombuffer(p["low"], "<i8"), np.frombuffer(p["high"], "<i8"))
        return np.frombuffer(p["bins"], np.uint8).reshape(features, -1), _Drawn(g * n if plain else g, n, *ends)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                bins, drawn = zip(*map(opened_part, row["parts"]))
                whole = _Drawn(*[np.concatenate([getattr(d, name) for d in drawn]) for name in ("g", "n", "low", "high")])
                out.append(json.dumps(grow_here(forest, row["tree"], paths[row["tree"], row["node"]], whole, np.concatenate(bins, 1))))
            yield pa.record_batch([batch.column("tree"), batch.column("node"), pa.array(out, pa.string())], names=["tree", "node", "nodes"])

    return run


def grow_here(forest: ForestRules, tree: int, path: str, drawn: _Drawn, bins: np.ndarray) -> list:
    """Nodes of a subtree from its rows: (feature, left bins, children, sums, path); no recursion, so any depth."""
    g, n = drawn.g, drawn.n
    top = _Top(sums=[(int(g.sum()), int(n.sum()))], paths=[path])
    todo = [(0, np.arange(len(g)))]
    while todo:
        i, rows = todo.pop()
        # Alike rows can't be told apart any further, and equal labels needn't be.
        if top.sums[i][1] < forest.min_split or drawn.low[rows].min() == drawn.high[rows].max():
            continue
        split = forest.split(forest.histogram(g[rows], n[rows], bins[:, rows]), tree, top.paths[i])
        if split is None:
            continue
        goes_left = np.zeros(256, bool)
        goes_left[list(split.left)] = True
        side = goes_left[bins[split.feature, rows]]
        a, b = top.divide(i, split)
        todo += [(a, rows[side]), (b, rows[~side])]
    return [[None if s is None else [s.feature, list(s.left), s.gain], list(c), list(g), p] for s, c, g, p in zip(top.splits, top.children, top.sums, top.paths)]


def _read(nodes: list) -> _Top:
    top = _Top([], [], [], [])
    for split, children, sums, path in nodes:
        top.splits.append(None if split is None else Split(split[0], tuple(split[1]), split[2], (0, 0), (0, 0)))
        top.children.append(tuple(children))
        top.sums.append(tuple(sums))
        top.paths.append(path)
    return top


def random_forest(
    store: Store, trees: int = 100, depth: int | None = None, min_split: int = 2, min_rows: int = 1, share: float = 1.0, used: Sequence[str] | None = None,
    fold: tuple[int, int] | None = None, seed: int = 42, local_rows: int = LOCAL_ROWS,
) -> Boosted:
    """Mean of trees over bootstrap samples; a part without rows gives a forest that predicts zero.

    A node is split if it holds `min_split` drawn rows and both sides keep
    `min_rows`; each node tries `share` of the features. With `fold` the rows of
    that fold are left out.
    """
    with store.held() as df:
        found = store.limits(df)
        if not found[0]:
            return Boosted(store.bins, 0.0, 1.0)
        start = (found[1] + found[2]) / 2
        # A row may be drawn up to 12 times.
        forest = ForestRules(store.rules(used=used, min_rows=min_rows), residual_grid(12 * found[0], 12 * (found[2] - found[1])), start, depth, min_split, share, seed, fold)
        out: list[Tree] = []
        for first in range(0, trees, TREES_AT_ONCE):
            out += _batch(df, forest, range(first, min(trees, first + TREES_AT_ONCE)), found[0], local_rows)
        return Boosted(store.bins, start, 1.0 / trees, out)


def _batch(df: DataFrame, forest: ForestRules, numbers: range, rows: int, local_rows: int) -> list[Tree]:
    tops = {t: _Top() for t in numbers}
    # The root's number of drawn rows isn't known yet: about that of all rows.
    local, wide = [], []
    for t in numbers:
        (local if rows <= local_rows else wide).append((t, 0))
    at_once = max(1, PASS_CELLS // int(forest.rules.offsets[-1]))
    while wide:
        trees, after = {t: top.tree(1.0) for t, top in tops.items()}, []
        for at in range(0, len(wide), at_once):
            asked = {pair: slot for slot, pair in enumerate(wide[at : at + at_once])}
            sums = with_package(df).mapInArrow(_asked_sums(forest, {t: trees[t] for t, _ in asked}, asked), "node int, sums binary")
            merged = sums.groupBy("node").agg(F.collect_list("sums").alias("parts")).mapInArrow(_added, "node int, sums binary")
            hists = {r["node"]: np.frombuffer(bytes(r["sums"]), "<i8").reshape(2, -1) for r in merged.collect()}
            for (t, i), slot in asked.items():
                top = tops[t]
                top.sums[i] = forest.rules.totals(hists[slot])
                split = forest.split(hists[slot], t, top.paths[i])
                for child in () if split is None else top.divide(i, split):
                    (local if top.sums[child][1] <= local_rows else after).append((t, child))
        wide = after
    if local:
        wanted: dict[int, list[int]] = {}
        for t, i in local:
            wanted.setdefault(t, []).append(i)
        trees = {t: tops[t].tree(1.0) for t in wanted}
        paths = {(t, i): tops[t].paths[i] for t, i in local}
        sent = with_package(df).mapInArrow(_handed_over(forest, trees, wanted), HANDED)
        listed = sent.groupBy("tree", "node").agg(F.collect_list(F.struct("bins", "sums", "times", "low", "high")).alias("parts"))
        for r in listed.mapInArrow(_grown(forest, paths), "tree int, node int, nodes string").collect():
            grown = _read(json.loads(r["nodes"]))
            tops[r["tree"]].graft(r["node"], grown)
            tops[r["tree"]].sums[r["node"]] = grown.sums[0]
    return [tops[t].tree(forest.scale) for t in numbers]
