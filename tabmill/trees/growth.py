"""Growth of regression trees from histograms by (node, feature, bin).

A pass reads the store once: each task adds the residuals of its rows to the
bins of the asked nodes, and the sums of all tasks are added by node. Residuals
are integers on a fixed grid, so the sums, and with them the trees, are the
same for any partitioning. Of two siblings only the smaller is asked for; the
larger is its parent less the smaller. The driver holds histograms of one tree
(nodes x bins), never rows.

Rows that fit one place (`Held`) are kept there instead: the same sums, without a
pass for each level.

Trees are grown best-first (`leafwise`): the leaf of the largest gain is split
next until there are enough leaves. All nodes that may be among the splits that
are left get their children in one pass, so a tree takes about as many passes
as it has levels; the order in which splits are taken is unchanged by it. `symmetric` takes one
split for all leaves of a level.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.runtime import with_package
from tabmill.trees.store import BLOCK_ROWS, opened

# Partial sums of one node that one merging task adds up at most, before a second one adds up theirs.
MERGE_PARTS = 64
TRAIN = "train"


@dataclass(frozen=True)
class Split:
    """A feature and the bins of it that go left."""

    feature: int
    left: tuple[int, ...]
    gain: float
    left_sum: tuple[int, int]  # residuals on their grid, rows
    right_sum: tuple[int, int]


@dataclass
class Tree:
    """Nodes as arrays: feature, children and a bit for each of 256 bins that goes left. A leaf is its own child."""

    feature: np.ndarray
    child: np.ndarray  # node x (right, left)
    left: np.ndarray  # node x 32 bytes
    value: np.ndarray

    @staticmethod
    def from_nodes(nodes: Sequence[tuple[Split | None, int, int, float]]) -> Tree:
        n = len(nodes)
        tree = Tree(np.zeros(n, np.int32), np.stack([np.arange(n), np.arange(n)], 1).astype(np.int32), np.zeros((n, 32), np.uint8), np.zeros(n))
        for i, (split, left, right, value) in enumerate(nodes):
            tree.value[i] = value
            if split is not None:
                tree.feature[i], tree.child[i] = split.feature, (right, left)
                goes_left = np.zeros(256, np.uint8)
                goes_left[list(split.left)] = 1
                tree.left[i] = np.packbits(goes_left, bitorder="little")
        return tree

    def left_bins(self, node: int) -> np.ndarray:
        """Whether each of 256 bins goes left at a node."""
        return np.unpackbits(self.left[node], bitorder="little").astype(bool)

    @property
    def depth(self) -> int:
        deep, level = 0, np.array([0])
        while len(level := level[self.child[level, 0] != level]):
            level, deep = self.child[level].ravel(), deep + 1
        return deep

    @property
    def leaves(self) -> int:
        return int((self.child[:, 0] == np.arange(len(self.child))).sum())

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row; bins are feature x row."""
        node = np.zeros(bins.shape[1], np.int32)
        row = np.arange(bins.shape[1])
        for _ in range(self.depth):
            b = bins[self.feature[node], row]
            node = self.child[node, (self.left[node, b >> 3] >> (b & 7)) & 1]
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins)]

    def to_dict(self) -> dict:
        return {"feature": self.feature.tolist(), "child": self.child.tolist(), "left": self.left.tobytes().hex(), "value": self.value.tolist()}

    @staticmethod
    def from_dict(d: dict) -> Tree:
        left = np.frombuffer(bytes.fromhex(d["left"]), np.uint8).reshape(-1, 32)
        return Tree(np.array(d["feature"], np.int32), np.array(d["child"], np.int32).reshape(-1, 2), left, np.array(d["value"], float))


@dataclass(frozen=True)
class Rules:
    """What a split must keep to. Categories are told by their place among the features."""

    sizes: tuple[int, ...]
    categorical: frozenset[int] = frozenset()
    min_rows: int = 20
    min_split: int = 0  # rows that a node needs to be split
    l2: float = 0.0
    min_gain: float = 0.0
    smooth: float = 10.0  # rows added to a category before its mean residual orders it
    used: tuple[int, ...] | None = None  # features that may be split; all if None

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)]).astype(int)

    @property
    def features(self) -> tuple[int, ...]:
        return tuple(range(len(self.sizes))) if self.used is None else self.used

    def totals(self, hist: np.ndarray) -> tuple[int, int]:
        """Residuals and rows of a node: every feature has each row in one of its bins."""
        f = self.features[0]
        at = slice(self.offsets[f], self.offsets[f + 1])
        return int(hist[0, at].sum()), int(hist[1, at].sum())


def _side(g: np.ndarray, n: np.ndarray, l2: float) -> np.ndarray:
    return np.divide(g * g, n + l2, out=np.zeros(np.broadcast(g, n).shape), where=n + l2 > 0)


def _candidates(g: np.ndarray, n: np.ndarray, categorical: bool, smooth: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums left of each candidate cut of a feature, and the order of its bins.

    Candidate k < size - 1 has bins order[:k + 1] on the left and missing ones on
    the right; the candidates behind these have missing ones on the left too.
    """
    size = len(g)
    if categorical:
        # For squared error, one cut of the categories ordered by mean residual is the best of all their splits.
        order = np.lexsort((np.arange(size), g / (n + smooth)))
        return np.cumsum(g[order])[:-1], np.cumsum(n[order])[:-1], order
    a, b = np.cumsum(g[:-1]), np.cumsum(n[:-1])
    return np.concatenate([a, a + g[-1]]), np.concatenate([b, b + n[-1]]), np.arange(size)


def _left_bins(k: int, order: np.ndarray, categorical: bool) -> tuple[int, ...]:
    size = len(order)
    if categorical:
        return tuple(sorted(order[: k + 1].tolist()))
    return (*range(k + 1),) if k < size - 1 else (*range(k + 2 - size), size - 1)


def best_split(hist: np.ndarray, rules: Rules, scale: float) -> Split | None:
    """Split of the largest gain of a node; ties go to the first feature, then the first candidate.

    `hist` is (residuals on their grid, rows) x bins. The gain is in squared
    residuals: what the split takes off the squared error.
    """
    best: Split | None = None
    offsets = rules.offsets
    total_g, total_n = rules.totals(hist)
    if total_n < rules.min_split:
        return None
    parent = float(_side(np.array(total_g / scale), np.array(float(total_n)), rules.l2))
    for f in rules.features:
        g, n = hist[:, offsets[f] : offsets[f + 1]]
        left_g, left_n, order = _candidates(g, n, f in rules.categorical, rules.smooth)
        right_g, right_n = total_g - left_g, total_n - left_n
        gain = _side(left_g / scale, left_n, rules.l2) + _side(right_g / scale, right_n, rules.l2) - parent
        gain[(left_n < max(1, rules.min_rows)) | (right_n < max(1, rules.min_rows))] = -np.inf
        if not len(gain):
            continue
        k = int(gain.argmax())
        if gain[k] > rules.min_gain and (best is None or gain[k] > best.gain):
            best = Split(f, _left_bins(k, order, f in rules.categorical), float(gain[k]), (int(left_g[k]), int(left_n[k])), (int(right_g[k]), int(right_n[k])))
    return best


def level_split(hists: Sequence[np.ndarray], rules: Rules, scale: float) -> tuple[int, tuple[int, ...], float] | None:
    """One split for all nodes of a level: that of the largest summed gain. (feature, bins that go left, gain)."""
    offsets, best = rules.offsets, None
    stack = np.stack(hists)
    for f in rules.features:
        g, n = stack[:, 0, offsets[f] : offsets[f + 1]], stack[:, 1, offsets[f] : offsets[f + 1]]
        order = np.arange(g.shape[1])
        if f in rules.categorical:
            order = _candidates(g.sum(0), n.sum(0), True, rules.smooth)[2]
            left_g, left_n = np.cumsum(g[:, order], 1)[:, :-1], np.cumsum(n[:, order], 1)[:, :-1]
        else:
            a, b = np.cumsum(g[:, :-1], 1), np.cumsum(n[:, :-1], 1)
            left_g, left_n = np.concatenate([a, a + g[:, -1:]], 1), np.concatenate([b, b + n[:, -1:]], 1)
        total_g, total_n = g.sum(1, keepdims=True), n.sum(1, keepdims=True)
        gain = (_side(left_g / scale, left_n, rules.l2) + _side((total_g - left_g) / scale, total_n - left_n, rules.l2) - _side(total_g / scale, total_n, rules.l2)).sum(0)
        # A cut that parts no rows of any node is none.
        gain[((left_n == 0) | (left_n == total_n)).all(0)] = -np.inf
        if not len(gain):
            continue
        k = int(gain.argmax())
        if gain[k] > rules.min_gain and (best is None or gain[k] > best[2]):
            best = f, _left_bins(k, order, f in rules.categorical), float(gain[k])
    return best


def goes(split: Split | tuple, hist: np.ndarray, rules: Rules) -> tuple[tuple[int, int], tuple[int, int]]:
    """(residuals, rows) on the left and on the right of a split."""
    f, left = (split.feature, split.left) if isinstance(split, Split) else split[:2]
    at = rules.offsets[f]
    g, n = hist[:, at : at + rules.sizes[f]]
    inside = list(left)
    a = int(g[inside].sum()), int(n[inside].sum())
    return a, (int(g.sum()) - a[0], int(n.sum()) - a[1])


def in_fold(hashes: np.ndarray, fold: tuple[int, int], seed: int) -> np.ndarray:
    """Whether the row of each hash belongs to the fold (number, folds)."""
    mixed = (hashes ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)) % np.uint64(fold[1]) == np.uint64(fold[0])


# Passes


@dataclass
class Fit:
    """What a task needs to know of the state: trees so far, the tree being grown, and the nodes asked for.

    `start` is the prediction before all trees, `rate` their weight.
    """

    rules: Rules
    start: float
    rate: float
    scale: float
    trees: list[Tree] = field(default_factory=list)
    growing: Tree | None = None
    slots: dict[int, int] = field(default_factory=dict)
    holdout: int = 0  # of 1000 rows of the train part, those kept out to measure the error; a divisor of 1000
    fold: tuple[int, int] | None = None  # (number, folds): the rows of this fold are kept out instead
    seed: int = 42

    def predict(self, bins: np.ndarray, base: np.ndarray | None = None) -> np.ndarray:
        out = np.full(bins.shape[1], self.start) if base is None else base.copy()
        for tree in self.trees:
            out += self.rate * tree.predict(bins)
        return out

    def held_out(self, hashes: np.ndarray) -> np.ndarray:
        if self.fold is not None:
            return in_fold(hashes, self.fold, self.seed)
        return in_fold(hashes, (0, 1000 // self.holdout), self.seed) if self.holdout else np.zeros(len(hashes), bool)


def _base(row: dict) -> np.ndarray | None:
    return np.frombuffer(row["base"], "<f8") if row.get("base") is not None else None


def _add_rows(sums: np.ndarray, rules: Rules, offsets: np.ndarray, slot: np.ndarray, r: np.ndarray, bins: np.ndarray) -> None:
    """Residuals (on their grid) and rows of a block to the bins of their slots."""
    slots = len(sums)
    for f in rules.features:
        size = rules.sizes[f]
        index = slot * size + bins[f]
        at = slice(offsets[f], offsets[f + 1])
        # Integers below 2^53 in doubles: the sums of a block are exact.
        sums[:, 0, at] += np.bincount(index, r, slots * size).astype(np.int64).reshape(slots, size)
        sums[:, 1, at] += np.bincount(index, minlength=slots * size).reshape(slots, size)


def _histograms(fit: Fit):
    """(node, sums, part): per task, for each asked node residuals and rows by bin; node -1 has errors and rows, held out and not."""
    rules, offsets = fit.rules, fit.rules.offsets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = len(fit.slots)
        sums = np.zeros((slots, 2, offsets[-1]), np.int64)
        errors = np.zeros(4, np.int64)
        slot_of = np.full(1 if fit.growing is None else len(fit.growing.value), -1)
        for node, slot in fit.slots.items():
            slot_of[node] = slot
        for batch in batches:
            for row in batch.to_pylist():
                y, hashes, bins = opened(row, len(rules.sizes))
                residual = y - fit.predict(bins, _base(row))
                out = fit.held_out(hashes)
                squares = np.rint(residual * residual * (1 << 20)).astype(np.int64)
                errors += [int(squares[~out].sum()), int((~out).sum()), int(squares[out].sum()), int(out.sum())]
                slot = np.zeros(len(y), np.int64) if fit.growing is None else slot_of[fit.growing.nodes(bins)]
                asked = np.flatnonzero((slot >= 0) & ~out)
                if not slots or not len(asked):
                    continue
                _add_rows(sums, rules, offsets, slot[asked], np.rint(residual[asked] * fit.scale), bins[:, asked])
        nodes = [*fit.slots, -1]
        cells = [*(x.tobytes() for x in sums), errors.tobytes()]
        yield pa.record_batch([pa.array(nodes, pa.int32()), pa.array(cells, pa.binary())], names=["node", "sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [np.add.reduce([np.frombuffer(x, "<i8") for x in parts]).tobytes() for parts in batch.column("parts").to_pylist()]
        yield pa.record_batch([batch.column("node"), pa.array(out, pa.binary())], names=["node", "sums"])


@dataclass
class Part:
    """Rows of the store that a model is fitted on, and the number of tasks that read them."""

    df: DataFrame
    tasks: int

    def scan(self, fit: Fit) -> tuple[dict[int, np.ndarray], tuple[int, int, int, int]]:
        return scan(self, fit)


class Held:
    """Rows of the store in one place. Predictions stay from tree to tree, the nodes of rows from scan to scan of a tree."""

    def __init__(self, y: np.ndarray, hashes: np.ndarray, bins: np.ndarray) -> None:
        self.y, self.hashes, self.bins = y, hashes, bins
        self.base, self.out, self.kept = None, None, np.zeros(0, np.int64)

    def scan(self, fit: Fit) -> tuple[dict[int, np.ndarray], tuple[int, int, int, int]]:
        """What `scan` gives; a tree's first scan is that of its root, and its nodes keep their numbers."""
        if fit.growing is None:
            self._begin(fit)
        else:
            self._move(fit.growing)
        rules, offsets, slots = fit.rules, fit.rules.offsets, len(fit.slots)
        sums = np.zeros((slots, 2, offsets[-1]), np.int64)
        slot_of = np.full(int(self.node.max(initial=0)) + 1 if fit.growing is None else len(fit.growing.value), -1)
        for node, slot in fit.slots.items():
            slot_of[node] = slot
        slot = slot_of[self.node]
        asked = np.flatnonzero(slot >= 0) if slots else np.zeros(0, np.int64)
        for at in range(0, len(asked), BLOCK_ROWS):
            rows = asked[at : at + BLOCK_ROWS]
            r, mine, bins = np.rint(self.residual[rows] * fit.scale), slot[rows], self.bins[:, self.kept[rows]]
            _add_rows(sums, rules, offsets, mine, r, bins)
        return {node: sums[slot] for node, slot in fit.slots.items()}, self.errors

    def _begin(self, fit: Fit) -> None:
        if self.out is None:
            self.out = fit.held_out(self.hashes)
            self.kept = np.flatnonzero(~self.out)
        predicted = np.full(len(self.y), fit.start) if self.base is None else self.base
        residual = self.y - predicted
        squares = np.rint(residual * residual * (1 << 20)).astype(np.int64)
        self.errors = int(squares[~self.out].sum()), int((~self.out).sum()), int(squares[self.out].sum()), int(self.out.sum())
        self.residual, self.node = residual[self.kept], np.zeros(len(self.kept), np.int32)

    def _move(self, tree: Tree) -> None:
        rows = np.arange(len(self.node))
        while len(rows := rows[tree.child[self.node[rows], 0] != self.node[rows]]):
            node = self.node[rows]
            b = self.bins[tree.feature[node], self.kept[rows]]
            self.node[rows] = tree.child[node, (tree.left[node, b >> 3] >> (b & 7)) & 1]

    def add(self, fit: Fit) -> None:
        """The trees of `fit` go into the predictions."""
        self.base = fit.predict(self.bins, self.base)
        fit.trees = []


def scan(part: Part, fit: Fit) -> tuple[dict[int, np.ndarray], tuple[int, int, int, int]]:
    """Histograms of the asked nodes, and (squared errors, rows) of trained and held-out rows."""
    sums = with_package(part.df).mapInArrow(_histograms(fit), "node int, sums binary")
    if part.tasks > MERGE_PARTS:
        dealt = sums.groupBy("node", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)).alias("part"))
        sums = dealt.agg(F.collect_list("sums").alias("parts")).mapInArrow(_added, "node int, sums binary")
    merged = sums.groupBy("node").agg(F.collect_list("sums").alias("parts")).mapInArrow(_added, "node int, sums binary")
    found = {r["node"]: np.frombuffer(bytes(r["sums"]), "<i8") for r in merged.collect()}
    errors = tuple(int(x) for x in found.pop(-1, np.zeros(4, np.int64)))
    empty = np.zeros(2 * fit.rules.offsets[-1], np.int64)
    return {node: found.get(node, empty).reshape(2, -1) for node in fit.slots}, errors


# Growth


@dataclass
class _Node:
    hist: np.ndarray
    depth: int
    split: Split | None
    children: tuple[int, int] | None = None


def _leaf(sums: tuple[int, int], rules: Rules, scale: float) -> float:
    return sums[0] / scale / (sums[1] + rules.l2) if sums[1] + rules.l2 > 0 else 0.0


def _chosen(nodes: list[_Node], leaves: int, depth: int | None) -> tuple[list[int], list[int]]:
    """Best-first over the known nodes: the splits taken, and the nodes whose children the next pass must bring.

    The walk ends at a node with unknown children; the list is empty once there
    are enough leaves. A node is split after its ancestors, so it waits for the
    least gain on its path: only the nodes of the largest such gains can be among
    the splits that are left, and all of these get their children at once.
    """
    may = lambda i: nodes[i].split is not None and (depth is None or nodes[i].depth < depth)
    heap = [(-nodes[0].split.gain, 0, 0)] if may(0) else []
    taken, order = [], 1
    while heap and len(taken) + 1 < leaves:
        i = heap[0][2]
        left = leaves - 1 - len(taken)
        if nodes[i].children is None and left > 1:
            reach, todo = [], [(j, -g) for g, _, j in heap]
            while todo:
                j, least = todo.pop()
                reach.append((-least, j))
                todo += [(c, min(least, nodes[c].split.gain)) for c in nodes[j].children or () if may(c)]
            near = {i, *(j for _, j in sorted(reach)[:left])}
            return taken, sorted(j for j in near if nodes[j].children is None)
        heapq.heappop(heap)
        taken.append(i)
        for child in nodes[i].children or ():
            if may(child):
                heapq.heappush(heap, (-nodes[child].split.gain, order, child))
            order += 1
    return taken, []


def leafwise(part: Part | Held, fit: Fit, leaves: int, depth: int | None, root: np.ndarray) -> tuple[Tree, list[Split]]:
    """A best-first tree from the root's histogram, and its splits in the order they were taken."""
    rules, scale = fit.rules, fit.scale
    nodes = [_Node(root, 0, best_split(root, rules, scale))]
    while True:
        taken, open_ = _chosen(nodes, leaves, depth)
        if not open_:
            break
        grown = _partial(nodes, open_)
        slots, smaller = {}, {}
        for i in open_:
            a, b = goes(nodes[i].split, nodes[i].hist, rules)
            side = 0 if a[1] <= b[1] else 1
            smaller[i] = side
            slots[grown.child[i, 1 - side].item()] = len(slots)
        fit.growing, fit.slots = grown, slots
        found, _ = part.scan(fit)
        for i in open_:
            kept = grown.child[i, ::-1].tolist()  # left, right
            small = found[kept[smaller[i]]]
            hists = (small, nodes[i].hist - small) if smaller[i] == 0 else (nodes[i].hist - small, small)
            deep = nodes[i].depth + 1
            nodes[i].children = (len(nodes), len(nodes) + 1)
            for h in hists:
                nodes.append(_Node(h, deep, best_split(h, rules, scale) if depth is None or deep < depth else None))
    fit.growing, fit.slots = None, {}
    splits = [nodes[i].split for i in taken]
    return _final(nodes, taken, rules, scale, root), splits


def _partial(nodes: list[_Node], open_: list[int]) -> Tree:
    """The tree of all known nodes, with two new leaves behind each open one; node numbers stay."""
    rows = [(n.split if n.children else None, *(n.children or (0, 0)), 0.0) for n in nodes]
    for i in open_:
        rows[i] = (nodes[i].split, len(rows), len(rows) + 1, 0.0)
        rows += [(None, 0, 0, 0.0), (None, 0, 0, 0.0)]
    return Tree.from_nodes(rows)


def _final(nodes: list[_Node], taken: list[int], rules: Rules, scale: float, root: np.ndarray) -> Tree:
    rows: list[tuple[Split | None, int, int, float]] = [(None, 0, 0, _leaf(rules.totals(root), rules, scale))]
    place = {0: 0}
    for i in taken:
        split = nodes[i].split
        rows[place[i]] = (split, len(rows), len(rows) + 1, 0.0)
        for k, child in enumerate(nodes[i].children or ()):
            place[child] = len(rows) + k
        rows += [(None, 0, 0, _leaf(split.left_sum, rules, scale)), (None, 0, 0, _leaf(split.right_sum, rules, scale))]
    return Tree.from_nodes(rows)


def symmetric(part: Part | Held, fit: Fit, depth: int, root: np.ndarray) -> Tree:
    """A tree with one split for each level; its leaves are 2^depth values by the bits of the splits, empty ones zero."""
    rules, scale = fit.rules, fit.scale
    level, splits = [root], []
    for deep in range(depth):
        split = level_split(level, rules, scale)
        if split is None:
            break
        splits.append(split)
        if deep + 1 == depth:
            break
        # Leaf i of a level has the children 2i (right) and 2i + 1 (left).
        grown = _complete(splits, [0.0] * (1 << len(splits)))
        first = (1 << len(splits)) - 1
        slots, small = {}, []
        for i, hist in enumerate(level):
            a, b = goes(split, hist, rules)
            side = 1 if a[1] <= b[1] else 0
            small.append(side)
            slots[first + 2 * i + side] = len(slots)
        fit.growing, fit.slots = grown, slots
        found, _ = part.scan(fit)
        after = []
        for i, (hist, side) in enumerate(zip(level, small)):
            asked = found[first + 2 * i + side]
            after += [hist - asked, asked] if side == 1 else [asked, hist - asked]
        level = after
    fit.growing, fit.slots = None, {}
    if not splits:
        return Tree.from_nodes([(None, 0, 0, _leaf(rules.totals(root), rules, scale))])
    values = []
    for hist in level:
        left, right = goes(splits[-1], hist, rules)
        values += [_leaf(right, rules, scale), _leaf(left, rules, scale)]
    return _complete(splits, values)


def _complete(splits: list[tuple], values: list[float]) -> Tree:
    """Complete tree of the level splits, nodes by level: node i has the children 2i + 1 (right) and 2i + 2 (left)."""
    rows: list[tuple[Split | None, int, int, float]] = []
    for f, left, gain in splits:
        for _ in range(len(rows) + 1):
            i = len(rows)
            rows.append((Split(f, left, gain, (0, 0), (0, 0)), 2 * i + 2, 2 * i + 1, 0.0))
    return Tree.from_nodes([*rows, *[(None, 0, 0, v) for v in values]])
