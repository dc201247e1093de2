"""Clusters of vectors by centroids, with a file of approximations in front of the vectors.

Vectors become integers, so that every sum and distance is exact. Beside each
vector stands its approximation: a 4-bit cell for each dimension. For a
centroid, two tables give the least and the most that a cell can add to the
distance; their sums over the dimensions enclose the distance. A vector whose
interval for one centroid lies below all others is assigned by its cells
alone; only where intervals overlap is the vector itself compared, and only
with the centroids that may win. A round is one pass over the staged file; its
tasks send exact partial sums, at most a row for each centroid, dimension and
limb.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.shared import for_workers, staged

COMPONENTS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
CELLS = 16  # 4 bits
NARROW = 1 << 26  # components up to here keep a distance of 64 dimensions inside 64 bits
BLOCK_ROWS = 8192
LIMB = 40  # bits of a limb of a sum
_COUNT, _DISTANCE = -1, -2  # rows of sums that aren't dimensions
LONG = (1 << 63) - 1


def integers(vector: list) -> list[int] | None:
    """floor(1024 x) of each component, or None for a vector that isn't kept."""
    if vector is None or len(vector) != COMPONENTS or any(x is None or not math.isfinite(x) for x in vector):
        return None
    # From 2^53 on a double is an integer, and 1024 times it may be beyond a double.
    return [math.floor(SCALE * x) if abs(x) < 2.0**53 else SCALE * int(x) for x in vector]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, wide, q): the vector as 64-bit integers, or as text where one doesn't fit."""
    for batch in batches:
        ids, q, wide = [], [], []
        values = batch.column(1)
        x = None
        if not values.null_count and len(values) and np.all(np.diff(values.offsets.to_numpy()) == COMPONENTS) and not values.flatten().null_count:
            x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, COMPONENTS)
        if x is not None and np.abs(np.where(np.isfinite(x), x, 0)).max() * SCALE < NARROW:
            ok = np.isfinite(x).all(1)
            rows = np.floor(SCALE * x[ok]).astype("<i8")
            yield pa.record_batch([batch.column(0).filter(pa.array(ok)), pa.array([False] * len(rows), pa.bool_()), pa.array([r.tobytes() for r in rows], pa.binary())], names=["vec_id", "wide", "q"])
            continue
        for vec_id, vector in zip(batch.column(0), values.to_pylist()):
            found = integers(vector)
            if found is None:
                continue
            broad = max(map(abs, found)) >= NARROW
            ids.append(vec_id.as_py())
            wide.append(broad)
            q.append(",".join(map(str, found)).encode() if broad else np.array(found, "<i8").tobytes())
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(wide, pa.bool_()), pa.array(q, pa.binary())], names=["vec_id", "wide", "q"])


def unpacked(data: bytes, wide: bool) -> list[int]:
    return [int(x) for x in data.split(b",")] if wide else np.frombuffer(data, "<i8").tolist()


def _rows(q: list[bytes], wide: list[bool], exact: bool) -> np.ndarray:
    """Vectors as rows of 64-bit integers, or of Python integers where some don't fit."""
    if not exact:
        return np.frombuffer(b"".join(q), "<i8").reshape(-1, COMPONENTS)
    return np.array([unpacked(x, w) for x, w in zip(q, wide)], dtype=object).reshape(-1, COMPONENTS)


def limbs(value: int) -> list[int]:
    """The value in base 2^40, lowest first; the last limb has the sign."""
    out = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def from_limbs(parts: dict[int, int]) -> int:
    return sum(v << (LIMB * i) for i, v in parts.items())


@dataclass(frozen=True)
class Grid:
    """Edges of the cells of each dimension: cell k of a dimension holds edges[k] to edges[k + 1] - 1."""

    edges: np.ndarray  # COMPONENTS x (CELLS + 1)

    def cells(self, q: np.ndarray) -> np.ndarray:
        out = np.empty(q.shape, np.uint8)
        for d in range(COMPONENTS):
            out[:, d] = np.searchsorted(self.edges[d, 1:-1], q[:, d], side="right")
        return out

    def bounds(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and most that a cell adds to the squared distance: centroid x dimension x cell."""
        low, high = self.edges[None, :, :-1], self.edges[None, :, 1:] - 1
        c = centroids[:, :, None]
        near = np.maximum(np.maximum(low - c, c - high), 0)
        far = np.maximum(np.abs(low - c), np.abs(high - c))
        return near * near, far * far


def even_grid(least: list[int], most: list[int]) -> Grid:
    """Cells of one width between the ends of each dimension."""
    edges = np.empty((COMPONENTS, CELLS + 1), np.int64)
    for d, (a, b) in enumerate(zip(least, most)):
        edges[d] = [a + (b + 1 - a) * k // CELLS for k in range(CELLS + 1)]
    return Grid(edges)


@dataclass
class Nearest:
    """Assigns vectors to the nearest of a few centroids, by cells first."""

    centroids: list[list[int]]
    grid: Grid | None
    near: np.ndarray = field(init=False)
    far: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        if self.grid is not None:
            self.points = np.array(self.centroids, np.int64).reshape(-1, COMPONENTS)
            self.near, self.far = self.grid.bounds(self.points)
        else:
            self.points = np.array(self.centroids, dtype=object).reshape(-1, COMPONENTS)

    def distances(self, q: np.ndarray, k: int) -> np.ndarray:
        return ((q - self.points[k]) ** 2).sum(1)

    def may_win(self, cells: np.ndarray) -> np.ndarray:
        """Row x centroid: its least distance isn't beyond another's most."""
        least = np.zeros((len(cells), len(self.points)), np.int64)
        most = np.zeros_like(least)
        for d in range(COMPONENTS):
            column = cells[:, d]
            least += self.near[:, d, :].T[column]
            most += self.far[:, d, :].T[column]
        return least <= most.min(1)[:, None]

    def assign(self, q: np.ndarray, cells: np.ndarray | None) -> tuple[np.ndarray, int]:
        """Nearest centroid of each vector (ties: the smaller number), and how many vectors were fetched."""
        n, k = len(q), len(self.points)
        if self.grid is None:
            all_ = np.stack([self.distances(q, c) for c in range(k)], 1) if n else np.empty((0, k))
            return np.array([min(range(k), key=row.__getitem__) for row in all_.tolist()], np.int64), n
        may = self.may_win(cells)
        label = may.argmax(1)
        open_ = np.flatnonzero(may.sum(1) > 1)
        if len(open_):
            full, candidates = q[open_], may[open_]
            best = np.full(len(open_), LONG, np.int64)
            for c in range(k):
                asked = np.flatnonzero(candidates[:, c])
                found = self.distances(full[asked], c)
                closer = found < best[asked]
                best[asked[closer]] = found[closer]
                label[open_[asked[closer]]] = c
        return label, len(open_)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least and most of each dimension over a task's vectors that fit, and how many don't fit."""
    least = most = None
    wide = 0
    for batch in batches:
        flags = batch.column(0).to_pylist()
        q = _rows([x for x, w in zip(batch.column(1).to_pylist(), flags) if not w], [], False)
        wide += sum(flags)
        if len(q):
            least = q.min(0) if least is None else np.minimum(least, q.min(0))
            most = q.max(0) if most is None else np.maximum(most, q.max(0))
    if least is not None or wide:
        d = np.arange(COMPONENTS if least is not None else 0)
        yield pa.record_batch(
            [pa.array([*d.tolist(), -1], pa.int64()), pa.array([*(least if least is not None else []), wide], pa.int64()), pa.array([*(most if most is not None else []), wide], pa.int64())],
            names=["dimension", "least", "most"])


def _with_cells(grid: Grid):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = grid.cells(_rows(batch.column("q").to_pylist(), [], False))
            packed = (cells[:, 0::2] << 4) | cells[:, 1::2]
            yield pa.record_batch([*batch.columns, pa.array([r.tobytes() for r in packed], pa.binary())], names=["vec_id", "wide", "q", "cells"])

    return run


def _blocks(batch: pa.RecordBatch, exact: bool) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray | None]]:
    """Pieces of a batch with their vectors and cells."""
    for at in range(0, batch.num_rows, BLOCK_ROWS):
        part = batch.slice(at, BLOCK_ROWS)
        q = _rows(part.column("q").to_pylist(), part.column("wide").to_pylist(), exact)
        if exact:
            yield part, q, None
            continue
        packed = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, COMPONENTS // 2)
        cells = np.empty((len(packed), COMPONENTS), np.uint8)
        cells[:, 0::2], cells[:, 1::2] = packed >> 4, packed & 15
        yield part, q, cells


def _sums(nearest: Nearest, exact: bool, last: bool):
    """(cluster, item, limb, value): sums of components and rows, or of distances in the last pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, q, cells in _blocks(batch, exact):
                label, _ = nearest.assign(q, cells)
                for c in np.unique(label).tolist():
                    mine = q[label == c]
                    total[c, _COUNT] = total.get((c, _COUNT), 0) + len(mine)
                    if last:
                        found = sum(map(int, nearest.distances(mine, c)))
                        total[c, _DISTANCE] = total.get((c, _DISTANCE), 0) + found
                    else:
                        for d, value in enumerate(mine.sum(0).tolist()):
                            total[c, d] = total.get((c, d), 0) + value
        rows = [(c, item, i, v) for (c, item), value in total.items() for i, v in enumerate(limbs(value)) if v]
        if rows:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows)], names=["cluster", "item", "limb", "value"])

    return run


def _final(nearest: Nearest, exact: bool, inertia: dict[int, int | None], whole: int | None, digests: list[str]):
    fits = lambda v: v if v is not None and v <= LONG else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, q, cells in _blocks(batch, exact):
                label, _ = nearest.assign(q, cells)
                distance = [0] * len(q)
                for c in np.unique(label).tolist():
                    at = np.flatnonzero(label == c)
                    for i, v in zip(at.tolist(), nearest.distances(q[at], c).tolist()):
                        distance[i] = fits(int(v))
                label = label.tolist()
                yield pa.record_batch(
                    [part.column("vec_id"), pa.array(label, pa.int32()), pa.array(distance, pa.int64()), pa.array([fits(inertia.get(c)) for c in label], pa.int64()),
                     pa.array([fits(whole)] * len(label), pa.int64()), pa.array([digests[c] for c in label], pa.string())],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return run


def _gathered(file: DataFrame, nearest: Nearest, exact: bool, last: bool = False) -> dict[int, dict[int, int]]:
    """Exact sums by cluster and item: at most a few thousand numbers, whatever the input."""
    sums = for_workers(file).mapInArrow(_sums(nearest, exact, last), "cluster long, item long, limb long, value long")
    found: dict[int, dict[int, dict[int, int]]] = {}
    for r in sums.groupBy("cluster", "item", "limb").agg(F.sum("value").alias("value")).collect():
        found.setdefault(r["cluster"], {}).setdefault(r["item"], {})[r["limb"]] = r["value"]
    return {c: {item: from_limbs(parts) for item, parts in items.items()} for c, items in found.items()}


def centroid_text(centroid: list[int]) -> str:
    return ",".join(map(str, centroid))


def clustered(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """One row for each kept row of `vectors` (vec_id, embedding): its cluster, distance, inertias and centroid digest.

    Cases: vectors that are null, not of 64 components, or hold null or
    non-finite components aren't kept; a null vec_id is hashed as the empty
    text; among repeated ids the smaller vector comes first as a start; fewer
    vectors than centroids give fewer centroids; equal start vectors leave the
    later ones without members, as they were; components beyond 2^26 are
    computed with Python integers, and a distance or inertia beyond a long is
    null; an empty table gives no rows; further columns are ignored.
    """
    slim = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    kept = staged(for_workers(slim).mapInArrow(_kept, "vec_id long, wide boolean, q binary"), "integer-vectors")
    key = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    start = kept.select(key.alias("key"), "wide", "q").orderBy("key", "q").limit(centroids).collect()
    now = [unpacked(bytes(r["q"]), r["wide"]) for r in start]

    ends = for_workers(kept.select("wide", "q")).mapInArrow(_ends, "dimension long, least long, most long")
    found = {r["dimension"]: r for r in ends.groupBy("dimension").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect()}
    exact = bool(found) and found[-1]["most"] > 0
    if not found or exact:
        grid, file = None, kept.withColumn("cells", F.lit(None).cast("binary"))
    else:
        grid = even_grid([found[d]["least"] for d in range(COMPONENTS)], [found[d]["most"] for d in range(COMPONENTS)])
        file = staged(for_workers(kept).mapInArrow(_with_cells(grid), "vec_id long, wide boolean, q binary, cells binary"), "va-file")
    for _ in range(rounds if now else 0):
        sums = _gathered(file, Nearest(now, grid), exact)
        after = [[sums[c].get(d, 0) // sums[c][_COUNT] for d in range(COMPONENTS)] if c in sums else old for c, old in enumerate(now)]
        if after == now:
            break  # every later round would repeat this one
        now = after
    nearest = Nearest(now, grid)
    sums = _gathered(file, nearest, exact, last=True) if now else {}
    inertia = {c: items.get(_DISTANCE, 0) for c, items in sums.items()}
    digests = [hashlib.sha256(centroid_text(c).encode()).hexdigest() for c in now]
    return for_workers(file).mapInArrow(
        _final(nearest, exact, inertia, sum(inertia.values()), digests), "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")


def _oracle() -> str:
    rounds = []
    for i in range(ROUNDS + 1):
        rounds.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM
      (SELECT v.vec_id, c.c, list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{i} c) GROUP BY 1)""")
        if i < ROUNDS:
            rounds.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN (SELECT cluster, list(m ORDER BY d) AS q FROM
      (SELECT a.cluster, l.d, ((sum(l.x) - (sum(l.x) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS m FROM a{i} a JOIN l USING (vec_id) GROUP BY 1, 2) GROUP BY 1) m ON m.cluster = c.c)""")
    return f"""WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    l AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS d, unnest(q) AS x FROM v),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, q FROM v ORDER BY sha256('3:' || vec_id) LIMIT 8),
    {", ".join(rounds)},
    s AS (SELECT cluster, sum(distance) AS t FROM a{ROUNDS} GROUP BY 1)
    SELECT a.vec_id, a.cluster::INTEGER AS cluster, a.distance, s.t::BIGINT AS cluster_inertia, (SELECT sum(t) FROM s)::BIGINT AS inertia,
    sha256(list_aggregate(c.q, 'string_agg', ',')) AS centroid_sha256 FROM a{ROUNDS} a JOIN s ON s.cluster = a.cluster JOIN c{ROUNDS} c ON c.c = a.cluster"""


#: For distinct ids.
ORACLE_SQL = _oracle()
