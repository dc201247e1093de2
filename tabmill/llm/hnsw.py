"""Near-duplicate vectors by navigable small-world graphs, one for each shard.

Equal vectors are one row with a weight before anything is searched. The rest
are dealt to shards of bounded size; each shard gets a hierarchical graph
(Malkov and Yashunin) that is built in batches: a batch searches the graph so
far, compares its own members, and links up with neighbours chosen for
diversity. Then every vector queries every shard, in blocks, with a beam that
is widened until audited queries, compared with all of the shard, find on
average the share of their links that they should; beams that end inside the radius are widened together until
they don't. Links are verified by cosine in double precision,
counted where they are found, and sent on as a forest of each block, so a
dense group costs one link a member and not its pairs.

A graph travels in pieces, before the queries that are put to it, and both reach
Python in batches of bounded bytes: no row of a table is as large as a graph.

Searches move many queries in step, as numpy arrays. The method compares every
vector with a beam of every shard: the work is vectors times shards.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.components import Forest, connected_components
from tabmill.llm.shared import for_workers, staged

RADIUS = 0.95
SHARD_ROWS = 50_000
SHARD_BYTES = 32 << 20  # of float32 vectors
LEAST_SHARDS = 8  # for tasks to share
BLOCK_ROWS = 16_384  # queries of one task against one shard
LINKS = 16  # of a node in the upper layers; twice as many at the bottom
BUILD_BEAM = 64
BEAM = 32
AUDIT_EVERY = 16  # of the queries, by a hash of the node
RECALL = 0.995  # that audited queries with links must reach on average
_STEP = 256  # queries moved together
_EXPAND = 4  # nodes that each of them visits at a time
_PAIRS = 1 << 18  # pairs verified at a time
_CELLS = 1 << 21  # similarities of an audit at a time
PIECE_BYTES = 256 << 10  # of a graph on its way
BATCH_BYTES = 8 << 20  # between Spark and Python
PAIRS_WANTED = 256  # of shards and groups of blocks, for tasks to share; beyond it a graph serves several blocks


@dataclass
class Graph:
    """unit: rows of length one, and exact: in double precision. layers: neighbours of each node by layer, bottom first, -1 for none. entry: where searches start."""

    unit: np.ndarray
    exact: np.ndarray
    layers: list[np.ndarray]
    entry: int


def levels(nodes: np.ndarray) -> np.ndarray:
    """Layer of each node: geometric, from a hash of its number."""
    x = nodes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    uniform = ((x >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    return np.minimum((-np.log(uniform) / math.log(LINKS)).astype(np.int64), 12)


def beam_search(graph: Graph, queries: np.ndarray, layer: int, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, similarities) of the nearest nodes found, best first; -1 where there are fewer."""
    n, rows = len(graph.unit), len(queries)
    near, unit = graph.layers[layer], graph.unit
    beam = max(beam, start.shape[1])
    ids = np.full((rows, beam), -1, np.int64)
    sims = np.full((rows, beam), -np.inf, np.float32)
    done = np.zeros((rows, beam), bool)
    visited = np.zeros((rows, n + 1), bool)  # the last column is for -1
    visited[:, n] = True
    first = np.sort(start, axis=1)
    first[:, 1:][first[:, 1:] == first[:, :-1]] = -1
    width = first.shape[1]
    ids[:, :width] = first
    sims[:, :width] = np.where(first >= 0, np.einsum("rkd,rd->rk", unit[first], queries), -np.inf)
    np.put_along_axis(visited, np.where(first >= 0, first, n), True, axis=1)
    todo = np.arange(rows)
    while len(todo):
        open_ = np.where(done[todo], -np.inf, sims[todo])
        k = min(_EXPAND, beam)
        pick = np.argpartition(-open_, k - 1, axis=1)[:, :k] if k < beam else np.tile(np.arange(beam), (len(todo), 1))
        live = np.take_along_axis(open_, pick, 1) > -np.inf
        some = live.any(1)
        todo, pick, live = todo[some], pick[some], live[some]
        if not len(todo):
            break
        at = todo[:, None]
        done[at, pick] |= live
        found = near[np.where(live, ids[at, pick], 0)]
        found[~live] = -1
        found = np.sort(found.reshape(len(todo), -1), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        found = np.where(visited[at, found], -1, found)
        visited[at, found] = True
        # Nodes already seen sort to the front; only as many columns as any query needs are compared.
        found = -np.sort(-found, axis=1)
        found = found[:, : max(1, int((found >= 0).sum(1).max()))]
        new = np.where(found >= 0, np.einsum("rkd,rd->rk", unit[found], queries[todo]), -np.inf).astype(np.float32)
        all_sims = np.concatenate([sims[todo], new], 1)
        best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        sims[todo] = np.take_along_axis(all_sims, best, 1)
        ids[todo] = np.take_along_axis(np.concatenate([ids[todo], found], 1), best, 1)
        done[todo] = np.take_along_axis(np.concatenate([done[todo], np.zeros(new.shape, bool)], 1), best, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    sims = np.take_along_axis(sims, order, 1)
    return np.where(np.isfinite(sims), np.take_along_axis(ids, order, 1), -1), sims


def _descend(graph: Graph, queries: np.ndarray, to: int, beam: int = 4) -> np.ndarray:
    start = np.full((len(queries), 1), graph.entry, np.int64)
    for layer in range(len(graph.layers) - 1, to, -1):
        start, _ = beam_search(graph, queries, layer, start, beam)
        start = start[:, :beam]
    return start


def nearest(graph: Graph, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    return beam_search(graph, queries, 0, _descend(graph, queries, 0), beam)


def _diverse(unit: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` of the candidates of each row: those nearer to it than to any chosen before, then the nearest of the others."""
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    rows = unit[ids]
    between = rows @ rows.transpose(0, 2, 1)
    chosen = np.zeros(ids.shape, bool)
    for j in range(ids.shape[1]):
        blocked = ((between[:, j, :] > sims[:, j, None]) & chosen).any(1)
        chosen[:, j] = (ids[:, j] >= 0) & ~blocked & (chosen.sum(1) < most)
    rank = np.where(ids >= 0, sims + np.where(chosen, 4, 0), -np.inf)
    best = np.argsort(-rank, axis=1, kind="stable")[:, :most]
    out = np.where(np.isfinite(np.take_along_axis(rank, best, 1)), np.take_along_axis(ids, best, 1), -1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _link(graph: Graph, layer: int, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
    """Neighbours for new nodes, and the way back from each of them."""
    near, unit = graph.layers[layer], graph.unit
    most = near.shape[1]
    for at in range(0, len(nodes), _STEP):
        near[nodes[at : at + _STEP]] = _diverse(unit, ids[at : at + _STEP], sims[at : at + _STEP], most)
    made = near[nodes]
    source, target = np.repeat(nodes, most)[made.ravel() >= 0], made.ravel()[made.ravel() >= 0]
    order = np.lexsort((-np.einsum("kd,kd->k", unit[source], unit[target]), target))
    source, target = source[order], target[order]
    ends, begin, count = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(begin, count)
    extra = np.full((len(ends), min(most, int(count.max(initial=0)))), -1, np.int64)
    fits = place < extra.shape[1]
    extra[np.repeat(np.arange(len(ends)), count)[fits], place[fits]] = source[fits]
    for at in range(0, len(ends), _STEP):
        part = ends[at : at + _STEP]
        both = np.concatenate([near[part], extra[at : at + _STEP]], 1)
        both = -np.sort(-both, axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        known = np.where(both >= 0, np.einsum("rkd,rd->rk", unit[both], unit[part]), -np.inf)
        full = (both >= 0).sum(1) > most
        few = -np.sort(-both[~full], axis=1)[:, :most]
        near[part[~full]] = np.pad(few, ((0, 0), (0, most - few.shape[1])), constant_values=-1)
        if full.any():
            near[part[full]] = _diverse(unit, both[full], known[full], most)


def build(exact: np.ndarray, nodes: np.ndarray) -> Graph:
    """The graph of a shard: rows of length one in double precision and their numbers."""
    unit, n, level = exact.astype(np.float32), len(exact), levels(nodes)
    top = int(level.max(initial=0))
    graph = Graph(unit, exact, [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int64) for k in range(top + 1)], int(np.argmax(level)))
    # The entry comes first, so that every layer has a node when others are linked to it.
    order = np.concatenate([[graph.entry], np.delete(np.arange(n), graph.entry)])
    at = 1
    while at < n:
        batch = order[at : at + min(_STEP, max(16, at))]
        rows, mine = unit[batch], level[batch]
        among = rows @ rows.T
        np.fill_diagonal(among, -np.inf)
        start = np.full((len(batch), 1), graph.entry, np.int64)
        for layer in range(top, -1, -1):
            ids, sims = beam_search(graph, rows, layer, start, BUILD_BEAM if layer == 0 else LINKS)
            start = ids[:, :4]
            here = np.flatnonzero(mine >= layer)
            if len(here):
                k = min(LINKS, len(here))
                fellows = among[np.ix_(here, here)]
                best = np.argpartition(-fellows, k - 1, axis=1)[:, :k]
                close = np.take_along_axis(fellows, best, 1)
                fellow_ids = np.where(np.isfinite(close), batch[here][best], -1)
                _link(graph, layer, batch[here], np.concatenate([ids[here], fellow_ids], 1), np.concatenate([sims[here], close], 1))
        at += len(batch)
    return graph


def links_within(graph: Graph, queries: np.ndarray, beam: int, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) pairs of cosine from `radius`, in parts. Queries are rows of length one in double precision.

    Queries whose beam ends inside the radius are widened together: all nodes
    that any of them found, and then the neighbours of those inside any one's
    radius, are compared with all of them, until no new node is inside. A beam
    as wide as the graph compares all.
    """
    if beam >= len(graph.unit):
        step = max(1, _PAIRS // max(1, len(graph.unit)))
        for at in range(0, len(queries), step):
            q, k = np.nonzero(queries[at : at + step] @ graph.exact.T >= radius)
            yield at + q, k
        return
    single, near = queries.astype(np.float32), radius - 1e-4
    wide, nodes = [], np.zeros(len(graph.unit), bool)
    for at in range(0, len(queries), _STEP):
        ids, sims = nearest(graph, single[at : at + _STEP], min(beam, len(graph.unit)))
        full = (sims[:, -1] >= near) & (ids.shape[1] < len(graph.unit))
        wide.append(at + np.flatnonzero(full))
        nodes[ids[full]] = True
        q, k = np.nonzero((sims >= near) & (ids >= 0) & ~full[:, None])
        q, k = q + at, ids[q, k]
        for part in range(0, len(q), _PAIRS):
            a, b = q[part : part + _PAIRS], k[part : part + _PAIRS]
            sure = np.einsum("kd,kd->k", queries[a], graph.exact[b]) >= radius
            yield a[sure], b[sure]
    rows, new = np.concatenate(wide or [np.zeros(0, np.int64)]), np.flatnonzero(nodes)
    while len(rows) and len(new):
        beside = np.unique(graph.layers[0][new])
        beside = beside[(beside >= 0)]
        beside = beside[~nodes[beside]]
        inside = np.zeros(len(beside), bool)
        among, step = graph.unit[beside].T, max(1, min(_STEP, _CELLS // max(1, len(beside))))
        for at in range(0, len(rows), step):
            inside |= (single[rows[at : at + step]] @ among >= near).any(0)
        new = beside[inside]
        nodes[new] = True
    some = np.flatnonzero(nodes)
    step, exact = max(1, _PAIRS // max(1, len(some))), graph.exact[some].T if len(rows) else None
    for at in range(0, len(rows) if len(some) else 0, step):
        q, k = np.nonzero(queries[rows[at : at + step]] @ exact >= radius)
        yield rows[at + q], some[k]


def beam_for(graph: Graph, queries: np.ndarray, radius: float, beam: int = BEAM, recall: float = RECALL, own: np.ndarray | None = None) -> int:
    """The beam, doubled from `beam` on, with which the audited queries find the links they have by brute force.

    Each query with links counts once, by the share of them that it finds, so a
    large group doesn't hide small ones. `own` is the row of the graph that is
    the query itself (-1 for none); it is no link.
    """
    own = np.full(len(queries), -1) if own is None else own
    step = max(1, min(_STEP, _CELLS // max(1, len(graph.unit))))
    due = np.concatenate([(queries[at : at + step] @ graph.exact.T >= radius).sum(1) for at in range(0, len(queries), step)] or [np.zeros(0, np.int64)])
    due = due - ((own >= 0) & (np.einsum("kd,kd->k", queries, graph.exact[own]) >= radius))
    some = due > 0
    while beam < len(graph.unit) and some.any():
        got = np.zeros(len(queries), np.int64)
        for q, k in links_within(graph, queries, beam, radius):
            got += np.bincount(q[own[q] != k], minlength=len(queries))
        if (got[some] / due[some]).mean() >= recall:
            break
        # Beams of a good part of the graph cost more than comparing all.
        beam = 2 * beam if 32 * beam < len(graph.unit) else len(graph.unit)
    return beam


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float32).reshape(len(column), dim)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, vec, key) for each row: float32 bytes and a 128-bit hash; null where a vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, blobs, keys = [], [], []
            for value in batch.column(1):
                items = value.as_py()
                v = None if items is None or None in items else np.array(items, np.float32) + np.float32(0)  # no negative zeros
                if v is None or not len(v) or not np.isfinite(v).all() or not v.any():
                    v = None
                dims.append(None if v is None else len(v))
                blobs.append(None if v is None else v.tobytes())
                keys.append(None if v is None else xxhash.xxh3_128_digest(v.tobytes()))
            yield pa.record_batch([batch.column(0), pa.array(dims, pa.int32()), pa.array(blobs, pa.binary()), pa.array(keys, pa.binary())], names=["vec_id", "dim", "vec", "key"])

    slim = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>"))
    return for_workers(slim).mapInArrow(run, "vec_id long, dim int, vec binary, key binary")


def _build_shard(part: pd.DataFrame) -> pd.DataFrame:
    """The graph of a shard as bytes, in pieces; of an upper layer only the nodes that it has."""
    part = part.sort_values("node")
    dim, nodes = int(part["dim"].iloc[0]), part["node"].to_numpy()
    vectors = _matrix(part["vec"], dim)
    graph, out = build(unit_rows(vectors), nodes), io.BytesIO()
    layers = {}
    for i, near in enumerate(graph.layers):
        here = np.flatnonzero((near >= 0).any(1))
        layers |= {f"at{i}": here.astype(np.int32), f"layer{i}": near[here].astype(np.int32)}
    np.savez(out, vectors=vectors, nodes=nodes, weights=part["weight"].to_numpy(), entry=np.array([graph.entry]), **layers)
    whole = out.getbuffer()
    pieces = [bytes(whole[at : at + PIECE_BYTES]) for at in range(0, len(whole), PIECE_BYTES)]
    return pd.DataFrame({"dim": dim, "shard": int(part["shard"].iloc[0]), "part": range(len(pieces)), "piece": pieces})


def _load(pieces: list[bytes]) -> tuple[Graph, np.ndarray, np.ndarray]:
    data = np.load(io.BytesIO(b"".join(pieces)))
    exact, layers = unit_rows(data["vectors"]), []
    for i in range(sum(name.startswith("layer") for name in data.files)):
        near = data[f"layer{i}"]
        layers.append(np.full((len(exact), 2 * LINKS if i == 0 else LINKS), -1, np.int64))
        layers[i][data[f"at{i}"]] = near
    return Graph(exact.astype(np.float32), exact, layers, int(data["entry"][0])), data["nodes"], data["weights"]


def _links(graph: Graph, nodes: np.ndarray, weights: np.ndarray, mine: np.ndarray, asked: np.ndarray, radius: float) -> pa.RecordBatch:
    """(a, b, n) of a block of queries: links of its forest, and counts where b is -1."""
    audit = np.array([xxhash.xxh32_intdigest(int(x).to_bytes(8, "little")) % AUDIT_EVERY == 0 for x in mine])
    place = np.minimum(np.searchsorted(nodes, mine[audit]), len(nodes) - 1)
    beam = beam_for(graph, asked[audit], radius, own=np.where(nodes[place] == mine[audit], place, -1))
    every, place = np.unique(np.concatenate([mine, nodes]), return_inverse=True)
    of_query, of_node = place[: len(mine)], place[len(mine) :]
    forest, counted = Forest(len(every)), np.zeros(len(mine))
    for q, k in links_within(graph, asked, beam, radius):
        other = mine[q] != nodes[k]
        q, k = q[other], k[other]
        forest.add(of_query[q], of_node[k])
        counted += np.bincount(q, weights[k], len(mine))
    a, b = forest.links()
    some = np.flatnonzero(counted)
    cells = np.concatenate([mine[some], every[a]]), np.concatenate([np.full(len(some), -1), every[b]]), np.concatenate([counted[some].astype(np.int64), np.zeros(len(a), np.int64)])
    return pa.record_batch([pa.array(c, pa.int64()) for c in cells], names=["a", "b", "n"])


def _query_shards(radius: float):
    """Over sorted rows: of each shard and group of blocks the pieces of its graph (block -1), then the queries by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, pieces, held, opened = None, -1, [], [], None

        def answered() -> Iterator[pa.RecordBatch]:
            nonlocal opened, pieces, held
            if pieces:
                opened, pieces = _load(pieces), []
            # A shard without vectors has no graph.
            if held and opened is not None:
                mine = np.concatenate([n for n, _ in held])
                yield _links(*opened, mine, unit_rows(np.frombuffer(b"".join(v for _, v in held), np.float32).reshape(len(mine), -1)), radius)
            held = []

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(cuts, cuts[1:]):
                if (new := tuple(keys[:3, a].tolist())) != at or keys[3, a] != block:
                    yield from answered()
                    if new != at:
                        opened = None
                    at, block = new, int(keys[3, a])
                data = batch.column("data").slice(a, b - a).to_pylist()
                if block < 0:
                    pieces += data
                else:
                    held.append((batch.column("node").slice(a, b - a).to_numpy(), b"".join(data)))
        yield from answered()

    return run


def near_duplicates(vectors: DataFrame, radius: float = RADIUS, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, least_shards: int = LEAST_SHARDS) -> DataFrame:
    """One row for each row of `vectors` (vec_id, embedding): vec_id, n_links, component_id, kept.

    n_links counts the links that the vector's own searches verify; one that only
    the other end's search finds, which the audits keep rare, is in the component
    and in the other's count.

    Cases: a vector that is null, empty, zero or holds a null or a number that
    isn't finite has no link; vectors of different lengths don't link; equal
    vectors and repeated rows link with each other; null ids name a component
    only if it has no other; an empty table gives no rows; further columns are
    ignored.
    """
    rows = staged(usable(vectors), "vectors")
    first = rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.any_value("dim").alias("dim"), F.any_value("vec").alias("vec"))
    first = staged(first.withColumn("node", F.monotonically_increasing_id()), "different-vectors")
    # A row for each length of vectors there is.
    shape = {r["dim"]: r["n"] for r in first.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shape:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    number = {d: max(min(least_shards, n), -(-n // min(shard_rows, max(1, SHARD_BYTES // (4 * d))))) for d, n in shape.items()}
    blocks = {d: -(-n // block_rows) for d, n in shape.items()}
    per_dim = lambda values: F.create_map(*[F.lit(x) for item in values.items() for x in item])[F.col("dim")]
    dealt = first.withColumn("shard", F.pmod(F.xxhash64("node"), per_dim(number)).cast("int"))
    tasks = max(sum(number.values()), 1)
    graphs = staged(dealt.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInPandas(_build_shard, "dim int, shard int, part int, piece binary"), "graphs")

    together = max(1, sum(number[d] * blocks[d] for d in shape) // PAIRS_WANTED)
    groups = {d: -(-n // together) for d, n in blocks.items()}
    vectors.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    block = F.pmod(F.xxhash64("node", F.lit(1)), per_dim(blocks)).cast("int")
    asked = first.select("dim", "node", "vec", block.alias("block"), F.explode(F.sequence(F.lit(0), per_dim(number) - 1)).alias("shard"))
    asked = asked.select("dim", "shard", F.floor(F.col("block") / together).cast("int").alias("group"), "block", F.lit(0).alias("part"), "node", F.col("vec").alias("data"))
    offered = graphs.withColumn("group", F.explode(F.sequence(F.lit(0), per_dim(groups) - 1)))
    offered = offered.select("dim", "shard", "group", F.lit(-1).alias("block"), "part", F.lit(-1).cast("long").alias("node"), F.col("piece").alias("data"))
    keys, tasks = ["dim", "shard", "group"], max(sum(number[d] * groups[d] for d in shape), 1)
    pairs = offered.unionByName(asked).repartition(tasks, *keys).sortWithinPartitions(*keys, "block", "part", "node")
    found = staged(for_workers(pairs).mapInArrow(_query_shards(radius), "a long, b long, n long"), "vector-links")

    forest = found.where("b >= 0").select("a", "b")
    # The forest says what is reachable, not what is linked: links are counted where they are verified.
    counts = found.where("b < 0").groupBy("a").agg(F.sum("n").alias("n")).select(F.col("a").alias("node"), "n")
    labels = connected_components(forest)
    named = first.select("key", "node", "rep", "weight").join(labels, "node", "left").join(counts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("key", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "key").join(named, "key", "left")
    # Unusable vectors stand alone.
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
