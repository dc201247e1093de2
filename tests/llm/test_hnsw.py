"""Graph search against brute force, and the operator's links, counts and components."""

import numpy as np
import pytest

from tabmill.llm import hnsw as h

SCHEMA = "vec_id long, embedding array<float>, label int, key string, shard int"


def vectors(rng, groups, spread, lonely, d=24):
    out = [c + rng.normal(0, s, (n, d)) for (n, s), c in zip([(g, spread) for g in groups], rng.normal(0, 1, (len(groups), d)))]
    return np.concatenate([*out, rng.normal(0, 1, (lonely, d))]).astype(np.float32)


def slow(items, radius=0.95):
    """vec_id -> (n_links, component) over (row number, vector or None)."""
    n = len(items)
    x = np.array([np.zeros(1) if v is None else v for _, v in items], dtype=object)
    link = np.zeros((n, n), bool)
    for dim in {len(v) for _, v in items if v is not None}:
        at = [i for i, (_, v) in enumerate(items) if v is not None and len(v) == dim and None not in list(v) and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
        if at:
            m = np.array([list(x[i]) for i in at], np.float32).astype(np.float64)
            m /= np.linalg.norm(m, axis=1, keepdims=True)
            link[np.ix_(at, at)] = m @ m.T >= radius - 1e-12
    np.fill_diagonal(link, False)
    label = np.array([i for i, _ in items])
    while True:
        new = np.array([min([label[i], *label[link[i]]]) for i in range(n)])
        if (new == label).all():
            return link.sum(1), label
        label = new


@pytest.mark.parametrize(("groups", "spread"), [((2,) * 40, 0.05), ((300, 120, 5), 0.05), ((400,), 0.2)])
def test_search_finds_all_links(groups, spread):
    rng = np.random.default_rng(len(groups))
    unit = h.unit_rows(vectors(rng, groups, spread, 900))
    graph = h.build(unit, np.arange(len(unit)))
    assert len(graph.layers) > 1 and (graph.layers[0] >= 0).any(1).all()
    beam = h.beam_for(graph, unit[::5], 0.95)
    parts = list(h.links_within(graph, unit, beam, 0.95))
    q, k = (np.concatenate([x[i] for x in parts]) for i in (0, 1))
    want = unit @ unit.T >= 0.95
    got = np.zeros_like(want)
    got[q, k] = True
    assert not (got & ~want).any() and got.sum() >= 0.995 * want.sum() and len(q) == got.sum()


def test_top_neighbours_of_unclustered_vectors():
    rng = np.random.default_rng(8)
    unit = h.unit_rows(rng.normal(0, 1, (2000, 16)).astype(np.float32))
    ids, sims = h.nearest(h.build(unit, np.arange(2000)), unit[:200].astype(np.float32), 64)
    exact = np.argsort(-(unit[:200] @ unit.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids.tolist(), exact.tolist())]) > 0.95
    assert (np.diff(sims, axis=1) <= 0).all()


def test_operator_against_brute_force(rows):
    rng = np.random.default_rng(4)
    x = vectors(rng, (60, 2, 2, 3, 9), 0.04, 150).tolist()
    items = [(1000 - i, v) for i, v in enumerate(x)]
    items += [(2000 + i, x[100]) for i in range(40)] + [(2100, [2 * a for a in x[100]]), (2101, [1.0, 0.0]), (2102, [1.0, 0.01])]
    items += [(2200, None), (2201, []), (2202, [0.0] * 24), (2203, [None] + [1.0] * 23), (2204, [float("nan")] + [1.0] * 23), (2205, [float("inf")] * 24), (2206, [1e-30] * 24)]
    items.append(items[0])
    n_links, label = slow(items)
    df = rows([(i, v, 0, "x", 1) for i, v in items], SCHEMA)
    got = h.near_duplicates(df, shard_rows=60, block_rows=70, least_shards=2).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == sorted((i, int(n), int(c), i == c) for (i, _), n, c in zip(items, n_links, label))


def test_nothing_to_link(rows):
    assert h.near_duplicates(rows([], SCHEMA)).collect() == []
    got = h.near_duplicates(rows([(1, None, 0, "", 0), (None, [0.0], 0, "", 0)], SCHEMA)).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {(1, 0, 1, True), (None, 0, None, True)}
    got = h.near_duplicates(rows([(5, [1.0, 2.0], 0, "", 0)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(5, 0, 5, True)]


def test_a_large_group_does_not_hide_lost_pairs():
    rng = np.random.default_rng(12)
    unit = h.unit_rows(vectors(rng, (300, *[2] * 60), 0.04, 200))
    graph = h.build(unit, np.arange(len(unit)))
    want = unit @ unit.T >= 0.95
    np.fill_diagonal(want, False)
    # Links of the bottom layer to the nodes of pairs are cut, so that narrow beams miss them.
    pair = (np.arange(len(unit)) >= 300) & (np.arange(len(unit)) < 420)
    cut = rng.random(graph.layers[0].shape) < 0.9
    graph.layers[0][(graph.layers[0] >= 0) & pair[graph.layers[0]] & cut] = -1
    own = np.arange(len(unit))

    def recall(beam):
        got = np.zeros(len(unit))
        for q, k in h.links_within(graph, unit, beam, 0.95):
            got += np.bincount(q[q != k], minlength=len(unit))
        return (got[want.any(1)] / want.sum(1)[want.any(1)]).mean()

    beam = h.beam_for(graph, unit, 0.95, own=own)
    assert recall(h.BEAM) < h.RECALL <= recall(beam)


def test_links_of_chains_are_counted_at_their_ends_only(rows):
    # Steps of 15 degrees: neighbours link (0.966), those two steps apart don't (0.866).
    turns = np.deg2rad(15 * np.arange(12))
    items = [(i, [float(np.cos(t)), float(np.sin(t)), 0.0]) for i, t in enumerate(turns)]
    df = rows([(i, v, 0, "x", 1) for i, v in items], SCHEMA)
    got = h.near_duplicates(df, shard_rows=5, block_rows=4, least_shards=2).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(i, 1 if i in (0, 11) else 2, 0) for i in range(12)]


def test_graphs_travel_in_pieces(rows, monkeypatch):
    """No row is as large as a graph, and a block is the same whether it gets the graph alone or with others."""
    import pandas as pd

    rng = np.random.default_rng(3)
    x = vectors(rng, (30, 2, 2), 0.04, 900, 64)
    made = h._build_shard(pd.DataFrame({"dim": 64, "shard": 0, "node": range(len(x)), "weight": 1, "vec": [v.tobytes() for v in x]}))
    assert len(made) > 1 and made["piece"].str.len().max() <= h.PIECE_BYTES
    graph, nodes, _ = h._load(list(made["piece"]))
    direct = h.build(h.unit_rows(x), np.arange(len(x)))
    assert (nodes == np.arange(len(x))).all() and graph.entry == direct.entry
    assert all((a == b).all() for a, b in zip(graph.layers, direct.layers, strict=True))
    df = rows([(i, v, 0, "x", 1) for i, v in enumerate(x.tolist())], SCHEMA)
    got = []
    for wanted in (h.PAIRS_WANTED, 3):
        monkeypatch.setattr(h, "PAIRS_WANTED", wanted)
        got.append(sorted(tuple(r) for r in h.near_duplicates(df, shard_rows=300, block_rows=100, least_shards=2).collect()))
    n_links, label = slow(list(enumerate(x)))
    assert got[0] == got[1] == [(i, int(n), int(c), i == c) for i, (n, c) in enumerate(zip(n_links, label))]
