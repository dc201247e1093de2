"""Centroids with approximations: rounds by plain Python integers, bounds by their definition."""

import hashlib
import math

import numpy as np
import pytest

from tabmill.llm import va_clusters as v

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string"


def plain(vectors, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) if abs(x) < 2**53 else 1024 * int(x) for x in e]) for i, e in vectors
            if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    key = lambda r: hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [q for _, q in sorted(kept, key=lambda r: (key(r), np.array(r[1], "<i8").tobytes() if max(map(abs, r[1])) < v.NARROW else b""))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda q: min(range(len(centroids)), key=lambda c: (far(q, centroids[c]), c))
    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(nearest(q), []).append(q)
        centroids = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else old for c, old in enumerate(centroids)]
    label = [nearest(q) for _, q in kept]
    distance = [far(q, centroids[c]) for (_, q), c in zip(kept, label)]
    inertia = [sum(d for d, x in zip(distance, label) if x == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    fits = lambda x: x if x <= v.LONG else None
    return sorted(((i, c, fits(d), fits(inertia[c]), fits(sum(inertia)), digest[c]) for (i, _), c, d in zip(kept, label, distance)), key=str)


def got(df, **options):
    found = v.clustered(df, **options).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found), key=str)


def vectors(n=400, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(11, 64))
    return [(i, (centres[i % 11] * (0.2 if i % 3 else 1) + rng.normal(scale=0.4, size=64)).tolist()) for i in range(n)]


ODD = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [0.0] * 63), (905, [float("nan")] + [0.0] * 63), (906, [float("inf")] * 64), (None, [0.25] * 64), (907, [0.0] * 64), (908, [-0.0] * 64)]


def test_equal_to_plain_rounds(rows):
    data = vectors() + ODD + [(7, vectors()[7][1])] * 150
    df = rows([(i, e, 1, "x") for i, e in data], SCHEMA).repartition(5)
    assert got(df) == plain(data)


def test_few_vectors_equal_starts_and_empty_table(rows):
    few = [(i, [0.5] * 64) for i in range(3)] + [(9, [0.75] * 64)]
    assert got(rows([(i, e, 1, "x") for i, e in few], SCHEMA)) == plain(few)
    assert got(rows([], SCHEMA)) == [] and got(rows([(i, e, 1, "x") for i, e in ODD[:7]], SCHEMA)) == []


def test_components_beyond_a_long(rows):
    data = vectors(40) + [(100, [3e38] * 64), (101, [-1e300] + [0.5] * 63), (102, [2.0**17 + 0.3] * 64)]
    assert got(rows([(i, e, 1, "x") for i, e in data], SCHEMA)) == plain(data)


def test_limbs_are_exact():
    for value in (0, 1, -1, 1 << 200, -(1 << 200) - 12345, (1 << 40) - 1, -(1 << 40), 1 << 1030):
        assert v.from_limbs(dict(enumerate(v.limbs(value)))) == value


@pytest.mark.parametrize("spread", [1, 300])
def test_intervals_enclose_distances_and_spare_vectors(spread):
    rng = np.random.default_rng(5)
    q = (rng.integers(-900, 900, (2000, 64)) + spread * rng.integers(-9, 9, (2000, 1))).astype(np.int64)
    grid = v.even_grid(q.min(0).tolist(), q.max(0).tolist())
    cells = grid.cells(q)
    near, far = grid.bounds(q[:8])
    for c in range(8):
        exact = ((q - q[c]) ** 2).sum(1)
        low = sum(near[c, d][cells[:, d]] for d in range(64))
        high = sum(far[c, d][cells[:, d]] for d in range(64))
        assert (low <= exact).all() and (exact <= high).all()
    nearest = v.Nearest(q[:8].tolist(), grid)
    label, fetched = nearest.assign(q, cells)
    assert label.tolist() == np.stack([((q - q[c]) ** 2).sum(1) for c in range(8)], 1).argmin(1).tolist()
    assert fetched < len(q) or spread == 1
