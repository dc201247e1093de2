"""Trees over the binned store against plain Python: split by split, on rows with nulls and categories."""

import heapq
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabmill.trees import boosting as B
from tabmill.trees import forest as Fo
from tabmill.trees import growth as G
from tabmill.trees import store as S

SCHEMA = "id long, a double, b double, c string, y double"


def plain_best(rows, names, categories, min_rows, l2):
    """(gain, feature, left values, missing left) of the best split, by trying every cut."""
    score = lambda part: sum(r["y"] for r in part) ** 2 / (len(part) + l2) if part else 0.0
    best = None
    for f in names:
        known, none = [r for r in rows if r[f] is not None], [r for r in rows if r[f] is None]
        values = sorted({r[f] for r in known})
        if f in categories:
            mean = lambda v: sum(r["y"] for r in rows if r[f] == v) / (sum(r[f] == v for r in rows) + 10.0)
            values = sorted({r[f] for r in rows}, key=lambda v: (mean(v), v is None, v or ""))
            cuts = [[r for r in rows if r[f] in values[: k + 1]] for k in range(len(values) - 1)]
        else:
            cuts = [[r for r in known if r[f] <= v] for v in values] + ([[r for r in known if r[f] <= v] + none for v in values] if none else [])
        for left in cuts:
            inside = {id(r) for r in left}
            right = [r for r in rows if id(r) not in inside]
            if min(len(left), len(right)) < max(1, min_rows):
                continue
            gain = score(left) + score(right) - score(rows)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = gain, left, right
    return best


def plain_tree(rows, names, categories, leaves, depth, min_rows, l2):
    """Gains in the order in which splits are taken, and the leaf value of each row id."""
    heap, order, taken, done = [], 0, [], []

    def push(part, deep):
        nonlocal order
        best = plain_best(part, names, categories, min_rows, l2) if deep < depth else None
        if best is None:
            done.append(part)
        else:
            heapq.heappush(heap, (-round(best[0], 7), order, best, part, deep))
        order += 1

    push(rows, 0)
    while heap and len(taken) + 1 < leaves:
        _, _, (gain, left, right), _, deep = heapq.heappop(heap)
        taken.append(gain)
        push(left, deep + 1)
        push(right, deep + 1)
    value = {}
    for part in done + [h[3] for h in heap]:
        for r in part:
            value[r["id"]] = sum(x["y"] for x in part) / (len(part) + l2)
    return taken, value


def make(n=260, seed=0):
    """Nulls in `b` and category `e` carry the signal beside `a`; labels are on the grid and have mean zero."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = float(rng.integers(0, 12)), None if rng.random() < 0.2 else float(rng.integers(0, 5)), [None, "d", "e", "f", "g"][rng.integers(0, 5)]
        y = 3 * (a > 5) + (4 if b is None else 0) + (2 if c == "e" else 0) + float(rng.integers(-512, 512)) / 1024
        rows.append({"id": i, "a": a, "b": b, "c": c, "y": y})
    return rows


def stored(spark, rows, split=None, numeric=("a", "b"), categories=("c",), parts=3):
    df = spark.createDataFrame([(r["id"], r["a"], r["b"], r["c"], r["y"]) for r in rows], SCHEMA).repartition(parts)
    spec = S.fit_bins(df, list(numeric), list(categories))
    return df, B.Store(S.binned(df, spec, "y", ["id"], F.lit("train") if split is None else split), spec)


def one_tree(store, rules, grow):
    model = B.boosted(store, rules, grow, 1, 1.0)
    return model, model.trees[0]


@pytest.mark.parametrize(("leaves", "depth", "min_rows", "l2"), [(2, 9, 1, 0.0), (9, 3, 1, 0.0), (17, 10, 7, 0.0), (40, 6, 2, 1.5)])
def test_leafwise_equals_plain_best_first(spark, leaves, depth, min_rows, l2):
    rows = make(seed=leaves)
    df, store = stored(spark, rows)
    seen = []

    def grow(part, fit, root):
        tree, splits = G.leafwise(part, fit, leaves, depth, root)
        seen.extend(s.gain for s in splits)
        return tree

    model, tree = one_tree(store, store.rules(["c"], min_rows=min_rows, l2=l2), grow)
    centred = [{**r, "y": r["y"] - model.start} for r in rows]
    taken, value = plain_tree(centred, ["a", "b", "c"], {"c"}, leaves, depth, min_rows, l2)
    assert len(seen) == len(taken) and np.allclose(seen, taken, atol=1e-4)
    assert tree.leaves == len(taken) + 1 and tree.depth <= depth
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert all(abs(got[i] - model.start - v) < 1e-5 for i, v in value.items())


def test_same_trees_for_any_partitioning(spark):
    rows = make(300, 3)
    models = [B.leafwise_boosting(stored(spark, rows, parts=p)[1], rounds=3, leaves=8, min_rows=5, categories=["c"]) for p in (1, 5)]
    assert models[0].to_json() == models[1].to_json()


def test_one_task_grows_the_same_trees_as_passes(spark, monkeypatch):
    """A small part takes a job or two for all trees, whatever their number."""
    rows = make(700, 9)
    _, store = stored(spark, rows)
    fits = [
        lambda: B.leafwise_boosting(store, rounds=12, leaves=9, min_rows=5, categories=["c"], fold=(1, 3)),
        lambda: B.gradient_boosting(store, rounds=3, depth=4), lambda: B.symmetric_boosting(store, rounds=3, depth=3),
        lambda: B.histogram_boosting(store, rounds=30, rate=0.9, min_rows=60, early=True),
    ]
    here = [f() for f in fits]
    assert len(here[0].trees) == 12 and len(here[0].errors) == 13
    monkeypatch.setattr(B, "HELD_BYTES", 0)
    there = [f() for f in fits]
    assert [m.to_json() for m in here] == [m.to_json() for m in there] and [m.errors for m in here] == [m.errors for m in there]


def test_missing_values_learn_their_side(spark):
    rows = [{"id": i, "a": 1.0, "b": None if i % 2 else float(i % 7), "c": "d", "y": 5.0 if i % 2 or i % 7 > 3 else 0.0} for i in range(420)]
    _, store = stored(spark, rows)
    model, tree = one_tree(store, store.rules(min_rows=1), lambda part, fit, root: G.leafwise(part, fit, 2, 4, root)[0])
    got = {r["label"]: r["prediction"] for r in model.scored(store).collect()}
    assert tree.leaves == 2 and abs(got[0.0]) < 1e-6 and abs(got[5.0] - 5) < 1e-6


def plain_symmetric(rows, names, depth, l2):
    parts, score = [rows], lambda part: sum(r["y"] for r in part) ** 2 / (len(part) + l2) if part else 0.0
    for _ in range(depth):
        best = None
        for f in names:
            for v in sorted({r[f] for r in rows if r[f] is not None}):
                for none_left in (False, True):
                    goes = lambda r: none_left if r[f] is None else r[f] <= v  # noqa: B023, E731
                    gain = sum(score([r for r in p if goes(r)]) + score([r for r in p if not goes(r)]) - score(p) for p in parts)
                    if best is None or gain > best[0] + 1e-9:
                        best = gain, f, v, none_left
        _, f, v, none_left = best
        goes = lambda r: none_left if r[f] is None else r[f] <= v  # noqa: B023, E731
        parts = [side for p in parts for side in ([r for r in p if not goes(r)], [r for r in p if goes(r)])]
    return {r["id"]: sum(x["y"] for x in p) / (len(p) + l2) for p in parts for r in p}


def test_symmetric_equals_plain_levels_and_expression(spark):
    rows = make(200, 8)
    df, store = stored(spark, rows, categories=())
    model, tree = one_tree(store, store.rules(min_rows=0, l2=3.0), lambda part, fit, root: G.symmetric(part, fit, 3, root))
    want = plain_symmetric([{**r, "y": r["y"] - model.start} for r in rows], ["a", "b"], 3, 3.0)
    got = model.transform(df).withColumn("e", model.expression()).collect()
    assert tree.leaves == 8
    assert all(abs(r["prediction"] - model.start - want[r["id"]]) < 1e-5 and abs(r["e"] - r["prediction"]) < 1e-12 for r in got)


def test_boosting_lowers_the_error_and_survives_saving(spark, tmp_path):
    rows = make(400, 5)
    df, store = stored(spark, rows)
    model = B.leafwise_boosting(store, rounds=12, rate=0.3, leaves=8, min_rows=5, categories=["c"])
    errors = [e[0] for e in model.errors]
    assert all(b < a for a, b in zip(errors, errors[1:])) and len(model.trees) == 12
    model.save(spark, str(tmp_path / "m"))
    again = B.Boosted.load(spark, str(tmp_path / "m"))
    new = df.unionByName(spark.createDataFrame([(-1, None, None, "unseen", None), (-2, math.nan, 99.0, None, None)], SCHEMA))
    a, b = ({r["id"]: r["prediction"] for r in m.transform(new).collect()} for m in (model, again))
    assert a == b and len(a) == 402


def test_training_ends_early_and_folds_measure_all_trees(spark):
    rng = np.random.default_rng(2)
    rows = [{"id": i, "a": float(rng.integers(0, 9)), "b": 1.0, "c": "x", "y": float(rng.normal())} for i in range(600)]
    _, store = stored(spark, rows)
    model = B.histogram_boosting(store, rounds=60, rate=0.5, min_rows=1, early=True)
    assert 10 <= len(model.trees) < 60 and all(e[1] is not None for e in model.errors)
    fold = B.leafwise_boosting(store, rounds=2, leaves=4, fold=(1, 3))
    assert len(fold.errors) == 3 and all(e[1] for e in fold.errors)


def test_empty_part_and_constant_label(spark):
    _, empty = stored(spark, [])
    assert B.leafwise_boosting(empty, rounds=2).trees == []
    df, flat = stored(spark, [{"id": i, "a": 1.0 * i, "b": None, "c": None, "y": 7.0} for i in range(50)])
    model = B.symmetric_boosting(flat, rounds=2)
    assert {round(r["prediction"], 9) for r in model.transform(df).collect()} == {7.0}


def test_ordered_statistics_do_not_leak(spark):
    """A random category of many values tells nothing of the label; its plain mean would."""
    rng = np.random.default_rng(6)
    data = [(i, str(rng.integers(0, 400)) if i % 9 else None, float(rng.normal())) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, c string, y double").repartition(4)
    got = S.ordered_statistics(df, "c", "y", ["id"], 0.0).collect()
    order = {r["id"]: r["h"] for r in df.select("id", F.xxhash64("id", F.lit(42)).alias("h")).collect()}
    by = {}
    for i, c, y in data:
        by.setdefault(c, []).append((order[i], y, i))
    for r in got:
        before = [y for h, y, _ in by[r["c"]] if h < order[r["id"]]]
        assert abs(r["c_stat"] - sum(before) / (len(before) + 1)) < 1e-9
    y, s = np.array([r["y"] for r in got]), np.array([r["c_stat"] for r in got])
    assert len(got) == 2000 and abs(np.corrcoef(y, s)[0, 1]) < 0.08
    leaky = S.with_category(df, "c", S.category_table(df, "c", "y", 0.0), 0.0).collect()
    assert np.corrcoef([r["y"] for r in leaky], [r["c_stat"] for r in leaky])[0, 1] > 0.3


def test_forest_is_the_same_wherever_nodes_are_grown(spark):
    rows = make(500, 11)
    df, store = stored(spark, rows)
    forests = [Fo.random_forest(store, trees=5, min_split=6, min_rows=2, share=0.7, local_rows=n) for n in (10_000, 60, 1)]
    got = [{r["id"]: r["prediction"] for r in f.transform(df).collect()} for f in forests]
    assert all(abs(got[0][i] - g[i]) < 1e-9 for g in got[1:] for i in got[0])
    error = np.mean([(got[0][r["id"]] - r["y"]) ** 2 for r in rows])
    assert error < 0.35 and len({t.to_dict()["left"] for t in forests[0].trees}) == 5


def test_forest_keeps_its_bounds_and_goes_deep(spark):
    rng = np.random.default_rng(1)
    rows = [{"id": i, "a": float(i), "b": None, "c": None, "y": float(1 << min(i, 45)) if i < 46 else 0.0} for i in range(230)]
    df, store = stored(spark, rows, categories=())
    deep = Fo.random_forest(store, trees=3)
    assert max(t.depth for t in deep.trees) > 12
    bound = Fo.random_forest(store, trees=3, depth=4, min_rows=10, min_split=30)
    assert max(t.depth for t in bound.trees) <= 4
    for forest, least in ((bound, 10),):
        matrix = store.bins.matrix([pa.array([r[f] for r in rows], "float64") for f in ("a", "b")])
        hashes = np.array([r["h"] for r in df.select("id", F.xxhash64("id").alias("h")).orderBy("id").collect()], np.int64).view(np.uint64)
        for t, tree in enumerate(forest.trees):
            drawn = np.bincount(tree.nodes(matrix), Fo.drawn_times(hashes, t, 42), len(tree.value))
            assert drawn[tree.child[:, 0] == np.arange(len(tree.value))].min() >= least
    assert 0.9 < Fo.drawn_times(rng.integers(0, 1 << 63, 20_000).astype(np.uint64), 3, 42).mean() < 1.1


def test_forest_goes_below_thirty_levels(spark):
    """Labels without pattern: splits cut off small ends, level after level, until rows are alike."""
    rng = np.random.default_rng(4)
    rows = [{"id": i, "a": float(rng.integers(0, 190)), "b": float(rng.integers(0, 190)), "c": None, "y": float(rng.normal())} for i in range(9000)]
    _, store = stored(spark, rows, categories=())
    forest = Fo.random_forest(store, trees=2)
    assert max(t.depth for t in forest.trees) > 30


def test_forest_of_an_empty_part(spark):
    _, store = stored(spark, [])
    assert Fo.random_forest(store, trees=2).trees == []


def test_forest_sends_alike_rows_once(spark):
    """Rows of few different features: a node gets one piece from a task, and a piece no more rows than there are features."""
    rows = [{"id": i, "a": float(i % 3), "b": float(i % 2), "c": None, "y": float(i % 7)} for i in range(3000)]
    _, store = stored(spark, rows, categories=())
    forest = Fo.ForestRules(store.rules(used=["a", "b"], min_rows=1), 1024.0, 3.0, None, 2, 1.0, 42)
    sent = list(Fo._handed_over(forest, {0: Fo._Top().tree(1.0)}, {0: [0]})(iter(store.df.toArrow().select(["rows", "label", "hash", "bins"]).combine_chunks().to_batches())))
    times = np.concatenate([np.frombuffer(t.as_py(), "<i4") for b in sent for t in b.column("times")])
    assert sum(b.num_rows for b in sent) == 1 and len(times) == 6
    hashes = np.concatenate([np.frombuffer(h, "<i8") for h in store.df.toArrow().column("hash").to_pylist()]).view(np.uint64)
    assert times.sum() == Fo.drawn_times(hashes, 0, 42).sum()


def test_batches_of_blocks_are_bounded(spark):
    """A task's part of the store grows with the table; what Python gets at once must not."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 30))
    _, store = stored(spark, make(50, 3))
    store.part()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_models_share_the_held_rows(spark):
    _, store = stored(spark, make(50, 3))
    with store.held() as one, store.held() as two:
        assert one.count() == two.count() and one.storageLevel.useMemory
    assert not one.storageLevel.useMemory
