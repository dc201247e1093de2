"""Starts of K-means and exact splits against plain Python."""

import hashlib
from math import ceil

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabmill.operators import clusters as C
from tabmill.operators import split as S


def plain_lloyd(x, centres, steps=20):
    centres = np.array(centres)
    for _ in range(steps):
        near = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        after = np.array([x[near == k].mean(0) if (near == k).any() else c for k, c in enumerate(centres)])
        moved, centres = ((after - centres) ** 2).sum(), after
        if moved <= 1e-4:
            break
    return ((x[:, None] - centres[None]) ** 2).sum(-1).min(1).sum(), sorted(centres.tolist())


def test_best_of_ten_starts_equals_plain_steps(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.4, (150, 4)) for c in rng.normal(0, 3, (5, 4))])
    vectors = spark.createDataFrame([(Vectors.dense(v),) for v in x], ["features"]).repartition(3)
    points = C._points(vectors, 42)
    starts = C.seeded_centres(points, 4, 10)
    assert len({str(s) for s in starts}) > 5 and all(len({tuple(c) for c in s}) == 4 for s in starts)
    rows = {tuple(v) for v in x.tolist()}
    assert all(tuple(c) in rows for s in starts for c in s)
    want = min(plain_lloyd(x, s) for s in starts)
    assert np.allclose(C.fit_kmeans(vectors, 4), want[1], atol=1e-9)


def test_far_rows_are_drawn_more_often(spark):
    """One row holds nearly all squared distance: nearly every start draws it."""
    vectors = spark.createDataFrame([(Vectors.dense(i / 1000, 0.0),) for i in range(300)] + [(Vectors.dense(100.0, 0.0),)], ["features"])
    points = C._points(vectors, 1)
    starts = C.seeded_centres(points, 2, 20)
    assert sum([100.0, 0.0] in s for s in starts) >= 19


def test_few_and_no_points(spark):
    one = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 5, ["features"])
    assert all(c == [1.0, 2.0] for c in C.fit_kmeans(one, 3))
    assert C.fit_kmeans(one.limit(0), 3) == []


def test_steps_read_blocks(spark):
    """A pass gets bytes of many vectors a row, and every vector once."""
    x = np.random.default_rng(3).normal(size=(20_000, 3))
    vectors = spark.createDataFrame([(Vectors.dense(v),) for v in x], ["features"]).coalesce(2)
    got = C._points(vectors, 5).collect()
    assert len(got) <= 4 and sum(r["rows"] for r in got) == 20_000
    back = np.concatenate([np.frombuffer(r["x"]).reshape(-1, 3) for r in got])
    assert np.array_equal(back[np.lexsort(back.T)], x[np.lexsort(x.T)])


def plain_hash(key, seed=42):
    return int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize(("n", "share"), [(0, 0.2), (1, 0.2), (7, 0.2), (1000, 0.2), (1001, 0.37), (50, 1.0), (50, 0.0)])
def test_exact_split_takes_the_smallest_hashes(spark, n, share):
    df = spark.range(n).withColumn("stratum", F.lit("kept"))
    got = {r["id"]: r["split"] for r in S.exact_split(df, ["id"], share).collect()}
    wanted = sorted(range(n), key=plain_hash)[: ceil(round(share * n, 9))]
    assert {i for i, s in got.items() if s == "test"} == set(wanted) and len(got) == n
    assert S.exact_split(df, ["id"], share).columns == ["id", "stratum", "split"]


def test_strata_are_met_to_the_row(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 50 != 0, (F.col("id") * 7919 % 331).cast("double")).alias("y"))
    got = S.exact_stratified_split(df, ["id"], "y").groupBy("stratum", "split").count().collect()
    count = {(r["stratum"], r["split"]): r["count"] for r in got}
    rows = {}
    for (s, _), n in count.items():
        rows[s] = rows.get(s, 0) + n
    assert {s: count.get((s, "test"), 0) for s in rows} == S.part_sizes(rows, 0.2)
    assert sum(n for (_, part), n in count.items() if part == "test") == 201
    assert all(abs(count.get((s, "test"), 0) - 0.2 * n) < 1 for s, n in rows.items())


def test_rows_of_one_key_stay_together(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("key"))
    got = S.exact_split(df, ["key"]).groupBy("key").agg(F.count_distinct("split").alias("n"), F.max("split").alias("s")).collect()
    assert all(r["n"] == 1 for r in got) and sum(r["s"] == "test" for r in got) == 2
