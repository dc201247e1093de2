import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.catalog import learning
from tabmill.catalog.learning import shown
from tabmill.operators.profile import null_profile
from tabmill.plans import models as A
from tabmill.plans import train as R
from tabmill.plans import tune
from tabmill.plans.clean import clean
from tabmill.plans.features import FeatureState, fit_features
from tabmill.plans.score import load_model, save_model, score_batch
from tabmill.runtime import staged

N = 240


@pytest.fixture(scope="module")
def raw(spark):
    """Listings as text, with repeats, gaps and nested columns."""
    i = F.col("id")
    text = lambda c: c.cast("string")
    gap = lambda c, every: F.when(i % every != 1, c)
    mark = F.element_at(F.array(*[F.lit(m) for m in ("BMW", "Toyota", "Kia", "Lada")]), (i % 4 + 1).cast("int"))
    return spark.range(N).select(
        F.format_string("i%d", i % (N - 5)).alias("inner_id"), text(i).alias("id"), text(i % 30).alias("seller_id"),
        gap(mark, 11).alias("mark"), gap(F.format_string("m%d", i % 8), 9).alias("model"), gap(text(2000 + i % 22), 7).alias("year"),
        gap(text(i * 977 % 250000), 5).alias("km_age"), F.lit("II").alias("generation"),
        F.format_string("Sedan %d.6 AT", i % 3 + 1).alias("configuration"), gap(F.format_string("c%d", i % 25), 6).alias("color"),
        text((i % 30) / 10.0 + 1).alias("displacement"), gap(text(60 + i * 37 % 300), 8).alias("horse_power"),
        F.when(i % 2 == 0, "Автомат").otherwise("механика").alias("transmission"), F.when(i % 3 == 0, "4+").otherwise("2").alias("owners_count"),
        F.when(i % 5 == 0, "полный").otherwise("передний").alias("drive_type"), F.when(i % 4 == 0, "Дизель").otherwise("бензин").alias("engine_type"),
        F.lit("X1").alias("vin"), F.format_string("s %d", i % 30).alias("seller"), F.lit("dealer").alias("seller_type"),
        F.lit("R").alias("region"), F.format_string("city %d", i % 26).alias("city"), F.lit("A").alias("address"),
        F.format_string("2024-%02d-%02d 10:00:00", i % 12 + 1, i % 28 + 1).alias("offer_created"),
        F.lit(None).cast("string").alias("last_update"), gap(text(100000 + i * 7919 % 4000000), 13).alias("price_rub_seen"),
        text(100000 + i * 7919 % 4000000).alias("price_rub"), F.when(i % 4 == 0, "1").alias("pts"), F.lit("nan").alias("url"),
        F.when(i % 3 != 0, F.concat(F.lit("{'Салон': "), text(i % 4), F.lit(", 'Обогрев зад.': None}"))).alias("options"),
        F.lit("['http://a/1', 'http://a/2']").alias("image_urls"),
    ).drop("price_rub_seen")


@pytest.fixture(scope="module")
def cleaned(raw, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("work"))
    return staged(clean(raw, order=["id"], work_folder=folder), "cleaned", folder)


def test_cleaned_table_has_no_nulls(cleaned):
    assert cleaned.count() == N - 5
    assert null_profile(cleaned).where("nulls > 0").count() == 0
    assert {"options_Салон", "image_urls_count", "image_urls_first", "has_pts_info"} <= set(cleaned.columns)
    assert not {"options", "image_urls", "last_update"} & set(cleaned.columns)
    assert dict(cleaned.dtypes)["horse_power"] == "double" and dict(cleaned.dtypes)["owners_count"] == "string"


def test_features_apply_equals_fit(spark, cleaned, tmp_path):
    fitted, state = fit_features(cleaned, 2024, work_folder=str(tmp_path / "w"))
    state.save(spark, str(tmp_path / "state"))
    loaded = FeatureState.load(spark, str(tmp_path / "state"))
    again = loaded.apply(cleaned)
    assert fitted.columns == again.columns
    a, b = fitted.toPandas().astype(float), again.toPandas().astype(float)
    assert not a.isna().any().any()
    order = list(a.columns)
    a, b = a.round(6).sort_values(order).to_numpy(), b.round(6).sort_values(order).to_numpy()
    assert np.allclose(a, b, atol=1e-6)
    assert {"tech_cluster", "tech_pca_1", "seller_freq", "model_m0", "city_freq", "options_Салон_norm"} <= set(order)
    part = loaded.apply(cleaned.where("mark = 'BMW'").drop("options_Салон"))
    assert part.columns == fitted.columns


def test_a_fit_works_out_dates_texts_and_lookups_once(cleaned, tmp_path):
    """The fitting passes read a stage behind them; new rows go through without one."""
    fitted, state = fit_features(cleaned.limit(40), 2024, work_folder=str(tmp_path))
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["encoded", "features"]
    plan = fitted._jdf.queryExecution().toString()
    assert state.apply(cleaned).columns == fitted.columns and "encoded-" not in plan and len(list(tmp_path.iterdir())) == 2


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(5, 3, (400, 2))
    y = 2 + x @ [0.5, -0.2] + rng.normal(0, 0.3, 400)
    return x, y, spark.createDataFrame([(i, float(a), float(b), float(v)) for i, ((a, b), v) in enumerate(zip(x, y))], "id long, a double, b double, label double")


def closed_ridge(x, y, alpha):
    z = (x - x.mean(0)) / x.std(0)
    return y.mean() + z @ np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (y - y.mean()))


@pytest.mark.parametrize("alpha", [0.0, 1.0, 250.0])
def test_linear_models_equal_closed_forms(regression, alpha):
    x, y, df = regression
    estimator = A.ridge(A.label_shape(df), alpha) if alpha else A.least_squares()
    model = A.assembled({}, ["a", "b"], estimator, True).fit(df)
    got = [r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()]
    assert np.allclose(got, closed_ridge(x, y, alpha), atol=1e-5)


def test_lasso_drops_everything_under_a_large_penalty(regression):
    _, y, df = regression
    model = A.assembled({}, ["a", "b"], A.lasso(A.label_shape(df), 5.0), True).fit(df)
    assert np.allclose([r[0] for r in model.transform(df).select("prediction").collect()], y.mean(), atol=1e-6)


def test_compare_tune_save_and_score(spark, tmp_path):
    i = F.col("id")
    matrix = spark.range(600).select(
        "id", (i % 7).cast("double").alias("a"), F.when(i % 10 != 3, (i % 11).cast("double")).alias("b"),
        F.format_string("k%d", i % 3).alias("kind"), F.log1p(20000.0 + i % 7 * 90000 + i % 11 * 5000).alias("price_log"),
    )
    data = R.prepare(matrix, "price_log", ["id"], folder=str(tmp_path / "parts"))
    assert data.features == ["a", "b", "kind"]
    assert data.test.join(data.train, data.features, "left_semi").count() == 0

    def broken(shape):
        raise RuntimeError("no such model")

    specs = [
        A.TreeSpec("Boosting", A.fit_gradient, {"rounds": 3, "rate": 0.3}), A.ModelSpec("Linear", lambda s: A.least_squares(), True),
        A.ModelSpec("Broken", broken),
    ]
    grids = {"Boosting": tune.drawn({"depth": [2, 4], "rate": [0.1, 0.3]}, 2), "Linear": [{"regParam": 0.0}, {"regParam": 0.1}]}
    found = R.compare_and_tune(data, specs, grids, folds=2)
    assert set(found.failures) == {"Broken"}
    assert found.metrics.count() == 3 and len([m for m in found.models if m.endswith("(tuned)")]) == 1
    best = min(found.rows, key=lambda r: r["test_rmse"])
    assert found.best == best["model"] and best["test_r2"] > 0.5
    save_model(found.models[found.best], str(tmp_path / "model"))
    scored = score_batch(load_model(str(tmp_path / "model")), data.test.drop("label").withColumn("b", F.lit(None).cast("double")))
    row = scored.first()
    assert row["price_min"] <= row["price"] <= row["price_max"]
    with pytest.raises(ValueError, match="no model"):
        R.compare(data, [specs[2]])


def test_a_failed_model_is_no_result(spark, tmp_path):
    """A query shows all of its models or fails; errors that are no numbers count as a failure."""
    i = F.col("id")
    matrix = spark.range(200).select("id", (i % 40).cast("double").alias("a"), F.log1p(1000.0 + i % 40 * 500).alias("price_log"))
    data = R.prepare(matrix, "price_log", ["id"], folder=str(tmp_path), stratified=False, deduplicate=False)

    def broken(shape):
        raise RuntimeError("no such model")

    class Endless:
        def scored(self, store):
            return data.train.select("label", F.lit("train").alias("split"), F.lit(2000.0).alias("prediction")).unionByName(
                data.test.select("label", F.lit("test").alias("split"), F.lit(2000.0).alias("prediction")))

    good = A.ModelSpec("Linear", lambda s: A.least_squares(), True)
    found = R.compare(data, [A.TreeSpec("Endless", lambda data, **settings: Endless(), {}), good, A.ModelSpec("Broken", broken)])
    assert set(found.failures) == {"Broken", "Endless"} and "no finite numbers" in found.failures["Endless"] and found.best == "Linear"
    with pytest.raises(RuntimeError, match="Broken.*no such model"):
        shown(found)
    assert shown(R.compare(data, [good])).count() == 1


@pytest.fixture
def asked(monkeypatch):
    """What a query asks of the comparison and the search, without their work."""
    seen = {}
    monkeypatch.setattr(learning, "order_matrix", lambda *a: None)
    monkeypatch.setattr(learning, "shown", lambda found: found)
    monkeypatch.setattr(R, "prepare", lambda *a, **k: None)
    monkeypatch.setattr(R, "compare", lambda data, specs, **k: seen.update(specs=specs, **k))
    monkeypatch.setattr(R, "compare_and_tune", lambda data, specs, searches, **k: seen.update(specs=specs, searches=searches, **k))
    return seen


def test_large_comparison_trains_whole_models(asked):
    learning.k13_large(None, "")
    settings = {m.name: dict(m.settings) for m in asked["specs"]}
    assert settings.pop("Random Forest") == {"trees": 100, "depth": 15, "min_split": 20, "min_rows": 10, "share": 0.5}
    assert len(settings) == 3 and all(s["rounds"] == 200 for s in settings.values())


def test_grid_search_tries_the_whole_grid(asked):
    learning.k14(None, "")
    assert [(m.name, dict(m.settings)) for m in asked["specs"]] == [("Gradient Boosting", {"rounds": 100})] and asked["folds"] == 3
    assert asked["searches"]["Gradient Boosting"] == tune.combinations(tune.BOOSTING_GRID) and len(asked["searches"]["Random Forest"]) == 24


def test_grids():
    assert len(tune.combinations(tune.FOREST_GRID)) == 24 and len(tune.combinations(tune.BOOSTING_GRID)) == 16
    for grid, n in tune.RANDOM_GRIDS.values():
        draws = tune.drawn(grid, n)
        assert len(draws) == n and draws == tune.drawn(grid, n)


def test_large_models_on_native_columns(spark, tmp_path):
    """Nulls and categories as they are; every model scores new rows and survives saving."""
    i = F.col("id")
    matrix = spark.range(900).select(
        "id", (i * 7919 % 211).cast("double").alias("a"), F.when(i % 5 != 3, (i * 31 % 17).cast("double")).alias("b"),
        F.when(i % 11 != 0, F.format_string("k%d", i % 13)).alias("kind"),
        F.log1p(20000.0 + i * 7919 % 211 * 900 + F.when(i % 5 == 3, 300_000).otherwise(0) + i % 13 * 40_000).alias("price_log"))
    data = R.prepare(matrix, "price_log", ["id"], folder=str(tmp_path / "parts"), native=True, deduplicate=False)
    assert data.categories == ["kind"] and data.fill == {}
    found = R.compare(data, [m.with_settings({"rounds": 6, "rate": 0.5} if "Boosting" in m.name else {"trees": 8}) for m in A.large_models()])
    assert not found.failures and len(found.rows) == 4
    assert all(r["test_r2"] > 0.6 for r in found.rows), found.rows
    new = data.test.drop("label").unionByName(spark.createDataFrame([(-5, None, None, "new")], "id long, a double, b double, kind string"))
    for name, model in found.models.items():
        path = str(tmp_path / name.replace(" ", "-"))
        save_model(model, path)
        a, b = ({r["id"]: r["price"] for r in score_batch(m, new).collect()} for m in (model, load_model(path)))
        assert a == b and len(a) == new.count()


def test_tree_search_reads_one_store(spark, tmp_path):
    i = F.col("id")
    matrix = spark.range(400).select("id", (i % 40).cast("double").alias("a"), (i * 13 % 7).cast("double").alias("b"), F.log1p(1000.0 + i % 40 * 500 + i * 13 % 7).alias("price_log"))
    data = R.prepare(matrix, "price_log", ["id"], folder=str(tmp_path), native=True, deduplicate=False)
    spec = next(m for m in A.large_models() if m.name == "Leaf-wise Boosting")
    chosen, error = tune.tree_search(data, spec.with_settings({"min_rows": 5}), [{"rounds": 1}, {"rounds": 8}], 2)
    assert chosen == {"rounds": 8} and 0 < error < 1
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("binned")]) == 1


def test_search_fits_side_by_side_on_a_matrix_written_once(spark, tmp_path):
    i = F.col("id")
    matrix = spark.range(300).select("id", (i % 40).cast("double").alias("a"), F.log1p(1000.0 + i % 40 * 500).alias("price_log"))
    data = R.prepare(matrix, "price_log", ["id"], folder=str(tmp_path), native=True, deduplicate=False)
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("matrix")]) == 1
    spec = next(m for m in A.large_models() if m.name == "Histogram Boosting").with_settings({"min_rows": 5})
    both = threading.Barrier(2)

    def fit(data, **settings):
        both.wait(60)
        return spec.fit(data, **settings)

    chosen, error = tune.tree_search(data, A.TreeSpec(spec.name, fit, spec.settings), [{"rounds": 1}, {"rounds": 3}], 2, parallelism=2)
    assert (chosen, error) == tune.tree_search(data, spec, [{"rounds": 1}, {"rounds": 3}], 2)


def test_a_model_that_never_ends_is_stopped(spark, tmp_path):
    i = F.col("id")
    matrix = spark.range(200).select("id", (i % 40).cast("double").alias("a"), F.log1p(1000.0 + i % 40 * 500).alias("price_log"))
    data = R.prepare(matrix, "price_log", ["id"], folder=str(tmp_path), stratified=False, deduplicate=False)

    def endless(shape):
        while True:
            spark.range(0, 10**12, 1, 2).selectExpr("sum(sqrt(id))").collect()

    def idle(shape):
        threading.Event().wait(600)

    specs = [A.ModelSpec("Endless", endless), A.ModelSpec("Idle", idle), *[m for m in A.small_models() if m.name in ("Linear Regression", "Ridge")]]
    start = time.monotonic()
    found = R.compare(data, specs, parallelism=3, limit=25)
    assert time.monotonic() - start < 60
    assert found.failures == {"Endless": "stopped after 25 s", "Idle": "stopped after 25 s"}
    assert [r["model"] for r in found.rows] == ["Linear Regression", "Ridge"]
    deadline = time.monotonic() + 10
    while spark.sparkContext.statusTracker().getActiveJobsIds() and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
