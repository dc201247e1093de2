"""Queries for clusters, splits, models, scoring and metrics (K and L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmill.catalog.registry import query, rounded, scratch, table
from tabmill.operators import metrics as M
from tabmill.operators import profile as P
from tabmill.operators.clusters import as_vectors, cluster_features, fit_components, fit_kmeans
from tabmill.operators.scale import apply_scale, fit_scale
from tabmill.operators.split import exact_split, exact_stratified_split, random_split, stratified_split
from tabmill.plans import models as A
from tabmill.plans import train as R
from tabmill.plans import tune
from tabmill.plans.score import load_model, price_band, save_model, score_batch, with_error
from tabmill.sources.sinks import write_settings

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
BUCKET = """CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 100"""


def scaled_lines(spark, d, names):
    lines = table(spark, d, "lineitem").select(*LINE_KEYS, *names)
    scale = fit_scale(lines, names)
    return lines, scale, as_vectors(apply_scale(lines.select(*names), scale), names)


@query("k01_kmeans")
def k01(spark, d):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines, scale, vectors = scaled_lines(spark, d, names)
    centres = fit_kmeans(vectors, 4)
    return cluster_features(lines, names, scale, centres, [], "line").groupBy("line_cluster").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("l_extendedprice"), 2).alias("mean_price")
    )


# Two standardised columns: the components are their sum and difference, the sum
# first when they correlate positively.
@query(
    "k02_pca",
    """WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem),
    z AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - mq) / sq AS a, (l_extendedprice - mp) / sp AS b FROM lineitem, s),
    c AS (SELECT corr(l_quantity, l_extendedprice) >= 0 AS together FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN together THEN a + b ELSE a - b END / sqrt(2), 6) AS line_pca_1,
    round(CASE WHEN together THEN a - b ELSE a + b END / sqrt(2), 6) AS line_pca_2 FROM z, c""",
)
def k02(spark, d):
    names = ["l_quantity", "l_extendedprice"]
    lines, scale, vectors = scaled_lines(spark, d, names)
    parts = cluster_features(lines, names, scale, [[0.0, 0.0]], fit_components(vectors, 2), "line")
    return parts.select(*LINE_KEYS, *rounded("line_pca_1", "line_pca_2"))


@query("k03_split_hash", f"SELECT o_orderkey, CASE WHEN {BUCKET} < 20 THEN 'test' ELSE 'train' END AS split FROM orders")
def k03(spark, d):
    return random_split(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])


STRATA = f"""WITH e AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b, quantile_cont(o_totalprice, 0.75) AS c FROM orders),
    s AS (SELECT o_orderkey, o_totalprice, CAST(o_totalprice > a AS INTEGER) + CAST(o_totalprice > b AS INTEGER) + CAST(o_totalprice > c AS INTEGER) AS stratum FROM orders, e)
    SELECT o_orderkey, stratum, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(stratum AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 100 < 20
      THEN 'test' ELSE 'train' END AS split FROM s"""


@query("k04_split_stratified", STRATA)
def k04(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return stratified_split(orders, ["o_orderkey"], "o_totalprice").select("o_orderkey", "stratum", "split")


HASH60 = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 15) AS BIGINT)"


@query(
    "k03_split_exact",
    f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {HASH60}, o_orderkey) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def k03_exact(spark, d):
    return exact_split(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])


@query(
    "k04_split_stratified_exact",
    f"""WITH e AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b, quantile_cont(o_totalprice, 0.75) AS c FROM orders),
    s AS (SELECT o_orderkey, {HASH60} AS h, CAST(o_totalprice > a AS INTEGER) + CAST(o_totalprice > b AS INTEGER) + CAST(o_totalprice > c AS INTEGER) AS stratum FROM orders, e),
    n AS (SELECT stratum, n, n * w / t AS exact, floor(n * w / t) AS low, w FROM (SELECT stratum, count(*) AS n, sum(count(*)) OVER () AS t, ceil(0.2 * sum(count(*)) OVER ()) AS w FROM s GROUP BY 1)),
    k AS (SELECT stratum, low + CASE WHEN row_number() OVER (ORDER BY low - exact, stratum) <= w - sum(low) OVER () THEN 1 ELSE 0 END AS k FROM n)
    SELECT o_orderkey, stratum, CASE WHEN row_number() OVER (PARTITION BY stratum ORDER BY h, o_orderkey) <= k THEN 'test' ELSE 'train' END AS split FROM s JOIN k USING (stratum)""",
)
def k04_exact(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return exact_stratified_split(orders, ["o_orderkey"], "o_totalprice").select("o_orderkey", "stratum", "split")


def one_feature(spark, d):
    return table(spark, d, "lineitem").select(*LINE_KEYS, "l_quantity", F.col("l_extendedprice").alias("label"))


def predicted_lines(spark, d, build):
    """Fit on one feature, save, load, and predict all lines."""
    lines = one_feature(spark, d).persist()
    model = A.assembled({}, ["l_quantity"], build(A.label_shape(lines)), True).fit(lines)
    lines.unpersist()
    path = scratch(spark, "model")
    save_model(model, path)
    return load_model(path).transform(one_feature(spark, d)).select(*LINE_KEYS, *rounded("prediction", digits=2))


MOMENTS = """WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, stddev_pop(l_quantity) AS sx, avg(l_extendedprice) AS my,
    covar_pop(l_quantity, l_extendedprice) AS cxy FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(my + (l_quantity - mx) / sx * {}, 2) AS prediction FROM lineitem, m"""


@query("k05_k12_a10_a11_linear_regression", MOMENTS.format("cxy / sx"))
def k05(spark, d):
    return predicted_lines(spark, d, lambda shape: A.least_squares())


@query("k06_ridge", MOMENTS.format("(n * cxy / sx) / (n + 5000)"))
def k06(spark, d):
    return predicted_lines(spark, d, lambda shape: A.ridge(shape, 5000.0))


@query("k07_lasso", MOMENTS.format("greatest(cxy / sx - 1000, 0)"))
def k07(spark, d):
    return predicted_lines(spark, d, lambda shape: A.lasso(shape, 1000.0))


def order_matrix(spark, d):
    """One row per order: line aggregates and calendar parts, and the log price."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("gross"),
        F.avg("l_discount").alias("discount"), F.max("l_tax").alias("tax"),
    )
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", F.month("o_orderdate").alias("month"), F.log1p("o_totalprice").alias("price_log")
    )
    return orders.join(lines, F.expr("o_orderkey = l_orderkey"), "left").drop("l_orderkey")


METRIC_COLUMNS = ("train_r2", "test_r2", "r2_gap", "test_rmse", "test_mae", "test_mape", "mse_log", "mae_log", "weighted_r2", "seconds")


def shown(comparison):
    """Metrics of all models; a model that failed fails the query."""
    return comparison.whole().metrics.select("model", *METRIC_COLUMNS)


@query("k05_k13_model_compare_small")
def k13_small(spark, d):
    data = R.prepare(order_matrix(spark, d), "price_log", ["o_orderkey"], stratified=False, deduplicate=False)
    models = [m.with_settings({"depth": 8}) if m.name == "Random Forest" else m for m in A.small_models(trees=10)]
    return shown(R.compare(data, models))


@query("k08_k10_k11_k20_model_compare_large")
def k13_large(spark, d):
    data = R.prepare(order_matrix(spark, d), "price_log", ["o_orderkey"], native=True)
    return shown(R.compare(data, A.large_models()))


@query("k14_k16_k17_tune_grid")
def k14(spark, d):
    data = R.prepare(order_matrix(spark, d), "price_log", ["o_orderkey"], stratified=False, deduplicate=False)
    specs = [m for m in A.small_models() if m.name == "Gradient Boosting"]
    grids = {name: tune.combinations(grid) for name, grid in tune.SMALL_GRIDS.items()}
    return shown(R.compare_and_tune(data, specs, grids, folds=3, parallelism=4))


@query("k15_a12_tune_random")
def k15(spark, d):
    data = R.prepare(order_matrix(spark, d), "price_log", ["o_orderkey"], deduplicate=False)
    specs = [m.with_settings({"trees": 5}) for m in A.large_models() if m.name == "Random Forest"]
    draws = tune.drawn({"depth": [10, 15, 20], "min_split": [15, 20, 25], "share": [0.4, 0.5, 0.6]}, 3)
    found = R.compare_and_tune(data, specs, {"Random Forest": draws}, folds=2, parallelism=3).whole()
    path = scratch(spark, "settings")
    write_settings(spark, path, found.best, found.settings.get("Random Forest (tuned)", {}))
    return spark.read.json(path).select("model_name", "hyperparameters")


@query("k18_l14_score_batch")
def k18(spark, d):
    matrix = order_matrix(spark, d)
    features = ["lines", "quantity", "gross", "discount", "tax", "month"]
    train = matrix.select(*features, F.col("price_log").alias("label"))
    model = A.assembled({}, features, A.least_squares(), True).fit(train)
    new = matrix.select("o_orderkey", *features, F.expm1("price_log").alias("actual"))
    return with_error(score_batch(model, new), "actual")


LINE_MOMENTS = """avg(l_quantity) AS mx, var_pop(l_quantity) AS vx, avg(ln(1 + l_extendedprice)) AS my, covar_pop(l_quantity, ln(1 + l_extendedprice)) AS cxy, count(*) AS n"""


@query(
    "k18_l14_linear_scores",
    f"""WITH m AS (SELECT {LINE_MOMENTS} FROM lineitem),
    p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, exp(my + (l_quantity - mx) * cxy / vx) - 1 AS p FROM lineitem, m)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round_even(p, 0) AS BIGINT) AS price, CAST(round_even(p - p * 0.15, 0) AS BIGINT) AS price_min,
    CAST(round_even(p + p * 0.15, 0) AS BIGINT) AS price_max, round(abs(CAST(round_even(p, 0) AS BIGINT) - l_extendedprice), 2) AS abs_error FROM p""",
)
def k18_linear(spark, d):
    lines = table(spark, d, "lineitem").select(*LINE_KEYS, "l_quantity", "l_extendedprice")
    model = A.assembled({}, ["l_quantity"], A.least_squares(), True).fit(lines.select("l_quantity", F.log1p("l_extendedprice").alias("label")))
    return with_error(score_batch(model, lines), "l_extendedprice").select(*LINE_KEYS, "price", "price_min", "price_max", *rounded("abs_error", digits=2))


LINE_HASH = "CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, 42)), 1, 15) AS BIGINT)"


def _linear_metrics(name: str, shrink: str) -> str:
    p = f"exp(my + (l_quantity - mx) * cxy / vx * {shrink}) - 1"
    r2 = "1 - sum((y - p) ** 2) FILTER (part = '{0}') / (count(*) FILTER (part = '{0}') * var_pop(y) FILTER (part = '{0}'))"
    return f"""SELECT '{name}' AS model, round({r2.format("train")}, 6) AS train_r2, round({r2.format("test")}, 6) AS test_r2, round({r2.format("train")} - ({r2.format("test")}), 6) AS r2_gap,
    round(sqrt(avg((y - p) ** 2) FILTER (part = 'test')), 4) AS test_rmse, round(avg(abs(y - p)) FILTER (part = 'test'), 4) AS test_mae,
    round(avg((ln(1 + y) - ln(1 + p)) ** 2) FILTER (part = 'test'), 6) AS mse_log, true AS timed
    FROM (SELECT part, l_extendedprice AS y, {p} AS p FROM s, m)"""


@query(
    "k13_k17_l13_linear_compare",
    f"""WITH h AS (SELECT l_quantity, l_extendedprice, {LINE_HASH} AS h FROM lineitem), k AS (SELECT max(h) AS k FROM (SELECT h, row_number() OVER (ORDER BY h) AS i, count(*) OVER () AS n FROM h) WHERE i <= ceil(0.2 * n)),
    s AS (SELECT l_quantity, l_extendedprice, CASE WHEN h <= k THEN 'test' ELSE 'train' END AS part FROM h, k), m AS (SELECT {LINE_MOMENTS} FROM s WHERE part = 'train'),
    r AS ({_linear_metrics("Linear Regression", "1")} UNION ALL {_linear_metrics("Ridge", "n / (n + 1)")})
    SELECT *, test_rmse = min(test_rmse) OVER () AS chosen FROM r""",
)
def k13_linear(spark, d):
    """Metrics of the linear models from a split of exact size, the time they took, and the one to save."""
    lines = table(spark, d, "lineitem").select(*LINE_KEYS, "l_quantity", F.log1p("l_extendedprice").alias("price_log"))
    data = R.prepare(lines, "price_log", LINE_KEYS, stratified=False, deduplicate=False)
    found = R.compare(data, [m for m in A.small_models() if m.name in ("Linear Regression", "Ridge")]).whole()
    best = found.metrics.agg(F.min(F.round("test_rmse", 4))).first()[0]
    return found.metrics.select(
        "model", *rounded("train_r2", "test_r2", "r2_gap"), *rounded("test_rmse", "test_mae", digits=4), *rounded("mse_log"),
        (F.col("seconds") > 0).alias("timed"), (F.round("test_rmse", 4) == best).alias("chosen"))


@query(
    "k18_price_band",
    """SELECT o_orderkey, CAST(round_even(p, 0) AS BIGINT) AS price, CAST(round_even(p * 0.15, 0) AS BIGINT) AS confidence_interval,
    CAST(round_even(p - p * 0.15, 0) AS BIGINT) AS price_min, CAST(round_even(p + p * 0.15, 0) AS BIGINT) AS price_max,
    round(abs(CAST(round_even(p, 0) AS BIGINT) - o_totalprice), 2) AS abs_error
    FROM (SELECT o_orderkey, o_totalprice, exp(ln(1 + o_totalprice * 1.1)) - 1 AS p FROM orders)""",
)
def k18_band(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.log1p(F.col("o_totalprice") * 1.1).alias("prediction"))
    return with_error(price_band(orders), "o_totalprice").select(
        "o_orderkey", "price", "confidence_interval", "price_min", "price_max", *rounded("abs_error", digits=2)
    )


# A fixed predictor: the metrics need no model.
PREDICTED = f"""SELECT o_orderkey, o_totalprice AS y, o_totalprice * (0.9 + (o_custkey % 7) * 0.05) AS p, CASE WHEN {BUCKET} < 20 THEN 'test' ELSE 'train' END AS split FROM orders"""


def predictions(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("y"), (F.col("o_totalprice") * (0.9 + (F.col("o_custkey") % 7) * 0.05)).alias("p")
    )
    return random_split(orders, ["o_orderkey"])


ERRORS = """count(*) AS rows, round(avg((y - p) ** 2), 0) AS mse, round(sqrt(avg((y - p) ** 2)), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
    round(1 - sum((y - p) ** 2) / (count(*) * var_pop(y)), 6) AS r2, round(avg(abs(y - p) / greatest(y, 1)) * 100, 6) AS mape"""


@query("l02_l03_metrics", f"SELECT split, {ERRORS} FROM ({PREDICTED}) GROUP BY split")
def l02(spark, d):
    return M.regression_metrics(predictions(spark, d), "y", "p", ["split"]).select(
        "split", "rows", *rounded("mse", digits=0), *rounded("rmse", "mae", digits=4), *rounded("r2", "mape")
    )


@query(
    "l01_log_metrics",
    f"""SELECT split, round(avg((ln(1 + y) - ln(1 + p)) ** 2), 8) AS mse_log, round(avg(abs(ln(1 + y) - ln(1 + p))), 8) AS mae_log FROM ({PREDICTED}) GROUP BY split""",
)
def l01(spark, d):
    logged = predictions(spark, d).select("split", F.log1p("y").alias("a"), F.log1p("p").alias("b"))
    return M.log_metrics(logged, "a", "b", ["split"]).select("split", *rounded("mse_log", "mae_log", digits=8))


@query(
    "a12_settings_of_best",
    f"""SELECT arg_min(split, rmse) AS model_name, '{{"rows": ' || arg_min(rows, rmse) || ', "rmse": ' || arg_min(rmse, rmse) || '}}' AS hyperparameters FROM
    (SELECT split, count(*) AS rows, CAST(round(sqrt(avg((y - p) ** 2))) AS BIGINT) AS rmse FROM ({PREDICTED}) GROUP BY split)""",
)
def a12(spark, d):
    found = M.regression_metrics(predictions(spark, d), "y", "p", ["split"]).orderBy("rmse").first()
    path = scratch(spark, "settings")
    write_settings(spark, path, found["split"], {"rows": found["rows"], "rmse": round(found["rmse"])})
    return spark.read.json(path).select("model_name", "hyperparameters")


@query(
    "l04_gaps",
    f"""WITH m AS (SELECT split, 1 - sum((y - p) ** 2) / (count(*) * var_pop(y)) AS r2, avg(abs(y - p)) AS mae, sqrt(avg((y - p) ** 2)) AS rmse,
      avg(abs(y - p) / greatest(y, 1)) * 100 AS mape FROM ({PREDICTED}) GROUP BY split)
    SELECT round(a.r2 - b.r2, 6) AS r2_gap, round(a.mae - b.mae, 4) AS mae_gap, round(a.rmse - b.rmse, 4) AS rmse_gap, round(a.mape - b.mape, 6) AS mape_gap
    FROM m a, m b WHERE a.split = 'train' AND b.split = 'test'""",
)
def l04(spark, d):
    found = M.gaps(M.regression_metrics(predictions(spark, d), "y", "p", ["split"]), "split")
    return found.select(*rounded("r2_gap", "mape_gap"), *rounded("mae_gap", "rmse_gap", digits=4))


RANGES = f"""WITH t AS (SELECT *, CASE WHEN y < 0 THEN NULL WHEN y < 500000 THEN 0 WHEN y < 1000000 THEN 1 WHEN y < 2000000 THEN 2 WHEN y < 5000000 THEN 3 ELSE 4 END AS range_id
      FROM (SELECT y * 3 AS y, p * 3 AS p FROM ({PREDICTED}))),
    g AS (SELECT range_id, count(*) AS samples, CASE WHEN count(*) > 5 AND min(y) < max(y) THEN 1 - sum((y - p) ** 2) / (count(*) * var_pop(y)) END AS r2 FROM t GROUP BY 1),
    e AS (SELECT * FROM (VALUES (0, '0 - 500,000'), (1, '500,000 - 1,000,000'), (2, '1,000,000 - 2,000,000'), (3, '2,000,000 - 5,000,000'), (4, '5,000,000 - inf')) v(range_id, price_range)),
    r AS (SELECT e.range_id, price_range, r2, coalesce(samples, 0) AS samples, coalesce(samples, 0) / (SELECT count(*) FROM t) AS weight FROM e LEFT JOIN g ON e.range_id = g.range_id)"""


def ranged(spark, d):
    return predictions(spark, d).select((F.col("y") * 3).alias("y"), (F.col("p") * 3).alias("p"))


@query("l05_range_r2", f"{RANGES} SELECT range_id, price_range, round(r2, 6) AS r2, samples, round(weight, 6) AS weight FROM r")
def l05(spark, d):
    return M.range_r2(ranged(spark, d), "y", "p").select("range_id", "price_range", *rounded("r2"), "samples", *rounded("weight"))


@query("l05_d19_weighted_r2", f"{RANGES} SELECT round(sum(r2 * weight), 6) AS weighted_r2 FROM r")
def d19(spark, d):
    return M.weighted_r2(M.range_r2(ranged(spark, d), "y", "p")).select(*rounded("weighted_r2"))


@query(
    "l06_overfit_level",
    """WITH g AS (SELECT l_suppkey AS model, 0.9 AS train_r2, avg(l_discount) * 10 AS test_r2, 0.9 - avg(l_discount) * 10 AS gap FROM
      (SELECT l_suppkey, l_discount + (l_suppkey % 20) / 200.0 AS l_discount FROM lineitem) GROUP BY 1)
    SELECT model, round(gap, 6) AS r2_gap, CASE WHEN gap > 0.15 THEN 'strong' WHEN gap > 0.08 THEN 'moderate' WHEN gap > 0.03 THEN 'slight' ELSE 'minimal' END AS level FROM g""",
)
def l06(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_discount") + (F.col("l_suppkey") % 20) / 200.0).alias("x"))
    scores = lines.groupBy(F.col("l_suppkey").alias("model")).agg(F.lit(0.9).alias("train_r2"), (F.avg("x") * 10).alias("test_r2"))
    return M.overfit_report(scores).select("model", *rounded("r2_gap"), "level")


@query(
    "l07_l11_summary",
    f"""SELECT split AS model, 'N/A' AS train_r2, format('{{:.4f}}', 1 - sum((y - p) ** 2) / (count(*) * var_pop(y))) AS test_r2,
    format('{{:,}}', CAST(round(sqrt(avg((y - p) ** 2))) AS BIGINT)) AS test_rmse, format('{{:.2f}}', avg(abs(y - p) / greatest(y, 1)) * 100) || '%' AS test_mape,
    count(*) AS rows, CAST(2 AS BIGINT) AS columns FROM ({PREDICTED}) GROUP BY split""",
)
def l07(spark, d):
    scored = predictions(spark, d)
    found = M.regression_metrics(scored, "y", "p", ["split"])
    named = found.select(F.col("split").alias("model"), *[F.col(m).alias(f"test_{m}") for m in ("r2", "rmse", "mae", "mape")])
    shown_text = M.summary_table(named).select("model", "train_r2", "test_r2", "test_rmse", "test_mape")
    return shown_text.join(P.size_report(scored, "split", ["y", "p"]).withColumnRenamed("split", "model"), "model")


@query("l08_rmse_share", f"SELECT round(sqrt(avg((y - p) ** 2)) / avg(y) * 100, 6) AS rmse_percent FROM ({PREDICTED})")
def l08(spark, d):
    return M.rmse_share(predictions(spark, d), "y", "p").select(*rounded("rmse_percent"))


@query(
    "l09_error_histogram",
    f"""WITH e AS (SELECT p - y AS x FROM ({PREDICTED})), b AS (SELECT min(x) AS lo, (max(x) - min(x)) / 50 AS w FROM e),
    c AS (SELECT CAST(least(floor((x - lo) / w) + 1, 50) AS INTEGER) AS bin, count(*) AS n FROM e, b GROUP BY 1)
    SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + (g.bin - 1) * w, 4) AS lower, round(lo + g.bin * w, 4) AS upper, coalesce(n, 0) AS n
    FROM (SELECT unnest(generate_series(1, 50)) AS bin) g CROSS JOIN b LEFT JOIN c ON c.bin = g.bin""",
)
def l09(spark, d):
    return M.error_histogram(predictions(spark, d), "y", "p").select("bin", *rounded("lower", "upper", digits=4), "n")


@query(
    "l12_new_columns",
    """SELECT CAST(2 AS INTEGER) AS new_columns, round(avg(ln(1 + o_totalprice)), 6) AS mean_o_totalprice_log,
    round(avg(CAST(o_totalprice > 200000 AS INTEGER)), 6) AS mean_large FROM orders""",
)
def l12(spark, d):
    before = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    after = before.withColumns({"o_totalprice_log": F.log1p("o_totalprice"), "large": (F.col("o_totalprice") > 200000).cast("int")})
    added = P.new_columns(before, after)
    return after.agg(F.lit(len(added)).alias("new_columns"), *[F.round(F.avg(c), 6).alias(f"mean_{c}") for c in added])
