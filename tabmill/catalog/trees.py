"""Queries for trees grown from the binned store, beside SQL that tries every split.

The SQL takes a split as the cut of the largest gain over all values of the
features, with rows of null on either side; trees are small, so that each split
is one step of it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmill.catalog.registry import query, rounded, scratch, table, without
from tabmill.plans import models as A
from tabmill.plans import train as R
from tabmill.plans.score import load_model, save_model
from tabmill.trees import boosting as B
from tabmill.trees.store import binned, category_table, fit_bins, ordered_statistics, with_category

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURES = ["l_quantity", "l_discount", "l_tax"]
MIN_ROWS = 20


def lines(spark, d):
    """Price by quantity, discount and tax; some of both rates are missing."""
    return table(spark, d, "lineitem").select(
        *LINE_KEYS, "l_quantity", without("l_discount", "l_partkey", 5).alias("l_discount"), without("l_tax", "l_linenumber", 4, 1).alias("l_tax"),
        (F.col("l_extendedprice") + F.when(F.col("l_partkey") % 5 == 0, 9000).otherwise(0)).alias("y"))


def line_store(spark, d):
    df = lines(spark, d)
    spec = fit_bins(df, FEATURES)
    return B.Store(binned(df, spec, "y", LINE_KEYS, F.lit("train")), spec)


def predicted(spark, d, model):
    return model.transform(lines(spark, d)).select(*LINE_KEYS, *rounded("prediction", digits=2))


BASE = """x0 AS MATERIALIZED (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN l_partkey % 5 <> 0 THEN l_discount END AS l_discount,
    CASE WHEN l_linenumber % 4 <> 1 THEN l_tax END AS l_tax, l_extendedprice + CASE WHEN l_partkey % 5 = 0 THEN 9000 ELSE 0 END AS y FROM lineitem),
    p0 AS MATERIALIZED (SELECT *, (SELECT avg(y) FROM x0) AS p FROM x0)"""


def _histogram_cuts(nodes: str, l2: float, least: int, level: bool) -> str:
    """The cut of the largest gain: of one node, or (level) summed over all nodes. From sums by value of each node."""
    values = " UNION ALL ".join(f"SELECT node, '{f}' AS f, {f} AS v, sum(r) AS r, count(*) AS k FROM {nodes} GROUP BY ALL" for f in FEATURES)
    left = "CASE WHEN h.v IS NULL THEN c.none_left ELSE h.v <= c.t END"
    return f"""(WITH h AS MATERIALIZED ({values}), c AS (SELECT DISTINCT f, v AS t, none_left FROM h, (VALUES (false), (true)) b(none_left) WHERE v IS NOT NULL),
      s AS (SELECT h.node, h.f, c.t, c.none_left, sum(r) AS g, sum(k) AS n, coalesce(sum(r) FILTER ({left}), 0) AS gl, coalesce(sum(k) FILTER ({left}), 0) AS nl
        FROM h JOIN c ON c.f = h.f GROUP BY ALL)
      SELECT {"0 AS node" if level else "node"}, f, t, none_left, sum(coalesce(gl * gl / nullif(nl + {l2}, 0), 0) + coalesce((g - gl) * (g - gl) / nullif(n - nl + {l2}, 0), 0) - g * g / (n + {l2})) AS gain
      FROM s {"" if level else f"WHERE least(nl, n - nl) >= {least}"} GROUP BY {"" if level else "node, "}f, t, none_left ORDER BY gain DESC LIMIT 1)"""


def _goes_left() -> str:
    value = "CASE s.f " + " ".join(f"WHEN '{f}' THEN {f}" for f in FEATURES) + " END"
    return f"CASE WHEN {value} IS NULL THEN s.none_left ELSE {value} <= s.t END"


def tree_steps(i: int, splits: int, rate: float, l2: float = 0.0, level: bool = False) -> str:
    """CTEs of tree number i: from predictions p{i} to p{i + 1}."""
    out = [f"t{i}_0 AS MATERIALIZED (SELECT *, y - p AS r, 0 AS node FROM p{i})"]
    for k in range(splits):
        out.append(f"s{i}_{k} AS MATERIALIZED {_histogram_cuts(f't{i}_{k}', l2, MIN_ROWS, level)}")
        goes = _goes_left()
        node = f"2 * n.node + CASE WHEN {goes} THEN 1 ELSE 0 END" if level else f"CASE WHEN n.node <> s.node THEN n.node WHEN {goes} THEN {2 * k + 1} ELSE {2 * k + 2} END"
        out.append(f"t{i}_{k + 1} AS MATERIALIZED (SELECT n.* EXCLUDE (node), {node} AS node FROM t{i}_{k} n, s{i}_{k} s)")
    out.append(f"p{i + 1} AS MATERIALIZED (SELECT * EXCLUDE (r, node, p), p + {rate} * sum(r) OVER (PARTITION BY node) / (count(*) OVER (PARTITION BY node) + {l2}) AS p FROM t{i}_{splits})")
    return ", ".join(out)


def boosted_sql(trees: int, splits: int, rate: float, l2: float = 0.0, level: bool = False) -> str:
    steps = ", ".join(tree_steps(i, splits, rate, l2, level) for i in range(trees))
    return f"WITH {BASE}, {steps} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(p, 2) AS prediction FROM p{trees}"


@query("k11_leafwise_trees", boosted_sql(2, 3, 0.5))
def k11(spark, d):
    return predicted(spark, d, B.leafwise_boosting(line_store(spark, d), rounds=2, rate=0.5, leaves=4, depth=10, min_rows=MIN_ROWS))


@query("k10_histogram_trees", boosted_sql(3, 2, 0.1))
def k10(spark, d):
    return predicted(spark, d, B.histogram_boosting(line_store(spark, d), rounds=3, rate=0.1, leaves=3, depth=10, min_rows=MIN_ROWS, early=False))


@query("k20_symmetric_trees", boosted_sql(2, 2, 0.1, 3.0, True))
def k20(spark, d):
    """Scored by the expression: no Python in the scan."""
    model = B.symmetric_boosting(line_store(spark, d), rounds=2, depth=2, l2=3.0)
    return lines(spark, d).withColumn("prediction", model.expression()).select(*LINE_KEYS, *rounded("prediction", digits=2))


@query("k09_gradient_trees", boosted_sql(3, 1, 0.1).replace(">= 20", ">= 1"))
def k09(spark, d):
    return predicted(spark, d, B.gradient_boosting(line_store(spark, d), rounds=3, depth=1))


@query("a10_a11_saved_trees", boosted_sql(1, 2, 0.5))
def saved(spark, d):
    model = B.leafwise_boosting(line_store(spark, d), rounds=1, rate=0.5, leaves=3, min_rows=MIN_ROWS)
    path = scratch(spark, "trees")
    save_model(model, path)
    return predicted(spark, d, load_model(path))


@query(
    "k20_category_table",
    """WITH m AS (SELECT avg(o_totalprice) AS p FROM orders), t AS (SELECT o_orderpriority AS c, (sum(o_totalprice) + any_value(p)) / (count(*) + 1) AS s FROM orders, m WHERE o_orderkey % 3 <> 0 GROUP BY 1)
    SELECT o_orderkey, round(coalesce(s, p), 4) AS o_orderpriority_stat FROM orders JOIN m ON true LEFT JOIN t ON c = o_orderpriority WHERE o_orderkey % 3 = 0""",
)
def k20_table(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    prior = orders.agg(F.avg("o_totalprice")).first()[0]
    known = category_table(orders.where("o_orderkey % 3 <> 0"), "o_orderpriority", "o_totalprice", prior)
    return with_category(orders.where("o_orderkey % 3 = 0"), "o_orderpriority", known, prior).select("o_orderkey", *rounded("o_orderpriority_stat", digits=4))


@query("k20_ordered_statistics")
def k20_ordered(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordered_statistics(orders, "o_orderpriority", "o_totalprice", ["o_orderkey"], 0.0).select("o_orderkey", *rounded("o_orderpriority_stat", digits=4))


@query("k08_forest")
def k08(spark, d):
    spec = next(m for m in A.small_models(trees=10) if m.name == "Random Forest")
    df = lines(spark, d).withColumnRenamed("y", "label")
    data = R.TrainingData(df, df.limit(0), FEATURES, {}, LINE_KEYS)
    return spec.fit(data, **spec.settings).transform(df).select(*LINE_KEYS, *rounded("prediction", digits=2))
