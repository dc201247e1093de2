"""Queries for dates, flags, segments, bins, scaling and encoding (H to J), and saved state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmill.catalog.registry import query, rounded, scratch, table, without
from tabmill.functions import dates, flags, segments
from tabmill.functions import text as T
from tabmill.operators import binning as B
from tabmill.operators import encode as E
from tabmill.operators import scale as S
from tabmill.operators.expand import expand_dict
from tabmill.operators.quantiles import medians
from tabmill.operators.split import random_split
from tabmill.plans.config import LISTINGS
from tabmill.plans.features import FeatureState, add_expanded, fit_features
from tabmill.runtime import staged


@query(
    "h01_lenient_time",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS t FROM orders""",
)
def h01(spark, d):
    text = F.when(F.col("o_orderkey") % 5 == 0, "31.31.2020").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, d, "orders").select("o_orderkey", dates.to_moment(text).alias("t"))


@query(
    "h02_h03_h04_date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS offer_year, CAST(month(o_orderdate) AS INTEGER) AS offer_month,
    CAST(day(o_orderdate) AS INTEGER) AS offer_day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS offer_dayofweek,
    CAST(weekofyear(o_orderdate) AS INTEGER) AS offer_weekofyear, CAST(quarter(o_orderdate) AS INTEGER) AS offer_quarter FROM orders""",
)
def h02(spark, d):
    parts = dates.date_parts(F.col("o_orderdate"), "offer")
    return table(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query(
    "h05_h06_h07_seasons",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(month(o_orderdate) IN (12, 1, 2) AS INTEGER) AS is_year_end,
    CAST(month(o_orderdate) BETWEEN 3 AND 5 AS INTEGER) AS is_spring, CAST(month(o_orderdate) BETWEEN 6 AND 8 AS INTEGER) AS is_summer,
    CAST(month(o_orderdate) >= 9 AND year(l_shipdate) = year(o_orderdate) AS INTEGER) AS is_new_model_year,
    CAST(2024 - year(l_shipdate) AS INTEGER) AS car_age FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def h05(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("oy"), F.month("o_orderdate").alias("om"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("sy"))
    joined = lines.join(orders, F.expr("l_orderkey = o_orderkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[c.alias(n) for n, c in dates.season_flags(F.col("om")).items()],
        dates.new_model_year(F.col("om"), F.col("sy"), F.col("oy")).alias("is_new_model_year"),
        dates.age_in_years(F.col("sy"), 2024).alias("car_age"),
    )


@query(
    "i01_i02_i03_i04_flags",
    """SELECT o_orderkey, CAST(o_totalprice < 50000 AS INTEGER) AS is_low, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(year(o_orderdate) >= 1998 AS INTEGER) ELSE 0 END AS is_recent,
    CAST(o_custkey > 0 AS INTEGER) AS has_images, CAST(o_orderpriority IN ('1-URGENT', '2-high') AS INTEGER) AS is_premium,
    CAST(o_orderkey % 3 = 0 AS INTEGER) AS is_cleared, CAST(contains(lower(o_orderpriority), 'not') AS INTEGER) AS is_diesel,
    CAST(o_custkey % 4 > 1 AS INTEGER) AS has_vin, CAST(o_custkey % 4 <> 0 AS INTEGER) AS has_pts FROM orders""",
)
def i01(spark, d):
    vin = F.when(F.col("o_custkey") % 4 == 1, "").when(F.col("o_custkey") % 4 > 1, F.col("o_orderstatus"))
    orders = table(spark, d, "orders").withColumns(
        {
            "y": without(F.year("o_orderdate"), "o_orderkey", 6),
            "custom": F.when(F.col("o_orderkey") % 3 == 0, "РАСТАМОЖЕН").when(F.col("o_orderkey") % 3 == 1, "нет"),
            "vin": vin,
        }
    )
    return orders.select(
        "o_orderkey",
        flags.below(F.col("o_totalprice"), 50000).alias("is_low"),
        flags.at_least(F.col("y"), 1998).alias("is_recent"),
        flags.above(F.col("o_custkey"), 0).alias("has_images"),
        flags.one_of(F.col("o_orderpriority"), ["1-URGENT", "2-high"]).alias("is_premium"),
        T.in_any_case(F.col("custom"), LISTINGS.cleared_words).alias("is_cleared"),
        T.contains_any_case(F.col("o_orderpriority"), "not").alias("is_diesel"),
        flags.present_text(F.col("vin")).alias("has_vin"),
        flags.present(F.col("vin")).alias("has_pts"),
    )


CARS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(2005 - year(l_shipdate) AS INTEGER) AS car_age, l_extendedprice * 2 AS km_age,
    l_quantity * 6 AS horse_power, l_discount * 40 AS displacement, CAST(l_returnflag = 'A' AS INTEGER) AS aut, CAST(l_linestatus = 'O' AS INTEGER) AS awd,
    CASE l_suppkey % 5 WHEN 0 THEN 'BMW' WHEN 1 THEN 'land rover' WHEN 2 THEN 'KIA' WHEN 3 THEN 'Lada' END AS mark FROM lineitem"""
CAR_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
CAR_KEY_SQL = ", ".join(CAR_KEYS)


def cars(spark, d):
    lines = table(spark, d, "lineitem")
    mark = F.expr("CASE l_suppkey % 5 WHEN 0 THEN 'BMW' WHEN 1 THEN 'land rover' WHEN 2 THEN 'KIA' WHEN 3 THEN 'Lada' END")
    return lines.select(
        *CAR_KEYS, dates.age_in_years(F.year("l_shipdate"), 2005).alias("car_age"), (F.col("l_extendedprice") * 2).alias("km_age"),
        (F.col("l_quantity") * 6).alias("horse_power"), (F.col("l_discount") * 40).alias("displacement"),
        flags.one_of(F.col("l_returnflag"), ["A"]).alias("aut"), flags.one_of(F.col("l_linestatus"), ["O"]).alias("awd"),
        mark.alias("mark"),
    )


@query(
    "i05_i10_logs",
    "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS price_log, round(exp(ln(1 + o_totalprice)) - 1, 4) AS back FROM orders",
)
def i05(spark, d):
    logged = table(spark, d, "orders").select("o_orderkey", segments.log_feature(F.col("o_totalprice")).alias("price_log"))
    return logged.select("o_orderkey", *rounded("price_log"), F.round(segments.unlog(F.col("price_log")), 4).alias("back"))


@query(
    "i06_i07_segments",
    f"""SELECT {CAR_KEY_SQL}, CASE WHEN mark IN ('BMW', 'land rover') THEN 'premium' WHEN mark = 'KIA' THEN 'mid' ELSE 'economy' END AS brand_segment,
    CASE WHEN car_age <= 3 AND km_age <= 50000 THEN 'new_low_mileage' WHEN car_age <= 5 AND km_age <= 100000 THEN 'mid_age_mileage'
    WHEN car_age > 10 OR km_age > 200000 THEN 'old_high_mileage' ELSE 'average' END AS age_mileage_segment FROM ({CARS})""",
)
def i06(spark, d):
    return cars(spark, d).select(
        *CAR_KEYS, segments.brand_segment(F.col("mark"), LISTINGS.premium_segment, LISTINGS.mid_segment).alias("brand_segment"),
        segments.age_mileage_segment(F.col("car_age"), F.col("km_age")).alias("age_mileage_segment"),
    )


@query(
    "i08_i09_ratios_scores",
    f"""SELECT {CAR_KEY_SQL}, round(car_age * km_age / 1000000, 9) AS budget_car_ratio, round(horse_power / nullif(car_age + 1, 0), 6) AS economy_power_ratio,
    round(horse_power / (displacement + 1), 6) AS premium_power_density,
    aut + awd + CAST(horse_power > 200 AS INTEGER) + CAST(displacement > 2.0 AS INTEGER) AS luxury_tech_score,
    CAST(displacement <= 2.5 AS INTEGER) + CAST(horse_power >= 100 AS INTEGER) + CAST(horse_power <= 200 AS INTEGER) + CAST(car_age <= 8 AS INTEGER) AS family_car_score
    FROM ({CARS})""",
)
def i08(spark, d):
    age, km, power, size = (F.col(c) for c in ("car_age", "km_age", "horse_power", "displacement"))
    return cars(spark, d).select(
        *CAR_KEYS,
        F.round(segments.usage_ratio(age, km), 9).alias("budget_car_ratio"),
        F.round(segments.per_unit(power, age), 6).alias("economy_power_ratio"),
        F.round(segments.per_unit(power, size), 6).alias("premium_power_density"),
        segments.technology_score(F.col("aut"), F.col("awd"), power, size).alias("luxury_tech_score"),
        segments.family_score(size, power, age).alias("family_car_score"),
    )


@query(
    "i11_indices",
    f"""SELECT {CAR_KEY_SQL}, round(horse_power * 0.3 + 0.3 / nullif(car_age + 1, 0) + 0.2 / (km_age / 10000 + 1) + aut * 0.1 + awd * 0.1, 6) AS value_index,
    round(car_age * 0.4 + km_age / 10000 * 0.4 + (1 - aut) * 0.1 + awd * 0.1, 6) AS maintenance_index FROM ({CARS})""",
)
def i11(spark, d):
    age, km, power = F.col("car_age"), F.col("km_age"), F.col("horse_power")
    return cars(spark, d).select(
        *CAR_KEYS,
        F.round(segments.value_index(power, age, km, F.col("aut"), F.col("awd")), 6).alias("value_index"),
        F.round(segments.maintenance_index(age, km, F.col("aut"), F.col("awd")), 6).alias("maintenance_index"),
    )


@query(
    "i12_large_groups",
    """WITH f AS (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS user_id_freq FROM events)
    SELECT event_id, user_id_freq, CAST(user_id_freq > (SELECT quantile_cont(user_id_freq, 0.5) FROM f) AS INTEGER) AS is_large FROM f""",
)
def i12(spark, d):
    counted = E.frequency_encode(table(spark, d, "events").select("event_id", "user_id"), "user_id")
    middle = medians(counted, ["user_id_freq"])["user_id_freq"]
    return counted.select("event_id", "user_id_freq", flags.above(F.col("user_id_freq"), middle).alias("is_large"))


@query(
    "i13_rare_values",
    """WITH s AS (SELECT event_id, CASE WHEN event_id % 400 = 0 THEN 'odd' WHEN event_id % 7 <> 3 THEN event_type END AS mark FROM events),
    c AS (SELECT mark, count(*) AS n FROM s GROUP BY 1)
    SELECT event_id, CASE WHEN mark IS NULL THEN 0 ELSE CAST(n < 0.01 * (SELECT count(*) FROM s) AS INTEGER) END AS is_rare_mark FROM s LEFT JOIN c USING (mark)""",
)
def i13(spark, d):
    mark = F.when(F.col("event_id") % 400 == 0, "odd").when(F.col("event_id") % 7 != 3, F.col("event_type"))
    return E.rare_flag(table(spark, d, "events").select("event_id", mark.alias("mark")), "mark").drop("mark")


@query(
    "i14_expanded_features",
    """WITH t AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 0 ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k FROM events)
    SELECT event_id, k AS options_k, CAST(k > 0 AS INTEGER) AS options_k_exists, round(k / (SELECT max(k) FROM t), 6) AS options_k_norm FROM t""",
)
def i14(spark, d):
    props = F.when(F.col("event_id") % 5 == 0, "{'k': 'yes'}").otherwise(F.col("props"))
    expanded = expand_dict(table(spark, d, "events").select("event_id", props.alias("options")), "options").drop("options")
    return add_expanded(expanded, FeatureState(2024, fitting=True)).withColumns(
        {"options_k_norm": F.round("options_k_norm", 6)}
    )


@query(
    "j01_clip_quantile",
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 8 <> 0 THEN l_extendedprice END AS x FROM lineitem),
    q AS (SELECT quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM t),
    c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN x IS NOT NULL THEN greatest(least(x, hi), lo) END AS x FROM t, q)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(x, (SELECT quantile_cont(x, 0.5) FROM c)), 4) AS x FROM c""",
)
def j01(spark, d):
    lines = table(spark, d, "lineitem").select(*CAR_KEYS, without("l_extendedprice", "l_partkey", 8).alias("x"))
    return S.apply_limits(lines, S.fit_clip(lines, ["x"])).select(*CAR_KEYS, *rounded("x", digits=4))


@query(
    "j02_winsorise",
    """WITH t AS (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN value * value END AS x, CAST(event_id % 50 = 0 AS INTEGER) AS flag FROM events),
    q AS (SELECT quantile_cont(x, 0.05) AS a, quantile_cont(x, 0.95) AS b, quantile_cont(flag, 0.05) AS fa, quantile_cont(flag, 0.95) AS fb FROM t),
    c AS (SELECT event_id, CASE WHEN x < a - 1.5 * (b - a) THEN a - 1.5 * (b - a) WHEN x > b + 1.5 * (b - a) THEN b + 1.5 * (b - a) ELSE x END AS x,
      least(greatest(flag, fa - 1.5 * (fb - fa)), fb + 1.5 * (fb - fa)) AS flag FROM t, q)
    SELECT event_id, round(coalesce(x, (SELECT quantile_cont(x, 0.5) FROM c)), 4) AS x, CAST(flag AS DOUBLE) AS flag FROM c""",
)
def j02(spark, d):
    events = table(spark, d, "events").select(
        "event_id", without(F.col("value") * F.col("value"), "event_id", 9).alias("x"), (F.col("event_id") % 50 == 0).cast("int").alias("flag")
    )
    return S.apply_limits(events, S.fit_winsor(events, ["x", "flag"])).select("event_id", *rounded("x", digits=4), "flag")


def edge_sum(column: str, edges: list[str]) -> str:
    return "CAST(" + " + ".join(f"CAST({column} > {e} AS INTEGER)" for e in edges) + " AS INTEGER)"


@query(
    "j03_bins_width",
    f"""WITH e AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders)
    SELECT o_orderkey, {edge_sum('o_totalprice', [f'(a + {i} * ((b - a) / 5))' for i in range(1, 5)])} AS o_totalprice_bins_5,
    {edge_sum('o_totalprice', [f'(a + {i} * ((b - a) / 10))' for i in range(1, 10)])} AS o_totalprice_bins_10 FROM orders, e""",
)
def j03(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    edges = B.fit_width_edges(orders, {"o_totalprice": [5, 10]})["o_totalprice"]
    return orders.select(
        "o_orderkey", *[B.coded(orders, "o_totalprice", edges[k]).alias(f"o_totalprice_bins_{k}") for k in (5, 10)]
    )


@query(
    "j04_bins_quantile",
    f"""WITH e AS (SELECT {', '.join(f'quantile_cont(value, {i / 5}) AS v{i}, quantile_cont(user_id, {i / 5}) AS u{i}' for i in range(1, 5))} FROM events)
    SELECT event_id, {edge_sum('value', [f'v{i}' for i in range(1, 5)])} AS value_q_bins_5,
    {edge_sum('user_id', [f'u{i}' for i in range(1, 5)])} AS user_id_q_bins_5 FROM events, e""",
)
def j04(spark, d):
    binned = B.quantile_bins(table(spark, d, "events").select("event_id", "value", "user_id"), ["value", "user_id"], 5)
    return binned.drop("value", "user_id")


@query(
    "j04_bins_repeated_edges",
    """WITH t AS (SELECT event_id, CASE WHEN event_id % 10 < 7 THEN 0.0 ELSE value END AS x FROM events),
    e AS (SELECT quantile_cont(x, 0.8) AS v4, quantile_cont(x, 0.0) AS v0 FROM t)
    SELECT event_id, CAST(CAST(x > v4 AS INTEGER) AS INTEGER) AS x_q_bins_5 FROM t, e""",
)
def j04_repeated(spark, d):
    x = F.when(F.col("event_id") % 10 < 7, F.lit(0.0)).otherwise(F.col("value"))
    binned = B.quantile_bins(table(spark, d, "events").select("event_id", x.alias("x")), ["x"], 5)
    return binned.drop("x")


@query(
    "j05_standardise",
    """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS v FROM customer WHERE c_custkey % 6 <> 0)
    SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 0 ELSE round((c_acctbal - m) / v, 6) END AS c_acctbal, CAST(0 AS DOUBLE) AS fixed FROM customer, s""",
)
def j05(spark, d):
    customers = table(spark, d, "customer").select(
        "c_custkey", without("c_acctbal", "c_custkey", 6).alias("c_acctbal"), F.lit(7.7).alias("fixed")
    )
    scaled = S.apply_scale(customers, S.fit_scale(customers, ["c_acctbal", "fixed"]))
    return scaled.select("c_custkey", *rounded("c_acctbal"), "fixed")


@query(
    "j06_freq_encode",
    """SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN n END AS p_brand_freq FROM part LEFT JOIN
    (SELECT p_brand, count(*) AS n FROM part WHERE p_partkey % 9 <> 0 GROUP BY 1) USING (p_brand)""",
)
def j06(spark, d):
    part = table(spark, d, "part").select("p_partkey", without("p_brand", "p_partkey", 9).alias("p_brand"))
    return E.frequency_encode(part, "p_brand").drop("p_brand")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "j07_onehot_encode",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(o_orderpriority = '{p}' AS DOUBLE) AS \"o_orderpriority_{p}\"" for p in PRIORITIES)
    + " FROM orders",
)
def j07(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return E.apply_encoding(orders, E.fit_encoding(orders, ["o_orderpriority"]))


@query(
    "j08_encode_choice",
    """SELECT p_partkey, count(*) OVER (PARTITION BY p_brand) AS p_brand_freq, CAST(p_size > 25 AS DOUBLE) AS half_big, CAST(p_size <= 25 AS DOUBLE) AS half_small FROM part""",
)
def j08(spark, d):
    half = F.when(F.col("p_size") > 25, "big").otherwise("small")
    part = table(spark, d, "part").select("p_partkey", "p_brand", half.alias("half"))
    return E.apply_encoding(part, E.fit_encoding(part, ["p_brand", "half"]))


@query(
    "j09_saved_categories",
    """SELECT event_id, CAST(event_type = 'click' AND event_id % 3 <> 0 AS DOUBLE) AS event_type_click FROM events""",
)
def j09(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type")
    fitted = E.fit_encoding(events.where("event_type = 'click'"), ["event_type"])
    unseen = events.withColumn("event_type", F.when(F.col("event_id") % 3 == 0, "unseen").otherwise(F.col("event_type")))
    return E.apply_encoding(unseen, fitted)


@query(
    "j10_label_encode",
    "SELECT event_id, event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS event_type_label FROM events",
)
def j10(spark, d):
    events = random_split(table(spark, d, "events").select("event_id", "event_type"), ["event_id"])
    train, test = events.where("split = 'train'"), events.where("split = 'test'")
    both = train.unionByName(test)
    return E.apply_labels(both, "event_type", E.fit_labels(both, "event_type")).drop("split")


@query(
    "j11_text_features",
    """SELECT doc_id, lang, length(lower(trim(text))) AS text_length, try_cast(nullif(regexp_extract(text, '([0-9]+[.][0-9]+)', 1), '') AS DOUBLE) AS volume FROM documents""",
)
def j11(spark, d):
    clean = T.normal_text(F.col("text"))
    return table(spark, d, "documents").select(
        "doc_id", "lang", F.length(clean).alias("text_length"), T.first_decimal(clean).alias("volume")
    )


TRAIN = """CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END"""


@query(
    "k19_apply_state",
    f"""WITH t AS (SELECT o_orderkey, {TRAIN} AS split, CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS x FROM orders),
    q AS (SELECT quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM t WHERE split = 'train'),
    c AS (SELECT o_orderkey, split, CASE WHEN x IS NOT NULL THEN greatest(least(x, hi), lo) END AS x FROM t, q),
    f AS (SELECT o_orderkey, split, coalesce(x, (SELECT quantile_cont(x, 0.5) FROM c WHERE split = 'train')) AS x FROM c),
    s AS (SELECT avg(x) AS m, stddev_pop(x) AS v FROM f WHERE split = 'train')
    SELECT o_orderkey, round((x - m) / v, 6) AS x FROM f, s WHERE split = 'test'""",
)
def k19(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", without("o_totalprice", "o_orderkey", 6).alias("x"))
    split = random_split(orders, ["o_orderkey"])
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    limits = S.fit_clip(train, ["x"])
    scale = S.fit_scale(S.apply_limits(train, limits), ["x"])
    applied = S.apply_scale(S.apply_limits(test, limits), scale)
    return applied.select("o_orderkey", *rounded("x"))


def listings(spark, d):
    """Order lines in the shape of the listings table, for the whole feature job."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.expr("l_orderkey = o_orderkey"))
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    joined = lines.join(part, F.expr("l_partkey = p_partkey"))
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("inner_id"),
        F.col("p_brand").alias("mark"), F.col("p_type").alias("model"),
        F.concat(F.lit("supplier "), F.col("l_suppkey")).alias("seller"),
        F.when(F.col("l_suppkey") % 2 == 0, "dealer").otherwise("private").alias("seller_type"),
        F.concat(F.lit("city "), F.col("l_suppkey") % 30).alias("city"),
        F.col("o_orderdate").alias("offer_created"),
        F.year("l_shipdate").cast("double").alias("year"), (F.col("l_quantity") * 4000).alias("km_age"),
        (F.col("p_size") * 6).cast("double").alias("horse_power"), (F.col("l_discount") * 40).alias("displacement"),
        F.when(F.col("l_returnflag") == "A", "автомат").otherwise("механика").alias("transmission"),
        F.when(F.col("l_linestatus") == "O", "полный").otherwise("передний").alias("drive_type"),
        F.when(F.col("l_tax") > 0.04, "дизель").otherwise("бензин").alias("engine_type"),
        F.col("l_extendedprice").alias("price_rub"),
    )


@query("k19_feature_job")
def k19_job(spark, d):
    rows = staged(listings(spark, d), "listings")
    _, state = fit_features(rows, 2005)
    path = scratch(spark, "state")
    state.save(spark, path)
    return FeatureState.load(spark, path).apply(rows)
