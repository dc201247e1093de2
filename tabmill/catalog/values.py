"""Queries for null filling and for text, dict and list columns (F and G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmill.catalog.registry import query, rounded, table, without
from tabmill.functions import nested as N
from tabmill.functions import text as T
from tabmill.operators import impute as I
from tabmill.operators.expand import dict_failures, dict_statistics, expand_dict, expand_list
from tabmill.operators.metrics import PRICE_RANGES, range_index
from tabmill.operators.split import random_split


def mode_sql(value: str, source: str) -> str:
    return f"(SELECT {value} FROM ({source}) WHERE {value} IS NOT NULL GROUP BY {value} ORDER BY count(*) DESC, {value} LIMIT 1)"


PARTS = """SELECT p_partkey, p_brand, p_size, p_retailprice,
    CASE WHEN p_partkey % 4 <> 0 AND p_brand <> 'Brand#7' THEN p_type END AS p_type,
    CASE WHEN p_partkey % 5 <> 2 THEN p_size END AS pts FROM part"""


def parts_with_gaps(spark, d):
    gap = F.when((F.col("p_partkey") % 4 != 0) & (F.col("p_brand") != "Brand#7"), F.col("p_type"))
    return table(spark, d, "part").select(
        "p_partkey", "p_brand", "p_size", "p_retailprice", gap.alias("p_type"), without("p_size", "p_partkey", 5, 2).alias("pts")
    )


@query(
    "f01_f02_f10_presence_mode",
    f"""SELECT p_partkey, CAST(pts IS NOT NULL AS INTEGER) AS has_pts_info, coalesce(pts, {mode_sql('pts', PARTS)}) AS pts,
    coalesce(p_type, {mode_sql('p_type', PARTS)}) AS p_type FROM ({PARTS})""",
)
def f01(spark, d):
    part = I.presence_flag(parts_with_gaps(spark, d), "pts", "has_pts_info")
    return I.fill_mode(I.fill_mode(part, ["pts"], 1), ["p_type"]).select("p_partkey", "has_pts_info", "pts", "p_type")


@query(
    "f03_fill_group_mode",
    f"""WITH t AS ({PARTS}), m AS (SELECT p_brand, p_type AS fill, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS rn
      FROM t WHERE p_type IS NOT NULL GROUP BY 1, 2)
    SELECT p_partkey, p_brand, coalesce(p_type, fill, 'Unknown') AS p_type FROM t LEFT JOIN (SELECT * FROM m WHERE rn = 1) USING (p_brand)""",
)
def f03(spark, d):
    return I.fill_group_mode(parts_with_gaps(spark, d), ["p_type"], ["p_brand"]).select("p_partkey", "p_brand", "p_type")


LINES = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
    CASE WHEN l_orderkey % 7 <> 0 AND l_suppkey % 10 <> 3 THEN l_quantity END AS quantity,
    CASE WHEN l_orderkey % 5 <> 1 AND l_suppkey % 10 <> 4 THEN l_extendedprice END AS price,
    CASE WHEN l_orderkey % 3 <> 1 AND l_suppkey % 10 <> 5 THEN l_returnflag END AS flag FROM lineitem"""
LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def lines_with_gaps(spark, d):
    def gap(name, every, at, supplier):
        return F.when((F.col("l_orderkey") % every != at) & (F.col("l_suppkey") % 10 != supplier), F.col(name))

    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        gap("l_quantity", 7, 0, 3).alias("quantity"), gap("l_extendedprice", 5, 1, 4).alias("price"),
        gap("l_returnflag", 3, 1, 5).alias("flag"),
    )


@query(
    "f04_fill_group_median",
    f"""WITH t AS ({LINES}), g AS (SELECT l_suppkey, quantile_cont(quantity, 0.5) AS m FROM t GROUP BY 1),
    f AS (SELECT {LINE_KEYS}, coalesce(quantity, m) AS q FROM t JOIN g USING (l_suppkey))
    SELECT {LINE_KEYS}, round(coalesce(q, (SELECT quantile_cont(q, 0.5) FROM f)), 6) AS quantity FROM f""",
)
def f04(spark, d):
    lines = lines_with_gaps(spark, d).drop("price", "flag")
    filled = I.fill_group_median(lines, ["quantity"], ["l_suppkey"])
    return filled.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *rounded("quantity"))


@query(
    "f05_fill_group_mean",
    f"""WITH t AS (SELECT * REPLACE (ln(1 + price) AS price) FROM ({LINES})), g AS (SELECT l_suppkey, l_returnflag, avg(price) AS m FROM t GROUP BY 1, 2),
    f AS (SELECT {LINE_KEYS}, coalesce(price, m) AS p FROM t JOIN g USING (l_suppkey, l_returnflag))
    SELECT {LINE_KEYS}, round(coalesce(p, (SELECT quantile_cont(p, 0.5) FROM f)), 6) AS price FROM f""",
)
def f05(spark, d):
    lines = lines_with_gaps(spark, d).drop("quantity", "flag").withColumn("price", F.log1p("price"))
    filled = I.fill_group_mean(lines, ["price"], ["l_suppkey", "l_returnflag"])
    return filled.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *rounded("price"))


@query(
    "f06_fill_typed",
    f"""WITH t AS ({LINES}),
    g AS (SELECT l_suppkey, l_linestatus, quantile_cont(quantity, 0.5) AS mq, quantile_cont(price, 0.5) AS mp FROM t GROUP BY 1, 2),
    c AS (SELECT l_suppkey, l_linestatus, flag AS mf, row_number() OVER (PARTITION BY l_suppkey, l_linestatus ORDER BY count(*) DESC, flag) AS rn
          FROM t WHERE flag IS NOT NULL GROUP BY 1, 2, 3),
    f AS (SELECT {LINE_KEYS}, coalesce(quantity, mq) AS q, coalesce(price, mp) AS p, coalesce(flag, mf, 'Unknown') AS flag
          FROM t JOIN g USING (l_suppkey, l_linestatus) LEFT JOIN (SELECT * FROM c WHERE rn = 1) USING (l_suppkey, l_linestatus))
    SELECT {LINE_KEYS}, round(coalesce(q, (SELECT quantile_cont(q, 0.5) FROM f)), 6) AS quantity,
    round(coalesce(p, (SELECT quantile_cont(p, 0.5) FROM f)), 4) AS price, flag FROM f""",
)
def f06(spark, d):
    filled = I.fill_typed(lines_with_gaps(spark, d), ["quantity", "price", "flag", "absent"], ["l_suppkey", "l_linestatus"])
    return filled.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *rounded("quantity"), *rounded("price", digits=4), "flag"
    )


@query(
    "f07_fill_date",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(CASE WHEN l_partkey % 3 <> 0 THEN l_shipdate END, o_orderdate) AS last_update
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def f07(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("offer_created"))
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", without("l_shipdate", "l_partkey", 3).alias("last_update")
    )
    joined = lines.join(orders, F.expr("l_orderkey = o_orderkey"))
    return I.fill_from(joined, ["last_update"], "offer_created").drop("o_orderkey", "offer_created")


@query(
    "f08_f09_fill_prices",
    """SELECT p_partkey, round(CASE WHEN p_partkey % 2 = 1 THEN p_retailprice - 1 ELSE p_retailprice * 0.9 END, 6) AS price_low,
    round(CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice + 1 ELSE p_retailprice * 1.1 END, 6) AS price_high,
    CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS DOUBLE) ELSE 0 END AS update_count,
    CASE WHEN p_partkey % 7 <> 0 THEN p_name ELSE '' END AS description FROM part""",
)
def f09(spark, d):
    part = table(spark, d, "part").select(
        "p_partkey", "p_retailprice",
        without(F.col("p_retailprice") - 1, "p_partkey", 2).alias("price_low"),
        without(F.col("p_retailprice") + 1, "p_partkey", 3).alias("price_high"),
        without(F.col("p_size").cast("double"), "p_partkey", 5).alias("update_count"),
        without("p_name", "p_partkey", 7).alias("description"),
    )
    filled = I.fill_prices(part, "p_retailprice", "price_low", "price_high", ["update_count"])
    return I.fill_values(filled, {"description": ""}).select(
        "p_partkey", *rounded("price_low", "price_high"), "update_count", "description"
    )


TRAIN = """CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END"""
ORDERS = f"""SELECT o_orderkey, {TRAIN} AS split, CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS price,
    CASE WHEN o_custkey % 4 <> 0 THEN o_orderpriority END AS priority FROM orders"""


@query(
    "f11_train_fill",
    f"""WITH t AS ({ORDERS}) SELECT o_orderkey, split,
    round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM t WHERE split = 'train')), 6) AS price,
    coalesce(priority, {mode_sql('priority', "SELECT * FROM t WHERE split = 'train'")}) AS priority FROM t""",
)
def f11(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", without("o_totalprice", "o_orderkey", 6).alias("price"), without("o_orderpriority", "o_custkey", 4).alias("priority")
    )
    split = random_split(orders, ["o_orderkey"])
    values = I.fit_fill(split.where("split = 'train'"), ["price", "priority"], "unknown")
    return I.fill_values(split, values).select("o_orderkey", "split", *rounded("price"), "priority")


@query(
    "f12_f13_f14_fill_features",
    f"""WITH t AS ({LINES}) SELECT {LINE_KEYS}, round(coalesce(quantity, (SELECT quantile_cont(quantity, 0.5) FROM t)), 6) AS quantity,
    round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM t)), 6) AS price, coalesce(flag, 'unknown') AS flag FROM t""",
)
def f14(spark, d):
    lines = I.fill_values(lines_with_gaps(spark, d), {"flag": "unknown"})
    filled = I.fill_fitted(lines, ["quantity", "price", "flag"], "unknown")
    return filled.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *rounded("quantity", "price"), "flag")


@query(
    "g03_normal_text",
    """SELECT p_partkey, lower(trim(coalesce(v, 'nan'))) AS v, length(lower(trim(coalesce(v, 'nan')))) AS n FROM
    (SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN '  ' || upper(p_name) || ' ' END AS v FROM part)""",
)
def g03(spark, d):
    padded = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    part = table(spark, d, "part").select("p_partkey", without(padded, "p_partkey", 5).alias("v"))
    clean = T.normal_text(F.col("v"))
    return part.select("p_partkey", clean.alias("v"), F.length(clean).alias("n"))


@query(
    "g04_g05_text_tests",
    """SELECT doc_id, CAST(contains(lower(text), 'the') AS INTEGER) AS has_the, CASE WHEN doc_id % 4 <> 0 THEN CAST(lower(lang) IN ('en', 'de') AS INTEGER) ELSE 0 END AS listed
    FROM documents""",
)
def g04(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", without(F.upper("lang"), "doc_id", 4).alias("lang"))
    return docs.select(
        "doc_id", T.contains_any_case(F.col("text"), "the").alias("has_the"), T.in_any_case(F.col("lang"), ["en", "de"]).alias("listed")
    )


NUMBER_TEXT = """CASE o_orderkey % 6 WHEN 0 THEN '4+' WHEN 1 THEN CAST(o_custkey AS VARCHAR) || ' owners' WHEN 2 THEN 'none'
    WHEN 3 THEN CAST(o_totalprice AS VARCHAR) WHEN 4 THEN 'v ' || CAST(o_custkey AS VARCHAR) || '.25 AT' END"""


@query(
    "g07_g08_g09_numbers",
    f"""SELECT o_orderkey, try_cast(nullif(regexp_extract(v, '([0-9]+)', 1), '') AS DOUBLE) AS whole,
    try_cast(nullif(regexp_extract(v, '([0-9]+[.][0-9]+)', 1), '') AS DOUBLE) AS decimal_part, try_cast(v AS DOUBLE) AS number
    FROM (SELECT o_orderkey, {NUMBER_TEXT} AS v FROM (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18, 2)) AS o_totalprice FROM orders))""",
)
def g07(spark, d):
    orders = table(spark, d, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    v = F.expr(NUMBER_TEXT.replace("VARCHAR", "STRING"))
    return orders.select("o_orderkey", v.alias("v")).select(
        "o_orderkey", T.first_integer(F.col("v")).alias("whole"), T.first_decimal(F.col("v")).alias("decimal_part"),
        T.to_number(F.col("v")).alias("number"),
    )


PROPS = """CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '{}' WHEN 2 THEN replace(props, '"', '''')
    WHEN 3 THEN replace(props, '}', ', "flag": None}') WHEN 4 THEN '{k: ' || CAST(event_id AS VARCHAR) || ', name: it''s}'
    WHEN 5 THEN 'plain text' ELSE props END"""
K_OF = "CASE WHEN event_id % 8 IN (0, 1, 5) THEN NULL WHEN event_id % 8 = 4 THEN CAST(event_id AS VARCHAR) ELSE regexp_extract(props, '([0-9]+)', 1) END"


def broken_props(spark, d):
    return table(spark, d, "events").select("event_id", F.expr(PROPS.replace("VARCHAR", "STRING").replace("''''", "\"'\"").replace("it''s", "it\\'s")).alias("props"))


@query(
    "g10_g12_b14_dict_expand",
    f"""SELECT event_id, {K_OF} AS props_k, CASE WHEN event_id % 8 = 4 THEN 'it''s' END AS props_name, CAST(NULL AS VARCHAR) AS props_flag FROM events""",
)
def g10(spark, d):
    return expand_dict(broken_props(spark, d), "props").drop("props")


@query(
    "g10_dict_typed_fill",
    f"""WITH t AS (SELECT event_id, try_cast({K_OF} AS DOUBLE) AS k FROM events)
    SELECT event_id, round(coalesce(k, (SELECT quantile_cont(k, 0.5) FROM t)), 6) AS props_k FROM t""",
)
def g10_fill(spark, d):
    expanded = expand_dict(broken_props(spark, d), "props", keys=["k"])
    typed = expanded.select("event_id", T.to_number(F.col("props_k")).alias("props_k"))
    return I.fill_fitted(typed, ["props_k"]).select("event_id", *rounded("props_k"))


@query(
    "g11_dict_statistics",
    """SELECT count_if(event_id % 8 NOT IN (0, 1, 5)) AS parsed, count_if(event_id % 8 = 5) AS failed, count_if(event_id % 8 IN (0, 1)) AS blank FROM events""",
)
def g11(spark, d):
    return dict_statistics(broken_props(spark, d), "props")


@query("g11_dict_failures", "SELECT count(*) AS n FROM (SELECT 1 FROM events WHERE event_id % 8 = 5 LIMIT 10)")
def g11_sample(spark, d):
    return dict_failures(broken_props(spark, d), "props").agg(F.count(F.lit(1)).alias("n"))


LISTS = """CASE page_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '["' || url || '", "b"]'
    WHEN 3 THEN '[{"url": "' || url || '"}, {"url": null}, {"url": "c"}]' WHEN 4 THEN url || ', "x" ,y' WHEN 5 THEN url
    WHEN 6 THEN '[{"url":null}]' WHEN 7 THEN CAST(page_id AS VARCHAR) ELSE '[''' || url || ''', None]' END"""
COUNTS = "CASE page_id % 9 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 1 WHEN 8 THEN 2 ELSE 0 END"


@query(
    "g13_list_expand",
    f"SELECT page_id, CAST({COUNTS} AS INTEGER) AS urls_count, CASE WHEN page_id % 9 IN (2, 3, 4, 5, 8) THEN url END AS urls_first FROM pages",
)
def g13(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.expr(LISTS.replace("VARCHAR", "STRING").replace("'[''' || url || ''', None]'", "concat(\"['\", url, \"', None]\")")).alias("urls"))
    return expand_list(pages, "urls").drop("urls")


@query(
    "g14_url_search",
    """SELECT page_id, CAST(len(u) AS INTEGER) AS n, u[1] AS first_url FROM
    (SELECT page_id, regexp_extract_all(html || ' ' || url, 'https?://[^\\s,\\]]+') AS u FROM pages)""",
)
def g14(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.concat_ws(" ", "html", "url").alias("t"))
    found = pages.withColumn("u", N.find_urls(F.col("t")))
    return found.select("page_id", N.list_count(F.col("u")).alias("n"), N.list_first(F.col("u")).alias("first_url"))


@query(
    "g15_comma_count",
    "SELECT doc_id, CASE WHEN doc_id % 6 <> 0 THEN CAST(len(string_split(text, ',')) AS INTEGER) ELSE 0 END AS items FROM documents",
)
def g15(spark, d):
    docs = table(spark, d, "documents").select("doc_id", without("text", "doc_id", 6).alias("t"))
    return docs.select("doc_id", N.comma_count(F.col("t")).alias("items"))


@query(
    "g16_number_labels",
    """SELECT o_orderpriority, format('{:,}', CAST(count(*) AS BIGINT)) AS n,
    CASE WHEN max(o_totalprice) < 500000 THEN '0 - 500,000' ELSE '500,000 - 1,000,000' END AS top_range FROM orders GROUP BY 1""",
)
def g16(spark, d):
    labels = [T.range_label(a, b) for a, b in zip(PRICE_RANGES, PRICE_RANGES[1:])]
    top = F.get(F.array(*[F.lit(x) for x in labels]), range_index(F.max("o_totalprice"), PRICE_RANGES))
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(
        T.thousands(F.count(F.lit(1))).alias("n"), top.alias("top_range")
    )
