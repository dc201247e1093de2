"""Queries for scans, sinks, projections, joins, aggregates and sorts (A to E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmill.catalog.registry import query, rounded, scratch, table, without
from tabmill.functions.text import composite_key
from tabmill.operators import columns as C
from tabmill.operators import dedup as D
from tabmill.operators import keys as K
from tabmill.operators import profile as P
from tabmill.operators import quantiles as Q
from tabmill.operators.expand import expand_list, list_without_first
from tabmill.operators.lookup import lookup
from tabmill.operators.metrics import best_model
from tabmill.operators.split import random_split
from tabmill.plans.filter_by_keys import filter_by_keys
from tabmill.runtime import sized
from tabmill.sources import delimited as S
from tabmill.sources import sinks as W

KEY_SQL = """trim(regexp_replace({}, '[ .,_]+', '_', 'g'), '_')"""


def key_sql(*parts: str) -> str:
    return " || '_' || ".join(KEY_SQL.format(p) for p in parts)


CUSTOMER_KEY = key_sql("c_name", "r_name", "n_name", "c_mktsegment")


def places(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
    return table(spark, d, "customer").join(nation, F.expr("c_nationkey = n_nationkey"))


PLACES = """customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def write_segments(spark, d, folder):
    """Customer files of two column orders in one folder, and a file without the key columns."""
    parts = ("c_name", "c_mktsegment")
    rows = table(spark, d, "customer").select(*[F.col(c).cast("string") for c in ("c_custkey", *parts, "c_acctbal")])
    machinery = F.col("c_mktsegment") == "MACHINERY"
    W.write_delimited(rows.where(~machinery), folder, sep="|")
    other = rows.where(machinery).select("c_mktsegment", "c_acctbal", "c_name", "c_custkey")
    W.write_delimited(other, folder, sep="|", mode="append")
    W.write_delimited(table(spark, d, "region"), folder, sep="|", mode="append")
    return folder, list(parts)


@query("a01_pipe_scan", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def a01(spark, d):
    path = scratch(spark, "pipe")
    W.write_delimited(table(spark, d, "supplier"), path, sep="|")
    return S.read_delimited(spark, path, sep="|").select(
        F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name", F.col("s_acctbal").cast("double").alias("s_acctbal")
    )


@query(
    "a02_comma_scan",
    """SELECT p_type, count(*) AS n, round(sum(p_retailprice), 2) AS price, CAST(max(p_size) AS DOUBLE) AS largest
    FROM part GROUP BY p_type""",
)
def a02(spark, d):
    path = scratch(spark, "comma")
    W.write_delimited(table(spark, d, "part"), path)
    read = S.read_delimited(spark, path)
    numbers = set(C.infer_numeric(read, read.columns))
    typed = read.select(*[F.col(c).cast("double").alias(c) if c in numbers else F.col(c) for c in read.columns])
    return typed.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("p_retailprice"), 2).alias("price"), F.max("p_size").alias("largest")
    )


@query(
    "a03_a04_folder_scan",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment, c_acctbal, '.csv' AS ending FROM customer""",
)
def a03(spark, d):
    folder, parts = write_segments(spark, d, scratch(spark, "folder"))
    rows = S.scan_folder(spark, folder, parts).rows
    return rows.select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("double").alias("c_acctbal"),
        F.right("source_file", F.lit(4)).alias("ending"),
    )


@query(
    "a05_b03_file_report",
    """SELECT 'missing columns' AS status, 'c_name,c_mktsegment' AS missing FROM region WHERE r_regionkey = 0
    UNION ALL SELECT 'read', '' FROM (SELECT count(*) AS n FROM customer) WHERE n > 0""",
)
def a05(spark, d):
    folder, parts = write_segments(spark, d, scratch(spark, "report"))
    report = S.scan_folder(spark, folder, parts).report
    return report.select("status", F.concat_ws(",", "missing").alias("missing")).distinct()


@query("a06_a08_quoted_roundtrip", "SELECT doc_id, text, lang, source FROM documents")
def a08(spark, d):
    path = scratch(spark, "quoted")
    W.write_delimited(table(spark, d, "documents").select("doc_id", "text", "lang", "source"), path, quote_all=True)
    read = S.read_delimited(spark, path, multiline=True)
    return read.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source")


@query(
    "a07_per_source_sink",
    "SELECT o_orderpriority AS source_file, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def a07(spark, d):
    path = scratch(spark, "per-source")
    W.write_per_source(table(spark, d, "orders").withColumn("source_file", F.col("o_orderpriority")), path)
    return spark.read.parquet(path).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "a09_read_back",
    """SELECT 'text_lang' AS column_name, count(*) AS rows, count_if(doc_id % 3 <> 0) AS filled FROM documents
    UNION ALL SELECT 'text_source', count(*), count_if(doc_id % 5 <> 1) FROM documents""",
)
def a09(spark, d):
    path = scratch(spark, "checked")
    rows = table(spark, d, "documents").select(
        "doc_id", without("lang", "doc_id", 3).alias("text_lang"), without("source", "doc_id", 5, 1).alias("text_source")
    )
    W.write_delimited(rows, path, quote_all=True)
    _, counts = W.read_back(spark, path, ["text_"])
    return counts.select(F.col("column").alias("column_name"), "rows", "filled")


@query("b01_projection", "SELECT DISTINCT c_custkey FROM customer")
def b01(spark, d):
    return C.first_column(table(spark, d, "customer")).distinct()


INJECTED_URL = """CASE page_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 'nan' WHEN 2 THEN 'None' WHEN 3 THEN '  '
    WHEN 4 THEN 'null' WHEN 5 THEN ' kept ' ELSE url END"""


@query(
    "b02_url_blanks",
    f"""SELECT page_id, CASE WHEN u IS NULL OR u IN ('nan', 'NaN', 'None', 'NULL', 'null', ' ', '  ') THEN '' ELSE u END AS url
    FROM (SELECT page_id, {INJECTED_URL} AS u FROM pages)""",
)
def b02(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.expr(INJECTED_URL).alias("url"))
    return C.blanks_to_empty(pages, ["url", "seller_url"])


@query("b04_drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def b04(spark, d):
    return C.drop_present(table(spark, d, "orders"), ["o_orderstatus", "o_orderdate", "o_orderpriority", "absent"])


SPARSE = """SELECT l_orderkey, l_linenumber,
    CASE WHEN l_partkey % 10 <> 0 THEN l_quantity END AS quantity,
    CASE WHEN l_partkey % 10 >= 8 THEN l_tax END AS tax,
    CASE WHEN l_partkey % 10 >= 8 THEN l_discount END AS pts
    FROM lineitem"""


def sparse_lines(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        without("l_quantity", "l_partkey", 10).alias("quantity"),
        F.when(F.col("l_partkey") % 10 >= 8, F.col("l_tax")).alias("tax"),
        F.when(F.col("l_partkey") % 10 >= 8, F.col("l_discount")).alias("pts"),
    )


@query("b05_drop_sparse", f"SELECT l_orderkey, l_linenumber, quantity, pts FROM ({SPARSE})")
def b05(spark, d):
    return P.drop_sparse(sparse_lines(spark, d), 0.7, exempt=["pts"])


@query(
    "b06_b07_b08_null_filters",
    """SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice FROM orders
    WHERE o_custkey % 7 <> 0 AND o_orderkey % 11 <> 3 AND o_orderkey % 13 <> 5""",
)
def b06(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", without("o_custkey", "o_custkey", 7).alias("o_custkey"),
        without("o_orderdate", "o_orderkey", 11, 3).alias("o_orderdate"),
        without("o_totalprice", "o_orderkey", 13, 5).alias("o_totalprice"),
    )
    kept = C.keep_not_null(orders, ["o_custkey", "absent_id"])
    kept = C.keep_not_null(kept, ["o_orderdate"])
    return C.keep_not_null(kept, ["o_totalprice"]).select("o_orderkey", "o_custkey", *rounded("o_totalprice", digits=2))


@query("b09_membership", "SELECT p_partkey, CAST(p_brand IN ('Brand#1', 'Brand#12') AS INTEGER) AS listed FROM part")
def b09(spark, d):
    return table(spark, d, "part").select("p_partkey", F.col("p_brand").isin("Brand#1", "Brand#12").cast("int").alias("listed"))


LIST_TEXT = """CASE page_id % 4 WHEN 0 THEN '[""]' WHEN 1 THEN '[]' WHEN 2 THEN '["' || url || '"]' END"""


@query("b10_list_without_first", "SELECT page_id FROM pages WHERE page_id % 4 = 0")
def b10(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.expr(LIST_TEXT).alias("urls"))
    return list_without_first(expand_list(pages, "urls"), "urls").select("page_id")


NUMERIC_TEXT = {"p_size": "CAST(p_size AS VARCHAR)", "p_brand": "p_brand", "p_mixed": "CASE WHEN p_partkey % 50 = 0 THEN 'x' ELSE CAST(p_size AS VARCHAR) END"}


@query(
    "b11_b13_infer_numeric",
    "\nUNION ALL ".join(
        f"""SELECT '{n}' AS column_name, CAST(bad = 0 AS INTEGER) AS is_numeric, CASE WHEN bad = 0 THEN top END AS max_value
        FROM (SELECT count_if(v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL) AS bad, max(try_cast(v AS DOUBLE)) AS top
              FROM (SELECT {sql} AS v FROM part))"""
        for n, sql in NUMERIC_TEXT.items()
    ),
)
def b11(spark, d):
    part = table(spark, d, "part").select(
        F.col("p_size").cast("string").alias("p_size"), "p_brand",
        F.when(F.col("p_partkey") % 50 == 0, "x").otherwise(F.col("p_size").cast("string")).alias("p_mixed"),
    )
    return C.numeric_report(part, C.by_prefix(part, ["p_"]))


@query(
    "b12_d10_d13_target_stats",
    """SELECT round(min(o_totalprice), 6) AS min_value, round(max(o_totalprice), 6) AS max_value,
    round(avg(o_totalprice), 4) AS mean_value, round(quantile_cont(o_totalprice, 0.5), 6) AS median_value FROM orders""",
)
def b12(spark, d):
    orders = table(spark, d, "orders")
    _, target = C.split_target(orders, "o_totalprice")
    middle = Q.medians(orders, [target])[target]
    return P.target_stats(orders, target).select(
        *rounded("min_value", "max_value"), *rounded("mean_value", digits=4), F.round(F.lit(middle), 6).alias("median_value")
    )


@query(
    "c01_key_semi_join",
    f"""WITH k AS (SELECT c_custkey, {CUSTOMER_KEY} AS soft_key, c_mktsegment FROM {PLACES})
    SELECT o_orderkey, soft_key FROM orders JOIN k ON o_custkey = c_custkey
    WHERE soft_key IN (SELECT soft_key FROM k WHERE c_mktsegment = 'BUILDING')""",
)
def c01(spark, d):
    keyed = K.with_key(places(spark, d), ["c_name", "r_name", "n_name", "c_mktsegment"], "soft_key")
    listed = K.distinct_keys(keyed.where("c_mktsegment = 'BUILDING'"), "soft_key")
    orders = table(spark, d, "orders").join(keyed.select("c_custkey", "soft_key"), F.expr("o_custkey = c_custkey"))
    return K.keep_listed(orders, listed, "soft_key").select("o_orderkey", "soft_key")


@query(
    "c01_filter_folder_by_keys",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, {key_sql("c_name", "c_mktsegment")} AS soft_key
    FROM customer WHERE c_acctbal > 5000""",
)
def c01_folder(spark, d):
    folder, parts = write_segments(spark, d, scratch(spark, "listed"))
    rich = table(spark, d, "customer").where("c_acctbal > 5000")
    listed = K.distinct_keys(K.with_key(rich, parts, "soft_key"), "soft_key")
    return filter_by_keys(spark, folder, listed, parts).rows.select("c_custkey", "soft_key")


FEATURES = """SELECT l_orderkey, CAST(l_quantity AS INTEGER) AS q, CASE WHEN l_partkey % 9 <> 0 THEN l_discount END AS disc, l_returnflag AS flag,
    {} AS part FROM lineitem"""
BUCKET = """CASE WHEN CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END"""


def feature_lines(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("int").alias("q"), without("l_discount", "l_partkey", 9).alias("disc"),
        F.col("l_returnflag").alias("flag"), "l_extendedprice",
    )
    return random_split(lines, ["l_orderkey"])


FEATURE_NAMES = ["q", "disc", "flag"]


@query(
    "c02_leak_anti_join",
    """WITH d AS (SELECT doc_id, text, CASE WHEN doc_id % 6 <> 0 THEN lang END AS lang, doc_id IN (SELECT doc_id FROM labels) AS labelled FROM documents)
    SELECT doc_id FROM d a WHERE NOT labelled AND NOT EXISTS
      (SELECT 1 FROM d b WHERE b.labelled AND b.text = a.text AND b.lang IS NOT DISTINCT FROM a.lang)""",
)
def c02(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", without("lang", "doc_id", 6).alias("lang"))
    labels = table(spark, d, "labels").select("doc_id")
    train = docs.join(labels, "doc_id", "left_semi")
    test = docs.join(labels, "doc_id", "left_anti")
    return D.not_in(test, train, ["text", "lang"]).select("doc_id")


@query(
    "c03_union_by_name",
    """SELECT doc_id AS id, text, lang, 'documents' AS source_file FROM documents
    UNION ALL SELECT item_id, text, NULL, 'benchmark' FROM benchmark""",
)
def c03(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    items = table(spark, d, "benchmark").select("text", F.col("item_id").alias("id"))
    return S.union_by_name([S.with_source(docs, "documents"), S.with_source(items, "benchmark")])


@query(
    "c04_d04_dup_counts",
    f"""WITH f AS ({FEATURES.format(BUCKET)})
    SELECT part, count(*) AS rows, count(DISTINCT (q, disc, flag)) AS distinct_rows, count(*) - count(DISTINCT (q, disc, flag)) AS duplicates FROM f GROUP BY part
    UNION ALL SELECT 'both', count(*), count(DISTINCT (q, disc, flag)), count(*) - count(DISTINCT (q, disc, flag)) FROM f""",
)
def c04(spark, d):
    lines = feature_lines(spark, d)
    train, test = lines.where("split = 'train'"), lines.where("split = 'test'")
    named = [("train", train), ("test", test), ("both", train.unionByName(test))]
    return S.union_by_name([D.duplicate_counts(f, FEATURE_NAMES).withColumn("part", F.lit(n)) for n, f in named])


@query(
    "c05_c06_lookup_counts",
    """SELECT l_orderkey, l_linenumber, l_suppkey, n AS supplier_lines, l_quantity / n AS per_line
    FROM lineitem JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) USING (l_suppkey)""",
)
def c06(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    counts = lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("supplier_lines"))
    counts = sized(counts.withColumn("_rows", F.col("supplier_lines")))
    return lookup(lines, counts, ["l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "supplier_lines",
        (F.col("l_quantity") / F.col("supplier_lines")).alias("per_line"),
    )


@query(
    "d01_dedup_first",
    """SELECT doc_id, lang, n_chars FROM
    (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def d01(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    return D.keep_first(docs, ["text"], ["doc_id"]).select("doc_id", "lang", "n_chars")


@query(
    "d01_dedup_null_key",
    """SELECT l_orderkey, l_linenumber, k FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
    FROM (SELECT *, CASE WHEN l_partkey % 3 <> 0 THEN l_partkey END AS k FROM lineitem)) WHERE rn = 1""",
)
def d01_null(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", without("l_partkey", "l_partkey", 3).alias("k")
    )
    return D.keep_first(lines, ["k"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "k")


@query("d02_distinct_keys", f"SELECT DISTINCT {key_sql('p_brand', 'p_type')} AS soft_key FROM part")
def d02(spark, d):
    return K.distinct_keys(K.with_key(table(spark, d, "part"), ["p_brand", "p_type"], "soft_key"), "soft_key")


@query(
    "d03_distinct_features",
    f"""SELECT q, disc, flag, min(l_orderkey) AS l_orderkey FROM ({FEATURES.format("''")}) GROUP BY 1, 2, 3""",
)
def d03(spark, d):
    lines = feature_lines(spark, d).select("l_orderkey", *FEATURE_NAMES, "l_extendedprice")
    return D.distinct_features(lines, FEATURE_NAMES, ["l_orderkey"]).select("l_orderkey", *FEATURE_NAMES)


@query(
    "d05_l10_key_summary",
    """SELECT event_type, count(*) AS rows, count(DISTINCT user_id) AS distinct_keys,
    count(*) - count(DISTINCT user_id) AS duplicates FROM events GROUP BY event_type""",
)
def d05(spark, d):
    return K.key_summary(table(spark, d, "events"), "user_id", ["event_type"])


@query("d06_frequency", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand")
def d06(spark, d):
    return K.frequency(table(spark, d, "part"), "p_brand").orderBy(F.desc("n"), "p_brand")


@query("d07_repeated_keys", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def d07(spark, d):
    return K.repeated(table(spark, d, "orders"), "o_custkey")


NULL_COLUMNS = ("l_orderkey", "quantity", "tax", "pts")


@query(
    "d08_d09_null_profile",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count({c}) AS non_nulls,
        round(1.0 * (count(*) - count({c})) / count(*), 6) AS null_ratio FROM ({SPARSE})"""
        for c in NULL_COLUMNS
    ),
)
def d08(spark, d):
    return P.null_profile(sparse_lines(spark, d), NULL_COLUMNS).select(
        "column_name", "nulls", "non_nulls", *rounded("null_ratio")
    )


@query("d08_total_nulls", f"SELECT CAST(count(*) - count(quantity) + count(*) - count(tax) AS BIGINT) AS nulls FROM ({SPARSE})")
def d08_total(spark, d):
    return P.total_nulls(sparse_lines(spark, d), ["quantity", "tax"])


@query(
    "d11_g06_length_profile",
    """SELECT min(length(t)) AS min_length, max(length(t)) AS max_length, round(avg(length(t)), 4) AS mean_length,
    count_if(t = '[]') AS empty_lists FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN '[]' ELSE text END AS t FROM documents)""",
)
def d11(spark, d):
    docs = table(spark, d, "documents").select(F.when(F.col("doc_id") % 10 == 0, "[]").otherwise(F.col("text")).alias("t"))
    return P.length_profile(docs, "t").select("min_length", "max_length", *rounded("mean_length", digits=4), "empty_lists")


DISTINCT = {"o_orderpriority": "o_orderpriority", "o_custkey": "o_custkey", "status": "CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END"}


@query(
    "d12_distinct_counts",
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(DISTINCT {sql}) AS distinct_values FROM orders" for n, sql in DISTINCT.items()
    ),
)
def d12(spark, d):
    orders = table(spark, d, "orders").withColumn("status", without("o_orderstatus", "o_orderkey", 4))
    return P.distinct_counts(orders, list(DISTINCT))


@query(
    "d14_global_mode",
    """SELECT (SELECT p_type FROM part WHERE p_partkey % 3 <> 0 GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1) AS type_mode,
    (SELECT p_size FROM part GROUP BY p_size ORDER BY count(*) DESC, p_size LIMIT 1) AS size_mode""",
)
def d14(spark, d):
    part = table(spark, d, "part").select(without("p_type", "p_partkey", 3).alias("p_type"), "p_size")
    found = Q.modes(part, ["p_type", "p_size"])
    return part.select(F.lit(found["p_type"]).alias("type_mode"), F.lit(int(found["p_size"])).alias("size_mode")).distinct()


@query(
    "d15_group_statistics",
    """WITH t AS (SELECT l_suppkey, l_extendedprice AS x, l_returnflag AS f FROM lineitem),
    m AS (SELECT l_suppkey, f, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, f) AS rn FROM t GROUP BY 1, 2)
    SELECT l_suppkey, round(quantile_cont(x, 0.5), 4) AS median_x, round(avg(x), 4) AS mean_x, any_value(m.f) AS mode_f
    FROM t JOIN m USING (l_suppkey) WHERE rn = 1 GROUP BY l_suppkey""",
)
def d15(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", F.col("l_extendedprice").alias("median_x"), F.col("l_returnflag").alias("mode_f"))
    middle = Q.group_medians(lines, ["median_x"], ["l_suppkey"]).drop("_rows")
    means = lines.groupBy("l_suppkey").agg(F.avg("median_x").alias("mean_x"))
    common = Q.group_modes(lines, ["mode_f"], ["l_suppkey"]).drop("_rows")
    return middle.join(means, "l_suppkey").join(common, "l_suppkey").select(
        "l_suppkey", *rounded("median_x", "mean_x", digits=4), "mode_f"
    )


QUANTS = (0.01, 0.05, 0.25, 0.5, 0.95, 0.99)


@query(
    "d16_d17_quantiles",
    "\nUNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS q, round(quantile_cont(value, {q}), 6) AS v, round(max(value), 6) AS top FROM events" for q in QUANTS
    ),
)
def d16(spark, d):
    events = table(spark, d, "events")
    found = Q.quantiles(events, {"value": QUANTS})["value"]
    pairs = F.array(*[F.struct(F.lit(q).alias("q"), F.round(F.lit(v), 6).alias("v")) for q, v in zip(QUANTS, found)])
    top = events.agg(F.round(F.max("value"), 6).alias("top"))
    return top.select(F.explode(pairs).alias("e"), "top").select("e.q", "e.v", "top")


@query(
    "d18_mean_deviation",
    "SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean, round(stddev_pop(c_acctbal), 6) AS spread FROM customer GROUP BY 1",
)
def d18(spark, d):
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(
        F.round(F.avg("c_acctbal"), 6).alias("mean"), F.round(F.stddev_pop("c_acctbal"), 6).alias("spread")
    )


@query("e01_first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def e01(spark, d):
    return C.first_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 10, [F.desc("o_totalprice"), "o_orderkey"])


@query("e02_top_repeated", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1 ORDER BY n DESC, user_id LIMIT 10")
def e02(spark, d):
    return K.top_repeated(table(spark, d, "events"), "user_id")


@query(
    "e02_more_repeated",
    """SELECT count(*) AS repeated_keys, greatest(count(*) - 10, 0) AS not_shown
    FROM (SELECT user_id FROM events GROUP BY user_id HAVING count(*) > 1)""",
)
def e02_more(spark, d):
    return K.more_repeated(table(spark, d, "events"), "user_id")


@query(
    "e03_best_by_error",
    """SELECT model, round(test_rmse, 4) AS test_rmse FROM (SELECT o_orderpriority AS model, sqrt(avg((o_totalprice - m) ** 2)) AS test_rmse
    FROM orders, (SELECT avg(o_totalprice) AS m FROM orders) GROUP BY 1) ORDER BY test_rmse, model LIMIT 1""",
)
def e03(spark, d):
    orders = table(spark, d, "orders")
    mean = orders.agg(F.avg("o_totalprice")).first()[0]
    errors = orders.groupBy(F.col("o_orderpriority").alias("model")).agg(
        F.sqrt(F.avg(F.pow(F.col("o_totalprice") - F.lit(mean), 2))).alias("test_rmse")
    )
    return best_model(errors).select("model", *rounded("test_rmse", digits=4))


@query("e04_example_row", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1")
def e04(spark, d):
    return C.first_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 1, ["o_orderkey"])


@query(
    "g01_g02_key_build",
    f"SELECT c_custkey, {CUSTOMER_KEY} AS soft_key FROM {PLACES}",
)
def g01(spark, d):
    keyed = K.with_key(places(spark, d), ["c_name", "r_name", "n_name", "c_mktsegment"], "soft_key")
    return keyed.select("c_custkey", "soft_key")


@query(
    "g01_document_keys",
    """SELECT doc_id, trim(regexp_replace(coalesce(t, 'nan'), '[ .,_]+', '_', 'g'), '_') AS soft_key
    FROM (SELECT doc_id, CASE WHEN doc_id % 8 <> 0 THEN text END AS t FROM documents)""",
)
def g01_docs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", without("text", "doc_id", 8).alias("t"))
    return docs.select("doc_id", composite_key([F.col("t")]).alias("soft_key"))
