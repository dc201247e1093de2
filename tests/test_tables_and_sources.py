import gzip

from pyspark.sql import functions as F

from tabmill.operators import dedup as D
from tabmill.operators import keys as K
from tabmill.operators import metrics as M
from tabmill.operators import profile as P
from tabmill.operators.split import random_split, stratified_split
from tabmill.plans.filter_by_keys import filter_by_keys, key_list
from tabmill.sources import sinks as W
from tabmill.sources.delimited import read_delimited, scan_folder


def test_keep_first_by_order_with_nulls_as_one_key(rows):
    df = rows([("a", 3, "z"), ("a", 1, "y"), (None, 5, "q"), (None, 4, "p")], "k string, ord int, v string")
    for parts in (1, 4):
        out = D.keep_first(df.repartition(parts), ["k"], ["ord"]).collect()
        assert sorted(((r["k"] or ""), r["v"]) for r in out) == [("", "p"), ("a", "y")]
    assert out[0].__fields__ == ["k", "ord", "v"]


def test_duplicates_and_leakage_with_nulls(rows):
    schema = "x1 double, x2 double, y int"
    train = rows([(1.0, None, 1), (1.0, None, 2), (2.0, 2.0, 3)], schema)
    test = rows([(1.0, None, 9), (2.0, None, 8), (None, None, 7)], schema)
    assert D.duplicate_counts(train, ["x1", "x2"]).first()["duplicates"] == 1
    assert D.distinct_features(train, ["x1", "x2"], ["y"]).agg(F.sum("y")).first()[0] == 4
    assert sorted(r["y"] for r in D.not_in(test, train, ["x1", "x2"]).collect()) == [7, 8]


def test_no_leak_is_left(spark):
    df = spark.range(2000).select("id", (F.col("id") % 300).alias("a"))
    split = random_split(df, ["id"])
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    assert D.not_in(test, train, ["a"]).join(train, "a", "left_semi").count() == 0


def test_splits_do_not_depend_on_partitions(spark):
    df = spark.range(3000).withColumn("y", F.col("id").cast("double"))
    a = stratified_split(df.repartition(1), ["id"], "y").orderBy("id").collect()
    b = stratified_split(df.repartition(7), ["id"], "y").orderBy("id").collect()
    assert a == b
    shares = stratified_split(df, ["id"], "y").groupBy("stratum").agg(F.avg((F.col("split") == "test").cast("int")).alias("s"))
    assert all(0.15 < r["s"] < 0.25 for r in shares.collect())


def test_sparse_threshold_is_strict(spark):
    df = spark.range(100).select(
        *[F.when(F.col("id") >= n, 1.0).alias(f"c{n}") for n in (69, 70, 71, 100)],
        F.when(F.col("id") >= 90, 1.0).alias("pts"),
    )
    assert P.sparse_columns(df, 0.7, ["pts"]) == ["c71", "c100"]


def test_key_reports(rows):
    df = rows([("a",), ("a",), ("b",), ("a",), ("b",), ("c",)], "k string")
    assert K.key_summary(df, "k").first().asDict() == {"rows": 6, "distinct_keys": 3, "duplicates": 3}
    assert [tuple(r) for r in K.top_repeated(df, "k").collect()] == [("a", 3), ("b", 2)]
    assert K.more_repeated(df, "k", 1).first().asDict() == {"repeated_keys": 2, "not_shown": 1}


def test_semi_join_keeps_repeats_and_has_no_plain_join(rows):
    df = rows([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    keys = rows([("a",), ("a",), (None,)], "listed string")
    kept = K.keep_listed(df, keys, "k")
    assert sorted(r["v"] for r in kept.collect()) == [1, 2]
    assert "LeftSemi" in kept._jdf.queryExecution().toString()


def test_folder_of_mixed_headers(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    head = "seller|region|city|address"
    (folder / "a.csv").write_text(f"{head}|price\nS 1|R|C|A|10\nS 1|R|C|A|11\nS 2|R|C||NA\n", encoding="utf-8")
    (folder / "b.csv").write_text("price|address|city|region|seller|more\n12|A|C|R|S 1|x\n", encoding="utf-8")
    (folder / "c.csv").write_text("seller|price\nS 1|13\n", encoding="utf-8")
    (folder / "d.CSV").write_text(f"{head}|price\nS 1|R|C|A|14\n", encoding="utf-8")
    (folder / "deep" / "e.csv").write_text(f"{head}|price\nS 1|R|C|A|15\n", encoding="utf-8")
    sellers = spark.createDataFrame([("S.1", "R", "C", "A")], "seller string, region string, city string, address string")
    found = filter_by_keys(
        spark, str(folder), key_list(sellers), annotated_path=str(tmp_path / "all"), work_folder=str(tmp_path / "work")
    )
    got = {(r["source_file"], r["price"], r["more"]) for r in found.rows.collect()}
    assert got == {("a.csv", "10", None), ("a.csv", "11", None), ("b.csv", "12", "x")}
    report = {r["source_file"]: (r["status"], r["rows"], r["duplicates"]) for r in found.per_file().collect()}
    assert report == {"a.csv": ("read", 2, 1), "b.csv": ("read", 1, 0), "c.csv": ("missing columns", 0, 0)}
    assert spark.read.parquet(str(tmp_path / "all")).count() == 4
    assert found.totals().first()["rows"] == 3
    assert scan_folder(spark, str(folder), ["seller"]).rows.where("price IS NULL").count() == 1


def test_quoted_round_trip(spark, tmp_path, rows):
    texts = ['say "hi"', "a,b|c", "two\nlines", "  padded  ", "back\\slash", "ё"]
    df = rows(list(enumerate(texts)), "id int, t string")
    W.write_delimited(df, str(tmp_path / "q"), quote_all=True)
    back = read_delimited(spark, str(tmp_path / "q"), multiline=True).orderBy("id").collect()
    assert [r["t"] for r in back] == texts
    columns, counts = W.read_back(spark, str(tmp_path / "q"), ["t"])
    assert columns == ["id", "t"]
    assert [tuple(r) for r in counts.collect()] == [(6, "t", 6)]


def test_settings_file(spark, tmp_path):
    assert not W.write_settings(spark, str(tmp_path / "s"), "m", {})
    assert W.write_settings(spark, str(tmp_path / "s"), "m", {"maxDepth": 5})
    row = spark.read.json(str(tmp_path / "s")).first()
    assert (row["model_name"], row["hyperparameters"]) == ("m", '{"maxDepth": 5}')


def test_range_r2_limits(rows):
    data = [(100.0 + i, 100.0) for i in range(6)] + [(600000.0 + i, 1.0) for i in range(5)] + [(1000000.0, 2.0)] * 7
    out = {r["range_id"]: r for r in M.range_r2(rows(data, "y double, p double"), "y", "p").collect()}
    assert len(out) == 5 and out[4]["samples"] == 0
    assert out[0]["r2"] is not None and out[1]["r2"] is None and out[2]["r2"] is None
    assert out[2]["samples"] == 7 and abs(sum(r["weight"] for r in out.values()) - 1) < 1e-12


def test_overfit_levels_at_the_limits(rows):
    gaps = [0.15, 0.16, 0.08, 0.081, 0.03, 0.031, -0.1]
    df = rows([(g,) for g in gaps], "g double").coalesce(1)
    got = [r[0] for r in df.select(M.overfit_level(F.col("g"))).collect()]
    assert got == ["moderate", "strong", "slight", "moderate", "minimal", "slight", "minimal"]


def test_histogram_counts_every_error(rows):
    df = rows([(0.0, float(i)) for i in range(101)], "y double, p double")
    out = M.error_histogram(df, "y", "p").collect()
    assert len(out) == 50 and sum(r["n"] for r in out) == 101


def test_one_broken_file_does_not_end_the_folder(spark, tmp_path):
    good = "seller|price\n" + "\n".join(f"s{i}|{i}" for i in range(3000)) + "\n"
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(good)
    (folder / "undecodable.csv").write_bytes(good.encode() + b"caf\xe9|1\n")
    (folder / "wide.csv").write_text(good + "s|1|2\n")
    (folder / "quoted.csv").write_text('seller|price\n"a|b"|1\nshort\n')
    (folder / "empty.csv").write_text("")
    (folder / "other.csv").write_text("x|y\n1|2\n")
    found = scan_folder(spark, str(folder), ["seller"])
    status = {r["source_file"]: r["status"] for r in found.report.collect()}
    assert {k: v for k, v in status.items() if k != "empty.csv"} == {"a.csv": "read", "undecodable.csv": "undecodable", "wide.csv": "too many fields", "quoted.csv": "read", "other.csv": "missing columns"}
    assert {r["source_file"]: r["count"] for r in found.rows.groupBy("source_file").count().collect()} == {"a.csv": 3000, "quoted.csv": 2}
    relaxed = {r["source_file"]: r["status"] for r in scan_folder(spark, str(folder), ["seller"], strict=False).report.collect()}
    assert relaxed["wide.csv"] == "read"


def test_truncated_archives_are_listed(spark, tmp_path):
    whole = gzip.compress("".join(["seller|price\n", *(f"s{i}|{i * 7919 % 1000}\n" for i in range(20000))]).encode())
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv.gz").write_bytes(whole)
    (folder / "two.csv.gz").write_bytes(whole + gzip.compress(b"s|1\n"))
    (folder / "cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    (folder / "noise.csv.gz").write_bytes(b"no archive at all")
    found = scan_folder(spark, str(folder), ["seller"], pattern="*.csv.gz")
    assert {r["source_file"]: r["status"] for r in found.report.collect()} == {"a.csv.gz": "read", "two.csv.gz": "read", "cut.csv.gz": "truncated", "noise.csv.gz": "truncated"}
    assert found.rows.count() == 40001
