"""Exact statistics, fills, bins and scaling against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabmill.operators import binning as B
from tabmill.operators import encode as E
from tabmill.operators import impute as I
from tabmill.operators import quantiles as Q
from tabmill.operators import scale as S
from tabmill.operators.lookup import lookup
from tabmill.runtime import sized


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 4000
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "g": np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 12, n).astype(str)),
            "x": rng.lognormal(3, 1, n).round(2),
            "y": np.where(rng.random(n) < 0.5, 7.0, rng.normal(0, 1, n)),
            "c": rng.choice(list("abcd"), n),
        }
    )
    pdf.loc[rng.random(n) < 0.15, "x"] = np.nan
    pdf.loc[rng.random(n) < 0.1, "c"] = None
    pdf.loc[rng.random(n) < 0.1, "g"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "id long, g string, x double, y double, c string")
    return pdf, df.repartition(4).persist()


PROBS = [0.01, 0.05, 0.5, 0.95, 0.99]


@pytest.mark.parametrize("limit", [10**6, 3000, 100])
def test_quantiles_are_exact_however_they_are_found(table, limit):
    pdf, df = table
    found = Q.quantiles(df, {"x": PROBS, "y": PROBS}, limit)
    for c in "xy":
        assert np.allclose(found[c], pdf[c].quantile(PROBS), rtol=1e-12)


def test_many_ranks_are_looked_up_without_a_row_for_each(table, monkeypatch):
    pdf, df = table
    monkeypatch.setattr(Q, "_narrowed", lambda *a: pytest.fail("every value was joined with every rank"))
    probs = [i / 254 for i in range(255)]
    found = Q.quantiles(df, {"x": probs, "y": probs}, 50)
    for c in "xy":
        assert np.allclose(found[c], pdf[c].quantile(probs), rtol=1e-12)


@pytest.mark.parametrize("limit", [10**6, 300])
def test_group_medians_split_large_groups(table, limit):
    pdf, df = table
    found = Q.group_medians(df, ["x", "y"], ["g"], limit).toPandas()
    want = pdf.fillna({"g": "?"}).groupby("g")[["x", "y"]].median()
    got = found.fillna({"g": "?"}).set_index("g").loc[want.index, ["x", "y"]]
    assert np.allclose(got.astype(float), want)


def test_empty_and_all_null_columns(rows):
    df = rows([(None, 1.0)], "a double, b double")
    assert Q.quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [None], "b": [1.0]}
    assert Q.modes(df, ["a"]) == {"a": None}


def test_mode_takes_the_smallest_on_a_tie(rows):
    df = rows([("b", 2), ("a", 2), (None, 1)], "t string, n int")
    assert Q.modes(df, ["t", "n"]) == {"t": "a", "n": 2.0}


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_lookup_is_the_same_by_broadcast_and_by_split_shuffle(table, broadcast_bytes):
    pdf, df = table
    means = sized(df.groupBy("g").agg(F.avg("y").alias("m"), F.count("*").alias("_rows")))
    got = lookup(df, means, ["g"], broadcast_bytes).orderBy("id").toPandas()
    assert len(got) == len(pdf)
    want = pdf.groupby("g")["y"].transform("mean")
    assert np.allclose(got["m"], want, equal_nan=True)


def test_group_fill_falls_back_to_the_filled_median(rows):
    df = rows(
        [("a", 1.0, "u"), ("a", None, None), ("a", 3.0, "u"), ("b", None, None), ("b", None, None), (None, None, "w"), (None, 9.0, None)],
        "g string, x double, t string",
    )
    out = I.fill_typed(df, ["x", "t"], ["g"]).toPandas()
    assert sorted(out["x"]) == [1.0, 2.0, 2.5, 2.5, 2.5, 3.0, 9.0]
    assert sorted(out["t"]) == ["Unknown", "Unknown", "Unknown", "u", "u", "u", "w"]


def test_fill_mode_of_an_empty_column_is_the_fallback(rows):
    df = rows([(None, None)], "pts double, c string")
    assert tuple(I.fill_mode(I.fill_mode(df, ["pts"], 1), ["c"]).first()) == (1.0, "Unknown")


def test_prices_without_a_price_column_take_medians(rows):
    df = rows([(1.0, None), (3.0, 5.0)], "price_low double, update_count double")
    out = I.fill_prices(df, "price_rub", "price_low", "price_high", ["update_count"]).collect()
    assert sorted(tuple(r) for r in out) == [(1.0, 5.0), (3.0, 5.0)]


def test_bins_equal_pandas(table):
    pdf, df = table
    out = B.quantile_bins(B.width_bins(B.width_bins(df, ["x"], 5), ["x"], 10), ["x", "y"], 5).orderBy("id").toPandas()
    for name, want in {
        "x_bins_5": pd.cut(pdf["x"], 5, labels=False),
        "x_bins_10": pd.cut(pdf["x"], 10, labels=False),
        "x_q_bins_5": pd.qcut(pdf["x"], 5, labels=False, duplicates="drop"),
        "y_q_bins_5": pd.qcut(pdf["y"], 5, labels=False, duplicates="drop"),
    }.items():
        assert np.array_equal(out[name], want, equal_nan=True), name


def test_constant_column_bins(rows):
    df = rows([(4.0,), (4.0,)], "x double")
    out = B.quantile_bins(B.width_bins(B.width_bins(df, ["x"], 5), ["x"], 10), ["x"], 5).first()
    assert (out["x_bins_5"], out["x_bins_10"], out["x_q_bins_5"]) == (2, 4, None)


def test_clip_and_winsor_equal_numpy(table):
    pdf, df = table
    got = S.apply_limits(df, S.fit_clip(df, ["x"])).orderBy("id").toPandas()["x"]
    want = np.clip(pdf["x"], pdf["x"].quantile(0.01), pdf["x"].quantile(0.99))
    assert np.allclose(got, want.fillna(want.median()))
    q05, q95 = pdf["x"].quantile(0.05), pdf["x"].quantile(0.95)
    want = pdf["x"].clip(q05 - 1.5 * (q95 - q05), q95 + 1.5 * (q95 - q05))
    got = S.apply_limits(df, S.fit_winsor(df, ["x"])).orderBy("id").toPandas()["x"]
    assert np.allclose(got, want.fillna(want.median()))


@pytest.mark.parametrize("skip, ones", [(False, 0), (True, 3)])
def test_rare_flag_is_winsorised_away_unless_skipped(spark, skip, ones):
    df = spark.range(100).select((F.col("id") < 3).cast("int").alias("f"))
    assert S.apply_limits(df, S.fit_winsor(df, ["f"], skip)).agg(F.sum("f")).first()[0] == ones


def test_scale_uses_population_deviation(table, rows):
    pdf, df = table
    got = S.apply_scale(df, S.fit_scale(df, ["y"])).orderBy("id").toPandas()["y"]
    assert np.allclose(got, (pdf["y"] - pdf["y"].mean()) / pdf["y"].std(ddof=0))
    flat = rows([(7.7,), (7.7,), (7.7,)], "x double")
    assert {r[0] for r in S.apply_scale(flat, S.fit_scale(flat, ["x"])).collect()} == {0.0}


@pytest.mark.parametrize("kinds, one_hot", [(20, True), (21, False)])
def test_encoding_choice_at_the_limit(spark, kinds, one_hot):
    df = spark.range(kinds * 2).select((F.col("id") % kinds).cast("string").alias("c"))
    fitted = E.fit_encoding(df, ["c"])
    assert (len(fitted.categories.get("c", [])) == kinds) == one_hot
    assert ("c" in fitted.counts) != one_hot


def test_unseen_values_get_zeros_or_null(rows):
    df = rows([("a", "p"), ("b", "q"), ("a", "q")], "c string, f string")
    fitted = E.fit_encoding(df, ["c", "f"], always_counts=["f"])
    out = E.apply_encoding(rows([("z", "z"), (None, None), ("a", "q")], "c string, f string"), fitted).collect()
    assert sorted((r["c_a"], r["c_b"], r["f_freq"] or 0) for r in out) == [(0.0, 0.0, 0), (0.0, 0.0, 0), (1.0, 0.0, 2)]


@pytest.mark.parametrize("limit", [100, 3])
def test_labels_are_sorted_ranks_for_any_number_of_values(spark, limit):
    df = spark.range(40).select(F.format_string("v%03d", F.col("id") % 20).alias("c"))
    out = E.apply_labels(df, "c", E.fit_labels(df, "c", limit)).distinct().collect()
    assert sorted((r["c"], r["c_label"]) for r in out) == [(f"v{i:03d}", i) for i in range(20)]


def test_rare_values(spark):
    df = spark.range(300).select(F.when(F.col("id") < 2, "odd").when(F.col("id") < 5, "few").when(F.col("id") < 9, None).otherwise("m").alias("mark"))
    out = E.rare_flag(df, "mark").groupBy("mark").agg(F.max("is_rare_mark").alias("r")).collect()
    assert {r["mark"]: r["r"] for r in out} == {"odd": 1, "few": 0, None: 0, "m": 0}


def test_many_columns_are_measured_a_dozen_at_a_time(spark, monkeypatch):
    """One aggregate over all columns of a wide table isn't compiled."""
    df = spark.range(200).select(*[(F.col("id") % (i + 2) + 0.5).alias(f"c {i}.x") for i in range(30)])
    pdf, widths, real = df.toPandas(), [], type(df).agg

    def agg(self, *columns):
        widths.append(len(columns))
        return real(self, *columns)

    monkeypatch.setattr(type(df), "agg", agg)
    scale = S.fit_scale(df, df.columns)
    middle = Q.quantiles(df, {c: [0.5] for c in df.columns}, 100)
    assert max(widths) <= 3 * 12
    assert all(np.allclose(scale[c], (pdf[c].mean(), pdf[c].std(ddof=0))) and middle[c] == [pdf[c].median()] for c in df.columns)
