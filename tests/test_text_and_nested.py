import pytest
from pyspark.sql import functions as F

from tabmill.functions import nested as N
from tabmill.functions import text as T
from tabmill.operators.expand import dict_keys, dict_statistics, expand_dict, expand_list


def values(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_clean_key(rows):
    cases = {
        "a b": "a_b", " a. b,, c ": "a_b_c", "__a__": "a", "_": "", "": "", None: "nan", "a\tb": "a\tb",
        "Москва, ул. Мира": "Москва_ул_Мира", "1.0": "1_0",
    }
    df = rows([(k,) for k in cases], "c string").coalesce(1)
    assert values(df, T.clean_key(F.col("c"))) == list(cases.values())


def test_composite_key_keeps_empty_parts(rows):
    df = rows([("a", "_", None, "b.")], "a string, b string, c string, d string")
    assert values(df, T.composite_key([F.col(c) for c in "abcd"])) == ["a__nan_b"]


def test_numbers_from_text(rows):
    cases = [("4+", 4.0, None, None), ("2", 2.0, None, 2.0), ("3 owners", 3.0, None, None), ("none", None, None, None),
             (None, None, None, None), ("1.6 AT", 1.0, 1.6, None), ("5d", 5.0, None, None), (" -1e2 ", 1.0, None, -100.0), (".5", 5.0, None, 0.5)]
    df = rows([(c[0],) for c in cases], "c string").coalesce(1)
    for i, fn in enumerate((T.first_integer, T.first_decimal, T.to_number), 1):
        assert values(df, fn(F.col("c"))) == [c[i] for c in cases]


def test_blank_tokens(rows):
    df = rows([("nan",), (" ",), ("   ",), (None,), ("x",)], "c string").coalesce(1)
    assert values(df, T.blank_to_empty(F.col("c"))) == ["", "", "   ", "", "x"]


def test_strip_takes_every_kind_of_space(rows):
    df = rows([("  A \n\t",)], "c string")
    assert values(df, T.normal_text(F.col("c"))) == ["a"]


DICTS = [
    (None, None), ("", None), ("nan", None), ("{}", None), ("[]", None), ("plain text", None), ("{abc}", None),
    ("{'a': 1, 'b': 'x'}", {"a": "1", "b": "x"}),
    ('{"a": null, "b": "y"}', {"a": None, "b": "y"}),
    ("{'a': None, 'b': True}", {"a": None, "b": "true"}),
    ("{'a': 'it's', 'b': 2}", {"a": "it's", "b": "2"}),
    ("{a: 1, b: two}", {"a": "1", "b": "two"}),
    ("{'a': 1, 'a': 2}", {"a": "2"}),
    ("{a: 1, a: 2, b: }", {"a": "2"}),
]


def test_parse_dict(rows):
    df = rows([(d[0],) for d in DICTS], "c string").coalesce(1)
    assert values(df, N.parse_dict(F.col("c"))) == [d[1] for d in DICTS]


def test_expand_dict_and_statistics(rows):
    df = rows([(i, d[0]) for i, d in enumerate(DICTS)], "row_id int, options string")
    out = expand_dict(df, "options").orderBy("row_id").collect()
    assert [r["options_a"] for r in out] == [(d[1] or {}).get("a") for d in DICTS]
    assert dict_statistics(df, "options").first().asDict() == {"parsed": 7, "failed": 2, "blank": 5}


def test_expand_dict_limits_and_clashes(rows):
    df = rows([("{'a': 1, 'b': 2}", 0)], "options string, options_a int")
    with pytest.raises(ValueError, match="more than 1"):
        dict_keys(df, "options", max_keys=1)
    with pytest.raises(ValueError, match="exist already"):
        expand_dict(df, "options")


def test_expanded_names_may_hold_blanks_and_dots(rows):
    df = rows([("{'Обогрев зад. стекла': 1}",)], "options string")
    assert expand_dict(df, "options").columns[-1] == "options_Обогрев зад. стекла"


LISTS = [
    (None, 0, None), ("", 0, None), ("[]", 0, None), ("['a','b']", 2, "a"), ('[{"url":"x"},{"url":"y"}]', 2, "x"),
    ('[{"url":null}]', 0, None), ('[{"url":"x"},{"url":null}]', 0, None), ('[{"url": null}, {"url": "z"}]', 1, "z"),
    ('a, b ,"c"', 3, "a"), ("single", 1, "single"), ("5", 0, None), ("[1, 2", 2, "[1"), ("[None, 'b']", 2, None),
    ("['']", 1, None), ("null", 1, "null"), ('{"a": 1}', 0, None),
]


def test_expand_list(rows):
    df = rows([(i, x[0]) for i, x in enumerate(LISTS)], "row_id int, image_urls string")
    out = expand_list(df, "image_urls").orderBy("row_id").collect()
    assert [(r["image_urls_count"], r["image_urls_first"]) for r in out] == [x[1:] for x in LISTS]


def test_url_search(rows):
    df = rows([(0, '[{"url":null}] http://a/1, https://b/2]')], "row_id int, urls string")
    found = df.select(N.find_urls(F.col("urls"))).first()[0]
    assert found == ["http://a/1", "https://b/2"]


def test_no_python_in_the_plan(spark, rows, capsys):
    df = rows([("{'a': 1}", "['x']")], "options string, urls string")
    expand_list(expand_dict(df, "options", keys=["a"]), "urls").explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "ArrowEval" not in plan
