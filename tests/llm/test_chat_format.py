"""Chat formatting: exact round trip, loss mask, role machine, and the SQL form."""

import hashlib
from collections import defaultdict

import check_oracles
import pytest
from pyspark.sql import functions as F

from tabmill.llm import chat_format as c
from tabmill.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, valid string, segments int"
TEXTS = [
    None, "", "\\", "\\\\", "##", "###", "####", "#" * 9, "</turn>\n", "\\</turn>\n\\", "</turn", "### User:\n</turn>\n### Assistant:\nx", "a:\nb", ":\\\n", "é𝄞\r\n\t",
    "#\\##", "<\\/turn>", "$1 \\1 (?s)", "long " * 60000, c.PROBE,
]
ROLES = ["system", "user", "assistant", "tool", "", None, "a:\nb", "?x", "User", "\\</turn>\n", "r:"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(rows):
    turns = [(i % 7, i, ROLES[(i * 5) % len(ROLES)], t, "x", 0) for i, t in enumerate(TEXTS * 3)] + [(90, 1, "user", "b", "x", 0), (90, 1, "user", "a", "x", 0), (90, 1, "user", "a", "x", 0), (None, None, None, None, "x", 0)]
    df = rows(turns, SCHEMA)
    got = {r.conv_id: r for r in c.digests(df).collect()}
    want = defaultdict(list)
    for conv, turn, role, text, *_ in turns:
        want[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(want)
    for conv, said in want.items():
        said.sort()
        trained = "".join(t for _, r, t in said if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(said) and r.turns_sha256 == sha("".join(f"{a}\n{t}\n" for _, a, t in said))
        assert (r.loss_chars, r.loss_sha256) == (len(trained), sha(trained))
    for r in c.formatted(df).select("segments", c.whole_text().alias("all")).collect():
        texts = [s.text for s in r.segments]
        assert r["all"] == "".join(texts)
        assert not any(m in t for t in texts[1::3] for m in c.DEFAULT.controls)


@pytest.mark.parametrize(
    ("roles", "valid"),
    [
        ("user", True), ("user assistant", True), ("system user assistant user", True), ("assistant", False), ("system", False), ("user user", False),
        ("user system", False), ("user assistant system", False), ("user tool assistant", False), ("system system user", False),
    ],
)
def test_role_machine(rows, roles, valid):
    df = rows([(1, i, r, "t", "", 0) for i, r in enumerate(roles.split())], SCHEMA)
    assert c.formatted(df).first().valid is valid


def test_templates(rows):
    with pytest.raises(ValueError):
        c.Template(close="##")
    own = c.Template(open="<|im|>", close="[[[end", trained=("user", "assistant"), labels=(("user", "U"),))
    df = rows([(1, 0, "user", "[[[end [[[[end <|im|>", "", 0), (1, 1, "assistant", "x", "", 0)], SCHEMA)
    out = c.formatted(df, own).select(c.read_back(c.whole_text(), own).alias("turns"), c.trained_text().alias("trained")).first()
    assert [tuple(t) for t in out.turns] == [("user", "[[[end [[[[end <|im|>"), ("assistant", "x")]
    assert out.trained == "[[[end [[[[end <|im|>x"


def test_empty_table_and_probe(rows):
    empty = rows([], SCHEMA)
    assert c.digests(empty).collect() == []
    r = c.digests(c.with_probe(empty)).first()
    assert (r.conv_id, r.n_turns, r.loss_chars, r.loss_sha256, r.valid) == (-7, 2, len(c.PROBE), sha(c.PROBE), True)


def test_query_equals_sql(spark):
    folder, name = "/root/testdata/sf0.001", "op9_role_machine_chat_format"
    assert check_oracles.compare(QUERIES[name](spark, folder), check_oracles.connect(folder), ORACLES[name]) is None


def test_escape_alone(rows):
    df = rows([(1, 0, "", t or "", "", 0) for t in TEXTS], SCHEMA).select("text", c.unescaped(c.escaped(F.col("text"))).alias("back"))
    assert all(r.text == r.back for r in df.collect())
