"""Hilbert shards: the curve by its defining properties, the law and slots by plain sums."""

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.llm import hilbert_shards as h

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, cell int"


@pytest.mark.parametrize(("d", "bits"), [(1, 3), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_and_moves_by_one(rows, d, bits):
    cells = list(itertools.product(range(1 << bits), repeat=d))
    names = [f"x{i}" for i in range(d)]
    df = rows(cells, ", ".join(f"{n} int" for n in names))
    got = df.withColumn("at", h.hilbert_index([F.col(n) for n in names], bits)).collect()
    order = sorted((r["at"], tuple(r[n] for n in names)) for r in got)
    assert [at for at, _ in order] == list(range(len(cells)))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for (_, a), (_, b) in zip(order, order[1:]))


def documents():
    rng = np.random.default_rng(1)
    out = [(i, "t" * int(rng.integers(0, 50)), ["en", "de", None, "fr"][i % 4], f"https://a.example/s{i * i % 17}", int(rng.integers(0, 900))) for i in range(403)]
    out += [(1000 + i, "hot", "en", "https://a.example/s1", 3) for i in range(250)] + [(None, None, None, None, None)] * 2 + [(5000, "é" * 40000, "en", "", 40000)]
    return out


def test_law_slots_and_order(rows, monkeypatch):
    docs = documents()
    got = h.sharded(rows([(*d, "x", 1) for d in docs], SCHEMA), rank_rows=20).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    shards = defaultdict(list)
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        shards[r.shard].append(r)
    assert sorted(shards) == list(range(16)) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    last = -1
    for shard in range(16):
        run = sorted(shards[shard], key=lambda r: r.slot)
        assert [r.slot for r in run] == list(range(len(run)))
        assert run[0].hilbert >= last and all(a.hilbert <= b.hilbert for a, b in zip(run, run[1:]))
        last = run[-1].hilbert


def test_shards_are_narrow_in_every_dimension(rows):
    rng = np.random.default_rng(2)
    docs = [(i, "t", f"l{rng.integers(0, 16):02}", f"s{rng.integers(0, 16):02}", int(rng.integers(0, 1000))) for i in range(2000)]
    df = rows([(*d, "x", 1) for d in docs], SCHEMA)
    shard = {r.doc_id: r.shard for r in h.sharded(df).collect()}
    for at in (2, 3, 4):
        values = defaultdict(set)
        for d in docs:
            values[shard[d[0]]].add(d[at])
        everything = len({d[at] for d in docs})
        assert np.mean([len(v) for v in values.values()]) < 0.6 * everything


def test_few_rows_and_none(rows):
    assert h.sharded(rows([], SCHEMA)).collect() == []
    got = h.sharded(rows([(7, "a", None, None, None, "x", 1)] * 3, SCHEMA)).collect()
    assert [(r.doc_id, r.slot) for r in got] == [(7, 0)] * 3 and len({r.shard for r in got}) == 3


def test_written_shards(spark, rows, tmp_path):
    docs = documents()
    rows([(*d, "x", 1) for d in docs], SCHEMA).write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    h.write_shards(df, str(tmp_path / "out"), files=2)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars, r.cell) for r in out.collect()) == Counter((*d, 1) for d in docs)
    want = {r.shard: r for r in h.sharded(df).groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).collect()}
    zones = {r.shard: r for r in h.zone_map(out).collect()}
    assert {k: r.rows for k, r in zones.items()} == {k: r.rows for k, r in want.items()}
    assert sum(r.lang_least is not None and r.lang_least <= "fr" <= r.lang_most for r in zones.values()) < 16
