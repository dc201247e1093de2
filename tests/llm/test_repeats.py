"""Repeated passages: every window of every document compared in plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabmill.llm import repeats as r

SCHEMA = "doc_id long, text string, n_words int, block string"


def plain(docs):
    """Counter of (doc_id, n_words, n_removed, sha, repeats)."""
    words = [(i, (t or "").encode().split()) for i, t in docs]
    least = defaultdict(lambda: None)
    for i, w in words:
        if i is not None:
            for k in range(len(w) - 12):
                key = tuple(w[k : k + 13])
                least[key] = i if least[key] is None else min(i, least[key])
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 12 if i is not None else 0):
            if least[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        runs = [k for k in range(len(w) + 1) if (k < len(w) and gone[k]) != (k > 0 and gone[k - 1])]
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), tuple(zip(runs[::2], runs[1::2]))))
    return Counter(out)


def got(df, **options):
    return Counter(
        (x.doc_id, x.n_words, x.n_removed, hashlib.sha256(x.kept.encode()).hexdigest(), tuple((y.start, y.end) for y in x.repeats))
        for x in r.without_repeats(df, **options).collect())


def prose(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents():
    """Texts of few words, passages in many contexts, near copies, equal ids, and texts without words."""
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.randrange(0, 120), rng.choice([2, 5, 400]))) for i in range(-20, 60)]
    passage, short, edge = prose(rng, 70, 400), prose(rng, 13, 400), prose(rng, 12, 400)
    docs += [(100 + i, f"{prose(rng, 20, 400)} {passage if i % 3 else passage[:200]} {prose(rng, 9, 400)}") for i in range(40)]
    docs += [(200 + i, f"{prose(rng, 3, 400)}\t{short}\n\n{prose(rng, 4, 400)} {edge} {i}") for i in range(40)]
    docs += [(300 + i, " ".join(w for k, w in enumerate(passage.split()) if k != i)) for i in range(25)]
    docs += [(400, passage), (400, passage), (400, f"x {passage} y"), (None, passage), (None, None), (401, None), (402, ""), (403, " \n\t"), (404, passage + " é ü " + passage)]
    docs += [(500 + i, "a b a b " * 30) for i in range(3)] + [(600, prose(rng, 40_000, 9000)), (601, "x" * 3_000_000 + " " + passage)]
    return docs


@pytest.mark.parametrize("options", [{}, {"block_bytes": 2000, "range_bytes": 9000, "group_bytes": 1}, {"block_bytes": 1, "group_bytes": 5000}])
def test_equal_to_all_windows(rows, options):
    docs = documents()
    df = rows([(i, t, 1, "x") for i, t in docs], SCHEMA).repartition(3)
    assert got(df, **options) == plain(docs)


def test_anchors_with_many_spans_in_some_blocks(rows):
    rng = random.Random(9)
    core = prose(rng, 11, 900)
    docs = [(k, f"{prose(rng, 6, 3)} {core} {prose(rng, 6, 3)}") for k in range(400)]
    df = rows([(i, t, 1, "x") for i, t in docs], SCHEMA).repartition(4)
    assert got(df, block_bytes=3000) == plain(docs) == got(df, block_bytes=100, group_bytes=2000)


def test_empty_table(rows):
    assert not got(rows([], SCHEMA)) and got(rows([(1, "a b", 1, "")], SCHEMA)) == plain([(1, "a b")])


@given(st.lists(st.text(alphabet="ab é\n\t ", max_size=40), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_equal_words_have_equal_hashes(texts):
    data = [t.encode() for t in texts]
    starts, lanes = r.word_hashes(b" ".join(data))
    words = b" ".join(data).split()
    assert len(starts) == len(words)
    for lane in lanes:
        assert len(set(zip(words, lane.tolist()))) == len(set(words)) == len(set(lane.tolist()))


def test_entries_survive_packing():
    rng = np.random.default_rng(1)
    values = {n: rng.integers(0, 200, 1000).astype(r._ENTRY[n]) for n in r._ENTRY.names}
    values["a"] = np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    for n in (1000, 1, 0):
        back = r._unpacked(r._packed({k: x[:n] for k, x in values.items()}, r._ENTRY), r._ENTRY)
        assert all((back[k] == x[:n]).all() and back[k].dtype == x.dtype for k, x in values.items())
