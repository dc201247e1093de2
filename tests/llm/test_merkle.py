"""Merkle manifest: bitmaps and ranks by sets, trees and proofs by a plain recursion."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabmill.llm import merkle as m

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot string, root int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc, add=0):
    doc_id, text, lang, source, n_chars = doc
    cells = [doc_id, source, lang, None if n_chars is None else n_chars + add, text]
    return H(*["-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells])


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain(docs):
    """Rows (doc_id, leaf, subroot, root, proof, folded, verified), leaves of one id by digest."""
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append(d)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for rows in groups.values():
        rows.sort(key=lambda d: (d[0] is not None, d[0] or 0, plain_leaf(d)))
    trees = {x: plain_levels([plain_leaf(d) for d in groups[x]]) for x in langs}
    over = plain_levels([trees[x][-1][0] for x in langs])
    out = []
    for place, x in enumerate(langs):
        for slot, d in enumerate(groups[x]):
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 and d[4] is not None
            node, seen = plain_leaf(d, int(hit)), []
            for levels, at in ((trees[x], slot), (over, place)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    seen.append(other)
                    node = H(other, node) if at & 1 else H(node, other)
                    at >>= 1
            out.append((d[0], plain_leaf(d), trees[x][-1][0], over[-1][0], H(*seen), node, node == over[-1][0]))
    return Counter(out)


def got(df, levels):
    return Counter(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in m.manifest(df, levels).collect())


def documents():
    rng = np.random.default_rng(3)
    ids = [*range(-40, 60), *rng.integers(-(1 << 62), 1 << 62, 60).tolist(), *rng.integers(0, 200_000, 60).tolist()]
    docs = [(int(i), f"text {i} é", ["en", "de", None, "", "Zz", "ü"][k % 6], [None, "web", "https://x"][k % 3], None if k % 5 == 0 else k) for k, i in enumerate(ids)]
    docs += [(7, f"other {k}", "en", "web", k) for k in range(25)] + [(7, "same", "en", "web", 4)] * 30
    docs += [(None, "none", "en", None, 1)] * 3 + [(None, None, None, None, None)] * 2 + [(9, "alone", "lonely", "web", 5), (11, "x" * 300_000, "de", "web", 300_000), (12, "", "de", "", 0)]
    return docs


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_equal_to_plain_trees(rows, levels):
    docs = documents()
    df = rows([(*d, "slot", 1) for d in docs], SCHEMA).repartition(7)
    assert got(df, levels) == plain(docs)


def test_single_row_and_empty_table(rows):
    doc = (3, "t", "en", "s", 1)
    only = got(rows([(*doc, "", 0)], SCHEMA), 10)
    assert only == plain([doc]) and next(iter(only))[1] == next(iter(only))[3]
    assert not got(rows([], SCHEMA), 10)


def test_a_changed_row_is_found(rows):
    docs = [(i, "t", "en", "s", 1) for i in range(300)]
    found = m.manifest(rows([(*d, "", 0) for d in docs], SCHEMA)).collect()
    changed = {i for i in range(300) if zlib.crc32(str(i).encode()) % 7 == 0}
    assert {r.doc_id for r in found if not r.verified} == changed
    assert all(m.fold(r.leaf, r.path) == r.root for r in found) and sorted(r.slot for r in found) == list(range(300))


@given(st.sets(st.integers(0, 65535), max_size=300), st.booleans())
@settings(max_examples=40, deadline=None)
def test_bitmaps_and_ranks(few, many):
    ids = sorted(few | set(range(0, 65536, 7))) if many else sorted(few)
    data = m.bitmap(np.array(ids, np.int64))
    assert m.members(data).tolist() == ids
    assert m.ranks(data, np.array(ids, np.int64)).tolist() == list(range(len(ids)))


def test_lists_and_bits_are_told_apart():
    for n in (m.SPARSE - 1, m.SPARSE, m.SPARSE + 1):
        ids = np.arange(n, dtype=np.int64) * 3
        assert m.members(m.bitmap(ids)).tolist() == ids.tolist()
