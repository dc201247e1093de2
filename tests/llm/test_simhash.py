"""SimHash near-duplicates against all pairs in plain Python."""

import re

import numpy as np
import pytest
import xxhash

from tabmill.llm import simhash
from tabmill.llm.components import Forest, connected_components

SCHEMA = "doc_id long, text string, fp string, component_id int, ones int"


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((1 << b) for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, radius=4):
    label = {d: d for d, _ in fps}
    changed = True
    while changed:
        changed = False
        for d, f in fps:
            for e, g in fps:
                if (f ^ g).bit_count() <= radius and label[d] != label[e]:
                    label[d] = label[e] = min(label[d], label[e])
                    changed = True
    return label


def texts():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ß!", "The"]
    out = [None, "", "   \t\n", "one", "one two", "ONE TWO", "one two", "a b c d", "a b c d"]
    for _ in range(12):
        words = list(rng.choice(vocabulary, 300))
        out.append(" ".join(words))
        for change in (1, 2, 8):
            near = words.copy()
            for at in rng.integers(0, 300, change):
                near[at] = "changed"
            out.append("\n".join(near))
    return out + ["x y z " * 20000]


def test_against_all_pairs(rows):
    docs = [(i * 3 % 101, t) for i, t in enumerate(texts())]
    want = [(d, slow_fingerprint(t)) for d, t in docs]
    label = slow_components(want)
    df = rows([(d, t, "x", -1, 0) for d, t in docs], SCHEMA)
    for tile in (4, 8192):
        got = sorted(tuple(r) for r in simhash.near_duplicates(df, tile_rows=tile).collect())
        assert got == sorted((d, f"{f:016x}", label[d]) for d, f in want)


def test_repeated_rows_null_ids_and_empty_table(rows):
    df = rows([(None, "a b c d e", "", 0, 0), (7, "a b c d e", "", 0, 0), (7, "a b c d e", "", 0, 0)], SCHEMA)
    assert sorted(((r.doc_id or -1), r.component_id) for r in simhash.near_duplicates(df).collect()) == [(-1, 7), (7, 7), (7, 7)]
    assert simhash.near_duplicates(rows([], SCHEMA)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components(rows, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 150, (90, 2))] + [(200 + i, 201 + i) for i in range(60)] + [(None, 3), (4, None)]
    label = {x: x for link in links for x in link if None not in link and link[0] != link[1]}
    for _ in range(200):
        for a, b in links:
            if a is not None and b is not None and a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in connected_components(rows(links, "a long, b long")).collect()}
    assert got == label


def test_forest_keeps_groups():
    forest = Forest(8)
    forest.add(np.array([1, 2, 5]), np.array([2, 3, 6]))
    forest.add(np.array([3]), np.array([6]))
    assert forest.label.tolist() == [0, 1, 1, 1, 4, 1, 1, 7]
    assert [x.tolist() for x in forest.links()] == [[2, 3, 5, 6], [1, 1, 1, 1]]
