"""Packing against the tokenizer on whole texts, exhaustive packings and plain sums."""

import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabmill.llm import packing as p

TEXTS = [
    None, "", " \t\n ", "The the THE the! the, the.", "don't we'll l'été 123 45 <|endoftext|> <|ENDOFTEXT|>x", "á ́b e f g h\x1ci \x85j",
    "Σας ΣΑΣ İstanbul Å ﬁ 中文字 🎉🎉 naïve", "word " * 9000, "x" * 3000, "one two three", "one two three",
]


def unpacked(plan):
    """Lengths by sequence, with a check that offsets leave no gap and that each rank goes once."""
    sequences, ranks = defaultdict(list), defaultdict(list)
    for length, first, number, base, offset in plan.runs:
        for i in range(number):
            sequences[base + i].append((offset, length))
            ranks[length].append(first + i)
    assert sorted(sequences) == list(range(plan.sequences))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
    for got in ranks.values():
        assert sorted(got) == list(range(len(got)))
    return {k: sum(x for _, x in v) for k, v in sequences.items()}, {k: len(v) for k, v in ranks.items()}


def fewest(lengths, capacity):
    @lru_cache(None)
    def least(todo):
        if not todo:
            return 0
        rest, best, seen = todo[1:], len(todo), set()
        for mask in range(1 << len(rest)):
            inside = tuple(x for i, x in enumerate(rest) if mask >> i & 1)
            if todo[0] + sum(inside) <= capacity and inside not in seen:
                seen.add(inside)
                best = min(best, 1 + least(tuple(x for i, x in enumerate(rest) if not mask >> i & 1)))
        return best

    return least(tuple(sorted(lengths, reverse=True)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=8))
def test_small_instances(lengths):
    plan = p.plan(dict(Counter(lengths)), 12)
    filled, counts = unpacked(plan)
    assert counts == dict(Counter(lengths)) and all(x <= 12 for x in filled.values())
    best = fewest(lengths, 12)
    assert plan.bound <= best <= plan.sequences <= best + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=8))
def test_reduction_keeps_the_optimum(lengths):
    plan = p.plan(dict(Counter(lengths)), 12)
    rest = Counter(lengths)
    for length, _, number, base, _ in plan.runs:
        if base < plan.fixed:
            rest[length] -= number
    assert plan.fixed + fewest(list(rest.elements()), 12) == fewest(lengths, 12)


@pytest.mark.parametrize("seed", range(3))
def test_large_instances_are_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    counts = Counter(np.minimum(4096, rng.lognormal(6, 1.2, 20000).astype(int) + 1).tolist())
    plan = p.plan({k: v * 3 for k, v in counts.items()})
    filled, got = unpacked(plan)
    assert got == {k: v * 3 for k, v in counts.items()} and max(filled.values()) <= 4096
    assert plan.sequences <= plan.bound * 1.002 + 2


def test_pieces_and_places(rows, monkeypatch):
    monkeypatch.setattr(p, "RANK_ROWS", 3)
    tokenizer = Tokenizer.from_file(p.tokenizer_path())
    docs = [(i, t, "x", -1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x", -1), (None, "null id", "x", -1)]
    got = p.packed(rows(docs, "doc_id int, text string, row string, length int"), with_ids=True).collect()
    want = Counter()
    for doc, text, _, _ in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[doc, k, start, len(part), zlib.crc32(part.tobytes()), tuple(part.tolist())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    ends = defaultdict(list)
    for r in got:
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 4096 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    whole = p.sequences(p.packed(rows(docs, "doc_id int, text string, row string, length int"), with_ids=True)).collect()
    assert len(whole) == len(ends) and Counter(i for r in whole for i in r.ids) == Counter(i for r in got for i in r.ids)
    assert all(r.starts[0] == 0 and r.ids[s - 1] == 1 for r in whole for s in r.starts[1:])
    assert p.packed(rows([], "doc_id long, text string")).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'sStTdD!<|>&é²ªß×endoftxr019")), max_size=30), max_size=6))
def test_ids_of_any_text(texts):
    tokenizer, ids = Tokenizer.from_file(p.tokenizer_path()), p.word_ids(p.tokenizer_path())
    texts = [*texts, "it's I'LL <|endoftext|>x <|ENDOFTEXT|> x&&&y!! 12ab² ªß ÉÀ×÷"]
    for text, found in zip(texts, ids(texts)):
        assert found.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_tables_stay_small(monkeypatch):
    monkeypatch.setattr(p, "CACHED_WORDS", 5)
    ids, tokenizer = p.WordIds(p.tokenizer_path()), Tokenizer.from_file(p.tokenizer_path())
    for text in ("a b c d", "d e f g", "one two three four five six seven", "a", "a b", "g h", "one seven", "中 b", "一 二 三 四 五 六 c"):
        assert ids([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert max(len(ids.words), len(ids.older), len(ids.parts)) <= 14
