"""N-best segmentation against all segmentations of short texts, and exact round trips."""

import re
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from tabmill.llm import nbest_pieces as nb

SCHEMA = "doc_id long, text string, score string, ids int"
TEXTS = [None, "", " ", "a", "the  theatre", "  lead\n\ttrail  ", "é中🎉\x00x", "naïve Ænigma", "of the people" * 300, "q" * 2000, "퟿"]


def small(extra=()):
    pieces = [("<unk>", 0.0), ("▁", -6.0), ("a", -4.0), ("b", -5.0), ("ab", -7.0), ("ba", -6.5), ("▁a", -7.0), ("aba", -12.0), ("▁ab", -10.5), *extra]
    return nb.Vocabulary(pieces, None)


def all_scores(v, text):
    """Scores of every segmentation, best first."""
    def walk(at):
        if at == len(text):
            return [(0.0, ())]
        out = []
        for j in range(at + 1, len(text) + 1):
            if text[at:j] in v.known:
                number, score = v.known[text[at:j]]
                out += [(score + s, (number, *ids)) for s, ids in walk(j)]
            elif j == at + 1:
                out += [(v.fallback + s, (v.unknown, *ids)) for s, ids in walk(j)]
        return out

    return sorted(walk(0), key=lambda x: -x[0])


@settings(max_examples=80, deadline=None)
@given(st.text("ab x", max_size=9), st.integers(1, 6), st.booleans())
def test_against_all_segmentations(text, n, crossing):
    v = small([("a▁", -7.5)] if crossing else [])
    assert v.by_word is not crossing
    want, got = all_scores(v, v.normal(text)), v.segmentations(text, n)
    assert [s for s, _ in got] == pytest.approx([s for s, _ in want[:n]])
    every = {ids: s for s, ids in want}
    assert len({tuple(ids.tolist()) for _, ids in got}) == len(got)
    assert all(every[tuple(ids.tolist())] == pytest.approx(s) for s, ids in got)


def test_real_vocabulary(rows):
    sp = SentencePieceProcessor(model_file=nb.vocabulary_path())
    v = nb.vocabulary(nb.vocabulary_path())
    docs = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "x", 1)]
    got = nb.encoded(rows(docs, SCHEMA), with_ids=True).collect()
    assert len(got) == len(docs)
    for r in got:
        text = TEXTS[r.doc_id] or ""
        assert v.normal(text) == sp.normalize(text)
        assert r.same and r.decoded_crc32 == zlib.crc32(text.encode())
        assert r.score == r.scores[0] and r.n_pieces == len(r.ids[0]) and all(a >= b for a, b in pairwise(r.scores))
        assert r.crcs == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in r.ids] and len({tuple(x) for x in r.ids}) == len(r.ids)
        for score, ids in zip(r.scores, r.ids):
            assert v.decode(np.array(ids)) == text and sp.decode(ids) == text
            bytes_ = sum(i in v.byte_of for i in ids)
            if not bytes_:
                assert score == sum(sp.get_score(i) for i in ids)
        # The best is at least as good as the segmentation that merges give.
        merged = sp.encode(text)
        if not any(i in v.byte_of for i in merged):
            assert r.score >= sum(sp.get_score(i) for i in merged)


def test_words_and_whole_text_agree():
    v = nb.vocabulary(nb.vocabulary_path())
    for text in ("ten cats ate  the end", "éé x\ny z"):
        assert [s for s, _ in v.segmentations(text, 6)] == [s for s, _ in v.n_best(v.normal(text), 6)]


def test_decoding_table_and_empty_table(rows):
    assert nb.encoded(rows([], SCHEMA)).collect() == []
    df = nb.encoded(rows([(1, "some text here", "x", 1), (2, None, "x", 1)], SCHEMA), with_ids=True).selectExpr("doc_id", "ids[0] as ids", "doc_id as other")
    assert sorted(map(tuple, nb.decoded(df).collect())) == [(1, 1, "some text here"), (2, 2, "")]
    assert nb.decoded(rows([(3, None)], "doc_id long, ids array<int>")).first().text is None


def test_words_together_and_alone():
    v, alone = nb.Vocabulary.load(nb.vocabulary_path()), nb.vocabulary(nb.vocabulary_path())
    rng = np.random.default_rng(1)
    words = ["▁" * int(rng.integers(0, 3)) + "".join(rng.choice(list("thernoaiséß.,!&9中\u4e9c"), int(rng.integers(1, 14)))) for _ in range(3000)]
    v.learn([words])
    for word in words:
        number, found = v.words[word], alone.n_best(word, 2)
        assert v.score[number] == found[0][0]
        assert v.loss[number] == (found[0][0] - found[1][0] if len(found) > 1 else float("inf"))
        assert v.decode(np.frombuffer(v.ids[number], np.uint32)) == word.replace("▁", " ").removeprefix(" ")


def test_table_stays_small(monkeypatch):
    monkeypatch.setattr(nb, "CACHED_WORDS", 3)
    v, fresh = nb.Vocabulary.load(nb.vocabulary_path()), nb.vocabulary(nb.vocabulary_path())
    for text in ("one two three four five", "one six", "two one", "seven one eight nine"):
        assert [s for s, _ in v.segmentations(text)] == [s for s, _ in fresh.segmentations(text)]
        assert len(v.words) <= 8 and v.size <= 16


def test_only_beginnings_of_pieces_are_followed(monkeypatch):
    v, steps, plain = nb.Vocabulary.load(nb.vocabulary_path()), [], nb._step
    monkeypatch.setattr(nb, "_step", lambda key, points: steps.append(len(key)) or plain(key, points))
    rng = np.random.default_rng(2)
    words = ["▁" + "".join(rng.choice(list("qzxjkvwy"), 23)) for _ in range(1000)]
    v.learn([words])
    # Each character begins strings of up to 16 characters; few of these go on to a piece.
    assert sum(steps) < 4 * 24 * len(words)
    assert len(steps) <= v.longest


def test_characters_that_only_longer_pieces_have():
    v = small([("xy", -3.0)])
    for word in ("▁xy", "xy", "▁axya"):
        v.learn([[word]])
        best, second = (s for s, _ in v.n_best(word, 2))
        assert v.loss[v.words[word]] == best - second


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab é\n▁🎉\t", max_size=9), max_size=5))
def test_words_of_many_texts(texts):
    v = small()
    words, which, ends = v._cut(texts)
    got = [[words[k] for k in which[a:b]] for a, b in pairwise([0, *ends.tolist()])]
    assert got == [re.findall("▁*[^▁\n]+|▁+|\n+", v.normal(t)) for t in texts]
    assert len(set(words)) == len(words)
    each = [v.segmentations(t, 3) for t in texts]
    assert [[(s, x.tolist()) for s, x in found] for found in v.segmented(texts, 3)] == [[(s, x.tolist()) for s, x in found] for found in each]


def test_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(nb, "ROWS", 3)
    monkeypatch.setattr(nb, "BYTES", 10)
    texts = ["a", None, "", "b", "x" * 30, "é" * 5, "c", "d" * 10]
    parts = list(nb._parts(pa.record_batch([pa.array(range(8)), pa.array(texts)], ["doc_id", "text"])))
    assert [p.column(1).to_pylist() for p in parts] == [texts[:3], texts[3:4], texts[4:5], texts[5:6], texts[6:7], texts[7:]]
    assert not list(nb._parts(pa.record_batch([pa.array([], pa.int64()), pa.array([], pa.string())], ["doc_id", "text"])))
