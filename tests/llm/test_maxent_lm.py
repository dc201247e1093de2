"""Language model: base scores by plain counts, probabilities that add up, and gain on held-out texts."""

import zlib
from collections import Counter
from math import exp, log, log10

import numpy as np
import pytest

from tabmill.llm import maxent_lm as m

SCHEMA = "doc_id long, text string, word string, row int"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def corpus():
    rng = np.random.default_rng(6)
    tongues = [["".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(300)] for letters in ("abcde", "vwxyz", "mnopé")]
    share = 1 / np.arange(1, 301)
    out = [(i, " ".join(rng.choice(tongues[i % 3], rng.integers(20, 120), p=share / share.sum()))) for i in range(240)]
    return [*out, (1000, None), (1001, ""), (1002, "\t The\x0bTHE the\n"), (None, "abc abc"), (1003, "q" * 5000), out[0]]


def slow_base(docs):
    counts, lists = Counter(), [[w.lower() for w in (t or "").encode().split()] + [b""] for _, t in docs]
    for (doc, _), words in zip(docs, lists):
        if not held(doc):
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return n, v, counts, [(len(w), sum(counts[x] > 0 for x in w), sum(log10((counts[x] + 1) / (n + v + 1)) for x in w)) for w in lists]


def slow_score(words, model, counts):
    """log10 of the probability of a list of words, one choice at a time, in plain numbers."""
    crc = lambda w: zlib.crc32(w) % (255 * 16 * 16) if w else 255 * 16 * 16
    ids, total, cut = [65_535] * 3 + [crc(w) for w in words], 0.0, (1 << 64) - 1
    class_of = [int(c) for c in model.classes]
    size = Counter()
    for w, c in counts.items():
        size[class_of[crc(w) // 16]] += c + 1
    for i, w in enumerate(words):
        three, two, one, this = ids[i : i + 4]
        to = class_of[this // 16]
        for level, (node, outcome) in enumerate([(0, to // 16), (1 + to // 16, to % 16)]):
            scores = [float(x) for x in model.base[node]]
            for kind, value in enumerate([one, two, three, one << 16 | two]):
                x = ((value + (kind << 40)) * 0x9E3779B97F4A7C15 + node * 0xC2B2AE3D27D4EB4F) & cut
                x = ((x ^ x >> 32) * 0x9E3779B97F4A7C15) & cut
                row = model.weights[level * 65536 + (x >> 48)]
                scores = [a + float(b) for a, b in zip(scores, row)]
            total += scores[outcome] / log(10) - log10(sum(exp(x) for x in scores))
        total += log10((counts[w] + 1) / (size[to] + 1))
    return total


def test_scores(rows, monkeypatch):
    monkeypatch.setattr(m, "FREQUENT", 50)
    docs = corpus()
    n, v, counts, want = slow_base(docs)
    df = rows([(*d, "x", 1) for d in docs], SCHEMA)
    fitted = m.fit(df)
    got = m.score(df, fitted).collect()
    assert {r.train_tokens for r in got} == {n} and (fitted.tokens, fitted.types) == (n, v)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    got = sorted(got, key=lambda r: key((r.doc_id, r.n_tokens)))
    expected = sorted(((d, *w, t) for (d, t), w in zip(docs, want)), key=key)
    model = fitted.model
    for r, (doc, tokens, known, base, text) in zip(got, expected, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known) == (doc, held(doc), tokens, known)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        words = [w.lower() for w in (text or "").encode().split()] + [b""]
        assert r.score == pytest.approx(slow_score(words, model, counts), rel=1e-4)
    # All words of a history, with one unknown word of each class, add up to one.
    inside = np.zeros(m.CLASSES)
    for w, c in counts.items():
        inside[model.classes[m.word_id(w) // m.DETAIL]] += c + 1
    assert np.allclose((inside + 1) / 10**model.share, 1)
    history, every = m.feature_hashes(np.array([5, 77, 900, m.END_ID])), np.arange(m.CLASSES)
    nodes, outcomes = m.choices(every)
    for h in history:
        weights_on = m.weight_rows(np.repeat(h[None], m.CLASSES, 0), nodes).reshape(-1, m.FEATURES)
        logs = m.log_probabilities(model.base, model.weights, nodes.ravel(), weights_on, outcomes.ravel())
        assert np.exp(logs.reshape(-1, m.LEVELS).sum(1)).sum() == pytest.approx(1, abs=1e-4)
    gain = [(r.score - r.base_score) / r.n_tokens for r in got if r.held_out and r.n_tokens > 10]
    assert len(gain) > 20 and np.mean(gain) > 0.1


def test_scores_do_not_depend_on_the_cluster(rows, monkeypatch):
    monkeypatch.setattr(m, "PART_TOKENS", 2000)
    df = rows([(*d, "x", 1) for d in corpus()], SCHEMA)
    few, many = ({(r.doc_id, r.n_tokens): r.score for r in m.scored(df.repartition(n, "text")).collect()} for n in (1, 7))
    assert few == pytest.approx(many, rel=1e-9)


def test_buckets_agree(rows):
    from pyspark.sql import functions as F

    words = ["", "a", "abcd", "abcde", "éé", "ééé", "x" * 100]
    df = rows([(w,) for w in words], "w string").select("w", m.bucket_column(F.encode("w", "UTF-8")).alias("b"))
    assert {r.w: r.b for r in df.collect()} == {w: m.word_id(w.encode()) // m.DETAIL for w in words}


def test_class_tree_puts_alike_buckets_together():
    rng = np.random.default_rng(1)
    kind = rng.integers(0, 2, m.BUCKETS)
    beside = rng.poisson(np.where(np.arange(128)[None] % 2 == kind[:, None], 20, 1))
    classes = m.class_tree(beside, np.full(m.BUCKETS, 10))
    assert classes[-1] == m.CLASSES - 1 and set(np.bincount(classes)) == {1, m.MEMBERS}
    mixed = [len(set(kind[classes[:-1] == c])) > 1 for c in range(m.CLASSES - 1)]
    assert sum(mixed) <= 1 + abs(kind.sum() - m.BUCKETS // 2) // m.MEMBERS


@pytest.mark.parametrize("times", [1, 3, 40])
def test_updates_follow_the_gradient(times):
    ids = np.tile(np.repeat([1, 2, 1, 2, 3], m.DETAIL) * m.DETAIL, times)
    classes = np.arange(m.BUCKETS + 1) % m.CLASSES
    base, weights = m.reference(np.ones(m.CLASSES)), np.zeros((m.ROWS, m.WAYS), np.float32)
    nodes, outcomes = m.choices(classes[ids // m.DETAIL])
    on = m.weight_rows(m.feature_hashes(ids), nodes)
    # One step against a plain sum over tokens.
    trainer = m.Trainer(base, weights.copy())
    trainer.update(nodes.ravel(), on.reshape(-1, m.FEATURES), outcomes.ravel())
    gradient = np.zeros((m.ROWS, m.WAYS))
    for node, rows_on, outcome in zip(nodes.ravel(), on.reshape(-1, m.FEATURES), outcomes.ravel()):
        error = np.exp(base[node].astype(float)) / np.exp(base[node].astype(float)).sum()
        error[outcome] -= 1
        for r in rows_on:
            gradient[r] += error
    step = m.RATE * gradient / np.sqrt(1e-3 + (gradient**2).sum(1, keepdims=True) / m.WAYS)
    assert np.allclose(trainer.weights, -step, atol=1e-5)
    assert trainer.touched.sum() == len(ids) * m.LEVELS * m.FEATURES
    loss = lambda: -m.log_probabilities(base, trainer.weights, nodes.ravel(), on.reshape(-1, m.FEATURES), outcomes.ravel()).mean()
    seen = [loss()]
    for _ in range(20):
        trainer.learn([ids], classes)
        seen.append(loss())
    assert seen[-1] < seen[5] < seen[0]


def test_empty_table_and_no_training(rows):
    assert m.scored(rows([], SCHEMA)).collect() == []
    only = next(i for i in range(100) if held(i))
    r = m.scored(rows([(only, "a b", "x", 1)], SCHEMA)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)
    assert r.score == pytest.approx(3 * log10(1 / m.CLASSES), rel=1e-4)
