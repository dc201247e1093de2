"""Quality rules against plain Python: counts from sets, estimates from numpy."""

import re
from collections import Counter

import numpy as np
import pytest

from tabmill.llm import robust_rules as rules

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, _rules int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + s for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for s in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines), sum(c.isupper() for c in text)


def slow_vector(text):
    n, chars, symbols, dups, repeats, lines, upper = slow_counts(text)
    c = max(chars, 1)
    v = [np.log(c / max(n, 1)), np.log1p(50 * symbols / c), np.log1p(2 * dups / (max(lines, 1) + 8)), np.log1p(2 * repeats / (max(n, 1) + 80)), np.log((upper + 4) / (c + 160))]
    return [np.floor(rules.GRID * x + 0.5) for x in v]


def slow_distances(x):
    least = (rules.FLOOR * rules.GRID) ** 2
    mean = np.median(x, 0)
    inverse = np.diag(1 / ((1.4826 * np.median(abs(x - mean), 0)) ** 2 + least))
    scale = 1.0
    for _ in range(rules.STEPS):
        d = np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean)
        bins = np.floor(rules.BINS * np.log2(1 + d))
        reached = lambda share: np.sort(bins)[int(np.ceil(share * len(x))) - 1]
        scale = max(1.0, (2 ** ((reached(0.5) + 1) / rules.BINS) - 1) / rules.HALF_CHI2)
        chosen = x[bins <= reached(rules.KEPT_SHARE)]
        mean = chosen.mean(0)
        inverse = np.linalg.inv(chosen.T @ chosen / len(chosen) - np.outer(mean, mean) + least * np.eye(len(mean)))
    return np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean) / scale


def prose(rng, n):
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]).capitalize() for i in range(0, n, 12))


@pytest.fixture(scope="module")
def docs():
    rng = np.random.default_rng(3)
    out = [(i, prose(rng, int(rng.integers(60, 400))), "en", "a") for i in range(150)]
    out += [(200 + i, prose(rng, 150).upper(), "en", "a") for i in range(8)]
    out += [(220 + i, re.sub(r"\w+", lambda m: m[0] + "$$%", prose(rng, 150)), "en", "a") for i in range(8)]
    out += [(300, None, None, None), (301, "", "en", None), (302, " \t\n", "", "a"), (303, "one two three", "de", "b"), (304, "a b c " * 60, "en", "a")]
    out += [(305, "x y z w x y z", "en", "a"), (None, prose(rng, 80), "en", "a"), (306, prose(rng, 30000), "en", "a")]
    return out + out[:2]


def test_counts_and_verdicts(rows, docs, monkeypatch):
    got = {r.doc_id: r for r in rules.verdicts(rows([(*d, "x", 1) for d in docs], SCHEMA)).collect()}
    x = np.array([slow_vector(t) for _, t, _, _ in docs])
    for (doc_id, text, _, _), distance in zip(docs, slow_distances(x)):
        r, want = got[doc_id], slow_counts(text)
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (*want[:5], failed)
        assert r.distance == pytest.approx(distance, rel=1e-6)
        assert r.kept == (not failed and distance <= rules.CUTOFF)
    assert all(got[i].kept for i in range(150)) and got[306].kept
    assert not any(got[i].kept for i in [*range(200, 208), *range(220, 228)])


def test_pools_by_language_and_source(rows, docs, monkeypatch):
    monkeypatch.setattr(rules, "MIN_POOL", 40)
    many = [(i, t, "en" if i % 3 else "fr", f"s{i % 4}") for i, (_, t, _, _) in enumerate(docs[:150])]
    got = {r.doc_id: r.distance for r in rules.verdicts(rows([(*d, "x", 1) for d in many], SCHEMA)).collect()}
    pools = {}
    for i, t, lang, source in many:
        n = sum((a[2], a[3]) == (lang, source) for a in many)
        rest = sum(a[2] == lang for a in many if sum((b[2], b[3]) == (a[2], a[3]) for b in many) < 40)
        pools.setdefault((lang, source) if n >= 40 else (lang,) if rest >= 40 else (), []).append((i, slow_vector(t)))
    assert len(pools) > 1
    for members in pools.values():
        for (i, _), d in zip(members, slow_distances(np.array([v for _, v in members]))):
            assert got[i] == pytest.approx(d, rel=1e-6)


def test_empty_table_and_few_rows(rows, docs):
    assert rules.verdicts(rows([], SCHEMA)).collect() == []
    assert rules.keep_good(rows([], SCHEMA)).collect() == []
    few = rules.keep_good(rows([(*docs[0], "x", 1), (*docs[0], "x", 1), (9, "too short", "en", "a", "x", 1)], SCHEMA)).collect()
    assert [tuple(r) for r in few] == [(*docs[0], "x", 1)] * 2


@pytest.mark.parametrize("share", [0.2, 1 / 3, 0.45])
def test_alike_bad_copies_do_not_pass(rows, docs, share):
    good, n = docs[:150], round(150 * share / (1 - share))
    exact = re.sub(r"\w+", lambda m: m[0] + "$$%", docs[0][1])
    bad = [(1000 + i, exact if i % 2 else f"{exact} tail{i}", "en", "a") for i in range(n)]
    got = {r.doc_id: r.kept for r in rules.verdicts(rows([(*d, "x", 1) for d in good + bad], SCHEMA)).collect()}
    assert all(got[d[0]] for d in good) and not any(got[d[0]] for d in bad)
