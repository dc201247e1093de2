"""The pipeline against its stages in plain Python, on the smallest tables."""

from collections import Counter

import duckdb
import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tabmill.llm import packing, robust_rules, secret_scan
from llm.test_robust_rules import slow_counts, slow_distances, slow_vector
from llm.test_simhash import slow_components, slow_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_run_against_plain_python(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
    distance = slow_distances(np.array([slow_vector(t) for _, t in docs]))
    good = []
    for (doc, text), d in zip(docs, distance):
        n = slow_counts(text)
        if n[0] >= 50 and 100 * n[4] <= 50 * n[0] and d <= robust_rules.CUTOFF:
            good.append((doc, text))
    label = slow_components([(doc, slow_fingerprint(text)) for doc, text in good])
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for doc, text in good:
        if label[doc] == doc:
            n = 1 + len(tokenizer.encode(secret_scan.masked(text, secret_scan.spans(text)), add_special_tokens=False).ids)
            for k, start in enumerate(range(0, n, 4096)):
                want[doc, k, start, min(4096, n - start)] += 1
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == want
    assert 0 < len(good) < len(docs)


def test_stages_take_odd_rows(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, fp int"
    odd = [(None, None, None, None, None, None, None), (1, "", "en", "a", 0, "r", 1), (1, "", "en", "a", 0, "r", 1), (2, 'w token = "04dbebab91ab85687d33" z', "en", "a", 9, "r", 1)]
    for docs in (rows(odd, schema), rows([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
    kept = corpus_pipeline.near_dedup(spark, rows(odd, schema), FOLDER).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2]
