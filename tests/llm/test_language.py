import zlib

import numpy as np
import pytest

from screenmeld.llm import language as L
from screenmeld.llm.queries import QUERIES


def chain(scores, trans):
    n, k = scores.shape
    emit, step = np.exp(scores), np.exp(trans)
    a, b = np.zeros((n, k)), np.ones((n, k))
    a[0] = emit[0]
    for t in range(1, n):
        a[t] = (a[t - 1] @ step) * emit[t]
    for t in range(n - 2, -1, -1):
        b[t] = step @ (emit[t + 1] * b[t + 1])
    return a * b / (a * b).sum(axis=1, keepdims=True), a, b, emit, step


@pytest.mark.parametrize("n", [1, 2, 9, 50])
def test_marginals_equal_plain_forward_backward(n):
    rng = np.random.default_rng(n)
    scores, trans = rng.normal(size=(n, 3)) * 2, rng.normal(size=(3, 3))
    cuts = sorted({0, *rng.integers(0, n, 3).tolist()})
    first = np.zeros(n, bool)
    first[cuts] = True
    gamma, pairs = L.marginals(scores, first, trans, pairs=True)
    expected = np.zeros((3, 3))
    for a, b in zip(cuts, [*cuts[1:], n]):
        want, alpha, beta, emit, step = chain(scores[a:b], trans)
        assert np.allclose(gamma[a:b], want)
        for t in range(b - a - 1):
            xi = alpha[t][:, None] * step * (emit[t + 1] * beta[t + 1])[None, :]
            expected += xi / xi.sum()
    assert np.allclose(pairs, expected)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op3_language_crf"](spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switched_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.train(docs)
    parts = [(lang, next(r.text for r in docs.filter(f"lang = '{lang}' AND n_chars > 800").orderBy("doc_id").collect()).split()[:40])
             for lang in ("de", "en", "fr")]
    text = [w.encode() for _, words in parts for w in words]
    best = [model.labels[k] for k in model.word_marginals([text])[0].argmax(axis=1)]
    right = np.mean([a == b for a, b in zip(best, [lang for lang, words in parts for _ in words])])
    assert right > 0.9
    assert model.documents([text, [], [b"12"]])[1:] == [("und", 0.0, 0, 0), ("und", 0.0, 1, 0)]


def test_odd_rows(odd, empty):
    rows = L.language_id(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (1, 2, 3, 8))
    assert L.language_id(empty).count() == 0
    kept = L.identified(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id IN (1, 2, 3, 8)").count() == 0
    assert L.language_id(odd.filter("lang IS NULL")).filter("lang_pred <> 'und'").count() == 0
