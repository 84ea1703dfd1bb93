"""Passages of just over 50 words that documents of the pipeline share."""

import numpy as np

import corpus_pipeline
from riskloom.llm import spans, suffix_dedup
from test_corpus_queries import suffix_reference


def test_shared_passages_of_51_to_65_words_go(spark):
    rng = np.random.default_rng(9)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 5))
    rows, planted = [], []
    for n in range(51, 66):
        passage = " ".join(word() for _ in range(n))
        assert 230 <= len(passage) < 400
        planted.append(passage)
        for _ in range(3):
            own = [word() for _ in range(120)]
            rows.append((len(rows), " ".join([*own[:60], passage, *own[60:]])))
    rows.append((len(rows), " ".join(word() for _ in range(300))))
    out = {r.doc_id: r.text for r in corpus_pipeline.substring_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert not any(p in t for p in planted for t in out.values())
    want = suffix_reference([t.encode() for _, t in rows], corpus_pipeline.PASSAGE)
    assert [len(out[d]) for d, _ in rows] == [size - gone for size, gone, _, _ in want]


def test_op8_keeps_its_length(spark):
    text = "".join(chr(97 + c) for c in np.random.default_rng(2).integers(0, 26, 399))
    df = spark.createDataFrame([(1, "A" + text), (2, "B" + text)], "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup.drop_repeats(df).collect()] == [0, 0]


def test_ranges_of_many_documents_merge_like_those_of_each():
    rng = np.random.default_rng(4)
    doc, key, s = rng.integers(-3, 3, 300), rng.integers(-2, 2, 300), rng.integers(0, 500, 300)
    e = s + rng.integers(1, 9, 300)
    got = {}
    for d, k, a, b in spans.by_place(doc, key, s, e).T.tolist():
        got.setdefault((d, k), []).append((a, b))
    for d, k in set(zip(doc.tolist(), key.tolist())):
        own = (doc == d) & (key == k)
        assert got.pop((d, k)) == list(zip(*(v.tolist() for v in spans.merge(s[own], e[own]))))
    assert not got and spans.by_place(*np.zeros((4, 0), np.int64)).shape == (4, 0)
