"""Phrases against counting everything in plain Python."""

import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm import collocations as C, queries


def brute(rows, least, top):
    count, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(ws)
            for k in range(1, 6):
                for i in range(len(ws) - k + 1):
                    count[lang, tuple(ws[i : i + k])] += 1
    often = {p: n for p, n in count.items() if n >= least and len(p[1]) > 1}
    covered = Counter()
    for (lang, ws), n in often.items():
        for m in range(2, len(ws)):
            for i in range(len(ws) - m + 1):
                covered[lang, ws[i : i + m]] = max(covered[lang, ws[i : i + m]], n)
    out = []
    for (lang, ws), a in often.items():
        if covered[lang, ws] >= a:
            continue
        cuts = [(1000 * a * sizes[lang] // (count[lang, ws[:k]] * count[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(ws).encode(), count[lang, ws[:k]], count[lang, ws[k:]], sizes[lang]))
    found, seen = set(), Counter()
    for lang, score, a, phrase, l, r, n in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            found.add((lang, seen[lang], phrase.decode(), -a, l, r, n, -score))
    return found


def rows_of(df):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


TEXTS = [
    ("en", "New York is big. new\tYORK is  far, New York! is\nnew york is"), (None, "a b a b; a b"), ("und", "a b"), ("en", ""), ("en", None),
    ("fr", "é à é à é à x é à"), ("de", "x\x00y z " * 40), ("en", " .,;"), ("es", "uno " * 300), ("en", "new york is big " * 7), ("en", "new york is big " * 7),
]


@pytest.mark.parametrize("sample", [1, 4, 1 << 40])
def test_phrases_are_those_of_counting_everything(spark, monkeypatch, sample):
    """Also from a sample of nothing, where every phrase comes out of border failures."""
    monkeypatch.setattr(C, "SAMPLE", sample)
    docs = spark.createDataFrame([(i, t, x, "z") for i, (x, t) in enumerate(TEXTS)], "doc_id long, text string, lang string, phrase string")
    found, sizes = C.frequent_phrases(docs, 3, 5, sample)
    counted = {(r.lang, r.phrase): r.f for r in found.collect()}
    assert found.count() == len(counted) and min(counted.values()) >= 3
    monkeypatch.setattr(C, "frequent_phrases", lambda *a: (found, sizes))
    assert rows_of(C.collocations(docs, 3, 5, 4)) == brute(TEXTS, 3, 4)


def test_table_with_lower_count(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute([(r.lang, r.text) for r in docs.collect()], 12, 2000)
    assert want and rows_of(C.collocations(docs, 12)) == want


def test_small_tables_let_strangers_pass_without_harm(spark, small, monkeypatch):
    monkeypatch.setattr(C, "MOST_BITS", 8)
    monkeypatch.setattr(C, "HELD", 1 << 10)
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 40")
    assert rows_of(C.collocations(docs, 12)) == brute([(r.lang, r.text) for r in docs.collect()], 12, 2000)


def test_rows_sent_by_name_do_not_drop_what_is_counted_by_key(monkeypatch):
    monkeypatch.setattr(C, "HELD", 16)
    tally, sums = C._Tally(), Counter()
    for turn in range(3):
        texts = C.Texts(pa.array(["a b c d e f"]), ["en"])
        places, keys = texts.words_at()
        tally.count_named(texts, 1, places[:5], keys[:5])
        tally.count(keys[5:])
        for batch in tally.batches(turn == 2):
            for r in batch.to_pylist():
                sums[r["lang"], r["phrase"], r["key"]] += r["n"]
    assert sums == {**{("en", w, None): 3 for w in "abcde"}, (None, None, int(keys[5:].view("int64")[0])): 3}


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    big = 10**15 + 7
    found = spark.createDataFrame([("en", "a", 10**13 + 1), ("en", "b", 10**12 + 3), ("en", "a b", 10**11 + 9)], "lang string, phrase string, f long")
    sizes = spark.createDataFrame([("en", big)], "lang string, n long")
    monkeypatch.setattr(C, "frequent_phrases", lambda *a: (found, sizes))
    (row,) = C.collocations(spark.range(0).select(F.lit("").alias("text"))).collect()
    assert row.score == 1000 * (10**11 + 9) * big // ((10**13 + 1) * (10**12 + 3))


def test_query_is_registered():
    assert "op12_collocations" in queries.ORACLES
