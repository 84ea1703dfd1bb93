"""Packing against the tokenizer itself and the least number of sequences."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, sequence_id string"


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(PATH)


def ids(slow, text):
    return np.array([*slow.encode(text or "", add_special_tokens=False).ids, packing.END], "<u4")


def check(rows, docs, slow, limit=1024):
    """Pieces, digests and places of every document; the number of sequences."""
    want = defaultdict(list)
    for doc, text in docs:
        all_ids = ids(slow, text)
        at = 0
        for piece, size in enumerate([len(all_ids) % limit] * (len(all_ids) % limit > 0) + [limit] * (len(all_ids) // limit)):
            want[doc].append((piece, at, size, zlib.crc32(all_ids[at : at + size].tobytes())))
            at += size
    got = defaultdict(list)
    held = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        held[r.sequence_id].append((r.offset, r.length))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in want.items()}
    for parts in held.values():
        parts.sort()
        ends = np.cumsum([n for _, n in parts])
        assert [o for o, _ in parts] == [0, *ends[:-1]] and ends[-1] <= limit
    return len(held)


def test_whole_table_is_packed_tightly(spark, small, slow):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    used = check(queries.op11_packing(spark, small).collect(), docs, slow)
    least = -(-sum(len(ids(slow, t)) for _, t in docs) // 1024)
    assert used <= 1.01 * least + 1


def test_odd_texts(spark, slow):
    texts = [None, "", " ", "<|endoftext|> a<|endoftext|>", " " * 40_000 + "x", "\n" * 20_000, "z" * 30_000, "é好🙂 ١٢ it's    x", "a\x00b", "same", "same"]
    docs = [(i if i < 9 else None, t) for i, t in enumerate(texts)]
    out = packing.packed(spark.createDataFrame([(*d, "x") for d in docs], SCHEMA))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(out.collect(), docs, slow)
    assert packing.packed(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_both_vocabularies_give_the_same_ids(text):
    slow = Tokenizer.from_file(PATH) if not hasattr(test_both_vocabularies_give_the_same_ids, "slow") else test_both_vocabularies_give_the_same_ids.slow
    test_both_vocabularies_give_the_same_ids.slow = slow
    assert packing.encoder(PATH)(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def sum_of_squares(bins, limit):
    gaps = np.bincount([limit - sum(b) for b in bins], minlength=limit + 1)
    return int((gaps[1:limit] ** 2).sum())


def test_every_placement_has_the_smallest_sum_of_squares():
    rng = np.random.default_rng(3)
    lengths, limit, bins = rng.integers(1, 24, 200), 24, []
    chosen = packing.squares(lengths, limit, True)
    for size, to in zip(lengths.tolist(), chosen.tolist()):
        options = []
        for i in [*(i for i, b in enumerate(bins) if sum(b) + size <= limit), len(bins)]:
            after = [*map(list, bins), []]
            after[i].append(size)
            options.append(sum_of_squares([b for b in after if b], limit))
        if to == len(bins):
            bins.append([])
        bins[to].append(size)
        assert sum_of_squares(bins, limit) == min(options)


def test_many_shards_and_lengths_without_a_place(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 500)
    pieces = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(90)) + 1).cast("long").alias("length"), "id")
    odd = spark.createDataFrame([(None, -1), (0, -2), (101, -3), (100, -4)], "length long, id long")
    rows = packing.place(pieces.union(odd), 100).collect()
    held = defaultdict(list)
    for r in rows:
        assert (r.sequence_id is None) == (r.id in (-1, -2, -3))
        held[r.sequence_id].append((r.offset, r.length, r.id))
    held.pop(None)
    assert len(rows) == 6004
    for parts in held.values():
        parts.sort()
        assert [o for o, *_ in parts] == [0, *np.cumsum([n for _, n, _ in parts])[:-1]]
    assert len(held) <= 1.02 * -(-sum(n for p in held.values() for _, n, _ in p) // 100)


def test_sequences_hold_the_tokens(spark, small, slow):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(30)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = defaultdict(dict)
    rows = packing.sequences(packing.place(packing.cut(docs))).collect()
    for r in rows:
        all_ids = np.frombuffer(r.ids, "<u4")
        assert len(all_ids) <= 1024
        for doc, a, b in zip(r.doc_ids, r.starts, [*r.starts[1:], len(all_ids)]):
            got[doc].setdefault("parts", []).append(all_ids[a:b])
    assert set(got) == set(texts)
    assert all(sorted(np.concatenate(got[d]["parts"])) == sorted(ids(slow, t)) for d, t in texts.items())
