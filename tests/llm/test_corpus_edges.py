"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import chat, decontaminate, induced_sort, mixing, quality, simhash, suffix_dedup, super_kmers, token_rollup, url_filter, warc
from riskloom.llm.components import components
from riskloom.llm.induced_sort import suffix_order

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = {"words": 1, "ws": 2, "n": 3, "h": 4, "size": 5, "slot": 6, "key": 7, "fp": 8, "doc": 9, "doc_key": 10, "_spans": 11, "ts": 12, "score": 13, "cutoff": 14}
LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def docs(spark, *rows):
    df = spark.createDataFrame(list(rows), DOCS)
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()})


def mixed_rows(spark):
    same = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi " * 20).strip()
    return docs(
        spark, (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (4, "one", "en", None, 3),
        (5, same, "en", "s", 9), (5, same, "en", "s", 9), (None, same, None, "t", 9), (6, LONG, "fr", "t", 9), (7, "\x00" * 900, "fr", "t", 900),
    )


DOC_OPERATORS = {
    "super_kmers": super_kmers.drop_repeats, "suffix": suffix_dedup.drop_repeats, "mix": mixing.mix, "near": simhash.near_groups,
    "tokens": token_rollup.count_tokens, "near_stage": simhash.one_of_each, "strip": suffix_dedup.strip,
}


@pytest.mark.parametrize("name", DOC_OPERATORS)
def test_odd_documents(spark, name):
    rows = DOC_OPERATORS[name](mixed_rows(spark)).collect()
    assert name == "near_stage" or len(rows) == 9
    twice = [tuple(r) for r in rows if r.doc_id == 5]
    assert len(twice) == 2 and (name == "mix" or twice[0] == twice[1])


@pytest.mark.parametrize("name", DOC_OPERATORS)
def test_no_documents(spark, name):
    assert DOC_OPERATORS[name](docs(spark)).collect() == []


def test_a_document_given_twice_is_one(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = docs(spark, (1, text, "en", "s", 1), (1, text, "en", "s", 1))
    assert [r.n_removed for r in super_kmers.drop_repeats(df).collect()] == [0, 0]
    long = docs(spark, (1, text * 4, "en", "s", 1), (1, text * 4, "en", "s", 1)).withColumn("text", F.substring("text", 1, 399 + 60))
    assert [r.n_removed for r in suffix_dedup.drop_repeats(long).collect()] == [0, 0]


def test_ids_that_share_a_text_are_ordered_null_first(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = docs(spark, (1, text, "en", "s", 1), (None, text, "en", "s", 1), (2, text, "en", "s", 1))
    assert {r.doc_id: r.n_removed for r in super_kmers.drop_repeats(df).collect()} == {None: 0, 1: 50, 2: 50}


def test_overfull_buckets_are_dealt_anew(spark, monkeypatch):
    base = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join(base[:40] + [str(i)] * 5 + base[40:]), "en", "s", 1) for i in range(50)]
    df = docs(spark, *rows)
    want = sorted(map(tuple, super_kmers.drop_repeats(df).collect()))
    bytes_ = sorted(map(tuple, suffix_dedup.drop_repeats(df, 100).collect()))
    monkeypatch.setattr(super_kmers, "MOST", 2000)
    monkeypatch.setattr(suffix_dedup, "MOST", 9000)
    monkeypatch.setattr(suffix_dedup, "GROUP", 1500)
    assert sorted(map(tuple, super_kmers.drop_repeats(df).collect())) == want
    assert sorted(map(tuple, suffix_dedup.drop_repeats(df, 100).collect())) == bytes_


@pytest.mark.parametrize("memory", [0, 7, 1 << 20])
def test_suffix_order_of_small_texts(memory):
    rng = np.random.default_rng(memory)
    for _ in range(60):
        base = rng.integers(0, rng.integers(1, 5), rng.integers(1, 40)).tolist()
        t, cap = (base * 6)[: rng.integers(1, 150)], int(rng.choice([3, 9, 400]))
        order, common = suffix_order(np.array(t), cap, memory)
        assert sorted(order.tolist()) == list(range(len(t)))
        for a, b, c in zip(order[:-1], order[1:], common[1:]):
            x, y = t[a : a + cap], t[b : b + cap]
            assert x <= y
            assert c == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


@pytest.mark.parametrize("budget", [0, 500, 1 << 20])
def test_waiting_chunks_are_dealt_in_blocks(monkeypatch, budget):
    monkeypatch.setattr(induced_sort, "_BLOCK", 64)
    with tempfile.TemporaryFile() as file:
        queue = induced_sort._Queue(file, [budget])
        for i in range(1000):
            queue.push(np.array([2 * i, 2 * i + 1]), np.array([i, i]))
        queue.push(np.arange(2000, 2100), np.zeros(100, np.int64))
        blocks = []
        for at, lcp in queue.pop():
            assert len(at) == len(lcp)
            blocks.append(at)
            if len(blocks) == 3:
                queue.push(np.array([2100]), np.zeros(1, np.int64))
    assert np.concatenate(blocks).tolist() == list(range(2101))
    assert len(blocks) == 34  # 2,000 entries by 64, the large chunk, the one pushed meanwhile


def test_suffix_order_deals_few_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    lexicon = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) for _ in range(500)]
    t = np.frombuffer(b" ".join(lexicon[i] for i in rng.integers(0, 500, 8000)), np.uint8).astype(np.int16)
    calls, deal = [], induced_sort._Pushes.deal
    monkeypatch.setattr(induced_sort._Pushes, "deal", lambda self, at, lcp: (calls.append(len(at)), deal(self, at, lcp)))
    order, _ = suffix_order(t, 400)
    assert sorted(order.tolist()) == list(range(len(t)))
    assert len(calls) < 300  # 1,509 when every chunk was dealt alone


def test_hashes_in_pieces_are_those_of_the_whole(monkeypatch):
    data = np.random.default_rng(5).integers(0, 256, 9000).astype(np.uint8)
    want = super_kmers.sliding_min(super_kmers.rolling(suffix_dedup._BYTE[data], 12, suffix_dedup._BASE), 89)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    for n in (0, 99, 100, 101, 999, 1000, 1099, 1100, 9000):
        assert suffix_dedup.least_hashes(data[:n], 12, 100).tolist() == want[: max(0, n - 99)].tolist()


def test_close_is_the_hamming_distance():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 70, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (6, 70), dtype=np.uint64))
    fps = np.unique(np.concatenate([base, base ^ flips]))
    for radius in (0, 3, 4, 7):
        got = np.unpackbits(simhash.close(fps, simhash.planes(fps), len(fps), radius).view(np.uint8), axis=1, bitorder="little")[:, : len(fps)]
        assert (got.astype(bool) == (np.bitwise_count(fps[:, None] ^ fps) <= radius)).all()


def test_hot_buckets_go_to_finer_keys(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = int(rng.integers(1 << 62))
    fps = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (300, 2))} | {int(x) for x in rng.integers(0, 1 << 62, 200)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    monkeypatch.setattr(simhash, "HOT", 20)
    roots = {r.node: r.root for r in components(simhash.links(df, 4)).collect()}
    left = {f: {f} for f in fps}
    arr = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(arr ^ np.uint64(f)) <= 4):
            a, b = left[f], left[fps[j]]
            if a is not b:
                a |= b
                for x in b:
                    left[x] = a
    assert all(roots.get(f, f) == min(left[f]) for f in fps)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 60)}


def test_quality_of_odd_documents(spark):
    labels = spark.createDataFrame([(5, 1), (5, None), (None, 0), (6, 0)], "doc_id long, quality int")
    out = quality.judge(mixed_rows(spark), labels).collect()
    assert len(out) == 9 and not any(r.kept for r in out if r.n_words < 10)
    assert quality.judge(docs(spark), labels).collect() == []
    kept = quality.keep_good(mixed_rows(spark), labels)
    assert set(kept.columns) == set(mixed_rows(spark).columns) and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in out if r.kept)


def test_cutoffs_are_certified_one_stratum_at_a_time(spark):
    rows = [("a", 0.1, 1)] * 200 + [("a", 2.5, 1)] * 3 + [("a", 9.0, 0)] * 50 + [("b", 0.1, 1)] * 20 + [("c", 5.0, 1)] * 200
    got = {r.stratum: r.cutoff for r in quality.certified_cutoffs(spark.createDataFrame(rows, "stratum string, score double, quality int"), 0.05, 0.1).collect()}
    assert got == {"a": 1.0}  # b has too few labels, and c loses too many good documents at once


def test_mix_meets_budgets_and_caps(spark):
    rows = [(i, "w " * (i % 7 + 1), "en", ["a", "b", "c", None][i % 4] if i > 30 else "a", 1) for i in range(400)]
    out = mixing.mix(docs(spark, *rows)).collect()
    assert all(r.taken <= 3 * r["size"] for r in out)
    for s in {r.source for r in out}:
        mine = [r for r in out if r.source == s]
        assert sum(r.taken for r in mine) == int(mine[0].target)
    again = mixing.mix(docs(spark, *rows).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_of_texts_without_words(spark):
    assert [r.taken for r in mixing.mix(docs(spark, (1, "", "en", "s", 0), (2, None, "en", None, 0))).collect()] == [0, 0]


def test_chat_parts_masks_and_odd_turns(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 600, "cy", "late"), (None, None, None, "x"), (2, 0, "system", "alone")]
    out = chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(9))).collect()
    assert sorted((r.conv_id or 0, r.part, r.participant) for r in out) == [(0, 0, "unknown"), (1, 0, "ann"), (1, 0, "bob"), (1, 0, "cy")]
    ann = next(r for r in out if r.participant == "ann")
    a, b = map(int, ann.mask.split(":"))
    assert ann.text[a:b] == "hi <| im_end|><|im_end|>" and ann.mask_chars == b - a and ann.n_turns == 5
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_archives_with_magic_in_payloads_over_many_splits(spark):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(i, f"http://x/{i}", "a" * (i * 37 % 400) + fake * (i % 3) + ("é\r\n\r\n" if i % 4 else "WARC/1.0")) for i in range(40)]
    rows += [(90, None, None), (91, "u\r\nX: y", ""), (92, "u", "WARC/1.0\r\n" * 60), (93, "u", "WARC/1.0\r\n" * 60), (93, "u", "WARC/1.0\r\n" * 60), (None, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).repartition(2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    try:
        got = sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in warc.round_trip(pages).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", 1 << 40))
    want = []
    for i, _, h in rows:
        lead = first[h or ""]
        want.append((-1 if i is None else i, len((h or "").encode()), *(("response", -1) if lead == i else ("revisit", lead))))
    assert got == sorted(want)
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_no_urls_no_benchmark_no_documents(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, None), (2, "too short"), (3, "a " * 40), (4, "a " * 40)], "item_id long, text string")
    assert decontaminate.leaks(mixed_rows(spark), none).collect() == [] and decontaminate.leaks(docs(spark), bench).collect() == []
    assert decontaminate.leaks(mixed_rows(spark), bench).collect() == []
    assert {r.item_id for r in decontaminate.leaks(docs(spark, (1, "b " + "a " * 99, "en", "s", 1)), bench).collect()} == {3}


def test_batches_count_once_in_any_order(spark, tmp_path):
    counts = spark.createDataFrame([(1, "s", "en", "v", 10), (2, "s", None, "v", 5), (3, None, "en", "v", 0)], "doc_id long, source string, lang string, version string, tokens long")
    roll = token_rollup.Rollup(spark, str(tmp_path / "roll"))
    assert roll.totals().collect() == []
    gone = token_rollup.deleted(counts.where("doc_id = 1"))
    assert roll.commit("b", gone) and roll.commit("a", token_rollup.inserted(counts)) and not roll.commit("b", gone)
    new = counts.where("doc_id = 2").withColumn("tokens", F.lit(8).cast("long"))
    assert roll.commit("c", token_rollup.revised(counts.where("doc_id = 2"), new))
    (tmp_path / "roll" / "batch=torn").mkdir()  # a batch that failed before its commit
    assert sorted((r.source or "", r.lang or "", r.docs, r.tokens) for r in roll.totals().collect()) == [("", "en", 1, 0), ("s", "", 1, 8)]
    with pytest.raises(ValueError, match="batch id"):
        roll.commit("../x", gone)


def test_kept_words_are_joined_by_single_spaces(spark):
    out = super_kmers.drop_repeats(docs(spark, (1, " a \n\n b\tc ", "en", "s", 1))).first()
    assert out.kept_text == "a b c" and out.kept_sha256 == hashlib.sha256(b"a b c").hexdigest()
