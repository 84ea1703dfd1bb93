"""Corpus queries against their SQL, and against brute force where SQL has no counterpart."""

import base64
import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from compare import connect, mismatch

import corpus_pipeline
from test_near_copies import all_pairs
from riskloom.llm import chat, decontaminate, queries, simhash, suffix_dedup, token_rollup, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def table(spark, root, name):
    return spark.read.parquet(f"{root}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, small, name):
    assert mismatch(queries.QUERIES[name](spark, small), connect(small), queries.ORACLES[name]) is None


def suffix_reference(texts, length):
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        edge = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge)[: len(b)] > 0
        spans = int((gone & ~np.append(False, gone[:-1])[: len(b)]).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_removes_what_brute_force_removes(spark, small):
    rows = table(spark, small, "documents").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in rows), suffix_reference([(r.text or "").encode() for r in rows], 400)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op8_suffix_dedup(spark, small).collect()}
    assert got == want


def fingerprint(text, shingle):
    ws = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    import xxhash

    grams = [" ".join(ws[i : i + shingle]) for i in range(max(1, len(ws) - shingle + 1))] if ws else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, ids, radius):
    fps = np.array(fps, np.uint64)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps[: i + 1] ^ fps[i]) <= radius):
            root[find(i)] = find(int(j))
    least = defaultdict(lambda: 1 << 62)
    for i, d in enumerate(ids):
        least[find(i)] = min(least[find(i)], d)
    return {d: least[find(i)] for i, d in enumerate(ids)}


def test_simhash_groups_are_those_of_all_pairs(spark, small):
    rows = table(spark, small, "documents").select("doc_id", "text").collect()
    fps = [fingerprint(r.text, 4) for r in rows]
    got = queries.op9_simhash(spark, small).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {r.doc_id: f"{f:016x}" for r, f in zip(rows, fps)}
    assert {r.doc_id: r.component_id for r in got} == groups(fps, [r.doc_id for r in rows], 4)


def mixed(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


def leaks_reference(docs, items):
    out = {}
    for d, text in docs:
        ws = mixed(text)
        for i, passage in items:
            ps = mixed(passage)
            width = min(13, len(ps))
            need = -(-width * 8 // 10)
            best = 0
            for shift in range(-len(ps), len(ws) + 1):
                same = [0 <= shift + j < len(ws) and ws[shift + j] == p for j, p in enumerate(ps)]
                best = max([best, *(sum(same[j : j + width]) for j in range(len(ps) - width + 1))])
            if best >= need:
                out[d, i] = best
    return out


def test_leaks_are_those_of_every_alignment(spark, small):
    docs = [(r.doc_id, r.text) for r in table(spark, small, "documents").where("doc_id % 4 = 0").collect()]
    items = [(r.item_id, r.text) for r in table(spark, small, "benchmark").limit(12).collect()]
    rng = np.random.default_rng(4)
    for k, (i, passage) in enumerate(items[:8]):  # planted whole, with every sixth word changed, and in upper case
        ws = passage.split()
        changed = [w if j % 6 else f"other{rng.integers(99)}" for j, w in enumerate(ws)]
        docs += [(10_000 + k, "before it " + passage + " after"), (20_000 + k, "so " + " ".join(changed)), (30_000 + k, passage.upper())]
    found = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {(r.doc_id, r.item_id): r.matched for r in found.collect()} == leaks_reference(docs, items)


def test_leaks_are_the_same_without_broadcast(spark, small):
    docs, bench = table(spark, small, "documents"), table(spark, small, "benchmark")
    a = {tuple(r) for r in decontaminate.leaks(docs, bench).collect()}
    assert a and a == {tuple(r) for r in decontaminate.leaks(docs, bench, broadcast_rows=0).collect()}


def test_token_totals_are_those_of_the_final_state(spark, small):
    with open(f"{token_rollup.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=token_rollup.PIECES, mergeable_ranks=ranks, special_tokens={})
    labels = {r.doc_id: r for r in table(spark, small, "labels").collect()}
    want = Counter()
    for r in table(spark, small, "documents").collect():
        label = labels.get(r.doc_id)
        if label and label.quality == 0:
            continue
        text = r.text.lower() if r.lang == "de" else r.text
        want[r.source, r.lang, "docs"] += 1
        want[r.source, r.lang, "tokens"] += len(enc.encode_ordinary(text))
    got = Counter()
    for r in queries.op10_token_counts(spark, small).collect():
        got[r.source, r.lang, "docs"], got[r.source, r.lang, "tokens"] = r.docs, r.tokens
    assert got == want


def rule_reference(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, *(best or (None, None))


URLS = [
    None, "", "no scheme", "http://A.Example.NET/en/x", "https://net/", "https://net", "http://x.net?y=/", "ftp://example.com/de/#a://b",
    "http://notexample.com/de/", "http://ÄB.org/fr/é?q=1", "://", "http://a.org/fr", "x://example.net/en/://y", "http://b.org/fr/\nz",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    for r in url_filter.judge(pages).collect():
        host, path, rule, verdict = rule_reference(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_trees_learn_from_labelled_urls(spark):
    bad = [f"http://cheap-{i % 7}-pills.shop/{i * 7919 % 100003}?a=1&b={i}" for i in range(400)]
    good = [f"http://www.paper{i % 9}.org/news/story{i % 50}" for i in range(400)]
    rows = [(u, 1) for u in bad] + [(u, 0) for u in good]
    labelled, held = rows[::2], rows[1::2]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(held)], "page_id long, url string")
    out = url_filter.judge(pages, rules=(), labels=spark.createDataFrame(labelled, "url string, label int"))
    right = sum((r.verdict == "block") == bool(held[r.page_id][1]) for r in out.collect())
    assert right >= 0.95 * len(held)


def test_pipeline_stages_do_what_brute_force_does(spark, small):
    docs = table(spark, small, "documents")
    run = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, small)
        run[name] = (before.collect(), docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema.names == before.schema.names
    verdict = {r.doc_id: r.kept for r in queries.op5_quality_rules(spark, small).collect()}
    before, after = run["quality rules"]
    assert sorted(after) == sorted(r for r in before if verdict[r.doc_id])
    before, after = run["near-duplicates"]
    least = all_pairs([(r.doc_id, r.text) for r in before])
    assert sorted(after) == sorted(r for r in before if least[r.doc_id] == r.doc_id)
    before, after = run["repeated strings"]
    want = {r.doc_id: w for r, w in zip(before, suffix_reference([r.text.encode() for r in before], corpus_pipeline.PASSAGE))}
    assert {r.doc_id for r in after} == set(want)
    assert all(abs(len(r.text.encode()) - (want[r.doc_id][0] - want[r.doc_id][1])) <= 6 * want[r.doc_id][2] for r in after)
    before, after = run["decontamination"]
    leaked = {r.doc_id for r in decontaminate.leaks(spark.createDataFrame(before), table(spark, small, "benchmark")).collect()}
    assert sorted(after) == sorted(r for r in before if r.doc_id not in leaked)
    before, after = run["mixture"]
    assert {r.doc_id: r["size"] for r in after} == {r.doc_id: len(words(r.text)) for r in before}
    by_source = defaultdict(list)
    for r in after:
        by_source[r.source].append(r)
    assert all(sum(r.taken for r in rs) == int(rs[0].target) for rs in by_source.values())


def test_kept_spans_stay_valid_text(spark):
    shared = "é" * 300
    docs = spark.createDataFrame([(1, "a" + shared, 301, "x"), (2, "b" + shared[:250] + "z", 252, "y"), (3, None, None, None)], "doc_id long, text string, n_chars long, _row string")
    out = {r.doc_id: r for r in suffix_dedup.strip(docs).collect()}
    assert out[3].text is None and out[1]._row == "x" and out[2].text == "bz" and out[2].n_chars == 2
    assert out[1].text == "a"


def test_simhash_drops_near_copies_only(spark):
    rng = np.random.default_rng(0)
    base = [f"w{rng.integers(10**6)}" for _ in range(400)]
    near = [*base[:399], "last"]
    other = [f"v{rng.integers(10**6)}" for _ in range(400)]
    data = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(base)), (1, " ".join(other)), (None, " ".join(base))]
    out = simhash.one_of_each(spark.createDataFrame(data, "doc_id long, text string").withColumn("fp", F.lit(1)))
    assert sorted((r.doc_id or 0, r.fp) for r in out.collect()) == [(0, 1), (1, 1), (3, 1)]


def whole_dialogue(rows, speaker):
    """What one participant should see of (turn, role, text) rows, and the ranges that carry loss."""
    text, spans = "", []
    for _, role, said in sorted(rows):
        text += "<|im_start|>" + ("assistant" if role == speaker else "system" if role == "system" else f"user name={role}") + "\n"
        body = f"{said}<|im_end|>"
        if role == speaker:
            spans.append(f"{len(text)}:{len(text) + len(body)}")
        text += body + "\n"
    return text, ",".join(spans)


def test_long_dialogues_stay_whole(spark):
    rows = [(0, "system", "be kind"), *((t, "ann" if t <= 300 else "bob", f"turn {t}") for t in range(1, 601))]
    out = {r.participant: r for r in chat.rotate(spark.createDataFrame([(7, *r) for r in rows], "conv_id long, turn long, role string, text string")).collect()}
    assert set(out) == {"ann", "bob"}
    for speaker, r in out.items():
        assert (r.text, r.mask, r.n_turns, r.part) == (*whole_dialogue(rows, speaker), 601, 0)


def test_parts_give_everybody_every_turn_and_the_system_turns(spark):
    rows = [(0, "system", "be kind"), *((t // 2, "ann" if t <= 9 else "bob", f"turn {t}") for t in range(2, 20))]
    df = spark.createDataFrame([(None, *r) for r in rows], "conv_id long, turn long, role string, text string")
    out = {(r.participant, r.part): r for r in chat.rotate(df, 5).collect()}
    ordered = sorted(rows)
    assert set(out) == {(who, part) for who in ("ann", "bob") for part in range(4)}
    for (who, part), r in out.items():
        mine = ([ordered[0]] if part else []) + ordered[5 * part : 5 * part + 5]
        text, spans, at = whole_dialogue(mine, who)[0], whole_dialogue(mine, who)[1], len(mine)
        assert (r.text, r.mask, r.n_turns) == (text, spans, at)


def test_a_rare_label_is_not_lost_to_the_sample(spark):
    """Also not to its weight: the one blocked url is blocked, whatever number of rows allow others."""
    allowed = spark.range(60_000).selectExpr("concat('http://www.paper', id % 90, '.org/news/story', id) AS url", "0 AS label")
    blocked = spark.createDataFrame([("http://cheap-pills-77.shop/?a=1&b=2&c=3", 1)], "url string, label int")
    pages = spark.createDataFrame([(1, "http://cheap-pills-77.shop/?a=1&b=2&c=3"), (2, "http://www.paper5.org/news/story17")], "page_id long, url string")
    for n in (100, 60_000):
        out = url_filter.judge(pages, rules=(), labels=allowed.limit(n).union(blocked))
        assert {r.page_id: r.verdict for r in out.collect()} == {1: "block", 2: "allow"}


def test_hosts_paths_and_rules_of_all_pages(spark, small):
    urls = {r.page_id: r.url for r in table(spark, small, "pages").collect()}
    got = queries.op4_url_filter(spark, small).collect()
    assert {r.page_id for r in got} == set(urls) and len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = rule_reference(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and verdict in (None, r.verdict)


@pytest.mark.parametrize("width", [8, 9, 10, 11, 12, 13])
def test_masks_find_every_accepted_choice_of_changed_words(width):
    changes = width - -(-width * 8 // 10)
    masks = decontaminate.masks_for(width)
    for changed in itertools.combinations(range(width), changes):
        assert any(
            all(m[c - at] == "0" for c in changed if at <= c < at + len(m)) for m in masks for at in range(width - len(m) + 1)
        ), changed


def test_short_items_and_changed_words_are_found(spark):
    rng = np.random.default_rng(9)
    items, docs = [], []
    for width in (1, 3, 6, 7, 8, 10, 13):
        ws = [f"q{width}x{j}" for j in range(width)]
        items.append((width, " ".join(ws)))
        changes = width - -(-width * 8 // 10) if width >= 8 else 0
        for k, changed in enumerate(itertools.combinations(range(width), changes)):
            copy = [w if j not in changed else f"z{rng.integers(10**6)}" for j, w in enumerate(ws)]
            docs.append((1000 * width + k, f"before {' '.join(copy)} after"))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(d, d // 1000) for d, _ in docs}
