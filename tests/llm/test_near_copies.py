"""Near copies of the pipeline against Jaccard similarity of all pairs."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskloom.llm import near_copies, simhash


def shingles(text, k=5):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(" ".join(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))) if ws else frozenset()


def all_pairs(rows, least=0.8):
    """The smallest id reachable over pairs at ``least``, by brute force."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or (min(len(x), len(y)) >= least * max(len(x), len(y)) and len(x & y) >= least * len(x | y)):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(d, low.get(find(i), d))
    return {d: low[find(i)] for i, (d, _) in enumerate(rows)}


def variants(seed=3):
    """Texts with copies of every likeness from about 0.6 to 1, some just repeating their lines."""
    rng, rows = np.random.default_rng(seed), []
    for g in range(40):
        base = [f"w{rng.integers(10**6)}" for _ in range(int(rng.integers(40, 300)))]
        rows.append((len(rows), " ".join(base)))
        for swaps in (1, 2, 3, 4, 6):
            ws = list(base)
            for at in rng.integers(0, len(ws), max(1, swaps * len(ws) // 120)):
                ws[at] = f"x{rng.integers(10**6)}"
            rows.append((len(rows), " ".join(ws)))
        rows.append((len(rows), " ".join(base + base)))
    return rows


def test_groups_are_those_of_all_pairs_at_the_threshold(spark):
    rows = variants()
    want = all_pairs(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies.near_groups(df).collect()} == want
    assert sorted(r.doc_id for r in simhash.one_of_each(df).collect()) == sorted(d for d, c in want.items() if d == c)


def test_hot_buckets_lose_no_pair(spark, monkeypatch):
    rows = variants(5)
    monkeypatch.setattr(near_copies, "HOT", 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies.near_groups(df).collect()} == all_pairs(rows)


def test_minima_of_long_sets_do_not_depend_on_the_steps():
    rng = np.random.default_rng(1)
    sizes = [0, 3, 70_000, 0, 1, 33_000, 0]
    first, hashes = np.append(0, np.cumsum(sizes)), rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64)
    got, mixed = near_copies.minima(hashes, first), near_copies._mix(hashes)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        for k in (0, 239):
            want = (mixed[a:b] * near_copies._MUL[k] + near_copies._ADD[k]).min() if b > a else np.uint64(0xFFFFFFFFFFFFFFFF)
            assert got[i, k] == want


def test_blank_texts_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, None), (2, ""), (None, text), (4, text), (5, text.upper())], "doc_id long, text string").withColumn("node", F.lit(1))
    assert sorted((r.doc_id or 0, r.node) for r in simhash.one_of_each(df).collect()) == [(0, 1), (1, 1), (4, 1)]


def crowd(seed=2, n=60):
    rng = np.random.default_rng(seed)
    bits = np.repeat(rng.integers(0, 1 << 63, (1, 4), dtype=np.uint64), n, axis=0) ^ (np.uint64(1) << rng.integers(0, 60, (n, 4), dtype=np.uint64))
    return np.arange(n) + 100, np.sort(rng.integers(50, 80, n)), np.where(np.arange(n) < 20, 100, np.arange(n) + 100), bits


def batches_of(key, node, size, root, weight, bits, rows):
    names = list(near_copies._MEMBER)
    columns = [pa.array(v) for v in (key, node, size, root, weight, *bits.view(np.int64).T.copy())]
    whole = pa.RecordBatch.from_arrays(columns, names)
    return [whole.slice(a, rows) for a in range(0, whole.num_rows, rows)]


def test_spanning_pairs_join_a_bucket_with_fewer_pairs_than_members():
    node, size, root, bits = crowd()
    key, weight = np.repeat([3, 5, 9], [40, 17, 3]), np.ones(60, np.int64)
    for rows in (7, 60):
        got = pa.Table.from_batches(list(near_copies._spanning(iter(batches_of(key, node, size, root, weight, bits, rows)), 0.8))).to_pydict()
        pairs = list(zip(got["a"], got["b"]))
        assert len(pairs) == len(set(pairs)) < 60 and all(key[a - 100] == key[b - 100] for a, b in pairs)
        assert all(size[a - 100] >= 0.8 * size[b - 100] - 1e-9 for a, b in pairs) and not any(a < 120 and b < 120 for a, b in pairs)
        join = {n: r for n, r in zip(node.tolist(), root.tolist())}
        for a, b in pairs:
            old, new = join[b], join[a]
            assert old != new  # no circles
            join = {n: new if r == old else r for n, r in join.items()}
        for x in range(60):
            for y in range(x):
                if key[x] == key[y] and size[y] >= 0.8 * size[x]:
                    assert join[x + 100] == join[y + 100]


def test_members_ask_a_larger_component_once_and_every_pair_is_asked_for():
    node, size, root, bits = crowd()
    weight = np.where(node < 120, 20, 1)
    key = np.repeat([3, 5, 9], [40, 17, 3])
    for rows in (7, 60):
        got = pa.Table.from_batches(list(near_copies._asks(iter(batches_of(key, node, size, root, weight, bits, rows)), 0.8))).to_pydict()
        asked = list(zip(got["node"], got["root"]))
        assert len(asked) == len(set(asked)) and not any(n < 120 for n, _ in asked)
        want = set()
        for x in range(60):
            for y in range(60):
                lower = (weight[x], root[x]) < (weight[y], root[y])
                if key[x] == key[y] and lower and min(size[x], size[y]) >= 0.8 * max(size[x], size[y]):
                    want.add((x + 100, int(root[y])))
        assert set(asked) == want


def test_blocks_of_a_component_answer_for_all_their_members(spark, monkeypatch):
    rows = variants(7)
    monkeypatch.setattr(near_copies, "BLOCK", 2)
    # Without spanning pairs, every link is found by asking.
    monkeypatch.setattr(near_copies, "alike", lambda pairs, *_: pairs.where("false"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies.near_groups(df).collect()} == all_pairs(rows)


def test_the_stage_links_by_fingerprints_first(spark, monkeypatch):
    """Before any band is looked at, the pairs that fingerprints propose are verified and linked."""
    base = " ".join(f"w{i}" for i in range(400))
    data = [(1, base), (2, base + " tail"), (3, " ".join(f"v{i}" for i in range(400))), (4, base), (5, "w1 w2"), (6, None)]
    seen = []

    def spied(nodes, docs, shingle, least, joined):
        seen.append(joined.where("node <> root").count())
        return joined

    monkeypatch.setattr(near_copies, "stars", spied)
    out = simhash.one_of_each(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert seen == [1] and sorted(r.doc_id for r in out) == [1, 3, 5, 6]
