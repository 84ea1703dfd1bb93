"""SimHash near-duplicates: fingerprints compared as bit planes with carry-save counters."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm import near_copies
from riskloom.llm.buffers import Words, slices
from riskloom.llm.components import components
from riskloom.llm.spans import small_batches
from riskloom.session import materialize

BITS = 64
#: Fingerprints in a block of planes, and the bucket size from which finer keys are used.
BLOCK, HOT = 1024, 8192
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprints(column: pa.Array, shingle: int, seed: int = 42) -> np.ndarray:
    """Signed 64-bit SimHash of every text: a bit is set if over half of the shingles' XXH64 have it.

    Words are runs without blanks, with A-Z lower-cased; a shingle is ``shingle`` words joined by
    one space, repeats count. Shorter texts are one shingle, texts without words are zero.
    """
    ws = Words(column, lower=True)
    n = np.diff(ws.first)
    per = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), per)
    begin = np.cumsum(per) - per
    head = np.repeat(ws.first[:-1] - begin, per) + np.arange(len(doc))
    tail = head + np.minimum(n, shingle)[doc] - 1
    text, h64 = ws.data.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((h64(text[a:b], seed) for a, b in zip(ws.start[head].tolist(), ws.end[tail].tolist())), np.uint64, len(doc))
    ones = np.zeros((len(n), BITS), np.int64)
    step = 1 << 17
    for at in range(0, len(doc), step):
        part = doc[at : at + step]
        bits = np.unpackbits(hashes[at : at + step].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        ones[part[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    over = (2 * ones > per[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.int64) if len(n) else np.zeros(0, np.int64)


def with_fingerprint(docs: DataFrame, shingle: int, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the fingerprint ``fp`` of every row's whole text."""
    source = docs.select(*keep, F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema) + ", fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text", 3 << 20):
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(fingerprints(b.column("_text"), shingle))], [*keep, "fp"])

    return source.mapInArrow(run, schema)


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of a block: row ``b`` holds bit ``b`` of all fingerprints, 64 to a word."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8), bitorder="little").reshape(-1, BITS)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def close(queries: np.ndarray, block: np.ndarray, size: int, radius: int, stride: int = 8) -> np.ndarray:
    """Bit matrix (query by block word) of the fingerprints within ``radius``.

    Every lane counts its differing bits in three bit-sliced counters and an overflow flag; a plane
    is added to all lanes of all queries by a carry-save step. After ``stride`` planes, queries of
    which all lanes have passed the radius are abandoned.
    """
    if not 0 <= radius <= 7:
        raise ValueError("the counters hold radii up to 7")
    out = np.zeros((len(queries), block.shape[1]), np.uint64)
    live, q = np.arange(len(queries)), queries.astype(np.uint64)
    c0, c1, c2, over = (np.zeros_like(out) for _ in range(4))
    spare = np.zeros(block.shape[1] * 64, np.uint8)
    spare[size:] = 1
    over |= np.packbits(spare, bitorder="little").view("<u8")
    for at in range(0, BITS, stride):
        for b in range(at, at + stride):
            x = block[b] ^ (np.uint64(0) - ((q >> np.uint64(b)) & np.uint64(1)))[:, None]
            t = c0 & x
            c0 ^= x
            x = c1 & t
            c1 ^= t
            t = c2 & x
            c2 ^= x
            over |= t
        gone = over | _above(c0, c1, c2, radius)
        rows = (gone != _ALL).any(axis=1)
        if not rows.all():
            live, q, c0, c1, c2, over = (v[rows] for v in (live, q, c0, c1, c2, over))
        if not len(live):
            return out
    out[live] = ~(over | _above(c0, c1, c2, radius))
    return out


def _above(c0, c1, c2, radius: int):
    """Lanes whose three-bit counter is above ``radius``."""
    more, same = np.zeros_like(c0), np.full_like(c0, _ALL)
    for c, bit in ((c2, radius & 4), (c1, radius & 2), (c0, radius & 1)):
        if bit:
            same &= c
        else:
            more |= same & c
            same &= ~c
    return more


def bucket_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) that connect whatever is within ``radius`` in a bucket, at most one per fingerprint."""
    root = np.arange(len(fps))
    blocks = [(at, fps[at : at + BLOCK]) for at in range(0, len(fps), BLOCK)]
    for j, (to, right) in enumerate(blocks):
        upright = planes(right)
        for base, left in blocks[: j + 1]:
            hits = close(left, upright, len(right), radius)
            for i in np.flatnonzero(hits.any(axis=1)):
                lanes = np.flatnonzero(np.unpackbits(hits[i].view(np.uint8), bitorder="little"))
                roots = np.unique(np.append(root[lanes + to], root[base + i]))
                if len(roots) > 1:
                    root[np.isin(root, roots[1:])] = roots[0]
    moved = root != np.arange(len(fps))
    return fps[moved], fps[root[moved]]


def _keys(parts: int, radius: int) -> list[Column]:
    """All but ``radius`` of ``parts`` bit ranges, in every choice: two fingerprints within the radius agree on one."""
    cuts = [BITS * i // parts for i in range(parts + 1)]
    out = []
    for k, chosen in enumerate(itertools.combinations(range(parts), parts - radius)):
        mask = sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        out.append(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(signed))))
    return out


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` whose components are those of all pairs of distinct fingerprints within ``radius``.

    Fingerprints that agree on all but ``radius`` of some bit ranges meet in a bucket, where planes
    compare them; the number of ranges follows from the number of fingerprints, and any number is
    exact. Members of a bucket above ``HOT`` do not meet there: they go on to keys of more ranges,
    which are again exact among them, and only what no key separates any more is compared whole.
    Each bucket gives a spanning forest, never all pairs.
    """
    fps = fps.select("fp").distinct()
    n, parts, most = fps.count(), radius + 1, radius + 4
    bits = lambda p: BITS * (p - radius) // p  # noqa: E731  of a key
    while parts < most and (bits(parts) < 12 or n > 256 * 2 ** bits(parts)):
        parts += 1
    found = None

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key, size = None, 0

        def flush():
            a, b = bucket_links(np.concatenate(held).view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys, values = np.asarray(batch.column("key")), np.asarray(batch.column("fp"))
            cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            for s, e in zip(cuts, np.append(cuts[1:], len(keys))):
                # Small buckets share a block of planes; a large one starts a block of its own.
                if held and keys[s] != key and (size + (e - s) > BLOCK):
                    yield flush()
                    held, size = [], 0
                held.append(values[s:e])
                key, size = keys[s], size + int(e - s)
        if held:
            yield flush()

    while True:
        keyed = materialize(fps.select("fp", F.explode(F.array(*_keys(parts, radius))).alias("key")), "simhash-keys")
        sizes = keyed.groupBy("key").count()
        hot = materialize(sizes.where(F.col("count") > HOT).select("key"), "simhash-hot")
        last = parts >= most or hot.isEmpty()
        # A bucket of one has no links.
        met = keyed.join(sizes.where((F.col("count") > 1) & (F.lit(last) | (F.col("count") <= HOT))).select("key"), "key", "left_semi")
        width = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = met.repartition(width, "key").sortWithinPartitions("key", "fp").mapInArrow(compare, "a bigint, b bigint")
        part = materialize(part, "simhash-links")
        found = part if found is None else found.union(part)
        if last:
            return found
        fps, parts = keyed.join(hot, "key", "left_semi").select("fp").distinct(), parts + 1


def near_groups(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row: the smallest id reachable over links of at most ``radius`` bits.

    Equal fingerprints are one node, whatever number of copies they stand for. Null and blank texts
    have fingerprint zero and are linked like any other. Rows that repeat an id are one more row of
    the result each. Null ids never name a component: one made of null ids has a null name. An
    empty table gives an empty result; other columns are ignored.
    """
    with small_batches(docs.sparkSession):
        marked = materialize(with_fingerprint(docs, shingle), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    joined = components(links(nodes, radius))
    rooted = nodes.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "fingerprint-roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.select("fp", "root").join(named, "root").select("fp", "component_id"), "fingerprint-names")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_pairs(docs: DataFrame, nodes: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``a, b``: pairs of the ``node, text_key`` rows that span whatever fingerprints link within ``radius`` bits.

    Texts of one fingerprint pair with one of them, which stands for it in the links of others.
    """
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text")
    with small_batches(docs.sparkSession):
        marked = materialize(with_fingerprint(texts, shingle, ("text_key",)).dropDuplicates(["text_key"]), "near-fingerprints")
    held = materialize(nodes.join(marked, "text_key").select("node", "fp"), "near-prints")
    first = materialize(held.groupBy("fp").agg(F.min("node").alias("first")), "near-firsts")
    same = held.join(first, "fp").where("node <> first").select("node", "first")
    x, y = (first.select(F.col("fp").alias(side), F.col("first").alias(name)) for side, name in (("a", "x"), ("b", "y")))
    across = links(held, radius).join(x, "a").join(y, "b").select("x", "y")
    pairs = same.toDF("x", "y").union(across).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return materialize(pairs.distinct(), "near-proposed")


def one_of_each(docs: DataFrame, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """The documents without those that have a smaller id in their group; all columns unchanged.

    Fingerprints within 4 bits propose pairs, which link where their shingle sets have a similarity
    of ``least``: a fingerprint distance that keeps most pairs at ``least`` also links many below
    it. The links that fingerprints miss are added by :mod:`near_copies`. Rows without an id stay,
    and rows that repeat an id stay or go together.
    """
    source = docs.select("doc_id", "text")
    groups = near_copies.near_groups(source, shingle, least, lambda nodes: near_pairs(source, nodes))
    gone = materialize(groups.where("component_id < doc_id").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
