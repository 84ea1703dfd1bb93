"""Near copies by shingle similarity: candidates share a band of minimum hashes, and each is verified on its whole shingle set."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.buffers import Words, slices
from riskloom.llm.components import components
from riskloom.llm.spans import small_batches
from riskloom.session import materialize

#: Bands of minimum hashes and rows of one band. A pair of similarity 0.8 shares no band with a
#: probability of (1 - 0.8 ** 6) ** 40 = 5e-6.
BANDS, ROWS = 40, 6
#: Bucket size from which members are told apart by a second and third band too.
HOT, DEEPEST = 4096, 2
#: Leaders in turn that the members of a hot bucket are compared with before any other pairs.
STARS = 3
#: Members and shingles of a component's block, which one task holds.
BLOCK, SHINGLES = 512, 1 << 19
#: Columns with one bit of every minimum, by which the members of a bucket are compared.
BITS = tuple(f"bits{k}" for k in range(-(-BANDS * ROWS // 64)))
#: How far below the wanted similarity a sketch may lie: 4.6 standard deviations at 0.8.
SLACK = 0.12
_MEMBER = ("key", "node", "size", "root", "weight", *BITS)
_RNG = np.random.default_rng(64)
_MUL = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_FOLD = _RNG.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct XXH64 of every text's shingles, and where each text's begin.

    Words are runs without blanks, with A-Z lower-cased; a text of fewer than ``shingle`` words is
    one shingle, a text without words has none.
    """
    ws = Words(column, lower=True)
    n = np.diff(ws.first)
    per = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), per)
    begin = np.cumsum(per) - per
    head = np.repeat(ws.first[:-1] - begin, per) + np.arange(len(doc))
    tail = head + np.minimum(n, shingle)[doc] - 1
    text, h64 = ws.data.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((h64(text[a:b]) for a, b in zip(ws.start[head].tolist(), ws.end[tail].tolist())), np.uint64, len(doc))
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1]))[: len(doc)]
    hashes, doc = hashes[fresh], doc[fresh]
    return hashes, np.searchsorted(doc, np.arange(len(n) + 1))


def minima(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The minimum of every set under each of the hash functions, a row per set; sets without members get the largest value."""
    out = np.full((len(first) - 1, len(_MUL)), np.uint64(0xFFFFFFFFFFFFFFFF))
    some = np.flatnonzero(np.diff(first))
    if not len(some):
        return out
    # Long sets are taken in steps, so that what is held does not grow with a text.
    step, mixed = 1 << 15, _mix(hashes)
    for at in range(0, len(mixed), step):
        part = mixed[at : at + step]
        a, b = np.searchsorted(first, at, side="right") - 1, np.searchsorted(first, at + len(part), side="left")
        own = np.arange(a, b)[np.diff(np.clip(first[a : b + 1], at, at + len(part))) > 0]
        cuts = np.maximum(first[own], at) - at
        for k in range(len(_MUL)):
            out[own, k] = np.minimum(out[own, k], np.minimum.reduceat(part * _MUL[k] + _ADD[k], cuts))
    return out


def signed(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, text_key, node, size, bands, sketch`` and ``BITS`` of every row; texts with one shingle set have one ``node``."""
    source = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 3 << 20):
            hashes, first = shingle_sets(b.column("text"), shingle)
            raw, least = hashes.tobytes(), minima(hashes, first)
            cuts = (8 * first).tolist()
            node = np.array([xxhash.xxh64_intdigest(raw[x:y]) for x, y in zip(cuts[:-1], cuts[1:])], np.uint64)
            bands = np.empty((len(node), BANDS), np.uint64)
            for k in range(BANDS):
                bands[:, k] = _mix((_mix(least[:, k * ROWS : (k + 1) * ROWS]) * _FOLD).sum(axis=1, dtype=np.uint64) + np.uint64(k))
            sketch = (_mix(least) >> np.uint64(56)).astype(np.uint8)
            bits = np.pad(np.packbits(sketch & 1, axis=1), ((0, 0), (0, 8 * len(BITS) - len(_MUL) // 8))).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("text_key"), pa.array(node.view(np.int64)), pa.array(np.diff(first).astype(np.int64)),
                pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())), pa.array([s.tobytes() for s in sketch], pa.binary()),
                *(pa.array(np.ascontiguousarray(bits[:, k])) for k in range(len(BITS))),
            ], ["doc_id", "text_key", "node", "size", "bands", "sketch", *BITS])

    plain = ", ".join(f"{b} bigint" for b in BITS)
    return source.mapInArrow(run, f"doc_id {kind}, text_key bigint, node bigint, size bigint, bands array<bigint>, sketch binary, {plain}")


def _farthest(least: float) -> float:
    """Bits in which sketches of a pair at ``least`` may differ: five standard deviations above the mean."""
    n, p = BANDS * ROWS, (1 - least) / 2
    return n * p + 5 * np.sqrt(n * p * (1 - p))


def _stacked(columns: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Buckets of two or more members, those of one size as the rows of matrices."""
    key = columns[0]
    cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.append(cuts, len(key)))
    for n in np.unique(count[count > 1]).tolist():
        at = cuts[count == n][:, None] + np.arange(n)
        yield [v[at] for v in columns]


def _buckets(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """:func:`_stacked` whole buckets of rows that come sorted by key, which is the first column."""
    parts: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        parts.append([np.asarray(batch.column(c)) for c in names])
        key = parts[-1][0]
        if key[-1] == parts[0][0][0]:  # still one bucket
            continue
        columns = [np.concatenate(v) for v in zip(*parts)]
        last = int(np.searchsorted(columns[0], key[-1]))
        parts = [[v[last:] for v in columns]]
        yield from _stacked([v[:last] for v in columns])
    if parts:
        yield from _stacked([np.concatenate(v) for v in zip(*parts)])


def _apart(i: np.ndarray, size: np.ndarray, bits: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """How many bits members lie from member ``i`` of their bucket, and whether sizes and bits leave ``least`` possible."""
    row = np.arange(len(size))
    apart = sum(np.bitwise_count(v ^ v[row, i][:, None]).astype(np.int16) for v in bits)
    own = size[row, i][:, None]
    return apart, (apart <= _farthest(least)) & (np.minimum(size, own) >= least * np.maximum(size, own) - 1e-9)


def _forest(size: np.ndarray, root: np.ndarray, bits: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and both members of the closest pairs that span every bucket, as far as ``least`` is possible.

    Members of one root count as joined, so a bucket has fewer pairs than members.
    """
    none, row = np.int16(1 << 14), np.arange(len(size))
    best, via, left = np.full(size.shape, none), np.zeros(size.shape, np.int64), np.ones(size.shape, bool)
    at, out = np.zeros(len(size), np.int64), []
    for _ in range(size.shape[1] - 1):
        left[row, at] = False
        apart, near = _apart(at, size, bits, least)
        apart = np.where(root == root[row, at][:, None], np.int16(-1), np.where(near, apart, none))
        closer = left & (apart < best)
        best, via = np.where(closer, apart, best), np.where(closer, at[:, None], via)
        at = np.where(left, best, none + 1).argmin(axis=1)
        edge = (best[row, at] >= 0) & (best[row, at] < none)
        out.append((row[edge], at[edge], via[row, at][edge]))
    return tuple(np.concatenate(v) for v in zip(*out))


def _spanning(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """``a, b``: the pairs of :func:`_forest` in every bucket."""
    for _, node, size, root, _, *bits in _buckets(batches, _MEMBER):
        bucket, x, y = _forest(size, root, [v.view(np.uint64) for v in bits], least)
        x, y = node[bucket, x], node[bucket, y]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def _asks(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """``node, root``: members and the other components in which a member of their bucket leaves ``least`` possible.

    Of two components the one with fewer members asks.
    """
    for _, node, size, root, weight, *bits in _buckets(batches, _MEMBER):
        bits = [v.view(np.uint64) for v in bits]
        for i in range(size.shape[1]):
            _, near = _apart(np.full(len(size), i), size, bits, least)
            near &= (weight[:, i, None] < weight) | ((weight[:, i, None] == weight) & (root[:, i, None] < root))
            bucket, j = np.nonzero(near)
            if len(bucket):
                own, other = node[bucket, i], root[bucket, j]
                order = np.lexsort((other, own))
                own, other = own[order], other[order]
                fresh = np.append(True, (own[1:] != own[:-1]) | (other[1:] != other[:-1]))
                yield pa.RecordBatch.from_arrays([pa.array(own[fresh]), pa.array(other[fresh])], ["node", "root"])


def _answers(batches: Iterator[pa.RecordBatch], exact: bool, least: float) -> Iterator[pa.RecordBatch]:
    """What of the blocks of components answers those that ask: rows come sorted by block, its members first.

    ``node, root, block`` where a sketch of the block lies near; if ``exact``, ``a, b`` for one
    member of the block at ``least`` or more.
    """
    now, held, table = None, [], None
    for batch in batches:
        out = []
        sets = batch.column("members") if exact else [None] * batch.num_rows
        plain = (batch.column(c).to_pylist() for c in ("root", "block", "asks", "node", "size", "sketch"))
        for root, block, asks, node, size, sketch, members in zip(*plain, sets):
            members = np.frombuffer(members.as_buffer(), np.uint64) if exact else None
            if (root, block) != now:
                now, held, table = (root, block), [], None
            if not asks:
                held.append((node, size, sketch, members))
                continue
            if not held:
                continue
            if table is None:
                table = np.array([h[1] for h in held]), np.frombuffer(b"".join(h[2] for h in held), np.uint8).reshape(len(held), -1)
            alike = (table[1] == np.frombuffer(sketch, np.uint8)).mean(axis=1)
            near = np.flatnonzero((alike >= least - SLACK) & (np.minimum(table[0], size) >= least * np.maximum(table[0], size) - 1e-9))
            if not exact:
                out += [(node, root, block)] if len(near) else []
                continue
            for j in near[np.argsort(-alike[near], kind="stable")].tolist():
                if _reaches(members, held[j][3], least):
                    out.append((node, held[j][0]))
                    break
        names = ["a", "b"] if exact else ["node", "root", "block"]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)] if out else [pa.array([], pa.int64())] * len(names), names)


def _reaches(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether two sorted shingle sets have a Jaccard similarity of ``least`` or more."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= least * (len(x) + len(y) - common) - 1e-9


def merged(joined: DataFrame, links: DataFrame) -> DataFrame:
    """``node, root`` of linked nodes after ``links`` too."""
    return components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def rooted(nodes: DataFrame, joined: DataFrame) -> DataFrame:
    """``nodes`` with the ``root`` of each, which is the node itself where nothing is linked."""
    return nodes.join(joined.withColumnRenamed("root", "_root"), "node", "left").withColumn("root", F.coalesce("_root", "node")).drop("_root")


def unlinked(nodes: DataFrame) -> DataFrame:
    return nodes.select("node", F.col("node").alias("root")).where(F.lit(False))


def stars(nodes: DataFrame, docs: DataFrame, shingle: int, least: float, joined: DataFrame | None = None) -> DataFrame:
    """``node, root`` after verified links that join the members of hot buckets to a few leaders, and those of ``joined``.

    A large cluster is then mostly linked at a cost that grows with its members.
    """
    joined = unlinked(nodes) if joined is None else joined
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    hot = materialize(keyed.groupBy("key").count().where(F.col("count") > HOT).select("key"), "near-hot")
    if hot.isEmpty():
        return joined
    members = materialize(keyed.join(hot, "key", "left_semi"), "near-members")
    for turn in range(STARS):
        now = rooted(members, joined)
        lead = now.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "root")).alias("lead"))
        tried = now.join(lead, "key").where("root <> lead.root").groupBy("node").agg(F.min("lead").alias("lead"))
        pairs = tried.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()
        joined = merged(joined, alike(materialize(pairs, "near-stars"), docs, nodes, shingle, least))
    return joined


def linked(nodes: DataFrame, docs: DataFrame, shingle: int, least: float, proposed: DataFrame | None = None) -> DataFrame:
    """``node, root`` of all nodes with a link: the components over pairs that share a band and reach ``least``.

    The pairs ``a, b`` of ``proposed`` that reach ``least`` are links before any band is looked at. Then every bucket proposes the pairs that span it, fewer than its members; they are verified
    and contracted, which settles nearly all links. Then members ask the other components that they
    meet in a bucket, see :func:`answered`, so a member near many of one component asks it once.
    Pairs of two components are all asked for and pairs of one are linked already: none is lost.
    Members of a bucket above ``HOT`` do not meet there but where a further band agrees too; what
    ``DEEPEST`` further bands do not part is compared whole, after the leaders of :func:`stars`
    have linked most of it.
    """
    width = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = unlinked(nodes)
    if proposed is not None and not proposed.isEmpty():
        joined = merged(joined, alike(proposed, docs, nodes, shingle, least))
    joined = stars(nodes, docs, shingle, least, joined)
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    for depth in range(DEEPEST + 1):
        sizes = rooted(keyed, joined).groupBy("key").agg(F.count(F.lit(1)).alias("count"), F.min("root").alias("r"), F.max("root").alias("s"))
        sizes = materialize(sizes.where("r < s").select("key", "count"), "near-buckets")
        last = depth == DEEPEST
        now = materialize(keyed.join(sizes if last else sizes.where(F.col("count") <= HOT), "key", "left_semi"), "near-met")
        for asking in (False, True):
            state = rooted(nodes.select("node", "size", *BITS), joined)
            weight = state.groupBy("root").agg(F.count(F.lit(1)).alias("weight"), F.sum("size").alias("shingles"))
            state = materialize(state.join(weight, "root"), "near-state")
            met = now
            if asking:  # what the spanning pairs have joined is done
                apart = now.join(state.select("node", "root"), "node").groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"))
                met = now.join(apart.where("r < s"), "key", "left_semi")
            rows = met.join(state.select("node", "size", "root", "weight", *BITS), "node").select(*_MEMBER)
            rows = rows.repartition(width, "key").sortWithinPartitions("key", "node")
            if asking:
                asked = materialize(rows.mapInArrow(partial(_asks, least=least), "node bigint, root bigint").distinct(), "near-asked")
                links = asked if asked.isEmpty() else answered(asked, state, docs, nodes, shingle, least)
            else:
                pairs = materialize(rows.mapInArrow(partial(_spanning, least=least), "a bigint, b bigint").distinct(), "near-pairs")
                links = pairs if pairs.isEmpty() else alike(pairs, docs, nodes, shingle, least)
            if not links.isEmpty():
                joined = merged(joined, links)
        hot = sizes.where(F.col("count") > HOT)
        if last or hot.isEmpty():
            return joined
        again = keyed.join(hot, "key", "left_semi").join(nodes.select("node", "bands"), "node")
        again = again.select("node", F.explode(F.array_except("bands", F.array("key"))).alias("more"), "key")
        # A pair of bands is one key, whichever of the two was hot.
        keyed = materialize(again.select("node", F.xxhash64(F.least("key", "more"), F.greatest("key", "more")).alias("key")).distinct(), "near-keys")


def answered(asked: DataFrame, state: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, least: float) -> DataFrame:
    """``a, b``: links of the ``asked`` pairs of a node and another component, one per block of the component at most.

    A component's members are dealt to blocks of about ``BLOCK`` members or ``SHINGLES`` shingles.
    Who asks goes to every block, with the sketch first, with the shingle set where a sketch is near.
    """
    width = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.ceil(F.greatest(F.col("weight") / BLOCK, F.col("shingles") / SHINGLES)).cast("long").alias("blocks")
    wanted = materialize(asked.select("root").distinct().join(state.select("root", "weight", "shingles").distinct(), "root").select("root", blocks), "near-wanted")
    dealt = state.select("node", "root").join(wanted, "root").select("node", "root", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    dealt = materialize(dealt, "near-dealt")
    calls = asked.join(wanted, "root").select("node", "root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))

    def facing(calls: DataFrame, held: DataFrame, what: DataFrame) -> DataFrame:
        both = held.withColumn("asks", F.lit(0)).union(calls.withColumn("asks", F.lit(1)))
        return both.join(what, "node").repartition(width, "root", "block").sortWithinPartitions("root", "block", "asks", "node")

    with small_batches(docs.sparkSession):
        light = facing(calls, dealt, nodes.select("node", "size", "sketch"))
        near = materialize(light.mapInArrow(partial(_answers, exact=False, least=least), "node bigint, root bigint, block bigint"), "near-answers")
    held = dealt.join(near.select("root", "block").distinct(), ["root", "block"], "left_semi").select("node", "root", "block")
    members = shingled(near.select("node").union(held.select("node")).distinct(), docs, nodes, shingle)
    with small_batches(docs.sparkSession, 100):
        heavy = facing(near, held, nodes.select("node", "size", "sketch").join(members, "node"))
        return materialize(heavy.mapInArrow(partial(_answers, exact=True, least=least), "a bigint, b bigint"), "near-links")


def shingled(needed: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """``node, members``: the packed shingle sets of the ``needed`` nodes."""
    keys = nodes.join(needed, "node", "left_semi").select("node", "text_key")
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text").join(keys, "text_key").select("node", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 3 << 20):
            hashes, first = shingle_sets(b.column("text"), shingle)
            cuts, raw = (8 * first).tolist(), hashes.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([raw[x:y] for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())], ["node", "members"])

    with small_batches(docs.sparkSession, 100):
        return materialize(texts.mapInArrow(sets, "node bigint, members binary").dropDuplicates(["node"]), "near-sets")


def alike(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of ``least`` or more."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("x", "y"))
                near = pa.array((x == y).mean(axis=1) >= least - SLACK)
                yield b.select(["a", "b"]).filter(near)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [_reaches(*(np.frombuffer(v.as_buffer(), np.uint64) for v in pair), least) for pair in zip(b.column("x"), b.column("y"))]
            yield b.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    def both(what: DataFrame, column: str, over: DataFrame) -> DataFrame:
        x, y = (what.select(F.col("node").alias(n), F.col(column).alias(v)) for n, v in (("a", "x"), ("b", "y")))
        return over.join(x, "a").join(y, "b").select("a", "b", "x", "y")

    with small_batches(docs.sparkSession):
        close = materialize(both(nodes, "sketch", pairs).mapInArrow(sketched, "a bigint, b bigint"), "near-sketched")
    members = shingled(close.select(F.col("a").alias("node")).union(close.select("b")).distinct(), docs, nodes, shingle)
    with small_batches(docs.sparkSession, 100):
        return materialize(both(members, "members", close).mapInArrow(verify, "a bigint, b bigint"), "near-links")


def near_groups(docs: DataFrame, shingle: int = 5, least: float = 0.8, propose: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``doc_id, component_id`` per row: the smallest id reachable over pairs of a Jaccard similarity of ``least`` or more.

    Similarity is that of the sets of ``shingle``-word shingles, told apart by 64-bit hashes. Texts
    with one set are one node, whatever number of copies they stand for; null and blank texts are
    one too. Null ids never name a component. Candidates share a band of minimum hashes, so a pair
    at 0.8 is missed with a probability of 5e-6 (8e-5 if it meets in hot buckets only), and
    alike ones more rarely; no pair below ``least`` is linked. ``propose`` may name pairs ``a, b``
    of the ``node, text_key`` it is given, which are verified first.
    """
    with small_batches(docs.sparkSession):
        marked = materialize(signed(docs, shingle), "near-signed")
    one = (F.first(c).alias(c) for c in ("bands", "sketch", "size", *BITS))
    nodes = materialize(marked.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"), *one), "near-nodes")
    worded = nodes.where("size > 0")
    joined = linked(worded, docs, shingle, least, propose(worded.select("node", "text_key")) if propose else None)
    roots = materialize(rooted(nodes.select("node", "least"), joined), "near-roots")
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(roots.select("node", "root").join(named, "root").select("node", "component_id"), "near-names")
    return marked.select("doc_id", "node").join(named, "node").select("doc_id", "component_id")
