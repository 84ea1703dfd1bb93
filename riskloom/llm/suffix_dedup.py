"""Suffix-array dedup over bytes: shards of strings that can share a substring, sorted by induction."""

from __future__ import annotations

import functools
import hashlib
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.llm.buffers import slices, text_bytes
from riskloom.llm.induced_sort import suffix_order
from riskloom.llm.spans import attach, by_place, decode, keyed, rows, small_batches
from riskloom.llm.super_kmers import rolling, sliding_min
from riskloom.session import materialize

#: Random but fixed: what each byte counts in a hash.
_BYTE = np.random.default_rng(8).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of text for one shard; bytes of strings above which a shard is dealt anew, or a group of one
#: hash; bytes sorted at once.
SHARD, MOST, GROUP, SORTED = 1 << 20, 8 << 20, 1 << 19, 1 << 18
#: Bytes of text whose spans are merged at once; spans that a task gathers before it sends them.
MERGED, GATHERED = 64 << 20, 1 << 16
#: Bytes that are hashed at once.
PIECE = 1 << 15
_SCHEMA = "shard bigint, kind int, payload binary"
_PACKED, _SPANS = 0, 1


class Strings:
    """Byte strings with their place: string ``i`` is ``data[first[i]:first[i + 1]]`` and begins at byte ``at[i]``."""

    def __init__(self, data: np.ndarray, first: np.ndarray, doc: np.ndarray, key: np.ndarray, at: np.ndarray):
        self.data, self.first, self.doc, self.key, self.at = data, first, doc, key, at

    def alike(self) -> np.ndarray:
        """The number of each string's content; equal strings have equal numbers."""
        array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.doc), [None, pa.py_buffer(self.first.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.data))])
        return np.asarray(array.dictionary_encode().indices)

    def take(self, which: np.ndarray) -> Strings:
        raw, f = self.data.tobytes(), self.first.tolist()
        parts = [raw[f[i] : f[i + 1]] for i in which.tolist()]
        first = np.append(0, np.cumsum(np.diff(self.first)[which])).astype(np.int64)
        return Strings(np.frombuffer(b"".join(parts), np.uint8), first, self.doc[which], self.key[which], self.at[which])


def settle_copies(strings: Strings, length: int) -> tuple[Strings, np.ndarray, np.ndarray]:
    """One of each equal strings, its number in the input, and the spans of those that occur at several places."""
    order = np.lexsort((strings.at, strings.key, strings.doc))
    places = np.stack([strings.doc, strings.key, strings.at])[:, order]
    single = np.sort(order[np.append(True, (places[:, 1:] != places[:, :-1]).any(axis=0))[: len(order)]])
    strings = strings.take(single) if len(single) < len(strings.doc) else strings
    alike = strings.alike()
    _, lead, member, counts = np.unique(alike, return_index=True, return_inverse=True, return_counts=True)
    size = np.diff(strings.first)
    many = np.flatnonzero((counts[member] > 1) & (size >= length))
    spans = np.stack([strings.doc[many], strings.key[many], strings.at[many], strings.at[many] + size[many]])
    if len(lead) == len(alike):
        return strings, single, spans
    lead = np.sort(lead)
    return strings.take(lead), single[lead], spans


def least_hashes(data: np.ndarray, gram: int, length: int) -> np.ndarray:
    """The smallest ``gram``-byte hash of every ``length`` bytes, worked out on pieces that stay in the processor's cache."""
    out = np.empty(max(0, len(data) - length + 1), np.uint64)
    step = max(PIECE, 4 * length)
    for a in range(0, len(out), step):
        piece = data[a : a + step + length - 1]
        out[a : a + step] = sliding_min(rolling(_BYTE[piece], gram, _BASE), length - gram + 1)
    return out


def runs(strings: Strings, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the runs of windows that share the smallest ``gram``-byte hash, and that hash."""
    n = len(strings.data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    least = least_hashes(strings.data, gram, length)
    whole = np.zeros(n + 1, np.int32)
    a, b = strings.first[:-1], np.maximum(strings.first[1:] - length + 1, strings.first[:-1])
    np.add.at(whole, a, 1)
    np.add.at(whole, b, -1)
    valid = np.cumsum(whole[: len(least)]) > 0
    same = valid[1:] & valid[:-1] & (least[1:] == least[:-1])
    # Neighbouring windows of two strings are apart, unless a string is just one window long.
    edge = strings.first[1:-1]
    edge = edge[(edge > 0) & (edge < len(least))]
    same[edge - 1] = False
    head = np.flatnonzero(valid & ~np.append(False, same))
    tail = np.flatnonzero(valid & ~np.append(same, False))
    return head, tail + length, least[head]


def pack(strings: Strings, begin: np.ndarray, stop: np.ndarray, least: np.ndarray, shard: np.ndarray) -> list[tuple[int, bytes]]:
    order = np.lexsort((least, shard))
    begin, stop, least, shard = begin[order], stop[order], least[order], shard[order]
    own = np.searchsorted(strings.first, begin, side="right") - 1
    place = strings.at[own] + begin - strings.first[own]
    raw, a, b = strings.data.tobytes(), begin.tolist(), stop.tolist()
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    press, out = zstandard.ZstdCompressor(level=1), []
    for s, e in zip(cuts, np.append(cuts[1:], len(shard))):
        ints = np.concatenate([strings.doc[own[s:e]], strings.key[own[s:e]], place[s:e], stop[s:e] - begin[s:e], least[s:e].view(np.int64)])
        body = b"".join([raw[x:y] for x, y in zip(a[s:e], b[s:e])])
        out.append((int(shard[s]), press.compress(struct.pack("<q", e - s) + ints.astype("<i8").tobytes() + body)))
    return out


def unpack(payloads: Sequence[bytes]) -> tuple[Strings, np.ndarray]:
    open_ = zstandard.ZstdDecompressor()
    ints, bodies = [], []
    for p in payloads:
        raw = open_.decompress(p)
        (n,) = struct.unpack_from("<q", raw)
        ints.append(np.frombuffer(raw, "<i8", 5 * n, 8).reshape(5, n))
        bodies.append(raw[8 + 40 * n :])
    doc, key, at, size, least = np.concatenate(ints, axis=1)
    first = np.append(0, np.cumsum(size)).astype(np.int64)
    return Strings(np.frombuffer(b"".join(bodies), np.uint8), first, doc, key, at), least


def cut_at(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to at most ``most``, or single ones."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def repeated_in(strings: Strings, length: int) -> np.ndarray:
    """Spans of the windows that occur twice in a shard: neighbours in suffix order that agree on ``length`` bytes."""
    n = len(strings.doc)
    t = np.zeros(len(strings.data) + n, np.int16)
    t[np.arange(len(strings.data)) + np.repeat(np.arange(n), np.diff(strings.first))] = strings.data.astype(np.int16) + 1
    first = strings.first + np.arange(n + 1)
    order, common = suffix_order(t, length)
    near = common >= length
    at = np.sort(order[near | np.append(near[1:], False)])
    own = np.searchsorted(first, at, side="right") - 1
    inside = at + length < first[own + 1]  # the separator is not part of a string
    at, own = at[inside], own[inside]
    starts = strings.at[own] + at - first[own]
    return by_place(strings.doc[own], strings.key[own], starts, starts + length)


def _emit(packed: list[tuple[int, bytes]], kind: int = _PACKED) -> pa.RecordBatch:
    return rows({
        "shard": ([s for s, _ in packed], pa.int64()),
        "kind": ([kind] * len(packed), pa.int32()),
        "payload": ([p for _, p in packed], pa.binary()),
    })


class Spans:
    """Spans that a task has found, merged and sent as one packed row for each group of documents."""

    def __init__(self, groups: int):
        self.groups, self.held, self.count = groups, [], 0

    def add(self, spans: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(spans)
        self.count += spans.shape[1]
        if self.count > GATHERED:
            yield self.send()

    def send(self) -> pa.RecordBatch:
        spans = by_place(*np.concatenate(self.held, axis=1)) if self.held else np.zeros((4, 0), np.int64)
        self.held, self.count = [], 0
        group = spans[1] % self.groups
        order = np.argsort(group, kind="stable")
        spans, group = spans[:, order], group[order]
        cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
        press = zstandard.ZstdCompressor(level=1)
        return _emit([(int(group[a]), press.compress(spans[:, a:b].astype("<i8").tobytes())) for a, b in zip(cuts, np.append(cuts[1:], len(group)))], _SPANS)


def spans_by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, doc_key, payload``: one row of merged spans for every document; rows of :class:`Spans` come sorted by group."""
    open_, now, held = zstandard.ZstdDecompressor(), None, []

    def merged() -> Iterator[pa.RecordBatch]:
        doc, key, start, end = by_place(*np.concatenate(held, axis=1))
        cuts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
        payload = [np.stack([start[a:b], end[a:b]]).astype("<i8").tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(doc)))]
        yield rows({"doc": (doc[cuts], pa.int64()), "doc_key": (key[cuts], pa.int64()), "payload": (payload, pa.binary())})

    for batch in batches:
        for group, payload in zip(batch.column("shard").to_pylist(), batch.column("payload").to_pylist()):
            if group != now and held:
                yield from merged()
                held = []
            now = group
            held.append(np.frombuffer(open_.decompress(payload), "<i8").reshape(4, -1))
    if held:
        yield from merged()


def repeated_spans(docs: DataFrame, length: int = 400, grams: Sequence[int] | None = None, shards: int | None = None) -> DataFrame:
    """Byte ranges covered by strings of ``length`` bytes that start elsewhere too: ``doc, doc_key, payload``.

    Strings of ``length`` bytes that are equal have the same smallest ``grams[0]``-byte hash. So
    runs of windows with one such hash go to the shard it names, and a shard is sorted on its own.
    Equal runs are settled where they meet, in the map task or the shard, and go on once. In a
    shard only runs whose hash occurs in different strings are sorted; their suffixes are induced
    with common prefixes, and neighbours that agree on ``length`` bytes mark both. A task merges
    the spans of its shards and sends them packed by groups of documents, so a document has one
    row in the result, however many shards and copies have marked it.

    A shard that outgrows ``MOST`` bytes is not held: its distinct runs are cut anew by the
    smallest hash of the next, longer gram, and in the end by the window itself, which parts
    whatever is not equal. Grams are 48, 128 and 256 bytes for 400, and in proportion for others.
    """
    grams = grams or [max(1, g * length // 400) for g in (48, 128, 256)]
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = shards or max(width, -(-size // SHARD))
    groups = max(width, -(-size // MERGED))
    levels = (*(g for g in grams if g < length), length)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Spans(groups)
        for b in slices(batches, "text", 2 << 20):
            raw, offs = text_bytes(b.column("text"))
            strings = Strings(raw, offs, np.asarray(b.column("doc")), np.asarray(b.column("doc_key")), np.zeros(b.num_rows, np.int64))
            strings, _, spans = settle_copies(strings, length)
            begin, stop, least = runs(strings, length, levels[0])
            yield _emit(pack(strings, begin, stop, least, (least % np.uint64(shards)).astype(np.int64)))
            yield from found.add(spans)
        yield found.send()

    def sort(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
        now, held, size, dealt, found = None, [], 0, False, Spans(groups)

        def settle(split: bool) -> Iterator[pa.RecordBatch]:
            strings, least = unpack(held)
            strings, kept, spans = settle_copies(strings, length)
            size = np.diff(strings.first)
            yield from found.add(spans)
            if split:
                yield from deal(strings, np.arange(len(size)))
                return
            # Two equal windows have the smallest hash at two places: of two strings, or of one.
            least = least[kept].view(np.uint64)
            _, member, counts = np.unique(least, return_inverse=True, return_counts=True)
            inside = np.zeros(len(size), np.int64)
            for a, b in cut_at(size, PIECE):
                part = strings.data[strings.first[a] : strings.first[b]]
                hashes = rolling(_BYTE[part], levels[level], _BASE)
                place = np.flatnonzero(hashes == np.repeat(least[a:b], size[a:b])[: len(hashes)]) + strings.first[a]
                inside += np.bincount(np.searchsorted(strings.first, place, side="right") - 1, minlength=len(size))[: len(size)]
            shared = np.flatnonzero((counts[member] > 1) | (inside > 1))
            shared = shared[np.argsort(member[shared], kind="stable")]
            group = np.flatnonzero(np.append(True, member[shared][1:] != member[shared][:-1])) if len(shared) else np.zeros(0, np.int64)
            ends = np.append(group[1:], len(shared))
            sizes = np.add.reduceat(size[shared], group) if len(shared) else np.zeros(0, np.int64)
            large = (sizes > GROUP) & (level + 1 < len(levels))
            for a, b in zip(group[large], ends[large]):
                yield from deal(strings, shared[a:b])
            group, ends, sizes = group[~large], ends[~large], sizes[~large]
            for a, b in cut_at(sizes, SORTED):
                which = np.concatenate([shared[x:y] for x, y in zip(group[a:b], ends[a:b])])
                yield from found.add(repeated_in(strings.take(which), length))

        def deal(strings: Strings, which: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a, b in cut_at(np.diff(strings.first)[which], 1 << 20):
                some = strings.take(which[a:b])
                begin, stop, key = runs(some, length, levels[level + 1])
                yield _emit(pack(some, begin, stop, key, now * 64 + (key % np.uint64(64)).astype(np.int64)))

        for batch in batches:
            settled = batch.filter(pc.equal(batch.column("kind"), _SPANS))
            yield pa.RecordBatch.from_arrays(settled.columns, settled.schema.names)  # all columns nullable, as in the others
            batch = batch.filter(pc.equal(batch.column("kind"), _PACKED))
            for shard, payload in zip(batch.column("shard").to_pylist(), batch.column("payload").to_pylist()):
                if shard != now:
                    if held:
                        yield from settle(dealt)
                    now, held, size, dealt = shard, [], 0, False
                held.append(payload)
                size += zstandard.frame_content_size(payload)
                if size > MOST and level + 1 < len(levels):
                    dealt = True
                    yield from settle(True)
                    held, size = [], 0
        if held:
            yield from settle(dealt)
        yield found.send()

    left, found = keyed(docs).mapInArrow(scan, _SCHEMA), None
    for level in range(len(levels)):
        sent = left.repartition(width, "shard").sortWithinPartitions("shard").mapInArrow(functools.partial(sort, level=level), _SCHEMA)
        with small_batches(spark):
            sent = materialize(sent, "suffix-spans")
        spans = sent.where(F.col("kind") == _SPANS).select("shard", "payload")
        found = spans if found is None else found.union(spans)
        left = sent.where(F.col("kind") == _PACKED)
        if left.isEmpty():
            break
    found = found.repartition(width, "shard").sortWithinPartitions("shard")
    return found.mapInArrow(spans_by_document, "doc bigint, doc_key bigint, payload binary")


def drop_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Texts without bytes covered by repeated strings: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    A string of ``length`` bytes is repeated if it also starts at any other place, overlapping or
    not, in the same document or another; all are judged on the input, so every occurrence goes.
    ``kept`` holds the remaining bytes. Matches never cross documents. Null and empty texts have
    no bytes; texts shorter than ``length`` lose nothing. Rows that repeat id and text are one
    document and share one result; rows that share only the id are told apart by their texts.
    Other columns are ignored; an empty table gives no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            raw, offs = text_bytes(b.column("text"))
            data, removed, spans, kept = raw.tobytes(), [], [], []
            for i, packed in enumerate(b.column("_spans").to_pylist()):
                s, e = decode(packed)
                removed.append(int((e - s).sum()))
                spans.append(len(s))
                lo, hi = np.append(0, e) + offs[i], np.append(s + offs[i], offs[i + 1])
                kept.append(b"".join([data[x:y] for x, y in zip(lo.tolist(), hi.tolist())]))
            yield rows({
                "doc_id": (b.column("doc_id").to_pylist(), pa.int64()), "n_bytes": (np.diff(offs).tolist(), pa.int64()), "n_removed": (removed, pa.int64()),
                "n_spans": (spans, pa.int64()), "kept_sha256": ([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), "kept": (kept, pa.binary()),
            })

    marked = attach(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), repeated_spans(docs, length))
    return marked.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def strip(docs: DataFrame, length: int = 400) -> DataFrame:
    """The documents with repeated strings cut out of their texts; ``n_chars``, if there, is counted anew.

    What a cut leaves of a character it runs through is dropped, so texts stay valid. Null texts
    stay null, documents cut to nothing stay with an empty text, other columns are unchanged.
    """
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = attach(packed, repeated_spans(docs, length)).select("_row", "text", "_spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            raw, offs = text_bytes(b.column("text"))
            data, texts = raw.tobytes(), []
            for i, (text, packed) in enumerate(zip(b.column("text"), b.column("_spans").to_pylist())):
                if not packed:
                    texts.append(text.as_py())
                    continue
                s, e = decode(packed)
                lo, hi = np.append(0, e) + offs[i], np.append(s + offs[i], offs[i + 1])
                texts.append(b"".join([data[x:y] for x, y in zip(lo.tolist(), hi.tolist())]).decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(texts, pa.string())], ["_row", "_text"])

    cut_rows = marked.mapInArrow(cut, T.StructType([T.StructField("_row", marked.schema["_row"].dataType), T.StructField("_text", T.StringType())]))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return cut_rows.select(*(new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns))
