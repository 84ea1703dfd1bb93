"""Substring dedup over words: super-k-mers travel to their minimiser's bucket, where sorting counts windows."""

from __future__ import annotations

import functools
import hashlib
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.buffers import Words, slices
from riskloom.llm.spans import attach, by_document, decode, keyed, rows, small_batches
from riskloom.session import materialize

_ROLL, _GRAM = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes of text for one bucket, and the bytes of packed strings above which a bucket is dealt anew.
BUCKET, MOST = 1 << 20, 10 << 20
_SCHEMA = "bucket bigint, kind int, doc bigint, doc_key bigint, payload binary"
_PACKED, _SPANS = 0, 1


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def rolling(h: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash modulo 2^64 of every run of ``width`` values, from prefix sums."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(base, len(h)), out=sums[1:])
    back = _powers(np.uint64(pow(int(base), -1, 1 << 64)), len(h) - width + 1)
    out = (sums[width:] - sums[:-width]) * back
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, by doubling."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Strings:
    """Packed word strings with their place: what a super-k-mer is while it travels.

    ``words`` holds all strings after one another; string ``i`` has words ``first[i]:first[i + 1]``
    and begins at word ``at[i]`` of document ``(doc[i], key[i])``.
    """

    def __init__(self, words: Words, first: np.ndarray, doc: np.ndarray, key: np.ndarray, at: np.ndarray):
        self.first, self.doc, self.key, self.at = first, doc, key, at
        self.words = words
        bare = words.data[words.data != 0x20]
        lengths = words.end - words.start
        ends = np.append(0, np.cumsum(lengths)).astype(np.int64)
        listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(bare)])
        coded = listed.dictionary_encode()
        self.ids = np.asarray(coded.indices)
        hashed = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        self.hashes = hashed[self.ids] if len(self.ids) else np.zeros(0, np.uint64)

    def windows(self, width: int) -> np.ndarray:
        """Marks the words at which a whole window begins."""
        out = np.zeros(len(self.ids), bool)
        out[: max(0, len(out) - width + 1)] = True
        n = np.diff(self.first)
        for back in range(1, width):
            last = self.first[1:] - back
            out[last[n >= back]] = False
        return out

    def repeats(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window starts, those of them with an equal window before (by document, then start), and window hashes.

        Strings must be in order of document and place. Hashes are sorted to find candidates; equal
        hashes count as equal only if their words are.
        """
        begins = np.flatnonzero(self.windows(width))
        hashes = rolling(self.hashes, width, _ROLL)[begins] if len(begins) else np.zeros(0, np.uint64)
        ordered = np.sort(hashes)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        later = np.zeros(len(begins), bool)
        if len(twice):
            twice = twice[np.append(True, twice[1:] != twice[:-1])]
            spot = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
            some = np.flatnonzero(twice[spot] == hashes)
            some = some[np.argsort(spot[some], kind="stable")]
            group = spot[some]
            head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            lead = np.repeat(some[head], np.diff(np.append(head, len(some))))
            same = np.ones(len(some), bool)
            for j in range(width):
                same &= self.ids[begins[some] + j] == self.ids[begins[lead] + j]
            own = self.owner(begins)
            spot_of = np.stack([self.doc[own], self.key[own], self.at[own] + begins - self.first[own]])
            # A document given twice is one: a window is no repeat of itself.
            later[some] = same & (spot_of[:, some] != spot_of[:, lead]).any(axis=0)
            for g in np.unique(group[~same]):  # a hash shared by different words
                members = some[group == g]
                _, which = np.unique(self.ids[begins[members][:, None] + np.arange(width)], axis=0, return_inverse=True)
                seen: dict[int, int] = {}
                for member, w in zip(members, which.reshape(-1)):
                    later[member] = (spot_of[:, member] != spot_of[:, seen.setdefault(w, member)]).any()
        return begins, later, hashes

    def owner(self, begins: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, begins, side="right") - 1


def pack(strings: Strings, begin: np.ndarray, stop: np.ndarray, bucket: np.ndarray) -> list[tuple[int, bytes]]:
    """One compressed payload per bucket of the word ranges ``begin:stop``."""
    order = np.argsort(bucket, kind="stable")
    begin, stop, bucket = begin[order], stop[order], bucket[order]
    own = strings.owner(begin)
    place = strings.at[own] + begin - strings.first[own]
    text = strings.words.data.tobytes()
    a, b = strings.words.start[begin].tolist(), strings.words.end[stop - 1].tolist()
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    press, out = zstandard.ZstdCompressor(level=1), []
    for s, e in zip(cuts, np.append(cuts[1:], len(bucket))):
        body = b"\n".join([text[x:y] for x, y in zip(a[s:e], b[s:e])])
        head = np.concatenate([strings.doc[own[s:e]], strings.key[own[s:e]], place[s:e]]).astype("<i8").tobytes()
        out.append((int(bucket[s]), press.compress(struct.pack("<q", e - s) + head + body)))
    return out


def unpack(payloads: list[bytes]) -> Strings:
    """The strings of payloads, in order of document and place."""
    open_ = zstandard.ZstdDecompressor()
    docs, keys, places, texts = [], [], [], []
    for p in payloads:
        raw = open_.decompress(p)
        (n,) = struct.unpack_from("<q", raw)
        ints = np.frombuffer(raw, "<i8", 3 * n, 8)
        docs.append(ints[:n])
        keys.append(ints[n : 2 * n])
        places.append(ints[2 * n :])
        texts += raw[8 + 24 * n :].split(b"\n")
    doc, key, at = np.concatenate(docs), np.concatenate(keys), np.concatenate(places)
    order = np.lexsort((at, key, doc))
    words = Words(pa.array([texts[i] for i in order.tolist()], pa.binary()))
    return Strings(words, words.first, doc[order], key[order], at[order])


def _emit(packed: list[tuple[int, bytes]], spans: list[tuple[int, int, bytes]], buckets: int) -> pa.RecordBatch:
    return rows({
        "bucket": ([b for b, _ in packed] + [k % buckets for _, k, _ in spans], pa.int64()),
        "kind": ([_PACKED] * len(packed) + [_SPANS] * len(spans), pa.int32()),
        "doc": ([None] * len(packed) + [d for d, _, _ in spans], pa.int64()),
        "doc_key": ([None] * len(packed) + [k for _, k, _ in spans], pa.int64()),
        "payload": ([p for _, p in packed] + [p for _, _, p in spans], pa.binary()),
    })


def repeated_spans(docs: DataFrame, width: int = 20, gram: int = 5, buckets: int | None = None) -> DataFrame:
    """Word ranges covered by windows that start earlier somewhere: rows of ``doc, doc_key, payload``.

    In the map tasks, windows that repeat inside a slice of documents are settled on the spot, so
    that a passage leaves a slice once however often it occurs there. Of what is left, consecutive
    windows with the same smallest ``gram``-word hash form one string; the strings of a bucket
    travel compressed together. A bucket sorts the windows of its strings and marks all but the
    first of equal ones. One that outgrows ``MOST`` bytes, because a minimiser is very common, is
    not held in memory: chunk by chunk its windows are reduced to first occurrences and dealt on
    by the hash of the whole window, in further rounds until none is left.
    """
    spark = docs.sparkSession
    width_out = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if buckets is None:
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        buckets = max(width_out, -(-size // BUCKET))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            words = Words(b.column("text"))
            doc, key = np.asarray(b.column("doc")), np.asarray(b.column("doc_key"))
            order = np.lexsort((key, doc))
            if (order[1:] < order[:-1]).any():
                b = b.take(pa.array(order))
                words, doc, key = Words(b.column("text")), doc[order], key[order]
            strings = Strings(words, words.first, doc, key, np.zeros(len(doc), np.int64))
            begins, later, _ = strings.repeats(width)
            own = strings.owner(begins)
            place = begins - strings.first[own]
            spans = by_document(doc[own[later]], key[own[later]], place[later], width)
            begins, own = begins[~later], own[~later]
            packed = []
            if len(begins):
                least = sliding_min(rolling(strings.hashes, gram, _GRAM), width - gram + 1)[begins]
                head = np.flatnonzero(np.append(True, (begins[1:] != begins[:-1] + 1) | (least[1:] != least[:-1]) | (own[1:] != own[:-1])))
                tail = np.append(head[1:], len(begins)) - 1
                packed = pack(strings, begins[head], begins[tail] + width, (least[head] % np.uint64(buckets)).astype(np.int64))
            yield _emit(packed, spans, buckets)

    def count(batches: Iterator[pa.RecordBatch], used: int) -> Iterator[pa.RecordBatch]:
        now, held, size, dealt = None, [], 0, False

        def settle(split: bool) -> Iterator[pa.RecordBatch]:
            strings = unpack(held)
            begins, later, hashes = strings.repeats(width)
            own = strings.owner(begins)
            gone = own[later]
            spans = by_document(strings.doc[gone], strings.key[gone], strings.at[gone] + begins[later] - strings.first[gone], width)
            yield _emit([], spans, 1)
            first = begins[~later] if split else begins[:0]
            # Six bits of the hash that no earlier round has used.
            part = (hashes[~later] >> np.uint64(58 - 6 * used)).astype(np.int64) & 63
            for at in range(0, len(first), 100_000):
                some = first[at : at + 100_000]
                yield _emit(pack(strings, some, some + width, now * 64 + part[at : at + 100_000]), [], 1)

        for batch in batches:
            settled = batch.filter(pc.equal(batch.column("kind"), _SPANS))
            yield pa.RecordBatch.from_arrays(settled.columns, settled.schema.names)  # all columns nullable, as in the others
            batch = batch.filter(pc.equal(batch.column("kind"), _PACKED))
            for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
                if bucket != now:
                    if held:
                        yield from settle(dealt)
                    now, held, size, dealt = bucket, [], 0, False
                held.append(payload)
                size += zstandard.frame_content_size(payload)
                if size > MOST:
                    dealt = True
                    yield from settle(True)
                    held, size = [], 0
        if held:
            yield from settle(dealt)

    left, found = keyed(docs).mapInArrow(scan, _SCHEMA), None
    for used in itertools.count():
        sent = left.repartition(width_out, "bucket").sortWithinPartitions("bucket").mapInArrow(functools.partial(count, used=used), _SCHEMA)
        with small_batches(spark):
            sent = materialize(sent, "window-spans")
        spans = sent.where(F.col("kind") == _SPANS).select("doc", "doc_key", "payload")
        found = spans if found is None else found.union(spans)
        left = sent.where(F.col("kind") == _PACKED)
        if left.isEmpty():
            return found


def drop_repeats(docs: DataFrame, width: int = 20) -> DataFrame:
    """Texts without the words of windows seen earlier: ``doc_id, n_words, n_removed, kept_sha256, kept_text``.

    A window of ``width`` words is seen earlier if it also starts in a smaller document or earlier
    in the same one; all windows are judged on the input. Documents are ordered by id (null first)
    and, where an id repeats, by the hash of their text; rows that repeat id and text are one
    document and share one result. Null, empty and blank texts have no words. Texts with fewer
    than ``width`` words lose nothing. Other columns are ignored; an empty table gives no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            words = Words(b.column("text"))
            data = words.data.tobytes()
            n, removed, kept = np.diff(words.first), [], []
            for i, packed in enumerate(b.column("_spans").to_pylist()):
                s, e = decode(packed)
                removed.append(int((e - s).sum()))
                lo, hi = np.append(0, e) + words.first[i], np.append(s, n[i]) + words.first[i]
                kept.append(b" ".join([data[words.start[x] : words.end[y - 1]] for x, y in zip(lo, hi) if x < y]))
            yield rows({
                "doc_id": (b.column("doc_id").to_pylist(), pa.int64()), "n_words": (n.tolist(), pa.int64()), "n_removed": (removed, pa.int64()),
                "kept_sha256": ([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), "kept_text": ([k.decode() for k in kept], pa.string()),
            })

    marked = attach(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), repeated_spans(docs, width))
    return marked.mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")


REPEATS_SQL = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM split)
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1
), gone AS (
    SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS j FROM later
), placed AS (
    SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j FROM split
), kept AS (
    SELECT p.doc_id, string_agg(w, ' ' ORDER BY p.j) AS kept_text, count(*) AS n FROM placed p
    LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.j = g.j WHERE g.j IS NULL GROUP BY p.doc_id
)
SELECT s.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""
