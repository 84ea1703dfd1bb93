"""Sum-of-squares packing: token pieces are dealt to shards and placed where the squared counts of open bins per gap become smallest."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from riskloom.llm.buffers import slices
from riskloom.llm.spans import small_batches
from riskloom.llm.token_rollup import _encoding
from riskloom.session import materialize

#: Tokens of a sequence, and the id that ends a document.
LIMIT, END = 1024, 2
#: Pieces that one task places. Pieces of one shard fill each other's gaps; what they leave goes to fewer shards.
SHARD = 1 << 15
#: A bin with at most this share of the limit free is not packed anew.
FULL = 1 / 64
_NEVER = 1 << 40


@functools.cache
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a text as the tokenizer of the json file gives them without special tokens around.

    The rank file beside it holds the same vocabulary and gives the same ids several times as
    fast. It knows no names of special tokens, and its pattern overflows the stack on very long
    blank runs: such texts, and all if there is no rank file, go through the json file.
    """
    slow = functools.cache(lambda: Tokenizer.from_file(path))

    def whole(text: str) -> np.ndarray:
        return np.array(slow().encode(text, add_special_tokens=False).ids, np.uint32)

    try:
        fast: tiktoken.Encoding = _encoding(path.removesuffix(".json") + ".tiktoken")
    except FileNotFoundError:
        return whole
    odd = re.compile(r"<\||\s{5000}").search
    return lambda text: whole(text) if odd(text) else fast.encode_to_numpy(text)


def cut(docs: DataFrame, limit: int = LIMIT, end: int = END, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every row's whole text and its end id, written once.

    Documents above ``limit`` tokens are cut so that all pieces but the first have ``limit``; others
    stay whole. ``ids`` holds little-endian 32-bit numbers. Null and empty texts have the end id
    alone. Rows that repeat an id, or have none, are documents of their own. Other columns are
    ignored; an empty table gives no rows. ``tokenizer`` is a file that every executor can read.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path)
        for b in slices(batches, "text", 2 << 20):
            doc, piece, start, length, ids = [], [], [], [], []
            for name, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                raw = np.append(ids_of(text.as_py() or ""), np.uint32(end)).astype("<u4").tobytes()
                n = len(raw) // 4
                edges = [0, *range(n % limit or limit, n + 1, limit)]
                for k, (x, y) in enumerate(zip(edges[:-1], edges[1:])):
                    doc.append(name)
                    piece.append(k)
                    start.append(x)
                    length.append(y - x)
                    ids.append(raw[4 * x : 4 * y])
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with small_batches(docs.sparkSession):
        return materialize(source.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids binary"), "pieces")


def squares(lengths: np.ndarray, limit: int, free: bool) -> np.ndarray:
    """The bin of every length, one after another, each where the sum of squares comes out smallest.

    The sum runs over gaps below ``limit`` and counts the open bins with that gap; a filled bin
    counts no more. Ties go to the smallest gap left. ``free`` lets a new bin compete with the open
    ones; otherwise one is opened only if nothing fits.
    """
    count = np.zeros(limit + 1, np.int64)
    waiting: list[list[int]] = [[] for _ in range(limit + 1)]
    out, bins = np.empty(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        having = count[size:limit]  # by the gap that would be left
        change = 2 * (count[: limit - size] - having) + 2
        change[0] = 1 - 2 * having[0]
        change[having == 0] = _NEVER
        left = int(change.argmin())
        if change[left] < (2 * count[limit - size] + 1 if free else _NEVER):
            out[i] = waiting[left + size].pop()
            count[left + size] -= 1
        else:
            left, out[i], bins = limit - size, bins, bins + 1
        if left:
            waiting[left].append(int(out[i]))
            count[left] += 1
    return out


def fill(lengths: np.ndarray, limit: int) -> np.ndarray:
    """Bins of a shard's lengths: long ones first, and the pieces of bins left open packed once more among themselves."""
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order]
    bins = squares(falling, limit, True)
    loose = np.flatnonzero(np.bincount(bins, falling)[bins] < limit)
    bins[loose] = squares(falling[loose], limit, False) + bins.max(initial=0) + 1
    out = np.empty(len(lengths), np.int64)
    out[order] = bins
    return out


def place(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``: where in which sequence of ``limit`` tokens their ``length`` lies.

    Pieces of ``limit`` tokens are sequences by themselves. The others are dealt evenly to shards of
    about ``SHARD``, whatever their values, and a task fills its bins by :func:`squares`. Pieces of
    bins that stay open by more than ``FULL`` go to a next round of fewer shards, until one shard is
    left or a round has not halved them; then every bin counts. Offsets of a sequence have no gaps.
    Rows whose length is null, below 1 or above ``limit`` get no place (nulls). Columns of these two
    names are replaced, others kept. An empty table gives no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    whole = pieces.where(F.col("length") == limit).withColumns({"sequence_id": F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 62)), "offset": F.lit(0).cast("long")})
    odd = pieces.where(~F.coalesce(F.col("length").between(1, limit), F.lit(False)))
    out = whole.unionByName(odd.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")}))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def shard(batches: Iterator[pa.RecordBatch], turn: int, last: bool) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        lengths = table.column("length").to_numpy().astype(np.int64)
        bins = fill(lengths, limit)
        used = np.bincount(bins, lengths).astype(np.int64)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        heads = np.flatnonzero(np.append(True, bins[order][1:] != bins[order][:-1]))
        offset = np.empty(len(bins), np.int64)
        offset[order] = ends - lengths[order] - np.repeat((ends - lengths[order])[heads], np.diff(np.append(heads, len(bins))))
        name = bins + ((turn << 56) + (TaskContext.get().partitionId() << 24))
        again = np.zeros(len(bins), bool) if last else limit - used[bins] > limit * FULL
        table = table.append_column("sequence_id", pa.array(name, mask=again)).append_column("offset", pa.array(offset, mask=again))
        yield from table.to_batches(max_chunksize=10_000)

    left, before = pieces.where((F.col("length") >= 1) & (F.col("length") < limit)), None
    turn = 0
    while n := left.count():
        shards = -(-n // SHARD)
        last = shards == 1 or (before is not None and 2 * n > before) or turn == 31
        now = materialize(left.repartition(shards).mapInArrow(functools.partial(shard, turn=turn, last=last), schema), "packed")
        out = out.unionByName(now.where("sequence_id IS NOT NULL"))
        if last:
            break
        left, before, turn = now.where("sequence_id IS NULL").drop("sequence_id", "offset"), n, turn + 1
    return out


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts``: the tokens of every sequence, and where in it which document's piece begins.

    ``placed`` is the result of :func:`place` over :func:`cut`; a sequence has at most its limit of pieces.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    held = placed.where("sequence_id IS NOT NULL").groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return held.select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("starts"))


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document."""
    digests = cut(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return place(digests)
