"""Positions to remove, as (start, end) pairs per document, and the tables that carry them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Whole texts and packed strings go to tasks in batches of so many rows, while tables are written inside."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


#: What stands for a null id inside tasks; ``doc_key`` keeps such rows apart from a real id of this value.
NO_ID = -(1 << 63)


def doc_key() -> Column:
    """Hash of id and text: tells documents apart that share an id."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc, doc_key, text``, where rows that repeat id and text have one key."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), doc_key().alias("doc_key"), "text")


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open ranges; touching ranges are one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    head = np.flatnonzero(np.append(True, s[1:] > e[:-1]))
    return s[head], e[np.append(head[1:], len(s)) - 1]


def by_document(doc: np.ndarray, key: np.ndarray, starts: np.ndarray, width: int) -> list[tuple[int, int, bytes]]:
    """Windows at ``starts`` of ``width`` as one row of merged ranges per document."""
    out = []
    if not len(doc):
        return out
    order = np.lexsort((starts, key, doc))
    doc, key, starts = doc[order], key[order], starts[order]
    cuts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
    for a, b in zip(cuts, np.append(cuts[1:], len(doc))):
        s, e = merge(starts[a:b], starts[a:b] + width)
        out.append((int(doc[a]), int(key[a]), np.stack([s, e]).astype("<i8").tobytes()))
    return out


def by_place(doc: np.ndarray, key: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Merged ranges of all documents as the rows ``doc``, ``key``, start and end of one matrix, sorted."""
    if not len(doc):
        return np.zeros((4, 0), np.int64)
    order = np.lexsort((starts, key, doc))
    doc, key = doc[order], key[order]
    fresh = np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))
    # Documents are laid side by side on one line, too far apart to touch.
    wide, line = int(ends.max()) + 2, np.cumsum(fresh) - 1
    s, e = merge(starts[order] + line * wide, ends[order] + line * wide)
    own, first = s // wide, np.flatnonzero(fresh)
    return np.stack([doc[first][own], key[first][own], s - own * wide, e - own * wide])


def decode(packed: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """The merged ranges of one document's rows."""
    if not packed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.concatenate([np.frombuffer(p, "<i8").reshape(2, -1) for p in packed], axis=1)
    return merge(pairs[0], pairs[1])


def attach(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with ``_spans``, the list of packed ranges of each document; extra columns are kept."""
    per_doc = found.groupBy(F.col("doc").alias("_doc"), F.col("doc_key").alias("_key")).agg(F.collect_list("payload").alias("_spans"))
    left = docs.withColumn("_d", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("_k", doc_key())
    return left.join(per_doc, (F.col("_d") == F.col("_doc")) & (F.col("_k") == F.col("_key")), "left").drop("_d", "_k", "_doc", "_key")


def rows(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))
