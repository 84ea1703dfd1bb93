"""Token counts kept as additive totals: signed deltas in idempotent batches."""

from __future__ import annotations

import base64
import functools
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm.buffers import slices
from riskloom.session import materialize, shared_dir

TOKENIZERS = "/opt/tokenizers"
#: How the byte-level vocabularies cut text before merging; fixed with them.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEYS = ("source", "lang", "version")
_CHANGE = "doc_id bigint, source string, lang string, version string, tokens bigint"


@functools.cache
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, version: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``doc_id, source, lang, version, tokens`` per row: ids the tokenizer gives the whole text.

    ``folder`` holds ``<version>.tiktoken`` on every executor. Null and empty texts have 0 tokens;
    names of special tokens are ordinary text. Rows that repeat an id are counted each.
    """
    path = f"{folder}/{version}.tiktoken"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path).encode_ordinary
        for b in slices(batches, "text", 4 << 20):
            tokens = [len(encode(t.as_py() or "")) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "source", "lang")), pa.array([version] * len(tokens), pa.string()), pa.array(tokens, pa.int64())],
                ["doc_id", "source", "lang", "version", "tokens"],
            )

    columns = (F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text")
    return docs.select(*columns).mapInArrow(run, _CHANGE)


def inserted(counts: DataFrame) -> DataFrame:
    return counts.withColumn("sign", F.lit(1))


def deleted(counts: DataFrame) -> DataFrame:
    return counts.withColumn("sign", F.lit(-1))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """What replaces the counts ``before`` by those ``after``: the old ones leave, the new ones enter."""
    return deleted(before).unionByName(inserted(after))


class Rollup:
    """Totals of documents and tokens by source, language and tokenizer version, below ``path``.

    A batch of signed counts is added up and written as its own folder. Spark's commit marks the
    folder whole, and only whole folders count; a batch id that is whole already is not applied
    again. So a retry after any failure neither loses nor doubles a batch, batches may come in any
    order, and what a batch adds is never rewritten. Totals are sums over the folders, whose size
    depends on the number of keys and not of documents.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def committed(self, batch: str) -> bool:
        files, path = self._at(f"batch={batch}/_SUCCESS")
        return files.exists(path)

    def batches(self) -> list[str]:
        files, path = self._at("")
        if not files.exists(path):
            return []
        names = (s.getPath().getName() for s in files.listStatus(path))
        return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch=") and self.committed(n.removeprefix("batch=")))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch once; False if it was committed before. Null keys are keys of their own."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"not a batch id: {batch!r}")
        if self.committed(batch):
            return False
        delta = changes.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"))
        delta.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """``source, lang, version, docs, tokens``; keys whose documents have all left are gone."""
        whole = [f"{self.path}/batch={b}" for b in self.batches()]
        schema = "source string, lang string, version string, docs bigint, tokens bigint"
        deltas = self.spark.read.schema(schema).parquet(*whole) if whole else self.spark.createDataFrame([], schema)
        summed = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.where("docs <> 0 OR tokens <> 0")


def corpus_totals(docs: DataFrame, labels: DataFrame, version: str = "byte_bpe_50k", folder: str = TOKENIZERS, revise: Column | None = None) -> DataFrame:
    """Totals after three batches over a corpus: all documents enter; those that ``revise`` selects (by default
    the German ones) are counted anew with lower-cased text; those labelled of low quality leave with the
    count they have then. Every batch is sent twice, as after a lost acknowledgement.

    The revised texts are picked where they are read; labels meet counts only, so no text is shuffled.
    """
    spark = docs.sparkSession
    chosen = F.coalesce(F.col("lang") == "de" if revise is None else revise, F.lit(False))
    poor = labels.where("quality = 0").select(F.col("doc_id").alias("l_id")).distinct()
    counts = materialize(count_tokens(docs, version, folder), "token-counts")
    after = materialize(count_tokens(docs.where(chosen).withColumn("text", F.lower("text")), version, folder), "token-revised")
    before, rest = counts.where(chosen), counts.where(~chosen)
    gone = rest.unionByName(after).join(poor, F.col("doc_id") == F.col("l_id"), "left_semi")
    rollup = Rollup(spark, f"{shared_dir(spark)}/riskloom/rollup-{uuid.uuid4().hex}")
    feed: Sequence[tuple[str, DataFrame]] = (("1-insert", inserted(counts)), ("2-revise", revised(before, after)), ("3-delete", deleted(gone)))
    for batch, changes in feed:
        rollup.commit(batch, changes)
        rollup.commit(batch, changes)
    return rollup.totals()
