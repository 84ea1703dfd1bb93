"""Benchmark decontamination by spaced seeds: hash joins that tolerate substituted words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.native import starts
from riskloom.session import materialize

#: Words that count (1) and words that may differ (0) inside a seed's span. Of 13 words any two may differ and
#: some placement still fits; a test goes through all choices.
MASKS = ("11101011", "11010111", "111001011")
#: The same for items of fewer words, of which one (8, 9) or two may differ. Shorter ones are looked up whole.
SHORT_MASKS = {8: ("1111",), 9: ("1111",), 10: ("111",), 11: ("111",), 12: ("1111",)}


def masks_for(words: int) -> tuple[str, ...]:
    """The masks that find an item of so many words."""
    return MASKS if words > max(SHORT_MASKS) else SHORT_MASKS.get(words, ("1" * words,))


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, as 64-bit hashes in order."""
    bare = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    listed = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))
    return F.transform(listed, lambda w: F.xxhash64(w))


def seeds(ts: str, n: str, masks: Sequence[str]) -> Column:
    """All seeds of a token array, as pairs (hash, start)."""
    def of(mask: str) -> Column:
        used = [i for i, bit in enumerate(mask) if bit == "1"]
        return F.transform(
            starts(n, len(mask)),
            lambda i: F.struct(F.xxhash64(F.lit(mask), *(F.get(F.col(ts), i + o) for o in used)).alias("h"), i.alias("at")),
        )

    return F.concat(*(of(m) for m in masks))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    overlap: int = 13,
    similarity: float = 0.8,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Documents that hold a passage of a benchmark item: ``doc_id, item_id, words, matched, start``.

    A hit is a seed that occurs in both texts: the words under the ones of a mask agree, those
    under its zeros may differ. Each hit fixes how the two texts line up. The overlap is verified
    there word by word: it is a leak if some ``overlap`` aligned words (all, if the item is
    shorter) agree in at least the share ``similarity``. ``matched`` is the largest number of
    equal words in such a stretch of ``words``, ``start`` its first word in the document.

    Every position of every document is looked up. Seeds of the benchmark are counted, and
    broadcast if they are at most ``broadcast_rows``; a larger benchmark is joined by shuffle.
    Texts travel only for documents with hits.

    With ``overlap`` 13 and ``similarity`` 0.8 every such leak of an item of 8 words or more has a hit
    (:func:`masks_for`); shorter items are found where all their words stand in sequence. Masks for
    short items are looked up only if the benchmark has such items.

    One row per document and item; equal items count once, under their smallest id. Null and empty
    texts have no leaks, and items without words cannot be found. Rows that repeat both id and text give one result. Empty tables give no rows.
    """
    items = (
        benchmark.where(F.col("text").isNotNull()).select("item_id", tokens(F.col("text")).alias("it"))
        .groupBy("it").agg(F.min("item_id").alias("item_id")).withColumn("n", F.size("it"))
    )
    items = materialize(items.where("n > 0"), "bench-items")
    longest = max(SHORT_MASKS) + 1
    sizes = sorted(r[0] for r in items.select(F.least("n", F.lit(longest))).distinct().collect())
    masks = sorted({m for size in sizes for m in masks_for(size)})
    none = items.where("false").select("item_id", F.lit(None).cast("struct<h: bigint, at: int>").alias("s"))
    seeded = reduce(
        lambda a, b: a.union(b),
        (items.where(F.least("n", F.lit(longest)) == size).select("item_id", F.explode(seeds("it", "n", masks_for(size))).alias("s")) for size in sizes), none,
    )
    # A seed that an item repeats counts once, so that repetitive texts do not multiply.
    listed = materialize(seeded.groupBy(F.col("s.h").alias("h"), "item_id").agg(F.min("s.at").alias("item_at")), "bench-seeds")
    small = listed.count() <= broadcast_rows
    fit = F.broadcast if small else lambda df: df

    key = F.xxhash64("doc_id", "text").alias("doc_key")
    spread = docs.where(F.col("text").isNotNull()).select("doc_id", key, tokens(F.col("text")).alias("ts"))
    spread = spread.withColumn("n", F.size("ts")).select("doc_id", "doc_key", F.explode(seeds("ts", "n", masks or MASKS)).alias("s"))
    hits = spread.select("doc_id", "doc_key", F.col("s.h").alias("h"), F.col("s.at").alias("doc_at")).join(fit(listed), "h")
    hits = materialize(hits.select("doc_id", "doc_key", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct(), "bench-hits")

    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("d_id"), key.alias("d_key"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("doc_key") == F.col("d_key"))
    found = texts.join(hits.select("doc_id", "doc_key").distinct(), same, "left_semi").select("d_id", "d_key", tokens(F.col("text")).alias("ts"))
    lined = hits.join(fit(items), "item_id").join(found.dropDuplicates(["d_id", "d_key"]), same)
    width = F.least(F.col("n"), F.lit(overlap))
    agree = F.transform("it", lambda w, j: F.when(F.coalesce(F.get(F.col("ts"), F.col("shift") + j) == w, F.lit(False)), 1).otherwise(0))
    lined = lined.withColumn("width", width).withColumn("agree", agree)
    inside = F.transform(
        F.sequence(F.lit(0), F.col("n") - F.col("width")),
        lambda j: F.struct(F.aggregate(F.slice("agree", j + 1, F.col("width")), F.lit(0), lambda a, x: a + x).alias("matched"), (-j).alias("at")),
    )
    best = lined.withColumn("best", F.array_max(inside)).where(F.col("best.matched") >= F.ceil(F.col("width") * similarity - 1e-9))
    best = best.groupBy("doc_id", "doc_key", "item_id", F.col("width").cast("long").alias("words")).agg(
        F.max(F.struct(F.col("best.matched").alias("matched"), (F.col("best.at") - F.col("shift")).alias("at"))).alias("b")
    )
    return best.select("doc_id", "item_id", "words", F.col("b.matched").cast("long").alias("matched"), F.greatest(-F.col("b.at"), F.lit(0)).cast("long").alias("start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without leaks, all columns kept. A null id never matches, so such rows are judged by text alone and stay."""
    found = materialize(leaks(docs, benchmark, **options).select("doc_id").distinct(), "leaks")
    return docs.join(found, "doc_id", "left_anti")
