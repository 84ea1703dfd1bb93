"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.llm.native import word_count
from riskloom.session import materialize


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """Target size of every source, from ``(source, source_size)``.

    Sources in code-point order, null last, take ``weights`` in turn. They share ``share`` of all
    sizes by weight; no target passes ``max_epochs`` times its source, and what is cut off goes to
    the others by weight until none is above. With sources in order of cap over weight, the common
    rate is the largest of (total - caps before) / (weights from here on), so no loop is needed.

    One row per source passes through the windows; documents never do.
    """
    listed = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy((F.col("cap") / F.col("weight")), "place")
    total = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    turn = F.array(*map(F.lit, weights))
    return (
        sizes.withColumn("place", F.row_number().over(listed))
        .withColumn("weight", F.element_at(turn, (F.col("place") - 1) % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("budget", F.sum("source_size").over(total) * F.lit(float(share)))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("rate", F.max((F.col("budget") - F.col("before")) / F.col("open_weight")).over(total))
        .select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("rate")).alias("target"))
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.0,
    max_epochs: int = 3,
    seed: str = "mix",
    size: Column | None = None,
    slot_digits: int = 3,
) -> DataFrame:
    """How many tokens of every document the mix takes: ``doc_id, source, size, source_size, target, taken``.

    A document's key is the MD5 of seed and id: random, but the same in every run. The first hex
    digits of the key cut each source into ``16 ** slot_digits`` key ranges of like size, so a
    source that holds most rows still spreads over all tasks. Tokens are summed inside each range
    in key order, and over the ranges of a source; the two sums place each document on its
    source's number line. Whole epochs take every document; the rest of the budget is cut off at
    its exact token, inside a document if it falls there.

    Null text has size 0; null sources form one source; repeated rows count as often as they
    occur; rows that tie in key are alike and share the cut in any order. An empty table gives an
    empty result. Other columns are ignored.
    """
    sized = docs.select(
        "doc_id", "source", (word_count(F.col("text")) if size is None else size).alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("key"),
    ).withColumn("slot", F.substring("key", 1, slot_digits))
    sized = materialize(sized, "mix-sizes")
    slots = sized.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    targets = source_targets(slots.groupBy("source").agg(F.sum("slot_size").alias("source_size")), weights, share, max_epochs)
    before = slots.withColumn("slot_before", F.sum("slot_size").over(W.partitionBy("source").orderBy("slot")) - F.col("slot_size"))
    offsets = before.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select(
        F.col("b.source").alias("slot_source"), F.col("b.slot").alias("slot_key"), "slot_before", "source_size", "target"
    )
    inside = W.partitionBy("source", "slot").orderBy("key", F.col("doc_id").asc_nulls_first(), "size")
    placed = sized.withColumn("in_slot", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
    budget, whole = F.floor("target"), F.col("source_size")
    epochs = F.when(whole > 0, F.floor(budget / whole)).otherwise(F.lit(0))
    rest = budget - epochs * whole - (F.col("slot_before") + F.col("in_slot"))
    return (
        placed.join(offsets, F.col("source").eqNullSafe(F.col("slot_source")) & (F.col("slot") == F.col("slot_key")))
        .select("doc_id", "source", "size", "source_size", "target",
                (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))).cast("long").alias("taken"))
    )


MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5('mix:' || doc_id) AS key FROM documents
), src AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
), weighed AS (
    SELECT *, 3 * source_size AS cap, [5, 2, 1][1 + (place - 1) % 3] AS weight, (SELECT sum(source_size) FROM src)::DOUBLE AS budget FROM src
), rates AS (
    SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
              / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS rate FROM weighed
), targets AS (
    SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT max(rate) FROM rates)) AS target FROM rates
), placed AS (
    SELECT s.doc_id, s.source, s.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
           (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS UNBOUNDED PRECEDING))::BIGINT - s.size AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
             + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM placed
"""
