"""Grouped aggregation over an entity key: fused, two-level and last-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from riskloom.functions.aggregates import named_aggs, stat

# Time per expression grows beyond this width (generated methods outgrow the JIT), so wider
# requests run as several groupings whose outputs are already partitioned alike.
MAX_WIDTH = 100


def _chunks(exprs: Sequence[Column], width: int) -> list[list[Column]]:
    return [list(exprs[i : i + width]) for i in range(0, len(exprs), width)]


def join_on_keys(blocks: Sequence[DataFrame], keys: Sequence[str], how: str = "left") -> DataFrame:
    return reduce(lambda a, b: a.join(b, list(keys), how), blocks)


def fused_group_agg(
    df: DataFrame,
    keys: Sequence[str],
    hashed: Sequence[Column],
    sorted_aggs: Sequence[Column] = (),
    distinct_aggs: Sequence[Column] = (),
    max_width: int = MAX_WIDTH,
) -> DataFrame:
    """Every feature family over ``keys`` with as few groupings as their buffers allow.

    ``hashed`` are fixed-width aggregates and share hash groupings. ``sorted_aggs`` and
    ``distinct_aggs`` would turn a whole grouping into a sort or an expand, so each kind gets its
    own narrow one. The blocks hold the same keys and the same hash partitioning, so joining them
    moves no rows. Rows with a NULL key form no group.
    """
    present = df.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    blocks = [*_chunks(hashed, max_width), list(sorted_aggs), list(distinct_aggs)]
    return join_on_keys([present.groupBy(*keys).agg(*b) for b in blocks if b], keys)


def global_stats(df: DataFrame, exprs: Sequence[Column], max_width: int = MAX_WIDTH) -> dict:
    """One row of whole-table aggregates as a dict, in scans that read only their own columns."""
    out: dict = {}
    for block in _chunks(exprs, max_width):
        row: Row = df.agg(*block).first()
        out.update(row.asDict())
    return out


def category_values(df: DataFrame, cols: Sequence[str], max_values: int = 2000) -> dict[str, list[str]]:
    """Sorted distinct non-null values per text column.

    They name output columns, so more than ``max_values`` in one column is an error that names it, never a
    cut-off; nothing is collected before all columns are known to be within it.
    """
    if not cols:
        return {}
    long = df.select(*(F.col(c).cast("string").alias(c) for c in cols)).unpivot([], list(cols), "col", "val")
    values = long.where(F.col("val").isNotNull()).distinct()
    wide = values.groupBy("col").count().where(F.col("count") > max_values).collect()
    if wide:
        raise ValueError(f"more than {max_values} category values in {sorted(r['col'] for r in wide)}; pass the values to keep")
    found = values.collect()
    return {c: sorted(r["val"] for r in found if r["col"] == c) for c in cols}


def two_level_rollup(
    df: DataFrame,
    keys: Sequence[str],
    sub_keys: Sequence[str],
    inner: Mapping[str, tuple[str, str]],
    stats: Sequence[str] = ("mean", "max", "std"),
) -> DataFrame:
    """Aggregate per sub-entity, then summarise the sub-entities of each entity."""
    per_sub = df.dropna(subset=[*keys, *sub_keys]).groupBy(*keys, *sub_keys).agg(*named_aggs(inner))
    outer = [stat(s, F.col(c)).alias(f"{c}_{s.upper()}") for c in inner for s in stats]
    return fused_group_agg(per_sub, keys, outer)


def newest_rows(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str], k: int, rank: str = "_rn"
) -> DataFrame:
    """The ``k`` newest rows of each group, numbered from 1.

    The filter on the row number lets Spark cut every group to ``k`` rows inside each map task
    (WindowGroupLimit), so a hot group shuffles ``k`` rows per task and not its whole history.
    """
    order = [F.col(time).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in ties)]
    numbered = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(rank) <= k)


def last_k(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str],
    spec: Mapping[str, tuple[str, str]],
    ks: Sequence[int],
    prefix: str,
) -> DataFrame:
    """The statistics of ``spec`` over the newest k rows of each group, for every k."""
    used = list(dict.fromkeys([*keys, time, *ties, *(c for c, _ in spec.values())]))
    newest = newest_rows(df.dropna(subset=list(keys)).select(*used), keys, time, ties, max(ks))
    exprs = [
        stat(s, F.when(F.col("_rn") <= k, F.col(c))).alias(f"{prefix}{k}_{new}")
        for k in ks
        for new, (c, s) in spec.items()
    ]
    return fused_group_agg(newest, keys, exprs)
