"""Builders of aggregate expressions.

Each returns a list of aliased columns, so that any number of feature families over the same key
run in one grouping (``operators.grouping.fused_group_agg``). Only aggregates with fixed-width
buffers appear here: they combine on the map side in a hash table, so a key that holds a third of
the rows still reaches the shuffle as one partial row per task. Means are written as sum / count
so that a family asking for both shares the buffers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from riskloom.functions.exprs import decay_weight, flag

PROFILE_STATS = ("min", "max", "mean", "sum", "var")


def _mean(x: Column) -> Column:
    return F.try_divide(F.sum(x), F.count(x))


def _zero_sum(x: Column) -> Column:
    total = F.sum(x)
    return F.coalesce(total, F.lit(0).cast("int"))


_STATS = {
    "min": F.min,
    "max": F.max,
    "mean": _mean,
    "sum": _zero_sum,
    "var": F.var_samp,
    "std": F.stddev_samp,
    "count": F.count,
    "size": lambda x: F.count(F.lit(1)),
    "any": lambda x: flag(F.max(x) > 0),
}


def stat(name: str, x: Column) -> Column:
    """One named statistic over the non-null values; ``sum`` of no values is 0."""
    return _STATS[name](x)


def numeric_profile(cols: Sequence[str], prefix: str, stats: Sequence[str] = PROFILE_STATS) -> list[Column]:
    return [stat(s, F.col(c)).alias(f"{prefix}_{c}_{s.upper()}") for c in cols for s in stats]


def named_aggs(spec: Mapping[str, tuple[str, str]]) -> list[Column]:
    """``{new_name: (column, statistic)}``."""
    return [stat(s, F.col(c)).alias(new) for new, (c, s) in spec.items()]


def row_count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def rate(pred: Column, name: str) -> Column:
    """Share of rows on which the predicate holds; NULL counts as not holding."""
    return F.avg(flag(pred)).alias(name)


def category_counts(col: str, values: Sequence[str], prefix: str) -> list[Column]:
    """One count column per category value, 0 when absent (A5)."""
    return [F.count_if(F.col(col) == F.lit(v)).alias(f"{prefix}_{v}") for v in values]


def onehot_means(col: str, values: Sequence[str], prefix: str) -> list[Column]:
    """Share of the group's rows per category value, NULL being a category of its own."""
    shares = [F.avg((F.col(col).eqNullSafe(F.lit(v))).cast("double")).alias(f"{prefix}_{col}_{v}") for v in values]
    return [*shares, F.avg(F.col(col).isNull().cast("double")).alias(f"{prefix}_{col}_nan")]


def segment_aggs(
    segment: Column, cols: Sequence[str], prefix: str, stats: Sequence[str]
) -> list[Column]:
    """Statistics restricted to the rows of a segment; all NULL when the group has none."""
    n = F.count_if(segment)
    out = [
        F.when(n > 0, stat(s, F.when(segment, F.col(c)))).alias(f"{prefix}_{c}_{s.upper()}")
        for c in cols
        for s in stats
    ]
    return [*out, F.nullif(n, F.lit(0).cast("long")).alias(f"{prefix}_COUNT")]


def trailing_window(cols: Sequence[str], time: str, cutoff: float, prefix: str) -> list[Column]:
    """Mean, max and sum over rows with ``time >= cutoff``, plus the row count."""
    return segment_aggs(F.col(time) >= F.lit(cutoff), cols, prefix, ("mean", "max", "sum"))


def trailing_windows(
    cols: Sequence[str], time: str, cutoffs: Mapping[str, float], prefix: str
) -> list[Column]:
    return [e for label, cut in cutoffs.items() for e in trailing_window(cols, time, cut, f"{prefix}_{label}")]


def decayed_means(cols: Sequence[str], time: str, prefix: str, decay: float = 0.002) -> list[Column]:
    """Mean weighted by ``exp(decay * time)`` over rows where value and time are present (A10)."""
    w = decay_weight(time, decay)
    return [
        F.try_divide(F.sum(F.col(c) * w), F.sum(F.when(F.col(c).isNotNull(), w))).alias(f"{prefix}_{c}_TWMEAN")
        for c in cols
    ]


def trend(col: str, time: str, prefix: str, min_rows: int = 3) -> Column:
    """Least-squares slope over complete rows, 0 without time variance, NULL below ``min_rows``."""
    v, t = F.col(col).cast("double"), F.col(time).cast("double")
    slope = F.regr_sxy(v, t) / (F.regr_sxx(v, t) + F.lit(1e-8))
    return F.when(F.regr_count(v, t) >= min_rows, slope).alias(f"{prefix}_{col}_TREND")


def latest_values(cols: Sequence[str], time: str, ties: Sequence[str], prefix: str) -> list[Column]:
    """Per column, its value on the newest dated row where it is present.

    The ordering key is a struct, which Spark aggregates by sorting; pass these as ``sorted_aggs``.
    """

    def newest(c: str) -> Column:
        dated = F.col(c).isNotNull() & F.col(time).isNotNull()
        return F.max_by(c, F.when(dated, F.struct(time, *ties, F.col(c).alias("v"))))

    return [newest(c).alias(f"{prefix}_{c}") for c in cols]


def segment_share(segment: Column, name: str) -> Column:
    """Rows of the segment over all rows; NULL, not 0, when there are none."""
    n = F.count_if(segment)
    return F.when(n > 0, n / F.count(F.lit(1))).alias(name)


def score_rollup(score: str, prefix: str, threshold: float = 0.15) -> list[Column]:
    """Per-entity summary of row-level scores and the count above the threshold."""
    stats = [stat(s, F.col(score)).alias(f"{prefix}_SUB_{s.upper()}") for s in ("mean", "max", "min", "std")]
    return [*stats, F.count_if(F.col(score) > threshold).alias(f"{prefix}_SUB_HIGHRISK")]
