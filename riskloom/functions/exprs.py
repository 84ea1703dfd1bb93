"""Row-level column expressions (P1-P26). NULL is the only missing value they produce."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The marker that day columns use for "unknown", the fill text of an encoded null,
# the text of a null inside a category cross, and the fill number of a null before modelling.
DAYS_UNKNOWN = 365243
NULL_CATEGORY = "__nan__"
NULL_TEXT = "nan"
NULL_NUMBER = -999.0

# Lower bound of the score, label.
RISK_BANDS = ((0.70, "Very High Risk"), (0.50, "High Risk"), (0.30, "Medium Risk"))
LOWEST_BAND = "Low Risk"

Name = str | Column


def _c(x: Name) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num: Name, den: Name, eps: float = 1.0) -> Column:
    """``num / (den + eps)``; NULL where the denominator is zero."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double") + F.lit(float(eps)))


def flag(pred: Column) -> Column:
    """1/0 from a predicate, with NULL counted as false."""
    return F.coalesce(pred.cast("int"), F.lit(0))


def square(x: Name) -> Column:
    return _c(x) * _c(x)


def cube(x: Name) -> Column:
    return _c(x) * _c(x) * _c(x)


def log1p_abs(x: Name) -> Column:
    return F.log1p(F.abs(_c(x)).cast("double"))


def days_to_years(x: Name) -> Column:
    return _c(x) / F.lit(-365.25)


def positive_part(a: Name, b: Name) -> Column:
    """``max(a - b, 0)``, NULL when either side is NULL."""
    diff = _c(a) - _c(b)
    return F.when(diff.isNotNull(), F.greatest(diff, F.lit(0).cast("double")))


def weighted_sum(terms: Sequence[tuple[float, Name]]) -> Column:
    return reduce(add, (F.lit(float(w)) * _c(x) for w, x in terms))


def decay_weight(t: Name, decay: float) -> Column:
    return F.exp(F.lit(float(decay)) * _c(t).cast("double"))


# --- across the columns of a row (P7-P10) -------------------------------------------------------

def _present(cols: Sequence[Name]) -> Column:
    return reduce(add, (_c(c).isNotNull().cast("int") for c in cols))


def _total(cols: Sequence[Name]) -> Column:
    return reduce(add, (F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols))


def row_mean(cols: Sequence[Name]) -> Column:
    return F.try_divide(_total(cols), _present(cols))


def row_std(cols: Sequence[Name]) -> Column:
    """Sample standard deviation of the values present; NULL for fewer than two."""
    mean, n = row_mean(cols), _present(cols)
    squares = reduce(
        add, (F.coalesce(square(_c(c).cast("double") - mean), F.lit(0.0)) for c in cols)
    )
    return F.when(n >= 2, F.sqrt(F.try_divide(squares, n - 1)))


def row_min(cols: Sequence[Name]) -> Column:
    return F.least(*map(_c, cols))


def row_max(cols: Sequence[Name]) -> Column:
    return F.greatest(*map(_c, cols))


def row_null_count(cols: Sequence[Name]) -> Column:
    return reduce(add, (_c(c).isNull().cast("int") for c in cols), F.lit(0))


def row_sum(cols: Sequence[Name]) -> Column:
    """Sum with text coerced to numbers; unusable values, and an empty list, count as 0."""
    return reduce(add, (F.coalesce(to_number(c), F.lit(0.0)) for c in cols), F.lit(0.0))


def matching(df: DataFrame, *, contains: str = "", prefix: str = "") -> list[str]:
    return [c for c in df.columns if contains in c and c.startswith(prefix)]


def optional(df: DataFrame, name: str, default: float = 0.0) -> Column:
    """The column when the table has it, otherwise a constant."""
    return F.col(name) if name in df.columns else F.lit(default)


# --- bins, categories, text ---------------------------------------------------------------------

def bucketize(x: Name, edges: Sequence[float]) -> Column:
    """Index of the right-closed bin ``(edges[i], edges[i+1]]``; NULL outside."""
    value = _c(x)
    out = F.when(value <= F.lit(float(edges[0])), F.lit(None).cast("int"))
    for i, upper in enumerate(edges[1:]):
        out = out.when(value <= F.lit(float(upper)), F.lit(i))
    return out


def category_cross(a: Name, b: Name) -> Column:
    left, right = (F.coalesce(_c(x).cast("string"), F.lit(NULL_TEXT)) for x in (a, b))
    return F.concat(left, F.lit("__"), right)


def to_number(x: Name) -> Column:
    return _c(x).try_cast("double")


def risk_band(score: Name) -> Column:
    value = _c(score)
    first, *rest = RISK_BANDS
    out = F.when(value >= first[0], first[1])
    for bound, label in rest:
        out = out.when(value >= bound, label)
    return out.otherwise(LOWEST_BAND)


# --- whole-table rewrites -----------------------------------------------------------------------

def sentinel_to_null(df: DataFrame, contains: str = "DAYS_", sentinel: float = DAYS_UNKNOWN) -> DataFrame:
    hit = set(matching(df, contains=contains))
    return df.select(
        *(F.when(F.col(c) != sentinel, F.col(c)).alias(c) if c in hit else F.col(c) for c in df.columns)
    )


def null_non_finite(df: DataFrame) -> DataFrame:
    """±infinity and NaN to NULL in every floating column (P15). NaN sorts above infinity."""

    def clean(field: T.StructField) -> str:
        c = f"`{field.name}`"
        floating = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        return f"CASE WHEN abs({c}) < double('infinity') THEN {c} END AS {c}" if floating else c

    return df.selectExpr(*map(clean, df.schema.fields))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def clean_names(columns: Sequence[str]) -> list[str]:
    """Replace runs of characters outside ``A-Za-z0-9_`` by one underscore; no two may meet."""
    cleaned = [re.sub(r"[^A-Za-z0-9_]+", "_", c) for c in columns]
    clash = sorted({c for c in cleaned if cleaned.count(c) > 1})
    if clash:
        raise ValueError(f"columns share a cleaned name: {clash}")
    return cleaned


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both tables have, in the order of the left one."""
    other = set(right.columns)
    return [c for c in left.columns if c in other]
