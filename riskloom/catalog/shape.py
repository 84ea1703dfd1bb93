"""Rounding shared by the queries and their checks, so both sides end in comparable values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    def one(f: T.StructField):
        c = F.col(f"`{f.name}`")
        return (F.round(c, digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else c

    return df.select(*map(one, df.schema))


def rounded_sql(sql: str, doubles: Sequence[str], digits: int = 6) -> str:
    """Wrap a ``WITH ... SELECT`` so that the named columns are rounded alike."""
    replaced = ", ".join(f'round("{c}", {digits}) + 0.0 AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"
