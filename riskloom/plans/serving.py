"""Queries over the score table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.exprs import risk_band

KEY, SCORE = "SK_ID_CURR", "TARGET"


def describe(scores: DataFrame) -> DataFrame:
    """Every client's rounded score, band and decision. A blended score is a rank, so 0.5 means the
    upper half of the portfolio and not a default probability."""
    return scores.select(
        KEY, F.round(SCORE, 6).alias("score"), risk_band(SCORE).alias("risk_label"), (F.col(SCORE) >= 0.5).alias("will_default")
    )


def predict(scores: DataFrame, client: int) -> DataFrame:
    """One client's row; an unknown client is an error."""
    found = describe(scores.where(F.col(KEY) == client))
    if found.isEmpty():
        raise KeyError(f"client {client} has no score")
    return found


def portfolio_stats(scores: DataFrame) -> DataFrame:
    s = F.col(SCORE)
    return scores.agg(
        F.count(F.lit(1)).alias("total_clients"),
        F.round(F.avg(s), 6).alias("mean_score"),
        F.count_if(s >= 0.5).alias("high_risk_count"),
        F.round(F.avg((s >= 0.5).cast("double")) * 100, 2).alias("high_risk_pct"),
        F.count_if(s >= 0.70).alias("very_high"),
        F.count_if((s >= 0.50) & (s < 0.70)).alias("high"),
        F.count_if((s >= 0.30) & (s < 0.50)).alias("medium"),
        F.count_if(s < 0.30).alias("low"),
    )
