"""Faults that the SQL checks do not reach."""

import pytest
from pyspark.sql import functions as F

from riskloom.catalog.roles import role
from riskloom.operators.selection import correlations
from riskloom.plans import children
from riskloom.plans.ensemble import _content
from riskloom.session import materialize, scratch
from riskloom.sources.checkpoints import RunStore


def test_correlation_of_columns_that_start_with_nulls(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id > 600 THEN 1e9 + id END AS a", "CASE WHEN id > 600 THEN 2e9 + id END AS b").coalesce(1)
    assert [r["corr"] for r in correlations(df, ["a", "b"]).collect()] == [pytest.approx(1.0)]


def test_absent_optional_column_gives_null_columns(spark, small):
    pos = role(spark, small, "pos")
    full, without = children.pos_features(pos), children.pos_features(pos.drop("NAME_CONTRACT_STATUS"))
    assert "POS_COMPLETED_RATE" in without.columns and set(without.columns) <= set(full.columns)
    assert without.count() == full.count()


def test_other_data_does_not_resume_a_run(spark, tmp_path):
    a, b = spark.range(10).toDF("k"), spark.range(1, 11).toDF("k")
    roots = {RunStore(spark, str(tmp_path), {"data": _content(df)}).root for df in (a, a.repartition(3), b)}
    assert len(roots) == 2
    assert _content(a.union(a)) != _content(b.union(b))


def test_scratch_tables_go_at_the_end(spark):
    import os

    with scratch(spark) as path:
        assert materialize(spark.range(3).toDF("x"), "t").count() == 3
        assert os.listdir(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))
