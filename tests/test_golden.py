"""Hand-made rows for the cases the given tables do not hold: nulls, ties, edges, empty groups."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import aggregates as A
from riskloom.functions import exprs as X
from riskloom.operators import encoding as E
from riskloom.operators import ranking as R
from riskloom.operators.grouping import category_values, fused_group_agg, last_k, two_level_rollup
from riskloom.operators.selection import constant_columns, correlations, narrow_types
from riskloom.plans import children as C


def rows(df, key="g"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def gappy(spark):
    return spark.createDataFrame([(1, -1, None), (1, -2, 5.0), (2, -1, None), (2, -2, None), (3, -1, 1.0)], "g int, t int, v double")


def test_profile_of_nulls(gappy):
    out = rows(fused_group_agg(gappy, ["g"], A.numeric_profile(["v"], "P")))
    assert [out[g]["P_v_SUM"] for g in (1, 2, 3)] == [5.0, 0.0, 1.0]
    assert [out[g]["P_v_MAX"] for g in (1, 2, 3)] == [5.0, None, 1.0]
    assert [out[g]["P_v_MEAN"] for g in (1, 2, 3)] == [5.0, None, 1.0]
    assert [out[g]["P_v_VAR"] for g in (1, 2, 3)] == [None, None, None]


def test_null_key_forms_no_group(spark):
    df = spark.createDataFrame([(None, 1.0), (1, 2.0)], "g int, v double")
    assert rows(fused_group_agg(df, ["g"], [A.row_count("n")])) == {1: {"g": 1, "n": 1}}


def test_latest_is_first_non_null_per_column(gappy):
    out = rows(fused_group_agg(gappy, ["g"], [], A.latest_values(["v"], "t", [], "LAST")))
    assert [out[g]["LAST_v"] for g in (1, 2, 3)] == [5.0, None, 1.0]


def test_window_edge_is_inclusive_and_empty_is_null(spark):
    df = spark.createDataFrame(
        [(1, -181, 1.0), (1, -180, 2.0), (1, -179, 4.0), (2, -181, 1.0), (3, -10, None)], "g int, t int, v double"
    )
    out = rows(fused_group_agg(df, ["g"], A.trailing_window(["v"], "t", -180, "W")))
    assert (out[1]["W_v_SUM"], out[1]["W_v_MEAN"], out[1]["W_COUNT"]) == (6.0, 3.0, 2)
    assert set(out[2].values()) == {2, None}
    assert (out[3]["W_v_SUM"], out[3]["W_v_MEAN"], out[3]["W_COUNT"]) == (0.0, None, 1)


def test_trend(spark):
    data = [(1, 0, 1.0), (1, 1, 2.0)]
    data += [(2, 0, 1.0), (2, 1, 3.0), (2, 2, 5.0)]
    data += [(3, 4, 1.0), (3, 4, 2.0), (3, 4, 3.0)]
    data += [(4, 0, 1.0), (4, 1, None), (4, 2, 2.0)]
    out = rows(fused_group_agg(spark.createDataFrame(data, "g int, t int, v double"), ["g"], [A.trend("v", "t", "P")]))
    assert out[1]["P_v_TREND"] is None and out[4]["P_v_TREND"] is None
    assert out[2]["P_v_TREND"] == pytest.approx(2.0, abs=1e-6)
    assert out[3]["P_v_TREND"] == pytest.approx(0.0, abs=1e-6)


def test_decayed_mean(spark):
    df = spark.createDataFrame([(1, 0, 10.0), (1, -1000, 0.0), (1, None, 99.0), (2, -1, None)], "g int, t int, v double")
    out = rows(fused_group_agg(df, ["g"], A.decayed_means(["v"], "t", "P", 0.001)))
    assert out[1]["P_v_TWMEAN"] == pytest.approx(10 / (1 + math.exp(-1)))
    assert out[2]["P_v_TWMEAN"] is None


def test_last_k(spark):
    df = spark.createDataFrame([(1, -t, float(t), t) for t in range(1, 5)], "g int, t int, v double, id int")
    out = rows(last_k(df, ["g"], "t", ["id"], {"MEAN": ("v", "mean"), "MAX": ("v", "max")}, (3, 10), "L"))
    assert (out[1]["L3_MEAN"], out[1]["L3_MAX"], out[1]["L10_MEAN"], out[1]["L10_MAX"]) == (2.0, 3.0, 2.5, 4.0)


def test_last_k_cuts_hot_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS g", "CAST(id AS INT) AS t", "CAST(id AS DOUBLE) AS v", "id")
    out = last_k(df, ["g"], "t", ["id"], {"MEAN": ("v", "mean")}, (3,), "L")
    plan = out._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning(g", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    assert sorted(r["L3_MEAN"] for r in out.collect()) == [996.0, 997.0]


def test_onehot_shares_sum_to_one(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, "y")], "g int, c string")
    out = rows(fused_group_agg(df, ["g"], A.onehot_means("c", category_values(df, ["c"])["c"], "P")))
    assert out[1] == {"g": 1, "P_c_x": 0.5, "P_c_y": 0.0, "P_c_nan": 0.5}
    assert out[2] == {"g": 2, "P_c_x": 0.0, "P_c_y": 1.0, "P_c_nan": 0.0}


def test_too_many_categories_is_an_error(spark):
    df = spark.range(30).selectExpr("CAST(id AS STRING) AS c")
    with pytest.raises(ValueError, match="more than 10"):
        category_values(df, ["c"], 10)


def test_segment_counts_and_share(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, None, 3.0), (2, "b", 1.0)], "g int, s string, v double")
    pred = F.coalesce(F.col("s") == "a", F.lit(False))
    out = rows(fused_group_agg(df, ["g"], [*A.segment_aggs(pred, ["v"], "S", ("sum",)), A.segment_share(F.col("s") == "a", "share"), A.rate(F.col("s") == "a", "rate")]))
    assert (out[1]["S_v_SUM"], out[1]["S_COUNT"], out[1]["share"], out[1]["rate"]) == (2.0, 1, 0.5, 0.5)
    assert (out[2]["S_v_SUM"], out[2]["S_COUNT"], out[2]["share"], out[2]["rate"]) == (None, None, None, 0.0)


def test_two_level(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (1, 2, 9.0), (2, 3, None)], "g int, s int, v double")
    out = rows(two_level_rollup(df, ["g"], ["s"], {"M": ("v", "mean"), "N": ("v", "size")}))
    assert (out[1]["M_MEAN"], out[1]["M_MAX"], out[1]["N_MEAN"]) == (6.0, 9.0, 1.5)
    assert (out[2]["M_MEAN"], out[2]["M_STD"], out[2]["N_MAX"]) == (None, None, 1)


def one(spark, sql_values, expr):
    return spark.sql(f"SELECT * FROM VALUES {sql_values}").select(expr.alias("x")).collect()


def test_ratio_by_zero_is_null(spark):
    assert [r.x for r in one(spark, "(2D, -1D), (2D, 1D), (NULL, 1D) AS t(a, b)", X.ratio("a", "b"))] == [None, 1.0, None]


def test_positive_part(spark):
    got = one(spark, "(CAST(NULL AS INT), 5), (3, 5), (7, 5) AS t(a, b)", X.positive_part("a", "b"))
    assert [r.x for r in got] == [None, 0.0, 2.0]


def test_bins_are_right_closed(spark):
    got = one(spark, "(0D), (25D), (25.1D), (100D), (101D), (CAST(NULL AS DOUBLE)) AS t(a)", X.bucketize("a", (0, 25, 30, 100)))
    assert [r.x for r in got] == [None, 0, 2 - 1, 2, None, None]


def test_cross_keeps_nulls_as_text(spark):
    got = one(spark, "(CAST(NULL AS STRING), 'X'), ('a', 'b') AS t(a, b)", X.category_cross("a", "b"))
    assert [r.x for r in got] == ["nan__X", "a__b"]


def test_row_statistics(spark):
    sql = "(1D, 2D, CAST(NULL AS DOUBLE)), (3D, NULL, NULL), (NULL, NULL, NULL) AS t(a, b, c)"
    cols = ("a", "b", "c")
    assert [r.x for r in one(spark, sql, X.row_mean(cols))] == [1.5, 3.0, None]
    assert [r.x for r in one(spark, sql, X.row_std(cols))] == [pytest.approx(math.sqrt(0.5)), None, None]
    assert [r.x for r in one(spark, sql, X.row_null_count(cols))] == [1, 2, 3]
    assert [r.x for r in one(spark, sql, X.row_sum(cols))] == [3.0, 3.0, 0.0]


def test_cleaned_names_must_stay_apart():
    assert X.clean_names(["a b", "c/d", "e"]) == ["a_b", "c_d", "e"]
    with pytest.raises(ValueError, match="a_b"):
        X.clean_names(["a b", "a/b"])


def test_target_encoding_falls_back_to_the_mean(spark):
    data = [(i, "big" if i < 8 else "rare", float(i % 2), i % 2, True) for i in range(10)] + [(10, "new", None, 0, False), (11, None, None, 0, False)]
    df = spark.createDataFrame(data, "id int, c string, y double, fold int, is_train boolean")
    out = rows(E.target_encode(df, ["c"], "y", "fold", F.col("is_train"), 2, 4), "id")
    assert {out[i]["c_TE"] for i in (8, 9, 10, 11)} == {0.5}
    # Fold 0 holds the even ids, all with label 0; it is encoded by fold 1, four rows of label 1.
    assert out[0]["c_TE"] == pytest.approx((4 + 2 * 0.5) / (4 + 2)) and out[1]["c_TE"] == pytest.approx((0 + 2 * 0.5) / 6)


def test_oof_encoding_ignores_own_fold_labels(spark):
    base = [(i, "k", float(i % 3 == 0), i % 2, True) for i in range(40)]
    flipped = [(i, c, 1 - y if f == 0 else y, f, t) for i, c, y, f, t in base]
    enc = []
    for data in (base, flipped):
        df = spark.createDataFrame(data, "id int, c string, y double, fold int, is_train boolean")
        # With no smoothing the global mean plays no part.
        enc.append(rows(E.target_encode(df, ["c"], "y", "fold", F.col("is_train"), 0, 1), "id")[0]["c_TE"])
    assert enc[0] == enc[1]


def test_rank_and_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.1, 0), (2, 0.5, 1), (3, 0.5, 0), (4, 0.9, 1), (5, None, 1)], "g int, s double, y int")
    out = rows(R.rank_norm(df, "s", "r"))
    assert [out[g]["r"] for g in range(1, 6)] == [0.25, 0.625, 0.625, 1.0, None]
    assert R.auc_value(df, "s", "y") == pytest.approx(3.5 / 4)
    assert R.auc_value(df.withColumn("s", -F.col("s")), "s", "y") == pytest.approx(1 - 3.5 / 4)


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, None, 5, 1), (1, None, None, 2)], "a int, b int, c int, d int")
    assert constant_columns(df, df.columns) == ["a", "b"]


def test_correlation_is_pairwise_complete(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)), columns=list("abc"))
    pdf["d"] = pdf["a"] * 2
    pdf = pdf.mask(rng.random(pdf.shape) < 0.3)
    want = pdf.corr().to_numpy()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, d double")
    for r in correlations(df.repartition(5), df.columns).collect():
        assert r["corr"] == pytest.approx(want[r["i"], r["j"]], abs=1e-9)


def test_narrowing(spark):
    df = spark.createDataFrame([(127, 40000, 1 << 40, 1.5)], "a long, b long, c long, d double")
    assert [f.dataType.simpleString() for f in narrow_types(df).schema] == ["tinyint", "int", "bigint", "float"]
    assert [f.dataType.simpleString() for f in narrow_types(df, 32).schema] == ["int", "int", "bigint", "float"]


def test_columns_do_not_depend_on_the_rows(spark):
    schema = "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE int, SK_DPD int, SK_DPD_DEF int, CNT_INSTALMENT double, CNT_INSTALMENT_FUTURE double, NAME_CONTRACT_STATUS string"
    values = {"NAME_CONTRACT_STATUS": ["Active", "Completed"]}
    full = C.pos_features(spark.createDataFrame([(1, 1, -1, 3, 0, 5.0, 4.0, "Active")], schema), values)
    none = C.pos_features(spark.createDataFrame([], schema), values)
    assert full.columns == none.columns and none.count() == 0
    row = full.first()
    assert row["POS_COUNT"] == 1 and row["POS_COMPLETED_RATE"] is None and row["POS_NAME_CONTRACT_STATUS_Active"] == 1.0
