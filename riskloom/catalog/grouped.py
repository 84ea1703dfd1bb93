"""Aggregation per entity and spine assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.roles import role, role_sql, table
from riskloom.catalog.shape import rounded, rounded_sql
from riskloom.functions import aggregates as A
from riskloom.functions.exprs import flag
from riskloom.operators import joins as J
from riskloom.operators.grouping import category_values, fused_group_agg, last_k, two_level_rollup
from riskloom.plans.children import balance_history

# Cut-offs of the trailing windows; the tightest leaves many clients and the last one all of them empty.
WINDOWS = {"6M": -180, "1Y": -365, "2Y": -730, "3Y": -1095, "5Y": -1825, "NONE": -100}


def numeric_profile(spark, root):
    loans = role(spark, root, "loans").withColumns({c: F.col(c) / 100000 for c in ("amount", "gappy")})
    out = fused_group_agg(loans, ["client"], [*A.numeric_profile(["amount", "gappy", "gappy_t"], "LN"), A.row_count("LN_COUNT")])
    return rounded(out.withColumn("LN_gappy_t_VAR", F.col("LN_gappy_t_VAR") / 1000000), 11)


PROFILE_SQL = rounded_sql(
    role_sql("loans")
    + ", k AS (SELECT client, amount / 100000 AS amount, gappy / 100000 AS gappy, gappy_t FROM loans) SELECT client, "
    + ", ".join(
        f"min({c}) AS LN_{c}_MIN, max({c}) AS LN_{c}_MAX, avg({c}) AS LN_{c}_MEAN, {s} AS LN_{c}_SUM, var_samp({c}){d} AS LN_{c}_VAR"
        for c, s, d in (("amount", "sum(amount)", ""), ("gappy", "coalesce(sum(gappy), 0)", ""), ("gappy_t", "CAST(coalesce(sum(gappy_t), 0) AS BIGINT)", " / 1000000"))
    )
    + ", count(*) AS LN_COUNT FROM k GROUP BY client",
    [f"LN_{c}_{s}" for c in ("amount", "gappy") for s in ("MIN", "MAX", "MEAN", "SUM", "VAR")] + ["LN_gappy_t_MEAN", "LN_gappy_t_VAR"],
    11,
)


def distinct_and_ever(spark, root):
    loans = role(spark, root, "loans")
    return fused_group_agg(
        loans, ["client"],
        A.named_aggs({"n_gappy": ("gappy", "count"), "n_rows": ("gappy", "size")})
        + [flag(F.max("amount") > 250000).alias("big_ever"), F.count_if(F.col("amount") > 100000).alias("n_big"),
           F.count_if(F.col("gappy").isNotNull() & F.col("gappy_t").isNotNull()).alias("n_complete")],
        distinct_aggs=[F.count_distinct("gappy_priority").alias("n_priorities")],
    )


DISTINCT_SQL = role_sql("loans") + """
SELECT client, count(gappy) AS n_gappy, count(*) AS n_rows, CASE WHEN max(amount) > 250000 THEN 1 ELSE 0 END AS big_ever,
       count(*) FILTER (WHERE amount > 100000) AS n_big,
       (SELECT count(*) FROM loans x WHERE x.client = l.client AND x.gappy IS NOT NULL AND x.gappy_t IS NOT NULL) AS n_complete,
       count(DISTINCT gappy_priority) AS n_priorities
FROM loans l GROUP BY client"""


def pivot_count(spark, root):
    return role(spark, root, "bureau").select("SK_ID_CURR", "SK_ID_BUREAU").join(
        balance_history(role(spark, root, "bureau_balance"), ["A", "N", "R", "Z"]), "SK_ID_BUREAU", "left"
    )


PIVOT_SQL = role_sql("bureau", "bureau_balance") + """,
c AS (SELECT SK_ID_BUREAU, STATUS, count(*) AS n FROM bureau_balance GROUP BY 1, 2),
m AS (SELECT SK_ID_BUREAU, min(MONTHS_BALANCE) AS lo, max(MONTHS_BALANCE) AS hi, count(*) AS n FROM bureau_balance GROUP BY 1)
SELECT b.SK_ID_CURR, b.SK_ID_BUREAU, m.lo AS BB_MONTHS_MIN, m.hi AS BB_MONTHS_MAX, m.n AS BB_MONTHS_SIZE,
""" + ", ".join(
    f"CASE WHEN m.n IS NOT NULL THEN coalesce((SELECT n FROM c WHERE c.SK_ID_BUREAU = b.SK_ID_BUREAU AND c.STATUS = '{v}'), 0) END AS \"BB_STATUS_{v}\""
    for v in "ANRZ"
) + " FROM bureau b LEFT JOIN m ON b.SK_ID_BUREAU = m.SK_ID_BUREAU"


def onehot_mean(spark, root):
    loans = role(spark, root, "loans")
    values = category_values(loans, ["gappy_priority", "status"])
    return rounded(fused_group_agg(loans, ["client"], [e for c, v in values.items() for e in A.onehot_means(c, v, "LN")]))


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_SHARES = [("gappy_priority", v) for v in _PRIORITIES] + [("gappy_priority", None)] + [("status", v) for v in "FOP"] + [("status", None)]
ONEHOT_SQL = rounded_sql(
    role_sql("loans")
    + ", n AS (SELECT client, count(*) AS n FROM loans GROUP BY client) SELECT n.client, "
    + ", ".join(
        f"(SELECT count(*) FROM loans l WHERE l.client = n.client AND l.{c} {'IS NULL' if v is None else f"= '{v}'"}) / n.n AS \"LN_{c}_{v or 'nan'}\""
        for c, v in _SHARES
    )
    + " FROM n",
    [f"LN_{c}_{v or 'nan'}" for c, v in _SHARES],
)


def segment_agg(spark, root):
    loans = role(spark, root, "loans")
    exprs = [
        e for v in ("F", "P", "none")
        for e in A.segment_aggs(F.col("status") == v, ["amount", "gappy"], f"LN_{v}", ("mean", "sum", "max", "min"))
    ]
    return rounded(fused_group_agg(loans, ["client"], exprs), 5)


def _segment_cols(v):
    return [f"LN_{v}_{c}_{s}" for c in ("amount", "gappy") for s in ("MEAN", "SUM", "MAX", "MIN")]


SEGMENT_SQL = rounded_sql(
    role_sql("loans")
    + ", ids AS (SELECT DISTINCT client FROM loans), "
    + ", ".join(
        f"s{v} AS (SELECT client, "
        + ", ".join(f"avg({c}) AS LN_{v}_{c}_MEAN, coalesce(sum({c}), 0) AS LN_{v}_{c}_SUM, max({c}) AS LN_{v}_{c}_MAX, min({c}) AS LN_{v}_{c}_MIN" for c in ("amount", "gappy"))
        + f", count(*) AS LN_{v}_COUNT FROM loans WHERE status = '{v}' GROUP BY client)"
        for v in ("F", "P", "none")
    )
    + " SELECT * FROM ids LEFT JOIN sF USING (client) LEFT JOIN sP USING (client) LEFT JOIN snone USING (client)",
    [c for v in ("F", "P", "none") for c in _segment_cols(v)],
    5,
)


def event_rate(spark, root):
    acts = role(spark, root, "activity")
    out = fused_group_agg(
        acts, ["client"],
        [A.rate(F.col("value") > 50, "high_rate"), A.rate(F.col("kind") == "click", "click_rate"),
         A.segment_share(F.col("kind") == "purchase", "purchase_share"), A.segment_share(F.col("kind") == "nothing", "nothing_share")],
    )
    return rounded(out)


EVENT_RATE_SQL = rounded_sql(
    role_sql("activity")
    + """, n AS (SELECT client, count(*) AS n FROM activity GROUP BY client),
h AS (SELECT client, count(*) AS k FROM activity WHERE value > 50 GROUP BY client),
c AS (SELECT client, count(*) AS k FROM activity WHERE kind = 'click' GROUP BY client),
p AS (SELECT client, count(*) AS k FROM activity WHERE kind = 'purchase' GROUP BY client)
SELECT n.client, coalesce(h.k, 0) / n.n AS high_rate, coalesce(c.k, 0) / n.n AS click_rate, p.k / n.n AS purchase_share, CAST(NULL AS DOUBLE) AS nothing_share
FROM n LEFT JOIN h USING (client) LEFT JOIN c USING (client) LEFT JOIN p USING (client)""",
    ["high_rate", "click_rate", "purchase_share", "nothing_share"],
)


def trailing_windows(spark, root):
    loans = role(spark, root, "loans")
    return rounded(fused_group_agg(loans, ["client"], A.trailing_windows(["gappy"], "t", WINDOWS, "LN")), 5)


TRAILING_SQL = rounded_sql(
    role_sql("loans")
    + ", ids AS (SELECT DISTINCT client FROM loans), "
    + ", ".join(
        f"w{k} AS (SELECT client, avg(gappy) AS LN_{k}_gappy_MEAN, max(gappy) AS LN_{k}_gappy_MAX, coalesce(sum(gappy), 0) AS LN_{k}_gappy_SUM, "
        f"count(*) AS LN_{k}_COUNT FROM loans WHERE t >= {cut} GROUP BY client)"
        for k, cut in WINDOWS.items()
    )
    + " SELECT * FROM ids " + " ".join(f"LEFT JOIN w{k} USING (client)" for k in WINDOWS),
    [f"LN_{k}_gappy_{s}" for k in WINDOWS for s in ("MEAN", "MAX", "SUM")],
    5,
)


def decayed_mean(spark, root):
    loans = role(spark, root, "loans")
    return rounded(fused_group_agg(loans, ["client"], A.decayed_means(["amount", "gappy"], "gappy_t", "LN", 0.001)), 5)


DECAY_SQL = rounded_sql(
    role_sql("loans")
    + """, ids AS (SELECT DISTINCT client FROM loans),
w AS (SELECT client, amount, gappy, exp(0.001 * gappy_t) AS w FROM loans WHERE gappy_t IS NOT NULL),
a AS (SELECT client, sum(amount * w) / sum(w) AS LN_amount_TWMEAN FROM w GROUP BY client),
g AS (SELECT client, sum(gappy * w) / sum(w) AS LN_gappy_TWMEAN FROM w WHERE gappy IS NOT NULL GROUP BY client)
SELECT * FROM ids LEFT JOIN a USING (client) LEFT JOIN g USING (client)""",
    ["LN_amount_TWMEAN", "LN_gappy_TWMEAN"],
    5,
)


def trend_slope(spark, root):
    loans = role(spark, root, "loans").select("client", "t", "gappy", "gappy_t", "amount")
    acts = role(spark, root, "activity").select((-F.col("client")).alias("client"), "t", F.col("value").alias("gappy"), F.col("t").alias("gappy_t"), F.col("value").alias("amount"))
    rows = loans.unionByName(acts)
    return rounded(fused_group_agg(rows, ["client"], [A.trend("gappy", "gappy_t", "LN"), A.trend("amount", "t", "LN")]), 5)


TREND_SQL = rounded_sql(
    role_sql("loans", "activity")
    + """, r AS (SELECT client, t, gappy, gappy_t, amount FROM loans UNION ALL SELECT -client, t, value, t, value FROM activity),
ids AS (SELECT DISTINCT client FROM r),
c AS (SELECT client, gappy AS v, CAST(gappy_t AS DOUBLE) AS t FROM r WHERE gappy IS NOT NULL AND gappy_t IS NOT NULL),
m AS (SELECT client, avg(v) AS mv, avg(t) AS mt FROM c GROUP BY client HAVING count(*) >= 3),
g AS (SELECT client, sum((t - mt) * (v - mv)) / (sum((t - mt) * (t - mt)) + 1e-8) AS LN_gappy_TREND FROM c JOIN m USING (client) GROUP BY client),
c2 AS (SELECT client, amount AS v, CAST(t AS DOUBLE) AS t FROM r WHERE amount IS NOT NULL),
m2 AS (SELECT client, avg(v) AS mv, avg(t) AS mt FROM c2 GROUP BY client HAVING count(*) >= 3),
a AS (SELECT client, sum((t - mt) * (v - mv)) / (sum((t - mt) * (t - mt)) + 1e-8) AS LN_amount_TREND FROM c2 JOIN m2 USING (client) GROUP BY client)
SELECT * FROM ids LEFT JOIN g USING (client) LEFT JOIN a USING (client)""",
    ["LN_gappy_TREND", "LN_amount_TREND"],
    5,
)

_PER_LOAN = {"LATE_MAX": ("dpd", "max"), "LATE_MEAN": ("dpd", "mean"), "LINES": ("line", "count"), "PRICE_SUM": ("price", "sum")}


def two_level(spark, root):
    pays = role(spark, root, "payments").withColumn("dpd", (F.col("paid") - F.col("due")).cast("double"))
    return rounded(two_level_rollup(pays, ["client"], ["loan"], _PER_LOAN), 7)


TWO_LEVEL_SQL = rounded_sql(
    role_sql("payments")
    + """, l AS (SELECT client, loan, CAST(max(paid - due) AS DOUBLE) AS LATE_MAX, avg(paid - due) AS LATE_MEAN, count(line) AS LINES, sum(price) AS PRICE_SUM
 FROM payments GROUP BY client, loan) SELECT client, """
    + ", ".join(f"avg({c}) AS {c}_MEAN, max({c}) AS {c}_MAX, stddev_samp({c}) AS {c}_STD" for c in _PER_LOAN)
    + " FROM l GROUP BY client",
    [f"{c}_{s}" for c in _PER_LOAN for s in ("MEAN", "MAX", "STD") if (c, s) != ("LINES", "MAX")],
    7,
)


def latest_snapshot(spark, root):
    loans = role(spark, root, "loans")
    return fused_group_agg(
        loans, ["client"], [A.row_count("n")], A.latest_values(["amount", "gappy", "gappy_priority"], "gappy_t", ["loan"], "LAST")
    )


LATEST_SQL = role_sql("loans") + ", ids AS (SELECT client, count(*) AS n FROM loans GROUP BY client) SELECT ids.client, n, " + ", ".join(
    f"(SELECT {c} FROM loans l WHERE l.client = ids.client AND {c} IS NOT NULL AND gappy_t IS NOT NULL ORDER BY gappy_t DESC, loan DESC LIMIT 1) AS LAST_{c}"
    for c in ("amount", "gappy", "gappy_priority")
) + " FROM ids"

_LAST_SPEC = {"DPD_MEAN": ("dpd", "mean"), "DPD_MAX": ("dpd", "max"), "PRICE_MEAN": ("price", "mean")}
_LAST_TIES = ["loan", "line", "part", "supp", "price", "discount", "paid"]
_LAST_KS = (3, 5, 10, 30)


def last_rows(spark, root):
    pays = role(spark, root, "payments").withColumn("dpd", (F.col("paid") - F.col("due")).cast("double"))
    return rounded(last_k(pays, ["client"], "due", _LAST_TIES, _LAST_SPEC, _LAST_KS, "LAST"), 5)


LAST_K_SQL = rounded_sql(
    role_sql("payments")
    + ", o AS (SELECT *, CAST(paid - due AS DOUBLE) AS dpd, row_number() OVER (PARTITION BY client ORDER BY due DESC, "
    + ", ".join(f"{c} DESC NULLS LAST" for c in _LAST_TIES)
    + ") AS rn FROM payments), "
    + ", ".join(
        f"k{k} AS (SELECT client, avg(dpd) AS LAST{k}_DPD_MEAN, max(dpd) AS LAST{k}_DPD_MAX, avg(price) AS LAST{k}_PRICE_MEAN FROM o WHERE rn <= {k} GROUP BY client)"
        for k in _LAST_KS
    )
    + " SELECT * FROM k3 JOIN k5 USING (client) JOIN k10 USING (client) JOIN k30 USING (client)",
    [f"LAST{k}_{s}" for k in _LAST_KS for s in _LAST_SPEC],
    5,
)


def spine_join(spark, root):
    cust = table(spark, root, "customer")
    train = cust.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("client"), flag(F.col("c_acctbal") < 0).alias("label"))
    test = cust.where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("client"))
    loans, pays = role(spark, root, "loans"), role(spark, root, "payments")
    # Not every client has an urgent loan, so the first and last block miss some.
    urgent = loans.where(F.col("priority") == "1-URGENT")
    seen, unseen = J.members(urgent, train, "client"), J.non_members(urgent, train, "client")
    labelled = J.attach_label(seen, train, "client", "label")
    blocks = [
        fused_group_agg(seen.unionByName(unseen), ["client"], [A.row_count("n_loans"), F.sum("amount").alias("total")]),
        fused_group_agg(pays, ["client"], [A.row_count("n_pays")]),
        fused_group_agg(labelled, ["client"], [F.sum("label").alias("label_rows")]),
    ]
    spine = J.attach_blocks(J.union_spine(train, test), blocks, "client")
    nations = table(spark, root, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").cast("double").alias("region"))
    return rounded(J.lookup(spine.withColumn("k", (F.col("client") % 25).cast("int")), nations, "k", "region", -1.0), 4)


SPINE_SQL = rounded_sql(
    role_sql("loans", "payments")
    + """, s AS (SELECT c_custkey AS client, CASE WHEN c_custkey % 4 <> 0 THEN CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END END AS label, c_custkey % 4 <> 0 AS is_train FROM customer),
a AS (SELECT client, count(*) AS n_loans, sum(amount) AS total FROM loans WHERE priority = '1-URGENT' GROUP BY client),
p AS (SELECT client, count(*) AS n_pays FROM payments GROUP BY client)
SELECT s.client, s.label, s.is_train, a.n_loans, a.total, p.n_pays,
       CASE WHEN s.is_train THEN CAST(a.n_loans * s.label AS BIGINT) END AS label_rows, CAST(s.client % 25 AS INT) AS k,
       coalesce((SELECT CAST(n_regionkey AS DOUBLE) FROM nation WHERE n_nationkey = s.client % 25 AND n_nationkey < 20), -1) AS region
FROM s LEFT JOIN a USING (client) LEFT JOIN p USING (client)""",
    ["total", "region"],
    4,
)

QUERIES = {
    "numeric_profile": numeric_profile, "distinct_and_ever": distinct_and_ever, "pivot_count": pivot_count,
    "onehot_mean": onehot_mean, "segment_agg": segment_agg, "event_rate": event_rate, "trailing_windows": trailing_windows,
    "decayed_mean": decayed_mean, "trend_slope": trend_slope, "two_level_rollup": two_level,
    "latest_snapshot": latest_snapshot, "last_k": last_rows, "spine_join": spine_join,
}
ORACLES = {
    "numeric_profile": PROFILE_SQL, "distinct_and_ever": DISTINCT_SQL, "pivot_count": PIVOT_SQL, "onehot_mean": ONEHOT_SQL,
    "segment_agg": SEGMENT_SQL, "event_rate": EVENT_RATE_SQL, "trailing_windows": TRAILING_SQL, "decayed_mean": DECAY_SQL,
    "trend_slope": TREND_SQL, "two_level_rollup": TWO_LEVEL_SQL, "latest_snapshot": LATEST_SQL, "last_k": LAST_K_SQL,
    "spine_join": SPINE_SQL,
}
