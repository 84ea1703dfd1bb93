"""Scans, contracts, row expressions and schema operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom.catalog.roles import role, role_sql, table
from riskloom.catalog.shape import rounded, rounded_sql
from riskloom.functions import exprs as X
from riskloom.operators.encoding import label_encode
from riskloom.operators.joins import IS_TRAIN, split_spine, union_spine
from riskloom.operators.selection import constant_columns, narrow_types
from riskloom.session import shared_dir
from riskloom.sources.tables import check_contract, read_csv


def scan_profile_contract(spark, root):
    path = f"{shared_dir(spark)}/riskloom/orders-{uuid.uuid4().hex}.csv"
    table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").write.csv(path, header=True)
    known = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice").schema
    back = read_csv(spark, path, known).withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice"))
    )
    report = check_contract(back, "orders", ["o_orderkey", "o_custkey"])
    totals = back.agg(F.sum("o_orderkey").alias("key_sum"), F.sum("o_totalprice").alias("price_sum"))
    one = report.withColumn("row", F.lit(1)).join(totals.withColumn("row", F.lit(1)), "row").drop("row")
    return rounded(one, 4)


SCAN_SQL = """
SELECT 'orders' AS "table", count(*) AS n_rows, CAST(4 AS INT) AS n_cols,
       round(100.0 * sum(CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END) / (4.0 * count(*)), 4) AS null_pct,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
       round(sum(CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END), 4) AS price_sum
FROM orders"""


def narrow(spark, root):
    out = narrow_types(table(spark, root, "part").select("p_partkey", "p_size", "p_retailprice"))
    kinds = {f.name: f.dataType.simpleString() for f in out.schema}
    # Keys are widened again here, because their type follows from the data.
    return out.select(F.col("p_partkey").cast("long"), "p_size", "p_retailprice", *(F.lit(k).alias(f"{c}_type") for c, k in kinds.items()))


NARROW_SQL = """
WITH b AS (SELECT min(p_partkey) lo_k, max(p_partkey) hi_k, min(p_size) lo_s, max(p_size) hi_s FROM part)
SELECT p_partkey, CAST(p_size AS TINYINT) AS p_size, CAST(p_retailprice AS FLOAT) AS p_retailprice,
       CASE WHEN lo_k >= -128 AND hi_k <= 127 THEN 'tinyint' WHEN lo_k >= -32768 AND hi_k <= 32767 THEN 'smallint'
            WHEN hi_k <= 2147483647 THEN 'int' ELSE 'bigint' END AS p_partkey_type,
       CASE WHEN lo_s >= -128 AND hi_s <= 127 THEN 'tinyint' ELSE 'wider' END AS p_size_type, 'float' AS p_retailprice_type
FROM part, b"""


def ratio_features(spark, root):
    p = role(spark, root, "payments")
    out = p.select(
        "client", "loan", "line", "part", "supp", "qty", "price",
        X.ratio("price", "qty").alias("unit_price"),
        X.ratio("price", F.col("qty") - 11, 1.0).alias("ratio_zero_den"),
        (F.col("price") * (1 - F.col("discount"))).alias("net"),
        X.flag(F.col("paid") > F.col("due")).alias("late"),
        X.square("qty").alias("qty_sq"), X.cube("discount").alias("discount_cb"),
        X.log1p_abs("due").alias("log_due"), X.days_to_years("due").alias("due_years"),
        X.weighted_sum([(2, "discount"), (1, "tax"), (0.5, "qty")]).alias("weighted"),
    )
    return rounded(out, 8)


RATIO_SQL = rounded_sql(
    role_sql("payments")
    + """
SELECT client, loan, line, part, supp, qty, price, price / (qty + 1) AS unit_price, price / nullif(qty - 11 + 1, 0) AS ratio_zero_den,
       price * (1 - discount) AS net, CASE WHEN paid > due THEN 1 ELSE 0 END AS late, qty * qty AS qty_sq,
       discount * discount * discount AS discount_cb, ln(1 + abs(due)) AS log_due, due / -365.25 AS due_years,
       2 * discount + tax + 0.5 * qty AS weighted
FROM payments""",
    ["qty", "price", "unit_price", "ratio_zero_den", "net", "qty_sq", "discount_cb", "log_due", "due_years", "weighted"],
    8,
)


def sentinel_flags(spark, root):
    loans = role(spark, root, "loans").select(
        "loan", "amount",
        F.when(F.col("loan") % 7 == 0, X.DAYS_UNKNOWN).otherwise(F.col("t")).alias("DAYS_OPEN"),
        F.when(F.col("loan") % 5 == 0, float("inf")).when(F.col("loan") % 5 == 1, float("-inf"))
        .when(F.col("loan") % 5 == 2, float("nan")).otherwise(F.col("amount")).alias("noisy"),
    )
    flagged = loans.withColumn("OPEN_ANOM", X.flag(F.col("DAYS_OPEN") == X.DAYS_UNKNOWN))
    return rounded(X.null_non_finite(X.sentinel_to_null(flagged)))


SENTINEL_SQL = rounded_sql(
    role_sql("loans")
    + """
SELECT loan, amount, CASE WHEN loan % 7 <> 0 THEN t END AS DAYS_OPEN,
       CASE WHEN loan % 5 IN (3, 4) THEN amount END AS noisy, CASE WHEN loan % 7 = 0 THEN 1 ELSE 0 END AS OPEN_ANOM
FROM loans""",
    ["amount", "noisy"],
)

_ROW = ("a", "b", "c")


def row_stats(spark, root):
    rows = table(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_quantity")).alias("a"),
        F.when(F.col("l_suppkey") % 4 != 0, F.col("l_tax") * 100).alias("b"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_linenumber").cast("double")).alias("c"),
    )
    return rounded(
        rows.select(
            "*", X.row_mean(_ROW).alias("row_mean"), X.row_std(_ROW).alias("row_std"), X.row_min(_ROW).alias("row_min"),
            X.row_max(_ROW).alias("row_max"), X.row_null_count(_ROW).alias("row_nulls"),
            X.row_sum([*_ROW, F.lit("x")]).alias("row_sum"), X.row_null_count(rows.columns).alias("all_nulls"),
        )
    )


ROW_STATS_SQL = rounded_sql(
    """
WITH r AS (SELECT row_number() OVER () AS id, l_orderkey, l_partkey, l_suppkey, l_linenumber,
                  CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS a, CASE WHEN l_suppkey % 4 <> 0 THEN l_tax * 100 END AS b,
                  CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_linenumber AS DOUBLE) END AS c FROM lineitem),
u AS (SELECT id, unnest([a, b, c]) AS v FROM r),
s AS (SELECT id, avg(v) AS row_mean, stddev_samp(v) AS row_std, min(v) AS row_min, max(v) AS row_max,
             CAST(3 - count(v) AS INT) AS row_nulls, coalesce(sum(v), 0) AS row_sum FROM u GROUP BY id)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, a, b, c, row_mean, row_std, row_min, row_max, row_nulls, row_sum, row_nulls AS all_nulls
FROM r JOIN s USING (id)""",
    ["a", "b", "c", "row_mean", "row_std", "row_min", "row_max", "row_sum"],
)

_EDGES = (905, 1000, 1100, 1250, 1400, 1700)


def bucketize(spark, root):
    part = table(spark, root, "part").select("p_partkey", "p_retailprice")
    return part.select("p_partkey", X.bucketize("p_retailprice", _EDGES).alias("price_bin"))


BUCKETIZE_SQL = (
    "SELECT p_partkey, CASE "
    + " ".join(f"WHEN p_retailprice > {a} AND p_retailprice <= {b} THEN {i}" for i, (a, b) in enumerate(zip(_EDGES, _EDGES[1:])))
    + " END AS price_bin FROM part"
)


def schema_ops(spark, root):
    part = table(spark, root, "part")
    messy = part.select(
        F.col("p_partkey").alias("part key"), F.col("p_size").alias("size/cm"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string")).alias("price.text"),
        "p_type",
    )
    clean = messy.toDF(*X.clean_names(messy.columns))
    other = clean.drop("p_type").withColumn("extra", F.lit(1))
    kept = clean.select(*X.shared_columns(clean, other))
    return kept.select(
        "part_key", "size_cm", X.to_number("price_text").alias("price"),
        X.row_sum(X.matching(kept, prefix="size")).alias("size_sum"),
        (F.col("size_cm") + X.optional(kept, "missing_flag", 2.0)).alias("size_plus"),
        F.lit(",".join(X.numeric_columns(kept))).alias("numeric_cols"),
    )


SCHEMA_SQL = """
SELECT p_partkey AS part_key, p_size AS size_cm, CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS price,
       CAST(p_size AS DOUBLE) AS size_sum, p_size + 2.0::DOUBLE AS size_plus, 'part_key,size_cm' AS numeric_cols
FROM part"""


def positive_part_dpd(spark, root):
    p = role(spark, root, "payments")
    return p.select(
        "loan", "line", "part", "supp", X.positive_part("paid", "due").alias("dpd"), X.positive_part("due", "paid").alias("dbd")
    )


DPD_SQL = role_sql("payments") + """
SELECT loan, line, part, supp, CASE WHEN paid IS NOT NULL THEN CAST(greatest(paid - due, 0) AS DOUBLE) END AS dpd,
       CASE WHEN paid IS NOT NULL THEN CAST(greatest(due - paid, 0) AS DOUBLE) END AS dbd
FROM payments"""


def category_cross(spark, root):
    loans = role(spark, root, "loans")
    return loans.select(
        "loan", X.category_cross("gappy_priority", "status").alias("priority__status"),
        F.coalesce("gappy_priority", F.lit(X.NULL_CATEGORY)).alias("filled"),
    ).na.fill({"filled": X.NULL_CATEGORY})


CROSS_SQL = role_sql("loans") + """
SELECT loan, coalesce(gappy_priority, 'nan') || '__' || coalesce(status, 'nan') AS priority__status, coalesce(gappy_priority, '__nan__') AS filled
FROM loans"""


def label_codes(spark, root):
    docs = role(spark, root, "docs").select("doc_id", "source", "lang")
    return label_encode(docs, ["source", "lang"])


LABEL_CODES_SQL = role_sql("docs") + """
SELECT doc_id, CAST(dense_rank() OVER (ORDER BY coalesce(source, 'nan')) - 1 AS INT) AS source,
       CAST(dense_rank() OVER (ORDER BY coalesce(lang, 'nan')) - 1 AS INT) AS lang
FROM docs"""


def union_split(spark, root):
    cust = table(spark, root, "customer").select("c_custkey", "c_acctbal")
    train = cust.where("c_custkey % 3 <> 0").withColumn("label", X.flag(F.col("c_acctbal") < 0))
    test = cust.where("c_custkey % 3 = 0").withColumn("only_test", F.lit(1))
    spine = union_spine(train, test)
    left, right = split_spine(spine, "label")
    back = left.withColumn("side", F.lit("train")).unionByName(right.withColumn("side", F.lit("test")), allowMissingColumns=True)
    return back.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labels"), F.count("only_test").alias("extras"),
        F.count_distinct("c_custkey").alias("ids"),
    )


UNION_SPLIT_SQL = """
SELECT CASE WHEN c_custkey % 3 <> 0 THEN 'train' ELSE 'test' END AS side, count(*) AS n,
       count(CASE WHEN c_custkey % 3 <> 0 THEN 1 END) AS labels, count(CASE WHEN c_custkey % 3 = 0 THEN 1 END) AS extras,
       count(DISTINCT c_custkey) AS ids
FROM customer GROUP BY 1"""


def constant_cols(spark, root):
    li = table(spark, root, "lineitem").select(
        "l_quantity", "l_tax", F.lit(1).alias("one"), F.lit(None).cast("double").alias("none"),
        F.when(F.col("l_quantity") > 10, 1).alias("one_or_null"), F.col("l_linenumber") - F.col("l_linenumber"),
    ).toDF("l_quantity", "l_tax", "one", "none", "one_or_null", "zero")
    found = set(constant_columns(li, li.columns))
    return li.select(*(F.count_if(F.lit(c in found)).alias(c) for c in li.columns)).unpivot([], li.columns, "col", "n").select(
        "col", F.when(F.col("n") > 0, 1).otherwise(0).alias("constant")
    )


CONSTANT_SQL = """
WITH s AS (SELECT l_quantity, l_tax, 1 AS one, NULL AS none, CASE WHEN l_quantity > 10 THEN 1 END AS one_or_null, l_linenumber - l_linenumber AS zero FROM lineitem),
c AS (SELECT 'l_quantity' AS col, count(DISTINCT l_quantity) + max(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END) AS k FROM s
 UNION ALL SELECT 'l_tax', count(DISTINCT l_tax) + max(CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END) FROM s
 UNION ALL SELECT 'one', count(DISTINCT one) + max(CASE WHEN one IS NULL THEN 1 ELSE 0 END) FROM s
 UNION ALL SELECT 'none', count(DISTINCT none) + max(CASE WHEN none IS NULL THEN 1 ELSE 0 END) FROM s
 UNION ALL SELECT 'one_or_null', count(DISTINCT one_or_null) + max(CASE WHEN one_or_null IS NULL THEN 1 ELSE 0 END) FROM s
 UNION ALL SELECT 'zero', count(DISTINCT zero) + max(CASE WHEN zero IS NULL THEN 1 ELSE 0 END) FROM s)
SELECT col, CASE WHEN k <= 1 THEN 1 ELSE 0 END AS constant FROM c"""

QUERIES = {
    "scan_profile_contract": scan_profile_contract, "narrow_types": narrow, "ratio_features": ratio_features,
    "sentinel_flags": sentinel_flags, "row_stats": row_stats, "bucketize": bucketize, "schema_ops": schema_ops,
    "positive_part_dpd": positive_part_dpd, "category_cross": category_cross, "label_encode": label_codes,
    "union_split": union_split, "constant_cols": constant_cols,
}
ORACLES = {
    "scan_profile_contract": SCAN_SQL, "narrow_types": NARROW_SQL, "ratio_features": RATIO_SQL, "sentinel_flags": SENTINEL_SQL,
    "row_stats": ROW_STATS_SQL, "bucketize": BUCKETIZE_SQL, "schema_ops": SCHEMA_SQL, "positive_part_dpd": DPD_SQL,
    "category_cross": CROSS_SQL, "label_encode": LABEL_CODES_SQL, "union_split": UNION_SPLIT_SQL, "constant_cols": CONSTANT_SQL,
}
