"""The given tables seen in the roles the operators work on.

A role is one projection, written once and read by both engines: Spark fills in DataFrames for the
braces, the checking engine its own table names. NULLs and sentinels are injected here by key, as
the given tables have none.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ANCHOR = "2002-01-01"

ROLES = {
    "loans": """
        SELECT o_custkey AS client, o_orderkey AS loan, DAYS(o_orderdate) AS t, o_totalprice AS amount,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS gappy,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE DAYS(o_orderdate) END AS gappy_t,
               o_orderstatus AS status, o_orderpriority AS priority,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS gappy_priority
        FROM {orders}""",
    "payments": """
        SELECT o_custkey AS client, o_orderkey AS loan, l_linenumber AS line, l_partkey AS part,
               l_suppkey AS supp, DAYS(o_orderdate) + 30 AS due,
               CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE DAYS(l_shipdate) END AS paid,
               l_quantity AS qty, l_extendedprice AS price, l_discount + 0.0e0 AS discount, l_tax AS tax,
               l_returnflag AS flag
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "activity": """
        SELECT user_id AS client, event_id AS event, DAYS(ts) - 8036 AS t, event_type AS kind,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value
        FROM {events}""",
    "docs": """
        SELECT d.doc_id, CASE WHEN d.doc_id % 10 = 0 THEN NULL ELSE d.source END AS source, d.lang,
               CAST(d.n_chars AS DOUBLE) AS n_chars, l.quality
        FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "application": """
        SELECT c_custkey AS SK_ID_CURR,
               CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_acctbal + c_custkey * 7919 % 6000 < 2500 THEN 1 ELSE 0 END AS TARGET,
               CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE (c_custkey * 37 % 1000) / 1000e0 END AS EXT_SOURCE_1,
               CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE (c_custkey * 71 % 997 + floor(c_acctbal / 20)) / 2000e0 END AS EXT_SOURCE_2,
               CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE (c_custkey * 13 % 991) / 1000e0 END AS EXT_SOURCE_3,
               CAST(-7500 - c_custkey * 53 % 17000 AS DOUBLE) AS DAYS_BIRTH,
               CASE WHEN c_custkey % 7 = 0 THEN 365243e0 ELSE CAST(-1 - c_custkey * 29 % 9000 AS DOUBLE) END AS DAYS_EMPLOYED,
               CAST(-1 - c_custkey * 17 % 6000 AS DOUBLE) AS DAYS_ID_PUBLISH,
               CAST(-1 - c_custkey * 19 % 4000 AS DOUBLE) AS DAYS_LAST_PHONE_CHANGE,
               CAST(-1 - c_custkey * 23 % 15000 AS DOUBLE) AS DAYS_REGISTRATION,
               c_acctbal * 3 + 40000 AS AMT_INCOME_TOTAL, c_acctbal * 10 + 120000 AS AMT_CREDIT,
               CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE c_acctbal + 9000 + c_nationkey * 100 END AS AMT_ANNUITY,
               c_acctbal * 9 + 110000 AS AMT_GOODS_PRICE,
               CAST(c_custkey % 4 AS DOUBLE) AS CNT_CHILDREN, CAST(1 + c_custkey % 5 AS DOUBLE) AS CNT_FAM_MEMBERS,
               CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST(c_custkey % 20 AS DOUBLE) END AS OWN_CAR_AGE,
               CAST(c_custkey % 9 AS DOUBLE) AS OBS_30_CNT_SOCIAL_CIRCLE, CAST(c_custkey % 8 AS DOUBLE) AS OBS_60_CNT_SOCIAL_CIRCLE,
               CAST(c_custkey % 3 AS DOUBLE) AS DEF_30_CNT_SOCIAL_CIRCLE, CAST(c_custkey % 2 AS DOUBLE) AS DEF_60_CNT_SOCIAL_CIRCLE,
               c_nationkey / 100e0 AS REGION_POPULATION_RELATIVE,
               CAST(c_custkey % 2 AS INT) AS FLAG_DOCUMENT_2, CAST(c_custkey % 3 AS INT) AS FLAG_DOCUMENT_3,
               CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_DAY,
               CAST(c_custkey % 6 AS DOUBLE) AS AMT_REQ_CREDIT_BUREAU_YEAR,
               1 AS FLAG_MOBIL, CAST(c_custkey % 2 AS INT) AS FLAG_EMP_PHONE, CAST(c_custkey % 5 AS INT) AS FLAG_EMAIL,
               CAST(1 + c_custkey % 3 AS INT) AS REGION_RATING_CLIENT_W_CITY, CAST(c_custkey % 24 AS INT) AS HOUR_APPR_PROCESS_START,
               CAST(c_custkey % 2 AS INT) AS REG_REGION_NOT_LIVE_REGION, CAST(c_custkey % 3 AS INT) AS REG_REGION_NOT_WORK_REGION,
               c_mktsegment AS NAME_EDUCATION_TYPE,
               CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE concat('org', CAST(c_nationkey AS VARCHAR(10))) END AS ORGANIZATION_TYPE,
               CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE concat('job', CAST(c_custkey % 18 AS VARCHAR(10))) END AS OCCUPATION_TYPE,
               concat('income', CAST(c_custkey % 6 AS VARCHAR(10))) AS NAME_INCOME_TYPE,
               CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END AS CODE_GENDER,
               concat('family', CAST(c_custkey % 4 AS VARCHAR(10))) AS NAME_FAMILY_STATUS,
               concat('house', CAST(c_custkey % 5 AS VARCHAR(10))) AS NAME_HOUSING_TYPE,
               CASE WHEN c_custkey % 11 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END AS NAME_CONTRACT_TYPE
        FROM {customer}""",
    "bureau": """
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU, DAYS(o_orderdate) AS DAYS_CREDIT,
               CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 30 AS INT) ELSE 0 END AS CREDIT_DAY_OVERDUE,
               CAST(DAYS(o_orderdate) + o_orderkey % 90 AS INT) AS DAYS_CREDIT_UPDATE,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(DAYS(o_orderdate) + 30 * (o_orderkey % 60) AS DOUBLE) END AS DAYS_CREDIT_ENDDATE,
               CASE WHEN o_orderstatus = 'F' THEN CAST(DAYS(o_orderdate) + o_orderkey % 400 AS DOUBLE) END AS DAYS_ENDDATE_FACT,
               o_totalprice AS AMT_CREDIT_SUM,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice * (o_orderkey % 10) / 10 END AS AMT_CREDIT_SUM_DEBT,
               CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice / 100 ELSE 0e0 END AS AMT_CREDIT_SUM_OVERDUE,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice / 12 END AS AMT_ANNUITY,
               CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END AS CREDIT_ACTIVE,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS CREDIT_TYPE
        FROM {orders}""",
    "bureau_balance": """
        SELECT l_orderkey AS SK_ID_BUREAU, CAST(-(l_linenumber + l_partkey % 12) AS INT) AS MONTHS_BALANCE, l_returnflag AS STATUS
        FROM {lineitem}""",
    "previous": """
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV, o_totalprice AS AMT_APPLICATION,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice * (8 + o_orderkey % 5) / 10 END AS AMT_CREDIT,
               o_totalprice * 9 / 10 AS AMT_GOODS_PRICE,
               CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice / 20 END AS AMT_DOWN_PAYMENT,
               o_totalprice / 12 AS AMT_ANNUITY, CAST(6 + o_orderkey % 18 AS DOUBLE) AS CNT_PAYMENT,
               CAST(DAYS(o_orderdate) AS DOUBLE) AS DAYS_DECISION,
               CASE WHEN o_orderkey % 5 = 0 THEN 365243e0 ELSE CAST(DAYS(o_orderdate) + 30 AS DOUBLE) END AS DAYS_FIRST_DUE,
               CASE WHEN o_orderkey % 4 = 0 THEN 365243e0 ELSE CAST(DAYS(o_orderdate) + 7 AS DOUBLE) END AS DAYS_FIRST_DRAWING,
               CAST(DAYS(o_orderdate) + o_orderkey % 700 AS DOUBLE) AS DAYS_LAST_DUE,
               CAST(DAYS(o_orderdate) + 360 AS DOUBLE) AS DAYS_LAST_DUE_1ST_VERSION,
               CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'Revolving loans' WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'Cash loans' END AS NAME_CONTRACT_TYPE
        FROM {orders}""",
    "pos": """
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV, CAST(-(l_linenumber + l_partkey % 30) AS INT) AS MONTHS_BALANCE,
               CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN CAST(l_suppkey % 20 AS INT) ELSE 0 END AS SK_DPD,
               CAST(l_suppkey % 5 AS INT) AS SK_DPD_DEF, l_quantity AS CNT_INSTALMENT,
               CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity / 2 END AS CNT_INSTALMENT_FUTURE,
               CASE l_returnflag WHEN 'A' THEN 'Completed' WHEN 'N' THEN 'Active' ELSE NULL END AS NAME_CONTRACT_STATUS
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "card": """
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV, CAST(-(l_linenumber + l_partkey % 30) AS INT) AS MONTHS_BALANCE,
               CASE WHEN l_partkey % 4 = 0 THEN CAST(l_suppkey % 15 AS INT) ELSE 0 END AS SK_DPD,
               CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_extendedprice END AS AMT_BALANCE,
               CASE WHEN l_partkey % 6 = 0 THEN -1e0 ELSE l_quantity * 1000 END AS AMT_CREDIT_LIMIT_ACTUAL,
               l_extendedprice / 10 AS AMT_PAYMENT_TOTAL_CURRENT, l_extendedprice * 11 / 10 AS AMT_TOTAL_RECEIVABLE,
               l_extendedprice / 5 AS AMT_DRAWINGS_CURRENT, l_quantity * 10 AS AMT_INST_MIN_REGULARITY,
               l_extendedprice / 12 AS AMT_PAYMENT_CURRENT
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "installments": """
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV,
               CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(l_suppkey % 4 AS DOUBLE) END AS NUM_INSTALMENT_VERSION,
               CAST(DAYS(o_orderdate) + 30 AS DOUBLE) AS DAYS_INSTALMENT,
               CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE CAST(DAYS(l_shipdate) AS DOUBLE) END AS DAYS_ENTRY_PAYMENT,
               l_extendedprice AS AMT_INSTALMENT,
               CASE WHEN l_partkey % 12 = 0 THEN NULL ELSE l_extendedprice * (100 - l_suppkey % 15) / 100 END AS AMT_PAYMENT
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
}

_TABLE = re.compile(r"\{(\w+)\}")
_DAYS = re.compile(r"DAYS\((\w+)\)")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def role(spark: SparkSession, root: str, name: str) -> DataFrame:
    sql = _DAYS.sub(rf"datediff(\1, DATE'{ANCHOR}')", ROLES[name])
    return spark.sql(sql, **{t: table(spark, root, t) for t in set(_TABLE.findall(sql))})


def role_sql(*names: str) -> str:
    """``WITH`` list defining the roles for the checking engine."""
    def one(name: str) -> str:
        days = rf"CAST(date_diff('day', DATE '{ANCHOR}', CAST(\1 AS DATE)) AS INT)"
        return f"{name} AS ({_TABLE.sub(r'\1', _DAYS.sub(days, ROLES[name]))})"

    return "WITH " + ", ".join(map(one, names))
