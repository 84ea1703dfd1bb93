"""The six table builders on the given tables in their roles.

The checks rebuild columns by separate filtering, grouping and joining: all of them for balances and
installments, a selection from every feature family for the others. Large sums and squares are
scaled before rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.catalog.roles import role, role_sql
from riskloom.catalog.shape import rounded, rounded_sql
from riskloom.plans import children as C
from riskloom.plans.application import application_features

DIGITS = 6
_SCALE = 1e6


def _scaled(df: DataFrame, cols: list[str], big: list[str], digits: int = DIGITS) -> DataFrame:
    """The key and the compared columns, all as doubles, with the large ones divided."""
    return rounded(
        df.select(
            C.KEY,
            *((F.col(f"`{c}`").cast("double") / (_SCALE if c in big else 1)).alias(c) for c in cols),
        ),
        digits,
    )


def _scaled_sql(sql: str, cols: list[str], big: list[str], digits: int = DIGITS) -> str:
    picked = ", ".join(f'CAST("{c}" AS DOUBLE) / {_SCALE if c in big else 1} AS "{c}"' for c in cols)
    return rounded_sql(f'SELECT "{C.KEY}", {picked} FROM ({sql})', cols, digits)


def _assemble(source: str, parts: list[tuple[str, str]]) -> str:
    """Left join of separately grouped parts ``(select list, filter)`` onto the distinct clients."""
    ctes = ", ".join(
        f"p{i} AS (SELECT {C.KEY}, {sel} FROM {source} WHERE {cond} GROUP BY {C.KEY})" for i, (sel, cond) in enumerate(parts)
    )
    joins = " ".join(f"LEFT JOIN p{i} USING ({C.KEY})" for i in range(len(parts)))
    return f", ids AS (SELECT DISTINCT {C.KEY} FROM {source}), {ctes} SELECT * FROM ids {joins}"


def _profile(prefix: str, col: str) -> str:
    return (
        f"min({col}) AS {prefix}_{col}_MIN, max({col}) AS {prefix}_{col}_MAX, avg({col}) AS {prefix}_{col}_MEAN, "
        f"coalesce(sum({col}), 0) AS {prefix}_{col}_SUM, var_samp({col}) AS {prefix}_{col}_VAR"
    )


def _window(prefix: str, label: str, cols: list[str]) -> str:
    stats = ", ".join(
        f"avg({c}) AS {prefix}_{label}_{c}_MEAN, max({c}) AS {prefix}_{label}_{c}_MAX, coalesce(sum({c}), 0) AS {prefix}_{label}_{c}_SUM"
        for c in cols
    )
    return f"{stats}, count(*) AS {prefix}_{label}_COUNT"


def _decay(prefix: str, col: str, t: str, rate: float) -> str:
    return f"sum({col} * exp({rate} * {t})) / sum(exp({rate} * {t})) AS {prefix}_{col}_TWMEAN"


# --- application ----------------------------------------------------------------------------------

APP_COLS = [
    "DAYS_EMPLOYED_ANOM", "DAYS_EMPLOYED", "EXT_MEAN", "EXT_STD", "EXT_PROD", "EXT_MIN", "EXT_MAX", "EXT_NANCOUNT",
    "EXT_S2divS3", "EXT_SOURCE_2_CB", "EXT_S3xEMPL", "GP1", "GP2", "GP3", "GP4", "GP5", "GP6", "GP7", "GP9", "GP10",
    "CREDIT_INCOME_RATIO", "CREDIT_ANNUITY_RATIO", "INCOME_PER_CHILD", "DOWN_PAYMENT", "DOWN_PAYMENT_RATIO", "EXT_WEIGHTED",
    "DAYS_BIRTH_YRS", "EMPLOYED_TO_BIRTH", "CAR_AGE_TO_BIRTH", "PHONE_TO_EMPLOYED", "AGE_RANGE", "INCOME_EMPLOYED",
    "CAR_EMPLOYED_RATIO", "PHONE_MINUS_REG", "CHILDREN_RATIO", "DEF_30_60_RATIO", "DOCUMENT_COUNT", "AMT_REQ_SUM",
    "FLAG_CONTACTS_SUM", "CITY_RATING_x_EXT2", "EXT_RANGE", "EXT_SOURCE_SPREAD", "REGION_POP_x_EXT", "HOUR_APPR_x_EXT2", "LIVE_REGION_DIFF",
]
APP_BIG = ["DAYS_BIRTH_YRS", "INCOME_EMPLOYED", "INCOME_PER_CHILD", "EXT_S3xEMPL", "DOWN_PAYMENT", "GP2", "GP9"]


def builder_application(spark, root):
    return _scaled(application_features(role(spark, root, "application")), APP_COLS, APP_BIG, 12)


_APP_SQL = role_sql("application") + """,
e AS (SELECT * REPLACE (CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS DAYS_EMPLOYED), CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END AS DAYS_EMPLOYED_ANOM FROM application),
u AS (SELECT SK_ID_CURR, unnest([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) AS v FROM e),
x AS (SELECT SK_ID_CURR, avg(v) AS EXT_MEAN, stddev_samp(v) AS EXT_STD, min(v) AS EXT_MIN, max(v) AS EXT_MAX, 3 - count(v) AS EXT_NANCOUNT FROM u GROUP BY 1)
SELECT *, EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3 AS EXT_PROD, EXT_SOURCE_2 / nullif(EXT_SOURCE_3 + 1e-4, 0) AS EXT_S2divS3,
 EXT_SOURCE_2 * EXT_SOURCE_2 * EXT_SOURCE_2 AS EXT_SOURCE_2_CB, EXT_SOURCE_3 * DAYS_EMPLOYED AS EXT_S3xEMPL, EXT_SOURCE_2 * EXT_SOURCE_2 * EXT_SOURCE_3 AS GP1,
 EXT_SOURCE_1 * DAYS_BIRTH / nullif(AMT_ANNUITY + 1, 0) AS GP2, EXT_SOURCE_2 * REGION_RATING_CLIENT_W_CITY AS GP3, EXT_SOURCE_3 * ln(1 + abs(DAYS_BIRTH)) AS GP4,
 AMT_ANNUITY * EXT_SOURCE_3 / nullif(AMT_INCOME_TOTAL + 1, 0) AS GP5, EXT_SOURCE_1 * DAYS_ID_PUBLISH / nullif(DAYS_BIRTH + 1, 0) AS GP6,
 EXT_SOURCE_2 * AMT_CREDIT / nullif(AMT_GOODS_PRICE + 1, 0) AS GP7, EXT_MEAN * DAYS_EMPLOYED / nullif(DAYS_BIRTH - 1, 0) AS GP9,
 (AMT_GOODS_PRICE - AMT_CREDIT) * EXT_SOURCE_2 / nullif(AMT_ANNUITY + 1, 0) AS GP10, AMT_CREDIT / nullif(AMT_INCOME_TOTAL + 1, 0) AS CREDIT_INCOME_RATIO,
 AMT_CREDIT / nullif(AMT_ANNUITY + 1, 0) AS CREDIT_ANNUITY_RATIO, AMT_INCOME_TOTAL / (CNT_CHILDREN + 1) AS INCOME_PER_CHILD, AMT_GOODS_PRICE - AMT_CREDIT AS DOWN_PAYMENT,
 (AMT_GOODS_PRICE - AMT_CREDIT) / nullif(AMT_GOODS_PRICE + 1, 0) AS DOWN_PAYMENT_RATIO, 2 * EXT_SOURCE_2 + EXT_SOURCE_3 + 0.5 * EXT_SOURCE_1 AS EXT_WEIGHTED,
 DAYS_BIRTH / -365.25 AS DAYS_BIRTH_YRS, DAYS_EMPLOYED / nullif(DAYS_BIRTH + 1, 0) AS EMPLOYED_TO_BIRTH, OWN_CAR_AGE / (DAYS_BIRTH / -365.25 + 1) AS CAR_AGE_TO_BIRTH,
 DAYS_LAST_PHONE_CHANGE / nullif(DAYS_EMPLOYED + 1, 0) AS PHONE_TO_EMPLOYED,
 (SELECT max(i) FROM (VALUES (0, 0, 25), (1, 25, 30), (2, 30, 35), (3, 35, 40), (4, 40, 45), (5, 45, 50), (6, 50, 55), (7, 55, 60), (8, 60, 65), (9, 65, 100)) b(i, lo, hi)
  WHERE DAYS_BIRTH / -365.25 > lo AND DAYS_BIRTH / -365.25 <= hi) AS AGE_RANGE,
 AMT_INCOME_TOTAL * (DAYS_EMPLOYED / -365.25) AS INCOME_EMPLOYED, OWN_CAR_AGE / nullif(DAYS_EMPLOYED / -365.25 + 1, 0) AS CAR_EMPLOYED_RATIO,
 DAYS_LAST_PHONE_CHANGE - DAYS_REGISTRATION AS PHONE_MINUS_REG, CNT_CHILDREN / (CNT_FAM_MEMBERS + 1) AS CHILDREN_RATIO,
 DEF_30_CNT_SOCIAL_CIRCLE / (DEF_60_CNT_SOCIAL_CIRCLE + 1) AS DEF_30_60_RATIO, FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3 AS DOCUMENT_COUNT,
 coalesce(AMT_REQ_CREDIT_BUREAU_DAY, 0) + AMT_REQ_CREDIT_BUREAU_YEAR AS AMT_REQ_SUM, FLAG_MOBIL + FLAG_EMP_PHONE + FLAG_EMAIL AS FLAG_CONTACTS_SUM,
 REGION_RATING_CLIENT_W_CITY * EXT_SOURCE_2 AS CITY_RATING_x_EXT2, EXT_MAX - EXT_MIN AS EXT_RANGE, EXT_STD / nullif(EXT_MEAN + 1e-4, 0) AS EXT_SOURCE_SPREAD,
 REGION_POPULATION_RELATIVE * EXT_MEAN AS REGION_POP_x_EXT, HOUR_APPR_PROCESS_START * EXT_SOURCE_2 AS HOUR_APPR_x_EXT2,
 REG_REGION_NOT_LIVE_REGION + REG_REGION_NOT_WORK_REGION AS LIVE_REGION_DIFF
FROM e JOIN x USING (SK_ID_CURR)"""


# --- bureau ---------------------------------------------------------------------------------------

_BURO_PARTS = [
    (f"{_profile('BURO', 'AMT_CREDIT_SUM')}, {_profile('BURO', 'DEBT_CREDIT_RATIO')}, {_profile('BURO', 'CREDIT_DURATION')}, {_profile('BURO', 'BB_STATUS_A')}, count(*) AS BURO_COUNT, "
     "max(ENDDATE_DIFF) AS BURO_ENDDATE_DIFF_MAX, avg(OVERDUE_DEBT_RATIO) AS BURO_OVERDUE_DEBT_RATIO_MEAN, min(BB_MONTHS_MIN) AS BURO_BB_MONTHS_MIN_MIN, sum(BB_MONTHS_SIZE) AS BURO_BB_MONTHS_SIZE_SUM, "
     "avg(CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1.0 ELSE 0 END) AS BURO_CREDIT_ACTIVE_Active, avg(CASE WHEN CREDIT_TYPE = '5-LOW' THEN 1.0 ELSE 0 END) AS \"BURO_CREDIT_TYPE_5-LOW\", "
     "avg(CASE WHEN CREDIT_TYPE IS NULL THEN 1.0 ELSE 0 END) AS BURO_CREDIT_TYPE_nan, count(DISTINCT CREDIT_TYPE) AS BURO_CREDIT_TYPE_NUNIQUE, "
     "CASE WHEN max(CREDIT_DAY_OVERDUE) > 0 THEN 1 ELSE 0 END AS BURO_OVERDUE_EVER", "true"),
    ("avg(AMT_CREDIT_SUM_DEBT) AS BURO_ACTIVE_AMT_CREDIT_SUM_DEBT_MEAN, coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS BURO_ACTIVE_AMT_CREDIT_SUM_DEBT_SUM, min(DAYS_CREDIT) AS BURO_ACTIVE_DAYS_CREDIT_MIN, count(*) AS BURO_ACTIVE_COUNT", "CREDIT_ACTIVE = 'Active'"),
    ("max(DEBT_CREDIT_RATIO) AS BURO_CLOSED_DEBT_CREDIT_RATIO_MAX, count(*) AS BURO_CLOSED_COUNT", "CREDIT_ACTIVE = 'Closed'"),
    (_window("BURO", "6M", ["AMT_CREDIT_SUM_DEBT"]), "DAYS_CREDIT >= -180"),
    (_window("BURO", "1Y", ["CREDIT_DAY_OVERDUE"]), "DAYS_CREDIT >= -365"),
    (_window("BURO", "5Y", ["DEBT_CREDIT_RATIO"]), "DAYS_CREDIT >= -1825"),
    (_decay("BURO", "AMT_CREDIT_SUM_DEBT", "DAYS_CREDIT", 0.001), "AMT_CREDIT_SUM_DEBT IS NOT NULL"),
    (_decay("BURO", "DEBT_CREDIT_RATIO", "DAYS_CREDIT", 0.001), "DEBT_CREDIT_RATIO IS NOT NULL"),
    ("CASE WHEN count(*) >= 3 THEN covar_samp(DEBT_CREDIT_RATIO, DAYS_CREDIT) * (count(*) - 1) / (var_samp(DAYS_CREDIT) * (count(*) - 1) + 1e-8) END AS BURO_DEBT_CREDIT_RATIO_TREND", "DEBT_CREDIT_RATIO IS NOT NULL"),
    ("max(DAYS_CREDIT) AS BURO_LAST_DAYS_CREDIT, arg_max(CREDIT_DAY_OVERDUE, CAST(DAYS_CREDIT AS BIGINT) * 1000000000 + SK_ID_BUREAU) AS BURO_LAST_CREDIT_DAY_OVERDUE", "true"),
    ("arg_max(AMT_CREDIT_SUM_DEBT, CAST(DAYS_CREDIT AS BIGINT) * 1000000000 + SK_ID_BUREAU) AS BURO_LAST_AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_DEBT IS NOT NULL"),
]
BURO_COLS = [
    *(f"BURO_{c}_{s}" for c in ("AMT_CREDIT_SUM", "DEBT_CREDIT_RATIO", "CREDIT_DURATION", "BB_STATUS_A") for s in ("MIN", "MAX", "MEAN", "SUM", "VAR")),
    "BURO_COUNT", "BURO_ENDDATE_DIFF_MAX", "BURO_OVERDUE_DEBT_RATIO_MEAN", "BURO_BB_MONTHS_MIN_MIN", "BURO_BB_MONTHS_SIZE_SUM",
    "BURO_CREDIT_ACTIVE_Active", "BURO_CREDIT_TYPE_5-LOW", "BURO_CREDIT_TYPE_nan", "BURO_CREDIT_TYPE_NUNIQUE", "BURO_OVERDUE_EVER",
    "BURO_ACTIVE_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_ACTIVE_AMT_CREDIT_SUM_DEBT_SUM", "BURO_ACTIVE_DAYS_CREDIT_MIN", "BURO_ACTIVE_COUNT",
    "BURO_CLOSED_DEBT_CREDIT_RATIO_MAX", "BURO_CLOSED_COUNT",
    *(f"BURO_6M_AMT_CREDIT_SUM_DEBT_{s}" for s in ("MEAN", "MAX", "SUM")), "BURO_6M_COUNT",
    *(f"BURO_1Y_CREDIT_DAY_OVERDUE_{s}" for s in ("MEAN", "MAX", "SUM")), "BURO_1Y_COUNT",
    *(f"BURO_5Y_DEBT_CREDIT_RATIO_{s}" for s in ("MEAN", "MAX", "SUM")), "BURO_5Y_COUNT",
    "BURO_AMT_CREDIT_SUM_DEBT_TWMEAN", "BURO_DEBT_CREDIT_RATIO_TWMEAN", "BURO_DEBT_CREDIT_RATIO_TREND",
    "BURO_LAST_DAYS_CREDIT", "BURO_LAST_CREDIT_DAY_OVERDUE", "BURO_LAST_AMT_CREDIT_SUM_DEBT",
]
BURO_BIG = [c for c in BURO_COLS if "AMT_CREDIT_SUM" in c or c.endswith(("DURATION_VAR", "DURATION_MEAN"))]


def builder_bureau(spark, root):
    out = C.bureau_features(role(spark, root, "bureau"), role(spark, root, "bureau_balance"))
    scaled = out.withColumn("BURO_AMT_CREDIT_SUM_VAR", F.col("BURO_AMT_CREDIT_SUM_VAR") / _SCALE)
    return _scaled(scaled, BURO_COLS, BURO_BIG, 12)


_BURO_SQL = role_sql("bureau", "bureau_balance") + """,
bb AS (SELECT SK_ID_BUREAU, min(MONTHS_BALANCE) AS BB_MONTHS_MIN, max(MONTHS_BALANCE) AS BB_MONTHS_MAX, count(*) AS BB_MONTHS_SIZE,
       count(*) FILTER (WHERE STATUS = 'A') AS BB_STATUS_A FROM bureau_balance GROUP BY 1),
b AS (SELECT *, DAYS_CREDIT_ENDDATE - DAYS_CREDIT AS CREDIT_DURATION, DAYS_CREDIT_ENDDATE - DAYS_ENDDATE_FACT AS ENDDATE_DIFF,
      AMT_CREDIT_SUM_DEBT / nullif(AMT_CREDIT_SUM + 1, 0) AS DEBT_CREDIT_RATIO, AMT_CREDIT_SUM_OVERDUE / nullif(AMT_CREDIT_SUM_DEBT + 1, 0) AS OVERDUE_DEBT_RATIO
      FROM bureau LEFT JOIN bb USING (SK_ID_BUREAU))""" + _assemble("b", _BURO_PARTS).replace("SELECT * FROM ids", "SELECT * REPLACE (BURO_AMT_CREDIT_SUM_VAR / 1e6 AS BURO_AMT_CREDIT_SUM_VAR) FROM ids")


# --- previous applications --------------------------------------------------------------------------

_PREV_PARTS = [
    (f"{_profile('PREV', 'APP_CREDIT_RATIO')}, {_profile('PREV', 'DAYS_FIRST_DUE_DIFF')}, {_profile('PREV', 'INTEREST_RATE')}, avg(DOWN_PAYMENT_P) AS PREV_DOWN_PAYMENT_P_MEAN, "
     "sum(DAYS_LAST_DUE_DIFF) AS PREV_DAYS_LAST_DUE_DIFF_SUM, avg(CASE WHEN NAME_CONTRACT_TYPE = 'Cash loans' THEN 1.0 ELSE 0 END) AS \"PREV_NAME_CONTRACT_TYPE_Cash loans\", "
     "avg(CASE WHEN NAME_CONTRACT_TYPE IS NULL THEN 1.0 ELSE 0 END) AS PREV_NAME_CONTRACT_TYPE_nan, count(*) AS PREV_COUNT, "
     "sum(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1.0 ELSE 0 END) / count(*) AS PREV_APPROVAL_RATE", "true"),
    ("avg(AMT_CREDIT) AS PREV_REFUSED_AMT_CREDIT_MEAN, min(DAYS_DECISION) AS PREV_REFUSED_DAYS_DECISION_MIN, count(*) AS PREV_REFUSED_COUNT", "NAME_CONTRACT_STATUS = 'Refused'"),
    ("count(*) AS PREV_CANCELED_COUNT", "NAME_CONTRACT_STATUS = 'Canceled'"),
    ("coalesce(sum(AMT_CREDIT), 0) AS PREV_REVOLV_AMT_CREDIT_SUM, max(APP_CREDIT_RATIO) AS PREV_REVOLV_APP_CREDIT_RATIO_MAX, count(*) AS PREV_REVOLV_COUNT", "NAME_CONTRACT_TYPE = 'Revolving loans'"),
    (_window("PREV", "6M", ["INTEREST_RATE"]), "DAYS_DECISION >= -180"),
    (_window("PREV", "3Y", ["APP_CREDIT_RATIO"]), "DAYS_DECISION >= -1095"),
    (_decay("PREV", "AMT_CREDIT", "DAYS_DECISION", 0.001), "AMT_CREDIT IS NOT NULL"),
    ("max(DAYS_DECISION) AS PREV_LAST_DAYS_DECISION", "true"),
    ("arg_max(AMT_CREDIT, DAYS_DECISION * 1000000000 + SK_ID_PREV) AS PREV_LAST_AMT_CREDIT", "AMT_CREDIT IS NOT NULL"),
]
PREV_COLS = [
    *(f"PREV_{c}_{s}" for c in ("APP_CREDIT_RATIO", "DAYS_FIRST_DUE_DIFF", "INTEREST_RATE") for s in ("MIN", "MAX", "MEAN", "SUM", "VAR")),
    "PREV_DOWN_PAYMENT_P_MEAN", "PREV_DAYS_LAST_DUE_DIFF_SUM", "PREV_NAME_CONTRACT_TYPE_Cash loans", "PREV_NAME_CONTRACT_TYPE_nan", "PREV_COUNT",
    "PREV_APPROVAL_RATE", "PREV_REFUSED_AMT_CREDIT_MEAN", "PREV_REFUSED_DAYS_DECISION_MIN", "PREV_REFUSED_COUNT", "PREV_CANCELED_COUNT",
    "PREV_REVOLV_AMT_CREDIT_SUM", "PREV_REVOLV_APP_CREDIT_RATIO_MAX", "PREV_REVOLV_COUNT",
    *(f"PREV_6M_INTEREST_RATE_{s}" for s in ("MEAN", "MAX", "SUM")), "PREV_6M_COUNT",
    *(f"PREV_3Y_APP_CREDIT_RATIO_{s}" for s in ("MEAN", "MAX", "SUM")), "PREV_3Y_COUNT",
    "PREV_AMT_CREDIT_TWMEAN", "PREV_LAST_DAYS_DECISION", "PREV_LAST_AMT_CREDIT",
]
PREV_BIG = [c for c in PREV_COLS if "_AMT_CREDIT" in c]


def builder_previous(spark, root):
    return _scaled(C.previous_features(role(spark, root, "previous")), PREV_COLS, PREV_BIG)


_PREV_SQL = role_sql("previous") + """,
c AS (SELECT * REPLACE (CASE WHEN DAYS_FIRST_DUE <> 365243 THEN DAYS_FIRST_DUE END AS DAYS_FIRST_DUE, CASE WHEN DAYS_FIRST_DRAWING <> 365243 THEN DAYS_FIRST_DRAWING END AS DAYS_FIRST_DRAWING) FROM previous),
b AS (SELECT *, AMT_APPLICATION / nullif(AMT_CREDIT + 1, 0) AS APP_CREDIT_RATIO, DAYS_FIRST_DUE - DAYS_FIRST_DRAWING AS DAYS_FIRST_DUE_DIFF,
      DAYS_LAST_DUE_1ST_VERSION - DAYS_LAST_DUE AS DAYS_LAST_DUE_DIFF, AMT_DOWN_PAYMENT / nullif(AMT_CREDIT + 1, 0) AS DOWN_PAYMENT_P,
      (CNT_PAYMENT * AMT_ANNUITY - AMT_CREDIT) / nullif(AMT_CREDIT + 1, 0) AS INTEREST_RATE FROM c)""" + _assemble("b", _PREV_PARTS)


# --- monthly balances and payments --------------------------------------------------------------------

def _per_loan_sql(spec: dict[str, str]) -> tuple[str, str]:
    inner = ", ".join(f"{sql} AS {name}" for name, sql in spec.items())
    outer = ", ".join(f"avg({n}) AS {n}_MEAN, max({n}) AS {n}_MAX, stddev_samp({n}) AS {n}_STD" for n in spec)
    return f"pl AS (SELECT SK_ID_CURR, {outer} FROM (SELECT SK_ID_CURR, SK_ID_PREV, {inner} FROM b GROUP BY 1, 2) GROUP BY 1)", "LEFT JOIN pl USING (SK_ID_CURR)"


def _with_per_loan(base: str, parts: list[tuple[str, str]], spec: dict[str, str], extra: str = "", joins: str = "") -> str:
    cte, join = _per_loan_sql(spec)
    return f"{base}, {cte}{extra}{_assemble('b', parts)} {join} {joins}"


def _every(df: DataFrame) -> DataFrame:
    """Every column of a builder as a double, scaled so that what is rounded away is noise."""
    cols = [c for c in df.columns if c != C.KEY]
    return rounded(df.select(C.KEY, *((F.col(f"`{c}`").cast("double") / _unit(c)).alias(c) for c in cols)), DIGITS)


def _every_sql(sql: str, cols: list[str]) -> str:
    picked = ", ".join(f'CAST("{c}" AS DOUBLE) / {_unit(c)} AS "{c}"' for c in cols)
    return rounded_sql(f'SELECT "{C.KEY}", {picked} FROM ({sql})', cols, DIGITS)


def _unit(col: str) -> float:
    """What a column is divided by; no round number, because short decimals would fall on the edge of rounding."""
    money = any(part in col for part in ("AMT_", "PAYMENT_DIFF", "PAYDIFF"))
    wide = money or any(part in col for part in ("DAYS_", "DPD", "DBD"))
    if col.endswith("_VAR"):
        power = 9 if money else 4 if wide else 1
    else:
        power = 6 if col.endswith("_SUM") and money else 3 if money or (wide and col.endswith("_SUM")) else 0
    return 1.009 * 10.0**power


_FIVE, _THREE, _LOAN = ("MIN", "MAX", "MEAN", "SUM", "VAR"), ("MEAN", "MAX", "SUM"), ("MEAN", "MAX", "STD")


def _trend(prefix: str, col: str, time: str) -> tuple[str, str]:
    pairs = f"covar_samp({col}, {time}) * (count(*) - 1) / (var_samp({time}) * (count(*) - 1) + 1e-8)"
    return f"CASE WHEN count(*) >= 3 THEN {pairs} END AS {prefix}_{col}_TREND", f"{col} IS NOT NULL"


def _monthly(prefix: str, time: str, numbers, windows, window_cols, decayed, decay, trends, extra) -> list[tuple[str, str]]:
    """The separately grouped parts of a table: profile, windows, decayed means and trends of all its columns."""
    return [
        (", ".join([*(_profile(prefix, c) for c in numbers), f"count(*) AS {prefix}_COUNT", *extra]), "true"),
        *((_window(prefix, label, window_cols), f"{time} >= {back}") for label, back in windows.items()),
        *((_decay(prefix, c, time, decay), f"{c} IS NOT NULL") for c in decayed),
        *(_trend(prefix, c, time) for c in trends),
    ]


def _monthly_cols(prefix: str, numbers, windows, window_cols, decayed, trends, loans) -> list[str]:
    return [
        *(f"{prefix}_{c}_{s}" for c in numbers for s in _FIVE), f"{prefix}_COUNT",
        *(f"{prefix}_{w}_{c}_{s}" for w in windows for c in window_cols for s in _THREE), *(f"{prefix}_{w}_COUNT" for w in windows),
        *(f"{n}_{s}" for n in loans for s in _LOAN), *(f"{prefix}_{c}_TWMEAN" for c in decayed), *(f"{prefix}_{c}_TREND" for c in trends),
    ]


_MONTHS = {"3M": -3, "6M": -6, "12M": -12, "24M": -24}
_POS_PL = {"POS_PL_DPD_MAX": "max(SK_DPD)", "POS_PL_DPD_MEAN": "avg(SK_DPD)", "POS_PL_LATE_RATE": "avg(LATE_POS)", "POS_PL_MONTHS": "count(MONTHS_BALANCE)"}
_POS_NUMBERS = ["MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD_RATIO", "LATE_POS"]
_POS_WINDOW = ["SK_DPD", "SK_DPD_DEF", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"]
_POS_PARTS = _monthly(
    "POS", "MONTHS_BALANCE", _POS_NUMBERS, _MONTHS, _POS_WINDOW, ["SK_DPD", "CNT_INSTALMENT_FUTURE"], 0.02, ["SK_DPD"],
    [*(f"avg(CASE WHEN NAME_CONTRACT_STATUS = '{v}' THEN 1.0 ELSE 0 END) AS POS_NAME_CONTRACT_STATUS_{v}" for v in ("Active", "Completed")),
     "avg(CASE WHEN NAME_CONTRACT_STATUS IS NULL THEN 1.0 ELSE 0 END) AS POS_NAME_CONTRACT_STATUS_nan", "sum(LATE_POS) / count(*) AS POS_LATE_RATE"],
) + [("count(*) AS done", "NAME_CONTRACT_STATUS = 'Completed'")]
POS_COLS = _monthly_cols("POS", _POS_NUMBERS, _MONTHS, _POS_WINDOW, ["SK_DPD", "CNT_INSTALMENT_FUTURE"], ["SK_DPD"], _POS_PL) + [
    *(f"POS_NAME_CONTRACT_STATUS_{v}" for v in ("Active", "Completed", "nan")), "POS_LATE_RATE", "POS_COMPLETED_RATE",
]


def builder_pos(spark, root):
    return _every(C.pos_features(role(spark, root, "pos")))


_POS_SQL = "SELECT *, done / POS_COUNT AS POS_COMPLETED_RATE FROM (" + _with_per_loan(
    role_sql("pos") + ", b AS (SELECT *, SK_DPD / (SK_DPD_DEF + 1) AS SK_DPD_RATIO, CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END AS LATE_POS FROM pos)", _POS_PARTS, _POS_PL
) + ")"

_CC_PL = {"CC_PL_BAL_LIM_MAX": "max(CC_BAL_LIM_RATIO)", "CC_PL_BAL_LIM_MEAN": "avg(CC_BAL_LIM_RATIO)", "CC_PL_DRAW_MEAN": "avg(CC_DRAW_LIM)",
          "CC_PL_DPD_MAX": "max(SK_DPD)", "CC_PL_LATE_RATE": "avg(CC_LATE)"}
_CC_NUMBERS = [
    "MONTHS_BALANCE", "SK_DPD", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_TOTAL_RECEIVABLE", "AMT_DRAWINGS_CURRENT",
    "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT", "CC_BAL_LIM_RATIO", "CC_PAY_TOTAL_RATIO", "CC_DRAW_LIM", "CC_MIN_PAY_RATIO", "CC_LATE",
]
_CC_WINDOW, _CC_DECAYED, _CC_TRENDS = ["AMT_BALANCE", "CC_BAL_LIM_RATIO", "CC_DRAW_LIM", "SK_DPD"], ["AMT_BALANCE", "CC_BAL_LIM_RATIO", "SK_DPD"], ["AMT_BALANCE", "CC_BAL_LIM_RATIO"]
_CC_PARTS = _monthly("CC", "MONTHS_BALANCE", _CC_NUMBERS, _MONTHS, _CC_WINDOW, _CC_DECAYED, 0.02, _CC_TRENDS, ["sum(CC_LATE) / count(*) AS CC_LATE_RATE"])
CC_COLS = _monthly_cols("CC", _CC_NUMBERS, _MONTHS, _CC_WINDOW, _CC_DECAYED, _CC_TRENDS, _CC_PL) + ["CC_LATE_RATE"]


def builder_card(spark, root):
    return _every(C.card_features(role(spark, root, "card")))


_CC_SQL = _with_per_loan(
    role_sql("card") + """, b AS (SELECT *, AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL + 1, 0) AS CC_BAL_LIM_RATIO, AMT_PAYMENT_TOTAL_CURRENT / nullif(AMT_TOTAL_RECEIVABLE + 1, 0) AS CC_PAY_TOTAL_RATIO,
 AMT_DRAWINGS_CURRENT / nullif(AMT_CREDIT_LIMIT_ACTUAL + 1, 0) AS CC_DRAW_LIM, CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END AS CC_LATE, AMT_INST_MIN_REGULARITY / nullif(AMT_PAYMENT_CURRENT + 1, 0) AS CC_MIN_PAY_RATIO FROM card)""",
    _CC_PARTS, _CC_PL,
)

_INS_PL = {
    "INS_PL_DPD_MEAN": "avg(DPD)", "INS_PL_DPD_MAX": "max(DPD)", "INS_PL_LATE_SUM": "sum(LATE_PAYMENT)", "INS_PL_LATE_RATE": "avg(LATE_PAYMENT)",
    "INS_PL_PAYPERC_MEAN": "avg(PAYMENT_PERC)", "INS_PL_PAYPERC_MIN": "min(PAYMENT_PERC)", "INS_PL_PAYDIFF_MAX": "max(PAYMENT_DIFF)", "INS_PL_COUNT": "count(*)",
}
_INS_NUMBERS = [
    "NUM_INSTALMENT_VERSION", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT", "DPD", "DBD", "PAYMENT_PERC", "PAYMENT_DIFF", "LATE_PAYMENT",
    "SIGNIFICANT_UNDERPAY",
]
_INS_BACK = {"6M": -180, "1Y": -365, "2Y": -730}
_INS_WINDOW, _INS_DECAYED, _INS_TRENDS = ["DPD", "PAYMENT_PERC", "PAYMENT_DIFF", "LATE_PAYMENT"], ["DPD", "PAYMENT_PERC", "PAYMENT_DIFF"], ["DPD", "PAYMENT_PERC"]
_INS_PARTS = _monthly(
    "INS", "DAYS_INSTALMENT", _INS_NUMBERS, _INS_BACK, _INS_WINDOW, _INS_DECAYED, 0.001, _INS_TRENDS,
    ["avg(LATE_PAYMENT) AS INS_LATE_RATE", "avg(SIGNIFICANT_UNDERPAY) AS INS_SIGUNDERPAY_RATE", "count(DISTINCT NUM_INSTALMENT_VERSION) AS INS_VERSION_NUNIQUE",
     "max(NUM_INSTALMENT_VERSION) AS INS_VERSION_MAX", "avg(NUM_INSTALMENT_VERSION) AS INS_VERSION_MEAN"],
)
_INS_KS = (3, 5, 10, 30)
_INS_RANKED = ", o AS (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_INSTALMENT DESC NULLS LAST, DAYS_ENTRY_PAYMENT DESC NULLS LAST, AMT_INSTALMENT DESC NULLS LAST, AMT_PAYMENT DESC NULLS LAST, SK_ID_PREV DESC NULLS LAST) AS rn FROM b)" + "".join(
    f", k{k} AS (SELECT SK_ID_CURR, avg(DPD) AS INS_LAST{k}_DPD_MEAN, max(DPD) AS INS_LAST{k}_DPD_MAX, avg(PAYMENT_PERC) AS INS_LAST{k}_PAYPERC_MEAN, avg(PAYMENT_DIFF) AS INS_LAST{k}_PAYDIFF_MEAN, avg(LATE_PAYMENT) AS INS_LAST{k}_LATE_RATE FROM o WHERE rn <= {k} GROUP BY 1)"
    for k in _INS_KS
)
INS_COLS = _monthly_cols("INS", _INS_NUMBERS, _INS_BACK, _INS_WINDOW, _INS_DECAYED, _INS_TRENDS, _INS_PL) + [
    "INS_LATE_RATE", "INS_SIGUNDERPAY_RATE", "INS_VERSION_NUNIQUE", "INS_VERSION_MAX", "INS_VERSION_MEAN",
    *(f"INS_LAST{k}_{s}" for k in _INS_KS for s in ("DPD_MEAN", "DPD_MAX", "PAYPERC_MEAN", "PAYDIFF_MEAN", "LATE_RATE")),
]


def builder_installments(spark, root):
    return _every(C.installment_features(role(spark, root, "installments")))


_INS_SQL = _with_per_loan(
    role_sql("installments") + """, b AS (SELECT *, AMT_PAYMENT / nullif(AMT_INSTALMENT + 0.001, 0) AS PAYMENT_PERC, AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
 CASE WHEN DAYS_ENTRY_PAYMENT IS NOT NULL THEN greatest(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, 0) END AS DPD, CASE WHEN DAYS_ENTRY_PAYMENT IS NOT NULL THEN greatest(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, 0) END AS DBD,
 CASE WHEN DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT THEN 1 ELSE 0 END AS LATE_PAYMENT, CASE WHEN AMT_INSTALMENT - AMT_PAYMENT > 100 THEN 1 ELSE 0 END AS SIGNIFICANT_UNDERPAY FROM installments)""",
    _INS_PARTS, _INS_PL, _INS_RANKED, " ".join(f"LEFT JOIN k{k} USING (SK_ID_CURR)" for k in _INS_KS),
)

QUERIES = {
    "builder_application": builder_application, "builder_bureau": builder_bureau, "builder_previous": builder_previous,
    "builder_pos": builder_pos, "builder_card": builder_card, "builder_installments": builder_installments,
}
ORACLES = {
    "builder_application": _scaled_sql(_APP_SQL, APP_COLS, APP_BIG, 12), "builder_bureau": _scaled_sql(_BURO_SQL, BURO_COLS, BURO_BIG, 12),
    "builder_previous": _scaled_sql(_PREV_SQL, PREV_COLS, PREV_BIG), "builder_pos": _every_sql(_POS_SQL, POS_COLS),
    "builder_card": _every_sql(_CC_SQL, CC_COLS), "builder_installments": _every_sql(_INS_SQL, INS_COLS),
}
