"""Encoders, folds, samples, ranks and score metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.roles import role, role_sql, table
from riskloom.catalog.shape import rounded, rounded_sql
from riskloom.functions.exprs import flag
from riskloom.operators import encoding as E
from riskloom.operators import folds as D
from riskloom.operators import ranking as R
from riskloom.operators.selection import correlated_with_earlier, correlations, top_rows
from riskloom.session import materialize

SEED, FOLDS = 42, 5


def _hash_sql(key: str, seed=SEED) -> str:
    return f"CAST('0x' || substr(md5('{seed}_' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


def freq_encode(spark, root):
    docs = role(spark, root, "docs").select("doc_id", "source", "lang")
    return rounded(E.frequency_encode(docs, ["source", "lang"]), 8)


FREQ_SQL = rounded_sql(
    role_sql("docs")
    + """, s AS (SELECT coalesce(source, '__nan__') AS k, count(*) AS n FROM docs GROUP BY 1),
l AS (SELECT coalesce(lang, '__nan__') AS k, count(*) AS n FROM docs GROUP BY 1), t AS (SELECT count(*) AS n FROM docs)
SELECT doc_id, source, lang, CAST(s.n AS DOUBLE) AS "source_FREQ", s.n / t.n AS "source_FREQ_NORM", CAST(l.n AS DOUBLE) AS "lang_FREQ", l.n / t.n AS "lang_FREQ_NORM"
FROM docs JOIN s ON s.k = coalesce(source, '__nan__') JOIN l ON l.k = coalesce(lang, '__nan__'), t""",
    ["source_FREQ", "source_FREQ_NORM", "lang_FREQ", "lang_FREQ_NORM"],
    8,
)


def group_relative(spark, root):
    cust = table(spark, root, "customer").select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("size"),
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("segment"), F.col("c_nationkey").alias("nation"),
    )
    return rounded(E.group_relative(cust, ["segment", "nation"], ["c_acctbal", "size"]))


_GR = [(c, n) for c in ("segment", "nation") for n in ("c_acctbal", "size")]
GROUP_RELATIVE_SQL = rounded_sql(
    """WITH k AS (SELECT c_custkey, c_acctbal, CAST(c_nationkey AS DOUBLE) AS size, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS segment, c_nationkey AS nation FROM customer), """
    + ", ".join(
        f"g_{c}_{n} AS (SELECT {c} AS key, avg({n}) AS m, quantile_cont({n}, 0.5) AS md, stddev_samp({n}) AS sd FROM k WHERE {c} IS NOT NULL GROUP BY 1)"
        for c, n in _GR
    )
    + " SELECT k.*, "
    + ", ".join(
        f'g_{c}_{n}.m AS "GB_{c}_{n}_MEAN", g_{c}_{n}.md AS "GB_{c}_{n}_MEDIAN", g_{c}_{n}.sd AS "GB_{c}_{n}_STD", '
        f'k.{n} - g_{c}_{n}.m AS "GB_{c}_{n}_DIFF", k.{n} / nullif(g_{c}_{n}.m + 1e-6, 0) AS "GB_{c}_{n}_RATIO"'
        for c, n in _GR
    )
    + " FROM k "
    + " ".join(f"LEFT JOIN g_{c}_{n} ON k.{c} = g_{c}_{n}.key" for c, n in _GR),
    ["c_acctbal", "size"] + [f"GB_{c}_{n}_{s}" for c, n in _GR for s in E.GROUP_FEATURES],
)


def target_encode_full(spark, root):
    docs = role(spark, root, "docs").select("doc_id", "source", "lang", "quality")
    out = E.target_encode(docs, ["source", "lang"], "quality", None, F.col("quality").isNotNull(), 40, 20)
    return rounded(out)


TE_FULL_SQL = rounded_sql(
    role_sql("docs")
    + ", g AS (SELECT avg(quality) AS g FROM docs), "
    + ", ".join(
        f"s_{c} AS (SELECT {c} AS k, CASE WHEN count(*) < 20 THEN max(g) ELSE (count(*) * avg(quality) + 40 * max(g)) / (count(*) + 40) END AS te "
        f"FROM docs, g WHERE quality IS NOT NULL AND {c} IS NOT NULL GROUP BY {c})"
        for c in ("source", "lang")
    )
    + """ SELECT doc_id, source, lang, quality, coalesce(s_source.te, g) AS "source_TE", coalesce(s_lang.te, g) AS "lang_TE"
FROM docs LEFT JOIN s_source ON source = s_source.k LEFT JOIN s_lang ON lang = s_lang.k, g""",
    ["source_TE", "lang_TE"],
)


def target_encode_oof(spark, root):
    cust = table(spark, root, "customer").select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).alias("nation"),
        F.when(F.col("c_custkey") % 5 != 0, flag(F.col("c_acctbal") < 0)).alias("label"),
        D.hash_fold("c_custkey", FOLDS, SEED).alias("fold"),
    )
    return rounded(E.target_encode(cust, ["c_mktsegment", "nation"], "label", "fold", F.col("label").isNotNull(), 40, 45))


_FOLD_CTE = f"""WITH k AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS nation,
 CASE WHEN c_custkey % 5 <> 0 THEN CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END END AS label, CAST({_hash_sql('c_custkey')} % {FOLDS} AS INT) AS fold FROM customer),
g AS (SELECT avg(label) AS g FROM k)"""


def _oof_sql(c: str) -> str:
    """Fold by fold: fit on the train rows of the other folds, then on all train rows for the rest."""
    fit = "CASE WHEN count(*) < 45 THEN max(g) ELSE (count(*) * avg(label) + 40 * max(g)) / (count(*) + 40) END"
    parts = [
        f"SELECT {c} AS key, {f} AS f, {fit} AS te FROM k, g WHERE label IS NOT NULL AND {c} IS NOT NULL AND fold <> {f} GROUP BY {c}"
        for f in range(FOLDS)
    ]
    parts.append(f"SELECT {c}, -1, {fit} FROM k, g WHERE label IS NOT NULL AND {c} IS NOT NULL GROUP BY {c}")
    return " UNION ALL ".join(parts)


TE_OOF_SQL = rounded_sql(
    _FOLD_CTE
    + f", s AS ({_oof_sql('c_mktsegment')}), n AS ({_oof_sql('nation')})"
    + """ SELECT k.*, coalesce(s.te, g) AS "c_mktsegment_TE", coalesce(n.te, g) AS "nation_TE"
FROM k LEFT JOIN s ON s.key = c_mktsegment AND s.f = CASE WHEN label IS NULL THEN -1 ELSE fold END
 LEFT JOIN n ON n.key = nation AND n.f = CASE WHEN label IS NULL THEN -1 ELSE fold END, g""",
    ["c_mktsegment_TE", "nation_TE"],
)


def fold_assign(spark, root):
    cust = table(spark, root, "customer").select("c_custkey", flag(F.col("c_acctbal") < 0).alias("label"))
    exact = D.stratified_folds(cust, "c_custkey", "label", FOLDS, SEED).withColumnRenamed("fold", "stratified_fold")
    return cust.join(exact, "c_custkey").withColumn("hash_fold", D.hash_fold("c_custkey", FOLDS, SEED))


FOLD_SQL = f"""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS label,
 CAST((row_number() OVER (PARTITION BY c_acctbal < 0 ORDER BY {_hash_sql('c_custkey')}, c_custkey) - 1) % {FOLDS} AS INT) AS stratified_fold,
 CAST({_hash_sql('c_custkey')} % {FOLDS} AS INT) AS hash_fold FROM customer"""


def group_fold(spark, root):
    orders = table(spark, root, "orders")
    return orders.withColumn("fold", D.hash_fold("o_custkey", FOLDS, SEED)).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("clients"), F.min("o_orderkey").alias("first_order")
    )


GROUP_FOLD_SQL = f"""SELECT CAST({_hash_sql('o_custkey')} % {FOLDS} AS INT) AS fold, count(*) AS n, count(DISTINCT o_custkey) AS clients, min(o_orderkey) AS first_order
FROM orders GROUP BY 1"""


def _scores(spark, root):
    """Three scores per client, with ties, and the label."""
    return table(spark, root, "customer").select(
        "c_custkey", flag(F.col("c_acctbal") < 0).alias("label"),
        (F.round(F.lit(9999) - F.col("c_acctbal"), -2) / 11000 + F.pmod(F.col("c_custkey") * 7, F.lit(13)) / 400).alias("s1"),
        (F.pmod(F.col("c_custkey") * 31, F.lit(97)) / 97 - F.col("c_acctbal") / 20000).alias("s2"),
        (F.pmod(F.col("c_custkey") * 17, F.lit(11)) / 11).alias("s3"),
    )


_SCORES_CTE = """WITH s AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS label,
 round(9999 - c_acctbal, -2) / 11000 + (c_custkey * 7 % 13) / 400 AS s1, (c_custkey * 31 % 97) / 97 - c_acctbal / 20000 AS s2, (c_custkey * 17 % 11) / 11 AS s3 FROM customer)"""


def _rank_sql(score: str, source: str = "s") -> str:
    return f"(rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2) / (SELECT count(*) FROM {source})"


def rank_norm(spark, root):
    cust = table(spark, root, "customer").select("c_custkey", F.round("c_acctbal", -1).alias("score"))
    return rounded(R.rank_norm(cust, "score", "rank"), 8)


RANK_SQL = rounded_sql(
    "WITH s AS (SELECT c_custkey, round(c_acctbal, -1) AS score FROM customer) SELECT c_custkey, score, " + _rank_sql("score") + " AS rank FROM s",
    ["score", "rank"],
    8,
)


def auc(spark, root):
    long = _scores(spark, root).unpivot(["label"], ["s1", "s2", "s3"], "model", "score")
    return rounded(R.auc(long, "score", "label", ["model"]), 8)


AUC_SQL = rounded_sql(
    _SCORES_CTE
    + ", l AS (SELECT 's1' AS model, s1 AS score, label FROM s UNION ALL SELECT 's2', s2, label FROM s UNION ALL SELECT 's3', s3, label FROM s)"
    + """ SELECT p.model, avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) AS auc
FROM l p JOIN l n ON p.model = n.model AND p.label = 1 AND n.label = 0 GROUP BY p.model""",
    ["auc"],
    8,
)


def rank_corr(spark, root):
    return rounded(R.rank_correlation(_scores(spark, root), ["s1", "s2", "s3"]), 8)


RANK_CORR_SQL = rounded_sql(
    _SCORES_CTE
    + f", r AS (SELECT {_rank_sql('s1')} AS r1, {_rank_sql('s2')} AS r2, {_rank_sql('s3')} AS r3 FROM s)"
    + " SELECT 's1|s2' AS pair, corr(r1, r2) AS rank_corr FROM r UNION ALL SELECT 's1|s3', corr(r1, r3) FROM r UNION ALL SELECT 's2|s3', corr(r2, r3) FROM r",
    ["rank_corr"],
    8,
)

_RANKS = ["r1", "r2", "r3"]


def _ranked(spark, root):
    ranked = R.rank_norms(_scores(spark, root), {f"s{i}": f"r{i}" for i in "123"})
    return ranked.select("c_custkey", "label", *_RANKS)


def rank_blend(spark, root):
    return rounded(R.rank_blend(_ranked(spark, root), _RANKS, [0.5, 0.3, 0.2], "blend"), 8)


RANK_BLEND_SQL = rounded_sql(
    _SCORES_CTE
    + f", r AS (SELECT c_custkey, label, {_rank_sql('s1')} AS r1, {_rank_sql('s2')} AS r2, {_rank_sql('s3')} AS r3 FROM s)"
    + " SELECT *, 0.5 * r1 + 0.3 * r2 + 0.2 * r3 AS blend FROM r",
    ["r1", "r2", "r3", "blend"],
    8,
)

_GRID = R.weight_grid(3, 0.2, 0.6)
_SEARCH_BINS = 1000


def blend_search(spark, root):
    """AUC of every weight vector of the grid, on scores in 1/1000 steps."""
    out = R.candidate_aucs(_ranked(spark, root), _RANKS, "label", dict(enumerate(_GRID)), _SEARCH_BINS)
    return rounded(out.select(F.col("candidate"), "auc"), 6)


BLEND_SEARCH_SQL = rounded_sql(
    _SCORES_CTE
    + f", r AS (SELECT label, {_rank_sql('s1')} AS r1, {_rank_sql('s2')} AS r2, {_rank_sql('s3')} AS r3 FROM s), "
    + "w(candidate, w1, w2, w3) AS (VALUES "
    + ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for i, (a, b, c) in enumerate(_GRID))
    + f"""), b AS (SELECT candidate, label, floor((w1 * r1 + w2 * r2 + w3 * r3) * {_SEARCH_BINS}) AS score FROM r, w),
h AS (SELECT candidate, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM b GROUP BY 1, 2)
SELECT CAST(p.candidate AS INT) AS candidate, sum(p.pos * n.neg * CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) / sum(p.pos * n.neg) AS auc
FROM h p JOIN h n ON p.candidate = n.candidate GROUP BY p.candidate""",
    ["auc"],
    6,
)


def corr_filter(spark, root):
    li = table(spark, root, "lineitem").select(
        "l_quantity", F.when(F.col("l_partkey") % 4 != 0, F.col("l_extendedprice")).alias("price"), "l_discount", "l_tax",
        (F.col("l_quantity") * 2 + F.col("l_tax")).alias("quantity2"),
        F.when(F.col("l_suppkey") % 3 != 0, -F.col("l_discount") * 5 + F.col("l_tax") / 50).alias("neg_discount"),
    )
    names = F.array(*(F.lit(c) for c in li.columns))
    found = materialize(correlations(li, li.columns), "correlations")
    dropped = {li.columns[j] for j in correlated_with_earlier(found)}
    pairs = found.select(
        F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"), "corr"
    )
    return rounded(pairs.withColumn("b_dropped", flag(F.col("b").isin(sorted(dropped)))))


_CC = ("l_quantity", "price", "l_discount", "l_tax", "quantity2", "neg_discount")
CORR_SQL = rounded_sql(
    """WITH x AS (SELECT l_quantity, CASE WHEN l_partkey % 4 <> 0 THEN l_extendedprice END AS price, l_discount, l_tax, l_quantity * 2 + l_tax AS quantity2,
 CASE WHEN l_suppkey % 3 <> 0 THEN -l_discount * 5 + l_tax / 50 END AS neg_discount FROM lineitem), p AS ("""
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM x" for i, a in enumerate(_CC) for b in _CC[i + 1 :])
    + ") SELECT a, b, corr, CAST(max(CASE WHEN abs(corr) > 0.985 THEN 1 ELSE 0 END) OVER (PARTITION BY b) AS INT) AS b_dropped FROM p",
    ["corr"],
)


def top_n(spark, root):
    part = table(spark, root, "part").select("p_partkey", "p_retailprice", "p_brand")
    return top_rows(part, "p_retailprice", 400, ["p_partkey"])


TOP_SQL = "SELECT p_partkey, p_retailprice, p_brand FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 400"


def hash_sample(spark, root):
    return D.hash_sample(table(spark, root, "part"), "p_partkey", 300, SEED).select("p_partkey", "p_brand")


SAMPLE_SQL = f"SELECT p_partkey, p_brand FROM part ORDER BY {_hash_sql('p_partkey')}, p_partkey LIMIT 300"


def permute(spark, root):
    part = table(spark, root, "part").select("p_partkey", "p_brand", "p_size")
    return D.permute_column(part, "p_partkey", "p_size", SEED)


PERMUTE_SQL = f"""WITH a AS (SELECT p_partkey, p_brand, row_number() OVER (ORDER BY {_hash_sql('p_partkey', '42a')}, p_partkey) AS r FROM part),
b AS (SELECT p_size, row_number() OVER (ORDER BY {_hash_sql('p_partkey', '42b')}, p_partkey) AS r FROM part)
SELECT p_partkey, p_brand, p_size FROM a JOIN b USING (r)"""


def percentile_runs(spark, root):
    runs = role(spark, root, "activity").select("kind", "value")
    return rounded(R.exact_quantiles(runs, ["kind"], "value", 0.8, "p80"))


PERCENTILE_SQL = rounded_sql(role_sql("activity") + " SELECT kind, quantile_cont(value, 0.8) AS p80 FROM activity GROUP BY kind", ["p80"])

QUERIES = {
    "freq_encode": freq_encode, "group_relative": group_relative, "target_encode_full": target_encode_full,
    "target_encode_oof": target_encode_oof, "fold_assign": fold_assign, "group_fold": group_fold, "rank_norm": rank_norm,
    "auc": auc, "rank_corr": rank_corr, "rank_blend": rank_blend, "blend_search": blend_search, "corr_filter": corr_filter,
    "top_n": top_n, "hash_sample": hash_sample, "permute": permute, "percentile_runs": percentile_runs,
}
ORACLES = {
    "freq_encode": FREQ_SQL, "group_relative": GROUP_RELATIVE_SQL, "target_encode_full": TE_FULL_SQL,
    "target_encode_oof": TE_OOF_SQL, "fold_assign": FOLD_SQL, "group_fold": GROUP_FOLD_SQL, "rank_norm": RANK_SQL,
    "auc": AUC_SQL, "rank_corr": RANK_CORR_SQL, "rank_blend": RANK_BLEND_SQL, "blend_search": BLEND_SEARCH_SQL,
    "corr_filter": CORR_SQL, "top_n": TOP_SQL, "hash_sample": SAMPLE_SQL, "permute": PERMUTE_SQL, "percentile_runs": PERCENTILE_SQL,
}
