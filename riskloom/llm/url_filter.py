"""URL verdicts: host and path rules first, boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.session import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = ("f_length", "f_host_length", "f_labels", "f_depth", "f_digits", "f_hyphens", "f_entropy", "f_params", "f_suffix_rows", "f_suffix_blocked")


class Rule(NamedTuple):
    """``verdict`` for the host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str


RULES = (
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``: host with A-Z lower-cased, and path; both empty without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_for(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null. Equal lengths: the longer host, then block."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "block")):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        name, verdict = F.when(fits, r.host + r.path).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def lexical(df: DataFrame) -> DataFrame:
    """Adds the features of the text of ``url`` and ``host``; null urls count as empty."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url)
    times = lambda text: n - F.length(F.replace(url, text, F.lit("")))
    letters = F.array_distinct(F.split(url, ""))
    share = lambda c: times(c) / n
    entropy = F.aggregate(letters, F.lit(0.0), lambda acc, c: acc - F.when(times(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0))
    return df.withColumns({
        "suffix": F.substring_index("host", ".", -2),
        "f_length": n.cast("double"), "f_host_length": F.length("host").cast("double"),
        "f_labels": F.size(F.split("host", r"\.")).cast("double"), "f_depth": times(F.lit("/")).cast("double"),
        "f_digits": F.when(n > 0, F.length(F.regexp_replace(url, r"[^0-9]", "")) / n).otherwise(0.0),
        "f_hyphens": F.length(F.regexp_replace("host", r"[^-]", "")).cast("double"),
        "f_entropy": F.when(n > 0, entropy).otherwise(0.0),
        "f_params": (times(F.lit("=")) + times(F.lit("&"))).cast("double"),
    })


def with_suffix(df: DataFrame, labelled: DataFrame, own: Column, prior: float = 20.0) -> DataFrame:
    """Adds rows and smoothed blocked share of the url's suffix over all labelled rows.

    ``own`` is the row's own label (1, 0 or null); it is taken out of the statistics, so that a
    training row is not told its label.
    """
    stats = labelled.groupBy("suffix").agg(F.count(F.lit(1)).alias("s_rows"), F.sum("label").alias("s_blocked"))
    stats = materialize(stats, "url-suffixes")
    rate = stats.agg(F.coalesce(F.sum("s_blocked") / F.sum("s_rows"), F.lit(0.0))).first()[0]
    rows = F.coalesce(F.col("s_rows"), F.lit(0)) - F.when(own.isNotNull(), 1).otherwise(0)
    blocked = F.coalesce(F.col("s_blocked"), F.lit(0)) - F.coalesce(own, F.lit(0))
    return df.join(stats, "suffix", "left").withColumns({
        "f_suffix_rows": F.log1p(F.greatest(rows, F.lit(0)).cast("double")),
        "f_suffix_blocked": (blocked + F.lit(prior * rate)) / (F.greatest(rows, F.lit(0)) + F.lit(prior)),
    }).drop("s_rows", "s_blocked")


def fit(labelled: DataFrame, train_rows: int = 20_000, rounds: int = 20, depth: int = 4):
    """Boosted trees on at most about ``train_rows`` distinct labelled urls, half of them for either label.

    ``labelled`` has the features and ``label`` (1 block, 0 allow). A url counts once, however many
    rows it has, and weighs as many; both labels weigh the same in all. Each label is sampled by a
    hash of the url at its own rate, and a label with fewer urls than its half is taken whole, so
    no label is lost to the sample. Suffix statistics inside cover all labelled rows. Returns None
    if only one label occurs: then there is nothing to learn.
    """
    urls = materialize(labelled.groupBy("url", "label", *FEATURES).agg(F.count(F.lit(1)).alias("rows")), "url-labelled")
    sizes = {r["label"]: r for r in urls.groupBy("label").agg(F.count(F.lit(1)).alias("urls"), F.sum("rows").alias("rows")).collect()}
    if len(sizes) < 2:
        return None
    rate, weight = F.lit(0.0), F.lit(0.0)
    for label, r in sizes.items():
        share = min(1.0, train_rows / 2 / r["urls"])
        rate = F.when(F.col("label") == label, share).otherwise(rate)
        weight = F.when(F.col("label") == label, F.col("rows") / (share * r["rows"])).otherwise(weight)
    picked = urls.where(F.pmod(F.xxhash64("url", F.lit("sample")), F.lit(1 << 30)) < rate * (1 << 30))
    # Weights of one on average, as the trees' least gains expect.
    picked = picked.withColumn("weight", weight * sum(min(r["urls"], train_rows / 2) for r in sizes.values()) / 2)
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(picked).select("features", F.col("label").cast("double"), "weight")
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, subsamplingRate=1.0, weightCol="weight", seed=7, checkpointInterval=-1)
    return trees.fit(materialize(table, "url-train"))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, labels: DataFrame | None = None, train_rows: int = 20_000) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per page: the rule's verdict, else the trees'.

    ``labels`` is ``(url, label)`` with 1 for block. Without it the urls that a rule decides are
    the labelled ones, and the trees carry the rules over to the others. Null urls and urls
    without ``://`` have empty host and path. If the labels hold one kind only, every url without
    a rule gets ``allow``. Repeated rows are judged each. Rules are few and become one
    expression; their number is bounded by the length of the plan, some hundreds.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    known = lexical(parts.withColumn("rule", name).withColumn("ruled", verdict))
    if labels is None:
        labelled = known.where(F.col("ruled").isNotNull()).withColumn("label", (F.col("ruled") == "block").cast("int"))
    else:
        lhost, lpath = host_and_path(F.col("url"))
        labelled = lexical(labels.select("url", F.col("label").cast("int").alias("label"), lhost.alias("host"), lpath.alias("path")).where("url IS NOT NULL AND label IS NOT NULL"))
    model = fit(with_suffix(labelled, labelled, F.col("label")), train_rows)
    if model is None:
        return known.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"))
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_suffix(known, labelled, F.lit(None).cast("int")))
    return model.transform(ready).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("prediction") == 1.0, "block").otherwise("allow")).alias("verdict"),
    )
