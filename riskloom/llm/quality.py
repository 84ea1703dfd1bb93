"""Quality rules with risk-controlled cutoffs: exact binomial tests on labelled rows, per stratum."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.native import starts, words
from riskloom.session import materialize

#: Fixed before any label is seen: the share of each defect that counts as one unit of the score.
SCALES = {"symbols": 0.07, "dup_lines": 0.50, "repeats": 0.20, "shouting": 0.40}
#: Cutoffs on the score from lenient to strict, tried in this order.
CUTOFFS = (4.0, 3.0, 2.0, 1.5, 1.0)


def text_counts(docs: DataFrame, keep: Sequence[str] = ("doc_id",), window: int = 5) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouts.

    Everything is one projection: no shuffle, whatever a text's length. Null, empty and blank
    texts count 0 throughout. ``n_lines`` are lines with a word; ``n_shouts`` are runs of two or
    more capitals. Windows are compared by 64-bit hashes of their words within one text.
    """
    text, ws = F.coalesce(F.col("text"), F.lit("")), F.col("ws")
    base = docs.select(*keep, text.alias("_t")).withColumn("ws", words(F.col("_t"))).withColumn("n", F.size("ws"))
    base = base.select(
        *keep, "n", F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split(F.col("_t"), "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "").alias("lines"),
        F.regexp_count("_t", F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_shouts"),
        F.transform(starts("n", window), lambda i: F.xxhash64(*(F.get(ws, i + k) for k in range(window)))).alias("h"),
    )
    base = base.withColumn("s", F.sort_array("h"))
    twice = F.exists(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.get("s", i) == F.get("s", i - 1))
    base = base.withColumn("twice", (F.size("s") > 1) & twice)
    # Pairs (hash, start) in order: a start repeats if a neighbour has its hash.
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    base = base.withColumn("p", F.when(F.col("twice"), pairs))
    near = lambda i, d: F.coalesce(F.get(F.col("p"), i + d)["x"] == F.get(F.col("p"), i)["x"], F.lit(False))
    hit = F.filter(F.transform("p", lambda x, i: F.when((i > 0) & near(i, -1) | near(i, 1), x["i"])), lambda x: x.isNotNull())
    base = base.withColumn("at", F.sort_array(hit))
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size("at") - 1), F.lit(0),
        lambda acc, k: acc + F.coalesce(F.least(F.get("at", k + 1) - F.get("at", k), F.lit(window)), F.lit(window)),
    )
    return base.select(
        *keep, F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("twice"), covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), "n_shouts",
    )


def defect_score(scales: Mapping[str, float] = SCALES) -> Column:
    """The largest defect share in units of its scale: one number that only grows with any defect."""
    def share(a, b, unit):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b) / F.lit(unit)).otherwise(F.lit(0.0))

    return F.greatest(
        share("n_symbols", "word_chars", scales["symbols"]), share("n_dup_lines", "n_lines", scales["dup_lines"]),
        share("n_repeat_words", "n_words", scales["repeats"]), share("n_shouts", "n_words", scales["shouting"]),
    )


def binomial_tail(n: Column, x: Column, risk: float) -> Column:
    """P(Binomial(n, risk) <= x), summed term by term from logarithms; 1 at once if x is above the mean."""
    zero = F.struct((n * F.log1p(F.lit(-risk))).alias("term"), F.exp(n * F.log1p(F.lit(-risk))).alias("total"))
    odds = F.log(F.lit(risk / (1 - risk)))

    def step(acc, k):
        term = acc["term"] + F.log((n - k + 1) / k) + odds
        return F.struct(term.alias("term"), (acc["total"] + F.exp(term)).alias("total"))

    ladder = F.when(x >= 1, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<bigint>"))
    return F.when(x > n * risk, F.lit(1.0)).otherwise(F.aggregate(ladder, zero, step, lambda acc: acc["total"]))


def certified_cutoffs(
    labelled: DataFrame, risk: float = 0.05, delta: float = 0.1, cutoffs: Sequence[float] = CUTOFFS
) -> DataFrame:
    """The strictest cutoff per stratum whose false rejection rate is certified: ``stratum, cutoff``.

    ``labelled`` holds ``stratum, score, quality``. A cutoff rejects scores above it, and errs on a
    row of quality 1. It is certified if the chance of so few errors, were the true rate above
    ``risk``, is at most ``delta`` over the number of strata (Bonferroni). Inside a stratum the
    cutoffs are tested in their fixed order and the first failure ends the sequence, which needs
    no further correction. All labelled rows count. A stratum without a certified cutoff is
    absent: nothing is rejected there.
    """
    good = labelled.where(F.col("quality") == 1)
    errors = [F.count_if(F.col("score") > F.lit(c)).alias(f"e{i}") for i, c in enumerate(cutoffs)]
    counts = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *errors)
    counted = materialize(counts, "risk-counts")
    m = max(1, counted.count())
    passed = F.lit(True)
    best = F.lit(None).cast("double")
    for i, c in enumerate(cutoffs):
        passed = passed & (binomial_tail(F.col("n"), F.col(f"e{i}"), risk) <= F.lit(delta / m))
        best = F.when(passed, F.lit(c)).otherwise(best)
    return counted.select("stratum", best.alias("cutoff")).where(F.col("cutoff").isNotNull())


def _limits(counts: DataFrame, labels: DataFrame, stratum: str, risk: float, delta: float) -> DataFrame:
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = counts.join(marked, "doc_id").select(F.col(stratum).alias("stratum"), "score", "quality")
    return materialize(certified_cutoffs(labelled, risk, delta), "risk-cutoffs")


def _decided(counts: DataFrame, limits: DataFrame, stratum: str) -> DataFrame:
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    above = F.coalesce((F.col("score") > F.col("cutoff")).cast("int"), F.lit(0))
    # One comparison that needs both sides of the join: as a filter it stays above the join, where the
    # counts are columns, and is not spelled out into the text expressions below.
    return (
        counts.join(limits, F.col(stratum).eqNullSafe(F.col("stratum")), "left")
        .withColumn("base_failed", failed).withColumn("kept", F.greatest(failed.cast("int"), above) == 0)
    )


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05, delta: float = 0.1) -> DataFrame:
    """Counts and verdict per document: ``doc_id, <stratum>, n_words, ..., base_failed, cutoff, kept``.

    ``labels`` is ``doc_id, quality``; a document labelled twice counts as good only if every label
    says so, and null labels are ignored. A null stratum is a stratum of its own. Documents that
    repeat an id are judged each by its own text. Other columns are ignored; an empty table gives
    an empty result, and without labels only the base rules reject.
    """
    counts = materialize(text_counts(docs, ("doc_id", stratum)).withColumn("score", defect_score()), "quality-counts")
    decided = _decided(counts, _limits(counts, labels, stratum, risk, delta), stratum)
    return decided.drop("stratum", "score", "n_lines", "n_shouts")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05, delta: float = 0.1) -> DataFrame:
    """The documents that :func:`judge` keeps, all columns unchanged.

    Cutoffs come from one pass over all documents; a second pass applies them where the texts are,
    so that no text is shuffled.
    """
    counts = materialize(text_counts(docs, ("doc_id", stratum)).withColumn("score", defect_score()), "quality-counts")
    limits = _limits(counts, labels, stratum, risk, delta)
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(stratum).alias("_stratum"), "text")
    scored = text_counts(packed, ("_row", "_stratum")).withColumn("score", defect_score())
    return _decided(scored, limits, "_stratum").where("kept").select("_row.*")


def _share(a: str, b: str, unit: float) -> str:
    return f"CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} / {unit} ELSE 0 END"


_SCORE_SQL = "greatest({}, {}, {}, {})".format(
    _share("n_symbols", "word_chars", SCALES["symbols"]), _share("n_dup_lines", "n_lines", SCALES["dup_lines"]),
    _share("n_repeat_words", "n_words", SCALES["repeats"]), _share("n_shouts", "n_words", SCALES["shouting"]),
)

QUALITY_SQL = rf"""
WITH split AS (
    SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), grams AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM split)
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1
), gaps AS (
    SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS c FROM twice
), covered AS (
    SELECT doc_id, sum(c) AS n_repeat_words FROM gaps GROUP BY doc_id
), counts AS (
    SELECT s.doc_id, lang, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           len(lines)::BIGINT AS n_lines, len(regexp_extract_all(t, '\p{{Lu}}{{2,}}'))::BIGINT AS n_shouts
    FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id
), scored AS (
    SELECT *, {_SCORE_SQL} AS score FROM counts
), good AS (
    SELECT lang, score FROM scored JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) USING (doc_id)
    WHERE quality = 1
), errors AS (
    SELECT lang, cutoff, count(*) AS n, count(*) FILTER (WHERE score > cutoff) AS x
    FROM good, (SELECT unnest([{", ".join(map(str, CUTOFFS))}]::DOUBLE[]) AS cutoff) GROUP BY lang, cutoff
), tests AS (
    SELECT lang, cutoff, CASE WHEN x > n * 0.05 THEN 1.0 ELSE list_sum(list_transform(range(0, x + 1),
               lambda k: exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.05) + (n - k) * ln(0.95)))) END
           <= 0.1 / (SELECT count(*) FROM (SELECT DISTINCT lang FROM good)) AS passed FROM errors
), limits AS (
    SELECT lang, min(cutoff) AS cutoff FROM (
        SELECT *, bool_and(passed) OVER (PARTITION BY lang ORDER BY cutoff DESC) AS so_far FROM tests) WHERE so_far GROUP BY lang
), judged AS (
    SELECT s.*, l.cutoff, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
    FROM scored s LEFT JOIN limits l ON s.lang IS NOT DISTINCT FROM l.lang
)
SELECT doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, cutoff,
       NOT base_failed AND NOT coalesce(score > cutoff, false) AS kept
FROM judged
"""
