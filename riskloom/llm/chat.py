"""Chat formatting by perspective rotation: every participant once as the assistant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

START, END = "<|im_start|>", "<|im_end|>"


def rotate(turns: DataFrame, part_turns: int | None = None) -> DataFrame:
    """Dialogues as seen by each of their participants: ``conv_id, part, participant, n_turns, text, mask, mask_chars``.

    ``turns`` is ``conv_id, turn, role, text``. For every participant the whole dialogue is rendered
    with that speaker as ``assistant`` and the others as ``user`` with their name; ``system`` turns
    stay system turns and are nobody's perspective. ``mask`` lists the character ranges
    ``start:end`` of the text (0-based, end excluded) that carry loss: what the participant says
    and its end mark.

    A rendering is one row, so a task holds a dialogue whole. ``part_turns``, off by default, cuts
    dialogues by row position into parts of so many turns, for any that no row can hold: every
    participant of the dialogue gets every part, and system turns of earlier parts come first in it.

    Turns with equal numbers are ordered by role and text, repeated rows are kept. A null turn
    comes first; a null role speaks as ``unknown``; a null text is empty. Null conversations form
    one conversation. Marks inside texts are broken up by a space. A dialogue with system turns
    only gives no row, and neither does an empty table. Other columns are ignored.
    """
    role = F.coalesce(F.col("role"), F.lit("unknown"))
    said = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    rows = turns.select("conv_id", F.struct(F.col("turn").alias("turn"), role.alias("role"), said.alias("said")).alias("t"))
    if part_turns is None:
        parts = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts")).withColumn("part", F.lit(0).cast("long"))
        speakers = F.array_distinct(F.filter(F.transform("ts", lambda t: t["role"]), lambda r: r != "system"))
        seen = parts.select("conv_id", "part", "ts", F.explode(speakers).alias("participant"))
    else:
        seen = _cut(rows, part_turns)

    def piece(t):
        mine = t["role"] == F.col("participant")
        head = F.when(mine, F.lit("assistant")).when(t["role"] == "system", F.lit("system")).otherwise(F.concat(F.lit("user name="), t["role"]))
        head = F.concat(F.lit(START), head, F.lit("\n"))
        body = F.concat(t["said"], F.lit(END))
        return F.struct(mine.alias("mine"), head.alias("head"), body.alias("body"))

    seen = seen.withColumn("ps", F.transform("ts", piece))
    whole = F.transform("ps", lambda p: F.concat(p["head"], p["body"], F.lit("\n")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).alias("chars"))

    def step(acc, p):
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.array(F.concat(start.cast("string"), F.lit(":"), end.cast("string")))
        return F.struct(
            (end + 1).alias("at"), F.when(p["mine"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
            (acc["chars"] + F.when(p["mine"], end - start).otherwise(0)).alias("chars"),
        )

    return seen.withColumn("text", F.array_join(whole, "")).withColumn("m", F.aggregate("ps", empty, step)).select(
        "conv_id", "part", "participant", F.size("ts").cast("long").alias("n_turns"), "text",
        F.array_join("m.spans", ",").alias("mask"), F.col("m.chars").cast("long").alias("mask_chars"),
    )


def _cut(rows: DataFrame, part_turns: int) -> DataFrame:
    """``conv_id, part, ts, participant`` of dialogues cut by row position."""
    position = F.row_number().over(W.partitionBy("conv_id").orderBy("t"))
    placed = rows.withColumn("part", F.floor((position - 1) / part_turns).cast("long"))
    whole = placed.groupBy(F.col("conv_id").alias("of")).agg(
        F.max("part").alias("last"), F.collect_set(F.when(F.col("t.role") != "system", F.col("t.role"))).alias("speakers")
    )
    joined = placed.join(whole, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    # What a part repeats of earlier ones stands before its own turns.
    again = joined.where("t.role = 'system' AND part < last").select("conv_id", F.explode(F.sequence(F.col("part") + 1, F.col("last"))).alias("part"), "t", "speakers")
    own = joined.select("conv_id", "part", F.lit(1).alias("own"), "t", "speakers").union(again.select("conv_id", "part", F.lit(0), "t", "speakers"))
    parts = own.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("own", "t"))).alias("ts"), F.first("speakers").alias("speakers"))
    return parts.select("conv_id", "part", F.transform("ts", lambda x: x["t"]).alias("ts"), F.explode("speakers").alias("participant"))


CHAT_SQL = r"""
WITH t AS (
    SELECT conv_id, 0::BIGINT AS part, turn, coalesce(role, 'unknown') AS role,
           replace(coalesce(text, ''), '<|im_', '<| im_') AS said FROM conversations
), n AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, role, said) AS i FROM t
), seen AS (
    SELECT n.*, p.participant, n.role = p.participant AS mine,
           '<|im_start|>' || CASE WHEN n.role = p.participant THEN 'assistant' WHEN n.role = 'system' THEN 'system' ELSE 'user name=' || n.role END || chr(10) AS head,
           said || '<|im_end|>' AS body
    FROM n JOIN (SELECT DISTINCT conv_id, part, role AS participant FROM t WHERE role <> 'system') p
      ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.part = p.part
), placed AS (
    SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, part, participant ORDER BY i) - length(body) - 1 AS start FROM seen
)
SELECT conv_id, part, participant, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY i) AS text,
       string_agg(CASE WHEN mine THEN start || ':' || (start + length(body)) END, ',' ORDER BY i) AS mask,
       coalesce(sum(length(body)) FILTER (WHERE mine), 0)::BIGINT AS mask_chars
FROM placed GROUP BY conv_id, part, participant
"""
