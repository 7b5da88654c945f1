"""Perspective rotation of multi-party dialogues, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with that speaker
as the assistant, all others as named users, and masks over the assistant's own words.
Turns come in segments of a fixed number of turn numbers, so no task ever holds a whole
long conversation; the segments of a perspective, joined in order, are its dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turn numbers in one segment.
SEGMENT = 64
#: Rows of a segment that stay together.
ROWS = 4096
SYSTEM = ("system",)


def _safe(text: Column) -> Column:
    """Text that cannot open or close a turn by itself."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def segments(turns: DataFrame, size: int = SEGMENT, most: int = ROWS) -> DataFrame:
    """(conv_id, segment, part, turns): the rows of ``size`` turn numbers, in order.

    Repeated rows count once. Rows of one turn stand in order of role and text; rows
    without a turn number come first, in segment -1. A segment of more than ``most`` rows
    (many rows of one turn number, or without one) comes in parts of about so many, by a
    hash of the row, so no array grows with the table; other segments are part 0.
    """
    rows = turns.select("conv_id", "turn", "role", "text").distinct()
    segment = F.coalesce(F.floor(F.col("turn") / size), F.lit(-1)).cast("long")
    rows = rows.withColumn("segment", segment)
    large = rows.groupBy(F.col("conv_id").alias("conv"), F.col("segment").alias("at")).agg(
        F.count(F.lit(1)).alias("rows")).where(F.col("rows") > most)
    same = rows.conv_id.eqNullSafe(F.col("conv")) & (rows.segment == F.col("at"))
    part = F.pmod(F.xxhash64("turn", "role", "text"), F.ceil(F.col("rows") / most))
    return (rows.join(large, same, "left").withColumn("part", F.coalesce(part, F.lit(0)).cast("long"))
            .groupBy("conv_id", "segment", "part")
            .agg(F.array_sort(F.collect_list(F.struct(
                F.coalesce("turn", F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text")))).alias("turns")))


def rotate(turns: DataFrame, size: int = SEGMENT, system: tuple[str, ...] = SYSTEM,
           most: int = ROWS) -> DataFrame:
    """One row per conversation, participant, segment and part.

    ``turns`` has conv_id, turn, role (the speaker's name) and text. Columns:
    conv_id, perspective, segment, part, n_turns, text, ``mask`` (array of start, end: the code
    points of ``text`` to train on, the perspective's words and their end marks) and
    n_trained (code points under the mask). Speakers in ``system`` take no perspective and
    stay system turns; a conversation of such alone gives no row. A null speaker is
    the participant ''; a null text is empty; an empty table gives no rows.
    """
    speakers = (turns.select("conv_id", F.coalesce("role", F.lit("")).alias("perspective"))
                .where(~F.col("perspective").isin(*system)).distinct())
    seg = segments(turns, size, most)
    both = (seg.join(speakers, seg.conv_id.eqNullSafe(speakers.conv_id))
            .select(seg.conv_id, "perspective", "segment", "part", "turns"))

    def pieces(t: Column) -> Column:
        """(head, body, own) of a turn as seen by the perspective."""
        own = t["role"] == F.col("perspective")
        head = (F.when(t["role"].isin(*system), F.lit("<|im_start|>system\n"))
                .when(own, F.lit("<|im_start|>assistant\n"))
                .otherwise(F.concat(F.lit("<|im_start|>user name="),
                                    F.regexp_replace(_safe(t["role"]), r"\s", "_"), F.lit("\n"))))
        return F.struct(head.alias("head"), F.concat(_safe(t["text"]), F.lit("<|im_end|>")).alias("body"),
                        own.alias("own"))

    start = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def step(acc: Column, p: Column) -> Column:
        a = acc["at"] + F.length(p["head"])
        b = a + F.length(p["body"])
        span = F.array(F.struct(a.alias("start"), b.alias("end")))
        return F.struct((b + 1).alias("at"), F.when(p["own"], F.concat(acc["mask"], span))
                        .otherwise(acc["mask"]).alias("mask"))

    return (both.withColumn("pieces", F.transform("turns", pieces))
            .withColumn("mask", F.aggregate("pieces", start, step)["mask"])
            .select("conv_id", "perspective", "segment", "part",
                    F.size("pieces").cast("long").alias("n_turns"),
                    F.array_join(F.transform("pieces", lambda p: F.concat(
                        p["head"], p["body"], F.lit("\n"))), "").alias("text"),
                    "mask",
                    F.aggregate("mask", F.lit(0), lambda s, m: s + m["end"] - m["start"])
                    .cast("long").alias("n_trained")))


#: The query's rows in DuckDB SQL; no segment of the given tables has over ROWS rows.
ORACLE = """
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text,
         CASE WHEN turn IS NULL THEN -1 ELSE CAST(floor(turn / 64.0) AS BIGINT) END AS segment
  FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
r AS (
  SELECT t.conv_id, perspective, segment, turn, role, text, role = perspective AS own,
         CASE WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN role = perspective THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name='
                   || regexp_replace(replace(role, '<|', '< |'), '\\s', '_', 'g') || chr(10) END AS head,
         replace(text, '<|', '< |') || '<|im_end|>' AS body
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (
           PARTITION BY conv_id, perspective, segment ORDER BY turn, role, text
           ROWS UNBOUNDED PRECEDING) - 1 AS stop
  FROM r)
SELECT conv_id, perspective, segment, 0::BIGINT AS part, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY turn, role, text) AS text,
       coalesce(string_agg(CAST(stop - length(body) AS BIGINT) || '-' || CAST(stop AS BIGINT), ' '
                           ORDER BY turn, role, text) FILTER (WHERE own), '') AS mask,
       CAST(coalesce(sum(length(body)) FILTER (WHERE own), 0) AS BIGINT) AS n_trained
FROM s GROUP BY conv_id, perspective, segment
"""
