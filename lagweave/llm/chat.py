"""Preference formatting of chosen and rejected conversations, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def distinct_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, said (role, text): one row for each turn; of several the least in role, then text. Rows without conv_id or turn take no part; a null role is 'unknown', a null text empty."""
    said = F.struct(F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).groupBy("conv_id", "turn").agg(F.min(said).alias("said"))


def rendered(said: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), said["role"], F.lit("\n"), said["text"], F.lit("<|im_end|>\n"))


def preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """The formatted turns of conversations that both sides have: conv_id, part, turn, role, rendered, loss.

    part 'prompt' holds the longest prefix of turns that are the same on both sides, once; 'chosen' and
    'rejected' hold what follows it on each side. loss is false on the prompt and on turns of other
    roles than assistant, whose tokens a trainer masks. A conversation's text is the concatenation of
    its parts in the order of turns; it stays one row per turn, so that no conversation, however long,
    has to fit in one row. Both sides are distinct_turns() tables. A conversation that only one side has
    is left out; equal sides give a prompt and no completion. Very long turns are rows like any other; columns
    besides the four do not matter, whatever their names.
    """
    both = chosen.select("conv_id", "turn", "said", F.lit(True).alias("good")).unionByName(rejected.select("conv_id", "turn", "said", F.lit(False).alias("good")))
    turns = both.groupBy("conv_id", "turn").agg(F.max(F.when(F.col("good"), F.col("said"))).alias("chosen"), F.max(F.when(~F.col("good"), F.col("said"))).alias("rejected"))
    same = F.col("chosen").eqNullSafe(F.col("rejected"))
    sides = turns.groupBy("conv_id").agg(F.min(F.when(~same, F.col("turn"))).alias("parts_at"), F.count("chosen").alias("n_chosen"), F.count("rejected").alias("n_rejected"))
    whole = turns.join(sides.filter("n_chosen > 0 and n_rejected > 0").select("conv_id", "parts_at"), "conv_id")
    before = F.col("parts_at").isNull() | (F.col("turn") < F.col("parts_at"))
    part = lambda name, said: F.struct(F.lit(name).alias("part"), F.col(said).alias("said"))
    cut = whole.select("conv_id", "turn", F.explode(F.when(before, F.array(part("prompt", "chosen"))).otherwise(F.array(part("chosen", "chosen"), part("rejected", "rejected")))).alias("x"))
    said = F.col("x.said")
    return cut.filter(said.isNotNull()).select("conv_id", F.col("x.part").alias("part"), "turn", said["role"].alias("role"), rendered(said).alias("rendered"), ((F.col("x.part") != "prompt") & (said["role"] == "assistant")).alias("loss"))


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as chosen, against itself with the last turn of its neighbour (2k and 2k + 1 are neighbours) in place of its own last turn.

    A conversation whose neighbour is not there keeps its own last turn on both sides, and so is all prompt; none is left out."""
    turns = distinct_turns(table(spark, sf_dir, "conversations"))
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"), F.max_by("said", "turn").alias("end"))
    other = last.select(F.expr("conv_id ^ 1").alias("conv_id"), F.col("end").alias("other"))
    ends = last.join(other, "conv_id", "left").select("conv_id", "last", F.coalesce("other", "end").alias("other"))
    swapped = turns.join(ends.select("conv_id", "last"), "conv_id").filter("turn < last").select("conv_id", "turn", "said")
    rejected = swapped.unionByName(ends.select("conv_id", F.col("last").alias("turn"), F.col("other").alias("said")))
    return preferences(turns, rejected)


OP4_SQL = """
WITH turns AS (
  SELECT conv_id, turn, min(row(coalesce(role, 'unknown'), coalesce(text, ''))) AS said FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
last AS (SELECT conv_id, max(turn) AS last, arg_max(said, turn) AS said FROM turns GROUP BY ALL),
ends AS (SELECT a.conv_id, a.last, coalesce(b.said, a.said) AS said FROM last a LEFT JOIN last b ON b.conv_id = xor(a.conv_id, 1)),
rejected AS (
  SELECT t.conv_id, t.turn, t.said FROM turns t JOIN ends e ON t.conv_id = e.conv_id AND t.turn < e.last
  UNION ALL SELECT conv_id, last, said FROM ends),
pairs AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn, c.said AS chosen, r.said AS rejected
  FROM (SELECT * FROM turns WHERE conv_id IN (SELECT conv_id FROM ends)) c
  FULL JOIN rejected r ON c.conv_id = r.conv_id AND c.turn = r.turn),
cut AS (SELECT conv_id, min(turn) FILTER (chosen IS DISTINCT FROM rejected) AS parts_at FROM pairs GROUP BY ALL),
parts AS (
  SELECT p.conv_id, 'prompt' AS part, turn, chosen AS said FROM pairs p JOIN cut USING (conv_id) WHERE parts_at IS NULL OR turn < parts_at
  UNION ALL SELECT p.conv_id, 'chosen', turn, chosen FROM pairs p JOIN cut USING (conv_id) WHERE turn >= parts_at
  UNION ALL SELECT p.conv_id, 'rejected', turn, rejected FROM pairs p JOIN cut USING (conv_id) WHERE turn >= parts_at)
SELECT conv_id, part, turn, said[1] AS role, '<|im_start|>' || said[1] || chr(10) || said[2] || '<|im_end|>' || chr(10) AS rendered,
  part <> 'prompt' AND said[1] = 'assistant' AS loss
FROM parts WHERE said IS NOT NULL
"""
