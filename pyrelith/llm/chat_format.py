"""Preference formatting: the common turns of two conversations once, then their completions with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The turn markup of the common ChatML convention.
OPEN, SEP, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(SEP), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def format_preferences(turns: DataFrame, pair: Column, chosen: Column, trained_role: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a pair: ``(pair_id, chosen_id, rejected_id, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans)``.

    ``pair`` names the pair that a row of ``turns`` belongs to and ``chosen`` says on which of its two
    sides it stands. The turns of a side are taken in order of (turn, role, text). The prompt is the
    longest run of first turns with equal role and text on both sides; it is rendered once, and what is
    left of each side is its completion. Spans ("from-to" in characters of the completion, comma between)
    are what the loss counts: the text and end mark of turns of ``trained_role``; all else, the prompt included, is masked.

    Where the first turns differ, the prompt is empty; where one side is a prefix of the other, its
    completion is empty. A pair without one of its sides keeps its row: the missing side is an empty
    conversation with a null id. Null roles and texts count as empty (and are equal to empty ones);
    repeated rows are turns each; rows with a null pair are left out, as they belong to none; an empty
    table gives no rows; other columns are not read.

    Where the sides part is found by a window over the pair's places, so it needs no whole conversation;
    only the render puts a conversation into one row, which is the result asked for.
    """
    t = turns.select(pair.alias("pair_id"), chosen.alias("side"), F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.where("pair_id is not null and side is not null")
    t = t.withColumn("at", F.row_number().over(Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")))
    t = t.withColumn("h", F.sha2(F.concat_ws("\x00", "role", "text"), 256))
    parts = t.groupBy("pair_id", "at").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("a"), F.max("h").alias("b"))
    parts = parts.groupBy("pair_id").agg(F.min(F.when((F.col("n") < 2) | (F.col("a") != F.col("b")), F.col("at"))).alias("parts_at"), (F.max("at") + 1).alias("end"))
    parts = parts.select("pair_id", (F.coalesce("parts_at", "end") - 1).alias("prompt_turns"))
    t = t.join(parts, "pair_id")
    t = t.withColumn("prompted", F.col("at") <= F.col("prompt_turns")).where("side or not prompted")
    t = t.withColumn("piece", rendered(F.col("role"), F.col("text"))).withColumn("head", F.length(F.concat(F.lit(OPEN), "role", F.lit(SEP))))
    before = Window.partitionBy("pair_id", "side", "prompted").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    span = F.concat((F.col("start") + F.col("head")).cast("string"), F.lit("-"), (F.col("start") + F.length("piece") - 1).cast("string"))
    t = t.withColumn("span", F.when((F.col("role") == trained_role) & ~F.col("prompted"), span))

    def text_of(where: Column, col: str, sep: str) -> Column:
        kept = F.sort_array(F.collect_list(F.when(where & F.col(col).isNotNull(), F.struct("at", col))))
        return F.array_join(F.transform(kept, lambda x: x[col]), sep)

    first, second = F.col("side"), ~F.col("side")
    out = t.groupBy("pair_id").agg(
        F.max("prompt_turns").alias("prompt_turns"),
        text_of(F.col("prompted"), "piece", "").alias("prompt"),
        text_of(first & ~F.col("prompted"), "piece", "").alias("chosen"),
        text_of(second & ~F.col("prompted"), "piece", "").alias("rejected"),
        text_of(first, "span", ",").alias("chosen_spans"),
        text_of(second, "span", ",").alias("rejected_spans"),
    )
    ids = turns.select(pair.alias("pair_id"), chosen.alias("side"), F.col(conv_col).alias("conv")).where("pair_id is not null")
    ids = ids.groupBy("pair_id").agg(F.min(F.when(F.col("side"), F.col("conv"))).alias("chosen_id"), F.min(F.when(~F.col("side"), F.col("conv"))).alias("rejected_id"))
    return out.join(ids, "pair_id").select("pair_id", "chosen_id", "rejected_id", "prompt_turns", "prompt", "chosen", "rejected", "chosen_spans", "rejected_spans")


def neighbouring_pairs(turns: DataFrame) -> DataFrame:
    """All conversations, paired by id: an even id is chosen over the odd one that follows it."""
    return format_preferences(turns, F.floor(F.col("conv_id") / 2).cast("long"), F.pmod("conv_id", F.lit(2)) == 0)


ORACLE = r"""
WITH t AS (SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, conv_id % 2 = 0 AS side, conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT pair_id, pos, count(*) AS n, min(role || chr(1) || text) AS a, max(role || chr(1) || text) AS b FROM t GROUP BY ALL),
q AS (SELECT pair_id, CAST(coalesce(min(CASE WHEN n < 2 OR a <> b THEN pos END), max(pos) + 1) - 1 AS INTEGER) AS prompt_turns FROM p GROUP BY pair_id),
u AS (SELECT t.*, prompt_turns, pos <= prompt_turns AS prompted, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS piece FROM t JOIN q USING (pair_id)),
w AS (SELECT *, CAST(coalesce(sum(length(piece)) OVER (PARTITION BY pair_id, side, prompted ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM u),
x AS (SELECT *, CASE WHEN role = 'assistant' AND NOT prompted THEN CAST(start + 13 + length(role) AS VARCHAR) || '-' || CAST(start + length(piece) - 1 AS VARCHAR) END AS span FROM w)
SELECT pair_id, min(CASE WHEN side THEN conv_id END) AS chosen_id, min(CASE WHEN NOT side THEN conv_id END) AS rejected_id, max(prompt_turns) AS prompt_turns,
  coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE prompted AND side), '') AS prompt,
  coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE side AND NOT prompted), '') AS chosen, coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE NOT side AND NOT prompted), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY pos) FILTER (WHERE side AND span IS NOT NULL), '') AS chosen_spans, coalesce(string_agg(span, ',' ORDER BY pos) FILTER (WHERE NOT side AND span IS NOT NULL), '') AS rejected_spans
FROM x GROUP BY pair_id
"""
