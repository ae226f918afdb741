"""Preference formatting: the shared turns of two conversations as one prompt, the rest as masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import pick, table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turns(df: DataFrame, side: str) -> DataFrame:
    """pair_id and the side's turns in order; ties of a turn number go by role, then text."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = df.where(F.col("side") == side).groupBy("pair_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.select("pair_id", plain.alias(side))


def _render(turns: Column) -> Column:
    one = lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(f"{CLOSE}\n"))
    return F.array_join(F.transform(turns, one), "")


def _spans(turns: Column) -> Column:
    """start and stop, in characters of the rendered completion, of what a model is trained to write: assistant texts with their end marks."""
    step = lambda acc, t: F.struct(
        (acc["at"] + F.length(t["role"]) + F.length(t["text"]) + len(OPEN) + len(CLOSE) + 2).alias("at"),
        F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(t["role"]) + len(OPEN) + 1).alias("start"), (acc["at"] + F.length(t["role"]) + F.length(t["text"]) + len(OPEN) + len(CLOSE) + 2).alias("stop"))))).otherwise(acc["spans"]).alias("spans"),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("spans"))
    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def preference_format(df: DataFrame) -> DataFrame:
    """One row per pair from rows of pair_id, side (chosen or rejected), turn, role, text.

    n_prompt_turns, prompt, chosen, rejected (rendered texts) and chosen_mask, rejected_mask (spans of the
    completion that count towards a loss). The prompt is the longest run of leading turns equal in role and text.
    Null roles and texts count as empty; a null turn number comes first; repeated rows are repeated turns. A pair
    with one side only has an empty other side. Equal conversations have empty completions. Rows with a null
    pair_id form one pair; other sides and columns are ignored; an empty table gives no rows.
    """
    rows = pick(df, "pair_id", "side", "turn", "role", "text")
    left, right = _turns(rows, "chosen"), _turns(rows, "rejected").withColumnRenamed("pair_id", "other_id")
    both = left.join(right, F.col("pair_id").eqNullSafe(F.col("other_id")), "full_outer").withColumn("pair_id", F.coalesce("pair_id", "other_id"))
    empty = F.expr("cast(array() as array<struct<role:string,text:string>>)")
    both = both.withColumns({s: F.coalesce(s, empty) for s in ("chosen", "rejected")})
    least = F.least(F.size("chosen"), F.size("rejected"))
    differ = F.filter(F.sequence(F.lit(0), least), lambda i: (i == least) | (F.get(F.col("chosen"), i) != F.get(F.col("rejected"), i)))
    both = both.withColumn("n_prompt_turns", F.get(differ, F.lit(0)))
    rest = {s: F.slice(s, F.col("n_prompt_turns") + 1, F.greatest(F.size(s), F.lit(1))) for s in ("chosen", "rejected")}
    both = both.withColumn("prompt", _render(F.slice("chosen", F.lit(1), F.col("n_prompt_turns")))).withColumns(rest)
    return both.select("pair_id", "n_prompt_turns", "prompt", *(_render(F.col(s)).alias(s) for s in rest), *(_spans(F.col(s)).alias(f"{s}_mask") for s in rest))


def conversation_pairs(df: DataFrame, odd: bool = False) -> DataFrame:
    """Preference pairs made of single conversations, two neighbouring ids each.

    A pair's chosen side is the conversation with the even id, or with `odd` that with the odd one. Its rejected side is the same with
    the last assistant turn answered by the last assistant turn of the other, where both have one, and ends there; without it the
    rejected side is the other conversation itself. Where several rows have the number of the last assistant turn, all assistant
    rows of it are answered, by the greatest text of the other's. Rows with a null conv_id belong to no conversation and are left
    out; null turns come first, null texts are empty, other columns are ignored, an empty table gives no rows.
    """
    rows = pick(df, "conv_id", "turn", "role", "text").withColumns({"pair_id": F.expr("cast((conv_id - pmod(conv_id, 2)) div 2 as long)"), "own": (F.col("conv_id") % 2 != 0) == F.lit(odd)})
    ends = rows.groupBy("pair_id").agg(
        F.max(F.when((F.col("role") == "assistant") & F.col("own"), F.col("turn"))).alias("at"),
        F.max(F.when((F.col("role") == "assistant") & ~F.col("own"), F.struct("turn", "text"))).alias("reply"),
    )
    chosen = rows.where("own").withColumn("side", F.lit("chosen"))
    joined = rows.join(ends, "pair_id")
    swap = F.col("at").isNotNull() & F.col("reply").isNotNull()
    swapped = joined.where(swap & F.col("own") & (F.col("turn") <= F.col("at")))
    swapped = swapped.withColumn("text", F.when((F.col("turn") == F.col("at")) & (F.col("role") == "assistant"), F.col("reply.text")).otherwise(F.col("text")))
    other = joined.where(~swap & ~F.col("own"))
    rejected = swapped.unionByName(other).withColumn("side", F.lit("rejected"))
    columns = ["pair_id", "side", "turn", "role", "text"]
    return chosen.select(*columns).unionByName(rejected.select(*columns))


def conversation_preferences(df: DataFrame) -> DataFrame:
    """Each conversation chosen once: preference_format's columns for the even one of each pair, and as other_... for the odd one.

    Rows with a null conv_id are the chosen side of one more row, whose pair_id is null; it has no rejected side and nulls as other_....
    """
    nulls = pick(df, "conv_id", "turn", "role", "text").where("conv_id is null")
    nulls = nulls.select(F.col("conv_id").cast("long").alias("pair_id"), F.lit("chosen").alias("side"), "turn", "role", "text")
    out = preference_format(conversation_pairs(df).unionByName(nulls))
    other = preference_format(conversation_pairs(df, odd=True))
    return out.join(other.toDF("pair_id", *(f"other_{c}" for c in other.columns[1:])), "pair_id", "left")


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = conversation_preferences(table(spark, sf_dir, "conversations"))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ";")
    return out.withColumns({c: text(c) for c in out.columns if c.endswith("_mask")})
