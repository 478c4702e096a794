"""Preference formatting: one prompt, two masked completions.

The turns that a chosen and a rejected conversation share from the start, the longest common prefix of (role, text), are
rendered once as the prompt. What follows in each is rendered as its completion, with the spans of characters that count
for the loss: the assistants' texts with their end mark. Everything else (headers, other roles) is masked.

Turns are ordered by (turn, role, text); null roles and texts render as empty and equal each other. A pair that lacks one
side has an empty completion there. Equal conversations have two empty completions. Repeated rows stay repeated turns.
Pairs with a null id are left out. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, MIDDLE, END = "<|", "|>\n", "<|end|>\n"


def _turns(side: DataFrame, name: str) -> DataFrame:
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return side.filter(F.col("pair_id").isNotNull()).groupBy("pair_id").agg(F.transform(F.array_sort(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name))


def _piece(t: Column) -> Column:
    return F.concat(F.lit(START), t["role"], F.lit(MIDDLE), t["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _piece), "")


def loss_spans(turns: Column, trained: str = "assistant") -> Column:
    """(start, end) in characters of render(turns), end excluded, for the turns of the trained role."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(a, t):
        end = a["at"] + F.length(_piece(t))
        start = a["at"] + F.length(F.concat(F.lit(START), t["role"], F.lit(MIDDLE)))
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(t["role"] == trained, F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda a: a["spans"])


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """chosen, rejected: pair_id, turn, role, text. Per pair: n_common, prompt, chosen, rejected, chosen_loss, rejected_loss."""
    both = _turns(chosen, "a").join(_turns(rejected, "b"), "pair_id", "full_outer")
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = both.select("pair_id", F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))
    differ = F.transform(F.arrays_zip("a", "b"), lambda z: ~z["a"].eqNullSafe(z["b"]))
    both = both.withColumn("n_common", F.when(F.array_contains(differ, True), F.array_position(differ, True).cast("int") - 1).otherwise(F.size("a")))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0)))
    both = both.select("pair_id", "n_common", F.slice("a", F.lit(1), F.col("n_common")).alias("p"), rest("a").alias("a"), rest("b").alias("b"))
    return both.select(
        "pair_id", "n_common", render(F.col("p")).alias("prompt"), render(F.col("a")).alias("chosen"), render(F.col("b")).alias("rejected"),
        loss_spans(F.col("a")).alias("chosen_loss"), loss_spans(F.col("b")).alias("rejected_loss"),
    )


def stale_reply_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from a table with conversations alone. chosen: a conversation up to its last assistant turn; rejected: the
    same, but the last reply repeats the assistant's reply before it (empty if there is none). Conversations without an
    assistant turn give no pair.
    """
    c = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    w = W.partitionBy("pair_id")
    said = F.when(F.col("role") == "assistant", F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))
    c = c.withColumn("last", F.max(said).over(w)["turn"]).filter(F.col("turn") <= F.col("last"))
    before = F.when((F.col("role") == "assistant") & (F.col("turn") < F.col("last")), F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))
    c = c.withColumn("before", F.coalesce(F.max(before).over(w)["text"], F.lit("")))
    chosen = c.select("pair_id", "turn", "role", "text")
    rejected = c.select("pair_id", "turn", "role", F.when((F.col("turn") == F.col("last")) & (F.col("role") == "assistant"), F.col("before")).otherwise(F.col("text")).alias("text"))
    return chosen, rejected
