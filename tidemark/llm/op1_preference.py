"""Preference formatting: one prompt for the turns two conversations share, and two completions.

The turns of a pair's chosen and rejected conversation are compared in order; the
longest common prefix of turns (equal role and text) is rendered once as the prompt. What
follows in each conversation is rendered as its completion, with the character spans
that count in training: the text of the assistant's turns and the mark that ends them. All of it is
DataFrame functions: one grouping by pair, then higher-order functions over its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is written: head, text, tail.
HEAD = ("<|", "|>\n")
TAIL = "<|end|>\n"

SPANS = "array<struct<start:int,`end`:int>>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD[0]), turn["role"], F.lit(HEAD[1]))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(TAIL))), "")


def _spans(turns: Column, trained_role: str) -> Column:
    """[start, end) in the rendered text of the trained role's texts and tails."""
    def add(state: Column, turn: Column) -> Column:
        start = state["at"] + F.char_length(_head(turn))
        end = start + F.char_length(turn["text"]) + F.lit(len(TAIL))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(turn["role"] == trained_role, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), SPANS).alias("spans"))
    return F.aggregate(turns, begin, add, lambda s: s["spans"])


def format_pairs(turns: DataFrame, *, pair_col: str = "pair_id", side_col: str = "side", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """(pair, n_prefix, n_chosen, n_rejected, prompt, chosen, chosen_spans, rejected, rejected_spans), a row per pair.

    ``turns`` has a row per turn; its side is 'chosen' or 'rejected' (other rows, and rows without a
    pair, have no place in a pair and are left out). A null turn number comes first, null roles and texts count
    as empty; turns of equal number are ordered by role and text, so the result doesn't
    depend on the order of rows; a repeated row is a turn of its own. A pair with one side only has an empty other side and an empty
    prompt. One conversation is one row of the result, so its turns are held together.
    """
    side = F.col("side")
    named = turns.select(F.col(pair_col).alias("pair"), F.col(side_col).alias("side"),
                         F.struct(F.col(turn_col).alias("n"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                                  F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    named = named.where(F.col("pair").isNotNull() & side.isin("chosen", "rejected"))

    def of(name: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(side == name, F.col("t")))), lambda t: F.struct(t["role"], t["text"])).alias(name)

    def rest(name: str) -> Column:
        return F.slice(name, F.col("n_prefix") + 1, F.size(name))

    pairs = named.groupBy("pair").agg(of("chosen"), of("rejected"))
    differs = F.array_position(F.zip_with("chosen", "rejected", lambda a, b: F.coalesce(a == b, F.lit(False))), False)
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    pairs = pairs.withColumn("n_prefix", F.when(differs > 0, differs.cast("int") - 1).otherwise(shorter))
    return pairs.select(
        F.col("pair").alias(pair_col), "n_prefix", F.size(rest("chosen")).alias("n_chosen"), F.size(rest("rejected")).alias("n_rejected"),
        _rendered(F.slice("chosen", 1, F.col("n_prefix"))).alias("prompt"),
        _rendered(rest("chosen")).alias("chosen"), _spans(rest("chosen"), trained_role).alias("chosen_spans"),
        _rendered(rest("rejected")).alias("rejected"), _spans(rest("rejected"), trained_role).alias("rejected_spans"))


def pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """Preference turns from plain conversations: each one is chosen; what is rejected depends on its number modulo 4.

    0: the same with the last turn's text taken from the last turn of the conversation before it (by number), if there is one;
    1: its turns up to the middle, then those of the conversation before it; 2: the same without its last turn; 3: the same, but
    the last turn is said by the other side.
    """
    c = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null")
    ends = c.groupBy("conv_id").agg(F.max("turn").alias("last"), F.max(F.struct("turn", "role", "text")).alias("t"))
    donor = ends.select((F.col("conv_id") + 1).alias("conv_id"), F.col("t.text").alias("other"), F.lit(True).alias("given"))
    c = c.join(ends.select("conv_id", "last").join(donor, "conv_id", "left"), "conv_id").withColumn("kind", F.pmod("conv_id", F.lit(4)))
    at_last, turn = F.coalesce(F.col("turn") == F.col("last"), F.lit(False)), [F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"), "turn"]
    other_side = F.when(F.col("role") == "assistant", "user").otherwise("assistant")
    own = c.where("kind <> 1").where(~((F.col("kind") == 2) & at_last)).select(
        *turn, F.when((F.col("kind") == 3) & at_last, other_side).otherwise(F.col("role")).alias("role"),
        F.when((F.col("kind") == 0) & at_last & F.col("given"), F.col("other")).otherwise(F.col("text")).alias("text"))
    middle = F.floor(F.col("last") / 2)
    before = F.col("turn").isNull() | (F.col("turn") < middle)
    begun = c.where("kind = 1").where(before).select(*turn, "role", "text")
    cut = ends.where(F.pmod("conv_id", F.lit(4)) == 1).select("conv_id", middle.alias("middle"))
    lent = conversations.select((F.col("conv_id") + 1).alias("conv_id"), "turn", "role", "text").join(cut, "conv_id").where(F.col("turn") >= F.col("middle")).select(*turn, "role", "text")
    chosen = c.select(F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"), "turn", "role", "text")
    return chosen.unionByName(own).unionByName(begun).unionByName(lent)


def listed(spans: str) -> Column:
    """Spans as start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
