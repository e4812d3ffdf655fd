"""Preference formatting: the common turns of two conversations as one prompt, the rest as masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: What stands before and after a turn's text; {role} is the turn's role.
HEAD_BEGIN, HEAD_END, TURN_END = "<|", "|>\n", "<|end|>\n"
#: Roles whose words a model is trained on.
TRAINED_ROLES = ("assistant",)


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order of (turn, role, text), nulls first.

    Rows with a null conv_id belong to no conversation and are left out; null roles and texts become empty.
    A conversation is one training example, so its turns are gathered into one row.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    known = conversations.filter(F.col("conv_id").isNotNull())
    return known.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that agree in role and text."""
    n = F.least(F.size(a), F.size(b))
    same = F.transform(F.sequence(F.lit(1), n), lambda i: (F.element_at(a, i)["role"] == F.element_at(b, i)["role"]) & (F.element_at(a, i)["text"] == F.element_at(b, i)["text"]))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(n).cast("int")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD_BEGIN), turn["role"], F.lit(HEAD_END))


def render(turns: Column) -> Column:
    """Turns one after the other: head, text, end."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(TURN_END))), "")


def trained_spans(turns: Column, roles: tuple[str, ...] = TRAINED_ROLES) -> Column:
    """(begin, end) in characters of render(turns) that are trained on: text and end of the turns of `roles`.

    Everything else, the heads too, is masked.
    """
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<begin:int,end:int>>)").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_head(turn))
        end = begin + F.length(turn["text"]) + len(TURN_END)
        span = F.array(F.struct(begin.cast("int").alias("begin"), end.cast("int").alias("end")))
        spans = F.when(turn["role"].isin(*roles), F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.cast("int").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def format_preferences(conversations: DataFrame, pairs: DataFrame, roles: tuple[str, ...] = TRAINED_ROLES) -> DataFrame:
    """Preference examples for pairs (pair_id, chosen_id, rejected_id) of conversations (conv_id, turn, role, text).

    The longest common prefix of turns (equal role and text) is rendered once as `prompt`; the turns after
    it are `chosen` and `rejected`, each with the spans that are trained on. Conversations that agree wholly
    give empty completions, those that differ at once an empty prompt. A side whose conversation doesn't
    exist (or whose id is null) has null turns: common is 0, its completion and spans are null. Every pair
    gives one row, repeated pairs too; conversations in no pair give none; empty tables give no rows.
    """
    turns = conversation_turns(conversations)
    sides = pairs.select("pair_id", "chosen_id", "rejected_id")
    sides = sides.join(turns.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("a")), "chosen_id", "left")
    sides = sides.join(turns.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("b")), "rejected_id", "left")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    cut = sides.withColumn("common", F.when(both, common_turns(F.col("a"), F.col("b"))).otherwise(F.lit(0)))
    rest = {side: F.slice(F.col(side), F.col("common") + 1, F.greatest(F.size(side), F.lit(1))) for side in "ab"}
    return cut.select(
        "pair_id", "chosen_id", "rejected_id", "common",
        F.coalesce(render(F.slice("a", F.lit(1), F.col("common"))), F.lit("")).alias("prompt"),
        render(rest["a"]).alias("chosen"), render(rest["b"]).alias("rejected"),
        trained_spans(rest["a"], roles).alias("chosen_spans"), trained_spans(rest["b"], roles).alias("rejected_spans"),
    )


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs of conversations 2k (chosen) and 2k + 1 (rejected), for tables that name no preferences.

    A conversation without its neighbour is paired with a null id.
    """
    ids = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id").distinct()
    pair = F.shiftright("conv_id", 1)  # halves of all longs, rounded down
    side = F.col("conv_id").bitwiseAND(F.lit(1))
    return ids.groupBy(pair.alias("pair_id")).agg(
        F.max(F.when(side == 0, F.col("conv_id"))).alias("chosen_id"), F.max(F.when(side == 1, F.col("conv_id"))).alias("rejected_id"))
