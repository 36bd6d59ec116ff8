"""Preference pairs as training examples.

A pair holds a chosen and a rejected conversation.  Their longest common
prefix of turns (same role and same text) is rendered once as the
prompt; what follows is rendered for each side as its completion, with
the character ranges a model should learn from: the assistant's words
and the end mark after them.  Everything else is masked.

The rendering is DataFrame expressions on the arrays of one pair; the
only shuffle gathers a conversation's turns, which end up in one
training example anyway.  Pairs are not formed by content, so a first
turn that many conversations share makes no group.

Defined results: a NULL role is written as ``unknown`` and a NULL text as
the empty text (and compared so); a missing or empty side gives an empty
completion; two equal sides give a prompt and two empty completions;
turns repeated with the same number, role and text count once, other
turns of one number follow in order of role and text; turns without a
conversation id belong to one conversation each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
TURNS = "array<struct<role:string,text:string>>"
LEARNT = "assistant"


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: its id and ``turns`` in order."""
    role = F.coalesce(F.col("role"), F.lit("unknown"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select(F.col(id_col).alias("id"), F.col("turn"), role.alias("role"), text.alias("text"))
    own = F.when(F.col("id").isNull(), F.xxhash64("turn", "role", "text"))
    rows = rows.withColumn("own", own).distinct()
    told = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return rows.groupBy("id", "own").agg(F.transform(told, lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text"))).alias("turns")).select(
        F.col("id").alias(id_col), "turns")


def stale_reply(turns: Column) -> Column:
    """A rejected side from a conversation: its last reply replaced by the reply before
    (by nothing, if there is none); what comes after the last reply is left out."""
    said = F.filter(F.transform(turns, lambda t, i: F.struct(i.alias("i"), t["role"].alias("role"),
                                                             t["text"].alias("text"))),
                    lambda t: t["role"] == LEARNT)
    last = F.get(said, F.size(said) - 1)["i"]
    stale = F.get(said, F.size(said) - 2)["text"]
    kept = F.slice(turns, F.lit(1), F.coalesce(last, F.size(turns)))
    reply = F.array(F.struct(F.lit(LEARNT).alias("role"), stale.alias("text"))).cast(TURNS)
    return F.when(stale.isNotNull(), F.concat(kept, reply)).otherwise(kept)


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    n = F.least(F.size(chosen), F.size(rejected))
    same = F.zip_with(F.slice(chosen, F.lit(1), n), F.slice(rejected, F.lit(1), n), lambda a, b: a == b)
    at = F.array_position(same, F.lit(False))
    return F.when(at > 0, at - 1).otherwise(n).cast("int")


def _written(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _written), "")


def learnt_ranges(turns: Column) -> Column:
    """Character ranges of the rendered turns that are not masked."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        head = acc["at"] + F.length(t["role"]) + len(OPEN) + len(MIDDLE)
        tail = head + F.length(t["text"]) + len(CLOSE)
        own = F.array(F.struct(head.alias("start"), tail.alias("end")))
        return F.struct(tail.alias("at"), F.when(t["role"] == LEARNT, F.concat(acc["out"], own))
                        .otherwise(acc["out"]).alias("out"))

    return F.aggregate(turns, zero, step, lambda acc: acc["out"])


def format_pairs(pairs: DataFrame, id_col: str, chosen_col: str = "chosen",
                 rejected_col: str = "rejected") -> DataFrame:
    """Per pair: ``n_prompt_turns``, ``prompt``, and per side the completion and its ranges."""
    side = lambda name: F.transform(
        F.coalesce(F.col(name), F.array().cast(TURNS)),
        lambda t: F.struct(F.coalesce(t["role"], F.lit("unknown")).alias("role"),
                           F.coalesce(t["text"], F.lit("")).alias("text")))
    rows = pairs.select(F.col(id_col).alias("id"), side(chosen_col).alias("c"), side(rejected_col).alias("r"))
    rows = rows.withColumn("n", common_turns(F.col("c"), F.col("r")))
    rest = lambda name: F.slice(F.col(name), F.col("n") + 1, F.size(name))
    rows = rows.select("id", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"),
                       rest("c").alias("c"), rest("r").alias("r"))
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_prompt_turns"), render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"), learnt_ranges(F.col("c")).alias("chosen_learnt"),
        render(F.col("r")).alias("rejected"), learnt_ranges(F.col("r")).alias("rejected_learnt"))
