"""Chat formatting after cumulative-snapshot collapse.

Logs often hold the same conversation several times, each time with more turns. Every turn extends a rolling hash of the
turns before it; a conversation whose last hash is an inner hash of a longer one is a snapshot of it and goes (anti-join
on the hash). Of equal conversations the one with the least id stays. The others are rendered with a chat template.

Hashes are pre-aggregated before each shuffle, so an opening or a conversation that very many logs share stays one row
a task. Defined cases: rows without conv_id belong to no conversation and are left out; equal rows count once; turns are
ordered by turn, then role, then text, nulls first; a null role is rendered as "user" and a null text as empty; other
columns are ignored; an empty table gives no conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns, hashes): turns in order, and the rolling hash after each."""
    grouped = (
        turns.selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "cast(role as string) role", "cast(text as string) text")
        .where("conv_id is not null").groupBy("conv_id")
        .agg(F.array_distinct(F.array_sort(F.collect_list(F.struct("turn", "role", "text")))).alias("turns"))
    )
    # Positions count, not turn numbers: a log that starts counting elsewhere is still a snapshot.
    own = F.transform("turns", lambda t: F.sha2(F.concat(F.coalesce(t.role, F.lit("user")), F.lit("\x1f"), F.coalesce(t.text, F.lit(""))), 256))
    chain = F.aggregate(
        "own",
        F.array().cast("array<string>"),
        lambda done, h: F.concat(done, F.array(F.sha2(F.concat(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")), h), 256))),
    )
    return grouped.withColumn("own", own).withColumn("hashes", chain).drop("own")


def maximal(convs: DataFrame) -> DataFrame:
    """(conv_id, n_equal) of the conversations that no longer one contains as its beginning."""
    whole = convs.groupBy(F.element_at("hashes", -1).alias("hash")).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    inner = convs.select(F.explode(F.slice("hashes", F.lit(1), F.size("hashes") - 1)).alias("hash")).distinct()
    return whole.join(inner, "hash", "left_anti").select("conv_id", "n_equal")


def render(turns: Column) -> Column:
    """The template's text of an array of turns."""
    role = lambda t: F.coalesce(t.role, F.lit("user"))
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(BEGIN), role(t), F.lit("\n"), F.coalesce(t.text, F.lit("")), F.lit(END + "\n"))), "")


def chat(turns: DataFrame) -> DataFrame:
    """Maximal conversations: conv_id, n_turns, n_equal (logs equal to it, itself included), rendered."""
    convs = conversations(turns)
    return convs.join(maximal(convs), "conv_id").select("conv_id", F.size("turns").cast("long").alias("n_turns"), "n_equal", render(F.col("turns")).alias("rendered"))
