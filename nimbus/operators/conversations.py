"""Conversations in batch: cut at the first 'exit', find the turns still open.

Rows: ``(conv_id, turn, role, text)``. Only partial aggregates and key joins:
the first exit per conversation is a ``min`` aggregate joined back on
``conv_id``, the last role a ``max_by`` aggregate, so a conversation holding a
third of all turns costs one row per task in each shuffle, not one task
holding all its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXIT_WORD = "exit"


def is_exit(role: Column, text: Column) -> Column:
    """A session ends when the user says 'exit', in any letter case and nothing else."""
    return (role == "user") & (F.lower(text) == EXIT_WORD)


def is_empty(role: Column, text: Column) -> Column:
    """An empty prompt is no turn (one of blanks is)."""
    return (role == "user") & (text.isNull() | (text == ""))


def kept_turns(conv: DataFrame) -> DataFrame:
    """Turns before the first exit of their conversation; empty user turns are
    not part of the history (the reference appends only non-empty prompts)."""
    first_exit = conv.where(is_exit(F.col("role"), F.col("text"))).groupBy("conv_id").agg(F.min("turn").alias("_exit"))
    joined = conv.join(first_exit, "conv_id", "left")
    before = F.col("_exit").isNull() | (F.col("turn") < F.col("_exit"))
    empty = F.coalesce(is_empty(F.col("role"), F.col("text")), F.lit(False))
    return joined.where(before & ~empty).drop("_exit")


def open_turns(conv: DataFrame) -> DataFrame:
    """W2 + T2: conversations whose last kept turn is not the assistant's."""
    last = kept_turns(conv).groupBy("conv_id").agg(
        F.max("turn").alias("last_turn"), F.max_by("role", "turn").alias("last_role")
    )
    return last.where(F.col("last_role") != "assistant")


#: Turn numbers of one range while turns are numbered.
TURN_RANGE = 1024


def numbered(turns: DataFrame, key: str = "conv_id", turn: str = "turn", out: str = "n") -> DataFrame:
    """``turns`` with the place of each row within its key by ``turn``, from 1, as a distributed prefix sum.

    Rows are numbered within ranges of ``TURN_RANGE`` turn numbers, and a range starts after
    the rows of all ranges before it: only one count per (key, range) is sorted by key, so
    a key that holds a third of all rows is spread over its ranges. Rows of one turn are
    numbered in any order; null turns come first, null keys are one key.
    """
    ranged = turns.withColumn("_range", F.floor(F.col(turn) / TURN_RANGE).cast("long"))
    counts = ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(key).alias("_key"), F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(key, "_range").orderBy(turn))
    placed = ranged.withColumn("_within", within)
    same = placed[key].eqNullSafe(starts["_key"]) & placed["_range"].eqNullSafe(starts["_at"])
    return placed.join(starts, same).withColumn(out, (F.col("_start") + F.col("_within")).cast("long")).select(*turns.columns, out)


def answered_turns(conv: DataFrame) -> DataFrame:
    """Batch twin of the streaming chat: every non-empty user turn before the
    first exit, numbered within its conversation."""
    users = kept_turns(conv).where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    return numbered(users, out="n_answered")
