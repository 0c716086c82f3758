"""Chat formatting with collapse of cumulative snapshots.

Loggers often store a conversation again after every turn.  Each turn gets a rolling
hash of its prefix; a conversation whose whole-conversation hash is the hash of a
proper prefix of another one is a snapshot, and an anti join removes it.  Of equal
conversations the one with the smallest id stays.  What is left is rendered.  All of
it is DataFrame expressions.

The rolling hash xors the hashes of (position, role, text) along the turns, twice
with different salts, so 128 bits and the number of turns must agree.

Scale: prefix hashes are made distinct before the anti join, so a first turn that a
third of all conversations share is one row.  A window holds the turns of one
conversation, which is one output text anyway.

Defined results: turns are ordered by number, null last, then role and text; exact
repeats of a row are one turn; a null id is a conversation like any other; null role
renders as ``unknown``, null text as empty; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# fixed values: the marks of the rendered text
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
BROKEN_START = "<|im_start |>"
BROKEN_END = "<|im_end |>"


def _prefixes(turns: DataFrame) -> DataFrame:
    ordered = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last()
    )
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    content = [F.col("place"), F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))]
    return (
        turns.withColumn("place", F.row_number().over(ordered))
        .withColumn("turns", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))
        .withColumn("h1", F.bit_xor(F.xxhash64(F.lit(1), *content)).over(so_far))
        .withColumn("h2", F.bit_xor(F.xxhash64(F.lit(2), *content)).over(so_far))
    )


def maximal_conversations(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Turns (conv_id, place, role, text, turns) of the conversations that no other one continues."""
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    ).distinct()
    prefixes = _prefixes(turns)
    inner = prefixes.where(F.col("place") < F.col("turns")).select("place", "h1", "h2").distinct()
    whole = prefixes.where(F.col("place") == F.col("turns")).select("conv_id", "turns", "h1", "h2")
    kept = (
        whole.groupBy("turns", "h1", "h2")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("equal"))
        .join(inner.withColumnRenamed("place", "turns"), ["turns", "h1", "h2"], "left_anti")
        .select(F.col("conv_id").alias("_kept"), "equal")
    )
    return prefixes.join(kept, F.col("conv_id").eqNullSafe(F.col("_kept"))).select(
        "conv_id", "place", "role", "text", "turns", "equal"
    )


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal, rendered): marks inside a text are broken by a blank so that they cannot end a turn."""
    safe = F.replace(
        F.replace(F.coalesce("text", F.lit("")), F.lit(TURN_START), F.lit(BROKEN_START)), F.lit(TURN_END), F.lit(BROKEN_END)
    )
    line = F.concat(F.lit(TURN_START), F.coalesce("role", F.lit("unknown")), F.lit("\n"), safe, F.lit(TURN_END + "\n"))
    pieces = F.array_sort(F.collect_list(F.struct("place", line.alias("line"))))
    return turns.groupBy("conv_id").agg(
        F.max("turns").alias("n_turns"),
        F.max("equal").alias("n_equal"),
        F.array_join(F.transform(pieces, lambda p: p["line"]), "").alias("rendered"),
    )


def format_chats(conversations: DataFrame, **columns) -> DataFrame:
    return render(maximal_conversations(conversations, **columns))
