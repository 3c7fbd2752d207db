"""Chat formatting after collapsing cumulative snapshots, with DataFrame operations only.

A log may hold a conversation several times, each time a few turns longer.
Every turn gets a hash of its position, role and text; the running XOR of
these is a hash of the turn prefix (128 bits in two parts). A conversation
whose whole hash is the hash of a shorter prefix of another is a snapshot of
that one: an anti-join drops it. Of equal conversations the smallest conv_id
stays. Only then are texts read again and rendered. Only that last step brings
the turns of one conversation, whose rendering is one value, together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import Scratch
from furrow.operators.lookups import join_lookup
from furrow.operators.ranking import rank_in_group

TURN = ["conv_id", "turn", "role", "text"]


def _turns(logs: DataFrame) -> DataFrame:
    return logs.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    )


def prefixes(logs: DataFrame, segment: int = 1 << 16) -> DataFrame:
    """``(conv_id, pos, a, b)``: the hash of the first ``pos`` turns of each conversation.

    A conversation of any length is numbered over many tasks; its running XOR is
    taken in segments of ``segment`` turns, and what the segments before add up
    to (one row a segment) is joined to the later ones.
    """
    # rows that are repeated whole count once; the text itself is not sorted or shuffled
    narrow = _turns(logs).select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("\0")).alias("role"),
        F.xxhash64(F.lit(1), F.col("text").isNull(), "text").alias("h"),
        F.xxhash64(F.lit(2), F.col("text").isNull(), "text").alias("g"),
    ).distinct()
    placed = rank_in_group(narrow, ["conv_id"], ["turn", "role", "h", "g"], "pos")
    salted = placed.select(
        "conv_id",
        "pos",
        F.floor((F.col("pos") - 1) / segment).alias("seg"),
        F.xxhash64(F.lit(3), "pos", "role", "h", "g").alias("a"),
        F.xxhash64(F.lit(4), "pos", "role", "h", "g").alias("b"),
    )
    inside = Window.partitionBy("conv_id", "seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = salted.select("conv_id", "pos", "seg", F.bit_xor("a").over(inside).alias("a"), F.bit_xor("b").over(inside).alias("b"))
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)  # one row a segment
    segments = salted.groupBy("conv_id", "seg").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    ahead = segments.select("conv_id", "seg", F.bit_xor("a").over(before).alias("a0"), F.bit_xor("b").over(before).alias("b0")).where("seg > 0")
    whole = join_lookup(running, ahead, ["conv_id", "seg"])
    a, b = (F.col(x).bitwiseXOR(F.coalesce(f"{x}0", F.lit(0).cast("long"))).alias(x) for x in "ab")
    return whole.select("conv_id", "pos", a, b)


def maximal(logs: DataFrame, scratch: Scratch, segment: int = 1 << 16) -> DataFrame:
    """``(conv_id, n_turns)`` of the conversations that are no snapshot of another one."""
    found = scratch.write(prefixes(logs, segment), "prefixes")
    whole = found.groupBy("conv_id").agg(F.max("pos").alias("n"), F.max_by(F.struct("a", "b"), "pos").alias("p"))
    whole = scratch.write(whole.select("conv_id", "n", "p.a", "p.b"), "whole")
    # a prefix that more conversations have than end there is a proper one of some
    both = found.select(F.col("pos").alias("n"), "a", "b", F.lit(1).alias("more")).unionByName(whole.select("n", "a", "b", F.lit(-1).alias("more")))
    inner = both.groupBy("n", "a", "b").agg(F.sum("more").alias("more")).where("more > 0").drop("more")
    return whole.groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id")).join(inner, ["n", "a", "b"], "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"))


def render_chats(logs: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, text)``: the maximal conversations of ``logs(conv_id, turn, role, text)``, rendered.

    Turns are ordered by (turn, role, hash of the text), nulls first. Rows that
    are repeated whole count once. Rows without a conv_id are one conversation.
    A null role is written as ``unknown``, a null text as an empty one (it
    differs from an empty one when conversations are compared). The opening
    ``<|`` of a marker inside a text is written ``< |``. Other columns are not
    read. A rendered conversation is one value, as long as its turns are. No
    rows in, no rows out.
    """
    scratch = Scratch(logs.sparkSession, "chat")
    kept = scratch.write(maximal(logs, scratch).toDF("c", "n_turns"), "kept")
    scratch.drop("prefixes", "whole")
    hashed = _turns(logs).withColumn("h", F.xxhash64(F.lit(1), F.col("text").isNull(), "text"))
    turns = hashed.join(kept, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c").distinct()
    line = F.concat(
        F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")), F.lit("<|im_end|>\n")
    )
    rows = turns.groupBy("conv_id", "n_turns").agg(
        F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("\0")).alias("role"), "h", line.alias("line")))).alias("turns")
    )
    return rows.select("conv_id", "n_turns", F.array_join(F.col("turns.line"), "").alias("text"))
