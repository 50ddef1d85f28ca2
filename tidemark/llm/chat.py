"""Chat formatting: collapse cumulative snapshots, then render.

Logs often hold a conversation several times, each snapshot longer by a turn.
Every turn carries the rolling hash of its conversation up to it.  A
conversation whose final hash is the prefix hash of a longer one is a snapshot
and goes (an anti-join); of equal conversations the smallest id stays.

The rolling hash is a sum over turns of hashes of (place, role, text), so whole
conversations hash in a map-side aggregate and running sums need only the turns
of one block: turns are placed over sorted range partitions, sums are computed per
block of places and shifted by the totals of the blocks before.  A conversation with
a third of all turns is spread over many tasks, whatever its turn numbers, and its
rendered text comes in parts.  Prefixes are compared by 64 bits of hashes and length.

Defined results
---------------
* Turns are ordered by (turn, role, text), nulls first; exact repeats of a turn
  count once.  A null role renders as ``unknown``, a null text as empty.
* A conversation with a null id is one conversation of its own.
* An empty table gives an empty result.
* Other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.places import numbered
from tidemark.session import materialize

BLOCK_TURNS = 256
#: Characters of a text that partitions are cut by, among turns alike in number and role.
START = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def placed_turns(turns: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """conv_id, place (from 1), role, text, h1, h2: the rolling hashes up to each turn."""
    rows = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.col(role_col).alias("role"), F.col(text_col).alias("text")).distinct()
    rows = materialize(rows.withColumn("start", F.substring("text", 1, START)), "chat-turns")
    placed = (numbered(rows, "conv_id", ["turn", "role", "text"], ["turn", "role", "start"])
              .select("conv_id", "role", "text", (F.col("place") + 1).alias("place"), F.floor(F.col("place") / BLOCK_TURNS).alias("block")))
    # two 32-bit hashes of each turn at its place; their running sums stay exact
    content = [F.col("place"), F.coalesce("role", F.lit("\x00")), F.coalesce("text", F.lit("\x00"))]
    big = F.xxhash64(*content)
    placed = materialize(placed.withColumn("t1", F.shiftrightunsigned(big, 32)).withColumn("t2", big.bitwiseAND(0xFFFFFFFF)),
                         "chat-placed")
    run = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per = placed.groupBy("conv_id", "block").agg(F.sum("t1").alias("s1"), F.sum("t2").alias("s2"))
    offsets = per.select(F.col("conv_id").alias("__c"), F.col("block").alias("__b"),  # one row per block passes
                         *[F.coalesce(F.sum(s).over(before), F.lit(0).cast("decimal(38,0)")).alias(f"__{s}") for s in ("s1", "s2")])
    same = F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("block") == F.col("__b"))
    return (placed.withColumn("__r1", F.sum("t1").over(run)).withColumn("__r2", F.sum("t2").over(run)).join(offsets, same)
            .select("conv_id", "place", "role", "text", (F.col("__r1") + F.col("__s1")).cast("long").alias("h1"),
                    (F.col("__r2") + F.col("__s2")).cast("long").alias("h2")))


def maximal(turns: DataFrame) -> DataFrame:
    """Placed turns -> conv_id, n_turns, n_snapshots of the conversations that stay."""
    last = turns.groupBy("conv_id").agg(F.max(F.struct("place", "h1", "h2")).alias("last"))
    whole = last.select("conv_id", F.col("last.place").alias("n"), "last.h1", "last.h2")
    # equal conversations: one row each, with the smallest id
    first = whole.groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    longer = turns.join(whole.select(F.col("conv_id").alias("__c"), "n"), F.col("conv_id").eqNullSafe(F.col("__c"))).where(
        F.col("place") < F.col("n")).select(F.col("place").alias("n"), "h1", "h2").distinct()  # one common first turn, one row
    return first.join(longer, ["n", "h1", "h2"], "left_anti").select(
        "conv_id", F.col("n").alias("n_turns"), "copies")


def render_turn(role, text):
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("unknown")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def format_chats(turns: DataFrame, part_turns: int = 64, **columns) -> DataFrame:
    """conv_id, part, n_turns, copies, text: the maximal conversations rendered in
    order, ``part_turns`` turns a row, so that no row grows with a conversation."""
    placed = materialize(placed_turns(turns, **columns), "chat-hashed")
    keep = maximal(placed).select(F.col("conv_id").alias("__c"), "n_turns", "copies")
    rows = placed.join(keep, F.col("conv_id").eqNullSafe(F.col("__c")))
    part = F.floor((F.col("place") - 1) / part_turns).cast("long")
    return (rows.groupBy("conv_id", part.alias("part"), "n_turns", "copies")
            .agg(F.sort_array(F.collect_list(F.struct("place", render_turn(F.col("role"), F.col("text")).alias("t")))).alias("ts"))
            .select("conv_id", "part", "n_turns", "copies", F.array_join(F.col("ts.t"), "").alias("text")))
