"""Exact dedup with a heavy-hitter split.

1. *Keys.*  One pass over the texts writes a narrow table: id, sha256 of the text,
   a second hash with the length, and a row number that stays as written.
2. *Frequent digests.*  Every task summarises its digests with Misra-Gries counters.
   The sum of a digest's counters is at most its true count and falls short of it
   by at most rows / (counters + 1), so what sums to more than that share are
   candidates: at most ``counters`` of them, however large the table.  No digest
   with over twice that share is missed.
3. *Winners.*  A pass over the keys counts the candidates exactly and finds their
   winners, combined within the tasks; one whose rows differ in the second hash is
   no winner and goes the ordinary way.  The winners, at most ``counters`` rows, are
   broadcast: rows of frequent texts are decided where they are read.
4. *The rest* is grouped by digest with an ordinary shuffle; no digest there holds
   more than twice the share.  Only digests that occur more than once come back to
   the rows.

Defined results
---------------
* A null text counts as empty: both are one group.  Texts are equal when their bytes
  are; they are told apart by sha256, a 64-bit hash of another kind and their length.
* The row with the largest id stays; a null id is smaller than every other.  Of rows
  that tie on the id as well, one stays.
* Every row comes back once from ``decide``, repeated rows and null ids too.
* An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.relational import pick_max
from tidemark.session import materialize

#: Counters of a task, and the most winners that are broadcast (about 100 bytes each).
COUNTERS = 4_096
LEAST = -(2**63)
SAME = ["digest", "check", "bytes"]


def text_keys(text: Column) -> dict[str, Column]:
    """What tells texts apart."""
    whole = F.coalesce(text, F.lit(""))
    return {"digest": F.unhex(F.sha2(whole, 256)), "check": F.xxhash64(whole), "bytes": F.octet_length(whole)}


def keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The narrow table of step 1, written: doc_id, digest, check, bytes, row."""
    return materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                   *[c.alias(n) for n, c in text_keys(F.col(text_col)).items()],
                                   F.monotonically_increasing_id().alias("row")), "dedup-keys")


def summarise(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries: at most ``counters`` digests, each with at most its true count.

    A batch's counts are added whole; what is over the number of counters goes by
    taking the first count left out from all of them."""
    held = None
    for batch in batches:
        mine = pa.table({"digest": batch.column("digest"), "n": pa.repeat(pa.scalar(1, pa.int64()), batch.num_rows)})
        both = mine if held is None else pa.concat_tables([held, mine])
        held = both.group_by("digest").aggregate([("n", "sum")]).rename_columns(["digest", "n"])
        if held.num_rows > counters:
            n = held.column("n").to_numpy()
            place = len(n) - counters - 1
            left = n - np.partition(n, place)[place]
            held = held.set_column(1, "n", pa.array(left)).filter(pa.array(left > 0))
    if held is not None:
        yield from held.combine_chunks().to_batches()


def frequent(keyed: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """digest: every digest with over 2 / (counters + 1) of the rows, ``counters`` at most, written."""
    share = keyed.count() / (counters + 1)
    parts = keyed.select("digest").mapInArrow(lambda b: summarise(b, counters), "digest binary, n long")
    return materialize(parts.groupBy("digest").agg(F.sum("n").alias("n")).where((F.col("n") > share) & (F.col("n") > 1))
                       .select("digest"), "dedup-frequent")


def groups(keyed: DataFrame, by: list[str]) -> DataFrame:
    """One row per group: keep_id, keep_row (of the row that stays), group_size."""
    return keyed.groupBy(*by).agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"),
        F.max_by("row", F.coalesce("doc_id", F.lit(LEAST).cast("long"))).alias("keep_row"))


def winners(keyed: DataFrame, candidates: DataFrame) -> DataFrame:
    """Exact groups of the candidates, written; without digests of unlike texts."""
    mine = keyed.join(F.broadcast(candidates), "digest", "left_semi")
    found = groups(mine, SAME).join(
        F.broadcast(mine.groupBy("digest").agg(F.min("check").alias("a"), F.max("check").alias("b"), F.min("bytes").alias("c"),
                                               F.max("bytes").alias("d")).where("a = b AND c = d").select("digest")),
        "digest", "left_semi")
    return materialize(found, "dedup-winners")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, digest, check, bytes, keep_id, group_size, kept."""
    keyed = keys(docs, id_col, text_col)
    heavy = F.broadcast(winners(keyed, frequent(keyed, counters)))
    said = [F.col("row") == F.col("keep_row"), F.col("keep_id"), F.col("group_size")]
    names = ["kept", "keep_id", "group_size"]
    hot = keyed.join(heavy, SAME).select("doc_id", *SAME, *[c.alias(n) for c, n in zip(said, names)])
    rest = keyed.join(heavy, SAME, "left_anti")
    # most texts occur once: only the other groups travel back to the rows
    several = groups(rest, SAME).where("group_size > 1")
    alone = [F.lit(True), F.col("doc_id"), F.lit(1).cast("long")]
    cold = rest.join(several, SAME, "left").select(
        "doc_id", *SAME, *[F.when(F.col("keep_row").isNull(), a).otherwise(c).alias(n) for a, c, n in zip(alone, said, names)])
    return hot.unionByName(cold)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with the columns of ``docs``.

    Rows of frequent texts other than the winner's go before anything is shuffled;
    of rows that tie on the id too, the greatest in the other columns stays."""
    keyed = keys(docs, id_col, text_col)
    heavy = winners(keyed, frequent(keyed, counters))
    best = heavy.select(*SAME, "keep_id").unionByName(
        groups(keyed.join(F.broadcast(heavy), SAME, "left_anti"), SAME).where("group_size > 1").select(*SAME, "keep_id"))
    mine = {f"__{n}": c for n, c in text_keys(F.col(text_col)).items()}
    named = best.select(*[F.col(c).alias(f"__{c}") for c in SAME], F.col("keep_id").alias("__keep"), F.lit(True).alias("__several"))
    # frequent texts: a broadcast of bounded size takes their losers out first
    lost = F.broadcast(heavy.select(*[F.col(c).alias(f"__{c}") for c in SAME], F.col("keep_id").alias("__top")))
    whole = docs.withColumns(mine).join(lost, list(mine), "left")
    own = F.col(id_col).cast("long")
    whole = whole.where(F.col("__top").isNull() | own.eqNullSafe(F.col("__top"))).drop("__top")
    whole = whole.join(named, list(mine), "left")
    single = whole.where("__several IS NULL").select(*[F.col(f"`{c}`") for c in docs.columns])
    shared = whole.where(F.col("__several") & own.eqNullSafe(F.col("__keep"))).drop("__several", "__keep")
    return single.unionByName(pick_max(shared, list(mine), []).select(*[F.col(f"`{c}`") for c in docs.columns]))
