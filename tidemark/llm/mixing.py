"""Mixing sources to target weights by hash-threshold histograms.

Every source gets a target in words; a document is taken when the hash of its
row lies below its source's threshold.  Thresholds come from histograms: sizes
are summed by (source, hash bucket), the running sum finds the bucket in which
the target is reached, and only that bucket is split further, twelve hash bits
a round, until it holds one hash.  No document is ever sorted, and what a round
moves is at most 4096 sums per source and task.

Defined results
---------------
* A null text has size 0; a document of size 0 is carried with ``taken`` 0.
* A null source is a source of its own, ranked last.
* The hash covers id and text, so rows that agree in both are one unit: they
  are taken or left together.
* A source of size 0 has target 0.  An empty table gives an empty result.
* Other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60
DIGIT_BITS = 12


def row_key(doc_id, text):
    """A 60-bit hash of id and text; a pure function of the row, so reruns agree."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, KEY_BITS // 4), 16, 10).cast("long")


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, total: float = 1.5, weights=(5, 2, 1), cap: float = 2.0) -> DataFrame:
    """(source, source_size) -> plus ``weight`` and ``target``: the fixed point of resharing.

    With ratio = cap * size / weight, the sources that stop at their cap are a
    prefix in ratio order, and the rest share what is left by weight.  One row
    per source passes through the window."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = (sizes.withColumn("__rank", rank)
              .withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                                                 (F.col("__rank") % len(weights) + 1).cast("int")))
              .withColumn("__cap", cap * F.col("source_size"))
              .withColumn("__ratio", F.col("__cap") / F.col("weight"))
              .withColumn("__all", F.sum("source_size").over(everything) * F.lit(float(total))))
    upto = Window.orderBy("__ratio", "__rank")
    share = ranked.withColumn(
        "__share",
        (F.col("__all") - (F.sum("__cap").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__cap")))
        / F.sum("weight").over(upto.rowsBetween(0, Window.unboundedFollowing)))
    level = F.max(F.when(F.col("__open_rank") == 1, F.col("__share"))).over(everything)
    opened = share.withColumn("__open", F.col("__share") <= F.col("__ratio")).withColumn(
        "__open_rank", F.when(F.col("__open"), F.row_number().over(
            Window.partitionBy("__open").orderBy("__ratio", "__rank"))))
    return (opened.withColumn("__level", level)
            .select("source", "source_size", "weight",
                    F.when(F.col("__level").isNull() | (F.col("__level") * F.col("weight") > F.col("__cap")),
                           F.col("__cap")).otherwise(F.col("__level") * F.col("weight")).alias("target")))


def thresholds(keyed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, size, key) and targets -> one row per source: ``copies`` whole
    takes of the source plus one take of every row whose key <= ``last_key``."""
    base = targets.withColumn(
        "copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    base = base.withColumn("__left", F.col("target") - F.col("copies") * F.col("source_size"))
    base = materialize(base, "mix-targets")
    state = base.where(F.col("__left") > 0).select(
        F.col("source").alias("__s"), F.lit(0).cast("long").alias("__prefix"), "__left")
    found = None
    for shift in range(KEY_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        inside = keyed.join(state, F.col("source").eqNullSafe(F.col("__s"))
                            & (F.shiftright("key", shift + DIGIT_BITS) == F.col("__prefix")))
        sums = inside.groupBy("__s", "__left", F.shiftright("key", shift).alias("__bucket")).agg(
            F.sum("size").alias("__sum"), F.min("key").alias("__lo"), F.max("key").alias("__hi"))
        # at most 4096 buckets per source: the prefix is fixed and one digit varies
        upto = Window.partitionBy("__s").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
        edge = (sums.withColumn("__before", F.sum("__sum").over(upto) - F.col("__sum"))
                .where((F.col("__before") <= F.col("__left"))
                       & (F.col("__left") < F.col("__before") + F.col("__sum")))
                .withColumn("__left", F.col("__left") - F.col("__before")))
        edge = materialize(edge, "mix-edge")
        one = F.col("__lo") == F.col("__hi")
        done = edge.where(one).select(
            "__s", (F.col("__lo") - F.when(F.col("__left") * 2 >= F.col("__sum"), 0).otherwise(1)).alias("last_key"))
        found = done if found is None else found.unionByName(done)
        state = edge.where(~one).select("__s", F.col("__bucket").alias("__prefix"), "__left")
        if state.isEmpty():
            break
    return base.join(found, F.col("source").eqNullSafe(F.col("__s")), "left").select(
        "source", "source_size", "weight", "target", "copies", F.coalesce("last_key", F.lit(-1)).alias("last_key"))


def keyed_sizes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The narrow table that every round reads: id, source, size, key."""
    return materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), row_key(F.col(id_col), F.col(text_col)).alias("key")), "mix-sizes")


def mix_thresholds(keyed: DataFrame, total=1.5, weights=(5, 2, 1), cap=2.0) -> DataFrame:
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    return materialize(thresholds(keyed, source_targets(sizes, total, weights, cap)), "mix-thresholds")


def mix_plan(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
             total: float = 1.5, weights=(5, 2, 1), cap: float = 2.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    keyed = keyed_sizes(docs, id_col, text_col, source_col)
    limits = mix_thresholds(keyed, total, weights, cap).withColumnRenamed("source", "__s")
    copies = F.col("copies") + F.when(F.col("key") <= F.col("last_key"), 1).otherwise(0)
    return (keyed.join(limits, F.col("source").eqNullSafe(F.col("__s")))
            .select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"),
                    (copies * F.col("size")).cast("long").alias("taken")))


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
        total: float = 1.5, weights=(5, 2, 1), cap: float = 2.0) -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``: a row taken twice
    appears twice.  The texts are filtered by threshold where they are read."""
    limits = mix_thresholds(keyed_sizes(docs, id_col, text_col, source_col), total, weights, cap).select(
        F.col("source").alias("__s"), F.col("copies").alias("__copies"), F.col("last_key").alias("__last"))
    n = F.col("__copies") + F.when(row_key(F.col(id_col), F.col(text_col)) <= F.col("__last"), 1).otherwise(0)
    taken = docs.join(limits, F.col(source_col).eqNullSafe(F.col("__s"))).withColumn("__n", n.cast("int"))
    return (taken.where("__n > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
