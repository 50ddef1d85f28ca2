"""Sharding by extendible hashing.

A row's bucket is the first d bits of the hash of its id.  Starting at depth 0,
a bucket whose bytes exceed the limit splits on the next bit, and only that
bucket: small ones keep their depth.  The directory is computed from sums per
hash prefix, pre-aggregated in every task before they are shuffled, never from
sorted rows; rows then meet it by an equality on their prefix at a depth that
occurs.

Defined results
---------------
* A row weighs the bytes of its text plus a fixed overhead (a null text: only
  the overhead).
* Rows whose hashes agree in all 60 bits cannot be told apart by any depth.
  Their bucket stops there and, above the limit, is cut by byte quota: ``part``
  numbers its pieces from 0.  No piece exceeds the limit but a single row that
  does by itself.  Which rows share a piece follows the order in which they were
  written; all but a piece or so of each size class are more than half full.
* An empty table gives an empty result.  A null id hashes as the empty string.
* Other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

KEY_BITS = 60
#: Bits of the first histogram: at most 2**16 sums, whatever the input.
HISTOGRAM_BITS = 16
#: Rows of up to 1/SMALL of the limit are cut by running bytes, larger ones by count.
SMALL = 8
#: 2**BLOCK_BITS numbers of rows are summed before they meet in one place.
BLOCK_BITS = 12


def id_key(doc_id):
    """The first 60 bits of the md5 of the id."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def row_bytes(text, overhead: int):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead)


def prefix(key, depth: int):
    return F.shiftright(key, KEY_BITS - depth) if depth else F.lit(0).cast("long")


def directory(keyed: DataFrame, limit: int) -> DataFrame:
    """(key, bytes) -> one row per bucket: depth, prefix, bucket_bytes, bucket_rows."""
    out, deep, start = None, keyed, 0
    while True:
        # sums at the finest depth of this pass; every coarser depth adds up those
        finest = min(start + HISTOGRAM_BITS, KEY_BITS)
        fine = materialize(deep.groupBy(prefix(F.col("key"), finest).alias("fine")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows")), "shard-sums")
        live = fine
        for depth in range(start, finest + 1):
            at = live.groupBy(F.shiftright("fine", finest - depth).alias("prefix")).agg(
                F.sum("bytes").alias("bucket_bytes"), F.sum("rows").alias("bucket_rows"))
            at = materialize(at.withColumn("depth", F.lit(depth)).withColumn(
                "__fits", (F.col("bucket_bytes") <= limit) | (F.col("bucket_rows") == 1) | F.lit(depth == KEY_BITS)),
                "shard-level")
            closed = at.where("__fits").drop("__fits")
            out = closed if out is None else out.unionByName(closed)
            over = at.where(~F.col("__fits")).select(F.col("prefix").alias("__over"))
            if over.isEmpty():
                return out.select("depth", "prefix", "bucket_bytes", "bucket_rows")
            live = live.join(over, F.shiftright("fine", finest - depth) == F.col("__over"), "left_semi")
        deep = deep.join(over, prefix(F.col("key"), finest) == F.col("__over"), "left_semi")
        start = finest + 1


def shard_rows(keyed: DataFrame, buckets: DataFrame, limit: int) -> DataFrame:
    """Each row with its bucket: one equality join per depth that occurs (at most 61)."""
    depths = sorted(r[0] for r in buckets.select("depth").distinct().collect())
    names = [*keyed.columns, "depth", "prefix", "bucket_bytes", "bucket_rows"]
    if not depths:
        return keyed.join(buckets, F.lit(False)).select(*names)
    # the key's prefixes at all depths in use; a row meets exactly one of them
    tries = keyed.withColumn("__try", F.explode(F.array(*[
        F.struct(F.lit(d).alias("d"), prefix(F.col("key"), d).alias("p")) for d in depths])))
    return tries.join(buckets, (F.col("__try.d") == F.col("depth")) & (F.col("__try.p") == F.col("prefix"))).select(*names)


def parts(rows: DataFrame, limit: int) -> DataFrame:
    """Rows (key, bytes, at) of buckets above the limit -> the same with ``part``.

    Of rows that go into the limit j times, j make a piece (one, if it does not
    fit at all); small ones fill pieces by running bytes, up to a quota that
    leaves room for one more of them.  Running sums are taken within blocks of
    ``at`` and shifted by the totals of the blocks before."""
    fits = F.least(F.expr(f"{limit} div greatest(bytes, 1)"), F.lit(SMALL)).cast("int")
    small = F.col("kind") == SMALL
    rows = rows.withColumn("kind", fits).withColumn("block", F.shiftright("at", BLOCK_BITS)).withColumn(
        "weight", F.when(small, F.col("bytes")).otherwise(F.lit(1).cast("long"))).withColumn(
        "quota", F.when(small, F.lit(limit - limit // SMALL)).otherwise(F.greatest("kind", F.lit(1))).cast("long"))
    rows = materialize(rows, "shard-crowded")
    of, inner = ["key", "kind"], ["key", "kind", "block"]

    def before(total, by, order):
        over = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(total).over(over), F.lit(0).cast("long"))

    blocks = materialize(rows.groupBy(*inner, "quota").agg(F.sum("weight").alias("weight")), "shard-blocks")
    # pieces of each class, numbered after those of the classes before: at most SMALL + 1 rows a key
    kinds = blocks.groupBy(*of, "quota").agg(F.sum("weight").alias("weight")).withColumn(
        "pieces", F.expr("(weight + quota - 1) div quota"))
    kinds = kinds.select(*of, before("pieces", ["key"], "kind").alias("first_part"))
    starts = blocks.select(*inner, before("weight", of, "block").alias("start")).join(kinds, of)
    ahead = F.col("start") + F.col("ahead")
    return (rows.withColumn("ahead", before("weight", inner, "at")).join(starts, inner)
            .withColumn("ahead", ahead).withColumn("part", (F.col("first_part") + F.expr("ahead div quota")).cast("int")))


def shard(docs: DataFrame, limit: int, id_col="doc_id", text_col="text", overhead: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, bytes, shard (the prefix as bits),
    depth, part, shard_bytes (of the whole bucket)."""
    # the rows' numbers are written with them, so that no later task numbers them otherwise
    keyed = materialize(docs.select(
        F.col(id_col).alias("doc_id"), id_key(F.col(id_col)).alias("key"),
        row_bytes(F.col(text_col), overhead).alias("bytes"), F.monotonically_increasing_id().alias("at")), "shard-keys")
    buckets = materialize(directory(keyed.drop("at"), limit), "shard-directory")
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.expr("lpad(bin(prefix), depth, '0')"))

    def named(rows, part):
        return rows.select("doc_id", "bytes", bits.alias("shard"), "depth", part.cast("int").alias("part"),
                           F.col("bucket_bytes").alias("shard_bytes"))

    # only buckets that no bit can split
    crowded = (F.col("depth") == KEY_BITS) & (F.col("bucket_bytes") > limit)
    whole = named(shard_rows(keyed, buckets.where(~crowded), limit), F.lit(0))
    if buckets.where(crowded).isEmpty():
        return whole
    return whole.unionByName(named(parts(shard_rows(keyed, buckets.where(crowded), limit), limit), F.col("part")))
