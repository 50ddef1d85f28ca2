"""Benchmark decontamination by spaced-seed hashing.

A seed is a hash of selected words of a window; a mask says which positions it
takes and which it ignores, so a passage whose words were partly replaced still
shares seeds with its original.  Documents' seeds meet the benchmark's by
equality; every hit fixes an alignment, and the words around it are compared
position by position: a run of aligned words that agrees in enough places is
contamination.

Nothing of the documents is shuffled but verified overlaps.  The benchmark's
seeds are broadcast in parts of bounded size, one pass over the documents for
each part; a seed names its item by a hash, and the items' words meet the hits
afterwards, broadcast only if they are small.

Defined results
---------------
* Words are runs of characters other than ASCII signs, in lower case.
* An item of fewer than ``SHORTEST`` words is not searched; nor is a null one.
  A null or empty document has no overlaps.
* An overlap needs ``window`` aligned words (the whole item where it has fewer)
  of which ``percent`` in a hundred agree.  With 13 words and 80 percent every
  such overlap has a seed, wherever the replaced words stand.
* Rows equal in id and text are one document; documents without an id are told
  apart by ``text_key``.  Of several overlaps with an item the one with most
  equal words counts, then the first.
* Empty tables give an empty result; other input columns play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.relational import maybe_broadcast
from tidemark.session import materialize

#: Word positions that a seed takes; the others are ignored.  Together they meet
#: all patterns of up to a fifth of replaced words in 8 to 13 (two in 13).
MASKS = ((0, 1, 3, 4, 6, 7), (0, 2, 3, 4, 5, 7), (0, 1, 2, 5, 6, 7), (0, 1, 3, 5, 7, 8), (0, 1, 2, 3, 4, 5))
#: Words of the shortest item that is searched.
SHORTEST = 8
SIGNS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Seeds broadcast at once, about 40 bytes each.
SEEDS_PER_PASS = 1_000_000


def word_hashes(text):
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SIGNS), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(df: DataFrame, hashes: str, *keep: str) -> DataFrame:
    """One row per window and mask: ``at`` (from 0), ``seed`` and the kept columns."""
    windows = df.select(*keep, hashes, F.posexplode(hashes).alias("at", "__w")).where(
        F.col("at") + min(mask[-1] for mask in MASKS) < F.size(hashes))
    masked = [F.when(F.col("at") + mask[-1] < F.size(hashes), F.xxhash64(F.lit(m), *[F.get(hashes, F.col("at") + o) for o in mask]))
              for m, mask in enumerate(MASKS)]
    return windows.select(*keep, hashes, "at", F.explode(F.array(*masked)).alias("seed")).where("seed IS NOT NULL")


def aligned(stretch, item, skipped):
    """Agreements, word by word, of a stretch of a document with an item whose
    first ``skipped`` words stand before the document begins."""
    n = F.least(F.size(stretch), F.size(item) - skipped)
    return F.zip_with(F.slice(stretch, F.lit(1), n), F.slice(item, skipped + 1, n), lambda a, b: (a == b).cast("int"))


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, text_key, item_id, start (of the item's first word in the document;
    negative where the document begins within the item), n_aligned, n_equal."""
    named = materialize(benchmark.select(F.col(item_col).cast("long").alias("item_id"), word_hashes(F.col(item_text_col)).alias("item"))
                        .where(F.size("item") >= SHORTEST).withColumn("ref", F.xxhash64("item"))
                        .dropDuplicates(["item_id", "ref"]), "decontam-items")
    items = materialize(named.select("ref", "item").dropDuplicates(["ref"]), "decontam-texts")  # equal items are one
    total = items.agg(F.sum(F.size("item"))).first()[0] or 0
    passes = max(1, -(-total * len(MASKS) // SEEDS_PER_PASS))
    known = items.withColumn("n_item", F.size("item"))
    known = materialize(seeds(known, "item", "ref", "n_item").groupBy("seed").agg(
        F.collect_set(F.struct("ref", F.col("at").alias("item_at"), "n_item")).alias("places")), "decontam-seeds")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                      word_hashes(F.col(text_col)).alias("words"))
    parts = [hits(own, known.where(F.pmod(F.xxhash64("seed"), F.lit(passes)) == p)) for p in range(passes)]
    best = verified(reduce(DataFrame.unionByName, parts), items, window, percent)
    return (best.join(maybe_broadcast(named.select("ref", "item_id")), "ref")
            .select("doc_id", "text_key", "item_id", "start", "n_aligned", "n_equal"))


def hits(own: DataFrame, known: DataFrame) -> DataFrame:
    """Alignments that a seed supports, each with the stretch of the document that
    the item would cover."""
    found = (seeds(own, "words", "doc_id", "text_key").join(F.broadcast(known), "seed")
             .select("doc_id", "text_key", "words", "at", F.explode("places").alias("p"))
             .select("doc_id", "text_key", "words", "p.ref", "p.n_item", (F.col("at") - F.col("p.item_at")).alias("start")))
    return found.select("doc_id", "text_key", "ref", "n_item", "start", F.slice(
        "words", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("n_item") + F.least(F.col("start"), F.lit(0))).alias("stretch"))


def verified(found: DataFrame, items: DataFrame, window: int, percent: int) -> DataFrame:
    """The best alignment of a document with an item among those that are close enough."""
    same = aligned(F.col("stretch"), F.col("item"), F.greatest(-F.col("start"), F.lit(0)))
    compared = found.join(maybe_broadcast(items), "ref").select("doc_id", "text_key", "ref", "n_item", "start", same.alias("same"))
    length = F.least(F.lit(window), F.col("n_item"))
    enough = F.exists(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("same") - length + 1)), lambda i: (
        100 * F.aggregate(F.slice("same", i, length), F.lit(0), lambda s, x: s + x) >= percent * length))
    total = F.aggregate("same", F.lit(0), lambda s, x: s + x)
    best = compared.where((F.size("same") >= length) & enough).groupBy("doc_id", "text_key", "ref").agg(
        F.max(F.struct(total.alias("n_equal"), (-F.col("start")).alias("late"), F.size("same").alias("n_aligned"))).alias("b"))
    return best.select("doc_id", "text_key", "ref", (-F.col("b.late")).alias("start"), "b.n_aligned", "b.n_equal")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without an overlap, with their columns."""
    bad = overlaps(docs, benchmark, id_col=id_col, text_col=text_col, **how)
    bad = materialize(bad.select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t")).distinct(), "decontam-found")
    same = F.col(id_col).eqNullSafe(F.col("__d")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__t"))
    return docs.join(maybe_broadcast(bad), same, "left_anti")
