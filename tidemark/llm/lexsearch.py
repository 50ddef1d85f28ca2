"""Ranked lexical search by hashed max-sketches.

1. *Index.*  One pass over the texts writes a row per document: the number of its
   terms, its postings (hash and occurrences of every term) and its sketch.  A sketch
   folds the terms to WIDTH coordinates by their hash and keeps the largest number of
   occurrences in each; as a term's impact grows with its occurrences, that is the
   coordinatewise maximum of the impacts too.
2. *Statistics.*  Documents, terms and, for the terms of the queries, document
   frequencies come from the index.
3. *Bounds.*  A batch of sketches is looked up for a whole block of queries at once: a
   matrix product over the coordinates that they use.  A query's sum can't be less
   than the score, as a coordinate holds the impact of each of its terms at least.
4. *Rescoring.*  For every query the documents of a batch are scored exactly, from
   their postings, by descending bound, until the bound falls below the k-th best
   score so far.  Tasks give their k best of each query and Spark merges them.

Queries come in blocks of bounded size, so what goes to the tasks is bounded however
many there are; every block reads the index again.

Defined results
---------------
* Terms are the maximal runs of ASCII letters, ASCII digits and non-ASCII characters;
  only A-Z is lower-cased.  A null or empty text has none.
* A document without terms is not counted and never found.  Rows repeated in
  ``docs`` are documents of their own.
* Only scores above 0 are given.  Equal scores go by ascending id, null ids last.
* Rows equal in item id and text are one query; an item id that occurs with several
  texts is ranked for each.  An item without terms gives no row.
* Terms are compared by 64-bit hashes.  Other columns play no part; an empty table on
  either side gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytewords import NOT_ALNUM, text_words
from tidemark.session import materialize

#: Coordinates of a sketch; a byte each holds up to 254 occurrences, 255 stands for more.
WIDTH = 8_192
MANY = 255
#: No impact reaches this.
FULL = 1_000_000
#: Documents whose bounds are taken at once, and scored at once.
BOUND_ROWS = 512
SCORE_ROWS = 32
#: A block of queries.
BLOCK_ITEMS = 512
BLOCK_TERMS = 1 << 16
INDEX_SCHEMA = "id long, n long, terms binary, counts binary, coords binary, tops binary"


class Postings(NamedTuple):
    """Distinct terms of several texts, by text and ascending hash."""

    sizes: np.ndarray  # terms with repeats, per text
    ends: np.ndarray  # of a text's part in terms, after a leading 0
    terms: np.ndarray
    counts: np.ndarray


def postings(column: pa.Array) -> Iterator[tuple[int, int, Postings]]:
    """Of whole texts: (first row, last row + 1, postings)."""
    for first, last, sizes, hashes in text_words(column, NOT_ALNUM):
        rows = np.repeat(np.arange(last - first), sizes)
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
        at = np.flatnonzero(new)
        ends = np.searchsorted(rows[at], np.arange(last - first + 1))
        yield first, last, Postings(sizes, ends, hashes[at], np.diff(np.append(at, len(rows))))


def sketch(p: Postings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends per text, coordinates and the largest count of each."""
    texts = len(p.ends) - 1
    place = np.repeat(np.arange(texts), np.diff(p.ends)) * WIDTH + coordinate(p.terms)
    order = np.argsort(place, kind="stable")
    place = place[order]
    at = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
    tops = np.maximum.reduceat(p.counts[order], at) if len(at) else np.zeros(0, np.int64)
    return (np.searchsorted(place[at], np.arange(texts + 1) * WIDTH), (place[at] % WIDTH).astype(np.uint16),
            np.minimum(tops, MANY).astype(np.uint8))


def coordinate(terms: np.ndarray) -> np.ndarray:
    return (terms % np.uint64(WIDTH)).astype(np.int64)


def blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """values[ends[i]:ends[i + 1]] as bytes, one row each."""
    offsets = pa.py_buffer((ends * values.itemsize).astype(np.int64).tobytes())
    large = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, offsets, pa.py_buffer(values.tobytes())])
    return large.cast(pa.binary())


def index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for first, last, p in postings(texts):
            ends, coords, tops = sketch(p)
            yield pa.record_batch([
                ids.slice(first, last - first), pa.array(p.sizes, pa.int64()), blobs(p.terms, p.ends),
                blobs(p.counts.astype(np.uint32), p.ends), blobs(coords, ends), blobs(tops, ends)],
                names=["id", "n", "terms", "counts", "coords", "tops"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: a row per document, with sketch and postings."""
    return materialize(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                       .mapInArrow(index_batches, INDEX_SCHEMA), "lexical-index")


class Block(NamedTuple):
    """Some queries: each one's item and its terms (hashes) with their weights."""

    items: list
    ends: np.ndarray
    terms: np.ndarray
    weights: np.ndarray  # repeats before, whole weights after the statistics


def query_blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """Blocks of queries, streamed in pieces."""
    rows = queries.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).where("text IS NOT NULL").distinct()
    items, parts = [], []
    for row in rows.toLocalIterator():
        for _, _, p in postings(pa.array([row.text], pa.large_string())):
            if len(p.terms):
                items.append(row.item)
                parts.append((p.terms, p.counts))
        if len(items) >= BLOCK_ITEMS or sum(len(t) for t, _ in parts) >= BLOCK_TERMS:
            yield block(items, parts)
            items, parts = [], []
    if items:
        yield block(items, parts)


def block(items: list, parts: list) -> Block:
    return Block(items, np.append(0, np.cumsum([len(t) for t, _ in parts])), np.concatenate([t for t, _ in parts]),
                 np.concatenate([c for _, c in parts]).astype(np.int64))


def frequencies(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Documents that hold each term of the (sorted) vocabulary."""
    def count(batches):
        found = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
            at = np.searchsorted(vocabulary, terms)
            at[at == len(vocabulary)] = 0
            found += np.bincount(at[vocabulary[at] == terms], minlength=len(vocabulary))
        places = np.flatnonzero(found)
        yield pa.record_batch([pa.array(places, pa.int64()), pa.array(found[places], pa.int64())], names=["place", "df"])

    out = np.zeros(len(vocabulary), np.int64)
    # one number for each term of the block
    for place, df in index.select("terms").mapInArrow(count, "place long, df long").groupBy("place").agg(F.sum("df")).collect():
        out[place] = df
    return out


def weigh(b: Block, index: DataFrame, documents: int) -> Block:
    """Repeats times floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    vocabulary = np.unique(b.terms)
    df = frequencies(index, vocabulary)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    return b._replace(weights=b.weights * weight[np.searchsorted(vocabulary, b.terms)])


def norms(sizes: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """8 m of each document."""
    return np.array([8 * (25 + 75 * n * documents // terms) for n in sizes.tolist()], np.int64)


def impacts(counts: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * counts // (1000 * counts + norm)


def glued(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows and the ends of each row's part."""
    rows = column.to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), kind), np.append(0, np.cumsum([len(r) // size for r in rows])).astype(np.int64)


class Search:
    """The k best documents of every query of a block among the batches of a task."""

    def __init__(self, b: Block, k: int, documents: int, terms: int):
        self.block, self.k, self.documents, self.all_terms = b, k, documents, terms
        coords = coordinate(b.terms)
        used = np.unique(coords)
        self.column = np.full(WIDTH, -1)
        self.column[used] = np.arange(len(used))
        self.lookup = np.zeros((len(used), len(b.items)))
        np.add.at(self.lookup, (self.column[coords], np.repeat(np.arange(len(b.items)), np.diff(b.ends))), np.maximum(b.weights, 0))
        # best scores so far, best first; ids beside them, null ids in a column of their own
        self.scores = [np.zeros(0, np.int64)] * len(b.items)
        self.ids = [np.zeros(0, np.int64)] * len(b.items)
        self.nulls = [np.zeros(0, bool)] * len(b.items)
        self.rescored = 0

    def add(self, batch: pa.RecordBatch) -> None:
        for start in range(0, batch.num_rows, BOUND_ROWS):
            self.chunk(batch.slice(start, BOUND_ROWS))

    def chunk(self, batch: pa.RecordBatch) -> None:
        norm = norms(batch.column("n").to_numpy(), self.documents, self.all_terms)
        coords, ends = glued(batch.column("coords"), np.uint16)
        tops, _ = glued(batch.column("tops"), np.uint8)
        at = self.column[coords]
        doc = np.repeat(np.arange(batch.num_rows), np.diff(ends))
        asked = at >= 0
        at, doc, tops = at[asked], doc[asked], tops[asked].astype(np.int64)
        most = np.zeros((batch.num_rows, len(self.lookup)))
        most[doc, at] = np.where(tops == MANY, FULL, impacts(tops, norm[doc]))
        bounds = most @ self.lookup  # whole numbers well below 2**53
        ids = batch.column("id")
        null = np.asarray(ids.is_null())
        ids = ids.fill_null(0).to_numpy()
        terms, ends = glued(batch.column("terms"), np.uint64)
        counts, _ = glued(batch.column("counts"), np.uint32)
        for q in range(len(self.block.items)):
            self.rescore(q, bounds[:, q], norm, ids, null, terms, counts, ends)

    def rescore(self, q, bounds, norm, ids, null, terms, counts, ends) -> None:
        rest = np.flatnonzero(bounds >= max(1, self.bar(q)))
        if not len(rest):
            return
        rest = rest[np.argsort(-bounds[rest], kind="stable")]
        s, e = self.block.ends[q], self.block.ends[q + 1]
        mine, weights = self.block.terms[s:e], self.block.weights[s:e]
        for i in range(0, len(rest), SCORE_ROWS):
            some = rest[i: i + SCORE_ROWS]
            if bounds[some[0]] < self.bar(q):
                return
            lengths = ends[some + 1] - ends[some]
            own = np.repeat(np.arange(len(some)), lengths)
            span = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(ends[some], lengths)
            at = np.searchsorted(mine, terms[span])
            at[at == len(mine)] = 0
            hit = np.flatnonzero(mine[at] == terms[span])
            scores = np.zeros(len(some), np.int64)
            np.add.at(scores, own[hit], weights[at[hit]] * impacts(counts[span[hit]].astype(np.int64), norm[some[own[hit]]]))
            self.rescored += len(some)
            good = scores > 0
            self.keep(q, scores[good], ids[some[good]], null[some[good]])

    def bar(self, q) -> int:
        return int(self.scores[q][-1]) if len(self.scores[q]) == self.k else 0

    def keep(self, q, scores, ids, null) -> None:
        scores = np.concatenate([self.scores[q], scores])
        ids, null = np.concatenate([self.ids[q], ids]), np.concatenate([self.nulls[q], null])
        best = np.lexsort((ids, null, -scores))[: self.k]
        self.scores[q], self.ids[q], self.nulls[q] = scores[best], ids[best], null[best]

    def found(self) -> pa.RecordBatch:
        query = np.repeat(np.arange(len(self.block.items)), [len(s) for s in self.scores])
        return pa.record_batch([pa.array(query, pa.int64()), pa.array(np.concatenate(self.ids), pa.int64(), mask=np.concatenate(self.nulls)),
                                pa.array(np.concatenate(self.scores), pa.int64())], names=["query", "doc_id", "score"])


def search_block(index: DataFrame, b: Block, k: int, documents: int, terms: int) -> DataFrame:
    def run(batches):
        search = Search(b, k, documents, terms)
        for batch in batches:
            search.add(batch)
        yield search.found()

    return index.mapInArrow(run, "query long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each query."""
    index = build_index(docs, id_col, text_col)
    spark, kind = docs.sparkSession, queries.schema[item_col].dataType.simpleString()
    documents, terms = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    if not documents:
        return out
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    for b in query_blocks(queries, item_col, query_col):
        found = search_block(index, weigh(b, index, documents), k, documents, terms)
        named = spark.createDataFrame(list(enumerate(b.items)), f"query long, item_id {kind}")  # a block of items
        out = out.unionByName(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                              .join(F.broadcast(named), "query").select("item_id", "rank", "doc_id", "score"))
    return out
