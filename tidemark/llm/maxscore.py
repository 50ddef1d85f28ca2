"""Exact top-k by inner product with MaxScore over integer vectors.

A component of a query is a term, a column of a shard its postings.  For every
term a shard knows the least and the most that it can add to the score.  Terms
are split by those bounds: the essential ones, without which no vector can reach
the running threshold, are traversed for the whole shard; the others are probed
term group by term group, only for vectors that are still competitive.  Shards
give their k best and Spark merges them.

Queries come in blocks and candidates in shards of bounded size, spread by a
hash of the id; a task holds one block and one shard.

Defined results
---------------
* A component x becomes floor(256 * x).  A vector that is null or holds a null
  or non-finite component takes no part, nor does a row without an id.
* Vectors of different lengths are compared as if the shorter had zeros.
* Rows equal in id and vector are one; a query never meets its own id.  Ids that
  occur with several vectors are queries and candidates of their own each.
* Ties go to the smaller id.  Scores beyond a long are held at its ends.
* An empty table gives an empty result; other input columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8_192
QUERY_BLOCK = 1_024
PROBE = 8  # terms probed at once
EXACT = 2.0**53


def integers(column: pa.Array) -> np.ndarray:
    """Rows of floor(256 x), shorter ones padded with zeros."""
    rows = [256 * np.asarray(x, np.float64) for x in column.to_pylist()]
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width))
    for i, x in enumerate(rows):
        out[i, : len(x)] = np.floor(x)
    return out


def best(v: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places in the shard of the k best for one query, by score, then id."""
    low, high = v.min(0) * q, v.max(0) * q
    low, high = np.minimum(low, high), np.maximum(low, high)
    order = np.argsort(low - high, kind="stable")  # widest range first
    after = np.append(np.cumsum(high[order][::-1])[::-1], 0.0)  # most that the terms from here on add
    others = np.flatnonzero(ids != own)
    if len(others) <= k:
        return top(v[others] @ q, ids[others], others, k)
    # a first threshold: the k-th best of the k that look best by the widest terms
    widest = order[:PROBE]
    lead = others[np.argpartition(-(v[np.ix_(others, widest)] @ q[widest]), k - 1)[:k]]
    bar = np.sort(v[lead] @ q)[0]
    # essential terms: without them no vector reaches the threshold, whatever the others add
    most = low.sum() + np.append(np.cumsum((high - low)[order][::-1])[::-1], 0.0)  # by all terms but the first ones
    essential = max(1, int(np.argmax(most < bar)) if (most < bar).any() else len(q))
    seen = order[:essential]
    part = v[:, seen][others] @ q[seen]
    at = essential
    while True:
        keep = part + after[at] >= bar
        others, part = others[keep], part[keep]
        if at >= len(q):
            return top(part, ids[others], others, k)
        probe = order[at: at + PROBE]
        part = part + v[np.ix_(others, probe)] @ q[probe]
        at += PROBE
        at = min(at, len(q))
        if len(part) > k:
            # what the rest adds at least lifts the bar
            least = low[order[at:]].sum()
            bar = max(bar, np.partition(part, len(part) - k)[len(part) - k] + least)


def top(scores: np.ndarray, ids: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    return places[np.lexsort((ids, -scores))[:k]]


def shard_top(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best of one shard for every query of one block."""
    v, q = integers(vectors.column("embedding").combine_chunks()), integers(queries.column("embedding").combine_chunks())
    width = max(v.shape[1], q.shape[1])
    v, q = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (v, q))
    ids = np.asarray(vectors.column("vec_id"))
    own = np.asarray(queries.column("vec_id"))
    out_q, out_k, out_v, out_s = [], [], [], []
    exact = len(v) and len(q) and width and np.abs(v).max() * np.abs(q).max() * width < EXACT
    keys = queries.column("row").to_pylist()
    for i in range(len(q)):
        if not len(v):
            break
        if exact:
            at = best(v, ids, q[i], own[i], k)
            scores = (v[at] @ q[i]).astype(np.int64).tolist()
        else:  # components so large that products need whole numbers of any size
            mine = [int(y) for y in q[i]]
            whole = [max(-2**63, min(2**63 - 1, sum(int(x) * y for x, y in zip(r, mine)))) for r in v]
            at = sorted((j for j in range(len(v)) if ids[j] != own[i]), key=lambda j: (-whole[j], ids[j]))[:k]
            scores = [whole[j] for j in at]
        out_q += [own[i]] * len(at)
        out_k += [keys[i]] * len(at)
        out_v += ids[at].tolist() if len(at) else []
        out_s += scores
    return pa.table([pa.array(x, pa.int64()) for x in (out_q, out_k, out_v, out_s)], names=["query_id", "row", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score.  is_query: a column over (vec_id, embedding)."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
            .dropDuplicates(["vec_id", "embedding"]).withColumn("row", F.xxhash64("vec_id", "embedding")))
    queries = rows.where(is_query)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    spread = lambda df, own, n, other, m: (df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(n)))
                                           .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)).cast("array<long>"))))
    sides = spread(rows, "shard", shards, "block", blocks), spread(queries, "block", blocks, "shard", shards)
    found = (sides[0].groupBy("shard", "block").cogroup(sides[1].groupBy("shard", "block"))
             .applyInArrow(lambda v, q: shard_top(v, q, k), "query_id long, row long, vec_id long, score long"))
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
