"""N-gram Jaccard join by signature trees.

Documents are sets of word shingles; two link when the Jaccard similarity of
their sets reaches a threshold.  The result is exact: every link between
different sets counts, and a document's component is what links reach.

1. *Classes.*  Equal sets are one class; everything below works on classes.
2. *Routing.*  Two sets that link share one of the first n - ceil(t n) + 1
   shingles of each under any common order, so classes meet under those.  The
   order puts shingles that many documents hold last.  A shingle that is
   frequent even so is routed by size band as well: linked sets lie in the same
   band or the next one.
3. *Contraction.*  On crowded routes each class is compared with a few others, of
   similar size, that it shares routes with; those that link pull groups of near
   copies together, so that the number of pairs within such a group stays linear.
   Done ``contract`` times over what is still open there.
4. *Signature trees.*  For every route that still holds several components, a
   tree over the classes in order of size: a leaf is a class with its shingle
   bitmap, a node the OR of its children's bitmaps with their range of sizes,
   of components and of bit collisions.  A dual traversal walks pairs of nodes
   and drops a pair whose sizes can't link, whose members are one component
   already, or whose largest possible overlap - the common bits plus the
   smaller number of collisions - is too small.  What reaches the leaves is
   verified on the whole sets.

Routes are cut into blocks, and pairs of blocks are tasks of their own, so a
route of any size needs bounded memory.  ``contract=0`` leaves step 3 out; the
results agree.

Defined results
---------------
* Words are runs of characters other than space and 09-0D; A-Z is lower-cased.
* Fewer words than a shingle: the whole sequence is the only element.  A text
  that is null or without words has the empty set and links with nothing.
* Every row of the input is a document; rows that share an id and differ in
  text are different documents.  The component is named by its smallest id;
  null where all its ids are null.  An empty table gives an empty result.
* Shingles and classes are compared by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bytewords as B
from tidemark.llm.batches import small_batches
from tidemark.llm.components import components
from tidemark.llm.shingles import set_digests, shingle_sets
from tidemark.llm.workers import release, trimmed
from tidemark.operators.relational import maybe_broadcast
from tidemark.session import materialize

#: How many frequent shingles the order knows of (a hint: 8 bytes each in every
#: task, whatever the input).
FREQUENT = 65_536
#: Classes of one route that one task holds on either side.
BLOCK = 8_192
#: Classes that one class is compared with in a round of contraction.
CONTRACT_PAIRS = 6
#: Sets that a task remembers to have met (a saving, whatever it forgets).
SEEN = 1 << 16
#: Children of a node.
FANOUT = 4
#: Routes of more classes are contracted before their trees are walked.
CROWDED = 16
#: Routes of no more classes are walked together with others.
SMALL = 64


# ---- frequent shingles ---------------------------------------------------
def frequent_shingles(texts: DataFrame, k: int) -> np.ndarray:
    """The shingles that most documents hold, by the sum over tasks of counts
    of those that at least one in 1000 of a task's documents holds."""
    def count(batches):
        release()
        held, docs = [], 0

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= max(4, docs / 1000)
            return pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(n[keep])], ["h", "n"])

        size = 0
        for batch in batches:
            for first, last, _, h in shingle_sets(batch.column(0), k):
                held.append(h)
                docs += last - first
                size += len(h)
                if size > 2 << 20:
                    yield flush()
                    held, docs, size = [], 0, 0
        if held:
            yield flush()

    top = (texts.mapInArrow(trimmed(count), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "h").limit(FREQUENT).select("h").toPandas())
    return np.sort(top["h"].to_numpy(np.int64).view(np.uint64))


def among(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


# ---- sets, routes and signatures ------------------------------------------
def bitmap(h: np.ndarray) -> bytes:
    """One bit per shingle in a power of two of bits, at least twice the shingles."""
    bits = np.zeros(max(64, 1 << int(2 * len(h) - 1).bit_length()), bool)
    bits[h & np.uint64(len(bits) - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def summaries(docs: DataFrame, k: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """doc_id, text_key, n, d1, d2, routes, bits: one row per document.  Routes and
    bits are null for a set that the task has met before."""
    band_width = math.log(100 / percent) * 1.0001
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def each(batches):
        release()
        frequent, seen = known.value, set()
        for batch in batches:
            ids = batch.column(0)
            for first, last, sizes, h in shingle_sets(batch.column(1), k):
                d1, d2 = set_digests(sizes, h)
                doc = np.repeat(np.arange(last - first), sizes)
                often = among(frequent, h)
                ends = np.cumsum(sizes)
                begins = ends - sizes
                take = sizes - (percent * sizes + 99) // 100 + 1
                order = np.lexsort((h, often, doc)) if often.any() else np.arange(len(h))
                routes, bits = [], []
                for i, (b, e, n, p) in enumerate(zip(begins.tolist(), ends.tolist(), sizes.tolist(), take.tolist())):
                    if not n or (int(d1[i]), int(d2[i])) in seen:
                        routes.append(None)
                        bits.append(None)
                        continue
                    seen.add((int(d1[i]), int(d2[i])))
                    at = order[b: b + p]
                    r, hot = h[at], often[at]
                    if hot.any():
                        band = int(math.log(n) / band_width)
                        r = np.concatenate([r[~hot], *(B.mix(r[hot] + np.uint64(x * 0x9E3779B9 + 1)) for x in (band, band + 1))])
                    routes.append(r.view(np.int64))
                    bits.append(bitmap(h[b:e]))
                if len(seen) > SEEN:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), batch.column(2).slice(first, last - first), pa.array(sizes, pa.int64()), pa.array(d1.view(np.int64)),
                     pa.array(d2.view(np.int64)), pa.array(routes, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                    ["doc_id", "text_key", "n", "d1", "d2", "routes", "bits"])

    return docs.mapInArrow(trimmed(each), "doc_id long, text_key long, n long, d1 long, d2 long, routes array<long>, bits binary")


def shared_routes(entries: DataFrame, percent: int) -> DataFrame:
    """(route, n, c) -> those that meet a class of a size that allows a link."""
    def stream(batches):
        held = np.zeros((0, 4), np.int64)  # of the last route: route, n, c, whether it is out already
        for batch in batches:
            rows = np.stack([np.asarray(batch.column(i)) for i in range(3)] + [np.zeros(batch.num_rows, np.int64)], 1)
            out, held = meeting(np.concatenate([held, rows]), percent)
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(out[:, i]) for i in range(3)], ["route", "n", "c"])

    return (entries.repartition("route").sortWithinPartitions("route", "n", "c")
            .mapInArrow(trimmed(stream), "route long, n long, c long"))


def meeting(rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by route, n, c, and a mark of those given out -> the rows to give
    out, and those of the last route that later rows may yet meet."""
    if not len(rows):
        return rows, rows
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    rows = rows[new]
    # in order of size, a row has a partner that may link if a neighbour is one
    near = np.zeros(len(rows), bool)
    near[1:] = (rows[1:, 0] == rows[:-1, 0]) & (100 * rows[:-1, 1] >= percent * rows[1:, 1])
    near[:-1] |= near[1:]
    out = rows[near & (rows[:, 3] == 0), :3]
    last = rows[-1:].copy()
    last[:, 3] |= near[-1:]
    return out, last


def size_window(route, n, percent):
    """Of rows sorted by route and n: the run of each row, and the first and last
    row of the run such that the smaller size is ``percent`` in a hundred of the larger."""
    first = np.ones(len(route), bool)
    first[1:] = route[1:] != route[:-1]
    run = np.cumsum(first) - 1
    wide = int(n.max()) * 100 // percent + 2
    place = run * wide
    low = np.searchsorted(place + n, place + (percent * n + 99) // 100)
    return run, low, np.searchsorted(place + n, place + 100 * n // percent, "right") - 1


def undecided(rows: DataFrame, percent: int) -> DataFrame:
    """(route, n, c, label) -> the rows that meet a class of another component, of a
    size that allows a link, on their route; and one such class of similar size."""
    def stream(batches):
        held = np.zeros((0, 5), np.int64)  # the rows, and whether they are out already
        for batch in batches:
            held = np.concatenate([held, np.stack([*(np.asarray(batch.column(i)) for i in range(4)),
                                                   np.zeros(batch.num_rows, np.int64)], 1)])
            # rows are decided once a larger size than they can link with has come
            route, n = held[:, 0], held[:, 1]
            done = (route != route[-1]) | (100 * n < percent * n[-1])
            yield from give(held, done & (held[:, 4] == 0))
            held[done, 4] = 1
            # smaller rows stay while later ones may link with them
            held = held[(route == route[-1]) & (100 * 100 * n >= percent * percent * n[-1])]
        if len(held):
            yield from give(held, held[:, 4] == 0)

    def give(held, done):
        other = partners(held[:, :4], percent)
        keep = (other >= 0) & done
        if keep.any():
            out = [*held[keep, :4].T, held[other[keep], 2]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["route", "n", "c", "label", "partner"])

    return (rows.repartition("route").sortWithinPartitions("route", "n", "label")
            .mapInArrow(trimmed(stream), "route long, n long, c long, label long, partner long"))


def partners(rows: np.ndarray, percent: int) -> np.ndarray:
    """Rows sorted by route, n, label -> for each the place of a row of another
    label whose size allows a link, or -1.  Preferred is any one of nearly the
    row's size, picked by a hash of route and class; then the nearest."""
    route, n, _, label = rows.T
    run, low, high = size_window(route, n, percent)
    change = np.ones(len(rows), bool)
    change[1:] = (label[1:] != label[:-1]) | (run[1:] != run[:-1])
    block = np.cumsum(change) - 1
    starts = np.append(np.flatnonzero(change), len(rows))
    before, after = starts[block] - 1, starts[block + 1]
    other = np.where(after <= high, after, -1)
    other = np.where(before >= low, before, other)
    _, near, far = size_window(route, n, 97)
    pick = B.mix(B.mix(route.view(np.uint64)) + rows[:, 2].view(np.uint64)) % (far - near + 1).astype(np.uint64)
    pick = near + pick.astype(np.int64)
    return np.where(label[pick] != label, pick, other)


# ---- trees ----------------------------------------------------------------
class Tree:
    """Levels of nodes over classes that share a bitmap width, leaves in order of size."""

    def __init__(self, n, label, bits):
        order = np.lexsort((label, n))
        self.order = order
        n, label, bits = n[order], label[order], bits[order]
        spare = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [(bits, n, n, label, label, spare)]
        while len(n) > 1:
            at = np.arange(0, len(n), FANOUT)
            b, lo, hi, l0, l1, s = self.levels[-1]
            n = np.minimum.reduceat(lo, at)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), n, np.maximum.reduceat(hi, at),
                                np.minimum.reduceat(l0, at), np.maximum.reduceat(l1, at), np.maximum.reduceat(s, at)))

    def children(self, level, i):
        """Node indexes i at a level -> (which of i, child) pairs one level down."""
        size = len(self.levels[level - 1][1])
        kids = i[:, None] * FANOUT + np.arange(FANOUT)
        which, col = np.nonzero(kids < size)
        return which, kids[which, col]


def possible(a, b, i, j, percent):
    """Which pairs of nodes may hold a link that joins two components."""
    (ab, alo, ahi, al0, al1, asp), (bb, blo, bhi, bl0, bl1, bsp) = a, b
    ok = (100 * ahi[i] >= percent * blo[j]) & (100 * bhi[j] >= percent * alo[i])
    ok &= ~((al0[i] == al1[i]) & (bl0[j] == bl1[j]) & (al0[i] == bl0[j]))
    i, j = i[ok], j[ok]
    common = np.bitwise_count(ab[i] & bb[j]).sum(1, dtype=np.int64)
    overlap = np.minimum(common + np.minimum(asp[i], bsp[j]), np.minimum(ahi[i], bhi[j]))
    # 100 * overlap >= percent * union, with union = sizes - overlap
    fit = (100 + percent) * overlap >= percent * (alo[i] + blo[j])
    return i[fit], j[fit]


def dual(a: Tree, b: Tree, percent: int):
    """Pairs of leaves (places in the trees' inputs) that survive the dual traversal."""
    same = a is b
    stack = [(len(a.levels) - 1, len(b.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        la, lb, i, j = stack.pop()
        if len(i) > 4096:
            half = len(i) // 2
            stack += [(la, lb, i[:half], j[:half]), (la, lb, i[half:], j[half:])]
            continue
        i, j = possible(a.levels[la], b.levels[lb], i, j, percent)
        if not len(i):
            continue
        if not la and not lb:
            keep = i < j if same else np.ones(len(i), bool)
            yield a.order[i[keep]], b.order[j[keep]]
            continue
        down_a, down_b = la >= lb, lb >= la  # the higher tree goes down; both where they are level
        if down_a:
            which, i = a.children(la, i)
            j = j[which]
        if down_b:
            which, j = b.children(lb, j)
            i = i[which]
        if same:
            i, j = i[i <= j], j[i <= j]
        stack.append((la - down_a, lb - down_b, i, j))


class Forest:
    """The trees of many small routes at once: leaves in order of route and size, and
    above them nodes of up to FANOUT leaves of a route, all of one bitmap width."""

    def __init__(self, route, n, label, bits):
        self.order = order = np.lexsort((label, n, route))
        route, n, label, bits = route[order], n[order], label[order], bits[order]
        spare = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.leaves = (bits, n, n, label, label, spare)
        first = np.flatnonzero(np.append(True, route[1:] != route[:-1]))
        place = np.arange(len(n)) - np.repeat(first, np.diff(np.append(first, len(n))))
        at = np.flatnonzero(place % FANOUT == 0)
        self.nodes = (np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(n, at), np.maximum.reduceat(n, at),
                      np.minimum.reduceat(label, at), np.maximum.reduceat(label, at), np.maximum.reduceat(spare, at))
        self.route, self.at = route[at], np.append(at, len(n))


def expand(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of the given sizes: the run of every member, and its place in it."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return run, np.arange(len(run)) - (np.cumsum(sizes) - sizes)[run]


def meet(a: Forest, b: Forest, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs (places in the forests' inputs) that survive the dual traversal of the
    trees of each route, from its nodes down."""
    same = a is b
    low = np.searchsorted(b.route, a.route)
    i, j = expand(np.searchsorted(b.route, a.route, "right") - low)
    j += low[i]
    if same:
        i, j = i[i <= j], j[i <= j]
    i, j = possible(a.nodes, b.nodes, i, j, percent)
    wide = b.at[j + 1] - b.at[j]
    pair, k = expand((a.at[i + 1] - a.at[i]) * wide)
    x, y = a.at[i[pair]] + k // wide[pair], b.at[j[pair]] + k % wide[pair]
    if same:
        x, y = x[x < y], y[x < y]
    x, y = possible(a.leaves, b.leaves, x, y, percent)
    return a.order[x], b.order[y]


def small_routes(route, n, c, label, bits, percent):
    """Candidate pairs of whole routes of few classes."""
    width = np.array([len(x) for x in bits])

    def forest(w, as_w):
        at = np.flatnonzero(width == w)
        if not len(at):
            return at, None
        raw = np.frombuffer(b"".join(bits[x] for x in at), "<u8").reshape(len(at), w // 8)
        return at, Forest(route[at], n[at], label[at], fold(raw, as_w // 8))

    for w in np.unique(width).tolist():
        # sizes that link differ by less than a factor of two, so bitmaps too by two at most
        (at, one), (wide_at, wide) = forest(w, w), forest(2 * w, w)
        x, y = meet(one, one, percent)
        yield c[at[x]], c[at[y]]
        if wide is not None:
            x, y = meet(one, wide, percent)
            yield c[at[x]], c[wide_at[y]]


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def route_pairs(n, c, label, bits, side, percent):
    """Candidate pairs of one block pair: within a block, or between sides 0 and 1."""
    width = np.array([len(x) for x in bits])
    trees: dict = {}

    def tree(s, w, as_w):
        if (s, w, as_w) not in trees:
            at = np.flatnonzero((width == w) & ((side == s) | (side == 2)))
            raw = np.frombuffer(b"".join(bits[x] for x in at), "<u8").reshape(len(at), w // 8)
            trees[s, w, as_w] = (at, Tree(n[at], label[at], fold(raw, as_w // 8))) if len(at) else (at, None)
        return trees[s, w, as_w]

    sides = [(2, 2)] if (side == 2).all() else [(0, 1)]
    for w in np.unique(width).tolist():
        for sa, sb in sides:
            # sizes that link differ by less than a factor of two, so bitmaps too by two at most
            todo = [((sa, w, w), (sb, w, w)), ((sa, w, w), (sb, 2 * w, w))]
            todo += [((sa, 2 * w, w), (sb, w, w))] * (sa != sb)
            for x, y in todo:
                (at_x, tx), (at_y, ty) = tree(*x), tree(*y)
                if tx is not None and ty is not None:
                    for i, j in dual(tx, ty, percent):
                        yield c[at_x[i]], c[at_y[j]]


def tree_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(route, n, c, label, bits, size) of routes with several components -> distinct (a, b)."""
    cut = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    mine = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")
    spread = (cut.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("route", F.least("mine", "other").alias("g1"), F.greatest("mine", "other").alias("g2"),
                      F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"),
                      "n", "c", "label", "bits"))

    def walk(batches):
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            key = np.stack([np.asarray(held.column(x)) for x in ("route", "g1", "g2")], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist()]
            few = []  # of whole routes, one after another
            for x, y in zip(cuts, cuts[1:]):
                if y - x > SMALL or held.column("side")[x].as_py() != 2:
                    yield from one(held.slice(x, y - x))
                else:
                    few.append(np.arange(x, y))
            if few:
                yield from many(held.take(pa.array(np.concatenate(few))))
            held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from one(held)

    def one(group):
        n, c, label, side = (np.asarray(group.column(x)).astype(np.int64) for x in ("n", "c", "label", "side"))
        yield from given(route_pairs(n, c, label, group.column("bits").to_pylist(), side, percent))

    def many(rows):
        route, n, c, label = (np.asarray(rows.column(x)).astype(np.int64) for x in ("route", "n", "c", "label"))
        yield from given(small_routes(route, n, c, label, rows.column("bits").to_pylist(), percent))

    def given(got):
        """Pairs in batches, as the traversal comes by them."""
        some, size = [], 0
        for a, b in got:
            some.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
            size += len(a)
            if size > 1 << 16:
                yield batch_of(some)
                some, size = [], 0
        if size:
            yield batch_of(some)

    def batch_of(some):
        pairs = np.unique(np.concatenate(some), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return (spread.repartition("route", "g1", "g2").sortWithinPartitions("route", "g1", "g2")
            .mapInArrow(trimmed(walk), "a long, b long").distinct())


def anchored(rows: DataFrame) -> DataFrame:
    """(route, n, c, label) -> (route, n, c, label, size): routes that have the same least
    class become one, in which a class stands once, whatever number of routes it shares.
    What shares a route shares that of its least class, so no pair is lost; groups that
    hold one component only go."""
    least = rows.groupBy("route").agg(F.min("c").alias("__least"))
    whole = materialize(rows.join(least, "route").select(F.col("__least").alias("route"), "n", "c", "label").distinct(), "near-anchored")
    sizes = whole.groupBy(F.col("route").alias("__r")).agg(
        F.count("*").alias("size"), F.min("label").alias("__a"), F.max("label").alias("__b")).where("__a <> __b")
    return materialize(whole.join(sizes.select("__r", "size"), F.col("route") == F.col("__r")).drop("__r"), "near-sized")


# ---- verification ----------------------------------------------------------
def class_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(c, words): the whole sets of the wanted classes; ids has (doc_id, c)."""
    def each(batches):
        for batch in batches:
            for first, last, sizes, h in shingle_sets(batch.column(1), k):
                ends = np.cumsum(sizes)
                d1, _ = set_digests(sizes, h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d1.view(np.int64)), batch.column(0).slice(first, last - first).cast(pa.int64()),
                     pa.array([h[e - s: e].tobytes() for s, e in zip(sizes.tolist(), ends.tolist())], pa.binary())],
                    ["c", "want", "words"])

    wanted = docs.join(maybe_broadcast(ids.where("doc_id is not null")), "doc_id").select("c", "text")
    # a doc_id that occurs with several texts gives sets of other classes, which go
    sets = wanted.mapInArrow(trimmed(each), "c long, want long, words binary").where("c = want").select("c", "words")
    # rows without an id are found by what they hold
    nameless = (docs.where("doc_id is null").select(F.lit(0).cast("long").alias("c"), "text")
                .mapInArrow(trimmed(each), "c long, want long, words binary").select("c", "words")
                .join(ids.where("doc_id is null").select("c"), "c", "left_semi"))
    return sets.unionByName(nameless).dropDuplicates(["c"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    def each(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = int(among(y, x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (pairs.join(sets.select(F.col("c").alias("a"), F.col("words").alias("x")), "a")
            .join(sets.select(F.col("c").alias("b"), F.col("words").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(trimmed(each), "a long, b long"))


def bits_fit(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose bitmaps allow a link (one leaf against one leaf)."""
    def each(batches):
        for batch in batches:
            na, nb = np.asarray(batch.column("na")), np.asarray(batch.column("nb"))
            ub = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist())):
                x, y = np.frombuffer(x, "<u8")[None], np.frombuffer(y, "<u8")[None]
                w = min(x.shape[1], y.shape[1])
                x, y = fold(x, w), fold(y, w)
                spare = min(na[i] - np.bitwise_count(x).sum(dtype=np.int64), nb[i] - np.bitwise_count(y).sum(dtype=np.int64))
                ub[i] = min(np.bitwise_count(x & y).sum(dtype=np.int64) + spare, na[i], nb[i])
            yield batch.select(["a", "b"]).filter(pa.array((100 + percent) * ub >= percent * (na + nb)))

    side = lambda v: classes.select(F.col("c").alias(v), F.col("n").alias(f"n{v}"), F.col("bits").alias(f"x{v}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(
        each, "a long, b long")


def text_key(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    contract: int = 3) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id, class_id,
    component (a class that stands for all of it), n_linked (classes in it)."""
    docs = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       text_key(F.col(text_col)).alias("text_key"))
    every = materialize(summaries(docs, k, percent, frequent_shingles(docs.select("text"), k)), "near-summaries")
    # class c is named by the first digest
    named = every.where("n > 0").groupBy(F.col("d1").alias("c")).agg(F.min("doc_id").alias("doc_id"))
    entries = every.where("routes is not null").select(F.explode("routes").alias("route"), "n", F.col("d1").alias("c"))
    shared = materialize(shared_routes(entries, percent), "near-routes")
    classes = materialize(
        every.where("bits is not null").select(F.col("d1").alias("c"), "n", "bits")
        .join(shared.select("c").distinct(), "c", "left_semi").dropDuplicates(["c"]), "near-classes")

    def link(pairs):
        pairs = materialize(pairs, "near-candidates")
        if pairs.isEmpty():
            return None
        wanted = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()
        ids = materialize(named.join(wanted, "c"), "near-wanted")
        sets = materialize(class_sets(docs, ids, k), "near-sets")
        return materialize(verified(pairs, sets, percent), "near-links")

    def still_open(rows, labels):
        now = rows.withColumn("label", F.col("c"))
        if labels is not None:
            now = rows.join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
        return materialize(undecided(now.select("route", "n", "c", "label"), percent), "near-undecided")

    labels, tried = None, None
    many = shared.groupBy(F.col("route").alias("__r")).agg(F.count("*").alias("size")).where(F.col("size") > CROWDED)
    crowded = materialize(shared.join(many, F.col("route") == F.col("__r"), "left_semi"), "near-crowded")
    for _ in range(contract):
        open_rows = still_open(crowded, labels)
        votes = open_rows.groupBy("c", "partner").agg(F.count("*").alias("m"))
        if tried is not None:
            votes = votes.join(tried, ["c", "partner"], "left_anti")
        # of one row per route of the class at most
        rank = F.row_number().over(Window.partitionBy("c").orderBy(F.desc("m"), F.xxhash64("c", "partner")))
        best = materialize(votes.withColumn("k", rank).where(F.col("k") <= CONTRACT_PAIRS).select(
            F.col("c").alias("a"), F.col("partner").alias("b")), "near-best")
        both = best.select(F.col("a").alias("c"), F.col("b").alias("partner"))
        both = both.unionByName(both.select(F.col("c").alias("partner"), F.col("partner").alias("c")))
        tried = both if tried is None else tried.unionByName(both)
        found = link(bits_fit(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), classes, percent))
        if found is None or found.isEmpty():
            break
        labels = components(found, labels)
    open_rows = still_open(shared, labels)
    more = link(tree_pairs(anchored(open_rows).join(classes.select("c", "bits"), "c"), percent))
    labels = labels if more is None else components(more, labels)
    whole = named.withColumn("label", F.col("c"))
    if labels is not None:
        whole = named.join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    whole = materialize(whole, "near-named")
    top = whole.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n_linked"))
    member = whole.join(top, "label").select(F.col("c").alias("class_id"), F.col("label").alias("component"), "component_id", "n_linked")
    return (every.select("doc_id", "text_key", "n", F.when(F.col("n") > 0, F.col("d1")).alias("class_id")).join(member, "class_id", "left")
            .select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component",
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "class_id", F.coalesce("n_linked", F.lit(1)).alias("n_linked")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, of which one stays of every component:
    the one with the smallest id.  Texts without words all stay."""
    found = materialize(near_components(docs, k, percent, id_col, text_col).where("component is not null")
                        .groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("rows")), "near-found")
    first = found.groupBy(F.col("component").alias("__c")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"))
    judged = found.join(first, F.col("component") == F.col("__c")).select(
        F.col("doc_id").alias("__d"), F.col("text_key").alias("__t"), "rows",
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))).alias("stays"))
    judged = materialize(judged.where(~F.col("stays") | (F.col("rows") > 1)), "near-judged")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__d")) & (text_key(F.col(text_col)) == F.col("__t"))
    kept = docs.join(maybe_broadcast(judged.select("__d", "__t")), same, "left_anti")
    repeated = judged.where("stays")
    if repeated.isEmpty():
        return kept
    # rows that are there several times: one of them, combined before it is shuffled
    again = docs.join(maybe_broadcast(repeated.select("__d", "__t")), same).dropDuplicates(["__d", "__t"])
    return kept.unionByName(again.select(*[F.col(f"`{c}`") for c in docs.columns]))
