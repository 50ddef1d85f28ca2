"""Merkle dataset manifest with pointer-jumping proofs.

1. *Leaves.*  Every row becomes the sha256 of its fields.  Leaves are sorted by
   (group, id) over range partitions and written; a leaf's place in its group is its
   place in the partition plus the leaves of the partitions before, so a group of any
   size spreads over many tasks.
2. *Trees.*  Runs of ``ARITY`` nodes have one parent.  An aggregate takes 27 nodes to
   three levels at once and gives every node its first segment: the digests of its
   siblings, with a pointer to the parent.  The groups' roots are the leaves of one
   more tree of the same kind, whose root stands for the dataset.
3. *Pointer jumping.*  A self-join takes each node to the one it points to, appends
   that one's segment and takes over its pointer, so every round doubles the distance
   until all leaves point past the root.  A node whose level is no multiple of the
   distance is pointed to by no leaf any more and goes.
4. *Proofs.*  A leaf's segments from the bottom up are its proof; folding it over any
   leaf gives the root that the leaf claims.

A segment holds, for each level, the siblings' digests from left to right (32 bytes
each) and one character that says how many stand left and right.

Defined results
---------------
* A field counts as ``-`` if null, else its number of UTF-8 bytes, ``:``, its text.
* A null group is a group of its own, before all others; groups are ordered by UTF-8
  bytes.  Leaves ascend by id, null ids first, equal ids by digest, so the trees do
  not depend on partitions.  Repeated rows are leaves of their own.
* A group of one leaf has that leaf as its root; a dataset of one group has the group's
  root.  An empty table gives an empty result.
* Other columns play no part but those named to be carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.places import numbered, small
from tidemark.session import materialize

ARITY = 3
#: Levels that one aggregate builds, and the nodes that it takes together.
LEVELS = 3
SPAN = ARITY**LEVELS
#: The tree over the groups; trees of groups are numbered from 0.
TOP = -1


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*fields: Column) -> Column:
    """The digest of a row, in hex."""
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def height(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    return F.size(F.filter(F.array(*[F.lit(ARITY**i).cast("long") for i in range(40)]), lambda p: p < n))


def above(nodes: Column) -> Column:
    """The parents of an array of digests, run by run."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / ARITY).cast("int") - 1)
    digest = lambda i: F.unhex(F.sha2(F.lower(F.hex(joined(F.slice(nodes, i * ARITY + 1, F.lit(ARITY))))), 256))
    return F.transform(runs, digest)


def joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda a, b: F.concat(a, b))


def segment(nodes: Column, i: Column) -> dict[str, Column]:
    """Of node i (from 0) among its run: the siblings, and how they stand."""
    first = (i - i % ARITY).cast("int")
    left = (i % ARITY).cast("int")
    run = F.slice(nodes, first + 1, F.lit(ARITY))
    right = F.size(run) - left - 1
    siblings = F.concat(joined(F.slice(run, F.lit(1), left)), joined(F.slice(run, left + 2, F.lit(ARITY))))
    return {"path": siblings, "shape": (left * ARITY + right).cast("string")}


def grow(leaves: DataFrame, payload: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From (tree, n, place, digest, payload) to the leaves with their segments, the
    inner nodes with theirs, and the roots (tree, digest).  Nodes below a root point
    to (tree, level, place) of their parent; those that a root stands above have
    ``at_level`` equal to the tree's height."""
    level, base = leaves.select("tree", "n", "place", "digest", F.struct(*payload).alias("own")), 0
    tops, bottoms, inner = None, None, None
    first = leaves.agg(F.max("n")).first()[0] or 0
    rounds = 1 + len([i for i in range(1, 60) if ARITY ** (LEVELS * i) < first])
    for r in range(rounds):
        own = ["own"] if r == 0 else []
        taken = F.sort_array(F.collect_list(F.struct("place", "digest", *own)))
        spans = level.groupBy("tree", "n", F.floor(F.col("place") / SPAN).alias("span")).agg(taken.alias("members"))
        spans = spans.withColumn("a0", F.col("members.digest"))
        for i in range(LEVELS):
            spans = spans.withColumn(f"a{i + 1}", above(F.col(f"a{i}")))
        spans = materialize(spans.drop("a0").withColumn("height", height(F.col("n"))), "merkle-spans")
        spans = spans.withColumn("a0", F.col("members.digest"))
        for i in range(LEVELS):
            nodes, lowest = F.col(f"a{i}"), base + i == 0
            each = spans if lowest else spans.where(F.col("height") > base + i)
            each = each.select("tree", "height", "span", f"a{i}", F.posexplode("members" if lowest else f"a{i}").alias("i", "node"))
            # a leaf that is its tree's root has no siblings and nobody to point to in that tree
            root = F.col("height") == base + i
            width = SPAN // ARITY**i
            seg = segment(nodes, F.col("i"))
            out = each.select(
                "tree", F.lit(base + i).alias("level"), (F.col("span") * width + F.col("i")).alias("place"), "height",
                F.when(root, F.lit(b"")).otherwise(seg["path"]).alias("path"), F.when(root, "").otherwise(seg["shape"]).alias("shape"),
                F.when(root, F.lit(base + i)).otherwise(F.lit(base + i + 1)).alias("at_level"),
                F.when(root, F.lit(0).cast("long")).otherwise(F.floor((F.col("span") * width + F.col("i")) / ARITY)).alias("at_place"),
                *(["node.digest", "node.own"] if lowest else []))
            if lowest:
                bottoms = out
            else:
                inner = out if inner is None else inner.unionByName(out)
            here = spans.where(F.col("height") == base + i).select("tree", F.element_at(nodes, 1).alias("digest"))
            tops = here if tops is None else tops.unionByName(here)
        base += LEVELS
        level = spans.where(F.col("height") >= base).select("tree", "n", F.col("span").alias("place"), F.element_at(f"a{LEVELS}", 1).alias("digest"))
    here = level.where(height(F.col("n")) == base).select("tree", "digest")
    return bottoms, inner, tops.unionByName(here)


def pointed(nodes: DataFrame, top: bool) -> DataFrame:
    """Pointers as one (at_tree, at_level, at_place); those to a root lead on into the
    tree over the groups, or nowhere from there."""
    at_root = F.col("at_level") == F.col("height")
    if top:
        return nodes.withColumns({"at_tree": F.when(~at_root, F.col("tree"))})
    return nodes.withColumns({
        "at_tree": F.when(at_root, F.lit(TOP).cast("long")).otherwise(F.col("tree")),
        "at_place": F.when(at_root, F.col("tree")).otherwise(F.col("at_place")),
        "at_level": F.when(at_root, F.lit(0)).otherwise(F.col("at_level"))})


AT = ["at_tree", "at_level", "at_place"]


def jump(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """One round: append the segment of the node pointed to, and point where it points."""
    to = targets.select(*[F.col(c[3:]).alias(f"to_{c}") for c in AT], F.col("path").alias("more"), F.col("shape").alias("shapes"),
                        *[F.col(c).alias(f"next_{c}") for c in AT])
    on = [F.col(c) == F.col(f"to_{c}") for c in AT]
    met = F.col("to_at_tree").isNotNull()
    kept = [c for c in nodes.columns if c not in (*AT, "path", "shape")]
    # who points past the root meets nobody; its own place spreads such rows over the tasks
    return nodes.join(small(to), on[0] & on[1] & on[2], "left").select(
        *kept, F.when(met, F.concat("path", "more")).otherwise(F.col("path")).alias("path"),
        F.when(met, F.concat("shape", "shapes")).otherwise(F.col("shape")).alias("shape"),
        F.when(met, F.col("next_at_tree")).alias("at_tree"),
        F.when(met, F.col("next_at_level")).otherwise(F.col("at_level")).alias("at_level"),
        F.when(F.col("next_at_tree").isNotNull(), F.col("next_at_place")).otherwise(F.col("place")).alias("at_place"))


def manifest(docs: DataFrame, fields: list[str], group_col: str = "source", id_col: str = "doc_id",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root (hex), path, shape and the
    carried columns.  ``path`` and ``shape`` are the proof (see ``fold``)."""
    carry = carry or {}
    spark = docs.sparkSession
    rows = docs.select(F.col(group_col).alias("group"), F.col(id_col).alias("id"), F.unhex(leaf(*[F.col(c) for c in fields])).alias("digest"),
                       *[c.alias(f"carried_{n}") for n, c in carry.items()])
    rows = materialize(rows, "merkle-digests")  # texts are hashed once; the sort below reads its input twice
    payload = ["id", *[f"carried_{n}" for n in carry]]
    leaves = numbered(rows, "group", ["id", "digest"])
    # groups get the numbers of their trees in their order
    groups = materialize(numbered(leaves.groupBy("group").agg(F.count("*").alias("leaves")), None, ["group"])
                         .select("group", F.col("place").alias("tree")), "merkle-groups")
    named = groups.withColumnRenamed("group", "__g")
    leaves = materialize(leaves.join(small(named), F.col("group").eqNullSafe(F.col("__g"))).drop("__g", "group"), "merkle-leaves")
    bottoms, inner, roots = grow(leaves, payload)
    roots = materialize(roots, "merkle-roots")
    count = roots.count()
    over = roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), F.col("tree").alias("place"), "digest")
    top_bottoms, top_inner, top = grow(over.withColumn("none", F.lit(0)), ["none"])
    shape = ["tree", "level", "place", "path", "shape", *AT]
    up = pointed(top_bottoms, True).select(*shape).unionByName(pointed(top_inner, True).select(*shape))
    nodes = materialize(pointed(inner, False).select(*shape).unionByName(up), "merkle-nodes")
    leaf_rows = pointed(bottoms, False).select("tree", "place", "digest", "own", "path", "shape", *AT)
    longest = leaves.agg(F.max("n")).first()[0] or 0
    steps = sum(len([i for i in range(40) if ARITY**i < x]) for x in (longest, count)) + 1
    distance = 1
    while True:
        # a segment of every leaf and one of what it points to: twice the distance
        leaf_rows = jump(leaf_rows, nodes)
        distance *= 2
        if distance >= steps:
            break
        useful = (F.col("tree") == TOP) | (F.col("level") % distance == 0)
        nodes = materialize(jump(nodes.where(useful), nodes), "merkle-nodes")
    root = top.first()  # one digest
    whole = F.lit(bytes(root["digest"]).hex() if root else "")
    tops = roots.select(F.col("tree").alias("__t"), F.lower(F.hex("digest")).alias("subroot"))
    out = leaf_rows.join(small(tops), F.col("tree") == F.col("__t"))
    return out.select(F.col("own.id").alias(id_col), F.lower(F.hex("digest")).alias("leaf"), "subroot", whole.alias("root"), "path", "shape",
                      *[F.col(f"own.carried_{n}").alias(n) for n in carry])


def proof_text(path: Column) -> Column:
    """The siblings' digests in hex, one after another."""
    return F.lower(F.hex(path))


def fold(digest: Column, path: Column, shape: Column) -> Column:
    """The root that a leaf (hex) and a proof lead to."""
    steps = F.filter(F.split(shape, ""), lambda c: c != "")
    start = F.struct(digest.alias("node"), proof_text(path).alias("proof"), F.lit(1).alias("at"))

    def step(state, c):
        code = c.cast("int")
        left, right = F.floor(code / ARITY).cast("int") * 64, (code % ARITY) * 64
        proof, at = state["proof"], state["at"]
        return F.struct(F.sha2(F.concat(F.substr(proof, at, left), state["node"], F.substr(proof, at + left, right)), 256).alias("node"),
                        proof.alias("proof"), (at + left + right).alias("at"))

    return F.aggregate(steps, start, step, lambda s: s["node"])
