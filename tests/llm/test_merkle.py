"""Merkle manifest against a plain recursion: group sizes, ties, nulls, tampering, empty tables."""

import random
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import DOCS
from tidemark.llm import merkle, places

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(i, text, lang, source, n):
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, source, lang, n, text)))


def climb(nodes):
    """The root over nodes, and each one's proof as (left, right) texts."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            s = i - i % 3
            proofs[k].append(("".join(nodes[s:i]), "".join(nodes[i + 1: s + 3])))
            at[k] = i // 3
        nodes = [h("".join(nodes[i: i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], proofs


def fold(node, proof):
    for left, right in proof:
        node = h(left + node + right)
    return node


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0] is not None, r[0] or 0, leaf(*r[:5]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = [climb([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order]
    root, over = climb([sub for sub, _ in tops]) if tops else ("", [])
    out = []
    for s, (sub, proofs), up in zip(order, tops, over):
        for (*_, digest, r), proof in zip(sorted(groups[s], key=lambda x: x[:3]), proofs):
            out.append((r[0], digest, sub, root, h("".join(a + b for a, b in proof + up)), fold(digest, proof + up)))
    return sorted(out, key=repr)


def made(df):
    got = merkle.manifest(df, FIELDS)
    return sorted(map(tuple, got.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256),
                                        merkle.fold(F.col("leaf"), F.col("path"), F.col("shape"))).collect()), key=repr)


def test_manifest_equals_plain_trees(spark, odd_rows, odd, clashing, empty):
    assert made(odd) == made(clashing) == brute(odd_rows)
    assert made(empty) == []


@pytest.mark.parametrize("sizes", [[1], [3], [1, 1], [27, 28, 1], [81, 82, 2, 4, 9, 10], [800] + [1] * 30])
def test_every_shape_of_tree(spark, sizes):
    rows = [(1000 * s + i, f"text {i}", None, f"s{s}" if s else None, i) for s, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    assert made(spark.createDataFrame(rows, DOCS).repartition(5)) == brute(rows)


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_joins_agree_with_and_without_broadcast(spark, monkeypatch, limit):
    monkeypatch.setattr(places, "BROADCAST_BYTES", limit)
    rows = [(i // 2, f"text {i % 50}", "en", "hot" if i % 3 else f"s{i % 40}", 1) for i in range(400)] + [(7, "again", "en", "hot", 1)] * 60
    assert made(spark.createDataFrame(rows, DOCS).repartition(4)) == brute(rows)


def test_a_changed_row_does_not_fold_to_the_root(spark):
    rows = [(i, f"a\nb {i}" if i % 2 else f"a b {i}", "en", f"s{i % 4}", 1) for i in range(90)]
    less = merkle.leaf(*[F.col(c) for c in FIELDS[:-1]], F.translate("text", "\n", ""))
    got = merkle.manifest(spark.createDataFrame(rows, DOCS), FIELDS, carry={"changed": less})
    got = got.select("doc_id", (merkle.fold(F.col("changed"), F.col("path"), F.col("shape")) == F.col("root")).alias("same")).collect()
    assert len(got) == 90 and all(r.same == (r.doc_id % 2 == 0) for r in got)
