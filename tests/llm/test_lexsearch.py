"""Ranked lexical search against brute force: ties, nulls, long texts, empty sides, sketches as bounds."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from tests.llm.conftest import DOCS, words
from tidemark.llm import lexsearch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UP))


def brute(docs, items, k):
    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total = len(docs), sum(x for *_, x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c, size in docs:
            m = 25 + 75 * size * n // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, r in Counter(terms(text)).items() if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(docs, items, k=10):
    return sorted(map(tuple, lexsearch.search(docs, items, k).collect()), key=repr)


ITEMS = "item_id long, text string, doc_id string, score string"


def test_search_equals_brute_force(spark, odd_rows, odd, clashing, empty):
    rng = random.Random(3)
    items = [(i, words(rng, 12), "mine", "mine") for i in range(8)]
    items += [(20, None, "a", "a"), (21, " ,; ", "a", "a"), (22, "W7 w7 w7 w8, w9 été", "a", "a"), (23, "nowhere", "a", "a"),
              (24, words(rng, 5000, 5000), "a", "a"), (None, "w1 w2", "a", "a"), (25, "w3", "a", "a"), (25, "w4", "a", "a")] + [(0, *items[0][1:])]
    table = spark.createDataFrame(items, ITEMS)
    want = brute([r[:2] for r in odd_rows], [r[:2] for r in items if r[1] is not None], 10)
    assert found(odd, table) == found(clashing, table) == want
    assert found(empty, table) == found(odd, table.where("false")) == []
    assert found(odd.where("doc_id in (200, 201, 202)"), table) == []  # no terms at all


def test_ties_take_the_smaller_id_in_any_order(spark):
    rows = [(i, f"same words {i % 3}", "en", "a", 1) for i in range(300, 0, -1)]
    items = spark.createDataFrame([(1, "same 0"), (2, "same words")], "item_id long, text string")
    assert found(spark.createDataFrame(rows, DOCS).repartition(6), items, 4) == brute([r[:2] for r in rows], [(1, "same 0"), (2, "same words")], 4)


def test_blocks_of_queries_agree(spark, odd_rows, odd, monkeypatch):
    rng = random.Random(5)
    items = [(i, words(rng, 6)) for i in range(7)]
    monkeypatch.setattr(lexsearch, "BLOCK_ITEMS", 2)
    assert found(odd, spark.createDataFrame(items, "item_id long, text string"), 3) == brute([r[:2] for r in odd_rows], items, 3)


def indexed(texts):
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.large_string())], names=["id", "text"])
    return pa.Table.from_batches(lexsearch.index_batches(iter([batch]))).combine_chunks().to_batches()[0]


def test_sketches_bound_and_spare_exact_scores(monkeypatch):
    rng = random.Random(11)
    texts = [words(rng, rng.choice([5, 80, 300]), 3000) for _ in range(2000)] + ["w1 " * 400 + "w2"]
    batch = indexed(texts)
    for row in batch.to_pylist()[-3:]:  # every term's occurrences are in its coordinate
        t, c = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["counts"], np.uint32)
        top = dict(zip(np.frombuffer(row["coords"], np.uint16), np.frombuffer(row["tops"], np.uint8)))
        assert all(top[x % lexsearch.WIDTH] >= min(n, 255) for x, n in zip(t.tolist(), c.tolist()))
    queries = [words(rng, 8, 3000) for _ in range(10)]
    parts = [next(lexsearch.postings(pa.array([q], pa.large_string())))[2] for q in queries]
    b = lexsearch.block(list(range(10)), [(p.terms, p.counts) for p in parts])
    docs, total = len(texts), sum(len(terms(t)) for t in texts)
    df = Counter(x for t in np.split(*(lambda v, e: (v, e[1:-1]))(*lexsearch.glued(batch.column("terms"), np.uint64))) for x in t.tolist())
    b = b._replace(weights=b.weights * np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df[x] + 1))) for x in b.terms.tolist()]))
    run = lexsearch.Search(b, 10, docs, total)
    run.add(batch)
    got = run.found().to_pylist()
    assert sorted((r["query"], r["doc_id"], r["score"]) for r in got) == sorted(
        (q, i, s) for q, _, i, s in brute(list(enumerate(texts)), list(enumerate(queries)), 10))
    assert run.rescored < len(texts) * 10 / 5  # most documents are left out by their bounds


def test_long_texts_are_one_document():
    text = " ".join(f"w{i % 977}" for i in range(200_000))
    row = indexed([text, "", None]).to_pylist()
    assert row[0]["n"] == 200_000 and len(row[0]["terms"]) == 977 * 8 and [r["n"] for r in row[1:]] == [0, 0]
    assert defaultdict(int, zip(*np.unique(np.frombuffer(row[0]["counts"], np.uint32), return_counts=True))) == Counter(
        Counter(terms(text)).values())
