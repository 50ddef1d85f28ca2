"""Exact dedup against brute force: hot texts, ties, nulls, empty tables, clashing columns."""

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from tests.llm.conftest import DOCS, rows_of
from tidemark.llm import exactdedup


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for t, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        ids.sort(key=lambda i: (i is None, -(i or 0)))
        out += [(i, best, len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def decided(df, **kw):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex())
                   for r in exactdedup.decide(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("counters", [3, 4096])
def test_every_row_is_decided(spark, odd_rows, odd, clashing, empty, counters):
    assert decided(odd, counters=counters) == decided(clashing, counters=counters) == brute(odd_rows)
    assert decided(empty, counters=counters) == []


def test_hot_texts_go_before_the_shuffle(spark):
    rows = [(i, "hot" if i % 3 == 0 else "warm" if i % 7 == 0 else f"text {i // 2}", "en", "a", i) for i in range(4000)]
    rows += [(None, "hot", "en", "a", 1)] * 50 + [(3999, "hot", "en", "a", 1)] * 5
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    assert decided(df, counters=20) == brute(rows)
    keyed = exactdedup.keys(df)
    heavy = exactdedup.winners(keyed, exactdedup.frequent(keyed, 20))
    assert {(r.keep_id, r.group_size) for r in heavy.collect()} >= {(3999, sum(r[1] == "hot" for r in rows))} and heavy.count() <= 20
    kept = exactdedup.deduplicate(df, counters=20).collect()
    want = [(i, t) for i, _, _, keep, t in brute(rows) if keep]
    assert sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in kept) == sorted(want)


def test_kept_rows_have_their_columns(spark, odd_rows, clashing, empty):
    kept = exactdedup.deduplicate(clashing)
    assert kept.columns == clashing.columns
    assert Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept.collect()) == Counter(
        (i, t) for i, _, _, keep, t in brute(odd_rows) if keep)
    assert rows_of(exactdedup.deduplicate(empty)) == []


def test_counters_keep_the_frequent():
    stream = [b"a"] * 500 + [b"b"] * 300 + [str(i).encode() for i in range(700)]
    stream = stream[::3] + stream[1::3] + stream[2::3]
    batches = [pa.record_batch({"digest": pa.array(stream[i: i + 64], pa.binary())}) for i in range(0, len(stream), 64)]
    true = Counter(stream)
    for k in (4, 9, 40):
        got = {x["digest"]: x["n"] for b in exactdedup.summarise(iter(batches), k) for x in b.to_pylist()}
        assert len(got) <= k and all(n <= true[d] for d, n in got.items())
        assert all(true[d] - got.get(d, 0) <= len(stream) / (k + 1) for d in true)
    assert list(exactdedup.summarise(iter([]), 4)) == []
