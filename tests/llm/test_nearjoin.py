import random
import re

import numpy as np
import pytest

from tests.llm.conftest import rows_of, words
from tidemark.llm import nearjoin
from tidemark.llm.components import components


def shingles(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def brute(rows, k, percent):
    """(doc_id, n, component_id) of every row by all pairs and a search."""
    sets = [shingles(r[1], k) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(s), least.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))), key=repr)


def result(df, **how):
    return rows_of(nearjoin.near_components(df, **how).select("doc_id", "n_shingles", "component_id"))


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_odd_rows_equal_brute_force(odd, odd_rows, k, percent):
    assert result(odd, k=k, percent=percent) == brute(odd_rows, k, percent)


def test_more_columns_change_nothing(clashing, odd_rows):
    assert result(clashing, k=4, percent=85) == brute(odd_rows, 4, 85)


def test_empty_table(empty):
    assert result(empty) == []


def near_rows(seed):
    """Chains and groups of edited copies around the threshold, sharing a passage."""
    rng = random.Random(seed)
    passage = words(rng, 40)
    rows = []
    for g in range(12):
        text = (words(rng, rng.choice([20, 60, 150])) + " " + passage).split()
        for _ in range(rng.choice([1, 2, 25])):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                text = copy  # a chain: the next copy starts from here
            rows.append((len(rows), " ".join(copy), None, None, None))
    return rows


@pytest.mark.parametrize("contract", [0, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_with_and_without_contraction(spark, seed, contract):
    from tests.llm.conftest import DOCS
    rows = near_rows(seed)
    assert result(spark.createDataFrame(rows, DOCS), k=4, percent=85, contract=contract) == brute(rows, 4, 85)


def test_blocks_of_a_large_route_meet(spark, monkeypatch):
    from tests.llm.conftest import DOCS
    monkeypatch.setattr(nearjoin, "BLOCK", 4)
    rows = near_rows(3)
    assert result(spark.createDataFrame(rows, DOCS), k=4, percent=85, contract=0) == brute(rows, 4, 85)


def test_dual_traversal_loses_no_pair():
    rng = np.random.default_rng(5)
    universe = rng.integers(1, 2**63, 400).astype(np.uint64)
    sets = []
    for _ in range(150):
        if sets and rng.random() < 0.6:
            s = sets[rng.integers(len(sets))].copy()
            s[rng.integers(len(s), size=max(1, len(s) // 12))] = rng.integers(1, 2**63, max(1, len(s) // 12)).astype(np.uint64)
            sets.append(np.unique(s))
        else:
            sets.append(np.unique(rng.choice(universe, rng.integers(3, 90))))
    n = np.array([len(s) for s in sets])
    c = np.arange(len(sets))
    got = set()
    for a, b in nearjoin.route_pairs(n, c, c.copy(), [nearjoin.bitmap(s) for s in sets], np.full(len(c), 2), 85):
        got |= {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    want = set()
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (n[i] + n[j] - both):
                want.add((j, i))
    assert want and want <= got
    assert len(got) < len(sets) ** 2 / 8  # and most pairs were pruned


def test_streams_do_not_depend_on_batches():
    rng = np.random.default_rng(2)
    rows = np.stack([rng.integers(0, 30, 400), rng.integers(5, 60, 400), rng.integers(0, 80, 400), np.zeros(400, int)], 1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    whole, held = nearjoin.meeting(rows, 85)
    out, held = [], rows[:0]
    for k in range(0, 400, 7):
        part, held = nearjoin.meeting(np.concatenate([held, rows[k:k + 7]]), 85)
        out += part.tolist()
    assert sorted(map(tuple, out)) == sorted(map(tuple, whole.tolist()))


def test_components_of_chains_stars_and_negative_ids(spark):
    rng = random.Random(4)
    edges = [(-i, -i - 1) for i in range(1, 60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(5, 5)]
    rng.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[-i] == -60 for i in range(1, 61)) and all(got[1000 + i] == 1000 for i in range(40)) and 5 not in got
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each(odd_rows, clashing):
    kept = nearjoin.one_of_each(clashing, k=5, percent=80)
    assert kept.columns == clashing.columns
    rows = rows_of(kept.select("doc_id", "text"))
    want = brute(odd_rows, 5, 80)
    named = {c for _, n, c in want if n and c is not None}
    empties = sum(1 for _, n, _ in want if not n)
    nameless = sum(1 for i, n, c in want if n and c is None)
    assert sorted(r[0] for r in rows if shingles(r[1], 5) and r[0] is not None) == sorted(named)
    assert len(rows) == len(named) + empties + nameless


# ---- which path gives what -------------------------------------------------
def test_forests_equal_plain_pairs():
    """Pairs of whole routes by trees: every pair that links, none across routes."""
    rng = np.random.default_rng(5)
    sets = [rng.choice(4000, int(rng.integers(3, 400)), replace=False).astype(np.uint64) for _ in range(60)]
    sets += [np.append(s[: max(1, len(s) - 2)], np.uint64(5000 + i)) for i, s in enumerate(sets)] + sets[:5]
    sets = [nearjoin.B.mix(s) for s in sets]
    n, c = np.array([len(s) for s in sets]), np.arange(len(sets))
    route = rng.integers(0, 9, len(sets))
    route[60:120] = route[:60]
    label = np.where(c >= 120, c - 120, c)  # the last ones are in the component of the first
    got = set()
    for a, b in nearjoin.small_routes(route, n, c, label, [nearjoin.bitmap(s) for s in sets], 80):
        pairs = list(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist()))
        assert len(pairs) == len(set(pairs)) and all(route[i] == route[j] and label[i] != label[j] for i, j in pairs)
        got |= set(pairs)
    links = {(i, j) for j in range(len(sets)) for i in range(j) if route[i] == route[j] and label[i] != label[j]
             and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert links and links <= got and len(got) < 3 * len(links) + 20


def test_forest_nodes_hold_their_leaves():
    rng = np.random.default_rng(6)
    n, route, label = rng.integers(1, 50, 30), np.sort(rng.integers(0, 6, 30)), rng.integers(0, 9, 30)
    bits = rng.integers(0, 1 << 62, (30, 2)).astype(np.uint64)
    f = nearjoin.Forest(route, n, label, bits)
    for k in range(len(f.route)):
        leaves = slice(f.at[k], f.at[k + 1])
        assert 1 <= f.at[k + 1] - f.at[k] <= nearjoin.FANOUT and (route[f.order[leaves]] == f.route[k]).all()
        assert (np.bitwise_or.reduce(f.leaves[0][leaves], 0) == f.nodes[0][k]).all()
        assert f.nodes[1][k] == f.leaves[1][leaves].min() and f.nodes[2][k] == f.leaves[2][leaves].max()


@pytest.mark.parametrize("contract", [0, 3])
def test_one_large_near_group_needs_linear_pairs(spark, monkeypatch, contract):
    """A group of near copies that all link: with contraction the verified pairs grow
    with the group, and its component is one either way."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    rows = [(i, " ".join([*base[:190], *(f"own{i}x{j}" for j in range(10))]), "en", "a", 1) for i in range(400)]
    rows += [(1000 + i, words(rng, 60, 3000), "en", "a", 1) for i in range(60)]
    seen = []
    plain = nearjoin.verified
    monkeypatch.setattr(nearjoin, "verified", lambda pairs, sets, percent: seen.append(pairs.count()) or plain(pairs, sets, percent))
    got = nearjoin.near_components(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5),
                                   k=4, percent=85, contract=contract).collect()
    assert {r.component_id for r in got if r.doc_id < 1000} == {0} and sum(r.component_id == r.doc_id for r in got) == 61
    if contract:
        assert sum(seen) <= 10 * 400
