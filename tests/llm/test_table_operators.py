"""Chat, line dedup, search, sharding, mixing: SQL oracles on the test tables and edge cases."""

import math
import os
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.llm.conftest import DOCS, rows_of
from tidemark.llm import chat, linededup, maxscore, mixing, queries, sharding

ORACLES = sorted(queries.SQL)


def plain(rows):
    return sorted([tuple(None if isinstance(x, float) and math.isnan(x) else x for x in r) for r in rows], key=repr)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SMALL)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.SQL[name]})").fetchall()
    assert plain(map(tuple, df.collect())) == plain(want) and (want or os.path.getsize(f"{SMALL}/benchmark.parquet") < 10_000)


# ---- chat -----------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string, place string, h1 string"


def brute_chats(rows):
    convs = defaultdict(set)
    for c, turn, role, text, *_ in rows:
        convs[c].add((turn, role, text))
    low = lambda x: (x is not None, x or 0)
    word = lambda x: (x is not None, x or "")
    seqs = {c: [(r, t) for _, r, t in sorted(s, key=lambda y: (low(y[0]), word(y[1]), word(y[2])))] for c, s in convs.items()}
    out = []
    for c, s in seqs.items():
        same = [d for d, o in seqs.items() if o == s]
        first = min((d for d in same if d is not None), default=None)
        if c == first and not any(len(o) > len(s) and o[:len(s)] == s for o in seqs.values()):
            out.append((c, len(s), len(same), "".join(f"<|im_start|>{r if r is not None else 'unknown'}\n{t or ''}<|im_end|>\n" for r, t in s)))
    return sorted(out, key=repr)


def test_chats_by_brute_force(spark):
    turns = lambda c, *ts: [(c, i, "user" if i % 2 == 0 else "assistant", t, "mine", "mine") for i, t in enumerate(ts)]
    rows = turns(1, "a", "b") + turns(2, "a", "b", "c") + turns(3, "a", "b", "c") + turns(4, "a") + turns(5, "z") + turns(6, *"abx")
    rows += turns(7, *[f"t{i}" for i in range(150)]) + turns(8, *[f"t{i}" for i in range(100)]) + turns(9, *[f"t{i}" for i in range(70)], "other")
    rows += [(10, None, None, None, None, None), (10, 0, "user", "", None, None), (None, 0, "user", "null id", None, None),
             (11, 5, "user", "gap", None, None), (11, 900, None, "far", None, None), (11, -3, "system", "before", None, None)]
    rows += rows[:4] * 2  # repeats count once
    got = defaultdict(list)
    for r in chat.format_chats(spark.createDataFrame(rows, TURNS).repartition(4)).collect():
        got[r.conv_id, r.n_turns, r.copies].append((r.part, r.text))
    assert sorted(((*k, "".join(t for _, t in sorted(v))) for k, v in got.items()), key=repr) == brute_chats(rows)
    assert max(len(v) for v in got.values()) == 3
    assert chat.format_chats(spark.createDataFrame([], TURNS)).collect() == []


# ---- lines ----------------------------------------------------------------
def test_boilerplate_is_relative_to_the_site(spark):
    page = lambda i, host, *lines: (i, f"https://{host}/{i}", "<p>" + "</p><p>".join(lines) + "</p>", "mine", "mine")
    rows = [page(i, "www.A.example:80", "Menu", f"text {i}", "Menu") for i in range(10)]
    rows += [page(20 + i, "b.example", f"other {i}") for i in range(30)] + [page(50, "b.example", "Menu")]
    rows += [(60, None, None, None, None), (61, "no scheme", "", None, None), (None, "https://b.example/x", "<p>null id</p>", None, None)] + rows[:2]
    got = {r.page_id: r for r in linededup.drop_boilerplate(
        spark.createDataFrame(rows, "page_id long, url string, html string, host string, hash string").repartition(3)).collect()}
    assert all((got[i].host, got[i].text, got[i].n_lines, got[i].n_dropped) == ("a.example", f"text {i}", 3, 2) for i in range(10))
    assert got[50].text == "Menu" and got[60].text == "" and got[61].host == "" and got[None].text == "null id" and len(got) == 44
    assert linededup.drop_boilerplate(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# ---- search ---------------------------------------------------------------
def brute_top(rows, k=5):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    ints = sorted((i, [math.floor(256 * x) for x in v], v) for i, v in ok)
    hold = lambda s: max(-2**63, min(2**63 - 1, s))
    out = []
    for i, q, _ in ints:
        if i % 50 == 0:
            s = sorted((-hold(sum(a * b for a, b in zip(q, v))), j) for j, v, _ in ints if j != i)[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [7, 8192])
def test_search_by_brute_force(spark, monkeypatch, shard):
    import random
    monkeypatch.setattr(maxscore, "SHARD_ROWS", shard)
    monkeypatch.setattr(maxscore, "QUERY_BLOCK", 2 if shard < 99 else 1024)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)]) for i in range(210)]
    rows += [(300 + i, list(rows[3][1])) for i in range(8)]  # ties
    rows += [(350, None), (351, [1.0, None]), (352, [float("nan")]), (353, [float("inf")]), (None, [1.0]), (400, []), (401, [0.5]), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'mine' AS row", "'mine' AS shard", "'mine' AS score")
    got = maxscore.top_k(df, queries.F.col("vec_id") % 50 == 0)
    assert rows_of(got) == brute_top(rows)


def test_search_beyond_floats_and_of_nothing(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [1e30, 1.0]), (1, [1.0, 2.0]), (2, [-1e30, 3.0]), (3, [2.0**40, 2.0**40])]
    assert rows_of(maxscore.top_k(spark.createDataFrame(rows, schema), queries.F.col("vec_id") % 50 == 0)) == brute_top(rows)
    assert maxscore.top_k(spark.createDataFrame([], schema), queries.F.col("vec_id") % 50 == 0).collect() == []
    assert maxscore.top_k(spark.createDataFrame(rows[1:3], schema), queries.F.col("vec_id") % 50 == 0).collect() == []


# ---- shards ---------------------------------------------------------------
def test_shards_fit_and_siblings_would_not(odd, odd_rows, clashing, empty):
    for df in (odd, clashing):
        rows = sharding.shard(df, 3_000).collect()
        assert sorted((repr(r.doc_id), r.bytes) for r in rows) == sorted((repr(r[0]), 64 + len((r[1] or "").encode())) for r in odd_rows)
        size, ids = defaultdict(int), defaultdict(set)
        for r in rows:
            size[r.shard] += r.bytes
            ids[r.shard].add(r.doc_id)
            assert len(r.shard) == r.depth and r.shard_bytes >= r.bytes
        assert all(b <= 3_000 or len(ids[s]) == 1 for s, b in size.items())
        assert not any(a != b and b.startswith(a) for a in size for b in size)  # no shard lies within another
        for s in size:  # a parent that would have fitted was not split
            parent = sum(b for x, b in size.items() if x.startswith(s[:-1]))
            assert not s or parent > 3_000
    assert sharding.shard(empty, 3_000).collect() == []


def test_rows_that_no_bit_can_split_come_in_parts(spark):
    df = spark.createDataFrame([(1, "x" * 936, None, None, None)] * 40, DOCS).repartition(4)
    rows = sharding.shard(df, 8_000).collect()
    assert len(rows) == 40 and {len(r.shard) for r in rows} == {60} and len({r.part for r in rows}) > 1


def test_parts_of_a_hot_key_keep_the_limit(spark, monkeypatch):
    import random
    monkeypatch.setattr(sharding, "BLOCK_BITS", 1)
    rng = random.Random(5)
    limit = 8_000
    sizes = {None: [rng.choice([0, 100, 936, 936, 1_500, 3_000, 5_000, 7_936]) for _ in range(400)] + [9_000, 20_000],
             1: [936] * 40, 2: [7_936] * 3, 3: [100] * 9 + [30_000], 4: [9_000], 5: [10] * 5}
    rows = [(i, "x" * n, None, None, None) for i, ns in sizes.items() for n in ns]
    rng.shuffle(rows)
    got = sharding.shard(spark.createDataFrame(rows, DOCS).repartition(5), limit).collect()
    assert sorted((repr(r.doc_id), r.bytes) for r in got) == sorted((repr(r[0]), len(r[1]) + 64) for r in rows)
    part = defaultdict(list)
    for r in got:
        part[r.doc_id, r.shard, r.part].append(r.bytes)
    assert all(sum(b) <= limit or len(b) == 1 for b in part.values())
    for i, ns in sizes.items():
        numbers = sorted(p for d, _, p in part if d == i)
        total = sum(ns) + 64 * len(ns)
        assert numbers == list(range(len(numbers))) and len(numbers) <= 2 * total / limit + sharding.SMALL + 1
    assert len([1 for d, _, _ in part if d == 1]) == 6  # 40 rows of 1000: by running bytes of 7000


# ---- mixing ---------------------------------------------------------------
def test_targets_reshare_the_excess(spark):
    sizes = {"a": 1000, "b": 10, "c": 400, "d": 0, None: 300}
    got = {r.source: r for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    target, left, live = {}, 1.5 * sum(sizes.values()), dict(weight)
    while True:
        share = {s: left * w / sum(live.values()) for s, w in live.items()}
        over = [s for s in live if share[s] > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            del live[s]
    target |= share
    assert {s: r.weight for s, r in got.items()} == weight
    assert all(abs(got[s].target - t) < 1e-6 for s, t in target.items())


def test_mix_meets_targets_and_agrees_with_itself(odd, odd_rows, clashing, empty):
    rows = rows_of(mixing.mix_plan(odd))
    assert rows == rows_of(mixing.mix_plan(clashing)) == rows_of(mixing.mix_plan(odd.repartition(1))) and len(rows) == len(odd_rows)
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for _, source, size, _, goal, _, words in rows:
        taken[source] += words
        target[source] = goal
        largest[source] = max(largest[source], size)
        assert words in (0, size, 2 * size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    kept = mixing.mix(clashing)
    assert kept.columns == clashing.columns
    count = defaultdict(int)
    for r in rows:
        count[repr(r[0]), repr(r[1]), r[2]] += r[5]
    assert kept.count() == sum(r[5] for r in rows)
    assert mixing.mix_plan(empty).collect() == [] and mixing.mix(empty).collect() == []


def test_turns_without_numbers_spread_over_tasks(spark):
    """A conversation whose turns all have the same number, or none, is cut by rows."""
    rows = [(1, None, "user", f"t{i:05d}", "m", "m") for i in range(1500)] + [(2, 7, "user", f"t{i:05d}", "m", "m") for i in range(1500)]
    rows += [(3, 7, "user", f"t{i:05d}", "m", "m") for i in range(700)] + [(None, None, None, f"n{i}", "m", "m") for i in range(600)]
    turns = spark.createDataFrame(rows, TURNS).repartition(6)
    got = defaultdict(list)
    for r in chat.format_chats(turns).collect():
        got[r.conv_id, r.n_turns, r.copies].append((r.part, r.text))
    assert sorted(((*k, "".join(t for _, t in sorted(v))) for k, v in got.items()), key=repr) == brute_chats(rows)
    placed = chat.placed_turns(turns.where("conv_id = 1"))
    assert sorted(r.place for r in placed.select("place").collect()) == list(range(1, 1501))
    assert spark.sparkContext.defaultParallelism and len({r.h1 for r in placed.select("h1").collect()}) == 1500
