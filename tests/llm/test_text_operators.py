"""Packing, language ID, decontamination, licenses: brute force, round trips, edge cases."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS, rows_of, words
from tidemark.llm import bytewords as B
from tidemark.llm import decontam, langid, license_rules, licenses, packing


# ---- words of columns -----------------------------------------------------
@pytest.mark.parametrize("size", [40, 1 << 20])
def test_text_words_equal_a_regular_expression(monkeypatch, size):
    whole = B.pieces
    monkeypatch.setattr(B, "pieces", lambda c, g: whole(c, g, size))
    rng = random.Random(1)
    for _ in range(60):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice("ab \n\tcdÉ .'") for _ in range(rng.choice([0, 1, 20, 200])))
                 for _ in range(rng.randrange(9))]
        got, known = [], {}
        for first, last, counts, h in B.text_words(pa.array(texts, pa.string()), B.SPACES):
            got += [x.tolist() for x in np.split(h, np.cumsum(counts)[:-1])]
            assert len(counts) == last - first
        for text, hashes in zip(texts, got, strict=True):
            mine = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
            assert [known.setdefault(w, h) for w, h in zip(mine, hashes, strict=True)] == hashes


# ---- packing --------------------------------------------------------------
def test_packing_is_a_round_trip(odd, odd_rows, clashing):
    enc = packing.encoder(packing.VOCABULARY)
    for df in (odd, clashing):
        packed = packing.pack(df, context=256, window=2_000).cache()
        got = {}
        for doc, offset, n, ids in sorted(packing.unpack(packed).collect(), key=lambda r: (str(r[0]), r[1])):
            got.setdefault((doc, offset), []).append(np.frombuffer(ids, "<u2").tolist())
            assert n == len(got[doc, offset][-1]) <= 256
        want = {}
        for r in odd_rows:
            ids = enc.bpe.encode_ordinary(r[1] or "")
            for o in range(0, len(ids), 256):
                want.setdefault((r[0], o), []).append(ids[o:o + 256])
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
        for r in packed.collect():
            assert len(r.input_ids) == 512 and r.cu_seqlens[-1] == r.n_tokens <= 256 and len(r.doc_ids) == r.n_segments
            pos = packing.positions(r.cu_seqlens)
            assert all(pos[a] == 0 for a in r.cu_seqlens[:-1]) and len(pos) == r.n_tokens


def test_packing_of_an_empty_table(empty):
    assert packing.pack(empty).collect() == []


def test_encoder_equals_the_tokenizer_at_odd_spaces():
    enc = packing.Encoder(packing.VOCABULARY)
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", " ", " ", "\n", "'s", "É", "\xa0", " the", "12", "　", "."]) for _ in range(60)) for _ in range(200)]
    got = {}
    for row, ids in enc.encode(pa.array(texts)):
        got.setdefault(row, []).extend(ids.tolist())
    assert [got.get(i, []) for i in range(200)] == [enc.bpe.encode_ordinary(t) for t in texts]


def test_best_fit_decreasing_by_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(30):
        lengths = rng.integers(1, 65, 50)
        free, want = [], []
        for i in np.argsort(-lengths, kind="stable"):
            fits = [f for f in free if f >= lengths[i]]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - lengths[i])
            else:
                free.append(64 - lengths[i])
        rows = packing.best_fit_decreasing(lengths, 64)
        assert sorted(64 - lengths[r].sum() for r in rows) == sorted(free)
        assert sorted(i for r in rows for i in r) == list(range(50))


# ---- language -------------------------------------------------------------
def labelled(spark):
    rng = random.Random(3)
    word = {"xx": ["der", "und", "nicht", "schule", "haus"], "yy": ["the", "and", "house", "school", "not"]}
    rows = [(i, " ".join(rng.choice(word[x]) for _ in range(12)), x, "s", 0) for i in range(80) for x in [["xx", "yy"][i % 2]]]
    return spark.createDataFrame(rows, DOCS)


def test_language_of_held_out_texts(spark, clashing, odd_rows):
    docs = labelled(spark)
    model = langid.fit(docs.where("doc_id < 60"))
    got = langid.predict(docs.where("doc_id >= 60"), model).select("lang", "__language.*").collect()
    assert all(r.lang == r.lang_pred and 0.5 < r.score <= 1 for r in got) and len(got) == 20
    odd = langid.predict(clashing, model).select("doc_id", "text", "__language.*").collect()
    assert len(odd) == len(odd_rows)
    for r in odd:
        has_letter = any(c.isalpha() for c in r[1] or "")
        assert (r[2] == "und") == (not has_letter) and 0 <= r[3] <= 1


def test_nothing_to_learn_from(empty, odd):
    model = langid.fit(empty)
    assert {tuple(r) for r in langid.predict(odd, model).select("__language.*").collect()} == {("und", 0.0)}
    assert langid.predict(empty, langid.fit(odd)).collect() == []


def test_forward_sums_all_segmentations():
    vocab, hashed = langid.pieces_of(langid.VOCABULARY), langid.vocabulary_of(langid.VOCABULARY)
    rng = np.random.default_rng(1)
    prob = rng.random(len(vocab) + 1)

    def brute(s):
        if not s:
            return 1.0
        return sum(prob[vocab.get(s[:k], len(vocab))] * brute(s[k:]) for k in range(1, len(s) + 1) if k == 1 or s[:k] in vocab)

    some = ["the", "éléphant", "日本", "zzq", "x"]
    got = langid.Lattice(some, hashed).log_probs(prob[:, None])[:, 0]
    assert np.allclose(got, [np.log(brute(" " + w)) for w in some])


# ---- decontamination ------------------------------------------------------
def brute_overlaps(docs, items, window=13, percent=80):
    cut = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if w]
    out = set()
    for d, text in docs:
        w = cut(text)
        for i, item in items:
            v = cut(item)
            length = min(window, len(v))
            for shift in range(-len(v) + 1, len(w)):
                pairs = [(v[x] == w[x + shift]) for x in range(max(0, -shift), min(len(v), len(w) - shift))]
                if len(v) >= 8 and any(100 * sum(pairs[x:x + length]) >= percent * length for x in range(len(pairs) - length + 1)):
                    out.add((d, i))
    return out


def test_overlaps_with_replaced_words(spark, clashing):
    rng = random.Random(9)
    items = [(i, words(rng, rng.choice([9, 15, 40]), 10_000)) for i in range(8)] + [(90, "too short"), (91, None), (92, "")]
    rows = []
    for d in range(60):
        body = words(rng, 30, 10_000).split()
        _, item = items[d % 8]
        part = item.split()
        for _ in range(d % 4):  # up to three words replaced
            part[rng.randrange(len(part))] = "zzz"
        rows.append((d, " ".join(body[:10] + (part if d % 3 else []) + body[10:]).upper(), None, None, None))
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(spark.createDataFrame(rows, DOCS), bench).collect()}
    want = brute_overlaps([r[:2] for r in rows], items)
    assert got <= want and len(got) >= 0.9 * len(want) and all((d, d % 8) in got for d in range(60) if d % 3 and d % 4 < 2)
    assert decontam.overlaps(clashing, bench).collect() == []


def test_every_allowed_substitution_has_a_seed(spark):
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(8, 15)]
    rows = []
    for n, item in items:
        for gone in itertools.combinations(range(n), n // 5):
            part = ["zzz" if k in gone else w for k, w in enumerate(item.split())]
            rows.append((len(rows), " ".join(["before"] * 3 + part + ["after"] * 3), None, None, None))
    rows += [(len(rows) + k, items[-1][1].split(" ", 1)[1].replace("x5", "y").replace(w, "y"), None, None, None)
             for k, w in enumerate(["x8", "x9"])]  # the document begins within the item
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(spark.createDataFrame(rows, DOCS), bench).collect()}
    assert got == brute_overlaps([r[:2] for r in rows], items) and len(got) == len(rows)


def test_decontaminate_keeps_clean_rows_and_columns(spark, clashing, odd_rows, empty):
    long_text = next(r[1] for r in odd_rows if r[0] == 205)
    bench = spark.createDataFrame([(1, " ".join(long_text.split()[500:530])), (None, odd_rows[0][1])], "item_id long, text string")
    kept = decontam.decontaminate(clashing, bench)
    assert kept.columns == clashing.columns
    bad = {d for d, _ in brute_overlaps([r[:2] for r in odd_rows if r[1] and len(r[1]) < 5000], bench.collect())} | {205, 206}
    whole = [r[0] for r in odd_rows if r[0] is not None and r[0] not in bad]
    assert sorted(r[0] for r in kept.select("doc_id").collect() if r[0] is not None) == sorted(whole)
    assert decontam.decontaminate(empty, bench).collect() == []
    assert decontam.decontaminate(clashing, bench.limit(0)).count() == clashing.count()


def test_large_benchmarks_take_several_passes(spark, odd, monkeypatch):
    bench = odd.where("length(text) between 40 and 2000 and doc_id < 100").selectExpr("doc_id AS item_id", "text")
    one = rows_of(decontam.overlaps(odd, bench))
    monkeypatch.setattr(decontam, "SEEDS_PER_PASS", 3_000)
    assert rows_of(decontam.overlaps(odd, bench)) == one and one


# ---- licenses -------------------------------------------------------------
def test_base_scan_by_brute_force(spark, odd_rows, clashing):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    texts = ["Licensed under the MIT License. Again: under the\nMIT license", "Apache License, Version 2.0; CC-BY-NC 4.0 cc by nc",
             "underthe mit license", "éunder the mit license", None, "", "GNU General Public License, version 3", "cc by nc cc by nc"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, texts[0], None, None, None)]
    for df, source in ((spark.createDataFrame(rows, DOCS), rows), (clashing, odd_rows)):
        got = rows_of(licenses.scan(df).select("doc_id", "n_words", "places"))
        want = []
        for r in source:
            w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r[1] or "").encode().lower())
            places = sorted((i, i + p.count(" "), label) for p, label in phrases.items() for i in range(len(w))
                            if [x.decode() for x in w[i:i + p.count(" ") + 1]] == p.split())
            want.append((r[0], len(w), places))
        assert sorted((repr(a), b, [tuple(x) for x in c]) for a, b, c in got) == sorted((repr(a), b, c) for a, b, c in want)


def test_suppression_and_labels():
    labels = lambda t: [x[2] for x in licenses.detect(t)]
    assert labels(b"licensed under cc by nc 4 0 here") == ["cc-by-nc-4.0"]
    assert labels(b"apache license version 2 0 or the mit license") == ["apache-2.0", "mit"]
    assert labels(b"gnu lesser general public license version 2 1") == ["lgpl-2.1"]
    assert labels(b"spdx license identifier gpl 2 0") == ["spdx-gpl-2.0"]
    assert labels(b"the weather was fine") == []


def test_gates_let_every_rule_through():
    by, gates = licenses.compiled()
    for keyword, own in by.items():
        for _, _, pattern in own:
            assert any(g in pattern.pattern or g in keyword for g in gates)


def examples(pattern):
    """Texts a pattern matches, with and without every optional part, for every choice."""
    def seq(items):
        return ["".join(x) for x in itertools.product(*[one(*i) for i in items])]

    def one(op, arg):
        op = str(op)
        if op == "LITERAL":
            return [chr(arg)]
        if op == "IN":
            return [chr(v) if str(k) == "LITERAL" else {"CATEGORY_WORD": "k", "CATEGORY_DIGIT": "3"}[str(v)] for k, v in arg]
        if op == "ANY":
            return ["x"]
        if op == "ASSERT_NOT":
            return [""]
        if op == "SUBPATTERN":
            return seq(arg[3])
        if op == "BRANCH":
            return [x for b in arg[1] for x in seq(b)]
        assert op in ("MAX_REPEAT", "MIN_REPEAT"), op
        least, most, inner = arg
        return [x for n in {least, min(most, max(least, 1))} for x in (seq(list(inner) * n) if n else [""])]

    got = seq(re._parser.parse(pattern))
    # what the license scan asks for around a match
    return [x for x in got if re.search(rf"(?<!\S)(?:{pattern})(?!\S)", x)]


def test_the_gate_passes_examples_of_every_rule():
    for _, label, _, pattern in licenses.rules():
        own = examples(pattern)
        assert own
        for x in own:
            assert licenses.passes(x.encode()) and licenses.passes(("(" + x.replace(" ", "-") + ").").encode()), (label, x)
    assert all(licenses.passes(p.encode()) for p, _ in licenses.BASE)
    assert not licenses.passes(b"the weather was fine, said the subcc and ungplayed")


def test_every_pattern_holds_its_keyword():
    for _, label, keyword, pattern in licenses.rules():
        assert any(keyword in x for x in license_rules.mandatory(pattern)), (label, keyword, pattern)
        for x in examples(pattern):
            assert keyword in x and licenses.detect(x.encode()), (label, keyword, x)


def test_a_notice_is_labelled_whatever_stands_elsewhere():
    labels = lambda t: [x[2] for x in licenses.detect(t)]
    for text, label in ((b"creative commons attribution noncommercial noderivs 4 0", "cc-by-nc-nd-4.0"),
                        (b"the creativeml open rail m", "openrail"), (b"psf license", "python-2.0"),
                        (b"internet systems consortium license", "isc")):
        assert licenses.passes(text) and label in labels(text)
        assert labels(text + b" access openrailing python isc") == labels(text)


def test_texts_of_one_license_name_are_labelled(spark):
    want = {"Released under the AGPLv3.": "agpl-3", "This library is LGPL 2.1": "lgpl-2.1", "lgplv3": "lgpl-3", "AGPL": "agpl",
            "CeCILL 2.1": "cecill-2.1", "CeCILL-B": "cecill-b", "MIT No Attribution": "mit-0", "GPLv2 or later": "gpl-2", "fine": None}
    rows = [(i, t, None, None, None) for i, t in enumerate(want)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert {t: next((d.label for d in got[i].detections), None) for i, t in enumerate(want)} == want
    assert all((got[i].confidence > 0) == (v is not None) for i, v in enumerate(want.values()))


def test_licenses_of_an_empty_table(empty):
    assert licenses.scan(empty).collect() == []


def test_columns_of_other_names(odd):
    assert licenses.scan(odd.select(F.col("text").alias("t"), F.col("doc_id").alias("i")), "i", "t").count() == odd.count()


def test_long_repetitive_texts_are_scanned_in_linear_time():
    import time
    unit = b"licensed under the mit license version 2 apache license version 2 0 cc by nc 4 0 "
    took = {}
    for n in (2_000, 25_000):  # the longer one has 2 MB
        words = (unit * n).strip()
        start = time.time()
        base, found = licenses.find_base(b" " + words + b" "), licenses.detect(words)
        took[n] = time.time() - start
        assert len(base) >= 2 * n and len(found) >= n and base[-1][0] > 14 * (n - 1)
    assert took[25_000] < 60 * max(took[2_000], 0.05)


def test_suppression_equals_all_pairs():
    rng = random.Random(12)
    for _ in range(200):
        n = rng.randrange(1, 40)
        found = [(s := rng.randrange(60), s + rng.randrange(1, 20), rng.randrange(5)) for _ in range(n)]
        # one rule's matches do not overlap
        found = [x for i, x in enumerate(found) if not any(y[2] == x[2] and y[0] < x[1] and x[0] < y[1] for y in found[:i])]
        got = licenses.outside_higher(*(np.array(x) for x in zip(*found)))
        want = [i for i, x in enumerate(found) if not any(y[2] > x[2] and y[0] <= x[0] and x[1] <= y[1] for y in found)]
        assert sorted(got.tolist()) == want


def test_position_resets_are_written(spark, odd):
    for r in packing.pack(odd, context=64).collect():
        at, pos = r.cu_seqlens, np.frombuffer(r.position_ids, "<u2")
        assert len(pos) == 64 and not pos[at[-1]:].any()
        assert all((pos[x:y] == np.arange(y - x)).all() for x, y in zip(at, at[1:]))
