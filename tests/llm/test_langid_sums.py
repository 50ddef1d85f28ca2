"""Sums over all segmentations of long words and of tiny probabilities; expected counts;
texts of no learned language."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm.conftest import DOCS
from tidemark.llm import langid


def vocab():
    return langid.pieces_of(langid.VOCABULARY), langid.vocabulary_of(langid.VOCABULARY)


def arcs(word, names, size):
    """(start, stop, piece) of every piece of " word"; single characters always."""
    s = " " + word
    return s, [(i, k, names.get(s[i:k], size)) for i in range(len(s)) for k in range(i + 1, len(s) + 1) if k == i + 1 or s[i:k] in names]


def plain_sum(word, names, log_prob):
    """log of the sum over all segmentations, one prefix after another."""
    s, edges = arcs(word, names, len(names))
    best = [0.0] + [-math.inf] * len(s)
    for k in range(1, len(s) + 1):
        into = [best[i] + log_prob[p] for i, stop, p in edges if stop == k]
        top = max(into)
        best[k] = top + math.log(sum(math.exp(x - top) for x in into))
    return best[-1]


LONG = ["internationalisation" * 10, "日本語の文章には空白がない" * 9, "a" * 31, "b" * 32, "é" * 40, "x"]


@pytest.mark.parametrize("scale", [1.0, 1e-9, 1e-40])
def test_long_words_and_tiny_probabilities(scale):
    names, hashed = vocab()
    prob = np.random.default_rng(2).random((len(names) + 1, 2)) * scale
    got = langid.log_probs(LONG, hashed, prob)
    want = [[plain_sum(w, names, np.log(prob[:, x]).tolist()) for x in range(2)] for w in LONG]
    assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-9)


@pytest.mark.parametrize("scale", [1.0, 1e-40])
def test_expected_counts_equal_plain_sums(scale):
    """The expected count of a piece is the slope of the log of the sum by the log of
    its probability."""
    names, hashed = vocab()
    prob = np.random.default_rng(3).random(len(names) + 1) * scale
    words, count = ["the", "international" * 4, "été", "日本語の"], np.array([3.0, 2.0, 1.0, 5.0])
    got = langid.expected(words, hashed, prob, count)
    log_prob = np.log(prob)
    used = sorted({p for w in words for *_, p in arcs(w, names, len(names))[1]})
    assert set(np.flatnonzero(got).tolist()) <= set(used)
    for p in random.Random(4).sample(used, 12):
        sums = []
        for d in (1e-5, -1e-5):
            moved = log_prob.copy()
            moved[p] += d
            sums.append(sum(n * plain_sum(w, names, moved.tolist()) for w, n in zip(words, count)))
        assert math.isclose(got[p], (sums[0] - sums[1]) / 2e-5, rel_tol=1e-4, abs_tol=1e-6)


def test_texts_of_no_learned_language_go(spark):
    rng = random.Random(6)
    word = {"xx": ["der", "und", "nicht", "schule", "haus", "garten"], "yy": ["the", "and", "house", "school", "not", "garden"]}
    rows = [(i, " ".join(rng.choice(word[x]) for _ in range(rng.choice([3, 30, 300]))), x, "s", 0) for i in range(120) for x in [["xx", "yy"][i % 2]]]
    rows += [(500, " ".join("".join(rng.choice("qxzjkvw") for _ in range(7)) for _ in range(40)), None, "s", 0),
             (501, "αλφα βητα γαμμα δελτα " * 10, None, "s", 0), (502, "qxz", None, "s", 0), (503, "12 34", None, "s", 0), (504, None, None, "s", 0)]
    kept = {r.doc_id for r in pipeline.language(spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert kept == {*range(120), 502}  # too short to tell stays, as do all clean texts


def test_clean_documents_stay(spark):
    from tests.conftest import SMALL
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labelled = docs.where("lang IS NOT NULL")
    assert pipeline.language(spark, docs, SMALL).where(F.col("lang").isNotNull()).count() == labelled.count()


def test_usual_scores_are_of_all_labelled_rows(spark):
    """More rows of a language than any sample: every one counts, those of no label or few bytes don't."""
    n = 12_000
    rows = spark.range(n + 2).select(
        F.when(F.col("id") < n, "en").alias("lang"),
        F.struct(F.lit("en").alias("lang_pred"), F.lit(1.0).alias("score"), (-F.col("id").cast("double")).alias("per_byte"),
                 F.when(F.col("id") == 0, 10).otherwise(100).cast("long").alias("word_bytes")).alias("__language"))
    values = -np.arange(1, n, dtype=float)
    got = langid.usual_scores(rows)
    assert got.keys() == {"en"} and math.isclose(got["en"], values.mean() - langid.FAR_BELOW * values.std(), rel_tol=1e-9)
