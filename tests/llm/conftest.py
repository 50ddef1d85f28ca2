"""Small tables with every awkward case the operators define."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty, blank and long texts, ties, repeats, near copies."""
    rng = random.Random(7)
    long_text = words(rng, 60_000, 5_000)
    base = [words(rng, rng.choice([3, 12, 60, 200])) for _ in range(40)]
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None, "é"][i % 4], len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, base[i].upper(), "en", "a", None) for i in range(6)]  # copies but for case
    rows += [(120 + i, base[i + 20] + " tail", "en", "b", 1) for i in range(6)]
    rows += [(200, None, "en", "a", 0), (201, "", "en", "a", 0), (202, " \n\t ", None, None, 0), (203, "one", "fr", "a", 3),
             (204, "one two", "fr", "a", 7), (205, long_text, "en", "b", 0), (206, long_text + " end", "en", "b", 0),
             (None, base[0], "en", "a", 1), (None, "without an id", "en", None, 1), (207, "12345 !!", "en", "a", 8),
             (208, "x" * 50_000, "en", "a", 1), (209, "Été où – ñandú 日本語 straße", "fr", "é", 1)]
    rows += [rows[0]] * 3 + [(300, None, None, None, None)] * 2
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same documents with more columns, named like the operators' own."""
    from pyspark.sql import functions as F
    names = ["n", "key", "size", "seed", "words", "at", "route", "c", "label", "bytes", "prefix", "depth", "place", "score",
             "lang_pred", "target", "text_key", "component_id", "item_id", "copies", "d1", "bits"]
    return odd.select("*", *[F.lit(f"mine {x}").alias(x) for x in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
