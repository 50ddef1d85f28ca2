"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities of the pieces of a fixed public vocabulary.
A text's score under a language sums over all segmentations of its words into
pieces: pieces don't cross words, so the sum factorises into one forward pass
per distinct word.  Piece probabilities are fitted by expectation: the expected
number of times each piece occurs over all segmentations of the training words,
weighted by how often each word occurs in each language.

Words of any length, those of scripts without spaces included, are summed whole; the
passes over long ones work with logarithms.  Fitting takes one expectation step from
even probabilities (``iterations``); the README has its held-out accuracy.

Learning gathers words, counted within tasks before they are shuffled; what
reaches the driver is one number per piece and language.

Defined results
---------------
* A word is a run of ASCII letters and non-ASCII characters, lower-cased; a
  character outside the vocabulary is a piece of its own with a floor probability.
* A null text, or one without a letter: ``und`` with score 0.
* With nothing to learn from (an empty table, no labels) every text is ``und``.
* Ties go to the language that sorts first.  The score is the posterior
  probability of the predicted language, given the document shares as prior.
* Other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytewords as B
from tidemark.llm.batches import small_batches
from tidemark.llm.workers import held, trim, trimmed
from tidemark.session import materialize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Added to every piece's expected count.
SMOOTHING = 0.05
MAX_CACHED = 200_000
#: How far below the usual score per byte, in standard deviations, a text is none of
#: the language's.
FAR_BELOW = 12.0
#: Shorter texts (bytes of words) vary too much to be told by their score per byte.
LEAST_BYTES = 64


def pieces_of(path: str) -> dict[str, int]:
    """Piece -> index; the word mark of the vocabulary becomes a leading space."""
    _memo = held("langid")
    if path not in _memo:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i).replace("▁", " ") for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        _memo[path] = {x: i for i, x in enumerate(dict.fromkeys(names))}
    return _memo[path]


class Vocabulary(NamedTuple):
    """Hashes of the pieces, ascending, their indexes, a filter on low bits, and the longest in bytes."""

    hashes: np.ndarray
    index: np.ndarray
    maybe: np.ndarray
    longest: int
    size: int

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and their indexes."""
        hit = np.flatnonzero(self.maybe[(h & np.uint64(len(self.maybe) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, h[hit]), len(self.hashes) - 1)
        ok = self.hashes[at] == h[hit]
        return hit[ok], self.index[at[ok]]


def vocabulary_of(path: str) -> Vocabulary:
    _memo = held("langid")
    if (path, "hashed") not in _memo:
        raw = [x.encode("utf-8") for x in pieces_of(path)]
        ends = np.cumsum([len(x) for x in raw])
        starts = ends - np.array([len(x) for x in raw])
        h = B.span_hashes(np.frombuffer(b"".join(raw), np.uint8), starts, ends)
        order = np.argsort(h)
        maybe = np.zeros(1 << 20, bool)
        maybe[(h & np.uint64(len(maybe) - 1)).astype(np.int64)] = True
        _memo[path, "hashed"] = Vocabulary(h[order], order, maybe, max(map(len, raw)), len(raw))
    return _memo[path, "hashed"]


class Lattice:
    """All pieces at all places of many words at once, each word with its leading space.

    Pieces are ordered by their end within the word, so a forward pass is one step
    per byte over all words.  A character that is no piece is one outside the
    vocabulary (the index after the last).

    Words of at most SHORT bytes go through a forward pass over boosted products.
    Longer ones, and those whose product leaves floating point, go through a pass
    over logarithms, so every word's sum is over all its segmentations."""

    SHORT = 32
    BOOST = 1e3  # per byte: piece probabilities are about 1e-3 a byte

    def __init__(self, words: list[str], vocab: Vocabulary):
        raw = [(" " + w).encode("utf-8") for w in words]
        self.data = data = np.frombuffer(b"".join(raw), np.uint8)
        n = np.fromiter(map(len, raw), np.int64, len(raw))
        self.begin = np.cumsum(n) - n
        self.end = self.begin + n
        lead = (data & 0xC0) != 0x80  # first bytes of characters
        word = np.repeat(np.arange(len(n)), n)
        room = self.end[word] - np.arange(len(data))  # bytes to the word's end
        found = []
        for width in range(1, min(vocab.longest, 62) + 1):
            at = np.flatnonzero(lead & (room >= width))
            if not len(at):
                break
            hit, piece = vocab.find(B.span_hashes(data, at, at + width))
            found.append((at[hit], np.full(len(hit), width), piece))
        chars = np.flatnonzero(lead)
        length = np.diff(np.append(chars, len(data)))
        known = np.zeros(len(data), np.int64)  # width bits of the pieces that begin here
        for at, width, _ in found:
            known[at] |= np.int64(1) << width
        alone = (known[chars] >> length) & 1 == 0
        found.append((chars[alone], length[alone], np.full(int(alone.sum()), vocab.size)))
        start, width, piece = (np.concatenate(x) for x in zip(*found))
        ends = start + width
        offset = ends - self.begin[word[start]]
        order = np.lexsort((ends, offset))
        self.start, self.stop, self.piece, self.width = start[order], ends[order], piece[order], width[order]
        self.owner = word[self.start]
        self.steps = np.flatnonzero(np.diff(np.append(offset[order], -1))) + 1

    def places(self, at: np.ndarray) -> np.ndarray:
        """Which byte positions are in ``at``, as a mask (a word's begin is its neighbour's end)."""
        out = np.zeros(len(self.data) + 1, bool)
        out[at] = True
        return out

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sums over segmentations of every prefix, boosted; weight: boosted
        probabilities of each piece, one row per place, any columns.

        alpha[i + 1] belongs to the prefix that ends before byte i + 1; a word
        begins with 1 whatever its neighbour ends with."""
        alpha = np.zeros((len(self.data) + 1, weight.shape[1]))
        opens = self.places(self.begin)
        lo = 0
        for hi in self.steps.tolist():
            s, e = self.start[lo:hi], self.stop[lo:hi]
            into = weight[lo:hi] * np.where(opens[s][:, None], 1.0, alpha[s])
            first = np.flatnonzero(np.diff(np.append(-1, e)))
            alpha[e[first]] = np.add.reduceat(into, first, axis=0)
            lo = hi
        return alpha

    def forward_log(self, weight: np.ndarray) -> np.ndarray:
        """The same over logarithms, without a boost."""
        alpha = np.full((len(self.data) + 1, weight.shape[1]), -np.inf)
        opens = self.places(self.begin)
        lo = 0
        for hi in self.steps.tolist():
            s, e = self.start[lo:hi], self.stop[lo:hi]
            into = weight[lo:hi] + np.where(opens[s][:, None], 0.0, alpha[s])
            first = np.flatnonzero(np.diff(np.append(-1, e)))
            alpha[e[first]] = log_sums(into, first)
            lo = hi
        return alpha

    def backward(self, weight: np.ndarray, logs: bool) -> np.ndarray:
        """The mirror image: of the rest of the word from byte i on, one column."""
        beta = np.full(len(self.data) + 1, -np.inf if logs else 0.0)
        closes = self.places(self.end)
        rest = self.end[self.owner] - self.start
        back = np.lexsort((self.start, rest))
        lo = 0
        for hi in (np.flatnonzero(np.diff(np.append(rest[back], -1))) + 1).tolist():
            k = back[lo:hi]
            first = np.flatnonzero(np.diff(np.append(-1, self.start[k])))
            if logs:
                into = weight[k] + np.where(closes[self.stop[k]], 0.0, beta[self.stop[k]])
                beta[self.start[k[first]]] = log_sums(into[:, None], first)[:, 0]
            else:
                into = weight[k] * np.where(closes[self.stop[k]], 1.0, beta[self.stop[k]])
                beta[self.start[k[first]]] = np.add.reduceat(into, first)
            lo = hi
        return beta

    def sums(self, prob: np.ndarray) -> np.ndarray:
        """prob: pieces x languages -> words x languages, the log of the sums; -inf where
        the products leave floating point."""
        alpha = self.forward(prob[self.piece] * (self.BOOST ** self.width)[:, None])
        with np.errstate(divide="ignore"):
            return np.log(alpha[self.end]) - ((self.end - self.begin) * math.log(self.BOOST))[:, None]

    def sums_log(self, prob: np.ndarray) -> np.ndarray:
        return self.forward_log(np.log(prob)[self.piece])[self.end]

    def log_probs(self, prob: np.ndarray) -> np.ndarray:
        """The sums, by logarithms where the products leave floating point."""
        out = self.sums(prob)
        return out if np.isfinite(out).all() else self.sums_log(prob)

    def through(self, prob: np.ndarray, logs: bool) -> np.ndarray:
        """prob: pieces of one language -> of every piece at its place, the share of its
        word's segmentations that use it; not a number where products leave floating point."""
        if logs:
            weight = np.log(prob)[self.piece]
            alpha = self.forward_log(weight[:, None])[:, 0]
        else:
            weight = prob[self.piece] * self.BOOST ** self.width
            alpha = self.forward(weight[:, None])[:, 0]
        beta = self.backward(weight, logs)
        opens, closes = self.places(self.begin), self.places(self.end)
        whole = alpha[self.end][self.owner]
        one = 0.0 if logs else 1.0
        before, after = np.where(opens[self.start], one, alpha[self.start]), np.where(closes[self.stop], one, beta[self.stop])
        if logs:
            return np.exp(before + weight + after - whole)
        with np.errstate(divide="ignore", invalid="ignore"):
            return before * weight * after / whole


def log_sums(into: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log of the sums of exp over runs of rows that begin at ``first``."""
    top = np.maximum.reduceat(into, first, axis=0)
    runs = np.diff(np.append(first, len(into)))
    return top + np.log(np.add.reduceat(np.exp(into - np.repeat(top, runs, axis=0)), first, axis=0))


def is_short(words: list[str]) -> np.ndarray:
    return np.fromiter((len(w.encode("utf-8")) < Lattice.SHORT for w in words), bool, len(words))


def log_probs(words: list[str], vocab: Vocabulary, prob: np.ndarray) -> np.ndarray:
    """prob: pieces x languages -> words x languages, the log of the sum over all segmentations."""
    out = np.full((len(words), prob.shape[1]), -np.inf)
    short = np.flatnonzero(is_short(words))
    if len(short):
        out[short] = Lattice([words[i] for i in short], vocab).sums(prob)
    rest = np.flatnonzero(~np.isfinite(out).all(1))
    for some in batches_of(words, rest):
        out[some] = Lattice([words[i] for i in some], vocab).sums_log(prob)
    return out


def batches_of(words: list[str], places: np.ndarray) -> Iterator[list[int]]:
    """Places of words in batches of about a quarter of a megabyte, words of like length together."""
    some, size = [], 0
    for i in sorted(places.tolist(), key=lambda i: len(words[i])):
        some.append(i)
        size += len(words[i])
        if size > 1 << 18:
            yield some
            some, size = [], 0
    if some:
        yield some


def expected(words: list[str], vocab: Vocabulary, prob: np.ndarray, count: np.ndarray) -> np.ndarray:
    """prob: pieces of one language; count: of each word -> expected count of each piece."""
    total = np.zeros(len(prob))

    def add(some, logs):
        """Words whose products leave floating point are given back."""
        lattice, n = Lattice([words[i] for i in some], vocab), count[some]
        share = lattice.through(prob, logs)
        bad = np.zeros(len(some), bool)
        bad[lattice.owner[~np.isfinite(share)]] = True
        good = ~bad[lattice.owner]
        total[:] += np.bincount(lattice.piece[good], weights=share[good] * n[lattice.owner[good]], minlength=len(prob))
        return np.asarray(some)[bad]

    short = is_short(words)
    again = add(np.flatnonzero(short), False) if short.any() else np.zeros(0, np.int64)
    for some in batches_of(words, np.concatenate([np.flatnonzero(~short), again])):
        add(some, True)
    return total


def word_keys(piece: B.Piece):
    """Distinct words of a piece: starts, ends, keys, which word stands where, and its text."""
    starts, ends, part = B.word_spans(piece, B.NOT_LETTER)
    keys, first, which = np.unique(B.span_hashes(piece.data, starts, ends), return_index=True, return_inverse=True)
    return starts[first], ends[first], keys, which, part


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, text) -> lang, word, n: counted in each task, summed by the shuffle."""
    def each(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs], np.int64)
            total: dict = {}
            for piece in B.pieces(batch.column(1), B.NOT_LETTER, 1 << 20):
                s, e, keys, which, part = word_keys(piece)
                if not len(keys):
                    continue
                raw = piece.data.tobytes()
                pairs, n = np.unique(which * len(names) + code[piece.rows[part]], return_counts=True)
                words = [raw[x:y].decode("utf-8").lower() for x, y in zip(s.tolist(), e.tolist())]
                for k, c in zip(pairs.tolist(), n.tolist()):
                    key = (k % len(names), words[k // len(names)])
                    total[key] = total.get(key, 0) + c
                if len(total) > 200_000:
                    yield rows(names, total)
                    total = {}
            if total:
                yield rows(names, total)

    def rows(names, total):
        return pa.RecordBatch.from_arrays([pa.array([names[k[0]] for k in total], pa.string()),
                                           pa.array([k[1] for k in total], pa.string()),
                                           pa.array(list(total.values()), pa.int64())], ["lang", "word", "n"])

    return docs.mapInArrow(trimmed(each), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Piece probabilities of each language; picklable, one number per piece and language."""

    def __init__(self, langs: list[str], prior: list[float], prob: list[list[float]], vocabulary: str):
        self.langs, self.prior, self.prob, self.vocabulary = langs, prior, prob, vocabulary
        self.key = uuid.uuid4().hex


def fit(docs: DataFrame, vocabulary: str = VOCABULARY, iterations: int = 1, text_col="text", lang_col="lang") -> Model:
    """Learn from all rows with a label and a text."""
    labelled = small_batches(docs).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    shares = {r[0]: r[1] for r in labelled.groupBy("lang").agg(F.count("*")).collect()}
    langs = sorted(shares)
    size = len(pieces_of(vocabulary))
    prob = [[1.0 / size] * size + [0.01 / size] for _ in langs]
    if not langs:
        return Model([], [], [], vocabulary)
    words = materialize(word_counts(labelled), "lang-words")
    for _ in range(iterations):
        now = docs.sparkSession.sparkContext.broadcast(dict(zip(langs, map(np.array, prob))))

        def expect(batches):
            vocab, total = vocabulary_of(vocabulary), {}
            for batch in batches:
                names = np.array(batch.column(0).to_pylist(), object)
                words, n = batch.column(1).to_pylist(), np.asarray(batch.column(2), float)
                for lang in dict.fromkeys(names.tolist()):
                    mine = np.flatnonzero(names == lang)
                    got = expected([words[i] for i in mine], vocab, now.value[lang], n[mine])[:-1]
                    total[lang] = total.get(lang, 0) + got
            for lang, got in total.items():
                piece = np.flatnonzero(got)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(piece), pa.string()), pa.array(piece, pa.int32()),
                                                  pa.array(got[piece])], ["lang", "piece", "n"])

        got = (words.mapInArrow(trimmed(expect), "lang string, piece int, n double")
               .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas())  # one row per piece and language
        for x, lang in enumerate(langs):
            counts = np.full(size, SMOOTHING)
            own = got[got["lang"] == lang]
            counts[own["piece"].to_numpy(np.int64)] += own["n"].to_numpy()
            whole = counts.sum() + SMOOTHING
            prob[x] = [*(counts / whole).tolist(), SMOOTHING / whole]
    total = sum(shares.values())
    return Model(langs, [math.log(shares[x] / total) for x in langs], prob, vocabulary)


class Scorer:
    """Log probabilities of words under every language, each word computed once."""

    def __init__(self, model: Model):
        self.model, self.vocab = model, vocabulary_of(model.vocabulary)
        self.prob = np.array(model.prob).T
        self.clear()

    def clear(self):
        self.place: dict[int, int] = {}
        self.logs = np.zeros((0, len(self.model.langs)))

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of log probabilities per text and language; whether a text has a letter;
        bytes of its words, with the space before each."""
        sums = np.tile(np.array(self.model.prior, float), (len(column), 1))
        sizes = np.zeros(len(column), np.int64)
        letters = np.zeros(len(column), bool)
        for piece in B.pieces(column, B.NOT_LETTER, 1 << 20):
            if len(self.place) > MAX_CACHED:
                self.clear()
            s, e, keys, which, part = word_keys(piece)
            if not len(keys):
                continue
            raw = piece.data.tobytes()
            keys = keys.tolist()
            new = [i for i, k in enumerate(keys) if k not in self.place]
            words = [raw[x:y].decode("utf-8").lower() for x, y in zip(s[new].tolist(), e[new].tolist())]
            got = [log_probs(words[k: k + 8192], self.vocab, self.prob) for k in range(0, len(words), 8192)]
            self.logs = np.concatenate([self.logs, *got])
            self.place.update(zip((keys[i] for i in new), range(len(self.logs) - len(new), len(self.logs))))
            at = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))[which]
            sizes[piece.rows] += np.bincount(part, weights=(e - s + 1)[which], minlength=len(piece.rows)).astype(np.int64)
            for x in range(sums.shape[1]):
                sums[piece.rows, x] += np.bincount(part, weights=self.logs[at, x], minlength=len(piece.rows))
            ascii_letter = ~B.NOT_LETTER[piece.data] & (piece.data < 0x80)
            run = np.concatenate([[0], np.cumsum(ascii_letter)])
            letters[piece.rows] |= run[piece.bounds[1:]] > run[piece.bounds[:-1]]
        for i in np.flatnonzero(~letters).tolist():
            letters[i] = any(map(str.isalpha, column[i].as_py() or ""))
        return sums, letters, sizes


def predictions(model: Model, column: pa.Array) -> pa.Array:
    if not model.langs:
        lang, score, per_byte, sizes = ["und"] * len(column), *np.zeros((2, len(column))), np.zeros(len(column), np.int64)
    else:
        _memo = held("langid")
        if _memo.get("model") != model.key:
            _memo["model"], _memo["scorer"] = model.key, Scorer(model)
        sums, letters, sizes = _memo["scorer"].texts(column)
        best = sums.argmax(1) if len(sums) else np.zeros(0, np.int64)
        score = np.where(letters, 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1), 0.0) if len(sums) else np.zeros(0)
        lang = [model.langs[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist())]
        own = sums - np.array(model.prior)  # of the words alone
        per_byte = own[np.arange(len(own)), best] / np.maximum(sizes, 1) if len(own) else np.zeros(0)
    return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(per_byte, pa.float64()),
                                       pa.array(sizes, pa.int64())], [x.split(":")[0] for x in PREDICTION.split(", ")])


#: What is said of a text; ``per_byte`` is the log probability of its words per byte,
#: the space before each included, under the language predicted.
PREDICTION = "lang_pred: string, score: double, per_byte: double, word_bytes: long"


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: str = "__language", measured: bool = False) -> DataFrame:
    """``docs`` and a column ``out``: struct of lang_pred and score; ``measured``: all
    of PREDICTION."""
    known = small_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(f"struct<{PREDICTION}>")
    def language(texts: pa.Array) -> pa.Array:
        said = predictions(known.value, texts)
        trim()
        return said

    said = docs.withColumn(out, language(F.col(text_col)))
    return said if measured else said.withColumn(out, F.struct(F.col(f"{out}.lang_pred"), F.col(f"{out}.score")))


def usual_scores(scored: DataFrame, lang_col: str = "lang", out: str = "__language") -> dict[str, float]:
    """The lowest score per byte that texts of each language come with: FAR_BELOW
    standard deviations under the mean over all labelled texts with at least
    LEAST_BYTES of words.  ``scored``: what ``predict`` gives with ``measured``."""
    got = scored.where(F.col(lang_col).isNotNull()).select(f"{out}.*").where(F.col("word_bytes") >= LEAST_BYTES)
    stats = got.groupBy("lang_pred").agg(F.avg("per_byte").alias("mean"), F.stddev_pop("per_byte").alias("spread")).collect()  # a row per language
    return {r["lang_pred"]: r["mean"] - FAR_BELOW * r["spread"] for r in stats}


def in_language(language: Column, lowest: dict[str, float], least_score: float = 0.5) -> Column:
    """Whether a prediction (the whole struct of ``predict``) holds: a language, more likely
    than not, and a text that is not far less likely per byte than its texts are.
    Texts too short to tell pass."""
    floor = F.coalesce(*[F.when(language["lang_pred"] == lang, F.lit(x)) for lang, x in lowest.items()], F.lit(float("-inf")))
    return ((language["lang_pred"] != "und") & (language["score"] >= least_score)
            & ((language["word_bytes"] < LEAST_BYTES) | (language["per_byte"] >= floor)))
