"""License scan by ordered signature rules.

Texts are first passed through keywords; what none of them occurs in costs a few
substring searches.  The others become lower-cased words, and the rules whose
keyword occurs are run.  A detection that lies within one of higher priority is
suppressed, so "CC BY-NC 4.0" is not also "CC BY-NC".  Base phrases are found
beside the rules and always stay.

Each text is scanned whole, by itself: nothing is shuffled.

Defined results
---------------
* Words are runs of ASCII letters and digits and non-ASCII characters; A-Z is
  lower-cased.  A null or empty text has no words, labels or places; score 0.
* Detections with equal intervals: the higher priority stays.  Repeated phrases
  are all counted.  Rows are scanned one by one, so repeats give repeats.
* The score is the largest confidence of what stays: 1 for a base phrase, and
  for a rule it grows with the words it matched.
* An empty table gives an empty result; other input columns play no part.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytewords as B
from tidemark.llm.batches import small_batches
from tidemark.llm.license_rules import BASE, mandatory, rules

#: Gates of so few letters count only at the start of a word.
SHORT = 3
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_compiled: list = []


def compiled():
    """Rules by keyword, and what any text must hold for one of them to match."""
    if not _compiled:
        by: dict[str, list] = {}
        for priority, label, keyword, pattern in rules():
            by.setdefault(keyword, []).append((priority, label, re.compile(rf"(?<!\S)(?:{pattern})(?!\S)".encode())))
        # a pattern that always speaks of a license has that word as its gate
        gates = {gate_of(k, p) for _, _, k, p in rules()} | {gate_of(p, p) for p, _ in BASE}
        # a gate that a plain one is part of adds nothing; a short one, asked for
        # at the start of a word only, stands in for no other: "gpl" is not in "agplv3"
        gates = sorted(g for g in gates if not any(o != g and len(o) > SHORT and o in g for o in gates))
        _compiled.extend([{k.encode(): v for k, v in by.items()}, gates])
    return _compiled


def gate_of(keyword: str, pattern: str) -> bytes:
    """A stretch of letters that every match of the pattern holds."""
    held = mandatory(pattern)
    if any("licen" in x for x in held):
        return b"licen"
    words = keyword if any(keyword in x for x in held) else " ".join(held)
    return max(words.split(), key=len).encode()


def passes(low: bytes) -> bool:
    """Whether any rule or base phrase may match the lower-cased text."""
    return any(g in low and (len(g) > SHORT or re.search(rb"(?<![0-9a-z\x80-\xff])" + g, low)) for g in compiled()[1])


def word_numbers(words: bytes, at: list[int]) -> list[int]:
    """How many words stand before each place of ' '-joined words."""
    spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 0x20)
    return np.searchsorted(spaces, np.array(at, np.int64)).tolist()


def find_base(padded: bytes) -> list[tuple[int, int, str]]:
    """(first word, last word, label) of every place of the base phrases in
    ' word word ... '."""
    found = []
    for phrase, label in BASE:
        at = padded.find(f" {phrase} ".encode())
        while at >= 0:
            found.append((at, phrase.count(" "), label))
            at = padded.find(f" {phrase} ".encode(), at + 1)
    first = word_numbers(padded, [x[0] for x in found])
    return sorted((f, f + more, label) for f, (_, more, label) in zip(first, found))


def detect(words: bytes) -> list[tuple[int, int, str, int]]:
    """(first word, last word, label, priority) after suppression, in order."""
    by, _ = compiled()
    found = []
    for keyword, own in by.items():
        if keyword in words:
            for priority, label, pattern in own:
                found += [(m.start(), m.end(), label, priority) for m in pattern.finditer(words)]
    if not found:
        return []
    stays = outside_higher(*(np.array(x) for x in zip(*[(s, e, p) for s, e, _, p in found])))
    kept = [found[i] for i in stays.tolist()]
    first, last = word_numbers(words, [x[0] for x in kept]), word_numbers(words, [x[1] for x in kept])
    return sorted((f, e, label, p) for f, e, (_, _, label, p) in zip(first, last, kept))


def outside_higher(start: np.ndarray, end: np.ndarray, priority: np.ndarray) -> np.ndarray:
    """Which intervals lie in none of higher priority.

    One that lies in a suppressed interval lies in the one that suppressed that, so
    all higher ones count, kept or not: by start, with the farthest end so far."""
    stays = []
    starts, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for p in np.unique(priority)[::-1]:
        mine = np.flatnonzero(priority == p)
        at = np.searchsorted(starts, start[mine], "right") - 1
        inside = (at >= 0) & (np.append(far, -1)[at] >= end[mine])
        stays.append(mine[~inside])
        starts, far = np.append(starts, start[mine]), np.append(far, end[mine])
        order = np.argsort(starts, kind="stable")
        starts, far = starts[order], np.maximum.accumulate(far[order])
    return np.concatenate(stays)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, places (base phrases: first, last, label), detections
    (first, last, label, priority), confidence."""
    schema = ("doc_id long, n_words long, places array<struct<first: long, last: long, label: string>>, "
              "detections array<struct<first: long, last: long, label: string, priority: int>>, confidence double")
    span = [("first", pa.int64()), ("last", pa.int64()), ("label", pa.string())]
    kinds = [pa.list_(pa.struct(span)), pa.list_(pa.struct([*span, ("priority", pa.int32())])), pa.float64()]

    def each(batches):
        for batch in batches:
            texts = batch.column(1)
            n = np.zeros(len(texts), np.int64)
            for piece in B.pieces(texts, B.NOT_ALNUM):
                part = B.word_spans(piece, B.NOT_ALNUM)[2]
                n[piece.rows] += np.bincount(part, minlength=len(piece.rows))
            data, at = B.strings(texts)
            raw, at = data.tobytes(), at.tolist()
            places, detections, confidence = [], [], []
            for x, y in zip(at, at[1:]):
                low = raw[x:y].lower()
                if not passes(low):
                    places.append([])
                    detections.append([])
                    confidence.append(0.0)
                    continue
                words = b" ".join(WORD.findall(low))
                base, found = find_base(b" " + words + b" "), detect(words)
                places.append([dict(zip(("first", "last", "label"), p)) for p in base])
                detections.append([dict(zip(("first", "last", "label", "priority"), p)) for p in found])
                confidence.append(1.0 if base else max((1 - 0.5 ** (p[1] - p[0] + 1) for p in found), default=0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), *(pa.array(v, k) for v, k in zip((places, detections, confidence), kinds))],
                ["doc_id", "n_words", "places", "detections", "confidence"])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(each, schema)
