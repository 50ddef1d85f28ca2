"""Distinct word shingles of whole texts as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm import bytewords as B

_ROT = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, set sizes, hashes): each text's distinct shingles
    of k words, ascending; a text with fewer words is one shingle, none without words."""
    for first, last, counts, words in B.text_words(column, B.SPACES):
        ends = np.cumsum(counts)
        begins = ends - counts
        if len(words) >= k:
            h = np.zeros(len(words) - k + 1, np.uint64)
            for j in range(k):
                h += B.mix(words[j: len(words) - k + 1 + j] + np.uint64(_ROT[j % 5])) * np.uint64(_ROT[(j + 1) % 5] + 2 * j)
            h = B.mix(h)
        else:
            h = np.zeros(0, np.uint64)
        n = np.maximum(counts - k + 1, 0)
        doc = np.repeat(np.arange(len(counts)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins, n)
        h = h[at]
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):  # fewer words: the sequence as a whole, told apart by its length
            own = np.array([int(B.mix(np.array([sum((int(w) * pow(_ROT[0], j + 1, 1 << 64)) for j, w in enumerate(
                words[begins[i]: ends[i]])) + int(counts[i]) & (2**64 - 1)], np.uint64))[0]) for i in short], np.uint64)
            h, doc = np.concatenate([h, own]), np.concatenate([doc, short])
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        yield first, last, np.bincount(doc, minlength=last - first), h


def set_digests(sizes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of every set."""
    out = []
    for salt in (0x51ED270B7F4A7C15, 0x2545F4914F6CDD1D):
        run = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(B.mix(hashes ^ np.uint64(salt)), out=run[1:])
        ends = np.cumsum(sizes)
        out.append(run[ends] - run[ends - sizes])
    return out[0], out[1]
