"""Token ids packed into rows of fixed length by best-fit-decreasing.

Texts become token ids of a public byte-level BPE; a document of more than a
row's tokens is split without loss.  Windows of consecutive segments are packed
largest first, each into the fullest row that still holds it: a segment tree
over free capacities finds that row in log(context) steps.  A window is bounded,
so a task's memory is too, and nothing is shuffled: rows are packed where they
are read.

A packed row carries its ids as little-endian uint16 (a matrix row, padded to
the context length), the cumulative segment lengths, and where positions start
over; ``positions`` gives the position ids and ``unpack`` the documents.

Defined results
---------------
* A null or empty text has no tokens and takes no place.
* A token sequence longer than the context becomes consecutive segments with
  their offsets; the pieces together are the sequence again.
* Equal texts and repeated rows are packed once each.
* An empty table gives an empty result; other input columns play no part.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bytewords as B
from tidemark.llm.batches import small_batches
from tidemark.llm.workers import held, trimmed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pre-token pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PAD = 50256
#: Segments are packed in windows of about so many tokens.
WINDOW_TOKENS = 1 << 20
CACHE_PARTS = 200_000
PIECE_BYTES = 1 << 19


class Encoder:
    """Token ids of whole texts, each distinct word encoded once.

    The pattern never joins a space before a word to what stands before it, so a
    text falls apart there; parts that were met before are looked up by a hash."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        self.bytes_of[list(ranks.values())] = [len(x) for x in ranks]
        self.clear()

    def clear(self):
        self.place: dict[int, int] = {}
        self.ids, self.ends = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def add(self, keys: list[int], raw: list[bytes]) -> None:
        """Encode new parts together: those that begin with a space fall apart again
        by the bytes that their tokens stand for."""
        loose = [i for i, x in enumerate(raw) if x[:1] != b" "]
        joined = [i for i, x in enumerate(raw) if x[:1] == b" "]
        got = np.array(self.bpe.encode_ordinary(b"".join(raw[i] for i in joined).decode("utf-8")), np.uint16)
        width = np.cumsum(self.bytes_of[got])
        ends = np.searchsorted(width, np.cumsum([len(raw[i]) for i in joined]), "left") + 1
        own = [np.array(self.bpe.encode_ordinary(raw[i].decode("utf-8")), np.uint16) for i in loose]
        new = np.concatenate([got, *own])
        stops = np.concatenate([ends[: len(joined)], len(got) + np.cumsum([len(x) for x in own])]).astype(np.int64)
        first = len(self.ends) - 1
        self.ids = np.concatenate([self.ids, new])
        self.ends = np.concatenate([self.ends, self.ends[-1] + stops])
        self.place.update(zip([keys[i] for i in joined] + [keys[i] for i in loose], range(first, first + len(raw))))

    def parts(self, piece: B.Piece):
        """Starts and ends of the parts of a piece, and the text each belongs to."""
        d = piece.data
        cut = np.zeros(len(d) + 1, bool)
        if len(d) > 1:
            cut[:-2] = (d[:-1] == 0x20) & B.SOLID[d[1:]]
        full = np.flatnonzero(np.diff(piece.bounds) > 0)
        cut[piece.bounds[:-1][full]] = True
        starts = np.flatnonzero(cut[:-1]) if len(d) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(d)) if len(starts) else starts
        return starts, ends, np.searchsorted(piece.bounds, starts, "right") - 1

    def encode(self, column: pa.Array):
        """(row, ids) of the texts of a column, in order; long texts come in several pieces."""
        for piece in B.pieces(column, CUTS, PIECE_BYTES, single=True):
            if len(self.ends) > CACHE_PARTS:
                self.clear()
            starts, ends, part = self.parts(piece)
            if not len(starts):
                continue
            keys, first, which = np.unique(B.span_hashes(piece.data, starts, ends), return_index=True, return_inverse=True)
            keys = keys.tolist()
            new = [i for i, k in enumerate(keys) if k not in self.place]
            if new:
                raw = piece.data.tobytes()
                at = first[new]
                self.add([keys[i] for i in new], [raw[x:y] for x, y in zip(starts[at].tolist(), ends[at].tolist())])
            at = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))
            stop = self.ends
            lo, hi = stop[at][which], stop[at + 1][which]
            n = hi - lo
            run = np.cumsum(n)
            ids = self.ids[np.repeat(lo - (run - n), n) + np.arange(n.sum())]
            per = np.bincount(part, weights=n, minlength=len(piece.rows)).astype(np.int64)
            yield from zip(piece.rows.tolist(), np.split(ids, np.cumsum(per)[:-1]))


#: Long texts are cut before a space or a line end; see ``encode``.
CUTS = np.zeros(256, bool)
CUTS[0x20] = True


def encoder(path: str) -> Encoder:
    kept = held("packing")
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


class Capacity:
    """A segment tree over free capacities 0..context: how many rows have each."""

    def __init__(self, context: int):
        self.size = 1 << context.bit_length()
        self.count = [0] * (2 * self.size)

    def put(self, free: int, by: int) -> None:
        i = free + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def best(self, need: int) -> int:
        """The smallest free capacity of at least ``need`` that some row has, or -1."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:  # up until a right neighbour has rows, then down to its leftmost
            if not i & 1 and self.count[i + 1]:
                i += 1
                break
            i >>= 1
        if i <= 1:
            return -1
        while i < self.size:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_decreasing(lengths: np.ndarray, context: int) -> list[list[int]]:
    """Indexes of the segments of every row."""
    rows: list[list[int]] = []
    free_rows: dict[int, list[int]] = {}
    tree = Capacity(context)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        free = tree.best(n)
        if free < 0:
            rows.append([i])
            row, free = len(rows) - 1, context
        else:
            row = free_rows[free].pop()
            rows[row].append(i)
            tree.put(free, -1)
        if free - n:
            free_rows.setdefault(free - n, []).append(row)
            tree.put(free - n, 1)
    return rows


SCHEMA = ("n_tokens int, n_segments int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
          "doc_ids array<bigint>, offsets array<bigint>")


def pack(docs: DataFrame, context: int = 2048, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
         text_col: str = "text", window: int = WINDOW_TOKENS) -> DataFrame:
    """Packed rows: n_tokens, n_segments, input_ids (context uint16), position_ids
    (context uint16: from 0 in every segment, 0 in the padding), cu_seqlens (0 and the
    running ends), doc_ids and offsets (of each segment in its document)."""
    def each(batches):
        enc = encoder(vocabulary)
        held: list[tuple] = []  # doc_id, offset, ids
        tokens = 0

        def flush():
            lengths = np.array([len(x[2]) for x in held])
            out = []
            for row in best_fit_decreasing(lengths, context):
                ids = np.full(context, PAD, "<u2")
                at = [0]
                for i in row:
                    ids[at[-1]: at[-1] + len(held[i][2])] = held[i][2]
                    at.append(at[-1] + len(held[i][2]))
                resets = np.zeros(context, "<u2")
                resets[: at[-1]] = positions(at)
                out.append((at[-1], len(row), ids.tobytes(), resets.tobytes(), at, [held[i][0] for i in row], [held[i][1] for i in row]))
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                              [x.split()[0] for x in SCHEMA.split(", ")])

        def segments(batch):
            """Segments of at most ``context`` tokens; a text's rest waits for its next piece."""
            ids_of = batch.column(0).to_pylist()
            row, rest, offset = None, np.zeros(0, np.uint16), 0
            for r, ids in enc.encode(batch.column(1)):
                if r != row:
                    if len(rest):
                        yield ids_of[row], offset, rest
                    row, rest, offset = r, ids, 0
                else:
                    rest = np.concatenate([rest, ids])
                while len(rest) > context:
                    yield ids_of[row], offset, rest[:context]
                    rest, offset = rest[context:], offset + context
            if len(rest):
                yield ids_of[row], offset, rest

        for batch in batches:
            for seg in segments(batch):
                held.append(seg)
                tokens += len(seg[2])
                if tokens >= window:
                    yield flush()
                    held, tokens = [], 0
        if held:
            yield flush()

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(trimmed(each), SCHEMA)


def positions(cu_seqlens) -> np.ndarray:
    """Position ids of a row: they start over with every segment."""
    at = np.asarray(cu_seqlens)
    n = np.diff(at)
    return np.arange(at[-1]) - np.repeat(at[:-1], n)


def unpack(packed: DataFrame) -> DataFrame:
    """(doc_id, offset, n, ids): the segments again, two bytes a token."""
    return (packed.select("input_ids", "cu_seqlens", F.posexplode("doc_ids").alias("i", "doc_id"), "offsets")
            .select("doc_id", F.get("offsets", F.col("i")).alias("offset"),
                    (F.get("cu_seqlens", F.col("i") + 1) - F.get("cu_seqlens", F.col("i"))).alias("n"),
                    F.get("cu_seqlens", F.col("i")).alias("s"), "input_ids")
            .select("doc_id", "offset", "n", F.expr("substring(input_ids, 2 * s + 1, 2 * n)").alias("ids")))


def write_matrix(packed: DataFrame, path: str) -> None:
    """Write packed rows; ``input_ids`` of a file together are its id matrix, and
    ``position_ids`` the matrix of position resets beside it."""
    packed.write.mode("errorifexists").parquet(path)
