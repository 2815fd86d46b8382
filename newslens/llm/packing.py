"""Harmonic packing of tokenised documents into fixed-length sequences.

Lengths are partitioned into reciprocal-capacity classes: a class ``k`` holds
pieces of exactly ``capacity // k`` tokens and every one of its bins takes
``k`` of them.  A document is cut greedily into the largest classes it still
fills, so nothing is left over (class ``capacity`` holds single tokens).  Only
classes that leave next to no padding in a full bin are used.

Each task fills the bins of its own rows and nothing else: no shuffle, no
counter shared between workers, and at most ``k - 1`` open pieces per class in
memory.  What is still open when a task ends is strung together and cut again
into full sequences and one last run whose length is split into powers of two,
because a sequence of a power-of-two length needs no padding.

The ids of a sequence are ``(partition << 33) + n``; they depend on the input
split alone, so a recomputed task gives the same rows.

Defined results: a null text is an empty text and still has its closing id;
rows with equal or null ids are packed one by one; an empty table gives an
empty result; further columns of the input are ignored; very long texts are
tokenised in slices cut where the tokenizer itself always cuts.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
CLOSING_ID = 1
VOCABULARY = "byte_bpe_50k"
SLICE_CHARS = 1 << 18
ROWS_PER_BATCH = 20_000
#: A class is used if a full bin of it has at most this share of padding.
MAX_CLASS_PADDING = 0.004

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")
TOKEN_SCHEMA = PIECE_SCHEMA + ", ids array<int>"


def encoder(vocabulary: str = VOCABULARY):
    """Text to ids by the rank file of ``vocabulary``.

    The rank file holds the same vocabulary as the tokenizer's JSON file and
    gives the same ids (a test compares them), several times as fast.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    end = "<|endoftext|>"
    enc = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN,
                            mergeable_ranks=ranks, special_tokens={end: len(ranks)})

    def encode(text: str) -> list[int]:
        if end in text:
            return enc.encode(text, allowed_special="all")
        return enc.encode_ordinary(text)

    return encode


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """Cut before a single space between two other characters: a token never spans it."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) - 1 and not (
                text[cut] == " " and not text[cut - 1].isspace()
                and not text[cut + 1].isspace()):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def document_ids(text: str | None, encode, closing_id: int = CLOSING_ID) -> np.ndarray:
    parts = [np.array(encode(s), dtype="<u4") for s in slices(text or "")]
    return np.concatenate([*parts, np.array([closing_id], dtype="<u4")])


def class_lengths(capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(piece length, pieces per bin), longest first; the last is (1, capacity)."""
    found: dict[int, int] = {}
    for k in range(1, capacity + 1):
        length = capacity // k
        if capacity - length * k <= MAX_CLASS_PADDING * capacity:
            found[length] = k  # of several classes of one length the fullest
    return sorted(found.items(), reverse=True)


def powers(n: int) -> list[int]:
    """``n`` as a sum of distinct powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def cut(n: int, lengths: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``n`` tokens as (class index, count) from the longest class down."""
    out = []
    for c, (length, _) in enumerate(lengths):
        if n >= length:
            out.append((c, n // length))
            n %= length
    return out


class _Packer:
    """The open bins of one task."""

    def __init__(self, capacity: int, first_sequence: int, with_ids: bool):
        self.capacity, self.with_ids = capacity, with_ids
        self.lengths = class_lengths(capacity)
        self.open: list[list] = [[] for _ in self.lengths]
        self.next_sequence = first_sequence
        self.rows: list[tuple] = []

    def _put(self, piece, sequence: int, offset: int) -> None:
        doc_id, total, start, ids = piece
        row = (doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset)
        self.rows.append((*row, ids.astype(np.int32)) if self.with_ids else row)

    def _sequence(self, pieces) -> None:
        offset = 0
        for p in pieces:
            self._put(p, self.next_sequence, offset)
            offset += len(p[3])
        self.next_sequence += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        start = 0
        for c, count in cut(len(ids), self.lengths):
            length, per_bin = self.lengths[c]
            for _ in range(count):
                # A copy, so that an open piece does not hold its whole document.
                piece = ids[start:start + length]
                self.open[c].append((doc_id, len(ids), start,
                                     piece if per_bin == 1 else piece.copy()))
                start += length
                if len(self.open[c]) == per_bin:
                    self._sequence(self.open[c])
                    self.open[c] = []

    def finish(self) -> None:
        """Cut what is open anew: full sequences, then powers of two."""
        left = [p for pieces in self.open for p in pieces]
        total = sum(len(p[3]) for p in left)
        bins = [self.capacity] * (total // self.capacity) + powers(total % self.capacity)
        at = 0
        room, offset = (bins[0], 0) if bins else (0, 0)
        for doc_id, doc_total, start, ids in left:
            while len(ids):
                if not room:
                    at += 1
                    self.next_sequence += 1
                    room, offset = bins[at], 0
                take = min(room, len(ids))
                self._put((doc_id, doc_total, start, ids[:take]), self.next_sequence, offset)
                room, offset, start, ids = room - take, offset + take, start + take, ids[take:]
        self.open = [[] for _ in self.lengths]


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         closing_id: int = CLOSING_ID, vocabulary: str = VOCABULARY,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place in it, and place in a sequence.

    ``with_ids`` adds the token ids themselves.  See the module for null, empty,
    repeated and very long texts.
    """
    names = [f.split()[0] for f in (TOKEN_SCHEMA if with_ids else PIECE_SCHEMA).split(", ")]
    types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        packer = _Packer(capacity, TaskContext.get().partitionId() << 33, with_ids)

        def drain():
            columns = list(zip(*packer.rows)) or [[]] * len(names)
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(key, document_ids(value.as_py(), encode, closing_id))
                if len(packer.rows) >= ROWS_PER_BATCH:
                    yield drain()
        packer.finish()
        yield drain()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).alias("text")).mapInArrow(
        run, TOKEN_SCHEMA if with_ids else PIECE_SCHEMA)
