"""Hierarchical multi-length packing (operator 8).

Documents are encoded and cut into windows of several context sizes, all
powers of two. A document's full longest windows stand alone; what is left of
it is routed to the smallest context size that holds it. Each size is packed
from the longest leftover down, the gap in a window is filled with the longest
leftovers of shorter sizes that fit, and the last gap with a piece cut off the
shortest one. Every window is therefore full; only the last tokens of a task
may not fill a window and are cut at powers of two. Windows are then dealt to
step groups of about equal tokens, longest first to the lightest group.

Each task packs the documents it reads: nothing is shuffled and memory is
bounded by ``CHUNK_TOKENS``. Ids of sequences and step groups carry the task's
partition in their upper bits, so a task that runs again gives the same ids.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeshore.llm.common import doc_text, releasing, ship
from lakeshore.llm.encoders import json_tokenizer_memo, with_end

CONTEXT_SIZES = (256, 512, 1024, 2048)
CHUNK_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
ROWS_PER_BATCH = 8192

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long, sequence_tokens long, step_group long")


class Piece(NamedTuple):
    """A run of a document's ids. Pieces compare by length, then doc_id (null
    last), start and the document's number, which no other piece shares."""
    length: int
    no_id: bool
    doc_id: int
    start: int
    number: int
    doc_tokens: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple[Piece, Piece]:
        length, no_id, doc_id, start, number, doc_tokens, ids = self
        return (Piece(n, no_id, doc_id, start, number, doc_tokens, ids[:n]),
                Piece(length - n, no_id, doc_id, start + n, number, doc_tokens, ids[n:]))


def fill_windows(pieces: list[Piece], sizes: tuple[int, ...]) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows out of ``pieces`` (none longer than the longest size), and
    the pieces of the one window that could not be filled."""
    pool = sorted(pieces)
    lengths = [p.length for p in pool]

    def take(i: int) -> Piece:
        lengths.pop(i)
        return pool.pop(i)

    windows = []
    while pool:
        window = [take(-1)]
        gap = sizes[bisect_left(sizes, window[0].length)] - window[0].length
        while gap and pool:
            i = bisect_right(lengths, gap) - 1
            if i >= 0:
                window.append(take(i))
            else:
                head, tail = take(0).cut(gap)
                window.append(head)
                at = bisect_left(lengths, tail.length)
                lengths.insert(at, tail.length)
                pool.insert(at, tail)
            gap -= window[-1].length
        if gap:
            return windows, window
        windows.append(window)
    return windows, []


def power_of_two_windows(pieces: list[Piece]) -> list[list[Piece]]:
    """Windows of falling powers of two that hold ``pieces`` without padding."""
    left, out, rest = sum(p.length for p in pieces), [], list(reversed(pieces))
    while left:
        gap = 1 << (left.bit_length() - 1)
        left -= gap
        window = []
        while gap:
            piece = rest.pop()
            if piece.length > gap:
                piece, tail = piece.cut(gap)
                rest.append(tail)
            window.append(piece)
            gap -= piece.length
        out.append(window)
    return out


def step_groups(tokens: list[int], step_tokens: int) -> list[int]:
    """Group number of each window: longest first, to the lightest group."""
    groups = [(0, g) for g in range(-(-sum(tokens) // step_tokens))]
    out = [0] * len(tokens)
    for i in sorted(range(len(tokens)), key=lambda i: -tokens[i]):
        load, g = heapq.heappop(groups)
        out[i] = g
        heapq.heappush(groups, (load + tokens[i], g))
    return out


def pack_documents(encoded: Iterator[tuple[int | None, np.ndarray]], sizes: tuple[int, ...], step_tokens: int,
                   base: int) -> Iterator[tuple]:
    """Rows of PIECE_SCHEMA and the piece's ids, for documents given as
    (doc_id, little-endian uint32 ids with the end id)."""
    longest, sequence, group = sizes[-1], base, base
    pending: list[Piece] = []
    tokens = 0

    def emit(windows: list[list[Piece]]) -> Iterator[tuple]:
        nonlocal sequence, group
        sums = [sum(p.length for p in w) for w in windows]
        dealt = step_groups(sums, step_tokens)
        for window, total, g in zip(windows, sums, dealt, strict=True):
            offset = 0
            for p in window:
                yield (None if p.no_id else p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, sequence, offset, total,
                       group + g, p.ids)
                offset += p.length
            sequence += 1
        group += max(dealt, default=-1) + 1

    full: list[list[Piece]] = []
    for number, (doc_id, ids) in enumerate(encoded):
        n = len(ids)
        rest = Piece(n, doc_id is None, doc_id or 0, 0, number, n, ids)
        while rest.length >= longest:
            head, rest = rest.cut(longest)
            full.append([head])
        if rest.length:
            pending.append(rest)
        tokens += n
        if tokens >= CHUNK_TOKENS:
            windows, pending = fill_windows(pending, sizes)
            yield from emit(full + windows)
            full, tokens = [], sum(p.length for p in pending)
    windows, pending = fill_windows(pending, sizes)
    yield from emit(full + windows + power_of_two_windows(pending))


def pack(docs: DataFrame, tokenizer: bytes, end_id: int, sizes: tuple[int, ...] = CONTEXT_SIZES,
         step_tokens: int = STEP_TOKENS, with_ids: bool = False, memo_bytes: int | None = None) -> DataFrame:
    """Pack every document into full windows; one row per piece.

    Columns: doc_id; start, length and ids_crc32 of the piece (little-endian
    uint32 ids); doc_tokens with the end id; sequence_id and the piece's offset
    there; sequence_tokens, the window's length; step_group; with ``with_ids``
    also the ids (binary).

    Null or empty text: a document of the end id alone. Null doc_id: kept as
    null. Repeated rows are packed once each. Ties in length go by doc_id
    (null last) and position. The text of a special token becomes its id, as the
    library does by default. An empty table gives no rows. ``sizes``: rising powers of two.
    ``memo_bytes``: another bound of each worker's memo of encoded pieces.
    """
    if any(s & (s - 1) for s in sizes) or list(sizes) != sorted(set(sizes)):
        raise ValueError("context sizes must be rising powers of two")
    ship(docs.sparkSession)
    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.binary() if n == "ids" else pa.int64() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        memo = json_tokenizer_memo(tokenizer, memo_bytes)

        def encoded() -> Iterator[tuple[int | None, np.ndarray]]:
            for b in batches:
                doc_ids = iter(b.column("doc_id").to_pylist())
                for ids, offsets in memo.encode(b.column("text")):
                    ids, offsets = with_end(ids, offsets, end_id)
                    for lo, hi in pairwise(offsets.tolist()):
                        yield next(doc_ids), ids[lo:hi]

        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))[:len(names)]
            if with_ids:
                columns[-1] = [x.tobytes() for x in columns[-1]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for row in pack_documents(encoded(), sizes, step_tokens, TaskContext.get().partitionId() << 33):
            rows.append(row)
            if len(rows) == ROWS_PER_BATCH:
                yield batch()
                rows.clear()
        if rows:
            yield batch()

    return doc_text(docs).mapInArrow(releasing(run), schema)
