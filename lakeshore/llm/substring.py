"""Substring dedup with a count-min prefilter (operator 6).

Every window of consecutive words has a 96-bit hash (by a multilinear hash of
64-bit word hashes; two different windows of 10^13 share one with a
probability of about 1 in 1000). First pass: each task
counts its windows in sketches, two rows of cells addressed by independent
halves of the hash; the sketches are merged by addition, block of cells by
block, and a window whose cells both hold two or more is estimated repeated.
Estimates are never below the true count, so no repeated window is missed.
Second pass: only those windows are grouped exactly by their whole hash, after
each task has settled the repeats among its own, and every window but the
earliest of a group is marked. For this they are shuffled by buckets of hashes,
about 14 bytes a window; the number of buckets grows with the words, so that
none has more than 2^20 windows of different hashes or so.

The sketch has one to ``CELLS_PER_WINDOW`` cells for each window and row, however
many there are. Its "two or more" bits are broadcast while they have a size of
at most ``BROADCAST_BITS`` (64 MB). A larger sketch stays where it is merged,
dealt over the cluster by blocks of cells: every unit of documents sends its
cells to their blocks and gets one bit back for each, so nothing is broadcast
and no task holds more than a block or a unit. Texts are shuffled once either
way: here all passes read one exchange of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.llm.common import keyed_text, releasing, ship

WINDOW_WORDS = 20
CELLS_PER_WINDOW = 2
MIN_CELL_BITS = 16
BROADCAST_BITS = 1 << 29
BLOCK_BITS = 16
# Blocks that are not broadcast: about this many a row, of so many cells at most.
FAR_BLOCKS_BITS, MAX_BLOCK_BITS = 12, 26
UNIT_BYTES = 8 << 20
MAX_UNIT_PARTITIONS = 1 << 15
# Working sets of a task: words hashed at a time, windows counted or compared at a time.
GROUP_WORDS = 1 << 15
FLUSH_WINDOWS = 1 << 21
CUT_ROWS = 512
# Buckets of hashes: 2^MIN_BUCKET_BITS at least, of at most 2^BUCKET_WORDS_BITS words each.
MIN_BUCKET_BITS, BUCKET_WORDS_BITS = 8, 20


def _coefficients(lane: int, n: int) -> np.ndarray:
    rng = np.random.default_rng([2_000_003, lane])
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def window_hashes(words: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hash lanes, document index and start of every window, by document
    and start."""
    import xxhash
    lengths = np.array([len(w) for w in words], np.int64)
    total = int(lengths.sum())
    document = np.repeat(np.arange(len(words)), lengths)
    start = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    n = total - width + 1
    if n <= 0:
        none = np.zeros(0, np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.int64)
    of_word = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, total)
    inside = np.flatnonzero(document[:n] == document[width - 1:])
    lanes = []
    for lane in range(2):
        x = of_word if lane == 0 else _mix(of_word)
        h = np.zeros(n, np.uint64)
        for j, c in enumerate(_coefficients(lane, width)):
            h += x[j:j + n] * c
        lanes.append(_mix(h[inside]))
    return lanes[0], lanes[1], document[inside], start[inside]


def _word_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[list[bytes]]]]:
    """ids, copies and word lists of a bounded number of documents at a time."""
    ids, copies, words, n = [], [], [], 0
    for b in batches:
        for i, c, text in zip(b.column("id").to_pylist(), b.column("copy").to_pylist(), b.column("text"),
                              strict=True):
            ids.append(i)
            copies.append(c)
            words.append(text.as_py().encode().split())
            n += len(words[-1])
            if n >= GROUP_WORDS:
                yield ids, copies, words
                ids, copies, words, n = [], [], [], 0
    if ids:
        yield ids, copies, words


def _pack_cells(cells: np.ndarray, repeated: np.ndarray) -> bytes:
    """Sorted distinct offsets below 2^16 as gaps, mostly of one byte."""
    gaps = np.diff(cells, prepend=-1) - 1
    long_gaps = np.flatnonzero(gaps > 255)
    return b"".join([np.array([len(cells), len(long_gaps)], "<u4").tobytes(), (gaps & 255).astype("u1").tobytes(),
                     long_gaps.astype("<u2").tobytes(), (gaps[long_gaps] >> 8).astype("u1").tobytes(),
                     np.flatnonzero(repeated).astype("<u2").tobytes()])


def _unpack_cells(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Offsets, and the offsets seen more than once."""
    n, m = np.frombuffer(data, "<u4", 2).tolist()
    gaps = np.frombuffer(data, "u1", n, 8).astype(np.int64)
    long_gaps = np.frombuffer(data, "<u2", m, 8 + n)
    gaps[long_gaps] += np.frombuffer(data, "u1", m, 8 + n + 2 * m).astype(np.int64) << 8
    cells = np.cumsum(gaps + 1) - 1
    return cells, cells[np.frombuffer(data, "<u2", -1, 8 + n + 3 * m)]


def _sketch(texts: DataFrame, width: int, cell_bits: int) -> np.ndarray:
    """The merged sketch's "two or more" bits: array of two rows of bytes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            rows, blocks, data = [], [], []
            for row in range(2):
                cells = np.concatenate([k[row] for k in kept])
                cells.sort()
                new = np.r_[True, cells[1:] != cells[:-1], True]
                cells, again = cells[new[:-1]], ~new[1:][new[:-1]]
                ends = np.searchsorted(cells, np.arange((1 << cell_bits) >> BLOCK_BITS, dtype=np.uint32)
                                       << np.uint32(BLOCK_BITS))
                for block, (lo, hi) in enumerate(pairwise([*ends.tolist(), len(cells)])):
                    if lo < hi:
                        rows.append(row)
                        blocks.append(block)
                        data.append(_pack_cells(cells[lo:hi].astype(np.int64) & ((1 << BLOCK_BITS) - 1), again[lo:hi]))
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(blocks, pa.int32()),
                                               pa.array(data, pa.binary())], ["row", "block", "cells"])

        n = 0
        for _, _, words in _word_groups(batches):
            h1, h2, _, _ = window_hashes(words, width)
            if len(h1):
                # At most 2^32 cells: half the memory of a hash.
                kept.append(tuple((h >> np.uint64(64 - cell_bits)).astype(np.uint32) for h in (h1, h2)))
                n += len(h1)
            if n >= FLUSH_WINDOWS:
                yield flush()
                n = 0
        if kept:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(1 << BLOCK_BITS, np.uint8)

        def finished() -> Iterator[pa.RecordBatch]:
            bits = np.packbits(counts > 1, bitorder="little").tobytes()
            if now is not None and any(bits):
                yield pa.RecordBatch.from_pydict({"row": pa.array([now[0]], pa.int32()),
                                                  "block": pa.array([now[1]], pa.int32()), "bits": [bits]})

        for b in batches:
            for row, block, data in zip(*(b.column(k).to_pylist() for k in ("row", "block", "cells")), strict=True):
                if (row, block) != now:
                    yield from finished()
                    now = (row, block)
                    counts[:] = 0
                cells, repeated = _unpack_cells(data)
                counts[cells] = np.minimum(counts[cells], 1) + 1
                counts[repeated] = 2
        yield from finished()

    merged = (texts.select("id", "copy", "text").mapInArrow(releasing(count), "row int, block int, cells binary")
              .repartition("row", "block").sortWithinPartitions("row", "block")
              .mapInArrow(merge, "row int, block int, bits binary"))
    bits = np.zeros((2, 1 << (cell_bits - 3)), np.uint8)
    size = 1 << (BLOCK_BITS - 3)
    # At most BROADCAST_BITS bits.
    for r in merged.toLocalIterator():
        bits[r["row"], r["block"] * size:(r["block"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _estimated_repeated(bits: np.ndarray, cell_bits: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    out = np.ones(len(h1), bool)
    for row, h in enumerate((h1, h2)):
        cell = (h >> np.uint64(64 - cell_bits)).astype(np.int64)
        out &= (bits[row][cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
    return out


# settled: the length of a run of windows known to be repeated; 0 for a window
# that is still open, the earliest of its hash in its task.
_CANDIDATE = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("id", pa.int64()), ("copy", pa.int64()),
                        ("lo", pa.int32()), ("settled", pa.int32())])
_CANDIDATE_DDL = "h1 long, h2 int, id long, copy long, lo int, settled int"
# Candidates packed by buckets of hashes.
_PACKED = pa.schema([("bucket", pa.int32()), ("open", pa.binary()), ("runs", pa.binary())])
_PACKED_DDL = "bucket int, open binary, runs binary"


def _by_hash(h1, h2, doc, copy, at) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by hash and place; in it, where a hash begins, and which places
    are not the first of their hash."""
    order = np.lexsort((at, copy, doc, h2, h1))
    # One after the other, so that no more than one column is held twice.
    new = np.ones(len(order), bool)
    new[1:] = False
    for h in (h1, h2):
        h = h[order]
        new[1:] |= h[1:] != h[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = np.zeros(len(order), bool)
    for x in (doc, copy, at):
        x = x[order]
        later |= x != x[first]
    return order, new, later


def _settle(h1, h2, doc, copy, at) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Windows estimated repeated, their repeats among themselves settled:
    h1, h2, doc, copy, at of those that are open, and doc, copy, lo, length of
    runs known to be repeated, both in the order of the text."""
    order, new, later = _by_hash(h1, h2, doc, copy, at)
    kept = order[new]
    kept = kept[np.lexsort((at[kept], copy[kept], doc[kept]))]
    open_windows = tuple(x[kept] for x in (h1, h2, doc, copy, at))
    order = order[later]
    order = order[np.lexsort((at[order], copy[order], doc[order]))]
    doc, copy, at = (x[order] for x in (doc, copy, at))
    breaks = np.ones(len(doc), bool)
    breaks[1:] = (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1]) | (at[1:] > at[:-1] + 1)
    lo = np.flatnonzero(breaks)
    return open_windows, (doc[lo], copy[lo], at[lo], np.diff(np.r_[lo, len(doc)]))


def _spread(doc: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return _mix(doc.astype(np.uint64) * np.uint64(31) + lo.astype(np.uint64))


def _candidate_rows(open_windows, runs) -> pa.Table:
    """What :func:`_settle` returns, a row for each window or run."""
    h1, h2, *place = open_windows
    doc, copy, lo, length = runs
    spread = _spread(doc, lo)
    parts = [(h1, h2, *place, np.zeros(len(h1), np.int32)), (spread, spread.astype(np.uint32), doc, copy, lo, length)]
    return pa.concat_tables(pa.table([pa.array(c).cast(f.type) for c, f in zip(
        (x.view(np.int64), y.view(np.int32), *rest), _CANDIDATE, strict=True)], _CANDIDATE) for x, y, *rest in parts)


def _pack_numbers(x: np.ndarray) -> bytes:
    """Unsigned numbers of one or two bytes, larger ones apart."""
    kinds = [("u1", 255), ("<u2", 65535)]
    large = [x >= top for _, top in kinds]
    which = int(len(x) + 8 * large[1].sum() < 8 * large[0].sum())
    kind, top = kinds[which]
    apart = x[large[which]]
    return b"".join([np.array([top, len(apart)], "<u4").tobytes(),
                     np.minimum(x, np.uint64(top)).astype(kind).tobytes(), apart.astype("<u8").tobytes()])


def _unpack_numbers(data: bytes, n: int, at: int) -> tuple[np.ndarray, int]:
    """n numbers that begin at byte ``at``, and where they end."""
    top, m = np.frombuffer(data, "<u4", 2, at).tolist()
    kind, end = ("u1", at + 8 + n) if top == 255 else ("<u2", at + 8 + 2 * n)
    x = np.frombuffer(data, kind, n, at + 8).astype(np.uint64)
    x[x == top] = np.frombuffer(data, "<u8", m, end)
    return x, end + 8 * m


def _pack_places(doc, copy, *numbers) -> bytes:
    """Documents as gaps (in their order mostly a byte), numbers of 0 or more."""
    doc = doc.astype(np.int64).view(np.uint64)
    return b"".join([np.array([len(doc), copy.any()], "<u4").tobytes(),
                     *(_pack_numbers(x.astype(np.uint64)) for x in (np.diff(doc, prepend=np.uint64(0)), *numbers)),
                     copy.astype("<i8").tobytes() if copy.any() else b""])


def _unpack_places(data: bytes, k: int) -> tuple[list[np.ndarray], int]:
    """doc, copy and k columns of numbers, and where they end."""
    n, copies = np.frombuffer(data, "<u4", 2).tolist()
    columns, end = [], 8
    for _ in range(1 + k):
        x, end = _unpack_numbers(data, n, end)
        columns.append(x)
    doc = np.cumsum(columns[0], dtype=np.uint64).view(np.int64)
    copy = np.frombuffer(data, "<i8", n, end) if copies else np.zeros(n, np.int64)
    return [doc, copy, *(x.astype(np.int64) for x in columns[1:])], end + 8 * n * copies


def _pack_candidates(open_windows, runs, bucket_bits: int) -> pa.RecordBatch:
    """What :func:`_settle` returns, a row for each bucket; the bytes of a hash
    that its bucket tells are left out."""
    def by_bucket(h: np.ndarray, columns) -> tuple[list[np.ndarray], list[int]]:
        bucket = (h >> np.uint64(64 - bucket_bits)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        return [x[order] for x in columns], np.searchsorted(bucket[order], np.arange((1 << bucket_bits) + 1)).tolist()

    told = bucket_bits // 8
    (h1, h2, *place), bounds = by_bucket(open_windows[0], open_windows)
    hashes = np.concatenate([h1.astype(">u8").view("u1").reshape(-1, 8)[:, told:],
                             h2.astype(">u4").view("u1").reshape(-1, 4)], axis=1)
    runs, run_bounds = by_bucket(_spread(runs[0], runs[2]), runs)
    out = [[], [], []]
    for bucket, ((i, j), (k, m)) in enumerate(zip(pairwise(bounds), pairwise(run_bounds), strict=True)):
        if i < j or k < m:
            out[0].append(bucket)
            out[1].append(_pack_places(*(x[i:j] for x in place)) + hashes[i:j].tobytes() if i < j else None)
            out[2].append(_pack_places(*(x[k:m] for x in runs)) if k < m else None)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _PACKED, strict=True)], _PACKED.names)


def _unpack_open(data: bytes, bucket_bits: int) -> list[np.ndarray]:
    """h1 (without the bytes that the bucket tells), h2, doc, copy, at."""
    place, end = _unpack_places(data, 1)
    told = bucket_bits // 8
    hashes = np.frombuffer(data, "u1", -1, end).reshape(-1, 12 - told)
    h1 = np.zeros((len(hashes), 8), "u1")
    h1[:, told:] = hashes[:, :8 - told]
    return [h1.view(">u8")[:, 0].astype(np.uint64),
            np.ascontiguousarray(hashes[:, 8 - told:]).view(">u4")[:, 0].astype(np.uint32), *place]


def _bucket_bits(words: int) -> int:
    return max(MIN_BUCKET_BITS, words.bit_length() - BUCKET_WORDS_BITS)


def _candidates_by_broadcast(texts: DataFrame, width: int, cell_bits: int, bucket_bits: int) -> DataFrame:
    """Packed candidates."""
    # As it is: a compressed copy would stay in each worker beside the bits.
    sketch = texts.sparkSession.sparkContext.broadcast(_sketch(texts, width, cell_bits))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        kept: list[tuple[np.ndarray, ...]] = []

        def settled() -> pa.RecordBatch:
            columns = list(zip(*kept, strict=True))
            kept.clear()
            # No column is held in pieces and whole, nor while the result is packed.
            return _pack_candidates(*_settle(*(np.concatenate(columns.pop(0)) for _ in range(5))), bucket_bits)

        n = 0
        for ids, copies, words in _word_groups(batches):
            h1, h2, document, start = window_hashes(words, width)
            at = np.flatnonzero(_estimated_repeated(bits, cell_bits, h1, h2))
            if len(at):
                # Mostly no id has two texts: then the column takes a byte a window.
                copy = np.array(copies, np.int64) if any(copies) else np.zeros(len(copies), np.int8)
                kept.append((h1[at], (h2[at] >> np.uint64(32)).astype(np.uint32), np.array(ids, np.int64)[document[at]],
                             copy[document[at]], start[at].astype(np.int32)))
                n += len(at)
            if n >= FLUSH_WINDOWS // 4:  # settling takes four times the memory of counting
                yield settled()
                n = 0
        if kept:
            yield settled()

    return texts.select("id", "copy", "text").mapInArrow(releasing(candidates), _PACKED_DDL)


# ---------------------------------------------------------------- a sketch that stays in its blocks

def _pack_gaps(cells: np.ndarray, repeated: np.ndarray) -> bytes:
    """Sorted distinct offsets as gaps of one or two bytes (larger ones apart),
    and a bit for each that is set if it was seen more than once."""
    gaps = np.diff(cells, prepend=-1) - 1
    kind, top = ("u1", 255) if len(cells) and cells[-1] < 64 * len(cells) else ("<u2", 65535)
    large = gaps >= top
    return b"".join([np.array([len(cells), top, int(large.sum())], "<u4").tobytes(),
                     np.minimum(gaps, top).astype(kind).tobytes(), gaps[large].astype("<u8").tobytes(),
                     np.packbits(repeated, bitorder="little").tobytes()])


def _unpack_gaps(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Offsets, and which of them were seen more than once."""
    n, top, m = np.frombuffer(data, "<u4", 3).tolist()
    kind, size = ("u1", n) if top == 255 else ("<u2", 2 * n)
    gaps = np.frombuffer(data, kind, n, 12).astype(np.int64)
    gaps[gaps == top] = np.frombuffer(data, "<u8", m, 12 + size).astype(np.int64)
    repeated = np.unpackbits(np.frombuffer(data, "u1", -1, 12 + size + 8 * m), count=n, bitorder="little").astype(bool)
    return np.cumsum(gaps + 1) - 1, repeated


def _cells(h: np.ndarray, cell_bits: int, **options):
    return np.unique((h >> np.uint64(64 - cell_bits)).astype(np.int64), **options)


def _dealt(texts: DataFrame, total_bytes: int) -> DataFrame:
    """``texts`` with ``unit``: documents dealt to units of about UNIT_BYTES,
    rows of one document to several. Everything that follows reads this one
    exchange, so all columns stay."""
    n = total_bytes // UNIT_BYTES + 1
    dealt = texts.withColumn("place", F.monotonically_increasing_id()).withColumn(
        "unit", F.pmod(F.xxhash64("id", "copy", "place"), F.lit(n)))
    return dealt.drop("place").repartition(int(min(n, MAX_UNIT_PARTITIONS)), "unit")


def _candidates_by_blocks(dealt: DataFrame, width: int, cell_bits: int, bucket_bits: int | None = None) -> DataFrame:
    """Packed candidates with their unit; without ``bucket_bits`` a row for each."""
    block_bits = min(MAX_BLOCK_BITS, max(BLOCK_BITS, cell_bits - FAR_BLOCKS_BITS))

    def hashes(documents: pa.Table):
        return window_hashes([t.encode().split() for t in documents.column("text").to_pylist()], width)

    def blocks_of(cells: np.ndarray) -> np.ndarray:
        """Bounds of the runs of sorted cells that lie in one block."""
        return np.flatnonzero(np.diff(cells >> block_bits, prepend=-1, append=-1)) if len(cells) else np.zeros(1, int)

    asked_schema = pa.schema([("unit", pa.int64()), ("row", pa.int32()), ("block", pa.int64()), ("cells", pa.binary())])

    def count(documents: pa.Table) -> pa.Table:
        """Cells of a unit by row and block."""
        out = [[], [], []]
        for row, h in enumerate(hashes(documents)[:2]):
            cells, n = _cells(h, cell_bits, return_counts=True)
            bounds = blocks_of(cells)
            for i, j in pairwise(bounds.tolist()):
                out[2].append(_pack_gaps(cells[i:j] & ((1 << block_bits) - 1), n[i:j] > 1))
            out[0] += [row] * (len(bounds) - 1)
            out[1] += (cells[bounds[:-1]] >> block_bits).tolist()
        unit = [documents.column("unit")[0].as_py()] * len(out[0])
        return pa.table([pa.array(c, f.type) for c, f in zip([unit, *out], asked_schema, strict=True)], asked_schema)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each cell of a block that a unit asked about: is it seen twice?"""
        counts = np.zeros(1 << block_bits, np.uint8)
        now, held = None, []

        def answered() -> Iterator[pa.RecordBatch]:
            counts[:] = 0
            for _, data in held:
                cells, repeated = _unpack_gaps(data)
                counts[cells] = np.minimum(counts[cells] + 1 + repeated, 2)
            for lo in range(0, len(held), 1024):
                part = held[lo:lo + 1024]
                bits = [np.packbits(counts[_unpack_gaps(x[1])[0]] > 1, bitorder="little").tobytes() for x in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in part], pa.int64()), pa.array([now[0]] * len(part), pa.int32()),
                     pa.array([now[1]] * len(part), pa.int64()), pa.array(bits, pa.binary())],
                    ["unit", "row", "block", "bits"])

        for b in batches:
            for unit, row, block, data in zip(*(b.column(k).to_pylist() for k in asked_schema.names), strict=True):
                if (row, block) != now:
                    if held:
                        yield from answered()
                    now, held = (row, block), []
                held.append((unit, data))
        if held:
            yield from answered()

    asked = dealt.groupBy("unit").applyInArrow(count, "unit long, row int, block long, cells binary")
    answers = (asked.repartition("row", "block").sortWithinPartitions("row", "block")
               .mapInArrow(answer, "unit long, row int, block long, bits binary"))
    found_schema = pa.schema([("unit", pa.int64()), *(_PACKED if bucket_bits else _CANDIDATE)])

    def candidates(documents: pa.Table, told: pa.Table) -> pa.Table:
        """Windows of a unit whose cells were both seen twice."""
        if not documents.num_rows or not told.num_rows:
            return found_schema.empty_table()
        told = told.sort_by([("row", "ascending"), ("block", "ascending")])
        h1, h2, document, start = hashes(documents)
        again = np.ones(len(h1), bool)
        for row, h in enumerate((h1, h2)):
            cells, which = _cells(h, cell_bits, return_inverse=True)
            bits = told.filter(pc.equal(told["row"], row))["bits"].to_pylist()
            seen = [np.unpackbits(np.frombuffer(x, "u1"), count=n, bitorder="little")
                    for x, n in zip(bits, np.diff(blocks_of(cells)).tolist(), strict=True)]
            again &= np.concatenate(seen).astype(bool)[which]
        at = np.flatnonzero(again)
        if not len(at):
            return found_schema.empty_table()
        found = _settle(h1[at], (h2[at] >> np.uint64(32)).astype(np.uint32), documents["id"].to_numpy()[document[at]],
                        documents["copy"].to_numpy()[document[at]], start[at].astype(np.int32))
        out = _pack_candidates(*found, bucket_bits) if bucket_bits else _candidate_rows(*found)
        unit = pa.array([documents["unit"][0].as_py()] * out.num_rows, pa.int64())
        return pa.table([unit, *out.columns], found_schema)

    return dealt.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(
        candidates, "unit long, " + (_PACKED_DDL if bucket_bits else _CANDIDATE_DDL))


def repeated_windows(found: DataFrame, bucket_bits: int) -> DataFrame:
    """Runs of starts, lo to hi, of windows whose words also start earlier, from
    packed candidates: id, copy, lo, hi, and unit where ``found`` has it."""
    own = [c for c in ("unit",) if c in found.columns]
    schema = pa.schema([*((c, pa.int64()) for c in own), ("id", pa.int64()), ("copy", pa.int64()), ("lo", pa.int32()),
                        ("hi", pa.int32())])

    def of_bucket(packed: pa.Table) -> pa.Table:
        out = []
        units = [packed[c].to_numpy() for c in own]
        rows = [(i, _unpack_open(x, bucket_bits)) for i, x in enumerate(packed["open"].to_pylist()) if x]
        if rows:
            columns = [np.concatenate(x) for x in zip(*(x for _, x in rows), strict=True)]
            source = np.repeat([i for i, _ in rows], [len(x[0]) for _, x in rows])
            del rows
            order, _, later = _by_hash(*columns)
            order = order[later]
            doc, copy, at = (x[order] for x in columns[2:])
            out.append([*(u[source[order]] for u in units), doc, copy, at, at])
        rows = [(i, _unpack_places(x, 2)[0]) for i, x in enumerate(packed["runs"].to_pylist()) if x]
        if rows:
            doc, copy, lo, length = (np.concatenate(x) for x in zip(*(x for _, x in rows), strict=True))
            source = np.repeat([i for i, _ in rows], [len(x[0]) for _, x in rows])
            out.append([*(u[source] for u in units), doc, copy, lo, lo + length - 1])
        return pa.table([pa.array(np.concatenate(c)).cast(f.type) for c, f in zip(
            zip(*out, strict=True), schema, strict=True)], schema)

    return found.groupBy("bucket").applyInArrow(
        of_bucket, "".join(f"{c} long, " for c in own) + "id long, copy long, lo int, hi int")


def _removed(n: int, lows: np.ndarray, highs: np.ndarray, width: int) -> np.ndarray:
    """Which of n words windows starting at lows..highs cover."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, lows, 1)
    np.add.at(edges, np.minimum(highs + width, n), -1)
    return np.cumsum(edges[:n]) > 0


def remove_repeats(docs: DataFrame, width: int = WINDOW_WORDS, keep_layout: bool = False) -> DataFrame:
    """Remove each word covered by a window of ``width`` words that also starts
    earlier (smaller doc_id, or the same document, earlier start), all windows
    judged on the input.

    One row per document row: all columns of ``docs`` but text in the struct
    ``row``, n_words, n_removed, kept_text: the kept words joined by one space,
    or with ``keep_layout`` the text without the removed words and the white
    space before each.

    Null or empty text: no words. Null doc_id: such documents order last.
    Repeated rows (one doc_id and text) are one document, each row with its
    result; different texts under one doc_id order by a hash of the text.
    Fewer words than ``width``: kept. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = keyed_text(docs)
    # Words are at least a byte and a space: an upper bound of windows, in one light pass.
    spaces = F.length("text") - F.length(F.translate("text", " \t\n\u000b\f\r", ""))
    words, size = texts.agg(F.sum(spaces + 1), F.sum(F.octet_length("text"))).first()
    # Between half of CELLS_PER_WINDOW and all of it.
    cell_bits = max(MIN_CELL_BITS, int((words or 0) * CELLS_PER_WINDOW).bit_length() - 1)
    bucket_bits = _bucket_bits(words or 0)
    segments = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

    def cut_text(text: str, lows: np.ndarray, highs: np.ndarray) -> tuple[int, int, bytes]:
        """Words, removed words and what is kept of a text."""
        import re
        data = text.encode()
        words = data.split()
        if not len(lows):
            return len(words), 0, data if keep_layout else b" ".join(words)
        removed = _removed(len(words), lows, highs, width)
        pieces, space = (re.findall(segments.encode(), data), b"") if keep_layout else (words, b" ")
        kept = space.join(p for p, out in zip(pieces, removed.tolist()) if not out) + b"".join(pieces[len(words):])
        return len(words), int(removed.sum()), kept

    names = ["row", "n_words", "n_removed", "kept_text"]

    def result(row: pa.Array, cuts: list[tuple[int, int, bytes]]) -> list[pa.Array]:
        n_words, n_removed, kept = zip(*cuts, strict=True) if cuts else ((), (), ())
        return [row, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string())]

    schema = T.StructType([texts.schema["row"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    none = np.zeros(0, np.int64)
    if 2 << cell_bits <= BROADCAST_BITS:
        found = _candidates_by_broadcast(texts, width, cell_bits, bucket_bits)
        runs = (repeated_windows(found, bucket_bits).groupBy("id", "copy")
                .agg(F.collect_list("lo").alias("lows"), F.collect_list("hi").alias("highs")))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for lo in range(0, whole.num_rows, CUT_ROWS):
                    b = whole.slice(lo, CUT_ROWS)
                    cuts = [cut_text(text.as_py(), *(x.values.to_numpy() if x.is_valid else none for x in found))
                            for text, *found in zip(b.column("text"), b.column("lows"), b.column("highs"), strict=True)]
                    yield pa.RecordBatch.from_arrays(result(b.column("row"), cuts), names)

        return (texts.join(runs, ["id", "copy"], "left").select("row", "text", "lows", "highs")
                .mapInArrow(releasing(cut), schema))

    dealt = _dealt(texts, size or 0)
    runs = repeated_windows(_candidates_by_blocks(dealt, width, cell_bits, bucket_bits), bucket_bits)

    def cut_unit(documents: pa.Table, found: pa.Table) -> pa.Table:
        order = np.lexsort((found["copy"].to_numpy(), found["id"].to_numpy()))
        keys, lows, highs = (x[order] for x in (np.stack([found["id"].to_numpy(), found["copy"].to_numpy()], axis=1),
                                                found["lo"].to_numpy(), found["hi"].to_numpy()))
        new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(keys) else none
        spans = {tuple(keys[i].tolist()): (lows[i:j], highs[i:j]) for i, j in pairwise([*new.tolist(), len(keys)])}
        cuts = [cut_text(t, *spans.get((i, c), (none, none))) for i, c, t in zip(
            *(documents[k].to_pylist() for k in ("id", "copy", "text")), strict=True)]
        return pa.table(result(documents["row"], cuts), names)

    return dealt.groupBy("unit").cogroup(runs.groupBy("unit")).applyInArrow(cut_unit, schema)
