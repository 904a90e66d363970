"""Byte-level BPE encoding and decoding (operator 10).

A sentencepiece BPE model is serialised straight from a rank vocabulary: every
token becomes a piece of printable characters, one per byte, scored by its
negative rank, under identity normalisation, so that the model joins the pair
of lowest rank first. Pre-tokens are looked up whole and otherwise encoded by
the model; decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeshore.llm.common import doc_text, ship
from lakeshore.llm.encoders import PieceMemo, memo_of

# Fixed values of the sentencepiece model file: field numbers and enum values.
NORMAL_PIECE, UNKNOWN_PIECE = 1, 2
BPE_MODEL = 2
# Pieces before the vocabulary: the unknown piece that every model must have.
FIRST_ID = 1


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file with one ``base64(token) rank`` per line."""
    return {base64.b64decode(token): int(rank) for token, rank in
            (line.split() for line in vocabulary.splitlines() if line.strip())}


def byte_letters() -> str:
    """256 distinct characters, none of them white space: byte b stands as
    letter b (any fixed one-to-one map serves; this one starts at U+4E00)."""
    return "".join(chr(0x4E00 + b) for b in range(256))


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model; piece id = FIRST_ID + position in rank order."""
    letters = byte_letters()

    def piece(text: str, score: float, kind: int) -> bytes:
        return _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece("<unk>", 0.0, UNKNOWN_PIECE)]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        pieces.append(piece("".join(letters[b] for b in token), -float(rank), NORMAL_PIECE))
    none = (1 << 64) - 1  # -1: the model has no such piece
    trainer = _number(3, BPE_MODEL) + _number(4, len(pieces)) + _number(40, 0) + b"".join(
        _number(field, none) for field in (41, 42, 43))
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _block(2, trainer) + _block(3, normalizer)


class ByteBpe:
    """Encoder and decoder over ranks, by a sentencepiece model of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece
        self.ranks = ranks
        self.pretokens = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.by_piece = [-1] * FIRST_ID + sorted(ranks.values())
        self.token_of = {rank: token for token, rank in ranks.items()}
        self.letters = byte_letters()

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each string: of its pre-tokens one by one."""
        split = [[p.encode() for p in self.pretokens(w)] for w in pieces]
        unknown = list({p for w in split for p in w if p not in self.ranks})
        spelled = ["".join(map(self.letters.__getitem__, p)) for p in unknown]
        ids = {p: [self.by_piece[i] for i in got]
               for p, got in zip(unknown, self.model.encode(spelled, num_threads=1) if spelled else [], strict=True)}
        return [[i for p in w for i in ((self.ranks[p],) if p in self.ranks else ids[p])] for w in split]

    def table(self, of_token: Callable[[int, bytes], bytes]) -> pa.Array:
        """A byte string for each id (null: no token has it)."""
        return pa.array([None if i not in self.token_of else of_token(i, self.token_of[i])
                         for i in range(max(self.token_of) + 1)], pa.large_binary())

    def decode(self, ids: tuple[int, ...]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


def _strung(table: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> tuple[memoryview, list[int]]:
    """The table's strings of all ids behind one another, and where each text's begin."""
    got = table.take(pa.array(ids))
    bounds = np.frombuffer(got.buffers()[1], np.int64)
    return memoryview(got.buffers()[2] or b""), bounds[offsets].tolist() if len(ids) else [0] * len(offsets)


def byte_bpe(docs: DataFrame, vocabulary: bytes, pattern: str) -> DataFrame:
    """Encode every whole text and decode it again.

    Returns doc_id, ids (array<int>) and decoded (binary) per row. Null or
    empty text: no ids. Null doc_id, repeated rows: kept. Empty table: no rows.
    """
    def rows(doc_ids, ids, offsets, tables):
        data, at = _strung(tables["bytes"], ids, offsets)
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32))),
             pa.array([bytes(data[i:j]) for i, j in pairwise(at)], pa.binary())], ["doc_id", "ids", "decoded"])
    return _over_texts(docs, vocabulary, pattern, rows, "doc_id long, ids array<int>, decoded binary")


def byte_bpe_digests(docs: DataFrame, vocabulary: bytes, pattern: str) -> DataFrame:
    """As :func:`byte_bpe`, with digests in place of ids and bytes: doc_id,
    n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256."""
    def rows(doc_ids, ids, offsets, tables):
        digests = []
        for name, behind in (("decimals", 1), ("bytes", 0)):  # a comma follows each number
            data, at = _strung(tables[name], ids, offsets)
            digests.append([hashlib.sha256(data[i:max(i, j - behind)]).hexdigest() for i, j in pairwise(at)])
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(np.diff(offsets), pa.int64()), *(pa.array(d, pa.string()) for d in digests)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _over_texts(docs, vocabulary, pattern, rows,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _over_texts(docs: DataFrame, vocabulary: bytes, pattern: str, rows: Callable, schema: str) -> DataFrame:
    ship(docs.sparkSession)
    key = hashlib.sha256(vocabulary + pattern.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make() -> PieceMemo:
            bpe = ByteBpe(read_ranks(vocabulary), pattern)
            memo = PieceMemo(bpe.encode_pieces)
            memo.tables = {"decimals": bpe.table(lambda i, _: b"%d," % i), "bytes": bpe.table(lambda _, token: token)}
            return memo
        memo = memo_of(key, make)
        for b in batches:
            done = 0
            for ids, offsets in memo.encode(b.column("text")):
                n = len(offsets) - 1
                yield rows(b.column("doc_id").slice(done, n), ids, offsets, memo.tables)
                done += n

    return doc_text(docs).mapInArrow(run, schema)


__all__ = ["byte_bpe", "byte_bpe_digests", "sentencepiece_model", "read_ranks", "ByteBpe"]
