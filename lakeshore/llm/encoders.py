"""Whole-text encoding through the public tokenizer libraries, with a memo of
the pieces already encoded.

Texts are cut only where the tokenizers' own pre-tokenisation always cuts:
in front of white space that follows another character, in front of a space
that a word follows, and behind a single newline between words. So the ids of
the pieces, one behind the other, are the ids of the whole text. A text that
holds the text of a special token goes through the library as a whole.

A group of texts is handled as arrays: cuts are found in the Arrow buffer, the
pieces are dictionary-encoded where they lie, only the group's distinct pieces
are looked up (and encoded if they are new), and ids are gathered into one
array with an offset for each text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of a worker's memo, as estimated; beyond it new pieces are encoded
# again in every group that has them, which costs time, never results.
MEMO_BYTES = 224 << 20
ENTRY_BYTES = 190  # of a memo entry, besides the piece and its ids
# A full memo that misses this share of a group's distinct pieces is emptied.
STALE_SHARE = 0.6
# Texts are worked on in groups of about this many bytes.
GROUP_BYTES = 8 << 20

_SPACE, _NEWLINE, _OTHER_WHITE, _UNSURE = 1, 2, 3, 4
_WHITE = np.zeros(256, np.uint8)
_WHITE[[0x09, 0x0B, 0x0C, 0x0D]] = _OTHER_WHITE
_WHITE[0x20], _WHITE[0x0A] = _SPACE, _NEWLINE
# Regular expressions disagree on these: never cut beside them.
_WHITE[0x1C:0x20] = _UNSURE
_WIDE_KIND = {chr(c).encode(): _OTHER_WHITE for c in (
    0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}
_WIDE_KIND |= {chr(c).encode(): _UNSURE for c in (0x85, 0x180E)}
_WIDE_FIRST = np.zeros(256, bool)
_WIDE_FIRST[[c[0] for c in _WIDE_KIND]] = True
# Where a text may always be cut: a space between printable ASCII characters.
_PLAIN_SPACE = re.compile(rb"(?<=[!-~]) (?=[!-~])")


def white_space(data: np.ndarray) -> np.ndarray:
    """Of each byte: 0, or the kind of white space it belongs to."""
    kind = _WHITE[data]
    wide = np.flatnonzero(_WIDE_FIRST[data])
    for width in (2, 3):
        at = wide[wide + width <= len(data)]
        at = at[(data[at] < 0xE0) == (width == 2)]
        if len(at):
            found, which = np.unique(data[at[:, None] + np.arange(width)], axis=0, return_inverse=True)
            own = np.array([_WIDE_KIND.get(bytes(c), 0) for c in found], np.uint8)[which.ravel()]
            for i in range(width):
                kind[at[own > 0] + i] = own[own > 0]
    return kind


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin that lie one behind the other in
    ``data``, text i between offsets[i] and offsets[i + 1]."""
    kind = white_space(data)
    first = np.zeros(len(data) + 1, bool)  # a text begins here
    first[offsets] = True
    word = kind == 0
    word_before = np.r_[False, word[:-1]]
    cut = ~word & (kind != _UNSURE) & word_before             # white space behind a character
    spaced = np.flatnonzero((kind[:-1] == _SPACE) & word[1:] & ~first[1:-1])
    cut[spaced] = True                                        # the space in front of a word
    lines = np.flatnonzero((kind[1:-1] == _NEWLINE) & word[:-2] & word[2:] & ~first[1:-2] & ~first[2:-1])
    cut[lines + 2] = True                                     # behind a newline between words
    cut |= first[:-1]
    return np.flatnonzero(cut)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all runs, run i being lengths[i] numbers from starts[i]."""
    bounds = np.cumsum(lengths)
    return np.repeat(starts - (bounds - lengths), lengths) + np.arange(bounds[-1] if len(bounds) else 0)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) with ``end_id`` behind each text."""
    return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))


class PieceMemo:
    """Encode texts to arrays of ids.

    ``encode_pieces`` gives the ids of each of a list of pieces;
    ``encode_whole`` those of a whole text that holds one of ``specials``;
    ``memo_bytes``: another bound than MEMO_BYTES."""

    def __init__(self, encode_pieces: Callable[[list[str]], Iterable[list[int]]],
                 encode_whole: Callable[[str], list[int]] | None = None, specials: Iterable[str] = (),
                 memo_bytes: int | None = None):
        self.encode_pieces, self.encode_whole, self.specials = encode_pieces, encode_whole, list(specials)
        self.memo_bytes = memo_bytes
        self._empty()

    def _empty(self) -> None:
        self.slot_of: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.used, self.bytes = 0, 0

    def _encode_new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece)."""
        found = list(self.encode_pieces([p.decode() for p in pieces]))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _remember(self, pieces: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, slot = len(pieces), len(self.slot_of)
        while slot + n > len(self.starts):
            self.starts, self.lengths = (np.r_[x, np.zeros_like(x)] for x in (self.starts, self.lengths))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[slot:slot + n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[slot:slot + n] = lengths
        self.slot_of.update(zip(pieces, range(slot, slot + n), strict=True))
        self.used += len(ids)
        self.bytes += ENTRY_BYTES * n + sum(map(len, pieces)) + 4 * len(ids)

    def _known(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths): where the ids of each piece lie."""
        slots = np.fromiter(map(self.slot_of.get, pieces, [-1] * len(pieces)), np.int64, len(pieces))
        new = np.flatnonzero(slots < 0)
        if not len(new):
            return self.ids, self.starts[slots], self.lengths[slots]
        fresh = [pieces[i] for i in new]
        ids, lengths = self._encode_new(fresh)
        most = MEMO_BYTES if self.memo_bytes is None else self.memo_bytes
        if self.bytes > most and len(new) > STALE_SHARE * len(pieces):
            known = np.flatnonzero(slots >= 0)
            old = self.starts[slots[known]], self.lengths[slots[known]]
            kept = self.ids[ragged(*old)]
            self._empty()
            self._remember([pieces[i] for i in known], kept, old[1])
            slots[known] = np.arange(len(known))
        if self.bytes <= most:
            slots[new] = np.arange(len(self.slot_of), len(self.slot_of) + len(new))
            self._remember(fresh, ids, lengths)
            return self.ids, self.starts[slots], self.lengths[slots]
        # No room: the memo's ids and the new ones side by side, for this group.
        starts, sizes = self.starts[slots], self.lengths[slots]
        starts[new] = self.used + np.cumsum(lengths) - lengths
        sizes[new] = lengths
        return np.r_[self.ids[:self.used], ids], starts, sizes

    def _group(self, texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        starts = piece_starts(data, offsets[:-1])
        bounds = np.r_[starts, len(data)]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        which = coded.indices.to_numpy()
        ids, at, n = self._known(coded.dictionary.to_pylist())
        n = n[which]
        ends = np.r_[0, np.cumsum(n)]
        return ids[ragged(at[which], n)], ends[np.searchsorted(starts, offsets)]

    def _long(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """A very long text in parts, cut at a space between words."""
        out, at = [], 0
        while at < len(text):
            cut = _PLAIN_SPACE.search(text, at + GROUP_BYTES)
            end = cut.start() if cut else len(text)
            out.append(self._group(pa.array([text[at:end]], pa.large_binary()))[0])
            at = end
        ids = np.concatenate(out)
        return ids, np.array([0, len(ids)])

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, offsets) of consecutive texts of a string column, null as
        empty: text i of a group has ids[offsets[i]:offsets[i + 1]]."""
        column = column.cast(pa.large_string()).fill_null("")
        special = np.zeros(len(column), bool)
        for s in self.specials:
            special |= pc.match_substring(column, s, ignore_case=True).to_numpy(zero_copy_only=False)
        texts = column.cast(pa.large_binary())
        size = pc.binary_length(texts).to_numpy()
        alone = special | (size > GROUP_BYTES)
        # A new group at every text that stands alone, behind it, and where a group is full.
        full = np.cumsum(size) // GROUP_BYTES
        edge = np.flatnonzero(alone[1:] | alone[:-1] | (full[1:] != full[:-1])) + 1
        bounds = [0, *edge.tolist(), len(column)] if len(column) else []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if special[lo]:
                ids = np.array(self.encode_whole(column[lo].as_py()), np.uint32)
                yield ids, np.array([0, len(ids)])
            elif alone[lo]:
                yield self._long(texts[lo].as_py())
            else:
                yield self._group(texts.slice(lo, hi - lo))


_MEMOS: dict[str, PieceMemo] = {}

# One pre-token for either json tokenizer: letters that no normalisation
# changes but for their case, behind at most one space.
_ONE_PRETOKEN = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)").fullmatch


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies (fixed by their format): itself if printable in Latin-1,
    otherwise the next one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in out:
            out[b] = chr(0x100 + len(out) - len(printable))
    return [out[b] for b in range(256)]


def json_tokenizer_memo(serialized: bytes, memo_bytes: int | None = None) -> PieceMemo:
    """The worker's memo over a tokenizers-library file given as its bytes.

    A piece that is one pre-token goes straight to the library's model, which
    costs half of the whole way; all others go the whole way."""
    key = f"{hashlib.sha256(serialized).hexdigest()} {memo_bytes}"
    if key not in _MEMOS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_buffer(serialized)
        letters = byte_letters()
        model, lower = tokenizer.model, tokenizer.normalizer is not None

        def spelled(pretoken: re.Match) -> str:
            """The pre-token as the model gets it."""
            text = pretoken[2].lower() if lower else pretoken[0]
            return text if text.isascii() and text[0] != " " else "".join([letters[b] for b in text.encode()])

        def whole_way(pieces: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

        def encode_pieces(pieces: list[str]) -> list[list[int]]:
            if not short_cut:
                return whole_way(pieces)
            pretokens = list(map(_ONE_PRETOKEN, pieces))
            rest = iter(whole_way([p for p, m in zip(pieces, pretokens, strict=True) if m is None]))
            return [next(rest) if m is None else [t.id for t in model.tokenize(spelled(m))] for m in pretokens]

        # Any other kind of tokenizer file takes the whole way.
        probe = ["word", " word", " Wörter", "Été", " naïvetés", "ABC", " unforeseeable", "ÿ", " Ø"]
        short_cut = [[t.id for t in model.tokenize(spelled(_ONE_PRETOKEN(p)))] for p in probe] == whole_way(probe)

        def encode_whole(text: str) -> list[int]:
            return tokenizer.encode(text, add_special_tokens=False).ids

        specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        _MEMOS[key] = PieceMemo(encode_pieces, encode_whole, specials, memo_bytes)
    return _MEMOS[key]


def memo_of(key: str, make: Callable[[], PieceMemo]) -> PieceMemo:
    """The worker's memo called ``key``, made on first use."""
    if key not in _MEMOS:
        _MEMOS[key] = make()
    return _MEMOS[key]
