"""Packing, token files and byte BPE against the libraries themselves."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from lakeshore.llm import bpe, encoders, packing, token_files
from lakeshore.llm.common import tokenizer_bytes
from lakeshore.session import scratch_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


SPECIAL_TEXTS = ["hello <|endoftext|> world <|startoftext|>", "a  <|endoftext|>  b\n<|ENDOFTEXT|>", "<|endoftext|>"]


def random_texts():
    """White space of all kinds, marks, joiners, control characters, contractions."""
    r = random.Random(11)
    parts = ["a", "Word", "été", "ß", "Ünter", "it's", "we'll", "'s", "12", "½", "!", "...", "日本", "e\u0301", "\u0301",
             "\u200d", "\U0001f600", " ", " ", " ", "  ", "\n", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c",
             "\x1f", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b",
             "\ufeff", "Σ", "İ", "ǅ", "\x00", "_", "<", "|", ">"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 30))) for _ in range(1500)]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_memo_equals_whole_text(path, texts, monkeypatch):
    plain = Tokenizer.from_file(path)
    every = [t for _, t in texts] + SPECIAL_TEXTS + random_texts() + [None, "", "é" * 3000 + " x"]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in every]
    for memo_bytes, group_bytes in ((encoders.MEMO_BYTES, encoders.GROUP_BYTES), (30_000, 4_000), (0, 500)):
        monkeypatch.setattr(encoders, "MEMO_BYTES", memo_bytes)
        monkeypatch.setattr(encoders, "GROUP_BYTES", group_bytes)
        encoders._MEMOS.clear()
        memo = encoders.json_tokenizer_memo(tokenizer_bytes(path))
        for _ in range(2):
            got = [ids[i:j].tolist() for ids, offsets in memo.encode(pa.array(every)) for i, j in pairwise(offsets)]
            assert got == want
        assert memo.bytes <= memo_bytes + 200 * group_bytes
    encoders._MEMOS.clear()


def test_other_tokenizer_files_take_the_whole_way():
    from tokenizers import models, pre_tokenizers
    words = Tokenizer(models.WordLevel({"word": 0, "?": 1}, unk_token="?"))
    words.pre_tokenizer = pre_tokenizers.Whitespace()
    memo = encoders.json_tokenizer_memo(words.to_str().encode())
    [(ids, offsets)] = memo.encode(pa.array(["word other word", None]))
    assert ids.tolist() == [0, 1, 0] and offsets.tolist() == [0, 3, 3]


def test_packing(documents, texts):
    rows = packing.pack(documents, tokenizer_bytes(BYTE_BPE), end_id=1, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append(r)
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    expected = Counter()
    for doc_id, text in texts:
        ids = [*library_ids(BYTE_BPE, text), 1]
        expected[doc_id, len(ids)] += 1
        assert all(crc(ids[r["start"]:r["start"] + r["length"]]) == r["ids_crc32"] for r in pieces[doc_id, len(ids)])
    assert {k: sum(r["length"] for r in own) for k, own in pieces.items()} == {
        (d, n): n * k for (d, n), k in expected.items()}
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == own[0]["sequence_tokens"] <= 2048 and not at & (at - 1)
    loads = Counter()
    for own in sequences.values():
        loads[own[0]["step_group"]] += own[0]["sequence_tokens"]
    assert max(loads.values()) <= packing.STEP_TOKENS + 2048


def test_packing_in_small_chunks_keeps_every_id():
    # Null and real ids of equal lengths, and a zero id beside null ones.
    lengths = [1, 5000, 300, 2048, 2047, 17, 900, 256, 3, 300, 300, 300, 17, 17]
    encoded = [(None if n >= 10 else n, np.zeros(k, "<u4")) for n, k in enumerate(lengths)]
    packing_rows = list(packing.pack_documents(iter(encoded), (256, 512, 1024, 2048), 4096, 0))
    assert sum(r[2] for r in packing_rows) == sum(lengths)
    held = packing.CHUNK_TOKENS
    try:
        packing.CHUNK_TOKENS = 1000
        again = list(packing.pack_documents(iter(encoded), (256, 512, 1024, 2048), 4096, 0))
    finally:
        packing.CHUNK_TOKENS = held
    for rows in (packing_rows, again):
        seen = defaultdict(list)
        for r in rows:
            seen[r[0]].append((r[1], r[2]))
        for i in range(10):
            at = 0
            for start, n in sorted(seen[i]):
                assert start == at
                at += n
            assert at == lengths[i]
        assert sum(n for _, n in seen[None]) == sum(lengths[10:])


def test_packing_null_ids_that_tie(spark):
    rows = [(None, "same text"), (5, "same text"), (None, "same text"), (0, "same text"), (None, "same text two")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = packing.pack(frame, tokenizer_bytes(BYTE_BPE), 1).groupBy("doc_id").sum("length").collect()
    n, m = (len(library_ids(BYTE_BPE, t)) + 1 for t in ("same text", "same text two"))
    assert {r[0]: r[1] for r in got} == {None: 3 * (2 * n + m), 5: 3 * n, 0: 3 * n}


def test_special_tokens_as_the_library_does(spark):
    frame = spark.createDataFrame(list(enumerate(SPECIAL_TEXTS)), "doc_id long, text string")
    packed = packing.pack(frame, tokenizer_bytes(BYTE_BPE), 1, with_ids=True).collect()
    for i, text in enumerate(SPECIAL_TEXTS):
        own = sorted((r for r in packed if r["doc_id"] == i), key=lambda r: r["start"])
        assert np.frombuffer(b"".join(bytes(r["ids"]) for r in own), "<u4").tolist() == [*library_ids(BYTE_BPE, text), 1]
    folder = scratch_dir(spark, "test-token-files")
    token_files.write_token_files(frame, folder, tokenizer_bytes(WORD_BPE), 2)
    got = {r["doc_id"]: r["ids"] for r in token_files.read_token_files(spark, folder, with_ids=True).collect()}
    assert got == {i: [*library_ids(WORD_BPE, t), 2] for i, t in enumerate(SPECIAL_TEXTS)}


def test_packing_rejects_other_sizes(documents):
    with pytest.raises(ValueError, match="powers of two"):
        packing.pack(documents, b"", 1, sizes=(100, 2048))


def test_packing_nothing(no_documents):
    assert packing.pack(no_documents, tokenizer_bytes(BYTE_BPE), 1).count() == 0


@pytest.mark.parametrize("width", [2, 4])
def test_token_files(spark, documents, texts, width):
    folder = scratch_dir(spark, "test-token-files")
    manifest = token_files.write_token_files(documents, folder, tokenizer_bytes(WORD_BPE), 2, id_bytes=width)
    rows = token_files.read_token_files(spark, folder, with_ids=True).collect()
    assert sum(m["docs"] for m in manifest) == len(rows) == len(texts)
    expected = Counter((d, tuple([*library_ids(WORD_BPE, t), 2])) for d, t in texts)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == expected
    rows.sort(key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(r["ids"]), crc(r["ids"]))
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_token_files_nothing(spark, no_documents):
    folder = scratch_dir(spark, "test-token-files")
    assert token_files.write_token_files(no_documents, folder, tokenizer_bytes(WORD_BPE), 2) == []
    assert token_files.read_token_files(spark, folder).count() == 0


def test_byte_bpe(documents, texts):
    vocabulary = tokenizer_bytes(RANKS)
    ranks = bpe.read_ranks(vocabulary)
    assert ranks[base64.b64decode(vocabulary.split()[0])] == int(vocabulary.split()[1])
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.byte_bpe(documents, vocabulary, public_tokenizers.PATTERN).collect()
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in got) == Counter(
        (d, tuple(library.encode_ordinary(t)), t.encode()) for d, t in texts)
    digests = bpe.byte_bpe_digests(documents, vocabulary, public_tokenizers.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert Counter(tuple(r) for r in digests) == Counter(
        (d, len(i), sha(",".join(map(str, i)).encode()), sha(t.encode()))
        for d, t in texts for i in [library.encode_ordinary(t)])


def test_byte_bpe_nothing(no_documents):
    assert bpe.byte_bpe(no_documents, tokenizer_bytes(RANKS), public_tokenizers.PATTERN).count() == 0


def test_whole_pretoken_that_merges_do_not_reach():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"de": 257}
    coder = bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "abcde", "de", "é abc"):
        ids = coder.encode_pieces([text])[0]
        assert ids == library.encode_ordinary(text)
        assert coder.decode(tuple(ids)) == text.encode()
