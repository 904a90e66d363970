"""SimHash, substring dedup and components against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from odd_rows import prose

from lakeshore.llm import simhash, substring
from lakeshore.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def union_find(pairs, members):
    parent = {m: m for m in members}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {m: find(m) for m in members}


def plain_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    random.Random(1).shuffle(edges)
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    members = {x for e in edges for x in e}
    assert Counter(tuple(r) for r in got) == Counter(union_find(edges, members).items())


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("members", [1024, 2])
def test_simhash_groups(documents, texts, members, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_MEMBERS", members)
    got = simhash.simhash_groups(documents).collect()
    fps = [plain_fingerprint(t) for _, t in texts]
    linked = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    group = union_find(linked, range(len(fps)))
    least = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            least[group[i]] = min(d, least.get(group[i], d))
    expected = Counter((d, f"{fps[i]:016x}", least.get(group[i])) for i, (d, _) in enumerate(texts))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == expected


@pytest.mark.parametrize("members", [1024, 3])
def test_links_of_dense_fingerprints(spark, members, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_MEMBERS", members)
    r = random.Random(5)
    seeds = [r.getrandbits(64) for _ in range(6)]
    fps = {s ^ sum(1 << r.randrange(64) for _ in range(r.randrange(5))) & (1 << 64) - 1 for s in seeds for _ in range(60)}
    fps = {f - (1 << 64) if f >> 63 else f for f in fps}
    links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    mask = (1 << 64) - 1
    near = [(a, b) for a in fps for b in fps if a < b and ((a ^ b) & mask).bit_count() <= 3]
    assert all(((u ^ v) & mask).bit_count() <= 3 for u, v in links)
    assert union_find(links, fps) == union_find(near, fps)


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError, match="at most three bits"):
        simhash.links(spark.createDataFrame([], "fp long"), max_bits=4)


def test_keep_one_document_of_each_group(documents, no_documents):
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    groups = {(r["doc_id"], r["text_hash"]): r["group"] for r in simhash.simhash_groups(documents).collect()}
    assert kept.count() == len(set(groups.values()))
    assert kept.where("doc_id = 1").count() == 1 and kept.where("doc_id = 2").count() == 0
    assert simhash.keep_one(no_documents).count() == 0


def plain_removal(texts, width):
    """(n_words, n_removed, kept) by row; texts in their order."""
    seen, out = {}, []
    for key, text in texts:
        words = [w.encode() for w in WORD.findall(text)]
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i:i + width])
            if seen.setdefault(window, (key, i)) != (key, i):
                gone[i:i + width] = [True] * width
        out.append((len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("flush", [1 << 21, 64])
def test_substring_dedup(spark, documents, texts, flush, monkeypatch):
    monkeypatch.setattr(substring, "FLUSH_WINDOWS", flush)
    monkeypatch.setattr(substring, "GROUP_WORDS", flush)
    got = substring.remove_repeats(documents).select("row.doc_id", "n_words", "n_removed", "kept_text").collect()
    # A row's key: its id (null last) and a rank of its text; equal keys are one document.
    hashes = {t: spark.sql("SELECT xxhash64(:t)", args={"t": t}).first()[0] for _, t in texts}
    keyed = sorted({((d is None, d or 0), hashes[t], t) for d, t in texts})
    expected = {(k[0], k[2]): r for k, r in zip(keyed, plain_removal([((k[0], k[1]), k[2]) for k in keyed], 20),
                                                strict=True)}
    assert Counter(tuple(r) for r in got) == Counter((d, *expected[(d is None, d or 0), t]) for d, t in texts)


def test_layout_is_kept(documents):
    joined = {(r[0], r[1]) for r in substring.remove_repeats(documents).select("row.doc_id", "kept_text").collect()}
    cut = substring.remove_repeats(documents, keep_layout=True).select("row.doc_id", "kept_text", "n_removed").collect()
    assert {(r[0], " ".join(WORD.findall(r[1]))) for r in cut} == joined
    assert any("\n" in r["kept_text"] for r in cut if r["n_removed"])


def test_a_small_sketch_loses_nothing(documents, monkeypatch):
    plain = Counter(map(str, substring.remove_repeats(documents).select("row.doc_id", "kept_text").collect()))
    monkeypatch.setattr(substring, "CELLS_PER_WINDOW", 1 / 1000)
    assert Counter(map(str, substring.remove_repeats(documents).select("row.doc_id", "kept_text").collect())) == plain


@pytest.mark.parametrize(("cells", "unit", "block", "layout"), [
    (2, 8 << 20, 16, False), (2, 2000, 9, True), (1 / 1000, 2000, 5, False)])
def test_a_sketch_in_blocks_gives_the_same(documents, monkeypatch, cells, unit, block, layout):
    def result():
        rows = substring.remove_repeats(documents, keep_layout=layout)
        assert rows.columns == ["row", "n_words", "n_removed", "kept_text"]
        return Counter(map(str, rows.select("row.doc_id", "n_words", "n_removed", "kept_text").collect()))
    plain = result()
    for name, value in (("CELLS_PER_WINDOW", cells), ("UNIT_BYTES", unit), ("BROADCAST_BITS", 0), ("BLOCK_BITS", block),
                        ("FAR_BLOCKS_BITS", 30), ("_candidates_by_broadcast", None)):
        monkeypatch.setattr(substring, name, value)
    assert result() == plain
    assert substring.remove_repeats(documents.limit(0)).count() == 0


def test_the_sketch_in_blocks_still_filters(spark, monkeypatch):
    """Beyond the broadcast bound few windows that don't repeat pass, and the
    texts go through one exchange."""
    texts = [(i, prose(1000 + i, 400)) for i in range(40)] + [(100, prose(1000, 400))]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(substring, "UNIT_BYTES", 20_000)
    found = substring._candidates_by_blocks(substring._dealt(substring.keyed_text(frame), 100_000), 20, 16)
    windows = sum(max(0, len(t.split()) - 19) for _, t in texts)
    repeated = 2 * (len(prose(1000, 400).split()) - 19)
    n = found.where("settled = 0").count() + (found.where("settled > 0").agg({"settled": "sum"}).first()[0] or 0)
    assert repeated <= n < repeated + 0.2 * windows
    monkeypatch.setattr(substring, "BROADCAST_BITS", 0)
    cut = substring.remove_repeats(frame)
    cut.collect()
    plan = cut._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 2 and plan.count("hashpartitioning(unit") - plan.count("ReusedExchange") == 3  # texts, answers, runs


def test_gaps_round_trip():
    r = np.random.default_rng(5)
    for top, n in ((1 << 16, 900), (1 << 26, 40), (1 << 26, 1), (1 << 40, 30), (700, 700)):
        cells = np.unique(r.integers(0, top, n))
        again = r.random(len(cells)) < 0.3
        got, seen = substring._unpack_gaps(substring._pack_gaps(cells, again))
        assert (got == cells).all() and (seen == again).all()


def test_candidates_round_trip(monkeypatch):
    """Windows and runs come back from their buckets as they were settled, in
    less than 17 bytes a window."""
    r = np.random.default_rng(6)
    n = 30_000
    h1 = r.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)
    h2 = r.integers(0, 1 << 32, n, dtype=np.uint32)
    h1[1000:2000], h2[1000:2000] = h1[:1000], h2[:1000]  # repeats that are settled
    ids = np.sort(r.choice(np.array([-7, 3, 4, 900, 70_000, 1 << 40, (1 << 63) - 1]), n))
    places = [ids, np.where(ids == 4, r.integers(-5, 5, n), 0), np.arange(n, dtype=np.int32)]
    settled = substring._settle(h1, h2, *places)
    rows = substring._candidate_rows(*settled).to_pylist()
    for bits in (8, 13, 16):
        packed = substring._pack_candidates(*settled, bits).to_pylist()
        windows, runs = [], []
        for row in packed:
            if row["open"]:
                first, *rest = substring._unpack_open(row["open"], bits)
                full = first | np.uint64(row["bucket"] << (64 - bits))
                columns = full.view(np.int64), rest[0].view(np.int32), *rest[1:]
                windows += zip(*(x.tolist() for x in columns), strict=True)
            if row["runs"]:
                runs += zip(*(x.tolist() for x in substring._unpack_places(row["runs"], 2)[0]), strict=True)
        assert sorted(windows) == sorted(tuple(x.values())[:5] for x in rows if not x["settled"])
        assert sorted(runs) == sorted(tuple(x.values())[2:] for x in rows if x["settled"])
    assert len(windows) == n - 1000 and sum(x[3] for x in runs) == 1000
    places[1][:] = 0
    dense = substring._pack_candidates(*substring._settle(h1, h2, *places), 8).to_pylist()
    assert sum(len(x["open"]) for x in dense) < 17 * len(windows)


def test_cut_texts_leave_in_small_batches(spark, monkeypatch):
    """Results of a batch are not held whole, and come in the same rows."""
    frame = spark.createDataFrame([(i, prose(i % 30, 40)) for i in range(100)], "doc_id long, text string")
    rows = Counter(map(str, substring.remove_repeats(frame).collect()))
    monkeypatch.setattr(substring, "CUT_ROWS", 7)
    assert Counter(map(str, substring.remove_repeats(frame).collect())) == rows and len(rows) == 100


def test_memory_of_counted_windows(monkeypatch):
    """A task counts cells of four bytes: it held hashes of eight, and sorted a
    copy of them."""
    import tracemalloc
    functions = []

    class Texts:
        def mapInArrow(self, f, _):
            functions.append(f)
            return self

        def select(self, *_):
            return self
        repartition = sortWithinPartitions = select

        def toLocalIterator(self):
            return []

    substring._sketch(Texts(), 20, 28)
    words = " ".join(str(i) for i in range(40_000))
    batches = [pa.record_batch([[i], [0], [f"{i} {words}".replace(" 1", f" {i}")]], ["id", "copy", "text"])
               for i in range(20)]
    list(functions[0](iter(batches[:1])))
    tracemalloc.start()
    cells = sum(len(x) for b in functions[0](iter(batches)) for x in b["cells"].to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert cells > 1_000_000 and peak < 35 * 20 * 40_000, peak


def test_numbers_round_trip():
    r = np.random.default_rng(7)
    for top in (1, 200, 300, 60_000, 70_000, (1 << 64) - 1):
        for n in (1, 500):
            x = r.integers(0, top, n, dtype=np.uint64, endpoint=True)
            data = substring._pack_numbers(x)
            got, end = substring._unpack_numbers(b"ab" + data, n, 2)
            assert (got == x).all() and end == 2 + len(data)


def test_candidates_are_shuffled_by_bucket(spark):
    """The exchange of windows carries packed buckets (24.5 bytes a window were
    shuffled before), and no window function sorts rows."""
    frame = spark.createDataFrame([(i, prose(i % 3, 60)) for i in range(9)], "doc_id long, text string")
    cut = substring.remove_repeats(frame)
    assert cut.where("n_removed > 0").count() == 6
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(bucket" in plan and "Window" not in plan


@pytest.mark.parametrize(("broadcast", "bits"), [(1 << 29, 0), (0, 0), (1 << 29, 12)])
def test_windows_meet_over_tasks(spark, monkeypatch, broadcast, bits):
    """Repeats within and over tasks, whatever the number of buckets."""
    texts = [(i % 50, prose(i % 9, 60) + " " + prose(500 + i % 50, 30)) for i in range(80)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(substring, "BROADCAST_BITS", broadcast)
    monkeypatch.setattr(substring, "UNIT_BYTES", 4000)
    if bits:
        monkeypatch.setattr(substring, "MIN_BUCKET_BITS", bits)
    hashes = {t: spark.sql("SELECT xxhash64(:t)", args={"t": t}).first()[0] for _, t in texts}
    keyed = sorted({(d, hashes[t], t) for d, t in texts})
    expected = {(k[0], k[2]): r for k, r in zip(keyed, plain_removal([(k[:2], k[2]) for k in keyed], 20), strict=True)}
    got = substring.remove_repeats(frame).select("row.doc_id", "n_words", "n_removed", "kept_text").collect()
    assert Counter(map(tuple, got)) == Counter((d, *expected[d, t]) for d, t in texts)


def test_sketch_cells_round_trip():
    r = random.Random(3)
    for n in (1, 2, 500, 60_000):
        cells = np.array(sorted(r.sample(range(1 << 16), n)))
        twice = np.array([r.random() < 0.3 for _ in range(n)])
        got, again = substring._unpack_cells(substring._pack_cells(cells, twice))
        assert got.tolist() == cells.tolist() and again.tolist() == cells[twice].tolist()


def test_substring_dedup_of_nothing(no_documents):
    assert substring.remove_repeats(no_documents).count() == 0


def test_digest_of_kept_words(documents):
    r = substring.remove_repeats(documents).where("row.doc_id = 8").first()
    assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == hashlib.sha256(b"one").hexdigest()
