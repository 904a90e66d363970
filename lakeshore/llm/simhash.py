"""SimHash near-duplicates by deletion-variant signatures (operator 3).

Fingerprints within three bits of each other agree up to one bit in one of
their two 32-bit halves. Each distinct fingerprint is therefore indexed under
64 variants, a half with one bit as wildcard; fingerprints that share a variant
are compared. Buckets that hold many fingerprints are split once more over the
half not yet fixed (its two 16-bit quarters with a wildcard, then the 8-bit
parts of the other quarter), which loses no link and leaves at most 2^11
fingerprints in a bucket. A bucket emits a spanning forest of its links, not
its pairs; components over the links name each group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeshore.llm.common import doc_text, hex64, matched, releasing, saved, ship
from lakeshore.llm.components import components
from lakeshore.plans.joins import sized_broadcast

MAX_BITS = 3
# Larger buckets are split; any value gives the same links.
BUCKET_MEMBERS = 1024
HASH_SEED = 42

_LOWER = bytes(range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, shingle: int) -> int:
    """SimHash of a text's word shingles as a signed 64-bit integer."""
    import xxhash
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = ends - [len(w) + 1 for w in words]
    k = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e], HASH_SEED) for s, e in
                       zip(starts[:len(words) - k + 1].tolist(), (ends[k - 1:] - 1).tolist(), strict=True)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)
    return int.from_bytes(np.packbits(majority).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; text_hash tells rows of one
    doc_id apart."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fps, pa.int64())],
                                             ["doc_id", "text_hash", "fp"])

    return (doc_text(docs).withColumn("text_hash", F.xxhash64("text"))
            .mapInArrow(releasing(run), "doc_id long, text_hash long, fp long"))


def spanning_links(fps: list[int], max_bits: int) -> list[tuple[int, int]]:
    """Edges that connect everything in ``fps`` linked within ``max_bits``,
    directly or through others of the list; at most one less than its size."""
    mask = (1 << 64) - 1
    if len(fps) <= 12:
        links, left = [], list(fps)
        while left:
            frontier = [left.pop()]
            while frontier:
                a = frontier.pop()
                near = [b for b in left if ((a ^ b) & mask).bit_count() <= max_bits]
                if near:
                    left = [b for b in left if b not in near]
                    links += [(a, b) for b in near]
                    frontier += near
        return links
    links, left = [], np.array(fps, np.int64)
    while len(left):
        frontier, left = [left[-1]], left[:-1]
        while frontier and len(left):
            a = frontier.pop()
            near = np.bitwise_count((left ^ a).view(np.uint64)) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                links += [(int(a), int(b)) for b in found]
                frontier += list(found)
    return links


def _link_buckets(members: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    """Spanning links of each bucket (of bounded size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            links = [link for fps in b.column("fps").to_pylist() for link in spanning_links(fps, max_bits)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()),
                                              pa.array([x[1] for x in links], pa.int64())], ["u", "v"])
    return members.groupBy(*keys).agg(F.collect_list("fp").alias("fps")).select("fps").mapInArrow(
        run, "u long, v long")


def _variants(frame: DataFrame, name: str, low_bit: str, width: int) -> DataFrame:
    """Index each row under one-wildcard variants of the two ``width``-bit
    parts that start at bit ``low_bit`` (an SQL expression): the part's number,
    the wildcard's place and the part without that bit."""
    part, bit = f"shiftright(__j, {width.bit_length() - 1})", f"(__j & {width - 1})"
    value = f"(shiftrightunsigned(fp, CAST({low_bit} + {width} * {part} AS INT)) & {(1 << width) - 1}L)"
    variant = f"({value} & ~shiftleft(1L, {bit})) | shiftleft(CAST({bit} AS BIGINT), {width}) | " \
              f"shiftleft(CAST({part} AS BIGINT), {width + 5})"
    return frame.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(2 * width - 1)))).withColumn(
        name, F.expr(variant))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): links among distinct fingerprints ``fps`` (column fp) that
    connect all of them within ``max_bits`` bits of each other."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("two halves with one wildcard find links of at most three bits")
    # Each fingerprint becomes 64 rows: spread them before, and don't let the
    # small table they come from be merged into a few tasks. (By "fp" itself
    # the planner would drop the exchange in favour of the one below it.)
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, keys, frame = [], [], fps.repartition(spread, F.xxhash64("fp"))
    # Free bits before each split: both halves; the other half; its other quarter.
    levels = [("k1", "0", 32),
              ("k2", "32 * (1 - shiftright(k1, 37))", 16),
              ("k3", "32 * (1 - shiftright(k1, 37)) + 16 * (1 - shiftright(k2, 21))", 8)]
    for depth, (name, low_bit, width) in enumerate(levels):
        keys = [*keys, name]
        members = _variants(frame, name, low_bit, width).select(*keys, "fp")
        sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        last = depth == len(levels) - 1
        small = sizes if last else sizes.where(F.col("__n") <= BUCKET_MEMBERS)
        # Merged: Spark takes the rows of an explode for as many as before it, and would broadcast them.
        parts.append(_link_buckets(members.hint("merge").join(small.select(*keys), keys), keys, max_bits))
        if last:
            break
        large = saved(sizes.where(F.col("__n") > BUCKET_MEMBERS).select(*keys), "large-buckets")
        if large.isEmpty():
            break
        # At most one key for each BUCKET_MEMBERS rows.
        frame = members.join(sized_broadcast(large), keys)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document row: doc_id, text_hash, fingerprint (16 hex
    digits), group (a number of the group), component_id (smallest doc_id of
    its group).

    Null or empty text: fingerprint zero, linked like any other. Null doc_id:
    kept; component_id is null only where no member has a doc_id. Repeated rows
    are kept. An empty table gives no rows.
    """
    rows = saved(fingerprints(docs, shingle), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    groups = components(links(classes.select("fp"), max_bits))
    named = (classes.join(groups, classes["fp"] == groups["vertex"], "left")
             .select("fp", "first_id", F.coalesce("component", "fp").alias("component")))
    first = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_fp = named.join(first, "component").select("fp", F.col("component").alias("group"), "component_id")
    return rows.hint("merge").join(of_fp, "fp").select(
        "doc_id", "text_hash", hex64(F.col("fp")).alias("fingerprint"), "group", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs``, all columns, without all but one document of each group: the
    one of smallest doc_id (a null after all others; ties by a hash of the
    text; of repeated rows one)."""
    groups = saved(simhash_groups(docs, shingle, max_bits), "groups")
    place = F.row_number().over(Window.partitionBy("group").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash"))
    first = groups.withColumn("place", place).where("place = 1").select("doc_id", "text_hash")
    kept = matched(docs, first, "left_semi")
    repeated = groups.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return kept
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return kept.withColumn("__hash", text_hash).dropDuplicates(["doc_id", "__hash"]).drop("__hash")
