"""Source divergence audit (operator 12): which sources of a language differ
most, and by which terms.

Counting is a token-start pointer sort. A task walks slices of whole documents
over their Arrow buffers, marks every word start (never copying a word) and
sorts the pointers with a multikey quicksort whose characters are slices of 8
bytes: one level orders all segments by their slice at once, and only segments
of equal slices whose words go on are sorted one slice deeper. A run of equal
words then yields document frequency and count for each (lang, source) of the
slice, so a very common word costs a task one row a source, whatever its count.

Spark adds up the runs by (lang, term), drops rare terms and stores the rest
once. Divergences are exact integers. Those of pairs of sources are summed over
buckets of terms as small matrices, in blocks of at most ``SOURCE_BLOCK``
sources a side; what no source of either block says is added in closed form.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshore.llm.common import saved, ship
from lakeshore.plans.joins import lookup_join

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
# Bytes of text sorted together; a longer document is cut between words.
SLICE_BYTES = 16 << 20
# From this slice on, what is left of equal words is sorted as byte strings.
DEEP = 4
SOURCE_BLOCK = 256
BUCKET_ROWS = 1 << 15

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
# Keeps the first k bytes of a big-endian slice.
_HEAD = np.array([(2 ** 64 - 1) ^ (2 ** (64 - 8 * k) - 1) for k in range(9)], np.uint64)


def word_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, documents) of all words of texts that lie one behind
    the other in ``data``, text i between offsets[i] and offsets[i + 1]."""
    letter = np.zeros(len(data) + 1, bool)
    letter[:-1] = _LETTER[data]
    first = np.zeros(len(data) + 1, bool)  # a text begins here
    first[offsets[:-1]] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = letter[:-1]
    starts = np.flatnonzero(letter & (first | ~before))
    ends = np.flatnonzero(before & (first | ~letter))
    documents = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    return starts, ends - starts, documents


def sort_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, term): the pointers in the order of their words, equal ones as
    they came, and for each of them in that order the number of its word.
    ``data`` has 8 spare bytes at its end. No word holds a zero byte, so a word
    that ends inside a slice differs from all that go on."""
    slices = _slices(data, starts, lengths)
    order = np.argsort(slices, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = slices[order[1:]] != slices[order[:-1]]
    for depth in range(1, DEEP + 1):
        segment, heads = np.cumsum(new) - 1, np.flatnonzero(new)
        size = np.diff(np.r_[heads, len(order)])
        goes_on = (size > 1) & (np.maximum.reduceat(lengths[order], heads) > 8 * depth)
        open_at = np.flatnonzero(goes_on[segment])
        if not len(open_at):
            return order, segment
        own, inside = order[open_at], segment[open_at]
        if depth < DEEP:
            keys = _slices(data, starts[own] + 8 * depth, lengths[own] - 8 * depth)
        else:
            tails = [bytes(data[s + 8 * depth:s + n]) for s, n in zip(starts[own], lengths[own], strict=True)]
            number = {t: i for i, t in enumerate(sorted(set(tails)))}
            keys = np.array([number[t] for t in tails])
        by = np.lexsort((keys, inside))
        order[open_at], keys, inside = own[by], keys[by], inside[by]
        new[open_at[1:]] |= (keys[1:] != keys[:-1]) & (inside[1:] == inside[:-1])
    return order, np.cumsum(new) - 1


def _slices(data: np.ndarray, starts: np.ndarray, left: np.ndarray) -> np.ndarray:
    """8 bytes at each start as a number in byte order, 0 beyond ``left``."""
    raw = data[np.minimum(starts, len(data) - 8)[:, None] + np.arange(8)]
    return raw.view(">u8").ravel().astype(np.uint64) & _HEAD[np.clip(left, 0, 8)]


def runs(data: bytes | np.ndarray, offsets: np.ndarray, group: np.ndarray):
    """(terms, term, group, documents, count): the distinct words of a slice as
    an Arrow array and, for each word and group that has it, the word's index,
    the group, its documents with the word and the word's count. ``group``
    gives the group of each text, in rising order."""
    data = np.frombuffer(data, np.uint8)
    starts, lengths, documents = word_pointers(data, offsets)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:-8] = _LOWER[data]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return pa.array([], pa.string()), none, none, none, none
    order, term = sort_words(padded, starts, lengths)
    documents = documents[order]
    owner = group[documents]
    new_term = np.r_[True, term[1:] != term[:-1]]
    new_group = new_term | np.r_[True, owner[1:] != owner[:-1]]
    new_document = new_term | np.r_[True, documents[1:] != documents[:-1]]
    at = np.flatnonzero(new_group)
    count = np.diff(np.r_[at, len(order)])
    seen = np.add.reduceat(new_document.astype(np.int64), at)
    head = order[np.flatnonzero(new_term)]
    return _terms(padded, starts[head], lengths[head]), term[at], owner[at], seen, count


def _terms(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    text = data[np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(text)).cast(pa.string())


def _long_document(text: bytes, slice_bytes: int) -> Counter:
    """Counts of the words of a text longer than a slice, in pieces that end
    in front of a byte that is no letter."""
    counts: Counter = Counter()
    data, start = np.frombuffer(text, np.uint8), 0
    while start < len(data):
        end = min(len(data), start + slice_bytes)
        while end < len(data) and _LETTER[data[end]]:
            stop = np.flatnonzero(~_LETTER[data[end:end + slice_bytes]])
            end = end + int(stop[0]) if len(stop) else min(len(data), end + slice_bytes)
        terms, term, _, _, count = runs(data[start:end], np.array([0, end - start]), np.zeros(1, np.int64))
        counts.update(dict(zip(terms.take(pa.array(term)).to_pylist(), count.tolist(), strict=True)))
        start = end
    return counts


def _count_slice(batches: list[pa.RecordBatch], slice_bytes: int) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches).combine_chunks()
    if not rows.num_rows:
        return
    langs, sources = (rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    n_sources = len(sources.dictionary)
    group = langs.indices.to_numpy().astype(np.int64) * n_sources + sources.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    group = group[order]
    text = rows.column("text").combine_chunks().cast(pa.large_string()).take(pa.array(order))
    offsets = np.frombuffer(text.buffers()[1], np.int64)[:len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)

    def batch(terms, groups, documents, count) -> pa.RecordBatch:
        lang, source = np.divmod(groups, n_sources)
        return pa.RecordBatch.from_pydict({
            "lang": langs.dictionary.take(pa.array(lang)), "source": sources.dictionary.take(pa.array(source)),
            "term": terms, "docs": pa.array(documents, pa.int64()), "n": pa.array(count, pa.int64())})

    if len(text) == 1 and len(data) > slice_bytes:
        counts = _long_document(data.tobytes(), slice_bytes)
        yield batch(pa.array(list(counts), pa.string()), np.repeat(group, len(counts)), [1] * len(counts),
                    list(counts.values()))
        return
    terms, term, groups, documents, count = runs(data, offsets, group)
    if len(term):
        yield batch(terms.take(pa.array(term)), groups, documents, count)


def count_batches(batches: Iterator[pa.RecordBatch], slice_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Word runs of batches of (lang, source, text), slice by slice; a document
    longer than a slice is one of its own."""
    held, size = [], 0
    for b in batches:
        width = np.array(pc.binary_length(b.column("text")), np.int64)
        done = 0
        for i in range(b.num_rows):
            if width[i] > slice_bytes:
                held.append(b.slice(done, i - done))
                yield from _count_slice([b.slice(i, 1)], slice_bytes)
                done = i + 1
                continue
            size += int(width[i])
            if size >= slice_bytes:
                held.append(b.slice(done, i + 1 - done))
                yield from _count_slice(held, slice_bytes)
                held, size, done = [], 0, i + 1
        held.append(b.slice(done))
    if held:
        yield from _count_slice(held, slice_bytes)


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, source, term, docs, n), a row for each slice, group and word."""
    ship(docs.sparkSession)
    return docs.mapInArrow(count_batches, "lang string, source string, term string, docs long, n long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total), exact for totals up to 2.9e14:
    SCALE is 31250 * 32000, divided in two steps."""
    a = (count + 1) * F.lit(31250)
    return F.lit(1) + _div(a, total) * F.lit(32000) + _div((a % total) * F.lit(32000), total)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) in exact integers."""
    return _div((p - q) * (p - q), q)


def kept_terms(docs: DataFrame, min_documents: int) -> DataFrame:
    """(lang, term, lang_n, by_source[source, n]): the terms in at least
    ``min_documents`` documents of the language."""
    runs_of_slices = count_words(docs)
    # Dealt by (lang, term) once: both sums below and the lists need no other shuffle.
    by_source = (runs_of_slices.repartition("lang", "term").groupBy("lang", "term", "source")
                 .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")))
    return (by_source.groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"),
                 F.collect_list(F.struct("source", "n")).alias("by_source"))
            .where(F.col("docs") >= min_documents).drop("docs"))


_PAIR_TYPES = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()),
                         ("value", pa.int64()), ("terms", pa.int64())])


def _pair_sums(terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Divergences of all sources of block ``a`` from those of block ``b``
    summed over the bucket's terms, and the number of these terms."""
    if not terms.num_rows:
        return _PAIR_TYPES.empty_table()
    terms = terms.combine_chunks()
    first, second = sources.filter(sources["side_a"]), sources.filter(sources["side_b"])
    coded = terms["term"].combine_chunks().dictionary_encode()
    term, n = coded.indices.to_numpy(), len(coded.dictionary)
    said = terms["p"].to_numpy()

    def shares(side: pa.Table) -> np.ndarray:
        out = np.repeat(side["none"].to_numpy()[None, :], n, axis=0)
        column = pc.fill_null(pc.index_in(terms["source"], side["source"]), -1).to_numpy()
        out[term[column >= 0], column[column >= 0]] = said[column >= 0]
        return out

    p, q = shares(first), shares(second)
    value = np.empty((first.num_rows, second.num_rows), np.int64)
    for i in range(first.num_rows):
        gap = p[:, i:i + 1] - q
        value[i] = (gap * gap // q).sum(axis=0)
    a, b = np.divmod(np.arange(value.size), max(1, second.num_rows))
    return pa.table([pa.array([terms["lang"][0].as_py()] * value.size, pa.string()), first["source"].take(pa.array(a)),
                     second["source"].take(pa.array(b)), value.ravel(), np.full(value.size, n)], schema=_PAIR_TYPES)


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Rows lang, source, part, item, value, rank; part ``pair``: divergence of
    each other source of the language, summed over its kept terms; part
    ``term``: the ``top_terms`` kept terms that the source says more often than
    its language.

    Null text, lang or source: empty. Each row is a document, repeated rows and
    ids included; doc_id is not read. A text without letters counts for its
    group's being there. Ties go by item. A language of one source has no pair
    rows; without kept terms pairs are 0. Empty table: no rows.
    """
    rows = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
                         for c in ("lang", "source", "text")))
    terms = saved(kept_terms(rows, min_documents), "divergence-terms")
    entries = terms.select("lang", "term", "lang_n", F.explode("by_source").alias("e")).select(
        "lang", "term", "lang_n", "e.source", "e.n")

    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"),
                                      F.sum(F.size("by_source")).alias("entries"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    there = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"))
    groups = there.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(
        0, ["total", "v", "lang_total", "entries"])
    many = there.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SOURCE_BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    buckets = (F.lit(1) + _div(F.col("entries"), F.lit(BUCKET_ROWS))).cast("int")
    # One row a group.
    groups = saved(groups.join(many, "lang").select(
        "lang", "source", "total", "v", "lang_total", "blocks", block.alias("block"), buckets.alias("buckets"),
        share(F.lit(0).cast("long"), F.greatest(F.col("total") + F.col("v"), F.lit(1))).alias("none")),
        "divergence-groups")

    shared = lookup_join(entries, groups, ["lang", "source"], "inner").withColumns({
        "p": share(F.col("n"), F.col("total") + F.col("v")),
        "q": share(F.col("lang_n"), F.col("lang_total") + F.col("v"))})
    said_more = shared.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                             divergence(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = said_more.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    # Each block of sources meets each other one in every bucket of terms.
    def dealt(df: DataFrame, bucket: Column, *columns) -> DataFrame:
        every = F.sequence(F.lit(0), F.col("blocks") - 1)
        df = df.withColumn("home", F.col("block") + 0)
        own_a = df.select(*columns, "home", bucket.alias("bucket"), F.col("block").alias("a"), F.explode(every).alias("b"))
        own_b = df.select(*columns, "home", bucket.alias("bucket"), F.explode(every).alias("a"), F.col("block").alias("b"))
        return own_a.unionByName(own_b.where("a <> b"))

    term_rows = dealt(shared, F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int"), "lang", "source", "term", "p")
    in_buckets = groups.select(*(F.col(c).alias(c) for c in groups.columns)).withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))
    source_rows = dealt(in_buckets, F.col("bucket"), "lang", "source", "none")
    source_rows = source_rows.withColumns({"side_a": F.col("home") == F.col("a"), "side_b": F.col("home") == F.col("b")})
    keys = ["lang", "a", "b", "bucket"]
    sums = (term_rows.groupBy(*keys).cogroup(source_rows.groupBy(*keys))
            .applyInArrow(_pair_sums, "lang string, source string, other string, value long, terms long")
            .groupBy("lang", "source", "other").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")))
    own = groups.select("lang", "source", "v", F.col("none").alias("p"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("q"))
    unsaid = (F.col("v") - F.coalesce("terms", F.lit(0))) * divergence(F.col("p"), F.col("q"))
    pairs = (own.join(other, "lang").where("source <> item")
             .join(sums.withColumnRenamed("other", "item"), ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     (F.coalesce("value", F.lit(0)) + unsaid).alias("value")))
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(top)
