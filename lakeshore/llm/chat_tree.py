"""Chat formatting as a prefix tree (operator 1).

Conversations that share their initial turns share tree nodes: a node is a
turn together with everything before it. Each node's formatted text is emitted
once, depth first; its tokens carry position ids (places in the conversation,
not in the emission) and the intervals of emitted positions that its
ancestors hold, to which alone it may attend.

A token here is one Unicode code point of the formatted text.

A node belongs to the smallest conv_id that passes through it, so every
conversation owns one run of consecutive nodes, its block, or none. Blocks in
the order of their paths (the owners above, deepest branching point first)
are the tree depth first; emitted positions are prefix sums over that order.
No conversation tree is ever gathered in one place: nodes meet by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import saved, ship

# Marks of the template, a fixed format.
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
# Stands for a null conv_id inside the operator; that id itself is reserved.
NULL_CONV = -(1 << 63)


def escape(text: str) -> str:
    """Without the marks' opening ``<|``, reversibly."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    parts = text.split("\\\\")
    return "\\".join(p.replace("<\\|", "<|") for p in parts)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its loss mask begins and ends (equal
    where no token of it is trained on)."""
    head = f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
    body = escape(text)
    lo = len(head)
    return f"{head}{body}{END}\n", lo, lo + len(body) if role == LOSS_ROLE else lo


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    at = 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        yield _role(formatted[at + len(START):line]), unescape(formatted[line + 1:end])
        at = end + len(END) + 1


def _role(escaped: str) -> str:
    parts = escaped.split("\\\\")
    return "\\".join(p.replace("\\n", "\n").replace("<\\|", "<|") for p in parts)


TURN_SCHEMA = "conv long, depth int, node binary, formatted string, chars int, loss_from int, loss_to int, position long"


def _nodes_of_turns(conversations: DataFrame) -> DataFrame:
    """Each turn with its node (a hash of the conversation up to it) and the
    position of its first token in the conversation."""
    names = [c.split()[0] for c in TURN_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, depth, position, above = None, 0, 0, b""
        for b in batches:
            rows = []
            for c, role, text in zip(*(b.column(x).to_pylist() for x in ("conv", "role", "text")), strict=True):
                if c != conv:
                    conv, depth, position, above = c, 0, 0, b""
                depth += 1
                formatted, lo, hi = format_turn(role, text)
                above = hashlib.blake2b(above + formatted.encode(), digest_size=16).digest()
                rows.append((c, depth, above, formatted, len(formatted), lo, hi, position))
                position += len(formatted)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_CONV)).alias("conv"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (turns.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
            .mapInArrow(run, TURN_SCHEMA))


def _with_offsets(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start``: the tokens of all blocks before them in path
    order, by prefix sums over ordered partitions."""
    ordered = saved(blocks.repartitionByRange("path").sortWithinPartitions("path")
                    .withColumn("part", F.spark_partition_id()), "blocks")
    # One row per partition.
    sizes = sorted((r["part"], r["n"]) for r in ordered.groupBy("part").agg(F.sum("tokens").alias("n")).collect())
    bases, total = [], 0
    for part, n in sizes:
        bases.append((part, total))
        total += n
    spark = blocks.sparkSession
    base = spark.createDataFrame(bases or [(0, 0)], "part int, base long")

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = None, 0
        for b in batches:
            starts = []
            for p, first, n in zip(*(b.column(c).to_pylist() for c in ("part", "base", "tokens")), strict=True):
                if p != part:
                    part, at = p, first
                starts.append(at)
                at += n
            yield pa.RecordBatch.from_arrays([b.column("owner"), pa.array(starts, pa.int64())], ["owner", "start"])

    starts = (ordered.join(F.broadcast(base), "part").select("part", "base", "tokens", "owner", "path")
              .repartition("part").sortWithinPartitions("part", "path")
              .mapInArrow(running, "owner long, start long"))
    return ordered.drop("part").join(starts, "owner")


def chat_tree(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths).

    ``nodes``, one row per tree node, to be read in the order of start: owner
    (conv_id whose block it is in), depth (turns up to it), start (emitted
    position of its first token), position (position id of that token; the
    others follow one by one), tokens, loss_from and loss_to (its loss mask,
    relative to start), text (its tokens, code points), ancestors (array of
    struct lo, hi: the intervals of emitted positions it attends to beside its
    own earlier tokens, hi exclusive).

    ``paths``, one row per conversation: conv_id, n_turns, tokens, spans (array
    of struct owner, first, last: the blocks that hold its nodes, with the
    depths taken from each, in order).

    Turns go by turn, role and text; equal turns are kept. Null text or role:
    empty; null turn: first; null conv_id: one conversation of its own. Empty
    texts are turns. Equal conversations share all nodes. An empty table gives
    no rows.
    """
    spark = conversations.sparkSession
    ship(spark)
    turns = saved(_nodes_of_turns(conversations), "turns")
    # Written, so that the join has nothing but two exchanges to read and a node
    # of many conversations can be split.
    owners = saved(turns.groupBy("node").agg(F.min("conv").alias("owner")), "node-owners")
    owned = turns.select("conv", "depth", "node", "chars").join(owners, "node")
    spans = saved(owned.groupBy("conv", "owner").agg(
        F.min("depth").alias("first"), F.max("depth").alias("last"), F.sum("chars").alias("chars")), "spans")
    # Owners rise along a path, and each holds one run of depths.
    path_of = spans.groupBy("conv").agg(F.sort_array(F.collect_list(
        F.struct("first", "last", "owner", "chars"))).alias("spans"))
    path_of = saved(path_of.withColumn("path", F.flatten(F.transform(
        "spans", lambda s: F.array(-s["first"].cast("long"), s["owner"])))), "paths")
    last = F.element_at("spans", -1)
    blocks = path_of.where(last["owner"] == F.col("conv")).select(
        F.col("conv").alias("owner"), "path", last["chars"].alias("tokens"),
        F.slice("spans", 1, F.size("spans") - 1).alias("above"))
    starts = saved(_with_offsets(blocks), "block-starts")

    # A branch point's tokens: how far down the owner's block the branch goes.
    begins = starts.select("owner", F.col("start").alias("lo"))
    above = (starts.select("owner", F.posexplode("above").alias("place", "s"))
             .select("owner", "place", F.col("s.owner").alias("of"), F.col("s.chars").alias("chars"))
             .join(begins.withColumnRenamed("owner", "of"), "of")
             .groupBy("owner").agg(F.sort_array(F.collect_list(F.struct("place", "lo", "chars"))).alias("a"))
             .select("owner", F.transform("a", lambda x: F.struct(
                 x["lo"].alias("lo"), (x["lo"] + x["chars"]).alias("hi"))).alias("above_intervals")))
    block = (starts.select("owner", "start").join(above, "owner", "left")
             .withColumn("begin", F.coalesce(F.aggregate(
                 "above_intervals", F.lit(0).cast("long"), lambda n, x: n + x["hi"] - x["lo"]),
                 F.lit(0).cast("long"))))
    own = turns.join(owners.withColumnRenamed("owner", "conv"), ["node", "conv"])
    at = F.col("start") + F.col("position") - F.col("begin")
    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    inside = F.when(at > F.col("start"), F.array(F.struct(F.col("start").alias("lo"), at.alias("hi")))).otherwise(none)
    nodes = (own.join(block.withColumnRenamed("owner", "conv"), "conv")
             .select(F.col("conv").alias("owner"), "depth", at.alias("start"), "position",
                     F.col("chars").alias("tokens"), "loss_from", "loss_to", F.col("formatted").alias("text"),
                     F.concat(F.coalesce("above_intervals", none), inside).alias("ancestors")))
    paths = path_of.select(
        F.col("conv").alias("conv_id"), F.element_at("spans", -1)["last"].cast("long").alias("n_turns"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["chars"]).alias("tokens"),
        F.transform("spans", lambda s: F.struct(s["owner"].alias("owner"), s["first"].alias("first"),
                                                s["last"].alias("last"))).alias("spans"))
    return nodes, paths


def conversation_digests(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Each conversation read back from the tree's output: conv_id, n_turns,
    turns_sha256 (role, newline, text, newline per turn), loss_chars and
    loss_sha256 (all text under the loss mask, unescaped), formatted_chars."""
    steps = (paths.select("conv_id", F.explode("spans").alias("s"))
             .select("conv_id", F.col("s.owner").alias("owner"),
                     F.explode(F.sequence(F.col("s.first"), F.col("s.last"))).alias("depth")))
    read = steps.join(nodes.select("owner", "depth", "text", "loss_from", "loss_to"), ["owner", "depth"])
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, rows = None, None, []

        def finish() -> None:
            n, turns, chars, loss, formatted = state
            rows.append((None if conv == NULL_CONV else conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
            rows.clear()
            return made.cast(pa.schema([(x, pa.string() if "sha256" in x else pa.int64()) for x in names]))

        for b in batches:
            for c, text, lo, hi in zip(*(b.column(x).to_pylist() for x in ("conv_id", "text", "loss_from", "loss_to")),
                                       strict=True):
                if c != conv or state is None:
                    if state is not None:
                        finish()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                trained = unescape(text[lo:hi])
                state[2] += len(trained)
                state[3].update(trained.encode())
                state[4] += len(text)
            if rows:
                yield batch()
        if state is not None:
            finish()
            yield batch()

    return (read.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
            .select("conv_id", "text", "loss_from", "loss_to").mapInArrow(run, schema))
