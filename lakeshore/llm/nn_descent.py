"""Embedding near-duplicates by NN-descent (operator 7).

Every distinct vector holds a list of its nearest neighbours found so far.
Lists start from leaves of random projections. In each round a vector joins
the group of each of its neighbours, so that neighbours of neighbours meet and
are compared; better ones enter the lists, and pairs at or above the threshold
are kept as links whether or not a list has room. A list whose every entry is
at or above the threshold is saturated and doubles. Rounds end when few lists
change. Recall is then audited by brute force for a bounded sample of vectors,
vector by vector, so that large groups don't hide lost small ones; below
``RECALL`` new projections and further rounds follow, and where they stop
helping the operator raises with the measured recall.

Links join vectors into components; inside each component every two vectors
are compared in tiles of bounded size, which gives exact link counts without
emitting pairs. All decisions use the cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import drop_saved, saved, ship
from lakeshore.llm.components import components
from lakeshore.llm.vectors import usable

LIST_LENGTH = 10
PROJECTION_TREES = 6
LEAF_VECTORS = 64
# Members of a group that are compared with each other at once.
CHUNK_VECTORS = 96
# Better neighbours that a chunk offers a vector at once.
OFFERS = 4
ROUNDS, MORE_TREES = 4, 3
SETTLED_SHARE = 0.02
# The audit takes AUDIT_VECTORS vectors with known links and as many without; a
# component counts with about AUDIT_GROUP of its vectors at most.
RECALL, AUDIT_VECTORS, AUDIT_GROUP = 0.999, 2000, 64
# Links this near to the threshold may be decided either way by rounding.
ROUNDING = 1e-12
TILE_VECTORS = 512

NODE_SCHEMA = "v long, vec binary, room int, ids binary, sims binary"


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=-1, keepdims=True)  # squares of very large or small values stay finite
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def _start(classes: DataFrame) -> DataFrame:
    """Nodes with empty lists; vec: the vector over its length, float64."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = [_unit(e.values.to_numpy()).tobytes() for e in b.column("embedding")]
            n = len(vecs)
            yield pa.RecordBatch.from_arrays(
                [b.column("v"), pa.array(vecs, pa.binary()), pa.array([LIST_LENGTH] * n, pa.int32()),
                 pa.array([b""] * n, pa.binary()), pa.array([b""] * n, pa.binary())],
                ["v", "vec", "room", "ids", "sims"])
    return classes.select("v", "embedding").mapInArrow(run, NODE_SCHEMA)


MEMBER_SCHEMA = "k1 long, k2 long, place double, v long, vec binary, worst double"


def _member_batch(rows: list[tuple]) -> pa.RecordBatch:
    k1, k2, place, v, vec, worst = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(place, pa.float64()), pa.array(v, pa.int64()),
         pa.array(vec, pa.binary()), pa.array(worst, pa.float64())], ["k1", "k2", "place", "v", "vec", "worst"])


def _node_rows(b: pa.RecordBatch) -> Iterator[tuple[int, bytes, np.ndarray, float]]:
    """v, vec, neighbour ids and the similarity a new neighbour must beat."""
    for v, vec, room, ids, sims in zip(*(b.column(c).to_pylist() for c in ("v", "vec", "room", "ids", "sims")),
                                       strict=True):
        sims = np.frombuffer(sims, "<f8")
        yield v, vec, np.frombuffer(ids, "<i8"), float(sims[-1]) if len(sims) >= room else -2.0


def _leaves(nodes: DataFrame, n: int, first_tree: int, trees: int) -> DataFrame:
    """Each vector once per tree, keyed by the signs of its projections."""
    depth = max(0, int(np.ceil(np.log2(max(1, n / LEAF_VECTORS)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            rows = []
            for v, vec, _, worst in _node_rows(b):
                x = np.frombuffer(vec, "<f8")
                for tree in range(first_tree, first_tree + trees):
                    if (tree, len(x)) not in planes:
                        planes[tree, len(x)] = np.random.default_rng([tree, len(x)]).normal(size=(depth + 1, len(x)))
                    at = planes[tree, len(x)] @ x
                    code = int.from_bytes(np.packbits(at[1:] > 0).tobytes(), "big")
                    rows.append((tree << 32 | len(x), code & (1 << 63) - 1, float(at[0]), v, vec, worst))
            if rows:
                yield _member_batch(rows)
    return nodes.mapInArrow(run, MEMBER_SCHEMA)


def _spread(v: int, salt: int) -> float:
    """A place from 0 to 1 for a vector, another one for each salt."""
    x = (v + salt * 0xD1B54A32D192ED03) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    return (x >> 11) / (1 << 53)


def _neighbour_groups(nodes: DataFrame, salt: int) -> DataFrame:
    """Each vector in its own group and in that of each of its neighbours;
    ``salt``: number of the round, so that the members of a group of several
    chunks meet others in each round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for v, vec, ids, worst in _node_rows(b):
                rows.append((-1, v, -1.0, v, vec, worst))
                spread = _spread(v, salt)
                rows += [(-1, u, spread, v, vec, worst) for u in ids.tolist()]
            if rows:
                yield _member_batch(rows)
    return nodes.mapInArrow(run, MEMBER_SCHEMA)


OFFER_SCHEMA = "v long, u long, sim double, link boolean"


def _compare(members: DataFrame, threshold: float) -> DataFrame:
    """Compare the members of each group, chunk by chunk along ``place``: rows
    (v, u, sim) offer v a nearer neighbour; rows with ``link`` connect what the
    chunk holds at or above the threshold (a spanning forest)."""
    def forest(close: np.ndarray) -> Iterator[tuple[int, int]]:
        left = np.flatnonzero(close.any(axis=1)).tolist()
        todo = set(left)
        while todo:
            frontier = [todo.pop()]
            while frontier:
                a = frontier.pop()
                for b in todo.intersection(np.flatnonzero(close[a]).tolist()):
                    yield a, b
                    todo.discard(b)
                    frontier.append(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v_out, u_out, s_out, l_out = [], [], [], []

        def compare(chunk: list[tuple[int, bytes, float]]) -> None:
            ids = np.array([c[0] for c in chunk])
            x = np.frombuffer(b"".join(c[1] for c in chunk), "<f8").reshape(len(chunk), -1)
            sims = x @ x.T
            sims[ids[:, None] == ids] = -3.0
            for a, b in forest(sims >= threshold):
                v_out.append(ids[a])
                u_out.append(ids[b])
                s_out.append(sims[a, b])
                l_out.append(True)
            best = np.argsort(-sims, axis=1, kind="stable")[:, :OFFERS]
            values = np.take_along_axis(sims, best, axis=1)
            a, j = np.nonzero(values > np.maximum([c[2] for c in chunk], -2.0)[:, None])
            v_out.extend(ids[a])
            u_out.extend(ids[best[a, j]])
            s_out.extend(values[a, j])
            l_out.extend([False] * len(a))

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(v_out, pa.int64()), pa.array(u_out, pa.int64()), pa.array(s_out, pa.float64()),
                 pa.array(l_out, pa.bool_())], ["v", "u", "sim", "link"])
            for column in (v_out, u_out, s_out, l_out):
                column.clear()
            return out

        chunk, key = [], None
        for b in batches:
            for k1, k2, v, vec, worst in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "v", "vec", "worst")),
                                             strict=True):
                now = (k1, k2, len(vec))
                if now != key or len(chunk) == CHUNK_VECTORS:
                    if len(chunk) > 1:
                        compare(chunk)
                    chunk, key = [], now
                chunk.append((v, vec, worst))
            if v_out:
                yield batch()
        if len(chunk) > 1:
            compare(chunk)
        if v_out:
            yield batch()

    return (members.repartition("k1", "k2").sortWithinPartitions("k1", "k2", F.length("vec"), "place", "v")
            .mapInArrow(run, OFFER_SCHEMA))


def _improve(nodes: DataFrame, offers: DataFrame, threshold: float) -> DataFrame:
    """Nodes with the offered neighbours merged into their lists; ``changed``
    says whether a list changed. A saturated list doubles its room."""
    best = offers.where("NOT link").groupBy("v", "u").agg(F.max("sim").alias("sim"))
    entries = (nodes.select("v", "vec", "room", "ids", "sims", F.lit(None).cast("long").alias("u"),
                            F.lit(None).cast("double").alias("sim"))
               .unionByName(best, allowMissingColumns=True)
               .repartition("v").sortWithinPartitions("v", F.col("vec").isNull(), F.col("sim").desc(), "u"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: list = []

        def finish() -> None:
            v, vec, room, ids, sims, offered = now
            merged = dict(zip(ids, sims, strict=True))
            known = len(merged)
            merged |= offered
            top = sorted(merged.items(), key=lambda x: (-x[1], x[0]))[:room]
            changed = len(merged) > known and {u for u, _ in top} != set(ids)
            if len(top) == room and top[-1][1] >= threshold:
                room *= 2
            out.append((v, vec, room, np.array([u for u, _ in top], "<i8").tobytes(),
                        np.array([s for _, s in top], "<f8").tobytes(), changed))

        def batch() -> pa.RecordBatch:
            types = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.bool_()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types,
                                                                               strict=True)],
                                              ["v", "vec", "room", "ids", "sims", "changed"])
            out.clear()
            return made

        for b in batches:
            for v, vec, room, ids, sims, u, sim in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if vec is not None:
                    if now:
                        finish()
                    now = [v, vec, room, np.frombuffer(ids, "<i8").tolist(), np.frombuffer(sims, "<f8").tolist(), {}]
                elif len(now[5]) < 2 * now[2]:  # offers come best first: no more can enter the list
                    now[5][u] = sim
            if out:
                yield batch()
        if now:
            finish()
            yield batch()

    return entries.mapInArrow(run, NODE_SCHEMA + ", changed boolean")


def _missed(nodes: DataFrame, threshold: float, salt: int = 0) -> float:
    """Mean share of a vector's links that lead to another component, over the
    vectors that have links; estimated by brute force for a bounded sample of
    the vectors with known links and one of those without, other ones for each
    ``salt``. Vectors of components beyond AUDIT_GROUP are thinned to that."""
    sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    draw = F.pmod(F.xxhash64("v", F.lit(salt)), F.lit(1 << 40)) / (1 << 40)
    drawn = (nodes.select("v", "component").join(sizes, "component").where(draw * F.col("size") < AUDIT_GROUP)
             .select("v", (F.col("size") > 1).alias("linked")))
    of_kind = {r["linked"]: r["n"] for r in drawn.groupBy("linked").agg(F.count(F.lit(1)).alias("n")).collect()}
    known, single = (drawn.where(kind).orderBy(F.xxhash64("v", F.lit(salt), F.lit(1)), "v").limit(AUDIT_VECTORS)
                     for kind in ("linked", "NOT linked"))
    sample = (nodes.join(F.broadcast(known.unionAll(single)), "v").select("v", "vec", "component", "linked")
              .collect())
    by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for size in {len(r["vec"]) for r in sample}:
        own = [r for r in sample if len(r["vec"]) == size]
        by_size[size] = (np.array([r["v"] for r in own]), np.array([r["component"] for r in own]),
                         np.frombuffer(b"".join(r["vec"] for r in own), "<f8").reshape(len(own), -1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, missed = ({size: np.zeros(len(ids), np.int64) for size, (ids, _, _) in by_size.items()}
                         for _ in range(2))

        def compare(size: int, tile: list[tuple[int, bytes, int]]) -> None:
            ids, components_, x = by_size[size]
            sims = x @ np.frombuffer(b"".join(t[1] for t in tile), "<f8").reshape(len(tile), -1).T
            sims[ids[:, None] == np.array([t[0] for t in tile])] = -3.0
            same = components_[:, None] == np.array([t[2] for t in tile])
            found[size] += ((sims >= threshold) & same).sum(axis=1)
            missed[size] += ((sims >= threshold + ROUNDING) & ~same).sum(axis=1)

        tiles: dict[int, list[tuple[int, bytes, int]]] = {size: [] for size in by_size}
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("v", "vec", "component")), strict=True):
                size = len(row[1])
                if size not in tiles:
                    continue
                tiles[size].append(row)
                if len(tiles[size]) == TILE_VECTORS:
                    compare(size, tiles[size])
                    tiles[size] = []
        for size, tile in tiles.items():
            if tile:
                compare(size, tile)
            some = np.flatnonzero(found[size] + missed[size])
            yield pa.RecordBatch.from_arrays(
                [pa.array(by_size[size][0][some], pa.int64()), pa.array(found[size][some], pa.int64()),
                 pa.array(missed[size][some], pa.int64())], ["v", "found", "missed"])

    # At most a row for each vector of the sample.
    links = (nodes.select("v", "vec", "component").mapInArrow(run, "v long, found long, missed long").groupBy("v")
             .agg(F.sum("found").alias("found"), F.sum("missed").alias("missed")).collect())
    share = {r["v"]: r["missed"] / (r["found"] + r["missed"]) for r in links}
    lost = having = 0.0
    for kind, n in of_kind.items():
        own = [r["v"] for r in sample if r["linked"] == kind]
        with_links = [share[v] for v in own if v in share]
        lost += n * sum(with_links) / max(1, len(own))
        having += n * len(with_links) / max(1, len(own))
    return lost / having if having else 0.0


def _labelled(nodes: DataFrame, links: list[DataFrame]) -> DataFrame:
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionAll(more)
    groups = components(edges)
    return nodes.join(groups.withColumnRenamed("vertex", "v"), "v", "left").withColumn(
        "component", F.coalesce("component", "v"))


def _link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(v, others): how many rows of the component the vector is linked to
    directly, its own class aside; for components of more than one vector.
    ``members``: v, n (rows of the class), vec, component."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    dealt = (members.join(sizes, "component")
             .withColumn("blocks", F.ceil(F.col("size") / TILE_VECTORS).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("component", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own",
                     "v", "n", "vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []

        def count(key: tuple, tile: list[tuple]) -> None:
            left = [t for t in tile if t[0] == key[1]]
            right = left if key[1] == key[2] else [t for t in tile if t[0] == key[2]]
            if not left or not right:
                return
            (ids, n, x), (ids2, n2, x2) = (
                (np.array([t[1] for t in side]), np.array([t[2] for t in side]),
                 np.frombuffer(b"".join(t[3] for t in side), "<f8").reshape(len(side), -1)) for side in (left, right))
            if x.shape[1] != x2.shape[1]:
                return
            close = (x @ x2.T >= threshold) & (ids[:, None] != ids2)
            out.extend(zip(ids.tolist(), (close @ n2).tolist()))
            if right is not left:
                out.extend(zip(ids2.tolist(), (close.T @ n).tolist()))

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(2)],
                                              ["v", "others"])
            out.clear()
            return made

        key, tile = None, []
        for b in batches:
            for component, a, b2, own, v, n, vec in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (component, a, b2) != key:
                    if tile:
                        count(key, tile)
                    key, tile = (component, a, b2), []
                tile.append((own, v, n, vec))
            if out:
                yield batch()
        if tile:
            count(key, tile)
        if out:
            yield batch()

    return (dealt.repartition("component", "a", "b").sortWithinPartitions("component", "a", "b")
            .mapInArrow(run, "v long, others long").groupBy("v").agg(F.sum("others").alias("others")))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other rows at a cosine
    of at least ``threshold``), component_id (smallest vec_id reachable by
    links, itself included), kept (vec_id = component_id).

    Vectors that are null, zero, empty or hold null or non-finite components
    link with nothing (no links, their own component). Vectors of different
    lengths never link. Equal vectors link with each other; repeated rows are
    rows of their own. A null vec_id stays null and never names a component
    that has another. An empty table gives no rows. RuntimeError where the
    audited recall stays below RECALL.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumn(
        "usable", usable(F.col("embedding")))
    classes = saved(rows.where("usable").groupBy("embedding").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "vector-classes")
    classes = saved(classes.withColumn("v", F.monotonically_increasing_id()), "vector-classes")
    n = classes.count()
    nodes = saved(_start(classes), "nodes")
    links: list[DataFrame] = []

    def round_of(members: DataFrame) -> float:
        """One step of comparing and improving; the share of changed lists."""
        nonlocal nodes
        offers = saved(_compare(members, threshold), "offers")
        links.append(saved(offers.where("link").select(F.col("v").alias("u"), F.col("u").alias("v")), "links"))
        better = saved(_improve(nodes, offers, threshold), "nodes")
        drop_saved(offers)
        drop_saved(nodes)
        nodes = better
        return (better.where("changed").count() or 0) / max(1, n)

    least_missed, attempt, in_vain = 1.0, 0, 0
    while True:
        round_of(_leaves(nodes.drop("changed"), n, attempt * PROJECTION_TREES, PROJECTION_TREES))
        for step in range(ROUNDS):
            if round_of(_neighbour_groups(nodes.drop("changed"), attempt * ROUNDS + step)) < SETTLED_SHARE:
                break
        labelled = saved(_labelled(nodes.select("v", "vec"), links), "labelled")
        missed = _missed(labelled, threshold, attempt)
        if missed <= 1 - RECALL:
            break
        in_vain = 0 if missed < least_missed else in_vain + 1
        if in_vain == MORE_TREES:
            raise RuntimeError(f"near_duplicates: recall {1 - missed:.5f} after {attempt + 1} attempts, "
                               f"{RECALL} wanted; the last {in_vain} did not raise it")
        least_missed = min(least_missed, missed)
        drop_saved(labelled)
        attempt += 1

    members = labelled.join(classes.select("v", "n", "first_id"), "v")
    counts = _link_counts(members.select("v", "n", "vec", "component"), threshold)
    least = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = (members.select("v", "n", "component").join(least, "component").join(counts, "v", "left")
                .select("v", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component_id"))
    of_class = classes.select("v", "embedding").join(of_class, "v").drop("v")
    whole = rows.where("usable").join(of_class, "embedding").select(
        "vec_id", F.col("links").alias("n_links"), "component_id")
    rest = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                               F.col("vec_id").alias("component_id"))
    return whole.unionAll(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
