"""Quality classifier (operator 5): a linear-chain conditional random field
labels every line good or bad from features of the line and its neighbours;
forward-backward marginals, weighted by line length, give the document's score.

Lines of a training document carry the document's label. The model is fitted
on the driver over a bounded sample, about ``train_documents`` labelled
documents of at most ``TRAIN_LINES`` lines drawn by a hash of their doc_id, one
text each, from line features computed on the executors; every document is then
scored whole, on the executors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.llm.common import doc_text, drawn, releasing, ship

TRAIN_DOCUMENTS = 3000
TRAIN_LINES = 1000
HOLDOUT_FOLDS, HOLDOUT_FOLD = 4, 2
THRESHOLD = 0.7
TRAIN_STEPS = 150
LEARNING_RATE = 0.1
RIDGE = 1e-3
# Documents and characters scored together; longer documents alone.
GROUP_DOCUMENTS, GROUP_CHARS = 256, 1 << 20

# Byte classes counted in each line.
BYTE_CLASSES = [bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b" \t", b".?", b",;:", b"!", b"|",
                b"#$%&*", b"\"'()[]{}<>=/\\+-_@~^`", bytes(range(128, 256))]
_CLASS_OF = np.full(256, len(BYTE_CLASSES), np.uint8)
for _i, _class in enumerate(BYTE_CLASSES):
    _CLASS_OF[list(_class)] = _i



class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of "good" against "bad"; the last one is the bias
    moves: np.ndarray    # 2 x 2 transition scores, [from, to]


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, lines): one row and one byte length per line of all
    texts in order, and the number of lines of each text (an empty text has
    one empty line)."""
    encoded = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1]
    lengths = ends - starts
    classes = _CLASS_OF[data]
    size = np.maximum(lengths, 1)
    columns = [np.log1p(lengths)]
    for c in range(len(BYTE_CLASSES)):
        total = np.r_[0, np.cumsum(classes == c, dtype=np.int64)]
        columns.append((total[ends] - total[starts]) / size)
    words, distinct, again, lines = [], [], [], []
    for t in encoded:
        own = t.split(b"\n")
        lines.append(len(own))
        seen = Counter(own)
        for line in own:
            w = line.split()
            words.append(len(w))
            distinct.append(len(set(w)))
            again.append(seen[line] > 1)
    words, distinct = np.array(words), np.array(distinct)
    columns += [np.log1p(words), distinct / np.maximum(words, 1), (words - distinct) > 5,
                lengths / np.maximum(words, 1) / 10, np.array(again, float)]
    return np.stack(columns, axis=1), lengths, np.array(lines)


def with_neighbours(x: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the line before and after it
    (zeros at a document's ends) and a constant."""
    last = np.cumsum(lines) - 1
    before, after = np.roll(x, 1, axis=0), np.roll(x, -1, axis=0)
    before[last - lines + 1] = 0
    after[last] = 0
    return np.hstack([x, before, after, np.ones((len(x), 1))])


def marginals(score: np.ndarray, moves: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all documents at once: P(good) of every line, the
    summed pair marginals of the documents (2 x 2 each), and log Z of each.
    ``score``: the lines' scores of "good" against "bad"."""
    order = np.argsort(-lines, kind="stable")
    first = (np.cumsum(lines) - lines)[order]
    counts = lines[order]
    longest = int(counts[0])
    active = np.searchsorted(-counts, -np.arange(longest), side="left")  # documents with more than t lines
    unary = np.zeros((len(score), 2))
    unary[:, 1] = score
    ahead, behind = np.zeros_like(unary), np.zeros_like(unary)
    ahead[first] = unary[first]
    for t in range(1, longest):
        at = first[:active[t]] + t
        ahead[at] = unary[at] + np.logaddexp(ahead[at - 1, :1] + moves[0], ahead[at - 1, 1:] + moves[1])
    for t in range(longest - 2, -1, -1):
        at = first[:active[t + 1]] + t
        x = unary[at + 1] + behind[at + 1]
        behind[at] = np.logaddexp(moves[:, 0] + x[:, :1], moves[:, 1] + x[:, 1:])
    end = np.cumsum(lines) - 1
    log_z = np.logaddexp(ahead[end, 0], ahead[end, 1])
    both = ahead + behind
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    inner = np.ones(len(score), bool)
    inner[end] = False
    at = np.flatnonzero(inner)
    z = np.repeat(log_z, lines)[at]
    pairs = np.exp(ahead[at][:, :, None] + moves + (unary[at + 1] + behind[at + 1])[:, None, :] - z[:, None, None])
    document = np.repeat(np.arange(len(lines)), lines)[at]
    summed = np.zeros((len(lines), 2, 2))
    np.add.at(summed, document, pairs)
    return good, summed, log_z


def fit(x: np.ndarray, lines: np.ndarray, labels: np.ndarray) -> Model:
    """Maximum likelihood by Adam; every line carries its document's label and
    every document counts alike."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    features = with_neighbours((x - mean) / scale, lines)
    y = np.repeat(labels, lines).astype(float)
    weight = np.repeat(1 / lines, lines)
    n = len(lines)
    theta = np.zeros(features.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    seen = np.zeros((n, 2, 2))
    seen[np.arange(n), labels, labels] = lines - 1
    for step in range(1, TRAIN_STEPS + 1):
        good, pairs, _ = marginals(features @ theta[:-4], theta[-4:].reshape(2, 2), lines)
        slope = np.r_[features.T @ ((good - y) * weight), (((pairs - seen) / lines[:, None, None]).sum(axis=0)).ravel()]
        slope = slope / n + RIDGE * theta
        first += 0.1 * (slope - first)
        second += 0.01 * (slope ** 2 - second)
        theta -= LEARNING_RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Model(mean, scale, theta[:-4], theta[-4:].reshape(2, 2))


def document_scores(model: Model | None, texts: list[str]) -> np.ndarray:
    """Length-weighted mean of P(good) over each text's lines; without a model
    one half."""
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    x, lengths, lines = line_features(texts)
    good, _, _ = marginals(with_neighbours((x - model.mean) / model.scale, lines) @ model.weights, model.moves, lines)
    document = np.repeat(np.arange(len(lines)), lines)
    weight = lengths + 1.0
    return np.bincount(document, good * weight) / np.bincount(document, weight)


def _groups(texts: Iterable[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        if group and (len(group) >= GROUP_DOCUMENTS or size + len(t) > GROUP_CHARS):
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def train(docs: DataFrame, labels: DataFrame, train_documents: int = TRAIN_DOCUMENTS) -> Model | None:
    """Fit on about ``train_documents`` labelled documents outside the held-out
    fold. A document labelled more than once takes the majority, good on a tie;
    null labels don't count; of different texts under one doc_id the smallest
    counts. None where no labelled document is left."""
    ship(docs.sparkSession)
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("q"))
             .where("doc_id IS NOT NULL AND q IS NOT NULL").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.avg("q") >= 0.5).cast("int").alias("label")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, label, text in zip(b.column("doc_id").to_pylist(), b.column("label").to_pylist(),
                                           b.column("text").to_pylist(), strict=True):
                x, _, lines = line_features([text])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([doc_id], pa.int64()), "label": pa.array([label], pa.int32()),
                    "n_lines": pa.array([int(lines[0])], pa.int32()), "x": [x.astype("<f4").tobytes()]})

    # About train_documents rows, and one text for each before any of them moves.
    chosen = F.broadcast(drawn(known, train_documents, "doc_id"))
    lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    rows = (doc_text(docs).where(lines <= TRAIN_LINES).join(chosen, "doc_id")
            .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
            .mapInArrow(features, "doc_id long, label int, n_lines int, x binary").collect())
    if not rows:
        return None
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.concatenate([np.frombuffer(r["x"], "<f4").reshape(r["n_lines"], -1) for r in rows]).astype(float)
    return fit(x, np.array([r["n_lines"] for r in rows]), np.array([r["label"] for r in rows]))


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(HOLDOUT_FOLDS)) == HOLDOUT_FOLD


def classify(docs: DataFrame, labels: DataFrame, train_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """Score every whole text: doc_id, held_out, score (0 to 1, higher: good
    likelier), predicted (1 from THRESHOLD on).

    Null or empty text: scored as one empty line. Null doc_id: scored, not
    held out. Repeated rows: scored alike, each kept. No labels: score 0.5.
    Empty table: no rows.
    """
    model = train(docs, labels, train_documents)
    rows = scored(doc_text(docs), model, "score")
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def scored(docs: DataFrame, model: Model | None, name: str) -> DataFrame:
    """``docs``, all columns, and the score of each text in column ``name``."""
    ship(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = (t.as_py() or "" for t in b.column("text"))
            scores = np.concatenate([document_scores(model, g) for g in _groups(texts)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores)], [*b.schema.names, name])

    return docs.mapInArrow(releasing(score), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, train_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """``docs``, all columns, without the documents predicted bad."""
    model = train(docs, labels, train_documents)
    return scored(docs, model, "__score").where(F.col("__score") >= THRESHOLD).drop("__score")
