"""Quality classifier: random-indexing word vectors and a two-layer network in numpy.

Tokens are runs of letters or digits in lower case, and runs of other signs; a capitalised,
an upper-case and a mixed form of a word are told apart by one more feature token. A token's slot
is a hash. Every slot has a fixed sparse vector of signs; the vector of a slot is the sum of the
signs of the tokens next to it, over all documents: one matrix of fixed size that every task adds
to. A document is the mean and the spread of its tokens' vectors.

The network is fitted on the driver on at most ``SAMPLE`` labelled documents, the first in the
order of a hash, a fifth of which sets the temperature of its probabilities. Documents whose
crc32 of the id leaves 2 modulo 4 are held out from learning.

Defined results: a null or empty text is a zero vector and gets the score of one; labels that are
null or differ for one id are not learnt from; with fewer than two classes to learn every score
is the share of label 1 (0.5 without labels); repeated rows repeat; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snaptrack.llm.graph import task_totals
from snaptrack.llm.ragged import SPACE, SpanHasher, lowered, mixed, pieces
from snaptrack.llm.tables import first_ids, stored, table

SLOTS = 1 << 13
WIDTH = 64
SIGNS = 4
POOLED = 2 * WIDTH + 1
SAMPLE = 16384
HIDDEN = 32
EPOCHS = 60
CUT = 0.7


def tokens(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher):
    """Slots of all tokens and the offsets of each text."""
    kind = np.full(256, 2, np.uint8)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kind[low:high] = 1
    kind[SPACE] = 0
    kinds = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:-1] |= kinds[1:] != kinds[:-1]
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    solid = kinds[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    upper = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data >= 65) & (data <= 90), out=upper[1:])
    capitals = upper[ends] - upper[starts]
    form = np.minimum(capitals, 2) * (ends - starts > 1)
    words = hasher(lowered(data), starts, ends)
    slots = mixed(words + form.astype(np.uint64)) % np.uint64(SLOTS)
    return slots.astype(np.int64), np.searchsorted(starts, offsets)


def signs() -> tuple[np.ndarray, np.ndarray]:
    """The places and signs of every slot's index vector."""
    drawn = mixed(np.arange(SLOTS * SIGNS, dtype=np.uint64) + np.uint64(77)).reshape(SLOTS, SIGNS)
    place = (drawn % np.uint64(WIDTH)).astype(np.int64)
    return place, np.where(drawn >> np.uint64(40) & np.uint64(1), 1, -1)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Slots x width: for each slot the signs of its neighbours, over all documents."""

    def update(batches, total):
        hasher = SpanHasher(31)
        place, sign = signs()
        for _, data, offsets in pieces(batches):
            slots, at = tokens(data, offsets, hasher)
            row = np.repeat(np.arange(len(at) - 1), np.diff(at))
            for step in (1, 2):
                left, right = slots[:-step], slots[step:]
                same = row[:-step] == row[step:]
                for a, b in ((left[same], right[same]), (right[same], left[same])):
                    for i in range(SIGNS):
                        where = a * WIDTH + place[b, i]
                        total += np.bincount(
                            where, sign[b, i], minlength=SLOTS * WIDTH
                        ).astype(np.int64)

    total = task_totals(docs.select("text"), update, SLOTS * WIDTH).reshape(SLOTS, WIDTH)
    length = np.sqrt((total.astype(float) ** 2).sum(1, keepdims=True))
    return (total / np.maximum(length, 1)).astype(np.float32)


def pooled(data, offsets, vectors: np.ndarray, hasher: SpanHasher) -> np.ndarray:
    """Texts x (mean and spread of their tokens' vectors, share of tokens like the one before)."""
    slots, at = tokens(data, offsets, hasher)
    out = np.zeros((len(at) - 1, POOLED), np.float32)
    again = np.zeros(len(slots) + 1, np.int64)
    if len(slots):
        np.cumsum(slots[1:] == slots[:-1], out=again[2:])
    for i, (low, high) in enumerate(zip(at[:-1], at[1:])):
        if high > low:
            used, count = np.unique(slots[low:high], return_counts=True)
            weight = (count / (high - low)).astype(np.float32)
            mean = weight @ vectors[used]
            square = weight @ vectors[used] ** 2
            out[i, :WIDTH], out[i, WIDTH:-1] = mean, np.sqrt(np.maximum(square - mean**2, 0))
            out[i, -1] = (again[high] - again[low + 1]) / (high - low)
    return out


def features(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher(31)
        for part, data, offsets in pieces(batches):
            rows = pooled(data, offsets, vectors, hasher)
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
            lists = pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("y").cast(pa.int32()), lists], ["y", "x"]
            )

    return docs.select("text", "y").mapInArrow(run, "y int, x array<float>")


class Network(NamedTuple):
    """Standardization, two layers and the temperature."""

    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.spread
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def constant(share: float, width: int) -> Network:
    share = min(max(share, 0.01), 0.99)
    zero = np.zeros((width, 1))
    return Network(zero[:, 0], zero[:, 0] + 1, zero, zero[0], zero[0], np.log(share / (1 - share)), 1.0)


def fitted(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS) -> Network:
    """Adam on four fifths of the rows; the rest chooses the temperature."""
    width = x.shape[1] if len(x) else POOLED
    if len(set(y.tolist())) < 2 or len(y) < 10:
        return constant(float(y.mean()) if len(y) else 0.5, width)
    rng = np.random.default_rng(0)
    order = rng.permutation(len(y))
    x, y = x[order].astype(float), y[order].astype(float)
    mean, spread = x.mean(0), x.std(0) + 1e-6
    held = max(1, len(y) // 5)
    z = (x - mean) / spread
    train, target = z[held:], y[held:]
    weights = [
        rng.normal(size=(width, hidden)) * np.sqrt(2 / width), np.zeros(hidden),
        rng.normal(size=hidden) * np.sqrt(2 / hidden), np.zeros(1),
    ]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    step = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(target)), max(1, len(target) // 128)):
            step += 1
            a, b = train[part], target[part]
            inner = np.maximum(a @ weights[0] + weights[1], 0)
            error = (1 / (1 + np.exp(-np.clip(inner @ weights[2] + weights[3], -30, 30))) - b) / len(b)
            back = np.outer(error, weights[2]) * (inner > 0)
            slopes = [a.T @ back + 1e-4 * weights[0], back.sum(0), inner.T @ error, error.sum(keepdims=True)]
            for w, m, v, slope in zip(weights, first, second, slopes):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                w -= 0.002 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, spread, *weights[:3], float(weights[3][0]), 1.0)
    logits = net.logits(x[:held])
    choices = np.exp(np.linspace(-1, 3, 81))
    return net._replace(temperature=float(min(choices, key=lambda t: loss(logits / t, y[:held]))))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learnt(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``text, y`` of at most ``sample`` labelled documents that are not held out; of rows
    of one id the one with the smallest text hash, so that an id on many rows gives one."""
    known = labels.select("doc_id", F.col("quality").alias("y")).filter("y in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_other"))
    known = known.filter((F.col("y") == F.col("_other")) & ~held_out(F.col("doc_id")))
    known = stored(known.select("doc_id", "y"), "labels")
    chosen = known.join(F.broadcast(first_ids(known, sample)), "doc_id")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y")).alias("row"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").select("row.text", "row.y")


def scored(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    vectors = word_vectors(docs)
    rows = features(learnt(docs, labels), vectors).collect()  # at most SAMPLE vectors
    x = np.array([row["x"] for row in rows], np.float32).reshape(-1, POOLED)
    net = fitted(x, np.array([row["y"] for row in rows], float))

    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher(31)
        for part, data, offsets in pieces(batches):
            scores = net.scores(pooled(data, offsets, vectors, hasher))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(scores.astype(float))],
                ["doc_id", "score"],
            )

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
