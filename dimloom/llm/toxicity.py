"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words, neighbouring word pairs and pairs with one word between, hashed
into a table of weights; the value of a feature grows with the logarithm of its count. Training
goes over a sample of labelled rows one text at a time. Each weight has its own rate, and the L1
term keeps most weights at exactly zero, so the model is a short list of (feature, weight).

The sample is bounded: a hash of the id picks ``sample_rows`` labelled ids on average, however
many there are. Features are made where the texts are; one task fits the sample. The weights, at
most ``2 ** BITS``, are broadcast, and every text is scored whole in one scan.

Labels, language, source and id are never inputs of a score. Defined results: null and empty texts
get the score of the bias alone; label rows without id or mark are not used, and several labels of
one id count as one, toxic if any is; without labels of both kinds nothing is learnt and every
score is 0. Repeated rows of documents are scored each; if they are in the sample, the id
is learnt once, from its smallest text. An empty table of documents gives no rows, one of labels
teaches nothing. Texts of any length are read whole. Samples are learnt in the order of a hash of
their id, ties in that of the ids. Further columns, whatever their names, are kept by ``scored``
and otherwise not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import in_small_batches, prepare, whole
from dimloom.llm.words import class_table, mixed, word_hashes

BITS = 20
# Words are runs of letters, digits and bytes beyond ASCII.
CLASSES = class_table(bytes(b for b in range(128) if not chr(b).isalnum()))
_MASK = np.uint64((1 << BITS) - 1)
_PAIR, _SKIP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_SAMPLE_STEPS = 1 << 30


def all_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature of every word, word pair and pair over one word."""
    hashes, first = word_hashes(texts, CLASSES)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    owners, features = [owner], [hashes]
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        same = owner[:-gap] == owner[gap:]
        owners.append(owner[:-gap][same])
        features.append(mixed(hashes[:-gap] * factor + hashes[gap:])[same])
    return np.concatenate(owners), (np.concatenate(features) & _MASK).astype(np.int64)


def counted(owners: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (text, feature) in order, and their counts."""
    both, counts = np.unique(owners << BITS | features, return_counts=True)
    return both >> BITS, both & ((1 << BITS) - 1), counts


def sigmoid(x):
    return np.exp(-np.logaddexp(0, -x))


@dataclass
class Ftrl:
    """Per-coordinate online learner; ``weights`` follow from the sums it keeps."""

    rate: float = 1.0
    smoothing: float = 1.0
    l1: float = 4.0
    l2: float = 1.0

    def __post_init__(self):
        # The bias is the last coordinate.
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, index: np.ndarray) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        shrunk = np.sign(z) * self.l1 - z
        weights = shrunk / ((self.smoothing + np.sqrt(n)) / self.rate + self.l2)
        weights[np.abs(z) <= self.l1] = 0.0
        return weights

    def learn(self, index: np.ndarray, values: np.ndarray, label: int) -> None:
        index = np.append(index, 1 << BITS)
        values = np.append(values, 1.0)
        weights = self.weights(index)
        gradient = (sigmoid(weights @ values) - label) * values
        squares = gradient * gradient
        n = self.n[index]
        sigma = (np.sqrt(n + squares) - np.sqrt(n)) / self.rate
        self.z[index] += gradient - sigma * weights
        self.n[index] = n + squares


@dataclass(frozen=True)
class Model:
    """Features with a weight, the weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS)
        table[self.features] = self.weights
        return table

    def scores(self, texts: list[bytes], dense: np.ndarray) -> np.ndarray:
        owners, features = all_features(texts)
        known = dense[features] != 0
        owners, features, counts = counted(owners[known], features[known])
        parts = dense[features] * (1 + np.log(counts))
        return sigmoid(np.bincount(owners, parts, minlength=len(texts)) + self.bias)


def packed_counts(counts: np.ndarray) -> bytes:
    """In 16 bits each, or in 32 if one needs them."""
    return counts.astype("<u2" if counts.max(initial=0) < 1 << 16 else "<u4").tobytes()


def unpacked_counts(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(packed, "<u2" if len(packed) == 2 * size else "<u4")


def sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        owners, features, counts = counted(*all_features(texts))
        cuts = np.searchsorted(owners, np.arange(len(texts) + 1))
        features = features.astype("<i4")
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("turn"),
                batch.column("toxic"),
                pa.array([features[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([packed_counts(counts[a:b]) for a, b in spans], pa.binary()),
            ],
            names=["turn", "toxic", "features", "counts"],
        )


def learned_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    sample_rows: int = 10_000,
    epochs: int = 3,
    id_col: str = "doc_id",
    text: str = "text",
) -> Model:
    """The model of a bounded sample of the labelled rows for which ``may_learn`` holds.

    ``may_learn`` is a condition on the column doc_id.
    """
    prepare(docs.sparkSession)
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & may_learn)
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .withColumn("turn", F.xxhash64("doc_id"))
    )
    there = marked.count()
    steps = _SAMPLE_STEPS if there <= sample_rows else sample_rows * _SAMPLE_STEPS // there
    picked = marked.where(F.pmod("turn", F.lit(_SAMPLE_STEPS)) < steps)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text).alias("text"))
    sample = (
        texts.join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "turn", "toxic")
        .agg(F.min("text").alias("text"))
        .select("turn", "toxic", "text")
        .mapInArrow(
            in_small_batches(sample_features),
            "turn long, toxic int, features binary, counts binary",
        )
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            columns = (c.to_pylist() for c in batch.columns)
            for _, toxic, features, counts in zip(*columns, strict=True):
                index = np.frombuffer(features, "<i4")
                rows.append((index, unpacked_counts(counts, len(index)), toxic))
        learner = Ftrl()
        if len({toxic for _, _, toxic in rows}) < 2:
            return
        for _ in range(epochs):
            for features, counts, toxic in rows:
                learner.learn(features, 1 + np.log(counts), toxic)
        weights = learner.weights(np.arange((1 << BITS) + 1))
        kept = np.flatnonzero(weights[:-1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([kept.astype("<i4").tobytes()], pa.binary()),
                pa.array([weights[kept].astype("<f8").tobytes()], pa.binary()),
                pa.array([float(weights[-1])], pa.float64()),
            ],
            names=["features", "weights", "bias"],
        )

    one_task = sample.repartition(1).sortWithinPartitions("turn")
    row = one_task.mapInArrow(fit, "features binary, weights binary, bias double").first()
    if row is None:
        return Model(np.zeros(0, "<i4"), np.zeros(0), -np.inf)
    return Model(
        np.frombuffer(bytes(row["features"]), "<i4"),
        np.frombuffer(bytes(row["weights"]), "<f8"),
        row["bias"],
    )


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row``, a struct of all columns of docs, and ``score``, from 0 to 1, of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)
    rows = docs.select(F.struct("*").alias("row"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = shared.value.dense()
        for batch in batches:
            texts = batch.column(0).field(place).cast(pa.binary()).to_pylist()
            scores = shared.value.scores([t or b"" for t in texts], dense)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"]
            )

    return rows.mapInArrow(in_small_batches(score), rows.withColumn("score", F.lit(0.0)).schema)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row. Rows of ids for which ``may_learn``
    does not hold are held out."""
    model = learned_toxicity(docs, labels, may_learn, id_col=id_col, text=text)
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return scored(ids, model).select("row.doc_id", "score").select(
        "doc_id",
        F.coalesce(~may_learn, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
