"""Quality classifier: nearest-neighbour voting among latent-semantic vectors.

Terms are pairs of neighbouring character classes, as log counts, and levels of three shares of
the text: words equal to the one before, repeated word pairs, and characters that are neither
letters nor white space. Weighted by inverse document frequency they are projected on the leading singular vectors of
a labelled sample. The sample's vectors are broadcast; every document is compared with all of them
by cosine, block by block, and its nearest neighbours vote with their similarity.

The sample holds at most ``SAMPLE`` labelled documents, half of each label as far as there
are enough, chosen by the hash of their id, so what is broadcast has a fixed bound:
``SAMPLE`` x ``RANK`` and ``TERMS`` x ``RANK`` numbers.
"""

import string
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import common

SAMPLE = 4096
RANK = 64
NEIGHBOURS = 25
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
_BLOCK = 128  # documents compared at a time
_CLASSES = 64
_LEVELS = np.array([0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8])
_LEVEL_WEIGHT = 0.4  # of a level, against the length of the character part
_PAIRS = _CLASSES * _CLASSES
TERMS = _PAIRS + 3 * (len(_LEVELS) + 1)


def _byte_classes() -> np.ndarray:
    """Lower-case letters, punctuation marks and line ends one by one; capitals, digits, other
    white space, control and non-ASCII bytes as one class each."""
    classes = np.full(256, 63, np.int64)
    classes[128:] = 62
    for i, mark in enumerate(string.ascii_lowercase + string.punctuation):
        classes[ord(mark)] = i
    classes[[ord(c) for c in string.ascii_uppercase]] = 58
    classes[[ord(c) for c in string.digits]] = 59
    classes[[9, 11, 12, 13, 32]] = 60
    classes[10] = 61
    return classes


_CLASS = _byte_classes()


def terms(text: bytes) -> np.ndarray:
    """Weights of the terms of one text; all zero without two characters."""
    classes = _CLASS[np.frombuffer(text, np.uint8)]
    row = np.zeros(TERMS, np.float32)
    if len(classes) < 2:
        return row
    row[:_PAIRS] = np.log1p(
        np.bincount(classes[:-1] * _CLASSES + classes[1:], minlength=_PAIRS).astype(np.float32)
    )
    words = common.words_of(text.lower())
    follow = list(zip(words, words[1:], strict=False))
    shares = (
        sum(a == b for a, b in follow) / max(1, len(follow)),
        1 - len(set(follow)) / max(1, len(follow)),
        np.count_nonzero((classes > 25) & (classes < 58)) / len(classes),
    )
    levels = np.searchsorted(_LEVELS, shares, side="right")
    weight = _LEVEL_WEIGHT * np.linalg.norm(row[:_PAIRS])
    row[_PAIRS + np.arange(3) * (len(_LEVELS) + 1) + levels] = weight
    return row


@dataclass(frozen=True)
class Model:
    """idf by term, projection (terms x rank), unit vectors (sample x rank), labels, and the
    share of label 1, which texts without terms and models without neighbours score."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return _unit(_unit(rows * self.idf) @ self.projection)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        similar = self.embed(rows) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        weights = np.clip(np.take_along_axis(similar, nearest, axis=1), 0, 1).astype(np.float64)
        total = weights.sum(axis=1)
        votes = (weights * self.labels[nearest]).sum(axis=1)
        return np.where(total > 0, votes / np.where(total > 0, total, 1), self.prior)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-6)


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Latent vectors of a labelled sample (weights by term, 0/1)."""
    if not len(labels):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32),
                     np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    idf = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))).astype(np.float32) + 1
    weighted = _unit(rows * idf)
    rank = min(RANK, *weighted.shape)
    # Randomised range finder with power iterations (Halko, Martinsson, Tropp 2011).
    basis = np.random.default_rng(0).standard_normal((weighted.shape[1], rank)).astype(np.float32)
    for _ in range(6):
        basis = np.linalg.qr(weighted.T @ (weighted @ basis))[0]
    model = Model(idf, basis, np.zeros((0, rank), np.float32), labels, float(labels.mean()))
    return Model(idf, basis, model.embed(rows), labels.astype(np.float64), model.prior)


_SPARSE = pa.schema(
    [("hash", pa.int64()), ("label", pa.int32()), ("at", pa.binary()), ("log", pa.binary())]
)


def _sparse_terms(batches):
    for rows in batches:
        counted = [terms(t) for t in rows.column(2).to_pylist()]
        at = [np.flatnonzero(c).astype(np.int32) for c in counted]
        log = [c[i].tobytes() for c, i in zip(counted, at, strict=True)]
        yield common.batch(
            _SPARSE, [rows.column(0), rows.column(1), [i.tobytes() for i in at], log]
        )


def learn(docs: DataFrame, labels: DataFrame, train, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows of ``labels`` that satisfy the condition ``train``.

    Ids with conflicting labels and labels other than 0 and 1 are left out. Without any label
    every score is one half."""
    common.small_batches(docs.sparkSession)
    marked = (
        labels.where(train)
        .where(F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where("label = other")
        .select("id", F.col("label").cast("int"), F.xxhash64("id").alias("hash"))
    )
    halves = [
        marked.where(F.col("label") == side).orderBy("hash", "id").limit(sample // 2) for side in (0, 1)
    ]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # at most ``sample`` rows of three numbers
    texts = docs.select(F.col("doc_id"), common.utf8(F.col("text")).alias("text")).join(
        chosen, F.col("doc_id") == F.col("id")
    )
    # An id that documents repeat counts once, by its smallest text hash.
    rows = texts.select("hash", "label", "text").mapInArrow(
        _sparse_terms, "hash long, label int, at binary, log binary"
    )
    first = {}
    for row in rows.toLocalIterator():
        key = row["hash"]
        if key not in first or bytes(row["log"]) < bytes(first[key]["log"]):
            first[key] = row
    found = [first[key] for key in sorted(first)]
    dense = np.zeros((len(found), TERMS), np.float32)
    for i, row in enumerate(found):
        dense[i, np.frombuffer(row["at"], np.int32)] = np.frombuffer(row["log"], np.float32)
    return fit(dense, np.array([row["label"] for row in found], np.float64))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; whole texts are read.

    Null and empty texts have no terms and score the sample's share of label 1. Equal texts
    score alike but for the last digits; which of several labelled texts equally near at the last place votes is
    left to the block. Repeated rows give repeated results. Other columns are ignored. An empty table gives an
    empty result."""
    spark = docs.sparkSession
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast(astuple(model))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def scored(batches):
        model = Model(*shared.value)
        for rows in batches:
            texts = rows.column(2).to_pylist()
            blocks = [
                model.score(np.stack([terms(t) for t in texts[i : i + _BLOCK]]))
                for i in range(0, len(texts), _BLOCK)
            ]
            values = np.concatenate(blocks) if blocks else np.zeros(0)
            yield common.batch(schema, [rows.column(0), rows.column(1), np.clip(values, 0, 1)])

    rows = docs.select(
        F.col("doc_id").cast("long"),
        (common.fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        common.utf8(F.col("text")).alias("text"),
    )
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def learnt(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the query: labels whose fold is not held out."""
    return learn(docs, labels, common.fold(F.col("doc_id"), FOLDS) != HELD_OUT)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learnt(docs, labels))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score the threshold or more, all columns kept whatever their names.

    Null and empty texts are kept if the sample's share of label 1 reaches the threshold. Repeated rows stay or go
    together; an empty table stays empty."""
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))

    @F.pandas_udf("boolean")
    def good(texts):
        model, values = Model(*shared.value), texts.tolist()
        keep = [
            model.score(np.stack([terms(t) for t in values[i : i + _BLOCK]])) >= threshold
            for i in range(0, len(values), _BLOCK)
        ]
        return pd.Series(np.concatenate(keep) if keep else np.zeros(0, bool))

    return docs.where(good(common.utf8(F.col("text"))))
