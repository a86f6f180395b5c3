"""Document quality by attention-based multiple-instance learning: a document is a bag of passages.

Every passage (a line with a word) is encoded: its hashed features (words, word shapes such as ``Aaa!!``, word pairs)
weighted to sum to one, times a learned table, give a vector e. Gated attention weighs the passages of a document,
a = softmax(w . (tanh(V e) * sigmoid(U e))), and the document is scored by the weighted passage vector z = sum a e:
score = sigmoid(c . z + b). Labels are only known per document; table, gates and scorer are learned together from
them by gradient descent with Adam, on the driver, from at most ``sample`` labelled documents chosen by a hash of
their id (a documented bound; their texts come to the driver whole). Scoring runs on the executors, batch by batch,
with the model broadcast: its size is fixed by ``buckets`` and ``dim``, not by the data.

Defined results: a document without passages (null, empty or blank text) has z = 0 and gets sigmoid(b); repeated rows
get equal scores; texts are read whole; a table without labelled rows gives a model that scores every document 0.5;
an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, bytes_of, mix, small_batches, word_ranges

# Byte classes of word shapes: upper-case letters, lower-case letters and digits each become one class.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58] = 65, 97, 48
_WORDS, _SHAPES = Hasher(21), Hasher(22)


@dataclass(frozen=True)
class MilModel:
    table: np.ndarray  # buckets x dim
    V: np.ndarray  # dim x gate
    U: np.ndarray  # dim x gate
    w: np.ndarray  # gate
    c: np.ndarray  # dim
    b: float


@dataclass
class Bags:
    """Sparse passage features of many texts: feature rows grouped by passage, passages by text."""
    bucket: np.ndarray
    weight: np.ndarray
    passage_start: np.ndarray  # first feature of each passage
    text_of_passage: np.ndarray
    texts: int


def featurize(column: pa.Array, buckets: int) -> Bags:
    data, offsets = bytes_of(column)
    texts = len(offsets) - 1
    starts, ends, first = word_ranges(data, offsets)
    if not len(starts):
        return Bags(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64), texts)
    text_of_word = np.repeat(np.arange(texts), np.diff(first))
    newlines = np.cumsum(data == 10)
    _, passage = np.unique(text_of_word * (len(data) + 1) + newlines[starts], return_inverse=True)
    words = _WORDS.ranges(data, starts, ends)
    shapes = _SHAPES.ranges(_SHAPE[data], starts, ends)
    same = passage[1:] == passage[:-1]
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ words[1:])[same]
    feats = np.concatenate([words, shapes, pairs]) % np.uint64(buckets)
    owner = np.concatenate([passage, passage, passage[:-1][same]])
    order = np.argsort(owner, kind="stable")
    feats, owner = feats[order].astype(np.int64), owner[order]
    counts = np.bincount(owner, minlength=passage.max() + 1)
    text_of_passage = np.zeros(len(counts), np.int64)
    text_of_passage[passage] = text_of_word
    return Bags(feats, (1.0 / counts)[owner], np.r_[0, np.cumsum(counts)[:-1]], text_of_passage, texts)


def _segments(values: np.ndarray, starts: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros((rows, *values.shape[1:]), values.dtype)
    if len(values):
        out[:] = np.add.reduceat(values, starts, axis=0)
    return out


class _Forward:
    def __init__(self, model: MilModel, bags: Bags):
        self.bags = bags
        p = len(bags.passage_start)
        self.E = _segments(model.table[bags.bucket] * bags.weight[:, None].astype(model.table.dtype), bags.passage_start, p) if p else np.zeros((0, model.table.shape[1]))
        self.A, self.G = np.tanh(self.E @ model.V), 1 / (1 + np.exp(-(self.E @ model.U)))
        s = (self.A * self.G) @ model.w
        doc = bags.text_of_passage
        self.Z = np.zeros((bags.texts, model.table.shape[1]), self.E.dtype)
        self.a = s
        if p:
            # Passages come text by text: each text with passages is one segment.
            owners, first = np.unique(doc, return_index=True)
            top = np.maximum.reduceat(s, first)
            ex = np.exp(s - np.repeat(top, np.diff(np.r_[first, p])))
            self.a = ex / np.bincount(doc, ex, bags.texts)[doc]
            self.Z[owners] = np.add.reduceat(self.a[:, None] * self.E, first, axis=0)
        self.y = 1 / (1 + np.exp(-(self.Z @ model.c + model.b)))


def score(model: MilModel, column: pa.Array, buckets: int) -> np.ndarray:
    return _Forward(model, featurize(column, buckets)).y


def train(texts: list[str | None], labels: np.ndarray, buckets: int = 1 << 15, dim: int = 16, gate: int = 8, epochs: int = 60,
          rate: float = 0.1, decay: float = 1e-5, seed: int = 5) -> MilModel:
    """Full-batch Adam on the mean logistic loss of the documents."""
    rng = np.random.default_rng(seed)
    params = {"table": rng.normal(0, 0.1, (buckets, dim)), "V": rng.normal(0, 0.3, (dim, gate)), "U": rng.normal(0, 0.3, (dim, gate)),
              "w": rng.normal(0, 0.3, gate), "c": np.zeros(dim), "b": np.zeros(1)}
    params = {k: v.astype(np.float32) for k, v in params.items()}
    if not len(texts):
        return MilModel(**{k: v for k, v in params.items() if k != "b"}, b=0.0)
    bags = featurize(pa.array(texts, pa.string()), buckets)
    doc, n = bags.text_of_passage, len(texts)
    by_bucket = np.argsort(bags.bucket, kind="stable")
    used, bucket_start = np.unique(bags.bucket[by_bucket], return_index=True)
    passage_of_feature = np.repeat(np.arange(len(bags.passage_start)), np.diff(np.r_[bags.passage_start, len(bags.bucket)]))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    for step in range(1, epochs + 1):
        model = MilModel(**{k: v for k, v in params.items() if k != "b"}, b=float(params["b"][0]))
        f = _Forward(model, bags)
        g = (f.y - labels) / n
        dZ = g[:, None] * model.c
        grads = {"c": f.Z.T @ g, "b": np.array([g.sum()])}
        dE = f.a[:, None] * dZ[doc]
        da = (f.E * dZ[doc]).sum(1)
        ds = f.a * (da - np.bincount(doc, f.a * da, n)[doc])
        grads["w"] = (f.A * f.G).T @ ds
        dAG = ds[:, None] * model.w
        dEV, dEU = dAG * f.G * (1 - f.A**2), dAG * f.A * f.G * (1 - f.G)
        grads["V"], grads["U"] = f.E.T @ dEV, f.E.T @ dEU
        dE += dEV @ model.V.T + dEU @ model.U.T
        table = np.zeros_like(params["table"])
        if len(used):
            table[used] = np.add.reduceat((dE[passage_of_feature] * bags.weight[:, None].astype(np.float32))[by_bucket], bucket_start, axis=0)
        grads["table"] = table + decay * params["table"]
        for k, grad in grads.items():
            m, v = moments[k]
            m *= 0.9
            m += 0.1 * grad
            v *= 0.999
            v += 0.001 * grad**2
            params[k] = params[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return MilModel(**{k: v.astype(np.float64) for k, v in params.items() if k != "b"}, b=float(params["b"][0]))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", sample: int = 1000,
        **options) -> tuple[MilModel, int]:
    """Learn from at most ``sample`` documents with a non-null label, chosen by a hash of the id alone; returns the
    model and its number of buckets."""
    rows = docs.select(F.col(id_col).alias("id__"), F.col(text).alias("text__")).join(
        labels.where(F.col(label).isNotNull()).select(F.col(id_col).alias("id__"), F.col(label).cast("double").alias("y__")), "id__")
    rows = rows.withColumn("h__", F.xxhash64(F.col("id__").cast("string"), F.lit(12)))
    total = rows.count()
    if total > sample:
        rows = rows.where(F.col("h__") <= int(-(2**63) + 2**64 * (sample / total)))
    got = rows.select("text__", "y__").toPandas()
    buckets = options.setdefault("buckets", 1 << 15)
    return train(got["text__"].tolist(), got["y__"].to_numpy(float), **options), buckets


def score_docs(docs: DataFrame, model: MilModel, buckets: int, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: the id and score, 0 to 1; higher means label 1 is likelier."""
    source = docs.select(F.col(id_col).alias("id__"), F.col(text).alias("text__"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text__", 1 << 20, 1024):
            y = score(shared.value, batch.column("text__"), buckets)
            yield pa.RecordBatch.from_arrays([batch.column("id__"), pa.array(y, pa.float64())], names=[id_col, "score"])

    return source.mapInArrow(run, f"`{id_col}` {id_type}, score double")
