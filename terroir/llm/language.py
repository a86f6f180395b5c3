"""Language identification with error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit, linear in hashed letter n-grams, predicts that
bit; loss-weighted decoding picks the language whose codeword costs least, and a small lead over the second best is
flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, small_batches

UNKNOWN = "und"


@dataclass(frozen=True)
class CodeModel:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits, entries -1 and 1
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray  # bits
    trust: np.ndarray  # languages x bits: how far a bit's classifier is right on a language, rows add up to 1
    scale: float  # from a lead in cost to a probability
    buckets: int


def codewords(n_languages: int, bits: int, seed: int = 9) -> np.ndarray:
    """Codewords of -1 and 1 with distant rows and no constant column: the best of many random codes.

    Up to five languages take every split of the languages in two, which is the most distant code there is.
    """
    if n_languages < 2:
        return np.ones((n_languages, 1))
    if n_languages <= 5:
        splits = [[1 if k == 0 or m >> (k - 1) & 1 else -1 for k in range(n_languages)] for m in range(2 ** (n_languages - 1) - 1)]
        return np.array(splits, float).T
    rng, best, found = np.random.default_rng(seed), None, -1
    for _ in range(300):
        code = rng.choice([-1.0, 1.0], (n_languages, bits))
        flat = np.abs(code.sum(0)) == n_languages
        code[0, flat] *= -1
        apart = ((bits - code @ code.T) / 2 + np.eye(n_languages) * bits).min()
        if apart > found:
            best, found = code, apart
    return best


# Bytes by kind. Letters keep their lower-case byte, UTF-8 bytes above ASCII stay, all else is a gap.
_FOLD = np.zeros(256, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:256] = np.arange(128, 256)


def ngram_counts(column: pa.Array, buckets: int) -> np.ndarray:
    """Counts of hashed byte n-grams of two and three letters per text; gaps count once, runs of them not.

    Every text has a gap before and after it, so a text of one letter has n-grams too.
    """
    data, offsets = bytes_of(column)
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(n, dtype=np.int64), lengths + 2)
    folded = np.zeros(len(data) + 2 * n, np.uint32)
    folded[np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, lengths)] = _FOLD[data]
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0) | (folded[:-1] != 0) | (row[1:] != row[:-1])
    folded, row = folded[keep], row[keep]
    if len(folded) < 2:
        return np.zeros((n, buckets))
    two = folded[:-1] * np.uint32(256) + folded[1:]
    three = folded[:-2] * np.uint32(65536) + folded[1:-1] * np.uint32(256) + folded[2:]
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    counts = np.zeros(n * buckets)
    for grams, last, factor in ((two, 1, 0x9E3779B1), (three, 2, 0x85EBCA6B)):
        same = row[last:] == row[: len(row) - last]
        bucket = ((grams * np.uint32(factor)) >> shift).astype(np.int64)
        counts += np.bincount((row[: len(bucket)] * buckets + bucket)[same], minlength=n * buckets)
    return counts.reshape(n, buckets)


def _fractions(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", sample: int = 6000,
        buckets: int = 4096, bits: int = 31, max_languages: int = 1000) -> CodeModel:
    """Fit on about ``sample`` labelled rows, chosen by a hash of the id alone, whatever the size of the table.

    Rows without text or language are left out. The sample's n-gram counts are summed on the executors, per language
    and half of the sample; the driver gets two vectors of ``buckets`` numbers per language. The first half gives the
    bits' classifiers, the second the trust in each bit. No rows give a model that knows no language.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.lit(31)).alias("h"))
    total = rows.count()
    if total > sample:
        rows = rows.where(F.col("h") <= int(-(2**63) + 2**64 * (sample / total)))
    rows = rows.withColumn("half", F.pmod("h", F.lit(2)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in small_batches(batches, "text", 256 << 10, 256):
            part = _fractions(ngram_counts(batch.column("text"), buckets))
            for k, key in enumerate(zip(batch.column("lang").to_pylist(), batch.column("half").to_pylist(), strict=True)):
                if part[k].any():
                    sums.setdefault(key, np.zeros(buckets + 1))[:-1] += part[k]
                    sums[key][-1] += 1
        for (name, half), vector in sums.items():
            at = np.flatnonzero(vector)
            yield pa.RecordBatch.from_pydict({
                "lang": [name] * len(at), "half": pa.array([half] * len(at), pa.int64()), "k": at, "v": vector[at]})

    summed = rows.select("lang", "half", "text").mapInArrow(count, "lang string, half long, k long, v double")
    found = summed.groupBy("lang", "half", "k").agg(F.sum("v").alias("v")).toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    if len(languages) > max_languages:
        raise ValueError(f"{len(languages)} languages; raise max_languages")
    by_half = np.zeros((2, len(languages), buckets + 1))
    by_half[found["half"].to_numpy(int), [languages.index(x) for x in found["lang"]], found["k"].to_numpy(int)] = found["v"]
    return _fit_bits(languages, by_half, bits, buckets)


def _fit_bits(languages: tuple[str, ...], by_half: np.ndarray, bits: int, buckets: int) -> CodeModel:
    """Each bit: log odds of an n-gram among the languages with the bit against those without, every language alike."""
    code = codewords(len(languages), bits)
    n = by_half[:, :, -1:]
    train = by_half[0] if by_half[0][:, -1].all() else by_half.sum(0)
    shares = train[:, :-1] / np.maximum(train[:, -1:], 1)
    smooth = 0.02 / buckets
    weights, bias = np.zeros((buckets, code.shape[1])), np.zeros(code.shape[1])
    for b in range(code.shape[1]):
        with_bit = code[:, b] > 0
        yes = shares[with_bit].mean(0) if with_bit.any() else np.zeros(buckets)
        no = shares[~with_bit].mean(0) if (~with_bit).any() else np.zeros(buckets)
        weights[:, b] = np.log((yes + smooth) / (no + smooth))
        middle = [shares[k] @ weights[:, b] for k in range(len(languages))]
        if with_bit.any() and (~with_bit).any():
            low, high = max(x for x, w in zip(middle, with_bit) if not w), min(x for x, w in zip(middle, with_bit) if w)
            half = max((high - low) / 2, 1e-3)
            weights[:, b] /= half
            bias[b] = -(low + high) / 2 / half
    other = by_half[1][:, :-1] / np.maximum(n[1], 1)
    other[n[1][:, 0] == 0] = shares[n[1][:, 0] == 0]
    right = np.clip(code * (other @ weights + bias), 0.05, 1)  # a language's mean margin on held-back rows
    trust = right / right.sum(1, keepdims=True)
    return CodeModel(languages, code, weights.astype(np.float32), bias, trust, 4.0, buckets)


def decode(model: CodeModel, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the cheapest codeword (-1 without a language or n-gram) and its probability, 0 to 1.

    The cost of a language is the logistic loss of its codeword's bits, weighted by the trust in them.
    """
    n = len(counts)
    if not model.languages:
        return np.full(n, -1), np.zeros(n)
    margin = np.clip(_fractions(counts).astype(np.float32) @ model.weights + model.bias, -4, 4)
    cost = np.stack([np.logaddexp(0, -2 * margin * model.code[k]) @ model.trust[k] for k in range(len(model.languages))], 1)
    odds = np.exp(-model.scale * (cost - cost.min(1, keepdims=True)))
    best = np.where(counts.any(1), cost.argmin(1), -1)
    return best, np.where(best >= 0, odds.max(1) / odds.sum(1), 0)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def identify(docs: DataFrame, model: CodeModel, text: str = "text", ambiguous_below: float = 0.5,
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, lang_pred, score (0 to 1) and ambiguous, per row; whole texts are read.

    ``und`` with score 0: null, empty or letterless texts, texts in a script without any n-gram, and every text if the
    model knows no language; all of these are ambiguous. Repeated rows get equal results. Columns beside ``keep`` and
    the text are not read, so extra ones cannot clash.
    """
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    source = docs.select(*keep, F.col(text).alias("text__"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text__", 256 << 10, 256):
            texts = batch.column("text__")
            best, score = decode(model, ngram_counts(texts, model.buckets))
            lettered = np.array([_has_letter(t) for t in texts.to_pylist()], bool)
            known = lettered & (best >= 0)
            score = np.where(known, score, 0.0)
            names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(keep))]
                + [pa.array(names, pa.string()), pa.array(score), pa.array(score < ambiguous_below)],
                names=[*keep, "lang_pred", "score", "ambiguous"])

    return source.mapInArrow(predict, schema)


def known_language(docs: DataFrame, model: CodeModel, text: str = "text", ambiguous_below: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is known: neither ``und`` nor ambiguous."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text, 256 << 10, 256):
            texts = batch.column(columns.index(text))
            best, score = decode(model, ngram_counts(texts, model.buckets))
            lettered = np.array([_has_letter(t) for t in texts.to_pylist()], bool)
            yield batch.filter(pa.array(lettered & (best >= 0) & (score >= ambiguous_below)))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id"):
    """Documents kept away from learning: crc32 of the id as text, modulo 5, is 0. Null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents that may be learned from: they have an id and are not held out."""
    return docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
