"""Periodic runs of words: maximal stretches with a smallest period q and at least ``min_exponent`` repetitions.

Method (Lyndon roots). Every run of period q holds a Lyndon word of length q under the order of words or under the
inverse order, and the longest Lyndon word starting there has exactly that length. So the Lyndon arrays of both
orders give every period at every place; a candidate (i, q) is extended to both sides by longest common extensions
between i and i + q, and it is a run when the extension covers two periods. The Lyndon arrays come from suffix
sorting: the longest Lyndon word at i ends at the next suffix that sorts below suffix i. Suffixes are sorted by prefix
doubling that keeps sorting only groups still tied, and the next smaller suffix is found by pointer jumping; both are
numpy passes over all texts of an Arrow batch at once, each text between two separators that sort below every word.
Longest common extensions compare double modular hashes by binary search; every run found is then checked word by
word, so hashes can cost time but never a wrong run.

Planting (``seed``): where seed % 10 == 0 and a text has n > 0 words, word i >= a becomes word a + (i - a) % p, with
g = seed // 10, a = g % n and p = 1 + (n - a) // (3 + g % 8); runs are then found on the planted words.

Defined results: a null text has no words and no runs; a null seed plants nothing; repeated rows get equal results;
texts of any length are whole (memory follows the words of one batch of about ``batch_bytes`` of text, or of one text
if it is longer); an empty table gives an empty result. Only the id, text and seed columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

GAPS = "[\\x20\\x09-\\x0D]+"
_PRIMES = (2147483647, 1000000007)
_BASES = (1_000_003, 911_382_323)

RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_ranks(t: np.ndarray) -> np.ndarray:
    """Place of every suffix of t in sorted order; all suffixes must differ (separators make them)."""
    n = len(t)
    values, inverse, counts = np.unique(t, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse].astype(np.int64)
    k = 1
    while True:
        active = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(active):
            return rank
        ahead = active + k
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        first = rank[active]
        order = np.lexsort((second, first))
        r, s, m = first[order], second[order], len(active)
        steps = np.arange(m)
        group_first = np.maximum.accumulate(np.where(np.r_[True, r[1:] != r[:-1]], steps, 0))
        key_first = np.maximum.accumulate(np.where(np.r_[True, (r[1:] != r[:-1]) | (s[1:] != s[:-1])], steps, 0))
        rank[active[order]] = r + key_first - group_first
        k *= 2


def next_smaller(rank: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each place in ``words``, the next place whose rank is smaller (pointer jumping; each text ends in a smaller
    separator, so it exists)."""
    cand = np.arange(1, len(rank) + 1)
    cand[-1] = len(rank) - 1
    open_ = words
    while len(open_):
        open_ = open_[rank[cand[open_]] >= rank[open_]]
        cand[open_] = cand[cand[open_]]
    return cand


class _Hashes:
    """Hashes of any stretch of a sequence, by two primes, from prefix sums of values times inverse powers."""

    def __init__(self, t: np.ndarray):
        n = len(t)
        self.layers = []
        for p, b in zip(_PRIMES, _BASES, strict=True):
            powers, inverse = _powers(b, n + 1, p), _powers(pow(b, -1, p), n + 1, p)
            terms = (t % p) * inverse[:n] % p
            prefix = np.zeros(n + 1, np.int64)
            np.cumsum(terms, out=prefix[1:])
            self.layers.append((p, powers, prefix % p))

    def equal(self, a: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
        same = np.ones(len(a), bool)
        for p, powers, prefix in self.layers:
            ha = (prefix[a + m] - prefix[a]) % p * powers[a] % p
            hb = (prefix[b + m] - prefix[b]) % p * powers[b] % p
            same &= ha == hb
        return same


def _powers(base: int, n: int, p: int) -> np.ndarray:
    exponent, out, step = np.arange(n, dtype=np.int64), np.ones(n, np.int64), base % p
    bit = 0
    while (1 << bit) < max(n, 1):
        out = np.where(exponent >> bit & 1, out * step % p, out)
        step = step * step % p
        bit += 1
    return out


def _extend(hashes: _Hashes, a: np.ndarray, b: np.ndarray, bound: np.ndarray, backward: bool) -> np.ndarray:
    """Longest m <= bound with t[a:a+m] == t[b:b+m] (or, backward, t[a-m:a] == t[b-m:b]), by binary search."""
    lo, hi = np.zeros(len(a), np.int64), bound.astype(np.int64)
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = hashes.equal(a - mid, b - mid, mid) if backward else hashes.equal(a, b, mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return lo


def plant(n: np.ndarray, seed: np.ndarray, planted: np.ndarray) -> np.ndarray:
    """Source place of every word of texts with ``n`` words (flat, text after text) under the planting rule."""
    doc = np.repeat(np.arange(len(n)), n)
    first = np.repeat(np.cumsum(n) - n, n)
    i = np.arange(n.sum()) - first
    g = seed // 10
    a = np.where(n > 0, g % np.maximum(n, 1), 0)
    p = 1 + (n - a) // (3 + g % 8)
    on = planted[doc] & (i >= a[doc])
    return first + np.where(on, a[doc] + (i - a[doc]) % p[doc], i)


def runs_of(ids: np.ndarray, n: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run, sorted by text, start, period; ``ids`` are word ids, flat."""
    texts = len(n)
    if not len(ids):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    vocab = int(ids.max()) + 1
    # Texts lie between separators: separator k before text k, one more after the last.
    place = np.arange(len(ids)) + np.repeat(np.arange(texts) + 1, n)
    size = len(ids) + texts + 1
    seps = np.setdiff1d(np.arange(size), place)
    doc_of = np.repeat(np.arange(texts), n)
    starts = np.cumsum(n) - n + np.arange(texts) + 1
    ends = starts + n
    found = []
    for inverse in (False, True):
        t = np.empty(size, np.int64)
        t[seps] = np.arange(texts + 1)
        t[place] = texts + 1 + ((vocab - 1 - ids) if inverse else ids)
        rank = suffix_ranks(t)
        lyndon = next_smaller(rank, place)[place] - place
        keep = (lyndon * min_exponent <= n[doc_of]) & (place + 2 * lyndon <= ends[doc_of])
        at, q, d = place[keep], lyndon[keep], doc_of[keep]
        if not inverse:
            hashes = _Hashes(t)
        twice = hashes.equal(at, at + q, q)
        at, q, d = at[twice], q[twice], d[twice]
        right = _extend(hashes, at, at + q, ends[d] - at - q, backward=False)
        left = _extend(hashes, at, at + q, at - starts[d], backward=True)
        found.append((d, at - left - starts[d], q + left + right, q))
    d, start, length, q = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = (length >= np.maximum(min_length, min_exponent * q)) & (length >= 2 * q)
    d, start, length, q = d[keep], start[keep], length[keep], q[keep]
    key = np.unique(np.stack([d, start, q, length], 1), axis=0) if len(d) else np.zeros((0, 4), np.int64)
    d, start, q, length = key.T
    _verify(ids, np.cumsum(n) - n, d, start, length, q, n)
    return d, start, length, q


def _verify(ids, first, d, start, length, q, n) -> None:
    """Each run word by word: period q throughout, and no neighbouring word keeps it."""
    for k in range(len(d)):
        w = ids[first[d[k]] : first[d[k]] + n[d[k]]]
        s, e, p = start[k], start[k] + length[k], q[k]
        if not (np.array_equal(w[s + p : e], w[s : e - p]) and (s == 0 or w[s - 1] != w[s - 1 + p]) and (e == len(w) or w[e] != w[e - p])):
            raise AssertionError("hash collision in run extension")


def find_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id", seed: Column | None = None,
              min_length: int = 6, min_exponent: int = 4, batch_bytes: int = 4 << 20) -> DataFrame:
    """Per row: the id, n_words, runs (start, length, period; by start, then period) and collapsed, the words kept
    (a word is dropped when a run holds it after its first period) joined by one space."""
    source = docs.select(F.col(id_col).alias("id__"), F.col(text).alias("text__"),
                         (seed if seed is not None else F.lit(None)).cast("long").alias("seed__"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text__", batch_bytes, 4096):
            parts = pc.split_pattern_regex(pc.fill_null(batch.column("text__"), ""), GAPS)
            flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts)
            real = pc.greater(pc.binary_length(flat), 0)
            flat, parent = flat.filter(real), parent.filter(real).to_numpy(zero_copy_only=False)
            n = np.bincount(parent, minlength=batch.num_rows).astype(np.int64)
            seed_ = batch.column("seed__")
            seeds = pc.fill_null(seed_, 1).to_numpy(zero_copy_only=False).astype(np.int64)
            planted = pc.fill_null(pc.is_valid(seed_), False).to_numpy(zero_copy_only=False) & (seeds % 10 == 0) & (n > 0)
            words = flat.take(pa.array(plant(n, seeds, planted)))
            ids = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)
            d, start, length, q = runs_of(ids, n, min_length, min_exponent)
            first = np.cumsum(n) - n
            cover = np.zeros(len(ids) + 1, np.int64)
            np.add.at(cover, first[d] + start + q, 1)
            np.add.at(cover, first[d] + start + length, -1)
            kept = np.cumsum(cover[:-1]) == 0
            kept_n = np.bincount(np.repeat(np.arange(batch.num_rows), n)[kept], minlength=batch.num_rows)
            offsets = np.r_[0, np.cumsum(kept_n)].astype(np.int32)
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words.filter(pa.array(kept))), " ")
            counts = np.bincount(d, minlength=batch.num_rows)
            run_offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            runs = pa.ListArray.from_arrays(pa.array(run_offsets), pa.StructArray.from_arrays(
                [pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(q, pa.int64())], fields=list(RUN_TYPE)))
            yield pa.RecordBatch.from_arrays([batch.column("id__"), pa.array(n, pa.int64()), runs, collapsed.cast(pa.string())],
                                             names=[id_col, "n_words", "runs", "collapsed"])

    schema = f"`{id_col}` {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return source.mapInArrow(run, schema)


def contract_seed(id_col: str = "doc_id") -> Column:
    """crc32 of the decimal id, unsigned; null for a null id."""
    return F.crc32(F.col(id_col).cast("string"))
