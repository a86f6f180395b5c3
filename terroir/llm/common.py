"""Helpers shared by the operators: tables, word and line hashes of Arrow text columns, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.session import materialize

# The word of the contracts: anything but ASCII blank and tab to carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"
GAP_BYTES = b" \t\n\x0b\x0c\r"

_CHUNK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str = "text") -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    part = np.empty_like(x)
    for factor, shift in ((0xD6E8FEB86659FD93, 29), (0xA0761D6478BD642F, 32)):
        x *= np.uint64(factor)
        x ^= np.right_shift(x, np.uint64(shift), out=part)
    return x


class Hasher:
    """64-bit hashes of many byte ranges at once: a polynomial over random values of the bytes, then scrambled.

    ``lower`` gives A-Z the values of a-z.
    """

    def __init__(self, seed: int, lower: bool = False):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            self.values[65:91] = self.values[97:123]
        self.base = int(rng.integers(1, 2**62)) * 2 + 1
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, factor in (("powers", self.base), ("inverse", pow(self.base, -1, 2**64))):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of data[s:e] for every range; ranges ascend and do not overlap. Works in slices of about a megabyte."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + _CHUNK, "right")))
            low, high = int(starts[at]), int(ends[to - 1])
            self._grow(high - low + 1)
            terms = np.append(self.values[data[low:high]] * self.powers[: high - low], np.uint64(0))
            edges = np.empty(2 * (to - at), np.int64)
            edges[0::2], edges[1::2] = starts[at:to] - low, ends[at:to] - low
            sums = np.add.reduceat(terms, edges)[0::2]
            sums[starts[at:to] == ends[at:to]] = 0
            out[at:to] = sums * self.inverse[starts[at:to] - low]
            at = to
        return mix(out)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, and where each text begins (one more entry than texts). Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


_GAP = np.zeros(256, bool)
_GAP[list(GAP_BYTES)] = True


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and for every text where its words begin in these lists (one more entry)."""
    inside = ~_GAP[data]
    change = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    # A word that two adjoining texts seem to share is cut at their border.
    inner = np.unique(offsets[1:-1])
    inner = inner[(inner > 0) & (inner < len(data))]
    cut = inner[inside[inner] & inside[inner - 1]] if len(inner) else inner
    if len(cut):
        starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array, hasher: Hasher) -> Iterator[np.ndarray]:
    """The word hashes of each text."""
    data, offsets = bytes_of(column)
    starts, ends, first = word_ranges(data, offsets)
    hashes = hasher.ranges(data, starts, ends)
    for a, b in zip(first[:-1], first[1:], strict=True):
        yield hashes[a:b]


_STEP = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 2**64)) for k in range(64)]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words in order; with fewer words, of the whole sequence; none without words."""
    n = len(words)
    width = min(k, n)
    total = np.zeros(max(0, n - width + 1) if n else 0, np.uint64)
    for j in range(width):
        total += words[j : j + len(total)] * _STEP[j]
    return mix(total)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text, so that memory does not follow the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = bytes_of(batch.column(batch.schema.get_field_index(column)))[1][1:]
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = min(begin + rows, max(begin + 1, int(np.searchsorted(ends, before + limit, "right"))))
            yield batch.slice(begin, end - begin)
            begin = end


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of (a, b) edges as (node, component): component is the smallest node reachable.

    Alternates the large and small star steps: every step joins a table of edges with one row per node, so a hub is
    a skewed join that Spark splits, and never a list. Each round is written to the shared folder. Loops are ignored.
    """
    graph = materialize(_oriented(edges.select("a", "b")), name)
    state = None
    while True:
        graph = materialize(_star(_star(graph, large=True), large=False), name)
        now = graph.agg(F.count("*"), F.sum("b"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    leaves = graph.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = graph.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, once each."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect the neighbours of each node to the smallest of them: the larger ones, or the smaller ones and itself."""
    around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = around.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return _oriented(moved)
