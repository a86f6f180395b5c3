"""Near-duplicate documents by fast similarity sketching, banding and exact verification on full shingle sets.

A sketch has ``bins`` coordinates. In round i every shingle is thrown into one bin by the round's hash, and each bin
keeps its smallest value of the earliest round that reached it; from round ``bins`` on, round bins + j throws all
shingles into bin j, so every coordinate is filled. Two sets agree in a coordinate with a probability equal to their
Jaccard similarity. Bands of coordinates meet in buckets; a bucket is linked to its smallest document first, and only
documents of different components are compared after that, so buckets of copies never become pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.session import materialize

from .common import Hasher, components, mix, shingles, small_batches, word_hashes

_SEED = 301
# Members verified beside one copy of their pivot's text.
_BLOCK = 64
# Members, and shingles of their deltas, that one task holds to compare others with.
_WINDOW, _ITEMS = 4096, 2_000_000


def round_seeds(bins: int) -> np.ndarray:
    return np.random.default_rng(_SEED).integers(1, 2**63, 2 * bins, dtype=np.uint64)


def sketch(values: np.ndarray, bins: int, seeds: np.ndarray) -> np.ndarray:
    """The coordinates of a set of 64-bit values: round in the upper, smallest value in the lower 32 bits."""
    out = np.full(bins, np.uint64(2**64 - 1))
    low, high = np.uint64(2**32 - 1), np.uint64(32)
    for i in range(2 * bins):
        if not len(values):
            break
        thrown = mix(values ^ seeds[i])
        priority = (thrown >> high) | np.uint64(i << 32)
        if i < bins:
            np.minimum.at(out, ((thrown & low) * np.uint64(bins) >> high).astype(np.intp), priority)
        else:
            out[i - bins] = min(out[i - bins], priority.min())
        if i < bins and (out >> high).max() <= i or i >= bins and out.max() < 2**64 - 1:
            break
    return out


def band_hashes(coordinates: np.ndarray, bands: int) -> np.ndarray:
    parts = coordinates.reshape(bands, -1)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(parts.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return out


def features(docs: DataFrame, words: int, bands: int, rows: int, id_col: str, text: str) -> DataFrame:
    """(id, n, d1, d2, bands): set size, a 128-bit digest of the set and the band hashes, per row; no bands for an empty set."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text__"))
    seeds = round_seeds(bands * rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(_SEED, lower=True)
        for batch in small_batches(batches, "text__", 1 << 20):
            sizes, d1, d2, found = [], [], [], []
            for hashes in word_hashes(batch.column("text__"), hasher):
                values = np.unique(shingles(hashes, words))
                sizes.append(len(values))
                d1.append(int(mix(values + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                d2.append(int(mix(values + np.uint64(2)).sum(dtype=np.uint64).view(np.int64)))
                found.append(band_hashes(sketch(values, bands * rows, seeds), bands).view(np.int64) if len(values) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["id", "n", "d1", "d2", "bands"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"id {id_type}, n long, d1 long, d2 long, bands array<long>")


def compared(stars: DataFrame, docs: DataFrame, words: int, percent: int, id_col: str, text: str) -> DataFrame:
    """(a, b, n, linked, delta) of pairs (a, b): the size of b's full set, whether 100 * intersection >= percent * union
    holds for the two, and the shingles that only one of them has.

    Members b are dealt into blocks of about 64 beside a copy of the text of a, so a hub is many small blocks.
    """
    counts = stars.groupBy("a").agg(F.count("*").alias("members"))
    blocks = materialize(
        stars.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("members") / _BLOCK)).alias("block")), "near_pairs")
    # Pairs grow with the corpus, so the texts are joined by a shuffle at every size.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text__")).hint("merge")
    pivots = blocks.select("a", "block").distinct().join(texts, F.col("a") == F.col("id")).select("a", "block", F.lit(False).alias("member"), "id", "text__")
    members = blocks.join(texts, F.col("b") == F.col("id")).select("a", "block", F.lit(True).alias("member"), "id", "text__")
    dealt = pivots.union(members).repartition("a", "block").sortWithinPartitions("a", "block", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(_SEED, lower=True)
        held, group = [], None
        for batch in small_batches(batches, "text__", 1 << 20):
            rows = []
            keys = zip(batch.column("a").to_pylist(), batch.column("block").to_pylist(), batch.column("member").to_pylist(), batch.column("id").to_pylist(), strict=True)
            for (a, block, member, own), hashes in zip(keys, word_hashes(batch.column("text__"), hasher), strict=True):
                values = np.unique(shingles(hashes, words))
                if (a, block) != group:
                    held, group = [], (a, block)
                if not member:
                    held.append(values)
                elif held:
                    # More than one pivot only if its id is repeated; all blocks then measure from the same one.
                    linked = any(_linked(values, pivot, percent) for pivot in held)
                    held.sort(key=np.ndarray.tobytes)
                    rows.append((a, own, len(values), linked, np.setxor1d(values, held[0], assume_unique=True).view(np.int64)))
            a, b, n, linked, delta = zip(*rows, strict=True) if rows else [()] * 5
            kind = batch.schema.field("a").type
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, kind), pa.array(b, kind), pa.array(n, pa.int64()), pa.array(linked, pa.bool_()), pa.array(delta, pa.list_(pa.int64()))],
                names=["a", "b", "n", "linked", "delta"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return dealt.mapInArrow(run, f"a {id_type}, b {id_type}, n long, linked boolean, delta array<long>")


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    if len(one) > len(two):
        one, two = two, one
    if not len(one) or 100 * len(one) < percent * len(two):
        return False
    at = np.searchsorted(two, one)
    both = int((two[np.minimum(at, len(two) - 1)] == one).sum())
    return 100 * both >= percent * (len(one) + len(two) - both)


def cross_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one pivot that lie in different components, enough to connect whatever is linked.

    ``members`` is (pivot, b, n, delta, component, home), home being the pivot's component. Two sets differ by exactly
    the symmetric difference of their deltas, so texts are not needed again. Members outside home are compared with all
    members. These are dealt into windows of bounded size; within one, an inverted index of deltas gives the overlaps,
    and a link is returned only where it joins two components not yet joined there, so rows stay below the members.
    """
    id_type = members.schema["b"].dataType.simpleString()
    sizes = members.groupBy("pivot").agg(
        F.count("*").alias("members"), F.sum(F.size("delta")).alias("items"), F.min("component").alias("low"), F.max("component").alias("high"), F.first("home").alias("home"))
    mixed = sizes.where("low < high OR low <> home").select(
        "pivot", F.greatest(F.ceil(F.col("members") / _WINDOW), F.ceil(F.col("items") / _ITEMS)).alias("windows"))
    rows = materialize(members.join(mixed, "pivot"), "near_members")
    fields = ["b", "n", "delta", "component"]
    targets = rows.select("pivot", F.pmod(F.xxhash64("b"), "windows").alias("window"), F.lit(False).alias("asks"), *fields)
    asking = rows.where("component <> home").select("pivot", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("window"), F.lit(True).alias("asks"), *fields)
    dealt = targets.union(asking).repartition("pivot", "window").sortWithinPartitions("pivot", "window", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, window = None, None
        for batch in batches:
            links: list[tuple] = []
            names = ("pivot", "window", "asks", "b", "n", "delta", "component")
            for pivot, part, asks, own, n, delta, component in zip(*(_column(batch, c) for c in names), strict=True):
                if (pivot, part) != group:
                    group, window = (pivot, part), _Window()
                if asks:
                    links.extend((own, other) for other in window.links(own, n, delta, component, percent))
                else:
                    window.add(own, n, delta, component)
            kind = batch.schema.field("b").type
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], kind), pa.array([x[1] for x in links], kind)], names=["a", "b"])

    return dealt.mapInArrow(run, f"a {id_type}, b {id_type}")


def _column(batch: pa.RecordBatch, name: str) -> list:
    column = batch.column(name)
    if name != "delta":
        return column.to_pylist()
    values, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
    return np.split(values, ends[:-1]) if len(ends) else []


class _Window:
    """Members of a pivot with an inverted index of their deltas, and what has been joined so far."""

    def __init__(self):
        self.ids, self.sizes, self.deltas, self.components = [], [], [], []
        self.items = None
        self.parent: dict = {}

    def add(self, own, n: int, delta: np.ndarray, component) -> None:
        self.ids.append(own)
        self.sizes.append(n)
        self.deltas.append(delta)
        self.components.append(component)

    def _root(self, x):
        while self.parent.setdefault(x, x) != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def _close(self) -> None:
        owners = np.repeat(np.arange(len(self.ids)), [len(d) for d in self.deltas])
        items = np.concatenate(self.deltas) if self.deltas else np.zeros(0, np.int64)
        order = np.argsort(items, kind="stable")
        self.items, self.owners = items[order], owners[order]
        self.n, self.d = np.array(self.sizes, np.int64), np.array([len(d) for d in self.deltas], np.int64)

    def links(self, own, n: int, delta: np.ndarray, component, percent: int) -> list:
        if self.items is None:
            self._close()
        low, high = np.searchsorted(self.items, delta, "left"), np.searchsorted(self.items, delta, "right")
        length = high - low
        at = np.repeat(low - np.cumsum(length) + length, length) + np.arange(length.sum())
        shared = np.bincount(self.owners[at], minlength=len(self.ids))
        differ = len(delta) + self.d - 2 * shared
        found = []
        for k in np.flatnonzero(100 * (n + self.n - differ) >= percent * (n + self.n + differ)):
            one, two = self._root(component), self._root(self.components[k])
            if one != two:
                self.parent[one] = two
                found.append(self.ids[k])
        return found


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 24, rows: int = 5,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, n_shingles, component_id (smallest id reachable over links) and kept (id = component_id).

    Documents are linked if their sets of ``words``-word shingles (A-Z lower-cased; a text with fewer words is one
    shingle) have a Jaccard similarity of ``percent`` or more. Equal sets are one class, linked without a comparison;
    other links are confirmed on full sets. Two sets at the limit share no band of 24 with 5 rows with a probability of
    8e-7 at 85 percent and 6e-5 at 80 percent.

    Empty and null texts, and rows without id, are linked with nothing: they stand alone and are kept (a null id has a
    null component). Rows that repeat an id count as one document: each gets the links of all of them.
    """
    found = materialize(features(docs, words, bands, rows, id_col, text), "near_features")
    usable = found.where("n > 0 AND id IS NOT NULL")
    classes = materialize(usable.groupBy("n", "d1", "d2").agg(F.min(F.struct("id", "bands")).alias("first")).select(
        "n", "d1", "d2", F.col("first.id").alias("rep"), F.col("first.bands").alias("bands")), "near_classes")
    spread = classes.select("rep", F.explode("bands").alias("bucket"))
    buckets = spread.groupBy("bucket").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last").select("bucket", "a")
    stars = spread.join(buckets, "bucket").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    pairs = materialize(compared(stars, docs, words, percent, id_col, text), "near_compared")
    links = pairs.where("linked").select("a", "b")

    # Two documents of a bucket share its pivot, so links that a pivot misses are between its members.
    labels = materialize(components(links, "near_components"), "near_labels")
    members = pairs.join(labels.withColumnRenamed("node", "b"), "b", "left").select("a", "b", "n", "delta", F.coalesce("component", "b").alias("component"))
    members = members.join(labels.select(F.col("node").alias("a"), F.col("component").alias("home")), "a", "left").select(
        F.col("a").alias("pivot"), "b", "n", "delta", "component", F.coalesce("home", "a").alias("home"))
    final = components(links.union(cross_links(members, percent)), "near_components").select(F.col("node").alias("rep"), "component")

    of_class = classes.join(final, "rep", "left").select("n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    joined = found.select("id", "n", "d1", "d2").join(of_class, ["n", "d1", "d2"], "left")
    component = F.when(F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("component", "id"))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("id").eqNullSafe(component)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, one document of each group, with all columns.

    Of rows that repeat an id one stays. Rows without id all stay. Only ids travel beside the texts.
    """
    columns = docs.columns
    found = materialize(near_duplicates(docs, words, percent, id_col=id_col, text=text), "near_found")
    dropped = found.where("NOT kept").select(F.col(id_col).alias("near_id__")).distinct()
    repeated = found.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("near_id__")).agg(F.count("*").alias("n")).where("n > 1").select("near_id__")
    own = F.col(id_col) == F.col("near_id__")
    once = docs.join(dropped.union(repeated).distinct().hint("merge"), own, "left_anti")
    first = docs.join(repeated.join(dropped, "near_id__", "left_anti"), own, "left_semi").dropDuplicates([id_col])
    return once.union(first).select(*columns)
