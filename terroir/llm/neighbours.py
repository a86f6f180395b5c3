"""Approximate nearest neighbours over shifted Hilbert curves.

Every curve turns, shifts and projects the vectors in its own way and orders them by their Hilbert key; Spark range-
partitions each order and numbers it, and every ``block`` consecutive vectors form a window. A query looks at the
windows around its own on each curve, the finds of all curves are merged, and scores are exact cosines of the original
vectors. How many windows to look at is measured: on a bounded sample of vectors, against brute force over all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terroir.session import materialize

# Queries that visit one window beside one copy of its vectors.
_CHUNK = 1024


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer cells (points x dimensions, below 2^bits); dimensions times bits is at most 63.

    Gray code and reflections are undone level by level from the top bit, then the bits of all dimensions interleave.
    """
    axes = [cells[:, k].astype(np.int64) for k in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for k in range(len(axes)):
            on = (axes[k] >> level & 1).astype(bool)
            swap = np.where(on, 0, (axes[0] ^ axes[k]) & low)
            axes[0] = np.where(on, axes[0] ^ low, axes[0] ^ swap)
            axes[k] = axes[k] ^ swap
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] >> level & 1, (1 << level) - 1, 0)
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << 1 | (axis ^ flip) >> level & 1
    return key


class Curves:
    """Projections, shifts and scales of all curves, fitted on a sample of unit vectors."""

    def __init__(self, sample: np.ndarray, curves: int, dims: int, bits: int, seed: int = 10):
        rng, width = np.random.default_rng(seed), sample.shape[1]
        self.bits, self.parts = bits, []
        for _ in range(curves):
            turned = rng.normal(size=(width, min(dims, width)))
            turned = np.linalg.qr(turned)[0]
            seen = sample @ turned
            spread = np.maximum(seen.std(0), 1e-9)
            self.parts.append((turned, seen.mean(0) - 3 * spread, 12 * spread, rng.random(turned.shape[1]) / 2))

    def keys(self, units: np.ndarray) -> list[np.ndarray]:
        """Per curve the keys. Three deviations to either side fill half of the grid, the shift moves that half."""
        top = 1 << self.bits
        return [hilbert_keys(np.clip((((units @ turned) - low) / width + shift) * top, 0, top - 1).astype(np.int64), self.bits)
                for turned, low, width, shift in self.parts]


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls and with equal lengths as doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def cosines(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Cosine of row i of both, in double precision and in one order of summation wherever a pair is met."""
    return (one * two).sum(1) / (np.sqrt((one * one).sum(1)) * np.sqrt((two * two).sum(1)))


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v) of the vectors that take part: not null, no null or non-finite component, not zero, the usual length.

    The usual length is the most frequent one (the smaller if two are). A null id takes no part.
    """
    broken = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    good = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    good = good.where(~broken).where((length > 0) & (length < float("inf")))
    usual = good.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    return good.where(F.size("v") == (usual["n"] if usual else 0))


def _placed(classes: DataFrame, curves: Curves, block: int) -> DataFrame:
    """(rep, v, curve, block): every class on every curve, numbered in key order and cut into windows."""
    id_type, v_type = (classes.schema[c].dataType.simpleString() for c in ("rep", "v"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for curve, keys in enumerate(curves.keys(_units(_matrix(batch.column("v"))))):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("rep"), batch.column("v"), pa.array(np.full(batch.num_rows, curve, np.int32)), pa.array(keys)],
                        names=["rep", "v", "curve", "key"])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            own = batch.column("curve").to_numpy()
            index = np.empty(len(own), np.int64)
            for curve in np.unique(own):
                at = np.flatnonzero(own == curve)
                if curve != last:
                    last, count = curve, 0
                index[at] = count + np.arange(len(at))
                count += len(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("v"), batch.column("curve"), pa.array(np.full(len(own), part, np.int32)), pa.array(index)],
                names=["rep", "v", "curve", "part", "i"])

    rows = classes.select("rep", "v").mapInArrow(keyed, f"rep {id_type}, v {v_type}, curve int, key long")
    rows = rows.repartitionByRange("curve", "key", "rep").sortWithinPartitions("curve", "key", "rep")
    rows = materialize(rows.mapInArrow(numbered, f"rep {id_type}, v {v_type}, curve int, part int, i long"), "curve_order")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("curve", "part").agg(F.count("*").alias("n"))
    offsets = counts.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One row per curve and shuffle partition.
    placed = rows.join(F.broadcast(offsets), ["curve", "part"])
    return placed.select("rep", "v", "curve", F.floor((F.col("base") + F.col("i")) / block).alias("block"))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest per row, in any order."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def _brute_force(classes: DataFrame, queries: np.ndarray, k: int) -> DataFrame:
    """(query, rep, score): the k best classes for each of a bounded list of vectors, over all classes."""
    id_type = classes.schema["rep"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            held = _matrix(batch.column("v"))
            chosen = _best(_units(queries) @ _units(held).T, k)
            query = np.repeat(np.arange(len(queries)), chosen.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int32()), batch.column("rep").take(pa.array(chosen.ravel())), pa.array(cosines(queries[query], held[chosen.ravel()]))],
                names=["query", "rep", "score"])

    found = classes.select("rep", "v").mapInArrow(scan, f"query int, rep {id_type}, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _reach(classes: DataFrame, placed: DataFrame, k: int, sample: int, target: float) -> int:
    """Windows to either side that hold ``target`` of the k nearest of a sample of vectors, on the nearest curve."""
    rows = classes.orderBy(F.xxhash64("rep", F.lit(7)), "rep").limit(sample).select("rep", "v").collect()
    if not rows:
        return 0
    ids = {n: r["rep"] for n, r in enumerate(rows)}
    near = _brute_force(classes, np.array([r["v"] for r in rows], np.float64), k + 1).select("query", "rep").collect()
    pairs = [(ids[r["query"]], r["rep"]) for r in near if ids[r["query"]] != r["rep"]]
    if not pairs:
        return 0
    id_type = classes.schema["rep"].dataType.simpleString()
    table = F.broadcast(classes.sparkSession.createDataFrame(pairs, f"a {id_type}, b {id_type}"))  # sample * k rows
    one = placed.select(F.col("rep").alias("a"), "curve", F.col("block").alias("a_block")).join(table, "a")
    two = placed.select(F.col("rep").alias("b"), "curve", "block").join(F.broadcast(table.select("b").distinct()), "b", "left_semi")
    apart = one.join(two, ["b", "curve"]).groupBy("a", "b").agg(F.min(F.abs(F.col("a_block") - F.col("block"))).alias("d")).collect()
    return int(np.ceil(np.quantile([r["d"] for r in apart], target)))


def _visits(placed: DataFrame, query_classes: DataFrame, reach: int, k: int) -> DataFrame:
    """(query, rep, score): the best k classes of every window that a query visits."""
    id_type = placed.schema["rep"].dataType.simpleString()
    asked = placed.join(query_classes.select("rep"), "rep", "left_semi")
    visits = asked.select("rep", "v", "curve", F.explode(F.sequence(F.col("block") - reach, F.col("block") + reach)).alias("block"))
    crowd = visits.groupBy("curve", "block").agg(F.count("*").alias("n")).withColumn("chunks", F.ceil(F.col("n") / _CHUNK))
    windows = placed.join(crowd, ["curve", "block"]).select(
        "curve", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(False).alias("asks"), "rep", "v")
    asking = visits.join(crowd.select("curve", "block", "chunks"), ["curve", "block"]).select(
        "curve", "block", F.pmod(F.xxhash64("rep"), F.col("chunks")).alias("chunk"), F.lit(True).alias("asks"), "rep", "v")
    dealt = windows.union(asking).repartition("curve", "block", "chunk").sortWithinPartitions("curve", "block", "chunk", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, names = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, reps = _matrix(batch.column("v")), batch.column("rep")
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("curve", "block", "chunk", "asks")], 1)
            cuts = np.append(np.flatnonzero((np.diff(keys, axis=0, prepend=keys[:1] - 1) != 0).any(1)), len(keys))
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                key = tuple(keys[begin][:3])
                if key != group:
                    group, held, names = key, [], []
                if not keys[begin][3]:
                    held.append(vectors[begin:end])
                    names.append(reps.slice(begin, end - begin))
                    continue
                if not held:
                    continue
                window, window_ids = np.concatenate(held), pa.concat_arrays(names)
                held, names = [window], [window_ids]
                asked_for = vectors[begin:end]
                chosen = _best(_units(asked_for) @ _units(window).T, k)
                row = np.repeat(np.arange(end - begin), chosen.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [reps.slice(begin, end - begin).take(pa.array(row)), window_ids.take(pa.array(chosen.ravel())),
                     pa.array(cosines(asked_for[row], window[chosen.ravel()]))],
                    names=["query", "rep", "score"])

    return dealt.mapInArrow(search, f"query {id_type}, rep {id_type}, score double")


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", curves: int = 8, dims: int = 16,
            bits: int = 3, block: int = 512, sample: int = 100, target: float = 0.96, fit_rows: int = 2000) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that ``is_query`` (a condition) holds for.

    Largest cosine first, ties to the smaller id; never the query's own row; all others if there are fewer than k.
    Equal vectors are one class that knows its k + 1 smallest ids, so copies neither crowd a window nor hide each
    other. ``fit_rows`` vectors fit the curves and ``sample`` vectors the number of windows; all are indexed. A query
    visits as many windows as ``target`` of the sample's true neighbours need, so hard data costs more, not recall.

    Vectors that are null, zero, of unusual length or with null or non-finite components take no part, nor do rows
    without id. Rows that repeat id and vector count once. An empty table gives no rows.
    """
    good = materialize(usable(vectors, id_col, vector).distinct(), "vectors")
    by_id = Window.partitionBy("v").orderBy("id")
    first = good.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
    classes = materialize(first.groupBy("v").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")).select("rep", "v", "ids"), "vector_classes")
    asked = good.where(is_query(F.col("id"))).join(classes.select("v", "rep"), "v").select(F.col("id").alias("query_id"), "rep")
    asked = materialize(asked, "query_vectors")
    fitted = classes.orderBy(F.xxhash64("rep"), "rep").limit(fit_rows).select("v").collect()
    width = len(fitted[0]["v"]) if fitted else 1
    known = _units(np.array([r["v"] for r in fitted], np.float64)) if fitted else np.ones((1, width))
    placed = materialize(_placed(classes, Curves(known, curves, dims, bits), block), "curve_windows")
    found = _visits(placed, asked.select("rep").distinct(), _reach(classes, placed, k, sample, target), k + 1)
    once = found.groupBy("query", "rep").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    top = once.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    each = top.join(classes.select("rep", F.explode("ids").alias("vec_id")), "rep").select(F.col("query").alias("rep"), "vec_id", "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = asked.join(each, "rep").where("vec_id <> query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")
