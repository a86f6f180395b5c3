"""Global order statistics that never put the whole frame into one task.

A window without partition keys, or an exact percentile buffer, would pull an
unbounded group into one task. Both are replaced here by: pre-aggregate equal
values, cut the value range at quantile sketches (bounded arrays), rank inside
the pieces and add the offsets of the pieces before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
PIECES = 256


def cumulative_counts(df: DataFrame, value: str, pieces: int = PIECES) -> DataFrame:
    """Distinct non-null values with their count ``n``, the count of values <= them ``upto`` and ``total``.

    Equal values meet in a pre-aggregated row first, so copies cost nothing. One
    window per piece of the value range follows; the offsets table has at most
    ``pieces`` + 1 rows, so broadcasting it is bounded by the parameter.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    cuts = counted.agg(
        F.array_distinct(F.percentile_approx(value, [i / pieces for i in range(1, pieces)], SKETCH_ACCURACY)).alias("cuts")
    )
    cut = counted.withColumn("_cuts", cuts.scalar())
    cut = cut.withColumn("_piece", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    totals = cut.groupBy("_piece").agg(F.sum("n").alias("_total"))
    every = Window.orderBy("_piece")
    offsets = totals.select(
        "_piece",
        F.coalesce(F.sum("_total").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_total").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    running = F.sum("n").over(Window.partitionBy("_piece").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return (
        cut.withColumn("_running", running)
        .join(F.broadcast(offsets), "_piece")
        .select(value, "n", (F.col("_before") + F.col("_running")).alias("upto"), "total")
    )


def spread_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on one key whose null rows do not all land in the same task."""
    spread = F.when(F.col(key).isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(4096)) + 1).otherwise(F.lit(0))
    return (
        left.withColumn("_spread", spread)
        .join(right.withColumn("_spread", F.lit(0).cast("bigint")), [key, "_spread"], "left")
        .drop("_spread")
    )


def percentile_score(df: DataFrame, value: str, out: str, higher_is_better: bool, neutral: float) -> DataFrame:
    """0-100 share of non-null values <= the row's value (or >= it); null scores ``neutral``.

    Reads ``df`` twice: give it a stored or materialised frame.
    """
    share = F.col("upto") if higher_is_better else F.col("total") - F.col("upto") + F.col("n")
    table = cumulative_counts(df, value).select(value, (share / F.col("total") * 100.0).alias(out))
    joined = spread_left_join(df, table, value)
    # The share lies in (0, 100] by construction.
    return joined.withColumn(out, F.coalesce(out, F.lit(neutral)))


def median_by(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact interpolated median per group (percentile_cont 0.5) without a per-group value buffer.

    A mergeable sketch brackets the middle of each group; everything below the
    bracket collapses to one counted row, everything above is dropped, and only
    the distinct values inside the bracket are ranked.
    """
    keys = list(keys)
    present = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    eps = 2.0 / SKETCH_ACCURACY
    bracket = present.groupBy(*keys).agg(
        F.percentile_approx("_v", [0.5 - eps, 0.5 + eps], SKETCH_ACCURACY).alias("_b"),
        F.count(F.lit(1)).alias("_n"),
    )
    counted = present.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    if keys:
        same = F.lit(True)
        right = bracket.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_b", "_n")
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        counted = counted.join(right, same)
    else:
        counted = counted.withColumn("_b", bracket.select("_b").scalar()).withColumn("_n", bracket.select("_n").scalar())
    inside = F.when(F.col("_v") >= F.col("_b")[0], F.col("_v"))
    pieces = (
        counted.where(F.col("_v") <= F.col("_b")[1])
        .groupBy(*keys, "_n", inside.alias("_slot"))
        .agg(F.sum("_c").alias("_c"), F.max("_v").alias("_v"))
    )
    upto = F.sum("_c").over(
        Window.partitionBy(*keys, "_n").orderBy(F.col("_slot").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = pieces.withColumn("_upto", upto)
    lower = F.floor((F.col("_n") - 1) / 2) + 1
    upper = F.ceil((F.col("_n") - 1) / 2) + 1
    low = F.min(F.when(F.col("_upto") >= lower, F.col("_v")))
    high = F.min(F.when(F.col("_upto") >= upper, F.col("_v")))
    return ranked.groupBy(*keys).agg(((low + high) / 2).alias(out))


def smallest_by_hash(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows (or all): those with the smallest md5 of seed and id.

    Slices of the hash range are counted (at most 2**16 counters). Only the hashes and ids of the slice at the cut are
    ranked, to find the last one that stays; the rows themselves are filtered against it and never move. Ids are to
    be distinct: rows that repeat the last one all stay.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col(id_col).cast("string")))
    hashed = df.withColumn("_h", key)
    slim = hashed.select("_h", F.col(id_col).alias("_id"), F.substring("_h", 1, 4).alias("_slice"))
    counts = slim.groupBy("_slice").agg(F.count(F.lit(1)).alias("_c"))
    before = F.coalesce(
        F.sum("_c").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    at_cut = counts.withColumn("_before", before).where((F.col("_before") < n) & (F.col("_before") + F.col("_c") >= n))
    rank = F.row_number().over(Window.partitionBy("_slice").orderBy("_h", "_id"))
    last = slim.join(F.broadcast(at_cut), "_slice").withColumn("_rank", rank).where(F.col("_rank") == n - F.col("_before"))
    end = last.agg(F.max("_h")).scalar()  # null if there are fewer rows
    return hashed.where(end.isNull() | (F.col("_h") <= end)).drop("_h")
