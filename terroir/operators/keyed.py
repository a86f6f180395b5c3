"""Keyed tables: last write wins, newest per key, insert if absent, code sets."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def newest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` becomes a group limit that runs before the shuffle, so a
    key with a third of all rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], year: str = "year") -> DataFrame:
    return newest_per_key(df, keys, [F.col(year).desc_nulls_last()])


def connected_keys(edges: DataFrame, name: str = "keys") -> DataFrame:
    """(node, component) of (a, b) edges: component is the smallest node reachable.

    Labels go down along the edges and are then followed to their own label, until no label changes. A round is two
    joins on a node, which Spark splits where one is hot, and is written to the shared folder.
    """
    both = materialize(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct(), name)
    labels = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), name)
    while True:
        lowest = both.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("seen"))
        moved = labels.join(lowest, "a").select("a", F.least("label", "seen").alias("label"), F.col("label").alias("was"))
        jump = labels.select(F.col("a").alias("label"), F.col("label").alias("next"))
        moved = materialize(moved.join(jump, "label", "left").select("a", F.least("label", "next").alias("label"), "was"), name)
        if moved.where("label <> was").limit(1).count() == 0:
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
        labels = moved.select("a", "label")


def listing_key(writes: DataFrame) -> DataFrame:
    """The writes with ``_key``: rows that share an id or a url, directly or over other rows, have one key.

    An id with one url that has one id is a key by itself; only the others go through the search for connected rows.
    """
    node = F.coalesce(F.concat(F.lit("u:"), F.nullif("url", F.lit(""))), F.concat(F.lit("i:"), F.nullif("id", F.lit(""))))
    pairs = writes.select(
        F.concat(F.lit("i:"), F.nullif("id", F.lit(""))).alias("a"), F.concat(F.lit("u:"), F.nullif("url", F.lit(""))).alias("b")
    ).where("a IS NOT NULL AND b IS NOT NULL").distinct()
    per_id, per_url = (pairs.groupBy(k).agg(F.count(F.lit(1)).alias(f"n_{k}")) for k in ("a", "b"))
    counted = materialize(pairs.join(per_id, "a").join(per_url, "b").select("a", "b", (F.greatest("n_a", "n_b") > 1).alias("knot")), "listing-keys")
    plain = counted.where("NOT knot").select(F.explode(F.array("a", "b")).alias("node"), F.col("a").alias("component"))
    keys = plain.union(connected_keys(counted.where("knot"), "listing-knots"))
    found = writes.withColumn("_node", node).join(keys.withColumnRenamed("node", "_node"), "_node", "left")
    return found.select(*writes.columns, F.coalesce("component", "_node").alias("_key"))


def replay(keys: pd.DataFrame) -> pd.DataFrame:
    """Writes of one connected group applied one after the other (rows in order): a write replaces the listing that
    holds its id or its url at that moment, the first created if several do, or creates one. Returns the row of the
    last write of every listing. Empty ids and urls match nothing."""
    holders: dict[tuple[str, str], set[int]] = {}
    owner: list[tuple[str | None, str | None]] = []
    last: list[int] = []
    for row, ident, url in zip(keys["_row"], keys["id"], keys["url"], strict=True):
        names = [(kind, value) for kind, value in (("i", ident), ("u", url)) if isinstance(value, str) and value]
        found = [min(holders[n]) for n in names if holders.get(n)]
        if found:
            at = min(found)
            for n in owner[at]:
                holders[n].discard(at)
            owner[at], last[at] = names, row
        else:
            at = len(last)
            owner.append(names)
            last.append(row)
        for n in names:
            holders.setdefault(n, set()).add(at)
    return pd.DataFrame({"_row": pd.Series(last, dtype="int64")})


def upsert_listings(writes: DataFrame, order: Sequence[str]) -> DataFrame:
    """State after a series of writes applied in ``order`` (ascending, nulls first; ties by the content of the row):
    a write replaces the listing that holds its id or its url when it comes, as a store that looks up the current
    holder does, and creates a listing when none does.

    A write without id and url meets nothing and stays a listing of its own. Writes of different connected groups
    (of ids and urls) never meet. A group whose writes all carry one (id, url)
    is one listing: its last write, by a group limit. The other groups drop writes that repeat the (id, url) of the
    write just before them (such a write meets the listing the previous one made), and are then replayed in order,
    one task per group (``replay``); the rows are numbered and stored first, so a replayed task sees the same rows.
    """
    ident, url = F.nullif("id", F.lit("")), F.nullif("url", F.lit(""))
    rows = materialize(listing_key(writes).withColumn("_row", F.monotonically_increasing_id()), "upsert-writes")
    pair = F.concat_ws("\u0001", F.coalesce(F.concat(F.lit("i"), ident), F.lit("-")), F.coalesce(F.concat(F.lit("u"), url), F.lit("-")))
    rows = rows.withColumn("_pair", pair)
    alone = rows.where(ident.isNull() & url.isNull())
    rows = rows.where(ident.isNotNull() | url.isNotNull())
    ties = [F.col(c).asc_nulls_first() for c in order] + [F.xxhash64(*writes.columns), F.col("_row")]
    pairs = rows.groupBy("_key").agg(F.countDistinct("_pair").alias("_pairs"))
    rows = rows.join(pairs, "_key")
    newest = [F.col(c).desc_nulls_last() for c in order] + [F.xxhash64(*writes.columns).desc(), F.col("_row").desc()]
    single = newest_per_key(rows.where("_pairs = 1"), ["_key"], newest)
    knotted = rows.where("_pairs > 1")
    step = Window.partitionBy("_key").orderBy(*ties)
    changes = knotted.withColumn("_next", F.lead("_pair").over(step)).where(F.coalesce(F.col("_next") != F.col("_pair"), F.lit(True)))
    ordered = changes.select("_key", "_row", ident.alias("id"), url.alias("url"), *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)],
                             F.xxhash64(*writes.columns).alias("_h"))
    sort_by = [f"_o{k}" for k in range(len(order))] + ["_h", "_row"]
    last = ordered.groupBy("_key").applyInPandas(
        lambda part: replay(part.sort_values(sort_by, na_position="first", kind="stable")), "_row long")
    kept = knotted.join(last, "_row", "left_semi")
    return single.unionByName(kept).select(*writes.columns).unionByName(alone.select(*writes.columns))


def merge_keyed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert of documents: fields supplied by the new document replace the old ones.

    Columns missing from ``new`` keep their old value, as a partial update does. Of several new documents with one
    key, the one whose fields have the largest hash wins, the same one at every run.
    """
    partial = [c for c in old.columns if c not in new.columns]
    if partial:
        new = new.join(old.select(*keys, *partial), list(keys), "left")
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    fields = F.xxhash64(*[c for c in both.columns if c != "_new"])
    return newest_per_key(both, keys, [F.col("_new").desc(), fields.desc()]).drop("_new")


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str = "id", order: Sequence[str] = ()) -> DataFrame:
    """The new rows that may be inserted: their id is not taken, and of several with one id the first in ``order``.

    Without an order the smallest row in its columns' order counts as the first.
    """
    free = new.join(existing.select(key), key, "left_anti")
    columns = [F.col(c).asc_nulls_last() for c in (order or [c for c, kind in new.dtypes if not kind.startswith("map")])]
    return newest_per_key(free, [key], columns)


def semi_join_codes(df: DataFrame, codes: DataFrame, key: str = "insee_code") -> DataFrame:
    return df.join(codes.select(key).distinct(), key, "left_semi")


def anti_join_ids(listings: DataFrame, similar: DataFrame, similar_id: str = "similar_id") -> DataFrame:
    """Listings that are not in the similar set."""
    return listings.join(similar.select(F.col(similar_id).alias("id")), "id", "left_anti")


def union_codes(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.distinct()


def intersect_codes(codes: DataFrame, preferred: DataFrame) -> DataFrame:
    return codes.intersect(preferred)


def union_frames(*frames: DataFrame) -> DataFrame:
    """Union by column name; columns a frame lacks become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
