"""Most similar listings of the same city: an exact, blocked k-nearest-neighbour join.

    score = 2*|price difference|/max(price, 1) + |surface difference|/max(surface, 1) + 0.05*km

with the base listing's price and surface in the denominators. Pairs of a city
are never all formed, because one city may hold a third of the table:

The spots are written to the shared folder once (a job of its own), so the
operator starts work when it is called; its result is lazy.

1. Listings that agree in city, price, surface and place form one *spot* that
   keeps only its ``k + 1`` smallest ids - no other copy can be in a top ``k``.
2. Spots are range-partitioned along a space-filling curve inside their city, so
   a hot city spreads over many tasks. The neighbours along the curve give every
   spot a first search radius: ``k + 1`` ids are known to lie within it.
3. Each city is a tree of cells in the four axes of the score; a cell with more
   than ``CELL_SPOTS`` spots is split into finer ones, so every leaf is small
   wherever the city is dense.
4. The bases of a leaf go down their city's tree together. At each step the
   farthest corners of the cells they still look at may tighten their radius, and
   cells whose nearest corner is beyond it are left out. What a sparse
   base beside a dense place looks at is a few cells, not the place. At the leaves
   every base drops those that start beyond its own radius.
5. The bases of a remaining leaf are compared with its spots a leaf at a time,
   at most ``LEAF_BASES`` bases beside at most ``LEAF_IDS`` ids, so a leaf that
   many look at spreads over tasks. What is found is ranked per base spot, then
   each listing takes its spot's list without itself.

A step is one equi-join on the cell and one window over the handful of cells of
a base. The cell of a hot city is a skewed join key, which Spark splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.listing import city_from_address
from ..functions.numbers import distance_km
from ..session import materialize

CELL_SPOTS = 64  # a cell with more spots is split
STEP = 1  # a step of the tree halves each axis so often
DEPTH = 26  # halvings at which splitting ends: cells are then max_score / 2**23 wide
COUNTED = 9  # levels that are counted in one go
CURVE_BITS = 12  # per dimension
CURVE_REACH = 128  # neighbours on each side along the curve that give the first radius
LEAF_BASES = 8192  # bases compared with a leaf in one go
LEAF_IDS = 8192  # about as many ids of a leaf are looked at in one go
_ROOT = 3  # root cells are max_score * 2**3 wide
_SLACK = 1e-9
_SPOT = ("city", "price", "surface", "lat", "lon")
_CELL = ("c_price", "c_surface", "c_lat", "c_lon")
# Units in which one step along an axis costs one unit of score.
_LAT_UNIT = K.SIMILAR_KM_WEIGHT * K.KM_PER_LAT
_LON_UNIT = K.SIMILAR_KM_WEIGHT * K.KM_PER_LON


def score_expr(a: str, b: str) -> Column:
    """Similarity score of the aliased rows ``a`` (base) and ``b``."""
    ca, cb = (lambda n: F.col(f"{a}.{n}")), (lambda n: F.col(f"{b}.{n}"))
    price = F.abs(cb("price") - ca("price")) / F.greatest(ca("price"), F.lit(1.0))
    surface = F.abs(cb("surface") - ca("surface")) / F.greatest(ca("surface"), F.lit(1.0))
    km = distance_km(ca("lat"), ca("lon"), cb("lat"), cb("lon"))
    return price * K.SIMILAR_PRICE_WEIGHT + surface + km * K.SIMILAR_KM_WEIGHT


def _points(listings: DataFrame) -> DataFrame:
    # A city is null only where its address is; testing the stored column keeps the filter cheap and pushable.
    stored = "city" if "city" in listings.columns else "address"
    city = F.col("city") if stored == "city" else city_from_address(F.col("address"))
    known = listings.where(F.col(stored).isNotNull() & F.col("price").isNotNull() & F.col("surface").isNotNull())
    known = known.where(~F.isnan(F.col("price").cast("double")) & ~F.isnan(F.col("surface").cast("double")))
    blind = F.col("lat").isNull() | F.col("lon").isNull()
    return known.select(
        "id", city.alias("city"), F.col("price").cast("double").alias("price"), F.col("surface").cast("double").alias("surface"),
        *[F.when(~blind, F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in ("lat", "lon")],
    )


def _spots(points: DataFrame, keep: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*_SPOT).orderBy("id"))
    return (
        points.withColumn("_rank", rank)
        .where(F.col("_rank") <= keep)
        .groupBy(*_SPOT)
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )


def _relative_axis(value: Column) -> Column:
    """Monotone axis on which a step of x means a relative change of about x (absolute below 1)."""
    return F.when(value < 1.0, value).otherwise(F.log(F.greatest(value, F.lit(1.0))) + 1.0)


def _axis_value(position: Column) -> Column:
    """Inverse of ``_relative_axis``."""
    return F.when(position < 1.0, position).otherwise(F.exp(position - 1.0))


def _positions(price: Column, surface: Column, lat: Column, lon: Column) -> tuple[Column, ...]:
    """Axis positions in score units; places without coordinates sit at 0."""
    return (
        _relative_axis(price) * K.SIMILAR_PRICE_WEIGHT,
        _relative_axis(surface),
        F.coalesce(lat * _LAT_UNIT, F.lit(0.0)),
        F.coalesce(lon * _LON_UNIT, F.lit(0.0)),
    )


_AXES = ("_x0", "_x1", "_x2", "_x3")


def _with_curve(spots: DataFrame, max_score: float) -> DataFrame:
    """Add ``_curve``: the interleaved bits of the four axis positions (only locality matters, not range)."""
    width = max_score / 2**6
    axes = _positions(F.col("price"), F.col("surface"), F.col("lat"), F.col("lon"))
    mask = F.lit(2**CURVE_BITS - 1)
    cells = {name: F.floor(x / width).cast("bigint").bitwiseAND(mask) for name, x in zip(_AXES, axes)}
    bits = [
        f"shiftleft(shiftright({name}, {bit}) & 1L, {4 * bit + axis})"
        for bit in range(CURVE_BITS) for axis, name in enumerate(_AXES)
    ]
    return spots.withColumns(cells).withColumn("_curve", F.expr(" | ".join(bits))).drop(*_AXES)


def _radius_along_curve(keep: int, max_score: float):
    """Upper bound of the ``keep``-th smallest score, from the neighbours in curve order."""
    # Plain values, so that a worker needs numpy and pandas but not this package.
    reach, price_weight, km_weight = max(CURVE_REACH, 4 * keep), K.SIMILAR_PRICE_WEIGHT, K.SIMILAR_KM_WEIGHT
    per_lat, per_lon = K.KM_PER_LAT, K.KM_PER_LON

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = len(pdf)
            city = pd.factorize(pdf["city"])[0]
            price, surface = pdf["price"].to_numpy(float), pdf["surface"].to_numpy(float)
            lat, lon = pdf["lat"].to_numpy(float), pdf["lon"].to_numpy(float)
            p_base, s_base = np.maximum(price, 1.0), np.maximum(surface, 1.0)
            scores = np.full((2 * reach + 1, n), np.inf)
            for row, step in enumerate(range(-reach, reach + 1)):
                lo, hi = max(0, -step), min(n, n - step)
                if lo >= hi:
                    continue
                a, b = slice(lo, hi), slice(lo + step, hi + step)
                km = np.sqrt(((lat[b] - lat[a]) * per_lat) ** 2 + ((lon[b] - lon[a]) * per_lon) ** 2)
                s = (
                    np.abs(price[b] - price[a]) / p_base[a] * price_weight
                    + np.abs(surface[b] - surface[a]) / s_base[a]
                    + np.nan_to_num(km, nan=0.0) * km_weight
                )
                scores[row, a] = np.where(city[a] == city[b], s, np.inf)
            radius = np.partition(scores, keep - 1, axis=0)[keep - 1]
            yield pdf.assign(radius=np.minimum(radius, max_score))

    return bound


def _with_radius(spots: DataFrame, keep: int, max_score: float) -> DataFrame:
    ordered = _with_curve(spots, max_score).repartitionByRange("city", "_curve", "price", "surface")
    ordered = ordered.sortWithinPartitions("city", "_curve").drop("_curve")
    schema = T.StructType([*ordered.schema.fields, T.StructField("radius", T.DoubleType())])
    # Ids may repeat, so spots have a number of their own; it holds once they are written.
    return ordered.mapInPandas(_radius_along_curve(keep, max_score), schema).withColumn("no", F.monotonically_increasing_id())


def _width(level: Column, max_score: float) -> Column:
    return F.lit(max_score) * F.pow(F.lit(2.0), F.lit(_ROOT) - level)


def _planed(spots: DataFrame) -> DataFrame:
    """Every spot in the planes where it is looked for: by place, among the placeless, or without regard to place."""
    planed = spots.withColumn("plane", F.when(F.col("lat").isNull(), "blind").otherwise("placed"))
    # A base without coordinates is at distance 0 from every place; only its city needs the flat copy.
    blind_cities = spots.where(F.col("lat").isNull()).select("city").distinct()
    flat = planed.where(F.col("plane") == "placed").join(blind_cities, "city", "left_semi")
    return planed.unionByName(flat.withColumn("plane", F.lit("flat")))


def _in_cells(planed: DataFrame, max_score: float, depth: int = DEPTH) -> DataFrame:
    """Every spot under its cell of every level down to ``depth``. Cells are whole numbers kept as doubles, so no junk value overflows."""
    leveled = planed.withColumn("level", F.explode(F.array(*[F.lit(n) for n in range(0, depth + 1, STEP)])))
    axes = _positions(F.col("price"), F.col("surface"), F.col("lat"), F.col("lon"))
    inside = F.col("plane") == "placed"
    cells = [_floor(x / _width(F.col("level"), max_score)) for x in axes]
    cells[2:] = [F.when(inside, c).otherwise(F.lit(0.0)) for c in cells[2:]]
    return leveled.select(*planed.columns, "level", *[c.alias(name) for c, name in zip(cells, _CELL)])


def _floor(x: Column) -> Column:
    """Floor as a double, with one zero."""
    return F.rint(x - F.pmod(x, F.lit(1.0))) + F.lit(0.0)


def _counted(cells: DataFrame) -> DataFrame:
    """(city, plane, level, cell, n, m): how many spots a cell has and ids they keep; beyond every ``COUNTED`` levels only
    inside of cells that are split."""
    parts: list[DataFrame] = []
    for first in range(0, DEPTH + 1, COUNTED * STEP):
        last = min(first + (COUNTED - 1) * STEP, DEPTH)
        some = cells.where(F.col("level").between(first, last))
        if parts:
            full = parts[-1].where((F.col("level") == first - STEP) & (F.col("n") > CELL_SPOTS))
            if full.isEmpty():
                break
            above = [_floor(F.col(c) / F.pow(F.lit(2.0), F.col("level") - (first - STEP))).alias(f"p{c}") for c in _CELL]
            some = some.select("*", *above).join(full.select("city", "plane", *[F.col(c).alias(f"p{c}") for c in _CELL]),
                                                 ["city", "plane", *[f"p{c}" for c in _CELL]], "left_semi")
        parts.append(materialize(
            some.groupBy("city", "plane", "level", *_CELL).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("m")), "similar-cells"))
    return reduce(DataFrame.unionByName, parts)


def _tree(cells: DataFrame, max_score: float = K.SIMILAR_MAX_SCORE) -> DataFrame:
    """(city, plane, level, cell, m, leaf, node, box): the cells of all trees, with how many ids their spots keep, a
    number that holds once they are written, and their bounds.

    A cell is there if the one above has too many spots; it is a leaf if it has few itself or is of the last level.
    """
    counted = _counted(cells)
    full = counted.where((F.col("n") > CELL_SPOTS) & (F.col("level") < DEPTH))
    above = full.select("city", "plane", (F.col("level") + STEP).alias("level"), *[F.col(c).alias(f"p{c}") for c in _CELL])
    inner = counted.select("*", *[_floor(F.col(c) / 2**STEP).alias(f"p{c}") for c in _CELL])
    below = inner.join(above, ["city", "plane", "level", *[f"p{c}" for c in _CELL]], "left_semi").drop(*[f"p{c}" for c in _CELL])
    nodes = counted.where(F.col("level") == 0).unionByName(below)
    leaf = (F.col("n") <= CELL_SPOTS) | (F.col("level") == DEPTH)
    return nodes.select("city", "plane", "level", *_CELL, "m", leaf.alias("leaf"), F.monotonically_increasing_id().alias("node"), _box(max_score).alias("box"))


def _box(max_score: float) -> Column:
    """Where the cell of a row begins and ends: prices and surfaces as they are, places in score units."""
    w = _width(F.col("level"), max_score)

    def ends(cell: str, weight: float) -> tuple[Column, Column]:
        return _axis_value(F.col(cell) * w / weight), _axis_value((F.col(cell) + 1) * w / weight)

    sides = [ends("c_price", K.SIMILAR_PRICE_WEIGHT), ends("c_surface", 1.0), *[(F.col(c) * w, (F.col(c) + 1) * w) for c in ("c_lat", "c_lon")]]
    return F.struct(*[x.alias(f"{end}_{c}") for c, side in zip(_SPOT[1:], sides) for end, x in zip(("low", "high"), side)])


def _reach() -> Column:
    """Lower bound of the score between a base and anything in the ``box`` of the same row."""
    def scaled(value: str, weight: float) -> Column:
        away = F.greatest(F.lit(0.0), F.col(f"box.low_{value}") - F.col(value), F.col(value) - F.col(f"box.high_{value}"))
        return away / F.greatest(F.col(value), F.lit(1.0)) * weight

    def placed(axis: str, unit: float) -> Column:
        return F.greatest(F.lit(0.0), F.col(f"box.low_{axis}") - F.col(axis) * unit, F.col(axis) * unit - F.col(f"box.high_{axis}"))

    lat, lon = placed("lat", _LAT_UNIT), placed("lon", _LON_UNIT)
    away = F.when(F.col("plane") == "placed", F.sqrt(lat * lat + lon * lon)).otherwise(F.lit(0.0))
    return (scaled("price", K.SIMILAR_PRICE_WEIGHT) + scaled("surface", 1.0) + away) * (1 - 1e-9) - 1e-9


_GROUP = (*[f"first_{c}" for c in _SPOT[1:]], *[f"last_{c}" for c in _SPOT[1:]])
_BOX = tuple(f"{end}_{c}" for c in _SPOT[1:] for end in ("low", "high"))


def _bounded():
    """Rows whose cell may hold something within the radius, with ``low`` and ``high``: the lower and upper bound of the
    score between any base of the group, whose values lie between first and last, and anything in the cell.
    """
    scaled = (("price", K.SIMILAR_PRICE_WEIGHT), ("surface", 1.0))
    placed = (("lat", _LAT_UNIT), ("lon", _LON_UNIT))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def sides(c: str) -> tuple[np.ndarray, ...]:
                return tuple(batch.column(f"{side}_{c}").to_numpy(zero_copy_only=False) for side in ("first", "last", "low", "high"))

            low, high = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            with np.errstate(all="ignore"):
                for value, weight in scaled:
                    least, most, begin, end = sides(value)
                    # The relative distance from a cell on either side is smallest beside the largest base.
                    low += np.maximum(0.0, np.maximum(begin - most, least - end)) / np.maximum(most, 1.0) * weight
                    high += np.maximum(end - least, most - begin) / np.maximum(least, 1.0) * weight
                near, far = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
                for axis, unit in placed:
                    least, most, begin, end = sides(axis)
                    near += np.maximum(0.0, np.maximum(begin - most * unit, least * unit - end)) ** 2
                    far += np.maximum(most * unit - begin, end - least * unit) ** 2
                inside = pc.equal(batch.column("plane"), "placed").to_numpy(zero_copy_only=False)
                low = (low + np.where(inside, np.sqrt(near), 0.0)) * (1 - 1e-9) - 1e-9
                high = (high + np.where(inside, np.sqrt(far), 0.0)) * (1 + 1e-9) + 1e-9
            within = low <= batch.column("radius").to_numpy(zero_copy_only=False)
            names = [*batch.schema.names, "low", "high"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low), pa.array(high)], names=names).filter(pa.array(within))

    return bounds


def _within_radius(seen: DataFrame) -> DataFrame:
    """The cells of a group that start within its radius, with the bounds ``low`` and ``high``."""
    # In one expression the bounds are a method too long for the JVM to compile: it would interpret them row by row.
    schema = T.StructType([*seen.schema.fields, T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())])
    return seen.mapInArrow(_bounded(), schema)


def _narrowed(bounded: DataFrame, keep: int) -> DataFrame:
    """The cells of a group that can hold one of its bases' nearest: those that start within the radius that ``keep`` ids fill."""
    nearest_first = Window.partitionBy("home").orderBy("high").rowsBetween(Window.unboundedPreceding, 0)
    enough = bounded.withColumn("filled", F.sum("m").over(nearest_first) >= keep)
    radius = F.least(F.col("radius"), F.min(F.when(F.col("filled"), F.col("high"))).over(Window.partitionBy("home")))
    return enough.withColumn("radius", radius).where(F.col("low") <= F.col("radius")).drop("filled")


def cells_to_search(bases: DataFrame, nodes: DataFrame, keep: int, max_score: float) -> DataFrame:
    """(base spot, radius, m, node): the leaves that each base has to look into."""
    keys = ("city", "plane", "level", *_CELL)
    depth = nodes.agg(F.max("level")).first()[0] or 0
    blind = F.col("lat").isNull()
    own = bases.withColumn("radius", F.col("radius") * (1 + 1e-9) + 1e-9).withColumn("plane", F.when(blind, "blind").otherwise("placed"))
    leaves = nodes.where("leaf").select(*keys, F.col("node").alias("home"))
    homes = materialize(
        _in_cells(own, max_score, depth).join(leaves, list(keys)).select("home", *_SPOT, "no", F.element_at("ids", 1).alias("spot"), "radius"), "similar-homes")
    planes = F.when(F.col("first_lat").isNull(), F.array(F.lit("blind"), F.lit("flat"))).otherwise(F.array(F.lit("placed"), F.lit("blind")))
    seen = homes.groupBy("home", "city").agg(
        *[F.min(c).alias(f"first_{c}") for c in _SPOT[1:]], *[F.max(c).alias(f"last_{c}") for c in _SPOT[1:]], F.max("radius").alias("radius"))
    # A group is a short row with much work ahead, so groups are dealt to all tasks, however few their bytes.
    tasks = int(bases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    roots = nodes.where("level = 0").select("city", "plane", "m", "node", "box.*")
    seen = seen.repartition(tasks).withColumn("plane", F.explode(planes)).join(roots, ["city", "plane"]).drop("city")
    columns = ("home", *_GROUP, "radius", "plane", "m", "node", *_BOX)
    seen = _narrowed(_within_radius(seen.select(*columns)), keep).select(*columns)
    # Below the roots a cell is found by the number of the one above.
    above = nodes.where("NOT leaf").select(
        "city", "plane", (F.col("level") + STEP).alias("level"), *[F.col(c).alias(f"p{c}") for c in _CELL], F.col("node").alias("above"))
    halved = nodes.select("city", "plane", "level", "m", "node", "box", *[_floor(F.col(c) / 2**STEP).alias(f"p{c}") for c in _CELL])
    below = materialize(
        halved.join(above, ["city", "plane", "level", *[f"p{c}" for c in _CELL]]).select("level", "above", "m", "node", "box.*"), "similar-below")
    for level in range(STEP, depth + 1, STEP):
        finer = below.where(F.col("level") == level).select("above", *[F.col(c).alias(f"finer_{c}") for c in ("m", "node", *_BOX)])
        cells = [F.coalesce(f"finer_{c}", c).alias(c) for c in ("m", "node", *_BOX)]
        joined = seen.join(finer, F.col("node") == F.col("above"), "left").select("home", *_GROUP, "radius", "plane", *cells)
        # Every other step only drops what lies beyond the radius known so far, which needs no window.
        bounded = _within_radius(joined)
        seen = (_narrowed(bounded, keep) if level % (2 * STEP) == 0 or level == depth else bounded).select(*columns)
        if level % (4 * STEP) == 0:
            seen = materialize(seen.repartition(tasks), "similar-search")
    leaf = seen.select("home", "plane", "m", "node", F.struct(*_BOX).alias("box"), F.col("radius").alias("widest"))
    look = homes.join(leaf, "home").withColumn("radius", F.least("radius", "widest")).drop("home", "widest")
    return look.where(_reach() <= F.col("radius")).drop("box", "plane")


def _same_spot(a: str, b: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in _SPOT])


def _scores(base: tuple[np.ndarray, ...], other: tuple[np.ndarray, ...]) -> np.ndarray:
    """``score_expr`` of every base (rows) and every other spot (columns): the same steps in the same order."""
    price, surface, lat, lon, placed = (x[:, None] for x in base)
    by_price = np.abs(other[0] - price) / np.maximum(price, 1.0)
    by_surface = np.abs(other[1] - surface) / np.maximum(surface, 1.0)
    north, east = (other[2] - lat) * K.KM_PER_LAT, (other[3] - lon) * K.KM_PER_LON
    km = np.where(placed & other[4], np.sqrt(north * north + east * east), 0.0)
    return by_price * K.SIMILAR_PRICE_WEIGHT + by_surface + km * K.SIMILAR_KM_WEIGHT


def _within_leaves(keep: int, max_score: float):
    """(no, score, ids): the spots of a leaf within the radius of each base beside it, the ``keep`` nearest and ties.

    Rows come by leaf and part, the spots of a leaf before the bases that look into it.
    """
    def values(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("price", "surface", "lat", "lon")]
        return *columns, ~np.asarray(batch.column("lat").is_null())

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, spots, ids = None, None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "part", "chunk", "base")])
            cuts = [0, *(np.flatnonzero((np.diff(keys) != 0).any(0)) + 1).tolist(), batch.num_rows]
            every = values(batch)
            no, radius, lists = batch.column("no").to_numpy(), batch.column("radius").to_numpy(zero_copy_only=False), batch.column("ids")
            out_no, out_score, out_ids = [], [], []
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                here, mine = tuple(keys[:3, low].tolist()), tuple(x[low:high] for x in every)
                if not keys[3, low]:
                    # A leaf may begin in one batch and go on in the next.
                    more = here == group
                    spots = tuple(map(np.concatenate, zip(spots, mine, strict=True))) if more else mine
                    ids = pa.concat_arrays([ids, lists.slice(low, high - low)]) if more else lists.slice(low, high - low)
                    group = here
                    continue
                if here != group:
                    continue
                step = max(1, (1 << 20) // len(ids))
                for first in range(0, high - low, step):
                    some = slice(first, first + step)
                    score = _scores(tuple(x[some] for x in mine), spots)
                    reach = radius[low:high][some] * (1 + _SLACK) + _SLACK
                    if len(ids) > keep:
                        reach = np.fmin(reach, np.partition(score, keep - 1, 1)[:, keep - 1])
                    row, column = np.nonzero((score < max_score) & (score <= reach[:, None]))
                    out_no.append(no[low:high][some][row])
                    out_score.append(score[row, column])
                    out_ids.append(ids.take(pa.array(column)))
            if out_no:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_no)), pa.array(np.concatenate(out_score)), pa.concat_arrays(out_ids)], names=["no", "score", "ids"])

    return compared


def _found(look: DataFrame, leaves: DataFrame, keep: int, max_score: float) -> DataFrame:
    """(no, score, ids): spots near each base, from the leaves it looks into."""
    look = materialize(look.select("node", "m", "no", *_SPOT[1:], "radius"), "similar-look")
    chunks = look.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / LEAF_BASES).alias("chunks"))
    parts = F.ceil(F.col("m") / LEAF_IDS)
    bases = look.join(chunks, "node").select(
        "node", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.pmod(F.xxhash64("no"), F.col("chunks")).alias("chunk"),
        F.lit(True).alias("base"), "no", *_SPOT[1:], "radius", F.lit(None).cast(leaves.schema["ids"].dataType).alias("ids"))
    spots = leaves.join(chunks, "node").select(
        "node", F.pmod(F.xxhash64("no"), parts).alias("part"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.lit(False).alias("base"), "no", *_SPOT[1:], "radius", "ids")
    keys = ("node", "part", "chunk")
    dealt = spots.unionByName(bases).repartition(*keys).sortWithinPartitions(*keys, "base")
    schema = T.StructType([T.StructField("no", T.LongType()), T.StructField("score", T.DoubleType()), dealt.schema["ids"]])
    return dealt.mapInArrow(_within_leaves(keep, max_score), schema)


def _same_spot(a: str, b: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in _SPOT])


def topk_similar(
    listings: DataFrame,
    k: int = K.SIMILAR_LIMIT,
    max_score: float = K.SIMILAR_MAX_SCORE,
    bases: DataFrame | None = None,
) -> DataFrame:
    """(base_id, rank, similar_id, score): the ``k`` lowest scores below ``max_score`` per base.

    Ties are broken by id. ``bases`` (a frame with ``id``) restricts the base listings.
    """
    keep = k + 1
    points = _points(listings)
    asked = points if bases is None else points.join(bases.select("id"), "id", "left_semi")
    # The tree and both sides of the search read the spots: they are written once, not computed again.
    spots = materialize(_with_radius(_spots(points, keep), keep, max_score), "similar-spots")
    searched = spots
    if bases is not None:
        wanted = asked.select(*_SPOT).distinct()
        searched = searched.alias("s").join(wanted.alias("w"), _same_spot("s", "w"), "left_semi")
    nodes = materialize(_tree(_in_cells(_planed(spots), max_score), max_score), "similar-tree")
    look = cells_to_search(searched, nodes, keep, max_score)
    keys = ("city", "plane", "level", *_CELL)
    placed = _in_cells(_planed(spots), max_score, nodes.agg(F.max("level")).first()[0] or 0)
    leaves = placed.join(nodes.where("leaf").select(*keys, "m", "node"), list(keys))
    by_score = F.row_number().over(Window.partitionBy("no").orderBy("score", "similar_id"))
    ranked = (
        _found(look, leaves, keep, max_score)
        .select("no", "score", F.explode("ids").alias("similar_id"))
        .withColumn("_rank", by_score)
        .where(F.col("_rank") <= keep)
        .groupBy("no")
        .agg(F.sort_array(F.collect_list(F.struct("score", "similar_id"))).alias("near"))
        .join(spots.select("no", *_SPOT), "no")
    )
    joined = asked.alias("p").join(ranked.alias("n"), _same_spot("p", "n"))
    others = F.slice(F.filter("n.near", lambda x: x["similar_id"] != F.col("p.id")), 1, k)
    return joined.select(F.col("p.id").alias("base_id"), F.posexplode(others).alias("pos", "x")).select(
        "base_id", (F.col("pos") + 1).alias("rank"), F.col("x.similar_id").alias("similar_id"),
        F.col("x.score").alias("score"),
    )


# --- the index as a table --------------------------------------------------

def similar_lists(ranked: DataFrame) -> DataFrame:
    """One row per base with its ordered list of similar ids (at most k entries)."""
    entries = F.sort_array(F.collect_list(F.struct("rank", "similar_id")))
    return ranked.groupBy("base_id").agg(F.transform(entries, lambda x: x["similar_id"]).alias("similar"))


def resolve_similar(ranked: DataFrame, listings: DataFrame) -> DataFrame:
    """Index entries with their listing; ids without a listing are dropped, the order is in ``rank``."""
    return ranked.join(listings.withColumnRenamed("id", "similar_id"), "similar_id")


def similar_with_fallback(
    index: DataFrame,
    listings: DataFrame,
    k: int = K.SIMILAR_LIMIT,
    max_score: float = K.SIMILAR_MAX_SCORE,
) -> DataFrame:
    """Index entries that still resolve; listings left with none are computed now."""
    known = index.join(listings.select(F.col("id").alias("similar_id")), "similar_id", "left_semi")
    known = known.select("base_id", "rank", "similar_id")
    missing = listings.select("id").join(known.select(F.col("base_id").alias("id")), "id", "left_anti")
    computed = topk_similar(listings, k, max_score, bases=missing)
    known = known.join(listings.select(F.col("id").alias("base_id")), "base_id", "left_semi")
    return known.unionByName(computed.select("base_id", "rank", "similar_id"))


def candidate_counts(listings: DataFrame) -> DataFrame:
    """(id, city, candidates): how many other listings of its city a base is compared with.

    The pairs themselves are never formed: a city's count does it.
    """
    city = F.col("city") if "city" in listings.columns else city_from_address(F.col("address"))
    located = listings.select("id", city.alias("city")).where(F.col("city").isNotNull())
    sizes = located.groupBy("city").agg(F.count(F.lit(1)).alias("n"))
    return located.join(sizes, "city").select("id", "city", (F.col("n") - 1).alias("candidates"))
