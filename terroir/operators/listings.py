"""Listings: normalise, reject, geocode, filter, search, page, market listings, comparison."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import listing as L
from ..functions.codes import department_from_insee
from ..functions.numbers import jitter_offsets, parse_number_fr, price_per_m2, rolling_hash
from ..functions.text import fold_accents

LISTING_COLUMNS = (
    "id", "title", "address", "price", "rooms", "surface", "floor", "tags",
    "score", "imageUrl", "lat", "lon", "source", "url",
)


# --- normalisation ---------------------------------------------------------

def geocode_fallback(raw: DataFrame, centroids: Sequence[L.Centroid] = K.CENTROIDS) -> DataFrame:
    """Fill missing coordinates from city or postal code and spread the points by url."""
    missing = F.col("lat").isNull() | F.col("lon").isNull()
    placed = raw.withColumn("_place", F.when(missing, L.geocode_city(F.col("city"), F.col("postalCode"), centroids)))
    placed = placed.withColumn("_hash", F.when(F.col("_place").isNotNull(), rolling_hash(F.col("url"))))
    dx, dy = jitter_offsets(F.col("_hash"))
    return (
        placed.withColumn("lat", F.when(F.col("_place").isNotNull(), F.col("_place.lat") + dx).otherwise(F.col("lat")))
        .withColumn("lon", F.when(F.col("_place").isNotNull(), F.col("_place.lon") + dy).otherwise(F.col("lon")))
        .drop("_place", "_hash")
    )


def _substrings(text: Column) -> Column:
    """All stretches of a short text, once each."""
    starts = F.sequence(F.lit(1), F.length(text))
    return F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(
        F.sequence(F.lit(1), F.length(text) - i + 1), lambda n: F.substr(text, i, n)))))


def geocode_by_table(raw: DataFrame, centroids: DataFrame) -> DataFrame:
    """``geocode_fallback`` with a table of centroids (key, lat, lon, place): any number of places, found by joins.

    ``place`` is a centroid's rank, as a name may hold several keys: the first one that is in the name, or that holds
    it, counts, after one that is equal. Only distinct city names meet the keys, by their stretches of letters. Keys
    that start with ``dept-`` are departments.
    """
    cities = raw.select(fold_accents(F.col("city")).alias("_name")).where("_name <> ''").distinct()
    keys = centroids.where(~F.col("key").startswith("dept-")).select("key", "place", "lat", "lon")
    inside = cities.select("_name", F.explode(_substrings(F.col("_name"))).alias("key")).join(keys, "key")
    around = keys.withColumn("_name", F.explode(_substrings(F.col("key")))).join(cities, "_name").select("key", "_name", "place", "lat", "lon")
    best = inside.select("key", "_name", "place", "lat", "lon").union(around).groupBy("_name").agg(
        F.min(F.struct((F.col("key") != F.col("_name")).alias("other"), "place", "lat", "lon")).alias("_city"))
    departments = centroids.where(F.col("key").startswith("dept-")).select("key", F.struct("lat", "lon").alias("at"))
    missing = F.col("lat").isNull() | F.col("lon").isNull()
    insee = F.when(F.col("postalCode").rlike("^[0-9]{5}$"), F.col("postalCode"))
    staged = raw.withColumns({
        "_name": fold_accents(F.col("city")), "_long": F.concat(F.lit("dept-"), department_from_insee(insee)),
        "_short": F.when(F.length("postalCode") >= 2, F.concat(F.lit("dept-"), F.substring("postalCode", 1, 2)))})
    staged = staged.join(best, "_name", "left")
    for name in ("_long", "_short"):
        side = departments.select(F.col("key").alias(name), F.col("at").alias(f"{name}_at"))
        staged = staged.join(side, name, "left")
    near = F.coalesce(
        F.when(F.col("_city").isNotNull(), F.struct(F.col("_city.lat").alias("lat"), F.col("_city.lon").alias("lon"))),
        L.insee_place(insee, F.col("_long_at")), F.col("_short_at"))
    placed = staged.withColumn("_place", F.when(missing, near)).withColumn("_hash", F.when(F.col("_place").isNotNull(), rolling_hash(F.col("url"))))
    dx, dy = jitter_offsets(F.col("_hash"))
    moved = placed.withColumn("lat", F.when(F.col("_place").isNotNull(), F.col("_place.lat") + dx).otherwise(F.col("lat")))
    moved = moved.withColumn("lon", F.when(F.col("_place").isNotNull(), F.col("_place.lon") + dy).otherwise(F.col("lon")))
    return moved.select(*raw.columns)


def _invalid(value: Column) -> Column:
    return value.isNull() | (value <= 0)


def normalize_listings(
    raw: DataFrame, geocode: bool = True, default_score: float = K.DEFAULT_SCORE, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw listings to listing records plus ``reject_reason`` (null when valid) and the columns to ``keep``."""
    base = geocode_fallback(raw) if geocode else raw
    base = base.withColumn("rooms", F.coalesce("rooms", "bedrooms")).withColumn("id", L.stable_id(F.col("url")))
    reason = (
        F.when(_invalid(F.col("price")), K.REJECT_REASONS["price"])
        .when(_invalid(F.col("rooms")), K.REJECT_REASONS["rooms"])
        .when(_invalid(F.col("surface")), K.REJECT_REASONS["surface"])
        .when(F.col("lat").isNull() | F.col("lon").isNull(), K.REJECT_REASONS["coordinates"])
    )
    before, after = K.DEFAULT_IMAGE
    return base.select(
        "id",
        F.coalesce(L.blank_to_null(F.col("title")), F.lit(K.DEFAULT_TITLE)).alias("title"),
        L.build_address(F.col("address"), F.col("postalCode"), F.col("city")).alias("address"),
        "price",
        F.col("rooms").try_cast("int").alias("rooms"),
        "surface",
        F.coalesce(L.blank_to_null(F.col("floor")), F.lit(K.DEFAULT_FLOOR)).alias("floor"),
        L.derive_tags().alias("tags"),
        F.lit(default_score).alias("score"),
        F.coalesce(F.try_element_at("photos", F.lit(1)), F.concat(F.lit(before), "id", F.lit(after))).alias("imageUrl"),
        "lat",
        "lon",
        L.canonical_source(F.coalesce(F.nullif("source", F.lit("")), "url")).alias("source"),
        "url",
        reason.alias("reject_reason"),
        *keep,
    )


def split_rejects(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid listings, rejected rows with their reason). Where both are used, give it a stored frame.

    A filter on the reason alone would be pushed below the normalisation and repeat its geocoding in the condition. So
    the computed columns pass a one-row list that is filtered; conditions on the url still reach the scan.
    """
    valid = where_computed(normalized, ["url"], lambda row: row["reject_reason"].isNull()).drop("reject_reason")
    return valid, where_computed(normalized, ["url"], lambda row: row["reject_reason"].isNotNull())


def where_computed(df: DataFrame, plain: Sequence[str], condition: Callable[[Column], Column]) -> DataFrame:
    """Rows of ``df`` that meet a condition on computed columns, which are computed once.

    ``plain`` names columns that come from the input as they are: later filters on them are pushed below the computation.
    """
    rest = [c for c in df.columns if c not in plain]
    row = F.filter(F.array(F.struct(*rest)), condition)
    return df.select(*plain, F.inline(row)).select(*df.columns)


def _alias(df: DataFrame, names: Sequence[str]) -> Column:
    have = [F.col(n).cast("string") for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


# Accepted names per field, in order of preference.
FIELD_ALIASES: Mapping[str, tuple[str, ...]] = {
    "type": ("type", "propertyType", "bien_type"),
    "price": ("price", "prix", "loyer"),
    "surface": ("surface", "area", "superficie"),
    "rooms": ("rooms", "pieces", "nb_pieces", "roomCount"),
    "bedrooms": ("bedrooms", "chambres", "nb_chambres"),
    "lat": ("lat", "latitude"),
    "lon": ("lon", "longitude"),
    "dpe": ("dpe", "energyClassification"),
    "ges": ("ges", "gasEmission"),
    "charges": ("charges",),
    "deposit": ("deposit", "depotGarantie"),
    "fees": ("fees", "honoraires"),
}
_TRIMMED = ("title", "address", "city", "postalCode", "floor", "description")
_NUMBERS = ("price", "surface", "rooms", "bedrooms", "lat", "lon", "charges", "deposit", "fees")


def normalize_raw_fields(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns under any accepted alias to the raw listing fields."""
    out = [F.col(c) for c in keep]
    out += [L.strip(_alias(df, (name,))).alias(name) for name in _TRIMMED]
    out += [parse_number_fr(_alias(df, FIELD_ALIASES[name])).alias(name) for name in _NUMBERS]
    out.append(L.detect_type(_alias(df, FIELD_ALIASES["type"])).alias("type"))
    out += [L.energy_grade(_alias(df, FIELD_ALIASES[name])).alias(name) for name in ("dpe", "ges")]
    return df.select(*out)


def market_listings(communes: DataFrame, limit: int | None = None) -> DataFrame:
    """Commune price statistics times three flat variants, as raw listings.

    ``communes`` has code, label and price_m2. Only with a ``limit`` the first
    communes by code are taken (a top-k, not a sort of the table).
    """
    priced = communes.where(F.col("price_m2") > 0)
    if limit is not None:
        priced = priced.orderBy("code").limit(limit)
    variants = F.array(*[
        F.struct(
            F.lit(rooms).cast("double").alias("rooms"), F.lit(surface).alias("surface"),
            F.lit(suffix).alias("suffix"), F.lit(kind).alias("type"), F.lit(name).alias("name"),
        )
        for rooms, surface, suffix, kind, name in K.MARKET_VARIANTS
    ])
    label = F.coalesce("label", "code", F.lit("Commune"))
    rent = F.floor(F.col("price_m2") * F.col("v.surface") / K.MARKET_RENT_DIVISOR + 0.5)
    return priced.withColumn("v", F.explode(variants)).select(
        F.concat(F.lit(K.MARKET_URL), "code", F.lit("/"), "v.suffix").alias("url"),
        F.lit("dvf").alias("source"),
        F.concat("v.name", F.lit(" — "), label).alias("title"),
        F.col("v.type").alias("type"),
        F.greatest(F.lit(K.MARKET_MIN_RENT), rent.cast("double")).alias("price"),
        F.col("v.surface").alias("surface"),
        F.col("v.rooms").alias("rooms"),
        F.concat("code", F.lit(" · "), label).alias("address"),
        label.alias("city"),
        F.when(F.length("code") == 5, F.col("code")).alias("postalCode"),
    )


def complete_raw(df: DataFrame) -> DataFrame:
    """Add the raw listing columns a frame lacks, as nulls of the declared type."""
    from ..schemas import RAW_LISTING

    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in RAW_LISTING
    ])


def market_records(communes: DataFrame, limit: int | None = None) -> DataFrame:
    """Market listings as valid listing records with their extra tags."""
    valid, _ = split_rejects(normalize_listings(complete_raw(market_listings(communes, limit))))
    extra = F.array(*[F.lit(t) for t in K.MARKET_TAGS])
    return valid.withColumn("tags", F.concat("tags", extra)).withColumn("source", F.lit("dvf"))


# --- filter, search, page --------------------------------------------------

@dataclass(frozen=True)
class ListingFilter:
    q: str | None = None
    city: str | None = None
    source: str | None = None
    min_price: float | None = None
    max_price: float | None = None
    min_rooms: float | None = None

    @classmethod
    def parse(cls, query: Mapping[str, object]) -> "ListingFilter":
        """Filter from request-style parameters; blank and non-numeric values are ignored."""

        def text(name: str, lower: bool) -> str | None:
            value = query.get(name)
            if not isinstance(value, str) or not value.strip():
                return None
            return value.strip().lower() if lower else value.strip()

        return cls(
            q=text("q", False), city=text("city", True), source=text("source", True),
            min_price=_number(query.get("minPrice")), max_price=_number(query.get("maxPrice")),
            min_rooms=_number(query.get("minRooms")),
        )


def _number(value: object) -> float | None:
    if value is None or value == "":
        return None
    try:
        number = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None
    return number if number - number == 0 else None


def text_search(listings: DataFrame, q: str) -> DataFrame:
    """Case-insensitive literal substring over title, address and city."""
    haystack = F.lower(F.concat_ws(" ", "title", "address", L.city_from_address(F.col("address"))))
    return listings.where(F.contains(haystack, F.lit(q.lower())))


def filter_listings(listings: DataFrame, f: ListingFilter) -> DataFrame:
    """All given predicates; those on stored columns reach the Parquet scan."""
    out = listings
    if f.min_price is not None:
        out = out.where(F.col("price") >= f.min_price)
    if f.max_price is not None:
        out = out.where(F.col("price") <= f.max_price)
    if f.min_rooms is not None:
        out = out.where(F.col("rooms") >= f.min_rooms)
    if f.source:
        out = out.where(F.lower("source") == f.source.lower())
    if f.city:
        out = out.where(L.city_from_address(F.col("address")) == f.city)
    return text_search(out, f.q) if f.q else out


def parse_pagination(query: Mapping[str, object]) -> tuple[int | None, int]:
    """(limit or None, offset); the limit is capped at the page size, 0 or less means none."""
    limit, offset = _number(query.get("limit")), _number(query.get("offset"))
    capped = int(min(limit, K.MAX_PAGE_SIZE)) if limit is not None and limit > 0 else None
    return capped, max(0, int(offset or 0))


def paginate(listings: DataFrame, order: Sequence[str], limit: int | None, offset: int = 0, slices: int = 256) -> DataFrame:
    """A page with ``total`` in ascending ``order`` (nulls first); without a limit everything, the offset then being
    ignored.

    The page is found by order statistics, not by counting through the offset: cut values of the first order column
    (from a sample of about 20 rows per slice; they only decide how fine the slices are) split the rows into at most
    ``slices`` + 1 ranges plus one of nulls, and one aggregate counts each range. The ranges that hold rows
    offset to offset + limit are the only ones sorted, and the offset left inside them is what is skipped. Equal
    first values always share a range, so ties are ordered by the other columns as in a full sort.
    """
    total = listings.agg(F.count(F.lit(1))).scalar()
    if limit is None:
        return listings.withColumn("total", total)
    ranged = page_slices(listings, order[0], slices)
    counts = sorted((r["_slice"], r["n"]) for r in ranged.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).collect())
    seen, before, wanted = 0, 0, []
    for number, n in counts:
        if seen + n > offset and seen < offset + limit:
            before = before if wanted else seen
            wanted.append(number)
        seen += n
    if not wanted:
        return listings.limit(0).withColumn("total", total)
    inside = ranged.where(F.col("_slice").between(wanted[0], wanted[-1])).drop("_slice")
    return inside.orderBy(*order).offset(offset - before).limit(limit).withColumn("total", total)


def page_slices(listings: DataFrame, column: str, slices: int = 256) -> DataFrame:
    """The rows with ``_slice``: -1 for a null ``column``, else how many cut values lie at or below the value."""
    n = listings.count()
    sample = listings.select(column).where(F.col(column).isNotNull())
    if n > 20 * slices:
        sample = sample.sample(fraction=20 * slices / n, seed=7)
    values = sorted({r[0] for r in sample.collect()})
    cuts = values[:: max(1, len(values) // slices)][1:] if values else []
    cut_array = F.array(*[F.lit(v) for v in cuts]) if cuts else F.array().cast(f"array<{listings.schema[column].dataType.simpleString()}>")
    number = F.size(F.filter(cut_array, lambda c: c <= F.col(column)))
    return listings.withColumn("_slice", F.when(F.col(column).isNull(), F.lit(-1)).otherwise(number))


def page_after(listings: DataFrame, order: Sequence[str], last: Sequence[object] | None, limit: int) -> DataFrame:
    """The next ``limit`` rows after the row whose order values are ``last`` (None for the first page).

    No offset is counted through: every page, however deep, is a top-k of ``limit`` rows per task over what lies behind
    ``last``. ``order`` has to end with a unique column; its values are not null.
    """
    behind = F.lit(last is None)
    same = F.lit(True)
    for name, value in zip(order, last or ()):
        behind, same = behind | (same & (F.col(name) > F.lit(value))), same & (F.col(name) == F.lit(value))
    return listings.where(behind).orderBy(*order).limit(limit)


# --- comparison ------------------------------------------------------------

def with_price_per_m2(listings: DataFrame) -> DataFrame:
    ratio = price_per_m2(F.col("price"), F.col("surface"))
    return listings.withColumn("price_m2", ratio).withColumn("price_m2_display", F.floor(ratio + 0.5).cast("bigint"))


# Criterion, column, and which side wins (-1 lower, 1 higher, 0 no winner).
COMPARE_CRITERIA = (
    ("Prix", "price", -1),
    ("Surface", "surface", 1),
    ("Pièces", "rooms", 1),
    ("Chambres", "bedrooms", 1),
    ("Prix/m²", "price_m2", -1),
    ("Étage", "floor", 0),
    ("Charges", "charges", -1),
    ("Dépôt de garantie", "deposit", -1),
    ("DPE", "dpe", -1),
    ("GES", "ges", -1),
    ("Ascenseur", "elevator", 0),
    ("Parking", "parking", 0),
    ("Cave", "cellar", 0),
    ("Balcon", "balcony", 0),
    ("Terrasse", "terrace", 0),
    ("Meublé", "furnished", 0),
)


def compare_pairs(pairs: DataFrame, listings: DataFrame, key: str = "url") -> DataFrame:
    """Criteria of both listings of each pair (a_key, b_key), one row per criterion, with the winner."""
    side = with_price_per_m2(listings)
    fields = sorted({column for _, column, _ in COMPARE_CRITERIA})
    a = side.select(F.col(key).alias("a_key"), F.struct(*fields).alias("a"))
    b = side.select(F.col(key).alias("b_key"), F.struct(*fields).alias("b"))
    both = pairs.join(a, "a_key").join(b, "b_key")

    def row(position: int, label: str, column: str, better: int) -> Column:
        va, vb = F.col(f"a.{column}"), F.col(f"b.{column}")
        if better == 0:
            winner = F.lit("none")
        else:
            # Grades compare as their letter: A is best, so the lower one wins.
            ahead = (va > vb) if better > 0 else (va < vb)
            winner = F.when(va.isNull() | vb.isNull() | (va == vb), "equal").when(ahead, "a").otherwise("b")
        return F.struct(
            F.lit(position).alias("position"), F.lit(label).alias("criterion"),
            va.cast("string").alias("a_value"), vb.cast("string").alias("b_value"), winner.alias("winner"),
        )

    rows = F.array(*[row(i, *criterion) for i, criterion in enumerate(COMPARE_CRITERIA, start=1)])
    return both.select("a_key", "b_key", F.inline(rows))
