"""Listing fields: city, source, type, tags, address and geocoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .codes import department_from_insee
from .numbers import jitter, rolling_hash
from .text import contains_any, fold_accents, let


# The white space a web client trims.
WHITE_SPACE = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def blank_to_null(text: Column) -> Column:
    trimmed = strip(text)
    return F.when(trimmed != "", trimmed)


def city_from_address(address: Column) -> Column:
    """City named in the part after the last comma, else that part in lower case."""

    def named(tail: Column) -> Column:
        out = tail
        for keyword, city in reversed(K.CITY_KEYWORDS):
            out = F.when(F.contains(tail, F.lit(keyword)), F.lit(city)).otherwise(out)
        return out

    last = F.regexp_extract(address, "[^,]*$", 0)
    return let(F.lower(F.when(address.contains(","), strip(last)).otherwise(address)), named)


def canonical_source(raw: Column) -> Column:
    low = F.lower(raw)
    cleaned = F.substring(F.regexp_replace(low, "[^a-z0-9]", ""), 1, 32)
    out = F.when(cleaned == "", F.lit("unknown")).otherwise(cleaned)
    for name, aliases in reversed(K.SOURCE_ALIASES):
        out = F.when(contains_any(low, aliases), F.lit(name)).otherwise(out)
    return out


def stable_id(url: Column) -> Column:
    return F.substring(F.sha2(url.cast("binary"), 256), 1, 16)


def detect_type(raw: Column) -> Column:
    low = F.lower(raw)
    return (
        F.when(low.contains("studio"), "studio")
        .when(contains_any(low, ("appartement", "apartment")), "appartement")
        .when(contains_any(low, ("maison", "house", "villa")), "maison")
        .when(low.isNotNull(), "autre")
    )


def energy_grade(raw: Column) -> Column:
    grade = F.upper(strip(raw))
    return F.when(grade.isin(*K.ENERGY_GRADES), grade)


def build_address(address: Column, postal_code: Column, city: Column) -> Column:
    parts = F.concat_ws(" · ", F.nullif(postal_code, F.lit("")), F.nullif(city, F.lit("")))
    return F.coalesce(blank_to_null(address), F.nullif(parts, F.lit("")), F.lit(K.DEFAULT_ADDRESS))


def derive_tags() -> Column:
    """Tags from the amenity columns and the energy grade of a raw listing."""
    tags = [F.when(F.col(name), F.lit(label)) for name, label in K.TAG_LABELS]
    grade = F.when(F.col("dpe") != "", F.concat(F.lit("DPE "), F.col("dpe")))
    return F.array_compact(F.array(*tags, grade))


# --- geocoding -------------------------------------------------------------

Centroid = tuple[str, float, float, str]


def _centroid_struct(key: str, lat: float, lon: float) -> Column:
    return F.struct(F.lit(key).alias("key"), F.lit(lat).alias("lat"), F.lit(lon).alias("lon"))


def _by_key(centroids: Sequence[Centroid], key: Column) -> Column:
    entries = [x for k, lat, lon, _ in centroids for x in (F.lit(k), _centroid_struct(k, lat, lon))]
    return F.try_element_at(F.create_map(*entries), key)


def _city_centroid(city: Column, centroids: Sequence[Centroid]) -> Column:
    key = fold_accents(city)
    places = F.array(*[_centroid_struct(k, lat, lon) for k, lat, lon, _ in centroids if not k.startswith("dept-")])
    near = F.filter(places, lambda p: F.contains(key, p["key"]) | F.contains(p["key"], key))
    return F.when(city != "", F.coalesce(_by_key(centroids, key), F.try_element_at(near, F.lit(1))))


def insee_coordinates(insee: Column, centroids: Sequence[Centroid] = K.CENTROIDS) -> Column:
    """Deterministic approximate place of any code: near its department centroid, else hashed."""
    place = insee_place(insee, _by_key(centroids, F.concat(F.lit("dept-"), department_from_insee(insee))))
    return F.when(place.isNotNull(), F.struct(F.lit("insee").alias("key"), place["lat"].alias("lat"), place["lon"].alias("lon")))


def geocode_city(city: Column, postal_code: Column, centroids: Sequence[Centroid] = K.CENTROIDS) -> Column:
    """Place of a city name, else of a five-digit code, else of a department prefix.

    The centroid list is a driver-side sequence, so it is a literal in the plan:
    a projection, with no join and nothing broadcast per row count.
    """
    insee = F.when(postal_code.rlike("^[0-9]{5}$"), postal_code)
    department = F.when(F.length(postal_code) >= 2, F.concat(F.lit("dept-"), F.substring(postal_code, 1, 2)))
    return F.coalesce(
        _city_centroid(city, centroids),
        insee_coordinates(insee, centroids),
        _by_key(centroids, department),
    )


def insee_place(insee: Column, base: Column) -> Column:
    """Deterministic approximate place of a code: near ``base`` (lat, lon) if that is known, else hashed."""
    h = rolling_hash(insee)
    lat = F.coalesce(base["lat"], F.lit(42.2) + F.abs(h) % 850 / F.lit(100.0))
    lon = F.coalesce(base["lon"], F.lit(-4.8) + F.abs(F.shiftright(h, 8)) % 1000 / F.lit(100.0))
    lat, lon = jitter(lat, lon, insee)
    return F.when(insee.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


__all__ = [
    "blank_to_null", "build_address", "canonical_source", "city_from_address", "derive_tags",
    "detect_type", "energy_grade", "geocode_city", "insee_coordinates", "stable_id", "strip",
]
