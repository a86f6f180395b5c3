"""Numbers: lenient parsing, the rolling hash and weighted means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

_NUMBER_PREFIX = r"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def leading_number(text: Column) -> Column:
    """The number a text starts with (leading blanks allowed), else null."""
    found = F.regexp_extract(F.ltrim(text), _NUMBER_PREFIX, 1)
    return F.nullif(F.regexp_replace(found, r"\.$", ""), F.lit("")).try_cast("double")


def _first_comma_to_dot(text: Column) -> Column:
    return F.regexp_replace(text, r"^([^,]*),", "$1.")


def parse_number_fr(text: Column) -> Column:
    """Number in French notation with currency, units and blanks around it."""
    return leading_number(_first_comma_to_dot(F.regexp_replace(text, "[^0-9,.-]", "")))


def parse_number_compact(text: Column) -> Column:
    """Number whose blanks are thousands separators and whose comma is the decimal mark."""
    return leading_number(_first_comma_to_dot(F.regexp_replace(text, r"(?U)\s", "")))


def _wrap32(value: Column) -> Column:
    """Two's complement wrap of a 64-bit value to 32 bits."""
    return (value + F.lit(2**31)).bitwiseAND(F.lit(2**32 - 1)) - F.lit(2**31)


def rolling_hash(text: Column) -> Column:
    """31-polynomial hash over UTF-16 units with 32-bit overflow, as a bigint."""

    def step(acc: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        high = F.lit(0xD800) + F.shiftright(point - 0x10000, 10)
        low = F.lit(0xDC00) + (point - 0x10000).bitwiseAND(F.lit(0x3FF))
        return (
            F.when(point < 0x10000, _wrap32(acc * 31 + point))
            .otherwise(_wrap32(_wrap32(acc * 31 + high) * 31 + low))
        )

    return F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), step)


def jitter_offsets(hash_value: Column) -> tuple[Column, Column]:
    """Small deterministic offsets (latitude, longitude) from a rolling hash."""
    dx = (hash_value % 1000 - 500) / F.lit(50000.0)
    dy = (F.shiftright(hash_value, 10) % 1000 - 500) / F.lit(50000.0)
    return dx, dy


def jitter(lat: Column, lon: Column, seed: Column) -> tuple[Column, Column]:
    dx, dy = jitter_offsets(rolling_hash(seed))
    return lat + dx, lon + dy


def weighted_avg(value: Column, weight: Column, null_safe: bool = True) -> Column:
    """sum(v*w) / sum(w); null-safe leaves the weight of null values out."""
    used = F.when(value.isNotNull(), weight) if null_safe else weight
    total = F.sum(used)
    return F.when(total != 0, F.sum(value * weight) / total)


def price_per_m2(price: Column, surface: Column) -> Column:
    return F.when(surface > 0, price / surface)


def distance_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Flat-earth distance; a missing coordinate counts as no distance."""
    dy = (lat_b - lat_a) * K.KM_PER_LAT
    dx = (lon_b - lon_a) * K.KM_PER_LON
    return F.coalesce(F.sqrt(dy * dy + dx * dx), F.lit(0.0))
