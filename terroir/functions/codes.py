"""Territory codes: levels, padding, departments, regions and years."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A small driver-side mapping as one literal map (no join, no broadcast)."""
    flat = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*flat)


def map_level(scale: Column, substring: bool = False) -> Column:
    """Source scale to city / department / region, exactly or by substring."""
    text = F.lower(F.trim(scale)) if not substring else F.lower(scale)
    if not substring:
        return F.try_element_at(literal_map(K.SCALE_TO_LEVEL), text)
    out = F.lit(None).cast("string")
    for level, parts in reversed(K.SCALE_SUBSTRINGS):
        hit = F.lit(False)
        for part in parts:
            hit = hit | F.contains(text, F.lit(part))
        out = F.when(hit, F.lit(level)).otherwise(out)
    return out


def _present(code: Column) -> Column:
    text = F.trim(code)
    return F.when(~F.lower(text).isin("", "nan", "none"), text)


def zfill(code: Column, width: int) -> Column:
    """Left-pad with zeros without ever truncating."""
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def pad_code(code: Column, width: int) -> Column:
    """Trim; blank, nan and none become null; digit strings are padded to ``width``."""
    text = _present(code)
    return F.when(text.rlike("^[0-9]+$"), zfill(text, width)).otherwise(text)


def normalize_geo_code(code: Column, level: Column) -> Column:
    """Code as expected at its level: 5 characters for a city, 2 for department and region."""
    text = _present(code)
    digits = F.regexp_replace(text, "[^0-9]", "")
    is_city = level == "city"
    is_parent = level.isin("department", "region")
    return (
        F.when(text.rlike("^[0-9]+$") & is_city, zfill(text, 5))
        .when(text.rlike("^[0-9]+$") & is_parent, zfill(text, 2))
        .when(is_city & (F.length(digits) >= 5), F.substring(digits, 1, 5))
        .when(is_parent & (F.length(digits) >= 2), F.substring(digits, 1, 2))
        .otherwise(text)
    )


def display_code(code: Column, level: str) -> Column:
    """Upper-case code as used on maps: short numeric department and region codes are padded."""
    text = F.upper(F.trim(code))
    if level not in ("department", "region"):
        return text
    return F.when(text.rlike("^[0-9]{1,2}$"), zfill(text, 2)).otherwise(text)


def extract_year(value: Column) -> Column:
    """A four-digit value, else the first 19xx or 20xx in the text."""
    text = F.trim(value)
    found = F.regexp_extract(text, "((?:19|20)[0-9]{2})", 1)
    return (
        F.when(text.rlike("^[0-9]{4}$"), text.try_cast("int"))
        .otherwise(F.nullif(found, F.lit("")).try_cast("int"))
    )


def department_from_commune(code: Column) -> Column:
    """Department of a commune code: three characters overseas, 2A and 2B kept."""
    text = F.upper(F.trim(code))
    return (
        F.when(text.startswith("97") & (F.length(text) >= 3), F.substring(text, 1, 3))
        .when(F.substring(text, 1, 2).isin("2A", "2B"), F.substring(text, 1, 2))
        .when(F.length(text) >= 5, F.substring(text, 1, 2))
        .otherwise(text)
    )


def department_from_insee(code: Column) -> Column:
    """Department of a five-digit code, as the geocoder reads it."""
    return (
        F.when(code.rlike("^(97[1-8]|98[47])[0-9]{2}$"), F.substring(code, 1, 3))
        .otherwise(F.substring(code, 1, 2))
    )


def region_from_department(department: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """Region by lookup; departments the table lacks give null."""
    return F.try_element_at(literal_map(mapping or K.DEPARTMENT_TO_REGION), department)


def region_from_digit(department: Column) -> Column:
    """Region by digit: the first one, or the second after a leading zero; overseas unchanged."""
    first = F.substring(department, 1, 1)
    return (
        F.when(department.startswith("97"), department)
        .when(first == "0", F.substring(department, 2, 1))
        .otherwise(first)
    )


def is_commune_code(code: Column, allow_corsica: bool = False) -> Column:
    return code.rlike("^([0-9]{5}|2[AB][0-9]{3})$" if allow_corsica else "^[0-9]{5}$")
