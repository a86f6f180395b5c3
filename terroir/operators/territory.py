"""Territories: unpivots, sampling, hierarchy joins and rollups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import constants as K
from ..functions.numbers import weighted_avg
from .keyed import union_frames
from .ranking import median_by

PRICE_COLUMNS = ("year", "level", "insee_code", "property_type", "price_m2_avg", "price_m2_median", "mutation_count")


# --- normalisation and reshaping -------------------------------------------

def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient casts: bad values become null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def normalize_territories(wide: DataFrame, keep_unknown_as_city: bool = False) -> DataFrame:
    """Level and code of the wide statistics.

    Scales other than commune, department and region are dropped; with
    ``keep_unknown_as_city`` they are kept at city level.
    """
    level = C.map_level(F.col("echelle_geo"))
    code = C.normalize_geo_code(F.col("code_geo"), F.coalesce(level, F.lit("")))
    out = wide.withColumn("level", level).withColumn("insee_code", code).where(F.col("insee_code").isNotNull())
    if keep_unknown_as_city:
        return out.withColumn("level", F.coalesce("level", F.lit("city")))
    return out.where(F.col("level").isNotNull())


# Measure prefix of the wide statistics -> fact column and type.
PRICE_MEASURES = (
    ("moy_prix_m2_whole_", "price_m2_avg", "double"),
    ("med_prix_m2_whole_", "price_m2_median", "double"),
    ("nb_ventes_whole_", "mutation_count", "bigint"),
)


def unpivot_property_types(
    wide: DataFrame,
    year: int | Column = K.FALLBACK_YEAR,
    property_types: Mapping[str, str] = K.PROPERTY_TYPES,
) -> DataFrame:
    """Wide to long over property types; rows with neither an average nor a median are dropped."""
    rows = []
    for name, suffix in property_types.items():
        if not any(prefix + suffix in wide.columns for prefix, _, _ in PRICE_MEASURES):
            continue
        cells = [
            (F.col(prefix + suffix) if prefix + suffix in wide.columns else F.lit(None)).try_cast(kind).alias(out)
            if kind == "double" or prefix + suffix not in wide.columns
            else F.col(prefix + suffix).try_cast("double").try_cast(kind).alias(out)
            for prefix, out, kind in PRICE_MEASURES
        ]
        rows.append(F.struct(F.lit(name).alias("property_type"), *cells))
    if not rows:
        raise ValueError(f"no price columns for {sorted(property_types.values())}")
    year_col = year if isinstance(year, Column) else F.lit(year)
    return (
        wide.select(year_col.alias("year"), "level", "insee_code", F.inline(F.array(*rows)))
        .where(F.col("year").isNotNull() & F.coalesce("price_m2_avg", "price_m2_median").isNotNull())
        .withColumn("source", F.lit(K.PRICE_SOURCE))
    )


def age_bin_mean(prefix: str, columns: Sequence[str]) -> Column:
    """Mean age over the age bins present; null when they hold nobody."""
    bins = [(F.col(f"{prefix}_POP{b}").try_cast("double"), mid)
            for b, mid in K.AGE_BIN_MIDPOINTS.items() if f"{prefix}_POP{b}" in columns]
    if not bins:
        return F.lit(None).cast("double")
    total = reduce(lambda x, y: x + y, [F.coalesce(b, F.lit(0.0)) for b, _ in bins])
    years = reduce(lambda x, y: x + y, [F.coalesce(b * mid, F.lit(0.0)) for b, mid in bins])
    return F.when(total > 0, years / total)


def unpivot_years(
    wide: DataFrame,
    years: Iterable[int] = K.CENSUS_YEARS,
    regions: Mapping[str, str] | None = None,
) -> DataFrame:
    """Wide population to one row per commune and census year found in the columns."""
    prefixes = [(y, f"P{y % 100:02d}") for y in years if f"P{y % 100:02d}_POP" in wide.columns]
    if not prefixes:
        raise ValueError("no census population columns")
    rows = F.array(*[
        F.struct(
            F.lit(y).alias("year"),
            F.col(f"{p}_POP").try_cast("double").alias("population"),
            age_bin_mean(p, wide.columns).alias("median_age"),
        )
        for y, p in prefixes
    ])
    department = C.department_from_commune(F.col("insee_code"))
    return (
        wide.select(F.trim("CODGEO").alias("insee_code"), F.inline(rows))
        .where(F.col("insee_code").isNotNull() & F.col("population").isNotNull())
        .select(
            "year", F.lit("city").alias("level"), "insee_code",
            department.alias("department_insee_code"),
            C.region_from_department(department, regions).alias("region_insee_code"),
            "population", "median_age", F.lit(K.POPULATION_SOURCE).alias("source"),
        )
    )


def region_lookup(df: DataFrame, department: str, regions: Mapping[str, str] | DataFrame | None = None) -> DataFrame:
    """Add the region: from a mapping, which becomes a literal of the plan, or from a table (department, region), by a join."""
    if isinstance(regions, DataFrame):
        table = regions.select(F.col("department").alias("_department"), F.col("region").alias("region_insee_code"))
        return df.join(table, F.col(department) == F.col("_department"), "left").drop("_department")
    return df.withColumn("region_insee_code", C.region_from_department(F.col(department), regions))


def unmapped_departments(df: DataFrame, department: str, regions: Mapping[str, str] | None = None) -> DataFrame:
    """Departments without a region, with their row counts."""
    missing = C.region_from_department(F.col(department), regions).isNull()
    return df.where(missing).groupBy(department).agg(F.count(F.lit(1)).alias("n"))


# --- filters and samples ---------------------------------------------------

def fact_slice(facts: DataFrame, level: str, year: int, property_type: str | None = None) -> DataFrame:
    """level = and year = and property type =; the first two prune partitions."""
    out = facts.where((F.col("level") == level) & (F.col("year") == year))
    return out if property_type is None else out.where(F.col("property_type") == property_type)


def commune_codes_only(df: DataFrame, allow_corsica: bool = False) -> DataFrame:
    return df.where(C.is_commune_code(F.col("insee_code"), allow_corsica))


def parse_prefixes(text: str) -> list[str]:
    return [p for p in text.replace(" ", "").split(",") if p]


def code_prefixes(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Codes starting with any prefix; no prefix means no filter."""
    if not prefixes:
        return df
    return df.where(reduce(lambda x, y: x | y, [F.col("insee_code").startswith(p) for p in prefixes]))


def sample_territories(df: DataFrame, n: int, overrides: Sequence[str] = (), code: str = "insee_code") -> DataFrame:
    """City rows of the first ``n`` codes in order and of the override codes; 0 keeps every row and level."""
    if n <= 0:
        return df
    cities = df.where(F.col("level") == "city")
    first = cities.select(code).where(F.col(code).isNotNull()).distinct().orderBy(code).limit(n)
    # The kept set has at most n + len(overrides) codes: both are call parameters.
    return cities.join(first, code, "left_semi").unionByName(
        cities.where(F.col(code).isin(list(overrides))).join(first, code, "left_anti")
    ) if overrides else cities.join(first, code, "left_semi")


def cap_codes(codes: DataFrame, preferred: DataFrame, maximum: int, code: str = "insee_code") -> DataFrame:
    """At most ``maximum`` codes when there are more: the preferred ones if any, else the first in order."""
    distinct = codes.select(code).where(F.col(code).isNotNull()).distinct()
    if maximum <= 0:
        return distinct
    liked = distinct.join(preferred.select(code).distinct(), code, "left_semi")
    fits = distinct.agg(F.count(F.lit(1))).scalar() <= maximum
    none_liked = liked.agg(F.count(F.lit(1))).scalar() == 0
    others = distinct.join(liked, code, "left_anti").where(fits | none_liked)
    return liked.unionByName(others).orderBy(code).limit(maximum)


# --- hierarchy -------------------------------------------------------------

def _population_asof(population: DataFrame) -> DataFrame:
    """Each census row with the first year it no longer applies."""
    until = F.lead("year").over(Window.partitionBy("insee_code").orderBy("year"))
    return population.withColumn("_until", until).withColumnRenamed("year", "_from")


def join_hierarchy(prices: DataFrame, population: DataFrame, year_match: str = "exact") -> DataFrame:
    """City prices with population and parent codes.

    ``year_match`` is ``exact`` (same year) or ``latest_leq`` (the latest census
    not after the price year). Which side is broadcast is left to the size
    statistics of both frames.
    """
    city = prices.where(F.col("level") == "city").drop("level", "source")
    parents = population.where(F.col("level") == "city").select(
        "year", "insee_code", "population", "department_insee_code", "region_insee_code"
    )
    if year_match == "exact":
        return city.join(parents, ["year", "insee_code"])
    if year_match != "latest_leq":
        raise ValueError(f"year_match {year_match!r}")
    valid = (F.col("year") >= F.col("_from")) & (F.col("_until").isNull() | (F.col("year") < F.col("_until")))
    return (
        city.alias("p").join(_population_asof(parents), ["insee_code"]).where(valid).drop("_from", "_until")
    )


def _parent_rollup(joined: DataFrame, levels: Sequence[str], null_safe: bool) -> DataFrame:
    """One scan and one shuffle for all parent levels."""
    parents = F.array(*[
        F.struct(F.lit(level).alias("level"), F.col(f"{level}_insee_code").alias("code")) for level in levels
    ])
    return (
        joined.withColumn("_parent", F.explode(parents))
        .where(F.col("_parent.code").isNotNull())
        .groupBy("year", F.col("_parent.level").alias("level"), F.col("_parent.code").alias("insee_code"), "property_type")
        .agg(
            weighted_avg(F.col("price_m2_avg"), F.col("population"), null_safe).alias("price_m2_avg"),
            weighted_avg(F.col("price_m2_median"), F.col("population"), null_safe).alias("price_m2_median"),
            F.sum("mutation_count").cast("double").alias("mutation_count"),
        )
    )


def rollup_prices(joined: DataFrame, level: str, null_safe: bool = True) -> DataFrame:
    """Population-weighted prices of one parent level."""
    return _parent_rollup(joined, [level], null_safe)


def rollup_hierarchy(
    prices: DataFrame, population: DataFrame, year_match: str = "exact", null_safe: bool = True
) -> DataFrame:
    """City, department and region prices in one fact table."""
    city = prices.where(F.col("level") == "city").select(*PRICE_COLUMNS)
    city = city.withColumn("mutation_count", F.col("mutation_count").cast("double"))
    parents = _parent_rollup(join_hierarchy(prices, population, year_match), ["department", "region"], null_safe)
    return union_frames(city, parents.select(*PRICE_COLUMNS)).withColumn("source", F.lit(K.PRICE_SOURCE))


def parent_code(level: str, region_rule: str = "lookup", code: str = "insee_code") -> Column:
    """Department or region of a commune code; regions by lookup table or by digit."""
    department = C.department_from_commune(F.col(code))
    if level == "department":
        return department
    if level != "region":
        raise ValueError(f"no parent level {level!r}")
    return C.region_from_department(department) if region_rule == "lookup" else C.region_from_digit(department)


def rollup_prices_unweighted(
    facts: DataFrame, level: str, year: int | None = None, property_type: str | None = None, region_rule: str = "lookup"
) -> DataFrame:
    """Plain mean of averages, median of medians and summed mutations per parent code."""
    city = commune_codes_only(facts.where(F.col("level") == "city"))
    if year is not None:
        city = city.where(F.col("year") == year)
    if property_type is not None:
        city = city.where(F.col("property_type") == property_type)
    keyed = city.withColumn("insee_code", parent_code(level, region_rule)).where(F.col("insee_code").isNotNull())
    keys = ["year", "insee_code", "property_type"]
    sums = keyed.groupBy(*keys).agg(
        F.avg("price_m2_avg").alias("price_m2_avg"), F.sum("mutation_count").cast("double").alias("mutation_count")
    )
    medians = median_by(keyed, keys, "price_m2_median", "price_m2_median")
    # A property type may be null: its rows are a group like others.
    m = medians.select(*[F.col(k).alias(f"_{k}") for k in keys], "price_m2_median")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return sums.join(m, same, "left").withColumn("level", F.lit(level)).select(*PRICE_COLUMNS)


def rollup_demographics(facts: DataFrame, level: str, year: int | None = None, region_rule: str = "lookup") -> DataFrame:
    """Summed population and mean age per parent code."""
    city = commune_codes_only(facts.where(F.col("level") == "city"))
    if year is not None:
        city = city.where(F.col("year") == year)
    keyed = city.withColumn("insee_code", parent_code(level, region_rule)).where(F.col("insee_code").isNotNull())
    return (
        keyed.groupBy("year", "insee_code")
        .agg(F.sum("population").alias("population"), F.avg("median_age").alias("median_age"))
        .select("year", F.lit(level).alias("level"), "insee_code", "population", "median_age")
    )


def population_weighted_age(city: DataFrame, code: str, level: str, null_safe: bool = False) -> DataFrame:
    """Population and population-weighted age per parent code column."""
    return (
        city.where(F.col(code).isNotNull())
        .groupBy("year", F.col(code).alias("insee_code"))
        .agg(
            F.sum("population").alias("population"),
            weighted_avg(F.col("median_age"), F.col("population"), null_safe).alias("median_age"),
        )
        .select("year", F.lit(level).alias("level"), "insee_code", "population", "median_age")
    )


def prices_or_rollup(facts: DataFrame, level: str, region_rule: str = "lookup") -> DataFrame:
    """Stored rows of a level; slices (year, property type) it lacks are rolled up from the cities."""
    direct = facts.where(F.col("level") == level).select(*PRICE_COLUMNS)
    direct = direct.withColumn("mutation_count", F.col("mutation_count").cast("double"))
    if level == "city":
        return direct
    stored = direct.select("year", "property_type").distinct()
    lacking = facts.join(stored, ["year", "property_type"], "left_anti")
    return direct.unionByName(rollup_prices_unweighted(lacking, level, region_rule=region_rule))


def demographics_or_rollup(facts: DataFrame, level: str, region_rule: str = "lookup") -> DataFrame:
    direct = facts.where(F.col("level") == level).select("year", "level", "insee_code", "population", "median_age")
    if level == "city":
        return direct
    lacking = facts.join(direct.select("year").distinct(), "year", "left_anti")
    return direct.unionByName(rollup_demographics(lacking, level, region_rule=region_rule))


# --- catalogue -------------------------------------------------------------

def counts_by(facts: DataFrame, column: str) -> DataFrame:
    return facts.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def latest_years(facts: DataFrame, n: int = 5) -> DataFrame:
    return facts.select("year").distinct().orderBy(F.col("year").desc()).limit(n)


def latest_vintage(facts: DataFrame, property_type: str, fallback: int = K.FALLBACK_YEAR) -> DataFrame:
    """Newest city year of a property type, else the fallback."""
    chosen = facts.where((F.col("level") == "city") & (F.col("property_type") == property_type))
    return chosen.agg(F.coalesce(F.max("year"), F.lit(fallback)).alias("year"))


def dataset_profile(facts: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, city rows and distinct city codes."""
    city_code = F.when(F.col("level") == "city", F.col("insee_code"))
    distinct = F.approx_count_distinct(city_code) if approximate else F.count_distinct(city_code)
    return facts.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("level") == "city").alias("city_rows"),
        distinct.alias("city_codes"),
    )


def raw_city_count(wide: DataFrame) -> DataFrame:
    """Distinct codes at commune scale in the raw statistics."""
    return wide.where(F.lower("echelle_geo") == "commune").agg(F.count_distinct("code_geo").alias("city_codes"))
