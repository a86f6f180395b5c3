"""Territory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terroir.functions import codes as C
from terroir.functions.numbers import weighted_avg
from terroir.operators.scoring import join_demographics, with_indicator
from terroir.operators import keyed
from terroir.operators import territory as T

from .base import case, near, near_sql, region_case, stored, table, view

FACTS = "SELECT year, level, insee_code, property_type, price_m2_avg, price_m2_median, mutation_count"


@case("cast_normalize", """SELECT code_geo, CAST(TRY_CAST(nb_ventes_whole_maison AS INT) AS INT) AS sales,
 TRY_CAST(moy_prix_m2_whole_maison AS DOUBLE) AS price FROM wide_prices""")
def _(spark, sf):
    df = view(spark, sf, "wide_prices").select(
        "code_geo", F.col("nb_ventes_whole_maison").alias("sales"), F.col("moy_prix_m2_whole_maison").alias("price")
    )
    return T.cast_columns(df, {"sales": "int", "price": "double"})


_LEVEL = """CASE lower(trim(echelle_geo)) WHEN 'commune' THEN 'city' WHEN 'departement' THEN 'department'
 WHEN 'département' THEN 'department' WHEN 'region' THEN 'region' WHEN 'région' THEN 'region' END"""


def _code(code: str, level: str) -> str:
    digits = f"regexp_replace({code}, '[^0-9]', '', 'g')"
    pure = f"regexp_matches({code}, '^[0-9]+$')"
    return f"""CASE WHEN {pure} AND {level} = 'city' THEN CASE WHEN length({code}) < 5 THEN lpad({code}, 5, '0') ELSE {code} END
 WHEN {pure} AND {level} IN ('department', 'region') THEN CASE WHEN length({code}) < 2 THEN lpad({code}, 2, '0') ELSE {code} END
 WHEN {level} = 'city' AND length({digits}) >= 5 THEN substr({digits}, 1, 5)
 WHEN {level} IN ('department', 'region') AND length({digits}) >= 2 THEN substr({digits}, 1, 2) ELSE {code} END"""


LEVELED = f"""leveled AS (SELECT *, {_code('trim(code_geo)', 'level')} AS insee_code FROM
 (SELECT *, {_LEVEL} AS level FROM wide_prices) WHERE level IS NOT NULL)"""


@case("map_level", f"""SELECT echelle_geo, {_LEVEL} AS level, CASE WHEN contains(lower(echelle_geo), 'commune') THEN 'city'
 WHEN contains(lower(echelle_geo), 'depart') OR contains(lower(echelle_geo), 'départ') THEN 'department'
 WHEN contains(lower(echelle_geo), 'region') OR contains(lower(echelle_geo), 'région') THEN 'region' END AS loose, code_geo FROM wide_prices""")
def _(spark, sf):
    scale = F.col("echelle_geo")
    return view(spark, sf, "wide_prices").select(
        "echelle_geo", C.map_level(scale).alias("level"), C.map_level(scale, substring=True).alias("loose"), "code_geo"
    )


@case("normalize_geo_code", f"WITH {LEVELED} SELECT code_geo, level, insee_code FROM leveled")
def _(spark, sf):
    return T.normalize_territories(view(spark, sf, "wide_prices")).select("code_geo", "level", "insee_code")


def _measure(kind: str, suffix: str) -> str:
    return f"TRY_CAST({kind}_whole_{suffix} AS DOUBLE)"


_LONG = " UNION ALL ".join(
    f"""SELECT 2023 AS year, level, insee_code, '{name}' AS property_type, {_measure('moy_prix_m2', s)} AS price_m2_avg,
 {_measure('med_prix_m2', s)} AS price_m2_median, CAST({_measure('nb_ventes', s)} AS BIGINT) AS mutation_count FROM leveled"""
    for name, s in (("apartments", "appartement"), ("houses", "maison"))
)


@case("unpivot_property_types", f"""WITH {LEVELED}, long AS ({_LONG}) SELECT * FROM long
 WHERE price_m2_avg IS NOT NULL OR price_m2_median IS NOT NULL""")
def _(spark, sf):
    return T.unpivot_property_types(T.normalize_territories(view(spark, sf, "wide_prices"))).drop("source")


_AGE = """(coalesce(TRY_CAST(P14_POP0014 AS DOUBLE), 0) * 7 + coalesce(TRY_CAST(P14_POP1529 AS DOUBLE), 0) * 22
 + coalesce(TRY_CAST(P14_POP3044 AS DOUBLE), 0) * 37 + coalesce(TRY_CAST(P14_POP90P AS DOUBLE), 0) * 95)"""
_AGED = """(coalesce(TRY_CAST(P14_POP0014 AS DOUBLE), 0) + coalesce(TRY_CAST(P14_POP1529 AS DOUBLE), 0)
 + coalesce(TRY_CAST(P14_POP3044 AS DOUBLE), 0) + coalesce(TRY_CAST(P14_POP90P AS DOUBLE), 0))"""
_MEAN_AGE = f"CASE WHEN {_AGED} > 0 THEN round({_AGE} / {_AGED}, 6) END"


@case("age_bin_mean", f"SELECT CODGEO AS code, {_MEAN_AGE} AS mean_age FROM wide_population")
def _(spark, sf):
    df = view(spark, sf, "wide_population")
    return df.select(F.col("CODGEO").alias("code"), F.round(T.age_bin_mean("P14", df.columns), 6).alias("mean_age"))


@case("unpivot_years", f"""WITH long AS (SELECT CAST(2009 AS INT) AS year, CODGEO AS insee_code, TRY_CAST(P09_POP AS DOUBLE) AS population,
   CAST(NULL AS DOUBLE) AS median_age FROM wide_population
  UNION ALL SELECT CAST(2014 AS INT), CODGEO, TRY_CAST(P14_POP AS DOUBLE), {_MEAN_AGE} FROM wide_population)
 SELECT year, insee_code, substr(insee_code, 1, 2) AS department_insee_code, {region_case('substr(insee_code, 1, 2)')} AS region_insee_code,
  population, median_age FROM long WHERE population IS NOT NULL""")
def _(spark, sf):
    df = T.unpivot_years(view(spark, sf, "wide_population"))
    return df.withColumn("median_age", F.round("median_age", 6)).drop("level", "source")


@case("extract_year", """SELECT doc_id, coalesce(CASE WHEN regexp_matches(t, '^[0-9]{4}$') THEN TRY_CAST(t AS INT) END,
  TRY_CAST(nullif(regexp_extract(t, '(?:19|20)[0-9]{2}'), '') AS INT)) AS year FROM (
  SELECT doc_id, trim(CASE WHEN doc_id % 3 = 0 THEN CAST(n_chars AS STRING) WHEN doc_id % 3 = 1
   THEN concat(' S', CAST(doc_id % 3 AS STRING), '-', CAST(1890 + doc_id % 180 AS STRING), '/2001 ') ELSE substr(text, 1) END) AS t FROM documents)""")
def _(spark, sf):
    text = F.expr("""CASE WHEN doc_id % 3 = 0 THEN CAST(n_chars AS STRING) WHEN doc_id % 3 = 1
   THEN concat(' S', CAST(doc_id % 3 AS STRING), '-', CAST(1890 + doc_id % 180 AS STRING), '/2001 ') ELSE text END""")
    return table(spark, sf, "documents").select("doc_id", C.extract_year(text).alias("year"))


_DEP = """CASE WHEN c LIKE '97%' AND length(c) >= 3 THEN substr(c, 1, 3) WHEN substr(c, 1, 2) IN ('2A', '2B') THEN substr(c, 1, 2)
 WHEN length(c) >= 5 THEN substr(c, 1, 2) ELSE c END"""


@case("dept_from_code", f"SELECT url, {_DEP} AS department FROM (SELECT url, upper(trim(postalCode)) AS c FROM raw_listings)")
def _(spark, sf):
    df = view(spark, sf, "raw_listings")
    return df.select("url", C.department_from_commune(F.col("postalCode")).alias("department"))


@case("region_lookup", f"""SELECT department, {region_case('department')} AS region_insee_code, count(*) AS n FROM
 (SELECT {_DEP} AS department FROM (SELECT upper(trim(postalCode)) AS c FROM raw_listings)) GROUP BY department""")
def _(spark, sf):
    df = view(spark, sf, "raw_listings").select(C.department_from_commune(F.col("postalCode")).alias("department"))
    counted = df.groupBy("department").agg(F.count(F.lit(1)).alias("n"))
    return T.region_lookup(counted, "department")


@case("region_lookup_table", f"""SELECT department, {region_case('department')} AS region_insee_code, count(*) AS n FROM
 (SELECT {_DEP} AS department FROM (SELECT upper(trim(postalCode)) AS c FROM raw_listings)) GROUP BY department""")
def _(spark, sf):
    from terroir.functions import constants as K

    df = view(spark, sf, "raw_listings").select(C.department_from_commune(F.col("postalCode")).alias("department"))
    table = spark.createDataFrame(list(K.DEPARTMENT_TO_REGION.items()), "department string, region string")
    return T.region_lookup(df.groupBy("department").agg(F.count(F.lit(1)).alias("n")), "department", table)


@case("filter_fact_slice", f"{FACTS} FROM prices WHERE level = 'city' AND year = 1998 AND property_type = 'apartments'")
def _(spark, sf):
    return T.fact_slice(view(spark, sf, "prices"), "city", 1998, "apartments")


@case("filter_commune_code", """SELECT url, postalCode AS insee_code FROM raw_listings WHERE regexp_matches(postalCode, '^[0-9]{5}$')""")
def _(spark, sf):
    return T.commune_codes_only(view(spark, sf, "raw_listings").select("url", F.col("postalCode").alias("insee_code")))


@case("filter_code_prefixes", f"{FACTS} FROM prices WHERE insee_code LIKE '01%' OR insee_code LIKE '13%' OR insee_code LIKE '22%'")
def _(spark, sf):
    return T.code_prefixes(view(spark, sf, "prices"), T.parse_prefixes("01, 13,,22"))


@case("sample_territories", f"""{FACTS} FROM prices WHERE insee_code IN (SELECT DISTINCT insee_code FROM prices ORDER BY insee_code LIMIT 50)
 OR insee_code IN ('13005', '22001')""")
def _(spark, sf):
    return T.sample_territories(view(spark, sf, "prices"), 50, ["13005", "22001"])


_SEGMENT = "SELECT DISTINCT insee_code FROM census WHERE population > 900"


@case("cap_codes_preferred", f"""SELECT insee_code FROM (SELECT DISTINCT insee_code FROM prices) WHERE insee_code IN ({_SEGMENT})
 ORDER BY insee_code LIMIT 20""")
def _(spark, sf):
    preferred = view(spark, sf, "census").where("population > 900")
    return T.cap_codes(view(spark, sf, "prices"), preferred, 20)


@case("filter_not_null_indicator", """SELECT year, insee_code, region_insee_code, population FROM census WHERE region_insee_code IS NOT NULL""")
def _(spark, sf):
    df = with_indicator(view(spark, sf, "census"), "region_insee_code")
    return df.select("year", "insee_code", "region_insee_code", "population")


_JOINED = """joined AS (SELECT p.year, p.insee_code, p.property_type, p.price_m2_avg, p.price_m2_median, p.mutation_count,
  c.population, c.department_insee_code, c.region_insee_code FROM prices p JOIN census c ON p.year = c.year AND p.insee_code = c.insee_code)"""
_ASOF = """joined AS (SELECT * FROM (SELECT p.year, p.insee_code, p.property_type, p.price_m2_avg, p.price_m2_median, p.mutation_count,
  c.population, c.department_insee_code, c.region_insee_code,
  row_number() OVER (PARTITION BY p.year, p.insee_code, p.property_type ORDER BY c.year DESC) AS rn
  FROM prices p JOIN census c ON c.year <= p.year AND p.insee_code = c.insee_code) WHERE rn = 1)"""


@case("join_fact_hierarchy", f"WITH {_JOINED} SELECT * FROM joined")
def _(spark, sf):
    return T.join_hierarchy(view(spark, sf, "prices"), view(spark, sf, "census"))


def _rollup_sql(level: str) -> str:
    return f"""SELECT year, '{level}' AS level, {level}_insee_code AS insee_code, property_type,
 {near_sql('sum(price_m2_avg * population) / sum(CASE WHEN price_m2_avg IS NOT NULL THEN population END)')} AS price_m2_avg,
 {near_sql('sum(price_m2_median * population) / sum(CASE WHEN price_m2_median IS NOT NULL THEN population END)')} AS price_m2_median,
 CAST(sum(mutation_count) AS DOUBLE) AS mutation_count FROM joined WHERE {level}_insee_code IS NOT NULL
 GROUP BY year, {level}_insee_code, property_type"""


def _rounded(df, digits=4):
    return df.withColumns({c: near(c, digits) for c in ("price_m2_avg", "price_m2_median")})


@case("agg_weighted_avg", f"""WITH {_JOINED} SELECT property_type, round(sum(price_m2_avg * population) / sum(population), 4) AS weighted,
 round(avg(price_m2_avg), 4) AS plain FROM joined GROUP BY property_type""")
def _(spark, sf):
    df = T.join_hierarchy(view(spark, sf, "prices"), view(spark, sf, "census"))
    return df.groupBy("property_type").agg(
        F.round(weighted_avg(F.col("price_m2_avg"), F.col("population")), 4).alias("weighted"),
        F.round(F.avg("price_m2_avg"), 4).alias("plain"),
    )


@case("rollup_department", f"WITH {_JOINED} {_rollup_sql('department')}")
def _(spark, sf):
    joined = T.join_hierarchy(view(spark, sf, "prices"), view(spark, sf, "census"))
    return _rounded(T.rollup_prices(joined, "department"))


@case("rollup_region", f"WITH {_JOINED} {_rollup_sql('region')}")
def _(spark, sf):
    joined = T.join_hierarchy(view(spark, sf, "prices"), view(spark, sf, "census"))
    return _rounded(T.rollup_prices(joined, "region"))


_HIERARCHY = f"""SELECT year, level, insee_code, property_type, {near_sql('price_m2_avg')} AS price_m2_avg, {near_sql('price_m2_median')} AS price_m2_median,
 CAST(mutation_count AS DOUBLE) AS mutation_count FROM prices UNION ALL {_rollup_sql('department')} UNION ALL {_rollup_sql('region')}"""


@case("rollup_hierarchy", f"WITH {_JOINED} {_HIERARCHY}")
def _(spark, sf):
    return _rounded(T.rollup_hierarchy(view(spark, sf, "prices"), view(spark, sf, "census"))).drop("source")


@case("rollup_hierarchy_asof", f"WITH {_ASOF} {_HIERARCHY}")
def _(spark, sf):
    df = T.rollup_hierarchy(view(spark, sf, "prices"), view(spark, sf, "census"), year_match="latest_leq")
    return _rounded(df).drop("source")


_PARENT_REGION = region_case("substr(insee_code, 1, 2)")


def _unweighted(level: str, code: str, source: str = "prices") -> str:
    return f"""SELECT year, '{level}' AS level, {code} AS insee_code, property_type, {near_sql('avg(price_m2_avg)')} AS price_m2_avg,
 {near_sql('quantile_cont(price_m2_median, 0.5)')} AS price_m2_median, CAST(sum(mutation_count) AS DOUBLE) AS mutation_count
 FROM {source} WHERE {code} IS NOT NULL GROUP BY year, {code}, property_type"""


@case("rollup_prices_unweighted", f"{_unweighted('department', 'substr(insee_code, 1, 2)')} UNION ALL {_unweighted('region', _PARENT_REGION)}")
def _(spark, sf):
    prices = stored(spark, sf, "prices")
    both = T.rollup_prices_unweighted(prices, "department").unionByName(T.rollup_prices_unweighted(prices, "region"))
    return _rounded(both)


_DIGIT = "CASE WHEN substr(insee_code, 1, 1) = '0' THEN substr(insee_code, 2, 1) ELSE substr(insee_code, 1, 1) END"


@case("rollup_prices_by_digit", _unweighted("region", _DIGIT))
def _(spark, sf):
    return _rounded(T.rollup_prices_unweighted(stored(spark, sf, "prices"), "region", region_rule="digit"))


@case("rollup_demographics", """SELECT year, 'department' AS level, substr(insee_code, 1, 2) AS insee_code, sum(population) AS population,
 round(avg(median_age), 4) AS median_age FROM census GROUP BY year, substr(insee_code, 1, 2)""")
def _(spark, sf):
    return T.rollup_demographics(view(spark, sf, "census"), "department").withColumn("median_age", F.round("median_age", 4))


@case("agg_population_weighted_age", """SELECT year, 'region' AS level, region_insee_code AS insee_code, sum(population) AS population,
 round(sum(population * median_age) / sum(population), 4) AS median_age FROM census WHERE region_insee_code IS NOT NULL
 GROUP BY year, region_insee_code""")
def _(spark, sf):
    df = T.population_weighted_age(view(spark, sf, "census"), "region_insee_code", "region")
    return df.withColumn("median_age", F.round("median_age", 4))


@case("agg_counts_by_level", """SELECT level AS name, count(*) AS n FROM prices GROUP BY level
 UNION ALL SELECT property_type, count(*) FROM prices GROUP BY property_type""")
def _(spark, sf):
    prices = view(spark, sf, "prices")
    by = lambda c: T.counts_by(prices, c).withColumnRenamed(c, "name")
    return by("level").union(by("property_type"))


@case("distinct_years_topn", "SELECT DISTINCT year FROM prices ORDER BY year DESC LIMIT 5")
def _(spark, sf):
    return T.latest_years(view(spark, sf, "prices"))


@case("latest_vintage", """SELECT coalesce(max(year), 2023) AS year FROM prices WHERE level = 'city' AND property_type = 'apartments'""")
def _(spark, sf):
    return T.latest_vintage(view(spark, sf, "prices"), "apartments")


@case("dataset_profile", """SELECT count(*) AS rows, count(*) FILTER (level = 'city') AS city_rows,
 count(DISTINCT CASE WHEN level = 'city' THEN insee_code END) AS city_codes FROM prices""")
def _(spark, sf):
    return T.dataset_profile(view(spark, sf, "prices"))


@case("raw_city_count", "SELECT count(DISTINCT code_geo) AS city_codes FROM wide_prices WHERE lower(echelle_geo) = 'commune'")
def _(spark, sf):
    return T.raw_city_count(view(spark, sf, "wide_prices"))


# Department rows are stored for the even years only; the others are rolled up.
_STORED = f"""stored AS ({FACTS} FROM prices UNION ALL SELECT year, 'department', substr(insee_code, 1, 2), property_type, max(price_m2_avg),
  max(price_m2_median), CAST(sum(mutation_count) AS BIGINT) FROM prices WHERE year % 2 = 0 GROUP BY year, substr(insee_code, 1, 2), property_type)"""


def stored_facts(spark, sf):
    prices = stored(spark, sf, "prices")
    parents = prices.where("year % 2 = 0").groupBy("year", F.substring("insee_code", 1, 2).alias("insee_code"), "property_type").agg(
        F.max("price_m2_avg").alias("price_m2_avg"), F.max("price_m2_median").alias("price_m2_median"),
        F.sum("mutation_count").alias("mutation_count"),
    )
    return keyed.union_frames(prices, parents.withColumn("level", F.lit("department")))


@case("prices_or_rollup", f"""WITH {_STORED}, odd AS (SELECT * FROM prices WHERE year % 2 <> 0)
 SELECT year, level, insee_code, property_type, {near_sql('price_m2_avg')} AS price_m2_avg, {near_sql('price_m2_median')} AS price_m2_median,
  CAST(mutation_count AS DOUBLE) AS mutation_count FROM stored WHERE level = 'department'
 UNION ALL {_unweighted('department', 'substr(insee_code, 1, 2)', 'odd')}""")
def _(spark, sf):
    return _rounded(T.prices_or_rollup(stored_facts(spark, sf), "department"))


@case("join_left_demographics", f"""SELECT p.year, p.insee_code, p.property_type, p.price_m2_avg, c.population, c.median_age
 FROM prices p LEFT JOIN (SELECT * FROM census WHERE year = 1998) c ON p.insee_code = c.insee_code WHERE p.year = 1998""")
def _(spark, sf):
    people = view(spark, sf, "census").where("year = 1998").select("insee_code", "population", "median_age")
    df = join_demographics(view(spark, sf, "prices").where("year = 1998"), people)
    return df.select("year", "insee_code", "property_type", "price_m2_avg", "population", "median_age")


@case("semi_join_codes", f"{FACTS} FROM prices WHERE insee_code IN ({_SEGMENT})")
def _(spark, sf):
    return keyed.semi_join_codes(view(spark, sf, "prices"), view(spark, sf, "census").where("population > 900"))


@case("union_by_name", """SELECT year, insee_code, price_m2_avg AS price, CAST(NULL AS DOUBLE) AS population FROM prices
 UNION ALL SELECT year, insee_code, CAST(NULL AS DOUBLE), population FROM census""")
def _(spark, sf):
    prices = view(spark, sf, "prices").select("insee_code", "year", F.col("price_m2_avg").alias("price"))
    return keyed.union_frames(prices, view(spark, sf, "census").select("year", "population", "insee_code"))


@case("union_distinct_codes", "SELECT insee_code FROM prices UNION SELECT insee_code FROM census UNION SELECT insee_code FROM reviews")
def _(spark, sf):
    code = lambda name: view(spark, sf, name).select("insee_code")
    return keyed.union_codes(code("prices"), code("census"), code("reviews"))


@case("intersect_codes", "SELECT insee_code FROM prices INTERSECT SELECT insee_code FROM reviews")
def _(spark, sf):
    code = lambda name: view(spark, sf, name).select("insee_code")
    return keyed.intersect_codes(code("prices"), code("reviews"))


