"""Registry and stand-in views.

The views are SQL text that Spark and DuckDB both run, so both sides of a check
start from the same listings, prices, population and reviews. They read the
whole tables; nothing is sampled.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.functions import constants as K
from terroir.session import materialize

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    run: Query
    sql: str | None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in CASES:
            raise ValueError(f"duplicate query {name}")
        CASES[name] = Case(run, None if sql is None else with_views(sql))
        return run

    return register


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_REGION = "CASE {dep} " + " ".join(f"WHEN '{d}' THEN '{r}'" for d, r in K.DEPARTMENT_TO_REGION.items()) + " END"


def region_case(dep: str) -> str:
    return _REGION.format(dep=dep)


_CODE = "lpad(CAST((c_nationkey + 1) * 1000 + c_custkey % 20 AS STRING), 5, '0')"

def near_sql(value: str, digits: int = 4) -> str:
    """Rounding that two engines agree on: the cut is not at a half, where exact decimals lie."""
    return f"floor(({value}) * {10 ** digits} + 0.437) / {10 ** digits}"


def near(value: Column | str, digits: int = 4) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value * 10 ** digits + 0.437) / 10 ** digits


VIEWS: dict[str, str] = {
    # A third of all listings lie in one city.
    "listings": """
SELECT lpad(CAST(p_partkey AS STRING), 10, '0') AS id, p_name AS title,
  concat(CAST(75000 + p_partkey % 20 AS STRING), ' · ', p_type, ', ',
    CASE WHEN p_partkey % 3 = 0 THEN 'Paris' WHEN p_brand = 'Brand#1' THEN 'Lyon 3e'
         WHEN p_brand = 'Brand#2' THEN 'Mérignac' WHEN p_brand = 'Brand#3' THEN 'Saint-Malo' ELSE p_brand END) AS address,
  CAST(600 + (p_partkey * 37) % 1900 + p_retailprice / 10 AS DOUBLE) AS price,
  CAST(1 + p_size % 6 AS INT) AS rooms, CAST(9 + p_size * 5 / 2 AS DOUBLE) AS surface,
  CAST(43 + (p_partkey % 31) / 200 AS DOUBLE) AS lat, CAST(-1 + (p_partkey % 29) / 200 AS DOUBLE) AS lon,
  CASE p_type WHEN 'PROMO' THEN 'SeLoger' WHEN 'SMALL' THEN 'leboncoin' ELSE lower(p_type) END AS source,
  concat('https://www.example.com/annonces/', CAST(p_partkey AS STRING)) AS url
FROM part""",
    "raw_listings": """
SELECT concat('https://www.example.com/annonces/', CAST(p_partkey AS STRING), '?é=', p_name) AS url,
  CASE p_size % 6 WHEN 0 THEN 'www.SeLoger.com' WHEN 1 THEN 'LBC annonces' WHEN 2 THEN 'Bien''Ici'
       WHEN 3 THEN 'Mon Agence 42 !' WHEN 4 THEN '' ELSE '***' END AS source,
  CASE WHEN p_partkey % 7 = 0 THEN '  ' ELSE concat(' ', p_name, ' ') END AS title,
  CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN 0 ELSE p_retailprice END AS price,
  CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS surface,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(1 + p_size % 5 AS DOUBLE) END AS rooms,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_size % 4 AS DOUBLE) END AS bedrooms,
  CASE WHEN p_partkey % 4 = 0 THEN concat(' ', p_brand, ', Paris ') WHEN p_partkey % 4 = 1 THEN '' END AS address,
  CASE p_partkey % 11 WHEN 0 THEN 'Paris' WHEN 1 THEN 'LYON' WHEN 2 THEN 'Mérignac' WHEN 3 THEN 'Saint-Malo'
       WHEN 4 THEN 'Marseille 13e' WHEN 5 THEN 'VilleInconnue' WHEN 6 THEN 'Lil' WHEN 7 THEN 'Straßbourg'
       WHEN 8 THEN '' WHEN 9 THEN 'Évry' END AS city,
  CASE p_partkey % 13 WHEN 0 THEN '28185' WHEN 1 THEN '75056' WHEN 2 THEN '97105' WHEN 3 THEN '2A004' WHEN 4 THEN '69'
       WHEN 5 THEN '3' WHEN 6 THEN '33700' WHEN 7 THEN '98412' WHEN 8 THEN '20001'
       ELSE lpad(CAST(p_partkey % 95000 AS STRING), 5, '0') END AS postalCode,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(43 + p_partkey % 50 / 10 AS DOUBLE) END AS lat,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey % 60 / 10 - 1 AS DOUBLE) END AS lon,
  CASE WHEN p_size % 3 = 0 THEN ' 3e ét. ' WHEN p_size % 3 = 1 THEN ' ' END AS floor,
  p_partkey % 2 = 0 AS furnished, CASE WHEN p_partkey % 3 > 0 THEN p_partkey % 3 = 1 END AS balcony,
  p_size % 2 = 0 AS terrace, p_size % 5 = 0 AS parking, p_size % 7 = 0 AS elevator,
  CASE WHEN p_size % 4 > 0 THEN substr('ABCDEFG', CAST(1 + p_partkey % 7 AS INT), 1) END AS dpe,
  CASE WHEN p_size % 3 > 0 THEN substr('ABCDEFG', CAST(1 + p_size % 7 AS INT), 1) END AS ges,
  CASE WHEN p_partkey % 2 = 0 THEN concat('https://img.example.com/', CAST(p_partkey AS STRING)) END AS photo,
  CAST(p_size % 9 * 10 AS DOUBLE) AS charges
FROM part""",
    "prices": f"""
SELECT CAST(year(o_orderdate) AS INT) AS year, 'city' AS level, {_CODE} AS insee_code,
  CASE l_returnflag WHEN 'A' THEN 'apartments' WHEN 'N' THEN 'houses' ELSE 'commercial' END AS property_type,
  {near_sql("avg(l_extendedprice / l_quantity)", 3)} AS price_m2_avg,
  {near_sql("(min(l_extendedprice / l_quantity) + max(l_extendedprice / l_quantity)) / 2", 3)} AS price_m2_median,
  CAST(count(*) AS BIGINT) AS mutation_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY CAST(year(o_orderdate) AS INT), {_CODE},
  CASE l_returnflag WHEN 'A' THEN 'apartments' WHEN 'N' THEN 'houses' ELSE 'commercial' END""",
    "census": f"""
SELECT CAST(1995 + 3 * (c_custkey % 3) AS INT) AS year, 'city' AS level, {_CODE} AS insee_code,
  CAST(sum(100 + c_custkey % 900) AS DOUBLE) AS population, {near_sql("avg(25 + c_custkey % 50)", 3)} AS median_age,
  substr({_CODE}, 1, 2) AS department_insee_code,
  {region_case(f"substr({_CODE}, 1, 2)")} AS region_insee_code
FROM customer GROUP BY CAST(1995 + 3 * (c_custkey % 3) AS INT), {_CODE}""",
    "wide_prices": """
SELECT CASE WHEN CAST(substr(insee_code, 4, 2) AS INT) % 7 = 0 THEN concat(insee_code, '000AT')
            WHEN substr(insee_code, 1, 1) = '0' THEN substr(insee_code, 2) ELSE concat(' ', insee_code) END AS code_geo,
  concat('Commune, ', insee_code) AS libelle_geo, substr(insee_code, 1, 2) AS code_parent,
  CASE CAST(substr(insee_code, 4, 2) AS INT) % 10 WHEN 0 THEN 'section' WHEN 1 THEN ' Département '
       WHEN 2 THEN 'région' ELSE 'commune' END AS echelle_geo,
  CAST(CAST(sum(CASE WHEN property_type = 'apartments' THEN mutation_count END) AS BIGINT) AS STRING) AS nb_ventes_whole_appartement,
  CAST(max(CASE WHEN property_type = 'apartments' THEN price_m2_avg END) AS STRING) AS moy_prix_m2_whole_appartement,
  CAST(max(CASE WHEN property_type = 'apartments' THEN price_m2_median END) AS STRING) AS med_prix_m2_whole_appartement,
  CAST(CAST(sum(CASE WHEN property_type = 'houses' THEN mutation_count END) AS BIGINT) AS STRING) AS nb_ventes_whole_maison,
  CASE WHEN CAST(insee_code AS INT) % 3 = 0 THEN 'n/a'
       ELSE CAST(max(CASE WHEN property_type = 'houses' THEN price_m2_avg END) AS STRING) END AS moy_prix_m2_whole_maison,
  CASE WHEN CAST(insee_code AS INT) % 6 = 0 THEN ''
       ELSE CAST(max(CASE WHEN property_type = 'houses' THEN price_m2_median END) AS STRING) END AS med_prix_m2_whole_maison
FROM prices GROUP BY insee_code""",
    "wide_population": f"""
SELECT {_CODE} AS CODGEO, substr({_CODE}, 1, 2) AS DEP,
  CAST(CAST(sum(10 + c_custkey % 90) AS BIGINT) AS STRING) AS P09_POP,
  CASE WHEN max(c_custkey) % 5 = 0 THEN 'NA' ELSE CAST(CAST(sum(20 + c_custkey % 90) AS BIGINT) AS STRING) END AS P14_POP,
  CAST(CAST(sum(c_custkey % 7) AS BIGINT) AS STRING) AS P14_POP0014,
  CASE WHEN max(c_custkey) % 3 = 0 THEN 'x' ELSE CAST(CAST(sum(c_custkey % 11) AS BIGINT) AS STRING) END AS P14_POP1529,
  CAST(CAST(sum(c_custkey % 13) AS BIGINT) AS STRING) AS P14_POP3044,
  CAST(CAST(sum(c_custkey % 5) AS BIGINT) AS STRING) AS P14_POP90P
FROM customer GROUP BY {_CODE}""",
    "reviews": """
SELECT doc_id, text AS review_text, lang, source AS city_name, CAST(2009 + doc_id % 5 AS INT) AS year,
  lpad(CAST(1000 * (1 + CAST(substr(source, 4) AS INT)) AS STRING), 5, '0') AS insee_code
FROM documents""",
}


def with_views(sql: str) -> str:
    """The SQL with the views it needs as common table expressions."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ", ".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {ctes}, {text[5:]}"
    return f"WITH {ctes} {text}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # The given text tables are one row group each, which is one task; whoever measures may ask for more.
    spread = spark.conf.get("terroir.suite.spread", "")
    return df.repartition(int(spread)) if spread and name in ("documents", "pages") else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in view on the tables of ``sf_dir``."""
    sql = with_views(f"SELECT * FROM {name}")
    for base in TABLES:
        if re.search(rf"\b{base}\b", sql):
            table(spark, sf_dir, base).createOrReplaceTempView(base)
    return spark.sql(sql)


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view written to the shared folder first, for operators that read a fact table more than once."""
    return materialize(view(spark, sf_dir, name), name)


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw listings with their photo as a list, in the declared schema."""
    from terroir.operators.listings import complete_raw

    df = view(spark, sf_dir, "raw_listings")
    photos = F.when(F.col("photo").isNotNull(), F.array("photo"))
    return complete_raw(df.withColumn("photos", photos))
