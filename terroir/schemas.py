"""Explicit schemas; nothing in the library infers one."""

from pyspark.sql import types as T

_S, _D, _I, _L, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


LISTING = _struct(
    id=_S, title=_S, address=_S, price=_D, rooms=_I, surface=_D, floor=_S,
    tags=T.ArrayType(_S), score=_D, imageUrl=_S, lat=_D, lon=_D, source=_S, url=_S,
)

RAW_LISTING = _struct(
    url=_S, source=_S, scrapedAt=_S, title=_S, type=_S, price=_D, surface=_D, rooms=_D,
    bedrooms=_D, address=_S, city=_S, postalCode=_S, lat=_D, lon=_D, floor=_S,
    elevator=_B, parking=_B, cellar=_B, balcony=_B, terrace=_B, furnished=_B,
    dpe=_S, ges=_S, charges=_D, deposit=_D, fees=_D, photos=T.ArrayType(_S),
    description=_S, availableFrom=_S,
)

PRICE_FACT = _struct(
    year=_I, level=_S, insee_code=_S, property_type=_S, price_m2_avg=_D,
    price_m2_median=_D, mutation_count=_L, source=_S,
)

DEMOGRAPHIC_FACT = _struct(
    year=_I, level=_S, insee_code=_S, department_insee_code=_S, region_insee_code=_S,
    population=_D, median_age=_D, source=_S,
)

TERM = _struct(term=_S, freq=_L)

SENTIMENT_DOC = _struct(
    level=_S, insee_code=_S, city_name=_S, year=_I, language=_S, sentiment_avg=_D,
    sentiment_count=_L, top_terms=T.ArrayType(TERM), source=_S, nlp_mode=_S,
    updated_at=T.TimestampType(),
)

CRAWL_EVENT = _struct(event=_S, timestamp=_S, searchUrl=_S, listingUrl=_S)
RAW_EVENT = _struct(event=_S, timestamp=_S, source=_S, payload=RAW_LISTING)
LISTING_EVENT = _struct(event=_S, timestamp=_S, source=_S, count=_L, listing=LISTING)
INGESTION_EVENT = _struct(
    event=_S, project=_S, timestamp_utc=_S, dvf_sample_cities=_L, scale=_S,
    paths=_struct(dvf_parquet=_S, insee_parquet=_S),
    metrics=_struct(dvf_rows=_L, insee_rows=_L),
)


def wide_price_schema() -> T.StructType:
    """Wide price statistics: every measure is read as text and cast with ``try_cast``."""
    from .functions.constants import PROPERTY_TYPES

    names = ["code_geo", "libelle_geo", "code_parent", "echelle_geo"]
    for suffix in PROPERTY_TYPES.values():
        names += [f"{measure}_whole_{suffix}" for measure in ("nb_ventes", "moy_prix_m2", "med_prix_m2")]
    return T.StructType([T.StructField(name, _S) for name in names])


def boundary_schema(properties: T.StructType) -> T.StructType:
    """GeoJSON FeatureCollection with multi-polygon coordinates."""
    ring = T.ArrayType(T.ArrayType(_D))
    geometry = _struct(type=_S, coordinates=T.ArrayType(T.ArrayType(ring)))
    feature = _struct(type=_S, properties=properties, geometry=geometry)
    return _struct(type=_S, features=T.ArrayType(feature))
