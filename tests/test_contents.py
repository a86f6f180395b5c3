"""A check whose columns hold one value only proves little: every SQL result has to vary."""

import duckdb
import pytest

from suite import all_cases
from suite.base import TABLES

# Columns that are the same in every row by the meaning of the query.
CONSTANT = {
    "scan_json_array": {"tags"}, "scan_geojson": {"points"}, "sink_kafka_json": {"event", "origin"}, "market_to_listings": {"source", "tags"},
    "sink_similar_index": {"listing_count"}, "sentiment_catalog": {"documents"}, "paginate": {"total"}, "page_site_readers": {"ges", "postalCode"},
    "listing_normalize": {"score"}, "sentiment_doc": {"language", "level", "nlp_mode", "source"},
    # One level, year or type is what these ask for.
    "unpivot_property_types": {"year"}, "filter_fact_slice": {"level", "property_type", "year"}, "join_left_demographics": {"year"},
    **{name: {"level"} for name in ("filter_code_prefixes", "sample_territories", "rollup_department", "rollup_region", "rollup_prices_by_digit",
                                    "rollup_demographics", "agg_population_weighted_age", "prices_or_rollup", "semi_join_codes")},
    "page_extract_layers": {"has_state", "has_jsonld"},
    "stream_ingestion_event": {"event", "scale", "dvf_rows", "insee_rows"},
}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.01/{table}.parquet'")
    return con


def flat_columns(con, sql):
    frame = con.execute(sql).df()
    if len(frame) < 20:
        return set()
    return {c for c in frame.columns if frame[c].astype(str).nunique(dropna=False) < 2}


def test_columns_vary(con):
    found = {name: flat_columns(con, case.sql) - CONSTANT.get(name, set()) for name, case in all_cases().items() if case.sql}
    assert {name: sorted(flat) for name, flat in found.items() if flat} == {}
