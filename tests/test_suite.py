"""The driver contract, and a few registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from suite import all_cases
from suite.base import TABLES
from suite.check import _rows

QUICK = ("filter_listings", "latest_per_key", "sample_territories", "rollup_hierarchy", "sentiment_by_year", "scan_geojson", "stream_dedupe")


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) >= 100


def test_entry(spark):
    assert entry.entry(spark).columns == ["base_id", "rank", "similar_id", "score"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    case = all_cases()[name]
    df = case.run(spark, sf)
    cursor = con.execute(case.sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, cursor.fetchall())


def test_stream_files_grow_with_the_table(spark):
    from suite import streams

    for parts in (4, 40):
        path, per_batch = streams._stored(spark, spark.range(2000).repartition(parts), "files", 3)
        files = spark.read.parquet(path).inputFiles()
        assert per_batch >= max(parts, 8) and len(files) == 3 * per_batch
        assert spark.read.parquet(path).count() == 2000
