import gzip
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir import schemas
from terroir.operators.keyed import merge_keyed
from terroir.session import materialize, scratch_path, shared_dir
from terroir.sources import files, jdbc, sinks


@pytest.mark.parametrize("text,sep", [("a;b;c,d\n1;2;3\n", ";"), ("a|b\n1|2\n", "|"), ("a\tb\n", "\t"), ("abc\n", ","), ("a,b\n", ",")])
def test_sniff(spark, tmp_path, text, sep):
    (tmp_path / "x.csv").write_text(text)
    assert files.sniff_delimiter(spark, str(tmp_path / "x.csv")) == sep


def test_csv_with_declared_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text('code;n;z\n"a;1";5;q\nb;bad;r\n')
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("missing", T.DoubleType())])
    rows = files.read_csv(spark, str(tmp_path / "x.csv"), schema).collect()
    assert [tuple(r) for r in rows] == [("a;1", 5, None), ("b", None, None)]


def test_reviews_gzip(spark, tmp_path):
    with gzip.open(tmp_path / "r.csv.gz", "wt", encoding="utf-8") as f:
        f.write('id,comments,date\n1,"été, ""bien""\nsuite",2020-01-02\n2,ok,\n')
    rows = files.read_reviews(spark, str(tmp_path / "r.csv.gz"), 3).orderBy("review_text").collect()
    assert [tuple(r) for r in rows] == [("ok", None), ('été, "bien"\nsuite', "2020-01-02")]


def test_json_array_with_integer_prices(spark, tmp_path):
    (tmp_path / "l.json").write_text('[{"id":"1","price":2850,"tags":["a"]},{"id":"2","price":1.5}]')
    rows = files.read_json_listings(spark, str(tmp_path / "l.json")).orderBy("id").collect()
    assert [(r.id, r.price, r.tags) for r in rows] == [("1", 2850.0, ["a"]), ("2", 1.5, None)]


def test_partitioned_write_and_pruned_scan(spark, tmp_path, capsys):
    df = spark.createDataFrame([(2020, "city", "01001"), (2020, "city", "01001"), (2021, "region", "84")], "year int, level string, insee_code string")
    with pytest.raises(ValueError):
        sinks.write_partitioned(df.drop("year"), str(tmp_path / "p"))
    sinks.write_partitioned(df, str(tmp_path / "p"))
    codes = files.read_codes(spark, str(tmp_path / "p"), df.schema, "city")
    assert [r.insee_code for r in codes.collect()] == ["01001"]
    codes.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(level" in plan and "ReadSchema: struct<insee_code:string>" in plan


def test_merge_keeps_fields_not_supplied(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    assert sorted(tuple(r) for r in merge_keyed(old, new, ["k"]).collect()) == [("a", 1, "x"), ("b", 9, "y"), ("c", 3, None)]


def test_versioned_upsert(spark, tmp_path):
    root = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    assert sinks.read_versioned(spark, root) is None
    sinks.upsert_keyed(frame(("a", 1), ("b", 1)), root, ["k"])
    (tmp_path / "t" / "v0000000099-broken").mkdir()
    out = sinks.upsert_keyed(frame(("b", 2)), root, ["k"])
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1), ("b", 2)]


def test_boundaries(spark, tmp_path):
    (tmp_path / "g.json").write_text(
        '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"code_insee":"1"},'
        '"geometry":{"type":"MultiPolygon","coordinates":[[[[1.23456789,2.0],[3.0,4.55555]]]]}},'
        '{"type":"Feature","properties":{"code_insee":"75"},"geometry":null}]}')
    properties = T.StructType([T.StructField("nom", T.StringType()), T.StructField("code_insee", T.StringType())])
    features = files.read_boundaries(spark, str(tmp_path / "g.json"), properties)
    kept = files.boundaries_of(features, spark.createDataFrame([("01",)], "insee_code string"), "department")
    assert files.compact_boundaries(kept).first().geometry.coordinates == [[[[1.2346, 2.0], [3.0, 4.5556]]]]
    assert files.code_property(["nom", "CodeX"]) == "CodeX" and files.code_property(["nom"]) == "nom" and files.code_property([]) is None


def test_decimals_become_doubles(spark):
    df = spark.createDataFrame([(1,)], "a int").withColumn("d", F.lit(1.5).cast("decimal(9,2)"))
    assert jdbc.decimals_to_double(df).dtypes == [("a", "int"), ("d", "double")]


def test_shared_folder_comes_from_the_session(spark):
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    named = SimpleNamespace(conf=Conf({"spark.checkpoint.dir": "/shared/run/"}))
    assert shared_dir(named) == "/shared/run" and scratch_path(named, "x").startswith("/shared/run/x-")
    assert shared_dir(spark) == shared_dir(spark)
    assert materialize(spark.range(3), "three").count() == 3


def test_listing_schema_is_declared():
    assert schemas.LISTING["price"].dataType == T.DoubleType() and schemas.LISTING["rooms"].dataType == T.IntegerType()


def test_merge_keyed_picks_one_new_row_by_content(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("a", 3), ("b", 4), ("b", 5)], "k string, v int")
    runs = {tuple(sorted(tuple(r) for r in merge_keyed(old, new.repartition(n), ["k"]).collect())) for n in (1, 3, 7)}
    assert len(runs) == 1 and len(next(iter(runs))) == 2
