import pytest
from pyspark.sql import functions as F

from terroir.functions import codes as C
from terroir.operators import scoring as S
from terroir.operators import territory as T


def values(df, column):
    return [r[0] for r in df.select(column.alias("x")).collect()]


def test_levels_and_codes(spark):
    df = spark.createDataFrame(
        [("commune", "1004"), ("commune", "01004000AT"), ("Département", "1"), ("région", "2"), ("section", "1"), ("commune", "2A004"),
         ("commune", " nan "), ("departement", "97105"), ("commune", "123456")], "echelle_geo string, code_geo string")
    level = C.map_level(F.col("echelle_geo"))
    assert values(df, level) == ["city", "city", "department", "region", None, "city", "city", "department", "city"]
    code = C.normalize_geo_code(F.col("code_geo"), F.coalesce(level, F.lit("")))
    assert values(df, code) == ["01004", "01004", "01", "02", "1", "2A004", None, "97105", "123456"]
    assert T.normalize_territories(df).count() == 7
    assert T.normalize_territories(df, keep_unknown_as_city=True).where("level = 'city'").count() == 5


def test_departments_and_regions(spark):
    df = spark.createDataFrame([("28185",), ("75056",), ("97105",), ("2a004",), ("98412",), ("01",), ("20001",)], "c string")
    assert values(df, C.department_from_commune(F.col("c"))) == ["28", "75", "971", "2A", "98", "01", "20"]
    assert values(df, C.department_from_insee(F.col("c"))) == ["28", "75", "971", "2a", "984", "01", "20"]
    department = C.department_from_commune(F.col("c"))
    assert values(df, C.region_from_department(department)) == ["24", "11", None, "94", None, "84", None]
    assert values(df, C.region_from_digit(department)) == ["2", "7", "971", "2", "9", "1", "2"]


def test_years(spark):
    df = spark.createDataFrame([("2018",), ("2018-S1",), ("semestre 1999",), ("3000",), ("x",), (" ",)], "v string")
    assert values(df, C.extract_year(F.col("v"))) == [2018, 2018, 1999, 3000, None, None]


def test_unpivot_drops_rows_without_prices(spark):
    wide = spark.createDataFrame(
        [("city", "01004", "3", "10.5", "x"), ("city", "01005", "4", None, "bad")],
        "level string, insee_code string, nb_ventes_whole_maison string, moy_prix_m2_whole_maison string, med_prix_m2_whole_maison string")
    rows = T.unpivot_property_types(wide, 2022).collect()
    assert [(r.year, r.insee_code, r.property_type, r.price_m2_avg, r.price_m2_median, r.mutation_count) for r in rows] == [
        (2022, "01004", "houses", 10.5, None, 3)]
    with pytest.raises(ValueError):
        T.unpivot_property_types(wide.select("level", "insee_code"))


def test_age_bins_skip_nulls(spark):
    df = spark.createDataFrame([("10", None, "0"), ("x", "0", None), ("1", "3", "0")], "P20_POP0014 string, P20_POP1529 string, P20_POP90P string")
    assert values(df, T.age_bin_mean("P20", df.columns)) == [7.0, None, (7 + 66) / 4]


PRICES = [(2020, "city", "01001", "houses", 10.0, 20.0, 1), (2020, "city", "01002", "houses", None, 40.0, 2), (2020, "city", "75056", "houses", 99.0, 99.0, 5)]
PRICE_SCHEMA = "year int, level string, insee_code string, property_type string, price_m2_avg double, price_m2_median double, mutation_count bigint"
PEOPLE = [(2020, "city", "01001", 1.0, 30.0, "01", "84"), (2020, "city", "01002", 3.0, 50.0, "01", "84"), (2020, "city", "75056", 7.0, 40.0, None, None)]
PEOPLE_SCHEMA = "year int, level string, insee_code string, population double, median_age double, department_insee_code string, region_insee_code string"


def test_rollup_null_weights(spark):
    prices, people = spark.createDataFrame(PRICES, PRICE_SCHEMA), spark.createDataFrame(PEOPLE, PEOPLE_SCHEMA)
    joined = T.join_hierarchy(prices, people)
    (safe,), (plain,) = T.rollup_prices(joined, "department").collect(), T.rollup_prices(joined, "department", null_safe=False).collect()
    assert (safe.price_m2_avg, safe.price_m2_median, safe.mutation_count) == (10.0, 35.0, 3.0)
    assert plain.price_m2_avg == 2.5
    assert T.rollup_hierarchy(prices, people).groupBy("level").count().count() == 3


def test_latest_census_not_after(spark):
    prices = spark.createDataFrame([(y, "city", "01001", "houses", 1.0, 1.0, 1) for y in (2008, 2012, 2014, 2023)], PRICE_SCHEMA)
    people = spark.createDataFrame([(y, "city", "01001", float(y), 1.0, "01", "84") for y in (2009, 2014, 2020)], PEOPLE_SCHEMA)
    rows = T.join_hierarchy(prices, people, "latest_leq").select("year", "population").collect()
    assert sorted((r.year, r.population) for r in rows) == [(2012, 2009.0), (2014, 2014.0), (2023, 2020.0)]


def test_sampling_and_caps(spark):
    df = spark.createDataFrame([("city", f"{i:05d}") for i in range(9)] + [("region", "84")], "level string, insee_code string")
    assert sorted(r.insee_code for r in T.sample_territories(df, 2, ["00007", "00001"]).collect()) == ["00000", "00001", "00007"]
    assert T.sample_territories(df, 0).count() == 10
    codes, liked = df.where("level = 'city'"), spark.createDataFrame([("00005",), ("00003",), ("x",)], "insee_code string")
    nobody = spark.createDataFrame([("x",)], "insee_code string")
    cap = lambda preferred, n: [r.insee_code for r in T.cap_codes(codes, preferred, n).collect()]
    assert cap(liked, 4) == ["00003", "00005"] and cap(liked, 1) == ["00003"]
    assert cap(nobody, 3) == ["00000", "00001", "00002"] and len(cap(liked, 9)) == 9 and len(cap(liked, 0)) == 9


def test_prefix_filter(spark):
    df = spark.createDataFrame([("69001",), ("01004",), ("33063",)], "insee_code string")
    assert T.code_prefixes(df, T.parse_prefixes(" 69 , 01")).count() == 2
    assert T.code_prefixes(df, T.parse_prefixes(" , ")).count() == 3


def test_scores_neutral_and_half_even(spark):
    df = spark.createDataFrame([("a", 10.0, 8.0, 1000.0, 5.0), ("b", 20.0, None, None, 0.25)],
                               "insee_code string, price_m2_avg double, price_m2_median double, population double, mutation_count double")
    live = {r.insee_code: r for r in S.where_to_live(df).collect()}
    assert (live["a"].score_prix, live["b"].score_prix, live["b"].score_dynamisme, live["a"].score_ressenti) == (100.0, 50.0, 50.0, 50.0)
    rows = {r.insee_code: r for r in S.add_liquidity(df).collect()}
    assert (rows["a"].indice_liquidite, rows["b"].indice_liquidite, rows["b"].prix_vs_mediane_nationale) == (100.0, 5.0, None)
    quiet = {r.insee_code: r.score_famille_calme for r in S.quiet_family(df).collect()}
    assert quiet == {"a": 37.5, "b": 45.0}
