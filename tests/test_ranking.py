import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terroir.operators import ranking as R


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    n = 5000
    value = np.where(rng.random(n) < 0.34, 7.0, np.round(rng.normal(10, 5, n), 2))
    value[rng.random(n) < 0.05] = np.nan
    return pd.DataFrame({"id": np.arange(n), "g": rng.choice(["hot", "hot", "hot", "a", "b"], n), "v": value})


def spark_frame(spark, frame):
    return spark.createDataFrame(frame).withColumn("v", F.when(~F.isnan("v"), F.col("v")))


def test_median_is_exact(spark, frame):
    got = {r.g: r.m for r in R.median_by(spark_frame(spark, frame), ["g"], "v", "m").collect()}
    assert got == pytest.approx(frame.groupby("g").v.median().to_dict())
    assert R.median_by(spark_frame(spark, frame), [], "v", "m").first().m == pytest.approx(frame.v.median())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7])
def test_median_of_few(spark, n):
    df = spark.createDataFrame([(float(i * i),) for i in range(n)], "v double")
    assert R.median_by(df, [], "v", "m").first().m == np.median([i * i for i in range(n)])


@pytest.mark.parametrize("higher", [True, False])
def test_percentile_score(spark, frame, higher):
    got = {r.id: r.s for r in R.percentile_score(spark_frame(spark, frame), "v", "s", higher, 50.0).collect()}
    known = np.sort(frame.v.dropna().to_numpy())
    share = (np.searchsorted(known, frame.v, "right") if higher else len(known) - np.searchsorted(known, frame.v, "left")) / len(known)
    want = np.where(frame.v.isna(), 50.0, share * 100)
    assert len(got) == len(frame)
    assert [got[i] for i in frame.id] == pytest.approx(list(want))


def test_smallest_by_hash(spark):
    df = spark.range(3000)
    kept = [r.id for r in R.smallest_by_hash(df, "id", 777, 42).collect()]
    order = [r.id for r in df.orderBy(F.md5(F.concat_ws(":", F.lit("42"), F.col("id").cast("string")))).limit(777).collect()]
    assert sorted(kept) == sorted(order)
    assert R.smallest_by_hash(df, "id", 5000, 42).count() == 3000


def test_spread_join_keeps_null_rows(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "k string, x int")
    right = spark.createDataFrame([("a", 9)], "k string, y int")
    assert sorted((r.x, r.y) for r in R.spread_left_join(left, right, "k").collect()) == [(1, None), (2, 9), (3, None)]
