"""Cleaning cases from the reference's preprocessing tests, as small frames."""

import math

from pyspark.sql import functions as F

from plotwise.operators import clean
from plotwise.operators.windows import fill_district_max


def test_price_by_land_zero_and_negative(spark):
    df = spark.createDataFrame([(1000 * 100, 100, 1), (50000, 0, 2), (300000, 200, 3), (50000, -50, 4)],
                               "transaction_price bigint, land_m2 bigint, unit_level int")
    out = [r.price_m2 for r in clean.clean_price_m2(df).orderBy("unit_level").collect()]
    assert out[0] == 1000.0 and out[1] is None and out[2] == 1500.0
    assert out[3] == -1000.0  # negative land still divides
    assert all(v is None or not math.isinf(v) for v in out)


def test_price_tiny_land_is_finite(spark):
    df = spark.createDataFrame([(1e8, 0.0001)], "transaction_price double, land_m2 double")
    v = clean.clean_price_m2(df).first().price_m2
    assert v is not None and math.isfinite(v)


def test_price_null_land(spark):
    df = spark.createDataFrame([(1000.0, 100), (1000.0, None)], "transaction_price double, land_m2 bigint")
    vals = [r.price_m2 for r in clean.clean_price_m2(df).collect()]
    assert vals[0] == 10.0 and vals[1] is None


def test_negative_floors(spark):
    df = spark.createDataFrame([(-1,), (-5,), (0,), (10,), (25,), (None,)], "unit_level int")
    assert [r.unit_level for r in clean.clean_unit_level(df).collect()] == [0, 0, 0, 10, 25, None]


def test_fill_by_district_max(spark):
    df = spark.createDataFrame([("KL", 5.0), ("KL", None), ("PE", 3.0), ("PE", None), (None, None), ("XX", None)],
                               "district string, walk_dist_to_mall double")
    out = fill_district_max(df, ["walk_dist_to_mall"]).collect()
    got = sorted((r.district or "", r.walk_dist_to_mall) for r in out)
    assert got == [("", 21.0), ("KL", 5.0), ("KL", 5.0), ("PE", 3.0), ("PE", 3.0), ("XX", 21.0)]


def test_inverse_transform(spark):
    df = spark.createDataFrame([(math.log1p(100),), (math.log1p(1000),), (0.0,), (-10.0,)], "prediction_log double")
    vals = [r.prediction for r in clean.expm1_prediction(df).collect()]
    assert abs(vals[0] - 100) < 1e-9 and abs(vals[1] - 1000) < 1e-9 and vals[2] == 0 and vals[3] < 0


def test_clip_reference_semantics(spark):
    df = spark.createDataFrame([(0.5,), (-3.0,), (10.0,)], "prediction double")
    assert [r.prediction for r in clean.clip_prediction(df).collect()] == [1.0, 1.0, 10.0]
    df2 = spark.createDataFrame([(0.5,), (10.0,)], "prediction double")
    assert [r.prediction for r in clean.clip_prediction(df2).collect()] == [0.5, 10.0]


def test_standardise_and_freehold(spark):
    df = spark.createDataFrame([(" Freehold\t", "Freehold"), (None, "Leasehold")], "a string, tenure string")
    out = clean.standardise_strings(clean.flag_freehold(df)).collect()
    assert out[0].a == "freehold" and out[0].freehold == 1 and out[1].freehold == 0


def test_parse_coordinate(spark):
    df = spark.createDataFrame([("3.1, 101.5",), ("bad",), ("1, 2, 3",)], "coordinates string")
    out = clean.parse_coordinate(df).collect()
    assert (out[0].lat, out[0].lon, out[0].coord_parsed) == (3.1, 101.5, True)
    assert out[1].coord_parsed is False and out[2].lat is None


def test_np_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.5,)], "x double")
    out = [r.y for r in df.select(clean.np_round(F.col("x"), 2).alias("y")).collect()]
    assert out[0] == 0.12 and out[2] == 2.5
