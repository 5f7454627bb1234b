"""Summary and validation reports, feature guard, file loaders."""

import os
import tempfile

import pytest
from pyspark.ml.feature import VectorAssembler

from plotwise.operators import validate
from plotwise.sources import files


def test_data_summary(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "d", 4.0), (5, "e", 5.0)],
                               "col1 bigint, col2 string, col3 double")
    rows = {r.column: r for r in validate.data_summary(df).collect()}
    assert rows["col3"].null_count == 1 and rows["col1"].n_rows == 5 and rows["col1"].n_columns == 3


def test_range_and_coords(spark):
    df = spark.createDataFrame([(5.0, 3.0, 101.0), (20000.0, None, 150.0)], "property_m2 double, lat double, lon double")
    rep = {r.feature: r for r in validate.range_report(df).collect()}
    assert rep["property_m2"].n_above == 1 and rep["property_m2"].n_below == 1 and rep["property_m2"].total_features == 3
    c = validate.coords_report(df).first()
    assert (c.valid_coordinates, c.missing_coordinates, c.invalid_coordinates) == (1, 1, 0)


def _vec(spark, rows, n):
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(n)))
    return VectorAssembler(inputCols=[f"c{i}" for i in range(n)], outputCol="features", handleInvalid="keep").transform(df)


def test_feature_guard(spark):
    ok = _vec(spark, [tuple(float(j) for j in range(279))] * 3, 279)
    assert validate.feature_guard(ok, expected=279)["n_nan"] == 0
    bad = _vec(spark, [tuple(float("nan") if j == 100 else 1.0 for j in range(279))], 279)
    with pytest.raises(ValueError):
        validate.feature_guard(bad, expected=279)
    inf = _vec(spark, [tuple(float("inf") if j == 50 else 1.0 for j in range(279))], 279)
    with pytest.raises(ValueError):
        validate.feature_guard(inf, expected=279)
    small = _vec(spark, [tuple(1.0 for _ in range(100))], 100)
    with pytest.raises(ValueError):
        validate.feature_guard(small, expected=279)


def test_loaders(spark):
    d = tempfile.mkdtemp(prefix="plotwise-test-")
    p = os.path.join(d, "empty.csv")
    with open(p, "w") as fh:
        fh.write("col1,col2\n")
    assert files.load_raw(spark, p).count() == 0
    with pytest.raises(ValueError):
        files.load_raw(spark, os.path.join(d, "x.xyz"))
    with pytest.raises(FileNotFoundError):
        files.load_raw(spark, os.path.join(d, "missing.csv"))
    with pytest.raises(ValueError):
        files.stage_path(d, "nope")
