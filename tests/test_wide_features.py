"""Feature vectors of thousands of one-hot slots: read as stored, never as arrays of their length."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from plotwise.functions.vectors import length, slot
from plotwise.operators import models as md
from plotwise.operators import linear, trees
from plotwise.operators.validate import feature_guard


def test_guard_reads_entries_only(spark):
    n = 400_000_000         # as an array: 3.2 GB a row
    df = spark.createDataFrame([(Vectors.sparse(n, {0: 1.0, n - 1: 2.0}),)], ["features"])
    assert feature_guard(df, "features", n)["n_nan"] == 0
    odd = df.union(spark.createDataFrame([(Vectors.sparse(n, {5: float("nan")}),)], ["features"]))
    with pytest.raises(ValueError, match="1 NaN"):
        feature_guard(odd, "features", n)


def test_slots_and_length_of_both_kinds(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 0.0, 3.0]),), (Vectors.sparse(3, {2: 4.0}),)], ["features"])
    assert [tuple(r) for r in df.select(length("features"), slot("features", 0), slot("features", 2)).collect()] == [(3, 1.0, 3.0), (3, 0.0, 4.0)]


def test_bins_of_stored_entries_equal_dense_bins():
    rng = np.random.default_rng(3)
    x = np.zeros((200, 12))
    x[:, :2] = rng.normal(size=(200, 2))
    hot = rng.integers(0, 6, 200)
    x[np.flatnonzero(hot), 1 + hot[hot > 0]] = 1.0
    x[::7, 7:] = rng.integers(0, 2, (len(x[::7]), 5))
    columns = trees.Columns((0, 1), ((-0.5, 0.0, 0.5), (0.0,)), ((2, 7), (7, 12)))
    at = [None if i % 3 == 0 else np.flatnonzero(r) for i, r in enumerate(x)]
    values = [r if i is None else r[i] for i, r in zip(at, x)]
    assert (columns.bins_of(pd.Series(at), pd.Series(values)) == columns.bins(x)).all()


def test_chunks_of_wide_rows_hold_bins(spark):
    wide = 400_000_000
    df = spark.createDataFrame([(i, float(i), Vectors.sparse(wide, {0: i / 10, 1 + i % 3: 1.0})) for i in range(30)], ["records_id", "label", "features"])
    columns = trees.Columns((0,), ((0.55, 1.05),), ((1, 4),))
    ids, y, _, b = trees._together([r["rows"] for r in trees.chunked(df, columns, "records_id", "label").collect()])
    assert b[:, 1].tolist() == [1 + i % 3 for i in ids] and (b[:, 0] == np.searchsorted([0.55, 1.05], ids / 10)).all()


def test_linear_models_beyond_the_normal_solver(spark):
    """4,200 columns: the normal equations refuse them. Ridge and least squares are held to closed forms."""
    rng = np.random.default_rng(5)
    n, wide = 400, 4200
    x, hot = rng.normal(size=n), rng.integers(0, 3, n)
    y = 2 * x + hot + rng.normal(scale=0.1, size=n)
    rows = [(i, float(y[i]), Vectors.sparse(wide, {0: float(x[i]), 1 + int(hot[i]): 1.0})) for i in range(n)]
    df = spark.createDataFrame(rows, ["records_id", "label", "features"]).cache()
    z = np.column_stack([x, *[hot == k for k in range(3)]]).astype(float)
    zc, yc = z - z.mean(axis=0), y - y.mean()
    for name, alpha in (("Linear Regression", 0.0), ("Ridge", 1.0)):
        w = np.linalg.lstsq(zc.T @ zc + alpha * np.eye(4), zc.T @ yc, rcond=1e-10)[0]
        want = y.mean() + zc @ w
        got = md.make_regressor(name, df).fit(df).transform(df).orderBy("records_id").select(F.col("prediction_log")).toPandas()["prediction_log"]
        assert np.abs(got - want).max() < 1e-4


def _hot_rows(spark, wide, n=400):
    rng = np.random.default_rng(7)
    x, hot = rng.normal(size=n), rng.integers(0, 3, n)
    y = 2 * x + 1.5 * hot + rng.normal(scale=0.1, size=n)
    rows = [(i, i % 4, float(y[i]), Vectors.sparse(wide, {0: float(x[i]), 1 + int(hot[i]): 1.0})) for i in range(n)]
    return spark.createDataFrame(rows, ["records_id", "fold", "label", "features"]).cache()


def test_wide_lasso_is_fitted_on_the_columns_in_use(spark):
    """Equal to the lasso of the same rows with four columns; of 400,000,000 columns the solver sees four at most."""
    stages = md.fit_lasso(_hot_rows(spark, 400_000_000))
    wide = PipelineModel(stages=stages).transform(_hot_rows(spark, 400_000_000)).orderBy("records_id").toPandas()["prediction_log"]
    narrow = md.fit_lasso(_hot_rows(spark, 4))[0].transform(_hot_rows(spark, 4)).orderBy("records_id").toPandas()["prediction_log"]
    assert len(stages[0].getIndices()) <= 4 and np.abs(wide - narrow).max() < 1e-4


def test_wide_lasso_without_any_column_in_use(spark):
    assert not md.fit_lasso(_hot_rows(spark, 600), alpha=1e3)[-1].coefficients.toArray().any()


def test_folds_of_wide_rows_share_no_matrix(spark):
    df = _hot_rows(spark, 6)
    for name in ("Linear Regression", "Ridge", "Lasso"):
        want = linear.out_of_fold(df, [name]).toPandas().sort_values(["fold", "y"])
        got = md._fold_by_fold(name, df, 4).toPandas().sort_values(["fold", "y"])
        assert (want["fold"].to_numpy() == got["fold"].to_numpy()).all() and np.abs(want["p"].to_numpy() - got["p"].to_numpy()).max() < 1e-3


def test_nearest_neighbours_read_entries_only(spark):
    """Vectors of 300 million slots, sparse and dense alike: the neighbours of brute force, ties by id."""
    n = 300_000_000         # as an array: 2.4 GB a row
    rng = np.random.default_rng(5)
    rows = [(i, {0: float(rng.integers(0, 3)), 1: float(rng.integers(0, 3)), int(rng.integers(2, 40)) * 7_000_000: 1.0}, float(rng.normal())) for i in range(240)]
    df = spark.createDataFrame([(i, Vectors.sparse(n, e), y) for i, e, y in rows], ["records_id", "features", "label"])
    got = {r["records_id"]: r["prediction_log"] for r in md.KnnModel(PipelineModel(stages=[]), df.filter("records_id % 3 != 0"), "label").transform(df.filter("records_id % 3 = 0")).collect()}
    train = [r for r in rows if r[0] % 3]
    for i, e, _ in rows[::3]:
        d = sorted((sum((e.get(c, 0.0) - o.get(c, 0.0)) ** 2 for c in e.keys() | o.keys()), j, y) for j, o, y in train)
        assert got[i] == pytest.approx(np.mean([y for *_, y in d[:5]]), abs=1e-12)
