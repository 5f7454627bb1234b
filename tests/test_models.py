"""Exact kNN, its saving and loading, and the split hash."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from plotwise.operators import evaluate, features, models


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, rng.integers(0, 4, 3)), float(rng.normal())) for i in range(400)]
    df = spark.createDataFrame(rows, "records_id long, a double, b double, c double, label double")
    return rows, df, PipelineModel(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")])


def brute(rows, queries, k=5):
    out = {}
    for q in queries:
        d = sorted((sum((x - y) ** 2 for x, y in zip(q[1:4], t[1:4])), t[0], t[4]) for t in rows)
        out[q[0]] = np.mean([y for _, _, y in d[:k]])
    return out


@pytest.mark.parametrize("block", [7, 2000])
def test_knn_equals_brute_force_with_ties(frames, monkeypatch, block):
    monkeypatch.setattr(models, "KNN_BLOCK_ROWS", block if block > 50 else 60)
    rows, df, prep = frames
    train, queries = [r for r in rows if r[0] % 4], [r for r in rows if r[0] % 4 == 0]
    m = models.KnnModel(prep, prep.transform(df.filter("records_id % 4 != 0")), "label")
    got = {r["records_id"]: r["prediction_log"] for r in m.transform(df.filter("records_id % 4 = 0")).collect()}
    want = brute(train, queries)
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-12) for i in got)


def test_knn_shuffles_queries_once_a_shelf(spark, frames, monkeypatch):
    """Blocks of 20 rows, 15 of training rows: on shelves of up to 4 a query is sent 4 times, not 15, and the results stay exact."""
    monkeypatch.setattr(models, "KNN_BLOCK_ROWS", 20)
    monkeypatch.setattr(models, "KNN_SHELF", 4)
    monkeypatch.setattr(models, "KNN_KEYS", 1)
    rows, df, prep = frames
    train, queries = [r for r in rows if r[0] % 4], [r for r in rows if r[0] % 4 == 0]
    met = []
    taken = models.F.sequence
    monkeypatch.setattr(models.F, "sequence", lambda a, b: (met.append(b), taken(a, b))[1])
    got = {r["records_id"]: r["prediction_log"] for r in models.KnnModel(prep, prep.transform(df.filter("records_id % 4 != 0")), "label").transform(df.filter("records_id % 4 = 0")).collect()}
    want = brute(train, queries)
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-12) for i in got)
    assert [spark.range(1).select(c).first()[0] + 1 for c in met] == [4, 2]


def test_knn_is_saved_and_loaded(spark, frames, tmp_path):
    rows, df, prep = frames
    m = models.KnnModel(prep, prep.transform(df), "label", k=3)
    models.save_model(m, str(tmp_path / "m"), {"model_name": "knn"}, spark)
    again, meta = models.load_model(str(tmp_path / "m"), spark)
    a, b = (sorted((r["records_id"], r["prediction_log"]) for r in x.transform(df).collect()) for x in (m, again))
    assert a == b and meta["model_name"] == "knn"


def test_split_hash_is_even(spark):
    part = spark.range(20000).select(features.hash_fraction("id").alias("h")).agg(F.avg((F.col("h") < 300).cast("int"))).first()[0]
    assert abs(part - 0.3) < 0.02


def test_tolerance_of_all_zero_actuals_raises(spark):
    with pytest.raises(ValueError):
        evaluate.within_tolerance(spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y double, p double"))


def test_ols_equals_the_normal_equations(spark, frames):
    rows, df, prep = frames
    m = models.fit("Linear Regression", prep, df)
    got = {r["records_id"]: r["prediction"] for r in models.predict(m, df, log_space=True).withColumnRenamed("prediction_log", "prediction").collect()}
    x = np.array([[1, *r[1:4]] for r in rows])
    beta = np.linalg.lstsq(x, np.array([r[4] for r in rows]), rcond=None)[0]
    assert all(got[r[0]] == pytest.approx(float(x[i] @ beta), abs=1e-6) for i, r in enumerate(rows))

