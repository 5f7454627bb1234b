"""K-means of several restarts in one pass, against numpy."""

import numpy as np
import pytest

from plotwise.operators import cluster as cl
from plotwise.operators.kmeans import assign, fit_restarts

SCHEMA = "road_id long, lat double, lon double, cluster string"


def frame(spark, yx):
    rows = [(i, None if y is None else float(y), None if x is None else float(x), "x") for i, (y, x) in enumerate(yx)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def lloyd(yx, centres, tol):
    """Plain Lloyd from given centres."""
    for _ in range(300):
        at = ((yx[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([yx[at == j].mean(0) if (at == j).any() else c for j, c in enumerate(centres)])
        done = ((new - centres) ** 2).sum() <= tol
        centres = new
        if done:
            break
    return centres, ((yx[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(3)
    hubs = rng.uniform(0, 30, (6, 2))
    yx = np.vstack([h + rng.normal(0, 0.8, (60, 2)) for h in hubs])
    return np.vstack([yx, np.repeat(yx[:40], 3, axis=0)])       # some places several times


def test_restarts_rest_where_numpy_rests(spark, blobs):
    fits = fit_restarts(frame(spark, blobs), 6, seed=7, n_init=4)
    tol = 1e-4 * blobs.var(axis=0).mean()
    assert len(fits) == 4
    for f in fits:
        centres, cost = lloyd(blobs, f.centres, tol)
        assert f.cost == pytest.approx(((blobs[:, None] - f.centres[None]) ** 2).sum(2).min(1).sum(), rel=1e-9)
        assert cost <= f.cost * (1 + 1e-9) and f.cost <= cost * 1.02     # at rest: one more run gains next to nothing


def test_restarts_together_equal_each_alone(spark, blobs):
    df = frame(spark, blobs)
    together = fit_restarts(df, 5, seed=11, n_init=3)
    for r, f in enumerate(together):
        alone, = fit_restarts(df, 5, seed=11 + r, n_init=1)
        assert np.allclose(f.centres, alone.centres) and f.iterations == alone.iterations
    labels = {q.road_id: q.market_cluster for q in cl.kmeans(df, 5, seed=11, n_init=3).collect()}
    best = min(together, key=lambda f: f.cost)
    want = ((blobs[:, None] - best.centres[None]) ** 2).sum(2).argmin(1)
    assert [labels[i] for i in range(len(blobs))] == want.tolist()


def test_good_starts(spark, blobs):
    """Ten restarts reach the cost of numpy's best of many random starts."""
    rng = np.random.default_rng(0)
    best = min(lloyd(blobs, blobs[rng.choice(len(blobs), 6, replace=False)], 1e-9)[1] for _ in range(60))
    assert min(f.cost for f in fit_restarts(frame(spark, blobs), 6, n_init=10)) <= best * 1.01


def test_few_places_nulls_ties_and_empty(spark):
    nan = float("nan")
    df = frame(spark, [(1, 1), (1, 1), (2, 2), (None, 1), (nan, 2), (3, float("inf"))])
    fits = fit_restarts(df, 5, n_init=2)
    assert all(len(f.centres) == 2 and f.cost == 0 for f in fits)
    rows = {r.road_id: r for r in cl.kmeans(df, 5, n_init=2).collect()}
    assert rows[0].market_cluster == rows[1].market_cluster != rows[2].market_cluster
    assert all(rows[i].market_cluster == -1 and rows[i].is_noise for i in (3, 4, 5))
    assert fit_restarts(df.limit(0), 3) == [] and cl.kmeans(df.limit(0), 3).collect() == []
    tie = assign(frame(spark, [(0, 1)]), np.array([[0.0, 0.0], [0.0, 2.0]])).first()
    assert tie.cluster == 0
