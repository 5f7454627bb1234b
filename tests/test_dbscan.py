"""DBSCAN against brute force: scattered, dense and adversarial layouts."""

import math

import numpy as np
import pytest

from plotwise.operators import cluster


def hav(a, b):
    k = math.pi / 180
    s = math.sin((b[0] - a[0]) * k / 2) ** 2 + math.cos(a[0] * k) * math.cos(b[0] * k) * math.sin((b[1] - a[1]) * k / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(s), math.sqrt(1 - s))


def brute(pts, eps, least):
    n = len(pts)
    nb = [[j for j in range(n) if hav(pts[i], pts[j]) <= eps] for i in range(n)]
    core = [len(x) >= least for x in nb]
    label = {}
    for i in range(n):
        if core[i] and i not in label:
            todo, label[i] = [i], i
            while todo:
                for j in nb[todo.pop()]:
                    if core[j] and j not in label:
                        label[j] = i
                        todo.append(j)
    out = []
    for i in range(n):
        out.append(label[i] if core[i] else min((label[j] for j in nb[i] if core[j]), default=None))
    order = {c: k for k, c in enumerate(sorted({c for c in out if c is not None}))}
    return [(order.get(c, -1), core[i]) for i, c in enumerate(out)]


def layouts():
    rng = np.random.default_rng(8)
    scattered = [(3 + y, 101 + x) for y, x in rng.uniform(0, 0.06, (150, 2))]
    blobs = [(3 + y, 101 + x) for y, x in np.concatenate([rng.normal(0, 0.002, (120, 2)), rng.normal(0.02, 0.002, (120, 2))])]
    # two clouds whose rims are just out of reach, or just in reach, of each other
    gap = lambda g: [(3 + y, 101 + x) for y, x in rng.uniform(0, 0.01, (90, 2))] + [(3 + y, 101.01 + g + x) for y, x in rng.uniform(0, 0.01, (90, 2))]
    north = [(60 + y, -101 + x) for y, x in rng.normal(0, 0.01, (150, 2))]
    return {"scattered": scattered, "blobs": blobs, "far rims": gap(0.0095), "near rims": gap(0.007), "north": north, "stacked": [(3.0, 101.0)] * 6 + [(3.2, 101.2)] * 2}


@pytest.mark.parametrize("name", list(layouts()))
def test_equals_brute_force(spark, name):
    pts = layouts()[name]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "road_id long, lat double, lon double")
    got = {r["road_id"]: (r["market_cluster"], r["is_core"]) for r in cluster.dbscan(df, 1.0).collect()}
    assert [got[i] for i in range(len(pts))] == brute(pts, 1.0, 5)


def test_pairs_stay_linear_in_a_dense_blob(spark, monkeypatch):
    """Ten times the points in the same place make about ten times the pairs, not a hundred times."""
    made, join = [], cluster.radius_join

    def counting(*args, **kw):
        out = join(*args, **kw).checkpoint()
        made.append(out.count())
        return out
    monkeypatch.setattr(cluster, "radius_join", counting)
    rng = np.random.default_rng(9)
    totals = []
    for n in (300, 3000):
        pts = rng.normal(0, 0.004, (n, 2))
        df = spark.createDataFrame([(i, float(3 + y), float(101 + x)) for i, (y, x) in enumerate(pts)], "road_id long, lat double, lon double")
        made.clear()
        cluster.dbscan(df, 1.0).count()
        totals.append(sum(made))
    assert totals[1] < 12 * totals[0]


def test_k_distance_in_a_dense_blob_with_outliers(spark):
    rng = np.random.default_rng(11)
    pts = [(3 + y, 101 + x) for y, x in np.concatenate([rng.normal(0, 0.0005, (400, 2)), rng.uniform(-0.5, 0.5, (20, 2))])]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "road_id long, lat double, lon double")
    got = {r["road_id"]: r["kdist_km"] for r in cluster.k_distance(df).collect()}
    for i in [*range(0, 400, 40), *range(400, 420)]:
        assert got[i] == pytest.approx(sorted(hav(pts[i], q) for q in pts)[4], rel=1e-9)
