import random

import numpy as np

from plotwise.operators.quantiles import exact_percentiles


def test_exact_percentiles_hot_group_with_ties(spark):
    random.seed(3)
    rows = [("hot", float(random.randint(0, 20))) for _ in range(5000)]
    rows += [(f"g{i % 7}", random.random()) for i in range(700)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    qs = [0.5, 0.1, 0.95]
    got = {r.g: (r.p0, r.p1, r.p2) for r in exact_percentiles(df, "v", qs, ["g"], limit=200, accuracy=1000).collect()}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    for g, vs in groups.items():
        vs = [x for x in vs if x is not None]
        want = tuple(float(np.percentile(vs, q * 100)) for q in qs) if vs else (None, None, None)
        assert got[g] == want or all(abs(a - b) < 1e-12 for a, b in zip(got[g], want))


def test_targets_are_broadcast_to_the_values(spark, monkeypatch):
    """A group's values must not be dealt by their group before the bracket is small."""
    from plotwise.operators import quantiles
    sent, was = [], quantiles.F.broadcast
    monkeypatch.setattr(quantiles.F, "broadcast", lambda d: sent.append(d.columns) or was(d))
    df = spark.range(3000).selectExpr("id % 2 AS g", "cast(id AS double) AS v")
    for by in (None, ["g"]):
        sent.clear()
        rows = exact_percentiles(df, "v", [0.5], by, limit=100, accuracy=1000).collect()
        assert sorted(r.p0 for r in rows) == ([1499.5] if by is None else [1499.0, 1500.0])
        assert [c[-1] for c in sent if "_lo" not in c].count("_below") >= 3      # a large bracket, and small ones of both rounds
