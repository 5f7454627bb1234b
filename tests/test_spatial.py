"""Spatial joins, DBSCAN and shortest paths against brute force (NumPy)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotwise.operators import cluster as cl
from plotwise.operators import graph as gr
from plotwise.operators.spatial import nearest, radius_join
from plotwise.sources import proxies
from tests.conftest import SF


def hav(a, b, c, d):
    r = math.pi / 180
    x = math.sin((c - a) * r / 2) ** 2 + math.cos(a * r) * math.cos(c * r) * math.sin((d - b) * r / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(x), math.sqrt(1 - x))


@pytest.fixture(scope="module")
def pts(spark):
    p = proxies.properties(spark, SF).select("records_id", "lat", "lon").limit(300)
    a = proxies.amenities(spark, SF).select("osm_id", F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"))
    return p.toPandas(), a.toPandas(), p, a


def test_radius_join_matches_brute_force(spark, pts):
    pp, aa, p, a = pts
    got = {(r.records_id, r.osm_id) for r in radius_join(p, a, 5.0, "haversine").collect()}
    want = {(int(x.records_id), int(y.osm_id)) for x in pp.itertuples() for y in aa.itertuples()
            if hav(x.lat, x.lon, y.r_lat, y.r_lon) <= 5.0}
    assert got == want


def test_radius_join_plan_has_no_nested_loop(spark, pts):
    _, _, p, a = pts
    plan = radius_join(p, a, 1.0, "degrees")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nearest_matches_brute_force(spark, pts):
    pp, aa, p, a = pts
    got = {r.records_id: r.dist for r in nearest(p, a, "records_id", start_radius=0.2).collect()}
    for x in pp.itertuples():
        want = min(hav(x.lat, x.lon, y.r_lat, y.r_lon) for y in aa.itertuples())
        assert abs(got[int(x.records_id)] - want) < 1e-9


def test_dbscan_core_and_noise_match_definition(spark):
    roads = proxies.roads(spark, SF).select("road_id", "lat", "lon")
    pdf = roads.toPandas()
    eps = cl.optimal_eps(cl.k_distance(roads, "road_id")).first()["eps_km"]
    lab = {r.road_id: r for r in cl.dbscan(roads, eps, "road_id").collect()}
    xy = pdf[["lat", "lon"]].to_numpy()
    ids = pdf["road_id"].to_numpy()
    d = np.array([[hav(a[0], a[1], b[0], b[1]) for b in xy] for a in xy])
    nb = d <= eps
    core = nb.sum(axis=1) >= 5
    for i, rid in enumerate(ids):
        assert lab[rid].is_core == bool(core[i])
        assert lab[rid].is_noise == bool(not core[i] and not (nb[i] & core).any())
    # every core point's neighbourhood lies in one cluster
    for i in np.where(core)[0]:
        clusters = {lab[ids[j]].market_cluster for j in np.where(nb[i] & core)[0]}
        assert len(clusters) == 1


def test_connected_components(spark):
    v = spark.createDataFrame([(i,) for i in range(8)], "id long")
    e = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (7, 6)], "src long, dst long")
    comp = {r.id: r.component for r in cl.connected_components(v, e).collect()}
    assert comp == {0: 0, 1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 5}


def test_shortest_paths_are_consistent(spark):
    edges = proxies.graph_edges(spark, SF, "drive")
    src = spark.createDataFrame([(0, "a"), (97, "a")], "node_id long, grp string")
    d = {r.node_id: r.dist_m for r in gr.multi_source_distances(edges, src).collect()}
    assert d[0] == 0 and d[97] == 0
    for e in edges.collect():  # d(u) <= w(u,v) + d(v)
        if e.dst in d:
            assert d[e.src] <= e.length_m + d[e.dst] + 1e-9


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """A street of 120 nodes with side streets and one-way pieces, three groups of sources: equal to Dijkstra, in rounds far below its hops."""
    import heapq
    rng = np.random.default_rng(5)
    rows = [(i, i + 1, float(rng.integers(1, 50))) for i in range(120)] + [(i + 1, i, float(rng.integers(1, 50))) for i in range(120) if i % 41]
    rows += [(i, 1000 + i, 7.0) for i in range(0, 120, 13)] + [(1000 + i, i, 2.0) for i in range(0, 120, 26)] + [(5, 5, 1.0), (5, 6, 0.5), (110, 20, 3.0)]
    at = [(0, "a"), (120, "b"), (60, "b"), (1026, "c"), (77, "c"), (9999, "c")]
    into, want = {}, {}
    for u, v, w in rows:
        into.setdefault(v, []).append((u, w))
    for g in "abc":
        heap = [(0.0, n) for n, grp in at if grp == g]
        while heap:
            d, v = heapq.heappop(heap)
            if want.setdefault((v, g), d) == d:
                for u, w in into.get(v, []):
                    if (u, g) not in want and d + w <= 1500.0:
                        heapq.heappush(heap, (d + w, u))
    monkeypatch.setattr(gr, "CHAIN_NODES", 12)
    rounds, relaxed = [], gr._relaxed
    monkeypatch.setattr(gr, "_relaxed", lambda e, d, near: (rounds.append(e.count()), relaxed(e, d, near))[1])
    got = gr.multi_source_distances(spark.createDataFrame(rows, "src long, dst long, length_m double"), spark.createDataFrame(at, "node_id long, grp string"), 1500.0).collect()
    assert {(r.node_id, r.grp): r.dist_m for r in got} == want and len(got) == len(want)
    assert rounds[0] < 80


@pytest.mark.parametrize("task_edges", [0, 1000])
def test_distances_in_rounds_and_in_tasks_are_equal(spark, monkeypatch, task_edges):
    """Parallel, missing and unknown ends and lengths, a null group, sources off the graph; a cutoff that ends some ways. A graph that
    a task holds takes no rounds, whatever its hops."""
    rng = np.random.default_rng(11)
    rows = [(int(a), int(b), float(d)) for a, b, d in zip(rng.integers(0, 60, 150), rng.integers(0, 60, 150), rng.integers(1, 40, 150))]
    rows += [(60 + i, 61 + i, 1.0) for i in range(40)] + [(None, 3, 1.0), (4, None, 1.0), (7, 8, None)]
    edges = spark.createDataFrame(rows, "src long, dst long, length_m double")
    at = spark.createDataFrame([(3, "a"), (9, "a"), (9, None), (100, "b"), (None, "b"), (5000, "c")], "node_id long, grp string")
    monkeypatch.setattr(gr, "TASK_EDGES", task_edges, raising=False)
    checkpoints, own = [], type(edges).checkpoint
    monkeypatch.setattr(type(edges), "checkpoint", lambda df, *a, **k: (checkpoints.append(1), own(df, *a, **k))[1])
    got = {(r.node_id, r.grp): r.dist_m for r in gr.multi_source_distances(edges, at, 60.0).collect()}
    want = {(n, g): 0.0 for n, g in [(3, "a"), (9, "a"), (9, None), (100, "b"), (None, "b"), (5000, "c")]}
    for _ in range(200):
        for u, v, d in rows:
            for g in ("a", "b", "c", None):
                if None not in (v, d) and (v, g) in want and want[v, g] + d <= min(60.0, want.get((u, g), 1e9)):
                    want[u, g] = want[v, g] + d
    assert got == want
    assert not task_edges or len(checkpoints) < 8


def test_distances_of_a_null_group_end(spark):
    """On a cycle a null group once counted as improved in every round up to the cutoff."""
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (2, 0, 1.0)], "src long, dst long, length_m double")
    at = spark.createDataFrame([(0, None)], "node_id long, grp string")
    got = gr.multi_source_distances(edges, at, 40.0).collect()
    assert sorted((r.node_id, r.dist_m) for r in got) == [(0, 0.0), (1, 2.0), (2, 1.0)]


def test_dbscan_with_stacked_points(spark):
    """A third of the points on one spot: weighted locations keep the
    definition (core = ≥ min_samples within ε, self counted)."""
    rng = np.random.default_rng(7)
    pts = [(i, 3.0, 101.5) for i in range(60)]
    pts += [(100 + i, 3.0 + rng.random() * 0.02, 101.5 + rng.random() * 0.02) for i in range(120)]
    df = spark.createDataFrame(pts, "road_id long, lat double, lon double")
    eps = 0.3
    lab = {r.road_id: r for r in cl.dbscan(df, eps, "road_id").collect()}
    xy = [(a, b) for _, a, b in pts]
    for i, (rid, a, b) in enumerate(pts):
        nb = [j for j, (c, d) in enumerate(xy) if hav(a, b, c, d) <= eps]
        assert lab[rid].is_core == (len(nb) >= 5)
    kd = {r.road_id: r.kdist_km for r in cl.k_distance(df, "road_id").collect()}
    assert all(kd[i] == 0.0 for i in range(60))


def test_nearest_road_takes_no_excluded_class_and_long_segments(spark):
    from plotwise.operators.geocode import nearest_road
    nodes = spark.createDataFrame([(1, 3.0, 101.0), (2, 3.0, 101.1), (3, 3.0002, 101.05), (4, 3.0002, 101.0501), (5, 3.5, 102.0)], "node_id long, lat double, lon double")
    ways = spark.createDataFrame([(10, 0, 1), (10, 1, 2), (20, 0, 3), (20, 1, 4), (30, 0, 5)], "way_id long, pos int, node_id long")
    roads = spark.createDataFrame([(10, "long road", "primary", 3.0, 101.05), (20, "path", "footway", 3.0002, 101.05), (30, None, "service", 3.5, 102.0)],
                                  "road_id long, road_name string, highway string, lat double, lon double")
    points = spark.createDataFrame([(1, 3.0003, 101.05), (2, 3.5, 102.0), (3, 3.2, 101.5)], "records_id long, lat double, lon double")
    got = {r["records_id"]: (r["near_way_id"], r["near_road_name"]) for r in nearest_road(points, ways, nodes, roads).collect()}
    # 33 m from the middle of a segment of 11 km, whose vertices are far off; a footway is nearer but no road
    assert got == {1: (10, "long road"), 2: (30, ""), 3: (None, None)}


def test_exploded_side_is_never_broadcast(spark):
    p = spark.createDataFrame([(1, 3.0, 101.0)], "pid long, lat double, lon double")
    t = spark.createDataFrame([(9, 3.0, 101.0)], "tid long, r_lat double, r_lon double")
    for metric in ("degrees", "haversine"):
        plan = radius_join(p, t, 1.0, metric)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_nearest_searches_stacked_places_once(spark):
    p = spark.createDataFrame([(1, 3.0, 101.0), (2, 3.0, 101.0), (3, 3.01, 101.0), (3, 3.2, 101.0), (4, None, 101.0)], "pid long, lat double, lon double")
    t = spark.createDataFrame([(9, 3.0, 101.0), (7, 3.0, 101.0), (8, 3.02, 101.0), (5, None, None)], "tid long, r_lat double, r_lon double")
    got = {r.pid: (round(r.dist, 6), r.tid) for r in nearest(p, t, "pid", start_radius=0.1, target_id="tid").collect()}
    assert got[1] == got[2] == (0.0, 7)
    assert got[3] == (round(hav(3.01, 101.0, 3.02, 101.0), 6), 8) or got[3][1] == 7
    assert set(got) == {1, 2, 3}
    stacked = spark.range(400).selectExpr("id AS pid", "3.0D AS lat", "101.0D AS lon")
    onto = stacked.selectExpr("pid AS tid", "lat AS r_lat", "lon AS r_lon")
    joined = []
    from plotwise.operators import spatial
    was = spatial.radius_join

    def seen(left, right, *args, **kw):
        joined.append((left.count(), right.count()))
        return was(left, right, *args, **kw)
    spatial.radius_join = seen
    try:
        rows = nearest(stacked, onto, "pid", start_radius=0.1, target_id="tid").collect()
    finally:
        spatial.radius_join = was
    assert joined == [(1, 1)] and {(r.pid, r.dist, r.tid) for r in rows} == {(i, 0.0, 0) for i in range(400)}


def test_ids_near_and_pivot_share_points(spark):
    from plotwise.operators.amenities import amenity_pivot, ids_near
    p = spark.createDataFrame([(1, 3.0, 101.0), (2, 3.0, 101.0), (2, 3.1, 101.0), (3, 4.0, 101.0), (4, None, None), (5, 3.0, 101.0), (5, 3.0, 101.0)],
                              "records_id long, lat double, lon double")
    a = spark.createDataFrame([(10, "mall", 3.0, 101.001), (2, "mall", 3.0, 101.0), (30, "park", 3.1, 101.0), (10, "mall", 3.1, 101.0)],
                              "osm_id long, feature_type string, lat double, lon double")
    assert {r.records_id: r.ids for r in ids_near(p, a, 1.0).collect()} == {1: "2, 10", 2: "2, 10, 30", 5: "2, 10"}
    got = {r.records_id: (r.mall, r.park) for r in amenity_pivot(p, a, ["mall", "park"], 1.0).collect()}
    assert got == {1: (2, 0), 2: (3, 1), 5: (4, 0)}
    from plotwise.operators import amenities as am
    joined, was = [], am.radius_join

    def seen(left, *args, **kw):
        joined.append(left.count())
        return was(left, *args, **kw)
    am.radius_join = seen
    try:
        stacked = spark.range(50).selectExpr("id AS records_id", "3.0D AS lat", "101.0D AS lon")
        assert ids_near(stacked, a, 1.0).count() == amenity_pivot(stacked, a, ["mall"], 1.0).count() == 50
    finally:
        am.radius_join = was
    assert joined == [1, 1]
