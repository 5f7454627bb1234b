"""Market segmentation of road centroids: k-distance ε, DBSCAN, K-means,
cluster ids and statistics.

DBSCAN is expressed as Spark jobs over grid cells whose points are all
neighbours: full cells are core at once, points of thin cells count theirs in a
grid join, clusters are the connected components of cells (large-star /
small-star, O(log² n) rounds, each round checkpointed), and border points take
the smallest component among their core neighbours (scikit-learn gives the first one that reaches
them; core and noise flags are identical either way).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotwise.config import (CLUSTER_PREFIXES, DBSCAN_EPS_PERCENTILE_MAX, DBSCAN_EPS_PERCENTILE_MIN,
                             DBSCAN_MAX_NOISE_THRESHOLD, DBSCAN_MIN_SAMPLES, EARTH_RADIUS_KM,
                             KMEANS_N_CLUSTERS, NOISE_LABEL, RANDOM_STATE, UNKNOWN_PREFIX)
from plotwise.functions.geo import KM_PER_DEG_LAT, haversine_sql
from plotwise.operators.kmeans import assign, fit_restarts
from plotwise.operators.spatial import radius_join


def _targets(points: DataFrame, id_col: str, lat: str, lon: str) -> DataFrame:
    return points.select(F.col(id_col).alias("_nid"), F.col(lat).alias("r_lat"), F.col(lon).alias("r_lon"))


def _locations(points: DataFrame, id_col: str, lat: str, lon: str) -> DataFrame:
    """Distinct locations with their multiplicity: points stacked on one spot
    join once, so a hot spot cannot make the neighbour join quadratic."""
    return (points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
                  .groupBy(lat, lon).agg(F.min(id_col).alias("_loc"), F.count(F.lit(1)).alias("_w")))


#: A first radius is right if no cell of its size holds more locations than this; cells are tried down to span / 2^LEVELS.
CROWD, LEVELS = 64, 24


def _crowded_km(loc: DataFrame, lat: str, lon: str, span_km: float) -> float:
    """Largest cell (span halved so and so often) that nowhere holds more than
    ``CROWD`` locations. From there on, rings stay linear: what a radius leaves open
    has fewer than k neighbours in it, so few open locations lie around any place."""
    side = F.lit(span_km / KM_PER_DEG_LAT) / F.pow(F.lit(2.0), F.col("lvl"))
    cells = (loc.select(lat, lon, F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("lvl"))
                .groupBy("lvl", F.floor(F.col(lat) / side).alias("r"), F.floor(F.col(lon) / side).alias("c")).count())
    fullest = {r["lvl"]: r["m"] for r in cells.groupBy("lvl").agg(F.max("count").alias("m")).collect()}  # one row per level
    return span_km / 2 ** min((lv for lv, m in fullest.items() if m <= CROWD), default=LEVELS)


def k_distance(points: DataFrame, id_col: str = "road_id", k: int = DBSCAN_MIN_SAMPLES,
               lat: str = "lat", lon: str = "lon", start_km: float | None = None) -> DataFrame:
    """Great-circle km to the k-th nearest point, the point itself counted
    first: (id, kdist_km). Works on weighted distinct locations with
    expanding rings as in ``spatial.nearest``: a location is final once the
    weights of candidates within the current radius reach k."""
    loc = _locations(points, id_col, lat, lon).checkpoint()
    ext = loc.agg(F.min(lat), F.max(lat), F.min(lon), F.max(lon), F.sum("_w"), F.count(F.lit(1))).first()
    n = ext[4] or 0
    if n == 0:
        return points.select(id_col).withColumn("kdist_km", F.lit(None).cast("double"))
    span = ((ext[1] - ext[0]) + (ext[3] - ext[2])) * KM_PER_DEG_LAT * 1.05 + 1e-9
    if start_km is None:
        # radius expected to hold ~k points if they were spread evenly
        area = max((ext[1] - ext[0]) * (ext[3] - ext[2]) * KM_PER_DEG_LAT ** 2, 1e-6)
        start_km = min(max((area * k / max(ext[5], 1)) ** 0.5, span / 4096), _crowded_km(loc, lat, lon, span))
    kk = min(k, n)
    tg = loc.select(F.col("_loc").alias("_nid"), F.col("_w").alias("_nw"), F.col(lat).alias("r_lat"),
                    F.col(lon).alias("r_lon"))
    r = min(start_km, span)
    pending = loc.select("_loc", lat, lon)
    done = []
    while True:
        last = r >= span
        cand = radius_join(pending, tg, r, "haversine", lat, lon, "r_lat", "r_lon", "d")
        w = Window.partitionBy("_loc").orderBy("d", "_nid").rowsBetween(Window.unboundedPreceding, 0)
        kth = (cand.withColumn("_cw", F.sum("_nw").over(w)).filter(F.col("_cw") >= kk)
                   .groupBy("_loc").agg(F.min("d").alias("kdist_km")))
        kth = kth.checkpoint()
        done.append(kth)
        if last:
            break
        pending = pending.join(kth.select("_loc"), "_loc", "left_anti").checkpoint()
        if pending.isEmpty():
            break
        r = min(r * 2.0, span)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    per_loc = loc.join(out, "_loc").select(lat, lon, "kdist_km")
    return points.select(id_col, lat, lon).join(per_loc, [lat, lon]).select(id_col, "kdist_km")


def optimal_eps(kdist: DataFrame, lo: float = DBSCAN_EPS_PERCENTILE_MIN, hi: float = DBSCAN_EPS_PERCENTILE_MAX) -> DataFrame:
    """One row: linear percentiles of the k-distances and ε = their mean (km and radians)."""
    from plotwise.operators.quantiles import exact_percentiles
    q = exact_percentiles(kdist, "kdist_km", [lo, hi]).first()
    n = kdist.agg(F.count(F.lit(1)).alias("n"))
    eps = (F.lit(q[0]) + F.lit(q[1])) / 2
    return n.select("n", F.lit(q[0]).cast("double").alias("kdist_p90_km"), F.lit(q[1]).cast("double").alias("kdist_p95_km"),
                    eps.alias("eps_km"), (eps / EARTH_RADIUS_KM).alias("eps_rad"))


def connected_components(vertices: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """Component = smallest vertex id, by alternating large-star and
    small-star edge rewrites until the edge set stops changing (its size and
    the xor of its edges' hashes, one aggregate over the checkpointed edges)."""
    e = (edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).filter(F.col("u") != F.col("v"))
              .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint())

    def sym(x):
        return x.unionByName(x.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def state(x):
        return tuple(x.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    before = state(e)
    while before[0]:
        s = sym(e)
        m = s.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("_m", "u"))
        large = (s.filter(F.col("v") > F.col("u")).join(m, "u")
                  .select(F.col("v").alias("u"), F.col("_m").alias("v")))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        s2 = sym(large)
        smaller = s2.filter(F.col("v") < F.col("u"))
        m2 = smaller.groupBy("u").agg(F.min("v").alias("_m"))
        small = (smaller.join(m2, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
                 .unionByName(m2.select("u", F.col("_m").alias("v"))))
        new = small.filter(F.col("u") != F.col("v")).distinct().checkpoint()
        e, after = new, state(new)
        if after == before:
            break
        before = after
    # at the fixed point every non-root vertex has one edge to its root
    root = e.groupBy("u").agg(F.min("v").alias("component"))
    v = vertices.select(F.col(id_col).alias("u")).distinct()
    return (v.join(root, "u", "left")
             .select(F.col("u").alias(id_col), F.coalesce("component", "u").alias("component")))


def _cell_links(core: DataFrame, eps_km: float, lat: str, lon: str) -> DataFrame:
    """(rep, component): which cells with core points are one cluster; rep is a
    cell's smallest location id. One pair of core points within ε suffices
    for a pair of cells, so pairs are looked for in order of promise: the two
    representatives, then the points nearest to the other's representative, and only between cells
    not connected by then the points that could reach the other cell at all.
    The first two steps touch each point once per neighbouring cell."""
    cells = core.groupBy("cr", "cc").agg(
        F.min("_loc").alias("rep"), F.min_by(lat, "_loc").alias("y"), F.min_by(lon, "_loc").alias("x"),
        F.min(lat).alias("y0"), F.max(lat).alias("y1"), F.min(lon).alias("x0"), F.max(lon).alias("x1")).checkpoint()
    a = cells.select(F.col("rep").alias("a"), F.col("y").alias("ay"), F.col("x").alias("ax"))
    b = cells.select(F.col("rep").alias("b"), F.col("y").alias("by"), F.col("x").alias("bx"))
    # points within ε of each other have representatives within 3 ε: a cell's diagonal is at most ε
    near = radius_join(a, b, 3 * eps_km, "haversine", "ay", "ax", "by", "bx", "d").filter("a < b").checkpoint()
    members = core.join(cells.select("cr", "cc", "rep"), ["cr", "cc"]).select("rep", F.col(lat).alias("py"), F.col(lon).alias("px"))
    open_ = near.filter(F.col("d") > eps_km)

    def closest(own: str, oy: str, ox: str, name: str) -> DataFrame:
        reach = open_.join(members, F.col(own) == F.col("rep"))
        gap = F.expr(haversine_sql("py", "px", oy, ox))
        return reach.groupBy("a", "b").agg(F.min(F.struct(gap.alias("g"), "py", "px")).alias(name))

    met = (closest("a", "by", "bx", "pa").join(closest("b", "ay", "ax", "pb"), ["a", "b"])
           .select("a", "b", *[F.col(f"{k}.{c}").alias(f"{c}_{k}") for k in ("pa", "pb") for c in ("py", "px")])
           .filter(F.expr(haversine_sql("py_pa", "px_pa", "py_pb", "px_pb")) <= eps_km))
    links = near.filter(F.col("d") <= eps_km).select("a", "b").unionByName(met.select("a", "b"))
    vertices = cells.select(F.col("rep").alias("id"))
    comp = connected_components(vertices, links.select(F.col("a").alias("src"), F.col("b").alias("dst")), "id").checkpoint()
    ca, cb = (comp.select(F.col("id").alias(k), F.col("component").alias(f"c{k}")) for k in "ab")
    apart = open_.select("a", "b").join(ca, "a").join(cb, "b").filter("ca != cb").checkpoint()
    if not apart.isEmpty():
        # a point can only take part if it is within ε of the other cell's box
        pad_y = eps_km / KM_PER_DEG_LAT * 1.001
        box = cells.select(F.col("rep").alias("o"), "y0", "y1", "x0", "x1")

        def facing(own: str, other: str, y: str, x: str) -> DataFrame:
            pad_x = F.lit(pad_y) / F.cos(F.radians(F.least(F.lit(89.0), F.greatest(F.abs("y0"), F.abs("y1")) + pad_y)))
            return (apart.join(box, F.col(other) == F.col("o")).join(members, F.col(own) == F.col("rep"))
                         .filter(F.col("py").between(F.col("y0") - pad_y, F.col("y1") + pad_y)
                                 & F.col("px").between(F.col("x0") - pad_x, F.col("x1") + pad_x))
                         .select("a", "b", "ca", "cb", F.col("py").alias(y), F.col("px").alias(x)))

        more = (facing("a", "b", "ya", "xa").join(facing("b", "a", "yb", "xb").drop("ca", "cb"), ["a", "b"])
                .filter(F.expr(haversine_sql("ya", "xa", "yb", "xb")) <= eps_km)
                .select(F.col("ca").alias("src"), F.col("cb").alias("dst")).distinct().checkpoint())
        if not more.isEmpty():
            upper = connected_components(comp.select(F.col("component").alias("id")), more, "id").withColumnsRenamed({"id": "component", "component": "root"})
            comp = comp.join(upper, "component").select("id", F.col("root").alias("component"))
    return cells.select("cr", "cc", "rep").join(comp, F.col("rep") == F.col("id")).select("cr", "cc", "component")


def dbscan(points: DataFrame, eps_km: float, id_col: str = "road_id", min_samples: int = DBSCAN_MIN_SAMPLES,
           lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(id, market_cluster, is_core, is_noise): labels 0.. by smallest member
    id of each cluster, noise −1; neighbours within ε inclusive, self counted.

    Works by cells of side ε/√2, whose points are all within ε of each other: a cell of
    ``min_samples`` points or more is all core and one piece at once. Only
    points of thinner cells count their neighbours, at most a
    bounded number of them around any point, so the pairs grow with the number of points
    and not with their density. Clusters are connected components of cells.
    Stacked points are one weighted location.
    """
    side = eps_km / 2 ** 0.5 * 0.999 / KM_PER_DEG_LAT
    row = F.floor(F.col(lat) / side)
    # degrees of longitude in the side at the row's edge nearest the equator: never wider further out
    edge = F.when(row >= 0, row * side).otherwise((row + 1) * side)
    loc = (_locations(points, id_col, lat, lon).withColumn("cr", row)
           .withColumn("cc", F.floor(F.col(lon) / (F.lit(side) / F.cos(F.radians(edge))))).checkpoint())
    weight = loc.groupBy("cr", "cc").agg(F.sum("_w").alias("_cw"))
    loc = loc.join(weight, ["cr", "cc"]).checkpoint()
    thin = loc.filter(F.col("_cw") < min_samples).select("_loc", F.col(lat).alias("ty"), F.col(lon).alias("tx"))
    every = loc.select(F.col("_loc").alias("_nid"), F.col("_w").alias("_nw"), F.col(lat).alias("ny"), F.col(lon).alias("nx"))
    pairs = radius_join(every, thin, eps_km, "haversine", "ny", "nx", "ty", "tx", "d").select("_loc", "_nid", "_nw").checkpoint()
    thin_core = pairs.groupBy("_loc").agg(F.sum("_nw").alias("_n")).filter(F.col("_n") >= min_samples).select("_loc")
    core = (loc.filter(F.col("_cw") >= min_samples).select("_loc", "cr", "cc", lat, lon)
               .unionByName(loc.join(thin_core, "_loc", "left_semi").select("_loc", "cr", "cc", lat, lon))).checkpoint()
    comp = core.join(_cell_links(core, eps_km, lat, lon), ["cr", "cc"]).select("_loc", "component").checkpoint()
    border = (pairs.join(core, "_loc", "left_anti")
                   .join(comp.withColumnRenamed("_loc", "_nid"), "_nid")
                   .groupBy("_loc").agg(F.min("component").alias("component")))
    labelled = comp.unionByName(border)
    from plotwise.operators.windows import global_index
    numbers = global_index(labelled.select("component").distinct(), ["component"], "market_cluster")
    per_loc = (loc.select("_loc", lat, lon).join(labelled, "_loc", "left").join(numbers, "component", "left")
                  .join(core.select("_loc", F.lit(True).alias("is_core")), "_loc", "left"))
    out = points.select(id_col, lat, lon).join(per_loc, [lat, lon], "left")
    return out.select(id_col, F.coalesce(F.col("market_cluster").cast("int"), F.lit(-1)).alias("market_cluster"),
                      F.coalesce("is_core", F.lit(False)).alias("is_core"),
                      F.col("component").isNull().alias("is_noise"))


def kmeans(points: DataFrame, k: int = KMEANS_N_CLUSTERS, id_col: str = "road_id", lat: str = "lat",
           lon: str = "lon", seed: int = RANDOM_STATE, n_init: int = 10) -> DataFrame:
    """K-means on raw (lat, lon) degrees; of ``n_init`` restarts, run together
    (see ``kmeans``), the one of least cost wins, the first among equals. k is held to the distinct
    points; points without a place get cluster -1 and count as noise."""
    fits = fit_restarts(points, k, lat, lon, seed, n_init)
    cols = [F.lit(False).alias("is_core"), F.col("market_cluster").eqNullSafe(-1).alias("is_noise")]
    if not fits:
        return points.select(id_col, F.lit(-1).alias("market_cluster")).select(id_col, "market_cluster", *cols)
    best = min(fits, key=lambda f: f.cost)
    told = assign(points.select(id_col, lat, lon), best.centres, lat, lon, "market_cluster")
    return told.fillna(-1, subset=["market_cluster"]).select(id_col, "market_cluster", *cols)


def cluster_roads(roads: DataFrame, method: str = "auto", id_col: str = "road_id",
                  noise_threshold: float = DBSCAN_MAX_NOISE_THRESHOLD, n_init: int = 10) -> DataFrame:
    """'auto': DBSCAN, then K-means when the noise share exceeds the
    threshold; 'dbscan' / 'kmeans' force one. Adds market_cluster,
    clustering_method, is_noise (and is_core)."""
    if method not in ("auto", "dbscan", "kmeans"):
        raise ValueError(f"method is {method!r}; it can be auto, dbscan or kmeans")
    if method == "kmeans":
        lab = kmeans(roads, id_col=id_col, n_init=n_init).withColumn("clustering_method", F.lit("kmeans"))
    else:
        eps = optimal_eps(k_distance(roads, id_col)).first()["eps_km"]
        lab = dbscan(roads, eps, id_col).checkpoint()
        noise = lab.agg(F.avg(F.col("is_noise").cast("double"))).first()[0] or 0.0
        if method == "auto" and noise > noise_threshold:
            lab = kmeans(roads, id_col=id_col, n_init=n_init).withColumn("clustering_method", F.lit("kmeans"))
        else:
            lab = lab.withColumn("clustering_method", F.lit("dbscan"))
    return roads.join(lab, id_col, "left")


def cluster_ids(df: DataFrame, district: str = "district", cluster: str = "market_cluster",
                out: str = "market_cluster_id") -> DataFrame:
    """PREFIX_%03d from the lower-cased district (unknown → 'XX'); noise → 'NOISE'."""
    m = F.create_map(*[F.lit(x) for kv in CLUSTER_PREFIXES.items() for x in kv])
    prefix = F.coalesce(m[F.lower(F.col(district))], F.lit(UNKNOWN_PREFIX))
    label = F.when(F.coalesce(F.col("is_noise"), F.lit(False)), F.lit(NOISE_LABEL)) \
             .otherwise(F.format_string("%s_%03d", prefix, F.col(cluster)))
    return df.withColumn(out, label)


def cluster_back_join(props: DataFrame, roads: DataFrame, road: str = "road_name") -> DataFrame:
    cols = [c for c in ("market_cluster_id", "market_cluster", "clustering_method", "is_noise") if c in roads.columns]
    return props.join(roads.select(road, *cols), road, "left")


def cluster_stats(df: DataFrame, cluster: str = "market_cluster_id", price: str = "price_m2",
                  size: str = "property_m2", district: str = "district", order_col: str = "records_id") -> DataFrame:
    from plotwise.operators.quantiles import exact_percentiles
    p = F.col(price)
    med = exact_percentiles(df, price, [0.5], [cluster]).withColumnRenamed("p0", "median_price_m2")
    return (df.groupBy(cluster)
              .agg(F.count(p).alias("property_count"), F.avg(p).alias("avg_price_m2"),
                   F.stddev_samp(p).alias("std_price_m2"),
                   F.min(p).alias("min_price_m2"), F.max(p).alias("max_price_m2"),
                   F.avg(size).alias("avg_property_size"),
                   F.min_by(F.col(district), F.when(F.col(district).isNotNull(), F.col(order_col))).alias(district))
              .join(med, cluster, "left")
              .select(cluster, "property_count", "avg_price_m2", "median_price_m2", "std_price_m2", "min_price_m2",
                      "max_price_m2", "avg_property_size", district)
              .orderBy(F.desc("property_count"), F.asc(cluster)))
