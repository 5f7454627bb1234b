"""Road-network distances on Spark DataFrames.

The graph is two tables: ``nodes(node_id, lat, lon)`` and directed
``edges(src, dst, length_m)`` (parallel edges collapse to their minimum).

Shortest distances to the nearest amenity of each type are computed once for
the whole graph – not once per property – by multi-source relaxation on the
reversed edges: every amenity node starts at 0 for its type, and each round
joins only the nodes improved in the previous round (the frontier) with the
edges, keeps the per-(node, type) minimum, and retains improvements. It stops
when no distance improves (exact, Bellman–Ford on a frontier). Every round's
frontier, and every fourth round's distance table, are checkpointed to the
shared checkpoint dir, so lineage stays a few rounds deep and a lost
executor costs at most four rounds.

Chains of streets would take a round per hop. So nodes with at most two neighbours
are taken out first, a third of a chain a round: their edges are added up across them, and
their neighbours learn the distances they know. When the distances of the rest are known, they
are put back in reverse order. Both steps are exact on any graph.

A graph, or what is left of one, of at most ``TASK_EDGES`` edges takes no rounds: a task per group finds its distances.
"""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.operators.spatial import nearest


def collapse_edges(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src", "dst").agg(F.min("length_m").alias("length_m"))


def union_graphs(*edge_tables: DataFrame) -> DataFrame:
    """Compose several (e.g. per-district) graphs into one."""
    out = edge_tables[0]
    for e in edge_tables[1:]:
        out = out.unionByName(e)
    return collapse_edges(out)


def snap_to_nodes(points: DataFrame, nodes: DataFrame, point_id: str, lat: str = "lat", lon: str = "lon",
                  start_km: float = 0.5) -> DataFrame:
    """Nearest graph node (great-circle) per point: (point_id, node_id, snap_km)."""
    tg = nodes.select("node_id", F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"))
    best = nearest(points.select(point_id, lat, lon), tg, point_id, "haversine", start_km, lat, lon,
                   dist_col="snap_km", target_id="node_id")
    return best


#: Chains are shortened until no more nodes than this could be taken out, or than ``FEW_NODES`` if what is left is too large for a task.
CHAIN_NODES, FEW_NODES = 100_000, 100
#: Edges that one task holds at most, and edges sent to the tasks of all groups.
TASK_EDGES, SENT_EDGES = 2_000_000, 32_000_000


def _shorten(edges: DataFrame, dist: DataFrame, near) -> tuple[DataFrame, DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """(edges, dist, steps) without the inner nodes of chains: of ``edges(src, dst, length_m)``, each pair once, those between the nodes
    that are left; the distances that these know by way of the others; and per round the edges (node, to, length_m) that led
    out of the nodes taken out, with the distances those knew. No two neighbours go in one round: of neighbours that
    could go, the one of least hash does."""
    steps = []
    for rnd in count():
        both = edges.select(F.col("src").alias("node"), F.col("dst").alias("other")) \
                    .unionByName(edges.select(F.col("dst").alias("node"), F.col("src").alias("other"))).distinct()
        thin = (both.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.count("other").alias("known"), F.min("other").alias("a"), F.max("other").alias("b"))
                    .filter("n <= 2 and n = known and node is not null").select("node", "a", "b")).checkpoint()
        left = thin.count()
        if left <= min(CHAIN_NODES, FEW_NODES) or (left <= CHAIN_NODES and _fits(edges, dist)):
            return edges, dist, steps
        rank = [F.struct(F.xxhash64(c, F.lit(rnd)), F.col(c)) for c in ("node", "other")]
        behind = (thin.select("node", F.explode(F.array_distinct(F.array("a", "b"))).alias("other"))
                      .join(thin.select(F.col("node").alias("other")), "other").filter(rank[1] < rank[0]).select("node"))
        gone = thin.select("node").join(behind, "node", "left_anti").checkpoint()
        src, dst, own = (gone.select(F.col("node").alias(c)) for c in ("src", "dst", "node_id"))
        out = edges.join(src, "src").select(F.col("src").alias("node"), F.col("dst").alias("to"), "length_m").checkpoint()
        told = dist.join(own, "node_id").checkpoint()
        into = edges.join(dst, "dst").select(F.col("dst").alias("node"), F.col("src").alias("from"), F.col("length_m").alias("_in"))
        across = (into.join(out, "node").filter(F.col("from") != F.col("to"))
                      .select(F.col("from").alias("src"), F.col("to").alias("dst"), (F.col("_in") + F.col("length_m")).alias("length_m")))
        left = edges.join(src, "src", "left_anti").join(dst, "dst", "left_anti")
        edges = collapse_edges(left.select("src", "dst", "length_m").unionByName(across)).checkpoint()
        by_way = into.join(told, F.col("node") == F.col("node_id")).select(F.col("from").alias("node_id"), "grp", (F.col("dist_m") + F.col("_in")).alias("dist_m"))
        dist = near(dist.join(own, "node_id", "left_anti").unionByName(by_way)).checkpoint()
        steps.append((out, told))


def multi_source_distances(edges: DataFrame, sources: DataFrame, cutoff_m: float | None = None) -> DataFrame:
    """Shortest directed distance (m) from every node TO the nearest source of
    each group: ``sources(node_id, grp)`` → ``(node_id, grp, dist_m)``. Rounds end
    when no distance improves, which any graph with lengths ≥ 0 reaches."""
    def near(dist: DataFrame) -> DataFrame:
        least = dist.groupBy("node_id", "grp").agg(F.min("dist_m").alias("dist_m"))
        return least if cutoff_m is None else least.filter(F.col("dist_m") <= cutoff_m)

    dist = sources.select("node_id", "grp").distinct().withColumn("dist_m", F.lit(0.0)).checkpoint()
    short, dist, steps = _shorten(collapse_edges(edges).filter(~F.col("src").eqNullSafe(F.col("dst"))).checkpoint(), dist, near)
    dist = _relaxed(short, dist, near)
    for i, (out, told) in enumerate(reversed(steps)):
        back = out.join(dist, F.col("to") == F.col("node_id")).select(F.col("node").alias("node_id"), "grp", (F.col("length_m") + F.col("dist_m")).alias("dist_m"))
        dist = dist.unionByName(near(back.unionByName(told)).checkpoint())
        if i % 4 == 3:
            dist = dist.checkpoint()
    return dist


def _fits(edges: DataFrame, dist: DataFrame) -> bool:
    """Whether a task holds all edges, and all groups' tasks can have them."""
    n = edges.count()
    return n <= TASK_EDGES and n * dist.select("grp").distinct().count() <= SENT_EDGES


def _in_tasks(edges: DataFrame, dist: DataFrame, near) -> DataFrame:
    """``_relaxed`` of few edges: Dijkstra's search, a task per group. Nodes that no edge leads to stay where they are."""
    node, grp = (dist.schema[c].dataType.simpleString() for c in ("node_id", "grp"))
    ends = edges.filter("dst is not null and length_m is not null") \
                .select(F.col("src").cast(node).alias("src"), F.col("dst").cast(node).alias("dst"), F.col("length_m").cast("double").alias("length_m"))
    known = ends.filter("src is not null")
    from_here = dist.join(ends.select(F.col("dst").alias("node_id")).distinct(), "node_id", "left_semi").select("node_id", "grp", "dist_m").checkpoint()
    sent = known.crossJoin(from_here.select(F.col("grp").alias("of")).distinct())

    def search(own: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(e):
            return own
        code, ids = pd.factorize(pd.concat([e["src"], e["dst"]], ignore_index=True))
        src, dst = code[:len(e)], code[len(e):]
        order = np.argsort(dst, kind="stable")
        ends = np.searchsorted(dst[order], np.arange(len(ids) + 1)).tolist()
        src, length = src[order].tolist(), e["length_m"].to_numpy()[order].tolist()
        best = [float("inf")] * len(ids)
        for at, d in zip(pd.Index(ids).get_indexer(own["node_id"]).tolist(), own["dist_m"].tolist()):
            if at >= 0:
                best[at] = min(best[at], d)
        heap = [(d, at) for at, d in enumerate(best) if d < float("inf")]
        heapq.heapify(heap)
        while heap:
            d, at = heapq.heappop(heap)
            if d > best[at]:
                continue
            for i in range(ends[at], ends[at + 1]):
                to, far = src[i], d + length[i]
                if far < best[to]:
                    best[to] = far
                    heapq.heappush(heap, (far, to))
        far = np.array(best)
        found = np.flatnonzero(np.isfinite(far))
        return pd.DataFrame({"node_id": np.asarray(ids)[found], "grp": own["grp"].iloc[0], "dist_m": far[found]})
    told = from_here.groupBy("grp").cogroup(sent.groupBy("of")).applyInPandas(search, f"node_id {node}, grp {grp}, dist_m double").checkpoint()
    dist = dist.unionByName(told)
    # a missing start is reached like a node, but nothing leads to it further
    nowhere = ends.filter("src is null").join(dist, F.col("dst") == F.col("node_id")).select(F.col("src").alias("node_id"), "grp", (F.col("dist_m") + F.col("length_m")).alias("dist_m"))
    return near(dist.unionByName(nowhere)).checkpoint()


def _relaxed(edges: DataFrame, dist: DataFrame, near) -> DataFrame:
    """``dist(node_id, grp, dist_m)``, relaxed along ``edges`` until nothing improves."""
    if _fits(edges, dist):
        return _in_tasks(edges, dist, near)
    e = edges.select(F.col("src").alias("_u"), F.col("dst").alias("_w"), "length_m")
    frontier = dist
    for rnd in count():
        cand = (frontier.join(e, frontier["node_id"] == e["_w"])
                        .select(F.col("_u").alias("node_id"), "grp", (F.col("dist_m") + F.col("length_m")).alias("dist_m")))
        cand = near(cand)
        # grouped, not joined: a group may be null, and is one like the others
        both = dist.select("node_id", "grp", F.col("dist_m").alias("_old"), F.lit(None).cast("double").alias("dist_m")) \
                   .unionByName(cand.withColumn("_old", F.lit(None).cast("double")))
        improved = (both.groupBy("node_id", "grp").agg(F.min("_old").alias("_old"), F.min("dist_m").alias("dist_m"))
                        .filter("dist_m is not null and (_old is null or dist_m < _old)").select("node_id", "grp", "dist_m")).checkpoint()
        if improved.isEmpty():
            return dist
        dist = near(dist.unionByName(improved))
        if rnd % 4 == 3:  # the frontier is checkpointed every round; the full table every 4th
            dist = dist.checkpoint()
        frontier = improved


def network_distance(props: DataFrame, amenities: DataFrame, nodes: DataFrame, edges: DataFrame,
                     types: list[str], prop_id: str = "records_id", way_col: str = "way_id",
                     type_col: str = "feature_type", prefix: str = "dist_to_", cutoff_km: float = 3000.0,
                     lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Per property: km along the directed network from its (way's) node to
    the nearest amenity node of each type; unreachable → NULL. Computed once
    per distinct way, mapped back by a join."""
    ways = (props.filter(F.col(way_col).isNotNull())
                 .groupBy(way_col).agg(F.min_by(F.struct(lat, lon), F.col(prop_id)).alias("_p"))
                 .select(way_col, F.col("_p.lat").alias(lat), F.col("_p.lon").alias(lon)))
    way_node = snap_to_nodes(ways, nodes, way_col, lat, lon).select(way_col, "node_id")
    a = amenities.select(F.col("osm_id").alias("_aid"), F.col(type_col).alias("grp"), lat, lon)
    a_node = snap_to_nodes(a, nodes, "_aid", lat, lon).join(a.select("_aid", "grp"), "_aid").select("node_id", "grp")
    d = multi_source_distances(edges, a_node, cutoff_km * 1000.0)
    per_way = (way_node.join(d, "node_id").groupBy(way_col).pivot("grp", types).agg(F.min("dist_m")))
    cols = {f"{prefix}{t.lower().replace(' ', '_')}": F.col(f"`{t}`") / 1000.0 for t in types}
    per_way = per_way.withColumns(cols).drop(*types)
    return props.join(per_way, way_col, "left")


def walk_drive_merge(props: DataFrame, walk: DataFrame, drive: DataFrame, key: str = "way_id") -> DataFrame:
    """walk ⟗ drive per way (full outer), then left-joined onto properties."""
    both = walk.join(drive, key, "full")
    return props.join(both, key, "left")
