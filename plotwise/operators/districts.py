"""District polygons: point-in-polygon flags, road-in-district by overlap
length, boundary tables.

District tables are small dimension tables (one row per administrative
district). Their rings are broadcast only after their vertices are summed up
against ``MAX_BROADCAST_BYTES``; beyond it, the same plans run as shuffled
equi-joins on the district's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.functions.geometry import edges_sql, pip_sql, seg_inside_len_sql, seg_len_sql

MAX_BROADCAST_BYTES = 32 << 20
#: Bytes of a ring vertex (two doubles and their place in a row's array of structs) and of a row without rings.
VERTEX_BYTES, ROW_BYTES = 40, 200


def maybe_broadcast(df: DataFrame, rings: str, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast a polygon table only when its summed vertices prove it small; beyond that it is left to a shuffled join.
    Meant for dimension tables read straight from storage."""
    size = df.agg(F.sum(F.aggregate(rings, F.lit(0).cast("long"), lambda a, r: a + F.size(r)) * VERTEX_BYTES + ROW_BYTES)).first()[0]
    return F.broadcast(df) if (size or 0) <= max_bytes else df


def with_bbox(polys: DataFrame, rings: str = "rings") -> DataFrame:
    pts = F.flatten(F.col(rings))
    return polys.withColumns({
        "_lon0": F.array_min(F.transform(pts, lambda p: p["lon"])),
        "_lon1": F.array_max(F.transform(pts, lambda p: p["lon"])),
        "_lat0": F.array_min(F.transform(pts, lambda p: p["lat"])),
        "_lat1": F.array_max(F.transform(pts, lambda p: p["lat"])),
    })


def point_in_polygon(points: DataFrame, polys: DataFrame, key: str = "district", lat: str = "lat",
                     lon: str = "lon", out: str = "in_expected_district") -> DataFrame:
    """Flag whether each point lies inside the polygon of its own ``key``
    (equi-join on the key, then an even–odd ray cast over all rings)."""
    pl = maybe_broadcast(polys.select(F.col(key).alias("_k"), F.col("rings").alias("_rings")), "_rings")
    j = points.join(pl, points[key] == pl["_k"], "left")
    flag = F.when(F.col("_rings").isNull(), F.lit(False)).otherwise(F.expr(pip_sql(lon, lat, edges_sql("_rings"))))
    return j.withColumn(out, flag).drop("_k", "_rings")


def _cells_between(lo: str, hi: str, size: float):
    return F.sequence(F.floor(F.col(lo) / size).cast("long"), F.floor(F.col(hi) / size).cast("long"))


def district_of_road(roads: DataFrame, polys: DataFrame, road_key: list[str], expected: str = "district",
                     line: str = "line", cell: float = 0.05) -> DataFrame:
    """Assign each road (line) to the district holding the greatest length of
    it (planar degrees). Ties go to the district listed first (lowest
    ``district_id``); a road touching no district gets 'Outside any district'.

    Segments and polygons are both keyed by the grid cells their boxes cover,
    equi-joined on the cell, de-duplicated per (segment, district), then
    clipped exactly with a JVM higher-order expression.
    """
    seg_idx = F.sequence(F.lit(1), F.size(F.col("_line")) - 1)
    segs = (roads.select(*road_key, F.col(line).alias("_line"))
                 .select(*road_key, F.posexplode(F.transform(seg_idx, lambda i: F.struct(
                     F.col("_line")[i - 1]["lon"].alias("ax"), F.col("_line")[i - 1]["lat"].alias("ay"),
                     F.col("_line")[i]["lon"].alias("bx"), F.col("_line")[i]["lat"].alias("by")))).alias("seg_no", "s"))
                 .select(*road_key, "seg_no", "s.*"))
    total = segs.groupBy(*road_key).agg(F.sum(F.expr(seg_len_sql("ax", "ay", "bx", "by"))).alias("total_road_length"))

    segc = (segs.withColumns({"_x0": F.least("ax", "bx"), "_x1": F.greatest("ax", "bx"),
                              "_y0": F.least("ay", "by"), "_y1": F.greatest("ay", "by")})
                .withColumn("_cx", F.explode(_cells_between("_x0", "_x1", cell)))
                .withColumn("_cy", F.explode(_cells_between("_y0", "_y1", cell))))
    pb = with_bbox(polys.select(F.col("district").alias("_district"), F.col("district_id").alias("_did"), "rings"))
    pc = (pb.withColumn("_cx", F.explode(_cells_between("_lon0", "_lon1", cell)))
            .withColumn("_cy", F.explode(_cells_between("_lat0", "_lat1", cell)))
            .select("_did", "_cx", "_cy"))
    # ids meet on cells; the rings come in only after each (segment, district) pair is left once
    pairs = (segc.join(pc, ["_cx", "_cy"], "inner")
                 .dropDuplicates(road_key + ["seg_no", "_did"]))
    rings = maybe_broadcast(pb.select("_did", "_district", F.col("rings").alias("_rings")), "_rings")
    inside = pairs.join(rings, "_did").withColumn("_len", F.expr(seg_inside_len_sql("ax", "ay", "bx", "by", edges_sql("_rings"))))
    per = inside.groupBy(*road_key, "_district", "_did").agg(F.sum("_len").alias("_ov"))
    best = (per.filter(F.col("_ov") > 0)
               .groupBy(*road_key)
               .agg(F.max(F.struct(F.col("_ov"), (-F.col("_did")).alias("_nd"), F.col("_district"))).alias("_b")))
    out = roads.join(total, road_key, "left").join(best, road_key, "left")
    found = F.col("_b").isNotNull()
    tl = F.coalesce(F.col("total_road_length"), F.lit(0.0))
    ov = F.when(found, F.col("_b._ov")).otherwise(F.lit(0.0))
    return out.select(
        *roads.columns,
        F.when(found, F.col("_b._district")).otherwise(F.lit("Outside any district")).alias("actual_district"),
        F.when(found, F.col(expected) == F.col("_b._district")).otherwise(F.lit(False)).alias("is_in_correct_district"),
        ov.alias("overlap_length"),
        tl.alias("total_road_length"),
        F.when(tl > 0, ov / tl * 100.0).otherwise(F.lit(0.0)).alias("overlap_percentage"))


def district_boundaries(districts: DataFrame, boundaries: DataFrame, id_col: str = "district_id") -> DataFrame:
    """District table ⟕ fetched boundaries on id; rows without geometry dropped."""
    return districts.join(boundaries, id_col, "left").filter(F.col("rings").isNotNull())
