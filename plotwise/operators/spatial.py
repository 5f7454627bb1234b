"""Spatial joins as equi-joins on grid cells.

Spark has no spatial index join, and a theta join on distance would plan as a
nested loop. Instead both sides get a cell key; the side expected to be smaller
is exploded into the 3×3 block of cells around it; the join is an equi-join on
(row, col), sort-merged: an exploded side has nine times the rows that Spark's estimate
from file sizes knows of, so a broadcast of it would fill the driver. The exact distance test runs after it. A cell is at least the search
radius wide, so no pair within the radius is missed and each pair meets once.

Metrics:
* ``degrees``   – planar distance in lat/lon degrees (EPSG:4326 buffers)
* ``haversine`` – great-circle km; longitude cells widen with latitude
* ``planar``    – projected coordinates (e.g. UTM metres)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.geo import (KM_PER_DEG_LAT, degree_dist_sql,
                                    haversine_sql, lon_cell_width_deg)

METRICS = ("degrees", "haversine", "planar")


def _dist_sql(metric: str, la1: str, lo1: str, la2: str, lo2: str) -> str:
    if metric == "haversine":
        return haversine_sql(la1, lo1, la2, lo2)
    if metric in ("degrees", "planar"):
        return degree_dist_sql(la1, lo1, la2, lo2)
    raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")


def _cell_size(metric: str, radius: float) -> float:
    if radius <= 0:
        raise ValueError("radius must be positive")
    if metric == "haversine":
        return radius / KM_PER_DEG_LAT * 1.001
    return radius


def _home_cell(metric: str, cell: float, y: Column, x: Column) -> tuple[Column, Column]:
    row = F.floor(y / cell)
    if metric == "haversine":
        w = lon_cell_width_deg(cell, row)
        ncols = F.ceil(F.lit(360.0) / w)
        col = F.pmod(F.floor((x + 180.0) / w), ncols)
        return row, col
    return row, F.floor(x / cell)


def _block_cells(metric: str, cell: float, y: Column, x: Column) -> Column:
    """ARRAY<STRUCT<cell_r, cell_c>> of the 3×3 block around a point."""
    row = F.floor(y / cell)
    offs = F.array(F.lit(-1), F.lit(0), F.lit(1))

    def per_row(dr):
        r = row + dr
        if metric == "haversine":
            w = lon_cell_width_deg(cell, r)
            ncols = F.ceil(F.lit(360.0) / w)
            c = F.floor((x + 180.0) / w)
            return F.transform(offs, lambda dc: F.struct(r.alias("cell_r"), F.pmod(c + dc, ncols).alias("cell_c")))
        c = F.floor(x / cell)
        return F.transform(offs, lambda dc: F.struct(r.alias("cell_r"), (c + dc).alias("cell_c")))

    cells = F.flatten(F.transform(offs, per_row))
    return F.array_distinct(cells) if metric == "haversine" else cells


def radius_join(left: DataFrame, right: DataFrame, radius: float, metric: str = "degrees",
                left_lat: str = "lat", left_lon: str = "lon",
                right_lat: str = "r_lat", right_lon: str = "r_lon",
                dist_col: str = "dist", extra_keys: list[str] | None = None) -> DataFrame:
    """All (left, right) pairs within ``radius``; ``right`` is the exploded side.

    Column names of the two sides must be disjoint (join keys in
    ``extra_keys`` excepted, e.g. a month that must also match). Returns
    every column of both sides plus ``dist_col``.
    """
    cell = _cell_size(metric, radius)
    extra_keys = extra_keys or []
    r_, c_ = _home_cell(metric, cell, F.col(left_lat), F.col(left_lon))
    lhs = left.withColumns({"cell_r": r_, "cell_c": c_})
    rhs = (right.withColumn("_cell", F.explode(_block_cells(metric, cell, F.col(right_lat), F.col(right_lon))))
                .withColumns({"cell_r": F.col("_cell.cell_r"), "cell_c": F.col("_cell.cell_c")})
                .drop("_cell"))
    keys = ["cell_r", "cell_c"] + extra_keys
    d = F.expr(_dist_sql(metric, left_lat, left_lon, right_lat, right_lon))
    return (lhs.join(rhs.hint("merge"), on=keys, how="inner")
               .withColumn(dist_col, d)
               .filter(F.col(dist_col) <= radius)
               .drop("cell_r", "cell_c"))


def _extent(df: DataFrame, la: str, lo: str):
    return df.agg(F.min(la).alias("a"), F.max(la).alias("b"), F.min(lo).alias("c"), F.max(lo).alias("d"),
                  F.count(F.lit(1)).alias("n")).first()


def nearest(points: DataFrame, targets: DataFrame, point_id: str, metric: str = "haversine",
            start_radius: float = 1.0, lat: str = "lat", lon: str = "lon",
            t_lat: str = "r_lat", t_lon: str = "r_lon", group_col: str | None = None,
            dist_col: str = "dist", checkpoint: bool = True, target_id: str | None = None) -> DataFrame:
    """Distance from each point to its nearest target (per ``group_col`` if given).

    Expanding rings: at radius r the 3×3 cell block holds every target within
    r, so a point whose best candidate is ≤ r is final. Unresolved points go on
    with 2r. Once r spans the joint bounding box of points and targets the
    block covers every target, so the last round is exact for all the rest.
    Points and targets stacked on one place are searched as one.
    Each round's results and survivors are checkpointed to the shared checkpoint dir, so
    lineage stays short and a lost executor recomputes one round only.
    Returns (point_id[, group_col], dist[, target_id]) for pairs that have a
    target (``target_id``: the nearest one, ties → smallest id); callers
    left-join and fill the rest.
    """
    gkeys = [group_col] if group_col else []
    schema_cols = [lat, lon] + gkeys
    places = targets.groupBy(*gkeys, t_lat, t_lon)
    tg = places.agg(F.min(target_id).alias(target_id)) if target_id else places.agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    spots = points.select(lat, lon).distinct()
    if checkpoint:
        tg, spots = tg.checkpoint(), spots.checkpoint()
    p_ext, t_ext = _extent(spots, lat, lon), _extent(tg, t_lat, t_lon)
    if t_ext is None or t_ext["a"] is None or p_ext is None or p_ext["a"] is None:
        empty = points.select(point_id).limit(0)
        if group_col:
            empty = empty.withColumn(group_col, F.lit(None).cast("string"))
        empty = empty.withColumn(dist_col, F.lit(None).cast("double"))
        return empty.withColumn(target_id, F.lit(None).cast("bigint")) if target_id else empty
    span_deg = (max(p_ext["b"], t_ext["b"]) - min(p_ext["a"], t_ext["a"])
                + max(p_ext["d"], t_ext["d"]) - min(p_ext["c"], t_ext["c"]))
    span = span_deg * KM_PER_DEG_LAT * 1.05 if metric == "haversine" else span_deg * 1.05
    span = max(span, start_radius)
    # start near the radius that holds ~one target per group if spread evenly
    tw = (t_ext["b"] - t_ext["a"]) * (t_ext["d"] - t_ext["c"])
    per_group = max(t_ext["n"] / 6.0 if group_col else t_ext["n"], 1.0)
    dens = (tw / per_group) ** 0.5 * (KM_PER_DEG_LAT if metric == "haversine" else 1.0)
    start_radius = min(max(start_radius, dens), span)

    pending = spots
    if group_col:
        # category list: bounded and small, collected as a scalar list
        values = sorted(r[0] for r in tg.select(group_col).distinct().collect() if r[0] is not None)
        pending = pending.withColumn(group_col, F.explode(F.array(*[F.lit(v) for v in values])))
    resolved: list[DataFrame] = []
    r = start_radius
    while True:
        last = r >= span
        cand = radius_join(pending, tg, r, metric, lat, lon, t_lat, t_lon, dist_col, extra_keys=gkeys)
        if target_id:
            best = (cand.groupBy(*schema_cols).agg(F.min(F.struct(dist_col, target_id)).alias("_b"))
                        .select(*schema_cols, F.col(f"_b.{dist_col}").alias(dist_col), F.col(f"_b.{target_id}").alias(target_id)))
        else:
            best = cand.groupBy(*schema_cols).agg(F.min(dist_col).alias(dist_col))
        if last:
            resolved.append(best)
            break
        done = best.filter(F.col(dist_col) <= r)
        if checkpoint:
            done = done.checkpoint(eager=True)
        resolved.append(done)
        # one anti-join per round (rounds ≤ log2(span / start)); both sides are checkpointed
        pending = pending.join(done.select(*schema_cols), schema_cols, "left_anti")
        if checkpoint:
            pending = pending.checkpoint(eager=True)
        if pending.isEmpty():
            break
        r = min(r * 2.0, span)
    out = resolved[0]
    for d in resolved[1:]:
        out = out.unionByName(d)
    told = points.select(F.col(point_id).alias("_id"), F.col(lat).alias("_la"), F.col(lon).alias("_lo")).distinct() \
                 .join(out, (F.col("_la") == F.col(lat)) & (F.col("_lo") == F.col(lon))) \
                 .groupBy(F.col("_id").alias(point_id), *gkeys).agg(F.min(F.struct(dist_col, *([target_id] if target_id else []))).alias("_b"))
    return told.select(point_id, *gkeys, "_b.*")
