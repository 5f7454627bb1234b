"""Planar geometry as Spark SQL higher-order functions (JVM, no UDF).

Geometries are plain columns:
* point  – two DOUBLE columns
* line   – ARRAY<STRUCT<lon DOUBLE, lat DOUBLE>> in vertex order
* rings  – ARRAY<line>; a polygon's outer ring and holes, closed; holes are
  handled by crossing parity, so a multipolygon is simply more rings

Builders return SQL text for ``F.expr`` so that the formulas are reusable
inside other lambdas (e.g. point-in-polygon at interval midpoints).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edges_sql(rings: str) -> str:
    """Every edge of every ring as STRUCT<x1,y1,x2,y2>."""
    return (f"flatten(transform({rings}, r -> transform(sequence(0, size(r) - 2), "
            f"i -> named_struct('x1', r[i].lon, 'y1', r[i].lat, 'x2', r[i + 1].lon, 'y2', r[i + 1].lat))))")


def pip_sql(x: str, y: str, edges: str) -> str:
    """Even–odd ray cast: TRUE when (x, y) lies inside (half-open edges)."""
    return (f"aggregate({edges}, false, (acc, e) -> IF(((e.y1 > {y}) <> (e.y2 > {y})) AND "
            f"({x} < (e.x2 - e.x1) * ({y} - e.y1) / (e.y2 - e.y1) + e.x1), NOT acc, acc))")


def point_in_polygon(x: str, y: str, rings: str) -> Column:
    return F.expr(pip_sql(x, y, edges_sql(rings)))


def seg_len_sql(ax: str, ay: str, bx: str, by: str) -> str:
    return f"sqrt(({bx} - {ax}) * ({bx} - {ax}) + ({by} - {ay}) * ({by} - {ay}))"


def seg_inside_len_sql(ax: str, ay: str, bx: str, by: str, edges: str) -> str:
    """Length of segment A→B inside the polygon: cut the segment at every
    edge crossing, keep the pieces whose midpoint is inside."""
    denom = f"(({bx} - {ax}) * (e.y2 - e.y1) - ({by} - {ay}) * (e.x2 - e.x1))"
    t = f"(((e.x1 - {ax}) * (e.y2 - e.y1) - (e.y1 - {ay}) * (e.x2 - e.x1)) / {denom})"
    u = f"(((e.x1 - {ax}) * ({by} - {ay}) - (e.y1 - {ay}) * ({bx} - {ax})) / {denom})"
    cuts = (f"filter(transform({edges}, e -> IF({denom} <> 0 AND {u} >= 0 AND {u} <= 1, {t}, NULL)), "
            f"t -> t IS NOT NULL AND t > 0 AND t < 1)")
    ts = f"array_sort(concat(array(0D, 1D), {cuts}))"
    mx = f"({ax} + (ts[i - 1] + ts[i]) / 2 * ({bx} - {ax}))"
    my = f"({ay} + (ts[i - 1] + ts[i]) / 2 * ({by} - {ay}))"
    inside = pip_sql(mx, my, edges)
    total = seg_len_sql(ax, ay, bx, by)
    # transform(array(v), ts -> ...)[0] binds the sorted cut list once
    return (f"transform(array({ts}), ts -> aggregate(sequence(1, size(ts) - 1), 0D, "
            f"(acc, i) -> acc + IF({inside}, (ts[i] - ts[i - 1]) * {total}, 0D)))[0]")


def line_length_sql(line: str) -> str:
    return (f"aggregate(sequence(1, size({line}) - 1), 0D, (acc, i) -> acc + "
            f"{seg_len_sql(f'{line}[i - 1].lon', f'{line}[i - 1].lat', f'{line}[i].lon', f'{line}[i].lat')})")


def line_centroid_sql(line: str) -> tuple[str, str]:
    """Length-weighted centroid (lon, lat); zero length → first vertex."""
    seg = seg_len_sql(f"{line}[i - 1].lon", f"{line}[i - 1].lat", f"{line}[i].lon", f"{line}[i].lat")
    total = line_length_sql(line)
    sx = (f"aggregate(sequence(1, size({line}) - 1), 0D, (acc, i) -> acc + {seg} * "
          f"({line}[i - 1].lon + {line}[i].lon) / 2)")
    sy = (f"aggregate(sequence(1, size({line}) - 1), 0D, (acc, i) -> acc + {seg} * "
          f"({line}[i - 1].lat + {line}[i].lat) / 2)")
    cx = f"IF({total} > 0, {sx} / {total}, {line}[0].lon)"
    cy = f"IF({total} > 0, {sy} / {total}, {line}[0].lat)"
    return cx, cy


def ring_area_centroid_sql(ring: str) -> tuple[str, str, str]:
    """Signed shoelace area and centroid (lon, lat) of one closed ring."""
    cross = f"({ring}[i].lon * {ring}[i + 1].lat - {ring}[i + 1].lon * {ring}[i].lat)"
    rng = f"sequence(0, size({ring}) - 2)"
    a2 = f"aggregate({rng}, 0D, (acc, i) -> acc + {cross})"
    cx = f"aggregate({rng}, 0D, (acc, i) -> acc + ({ring}[i].lon + {ring}[i + 1].lon) * {cross})"
    cy = f"aggregate({rng}, 0D, (acc, i) -> acc + ({ring}[i].lat + {ring}[i + 1].lat) * {cross})"
    area = f"({a2} / 2)"
    return area, f"({cx} / (3 * {a2}))", f"({cy} / (3 * {a2}))"
