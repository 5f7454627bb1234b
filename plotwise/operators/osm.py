"""OSM element handling: tag categories, element geometry, transit-line
members, and boundary polygons assembled from member ways."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.config import AMENITY_TAGS
from plotwise.operators.rings import valid_polygons


def tag_category(elements: DataFrame, categories: dict | None = None, tags: str = "tags",
                 out: str = "category", drop_unknown: bool = True) -> DataFrame:
    """First category (in order) whose tag pairs all match, else 'Unknown';
    name from tags (default 'N/A'); Unknown or coordinate-less rows dropped."""
    cats = AMENITY_TAGS if categories is None else categories
    expr = F.lit("Unknown")
    for name, pairs in reversed(list(cats.items())):
        cond = None
        for k, v in pairs.items():
            c = F.coalesce(F.col(tags)[k] == v, F.lit(False))
            cond = c if cond is None else cond & c
        expr = F.when(cond, F.lit(name)).otherwise(expr)
    df = elements.withColumns({out: expr, "name": F.coalesce(F.col(tags)["name"], F.lit("N/A"))})
    if drop_unknown:
        df = df.filter((F.col(out) != "Unknown") & F.col("coords").isNotNull() & (F.size("coords") > 0))
    return df


def coords_to_geometry(elements: DataFrame, coords: str = "coords", kind: str = "osm_type") -> DataFrame:
    """[lat, lon] lists → geometry (ARRAY<STRUCT<lon,lat>>) and its type:
    node → Point; relation with one pair → Point; way closed with ≥4 points →
    Polygon, ≥2 → LineString; anything else → NULL, and NULL rows dropped."""
    pts = F.transform(F.col(coords), lambda p: F.struct(p[1].alias("lon"), p[0].alias("lat")))
    n = F.size(F.col(coords))
    closed = (n >= 4) & (F.col(coords)[0] == F.element_at(F.col(coords), -1))
    gtype = (F.when(F.col(coords).isNull() | (n < 1), F.lit(None))
              .when(F.col(kind) == "node", F.lit("Point"))
              .when(F.col(kind) == "relation", F.when(n == 1, F.lit("Point")))
              .when(F.col(kind) == "way", F.when(closed, F.lit("Polygon")).when(n >= 2, F.lit("LineString"))))
    geom = F.when(gtype == "Point", F.slice(pts, 1, 1)).when(gtype.isNotNull(), pts)
    return elements.withColumns({"geom_type": gtype, "geometry": geom}).filter(F.col("geom_type").isNotNull())


def poi_first_coord(elements: DataFrame, coords: str = "coords") -> DataFrame:
    """Plot position: the first pair of the list (or the pair itself)."""
    first = F.col(coords)[0]
    return elements.filter(F.col(coords).isNotNull() & (F.size(coords) > 0)) \
                   .withColumns({"lat": first[0], "lon": first[1]})


def line_stations(members: DataFrame, nodes: DataFrame, rel_tags: DataFrame) -> DataFrame:
    """Ordered node members of each transit relation with their coordinates,
    name and ref, plus the relation's alt_name/name/from/to; rows without
    coordinates dropped; one row per (lat, lon), the first in (relation, pos)."""
    m = members.filter(F.col("member_type") == "node")
    j = (m.join(nodes, m["ref"] == nodes["node_id"], "inner")
          .join(rel_tags.withColumnRenamed("tags", "rtags"), "relation_id", "left"))
    j = j.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    j = j.select("relation_id", "pos", "node_id", "lat", "lon",
                 F.col("tags")["name"].alias("station_name"), F.col("tags")["ref"].alias("ref"),
                 F.col("rtags")["alt_name"].alias("line_alt_name"), F.col("rtags")["name"].alias("line_name"),
                 F.col("rtags")["from"].alias("line_from"), F.col("rtags")["to"].alias("line_to"))
    rest = [c for c in j.columns if c not in ("lat", "lon")]
    g = j.groupBy("lat", "lon").agg(F.min_by(F.struct(*rest), F.struct("relation_id", "pos")).alias("_r"))
    return g.select("lat", "lon", *[F.col(f"_r.{c}").alias(c) for c in rest])


# ---------------------------------------------------------------------------
# polygon assembly: one relation per group (its member ways; bounded by the
# relation, not by the data), stitched in pandas/NumPy via applyInPandas.
# ---------------------------------------------------------------------------

ASSEMBLY_SCHEMA = ("relation_id long, polygon_no int, ring_no int, role string, n_points int, "
                   "area double, ring array<struct<lon:double,lat:double>>")


def _stitch(ways: list[list[tuple[float, float]]]) -> tuple[list[list[tuple[float, float]]], list[list[tuple[float, float]]]]:
    """Join open ways end to end; returns (closed rings, lines that no way closes).
    Ends are looked up in a dict, so the work is linear in the member ways."""
    ways = [list(w) for w in ways if len(w) >= 2]
    at_end: dict[tuple[float, float], list[int]] = {}
    for i, w in enumerate(ways):
        at_end.setdefault(w[0], []).append(i)
        at_end.setdefault(w[-1], []).append(i)
    free = [True] * len(ways)

    def take(point):
        for i in at_end.get(point, ()):
            if free[i]:
                free[i] = False
                return ways[i] if ways[i][0] == point else ways[i][::-1]
        return None

    rings, open_lines = [], []
    for i, w in enumerate(ways):
        if not free[i]:
            continue
        free[i] = False
        cur = list(w)
        for _ in (0, 1):                    # grow at the end, then, turned round, at the start
            while cur[0] != cur[-1] and (nxt := take(cur[-1])) is not None:
                cur += nxt[1:]
            if cur[0] == cur[-1]:
                break
            cur.reverse()
        (rings if cur[0] == cur[-1] and len(cur) >= 4 else open_lines).append(cur)
    return rings, open_lines


def _signed_area(ring) -> float:
    s = 0.0
    for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
        s += x1 * y2 - x2 * y1
    return s / 2.0


def _inside(pt, ring) -> bool:
    x, y = pt
    inside = False
    for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def _assemble(pdf: pd.DataFrame) -> pd.DataFrame:
    rid = int(pdf["relation_id"].iloc[0])
    ways = {role: [[(float(p["lon"]), float(p["lat"])) for p in pts] for pts in grp["pts"]]
            for role, grp in pdf.groupby("role")}
    (outers, open_outer), (inners, open_inner) = _stitch(ways.get("outer", [])), _stitch(ways.get("inner", []))
    # rings that cross or touch themselves fall into valid ones; what a hole leaves out is land again
    polygons = [p for ring in outers for p in valid_polygons(ring)]
    holes_of = [p for ring in inners for p in valid_polygons(ring)]
    polygons += [(island[::-1], []) for _, islands in holes_of for island in islands]
    rows, free = [], [hole for hole, _ in holes_of]

    def row(polygon, ring_no, role, area, ring):
        rows.append((rid, polygon, ring_no, role, len(ring), area, [{"lon": x, "lat": y} for x, y in ring]))

    for pi, (outer, own) in enumerate(polygons):
        row(pi, 0, "outer", abs(_signed_area(outer)), outer)
        holes = own + [h for h in free if all(_inside(p, outer) for p in h)]
        free = [h for h in free if h not in holes]      # a hole belongs to the first outer ring that holds it wholly
        for hi, hole in enumerate(holes, start=1):
            row(pi, hi, "inner", -abs(_signed_area(hole)), hole if _signed_area(hole) <= 0 else hole[::-1])  # holes clockwise
    for k, (role, line) in enumerate([("stray inner", h) for h in free] + [("unclosed outer", x) for x in open_outer]
                                     + [("unclosed inner", x) for x in open_inner]):
        row(-1, k, role, None, line)
    return pd.DataFrame(rows, columns=["relation_id", "polygon_no", "ring_no", "role", "n_points", "area", "ring"])


def polygon_assembly(members: DataFrame) -> DataFrame:
    """Member ways (relation_id, role, pts) → one row per ring: outer rings
    counter-clockwise, holes clockwise with negative area, each hole in the
    first outer ring that holds it wholly. Rings that cross or touch themselves are made valid first (see ``rings``). What can't be used is reported as
    rows of polygon -1 without area: lines that no member way closes
    (``unclosed outer`` / ``unclosed inner``) and holes in no outer ring (``stray inner``)."""
    return members.select("relation_id", "role", "pts").groupBy("relation_id").applyInPandas(_assemble, ASSEMBLY_SCHEMA)


def member_ways(members: DataFrame, lines: DataFrame) -> DataFrame:
    """Way members of relations with their lines (way_id, line), as
    ``polygon_assembly`` takes them; members whose way is not in the extract are left out."""
    m = members.filter(F.col("member_type") == "way").select("relation_id", F.col("ref").alias("way_id"), "role")
    return m.join(lines, "way_id").select("relation_id", "way_id", "role", F.col("line").alias("pts"))
