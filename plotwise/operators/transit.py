"""Transit ridership: monthly origin–destination sums, station in/out tables,
and ridership of stations near each property in the property's month.

The property–station join is a grid equi-join in projected metres whose key
also carries the month, so (station × month) rows only meet properties of the
same month and the pairs × months product never materialises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.config import EXCLUDED_STATION_ID
from plotwise.functions.geo import utm_sql, utm_xy
from plotwise.operators.shapes import points_as_shapes, shape_join
from plotwise.operators.spatial import radius_join
from plotwise.sources.proxies import ALL_STATIONS


def monthly_ridership(od: DataFrame, since: str = "2022-01-01", date: str = "date") -> DataFrame:
    """Sum passengers by month ('yyyy-MM'), service, origin, destination.
    The date filter is on the raw column, so it reaches the parquet scan."""
    f = od.filter(F.col(date) >= F.lit(since).cast("timestamp_ntz")) if since else od
    return (f.withColumn("year_month", F.date_format(F.col(date), "yyyy-MM"))
             .groupBy("year_month", "service", "origin", "destination")
             .agg(F.sum("passengers").alias("passengers"))
             .withColumnRenamed("year_month", "date")
             .select("date", "service", "origin", "destination", "passengers"))


def all_station_filter(df: DataFrame, marker: str = ALL_STATIONS) -> DataFrame:
    return df.filter((F.col("origin") == marker) | (F.col("destination") == marker))


def station_outgoing(all_station: DataFrame) -> DataFrame:
    return (all_station.groupBy(F.col("origin").alias("station_name"), "date")
                       .agg(F.sum("passengers").alias("outgoing")))


def station_incoming(all_station: DataFrame) -> DataFrame:
    return (all_station.groupBy(F.col("destination").alias("station_name"), "date")
                       .agg(F.sum("passengers").alias("incoming")))


def ridership_in_out(monthly: DataFrame, marker: str = ALL_STATIONS) -> DataFrame:
    """outgoing ⟕ incoming on (station, month); missing → 0; integers."""
    a = all_station_filter(monthly, marker)
    out = station_outgoing(a).join(station_incoming(a), ["station_name", "date"], "left")
    return (out.fillna(0, subset=["incoming"])
               .select("station_name", "date", F.col("outgoing").cast("bigint").alias("outgoing"),
                       F.col("incoming").cast("bigint").alias("incoming")))


def exclude_station(df: DataFrame, col: str = "station_id", value: str = EXCLUDED_STATION_ID) -> DataFrame:
    """Drop one station id; NULL ids stay (pandas ``!=`` keeps NaN)."""
    return df.filter(~F.col(col).eqNullSafe(value))


def station_month_total(ridership: DataFrame) -> DataFrame:
    """Per (station_id, month): incoming, outgoing and their total. The
    month key becomes a DATE (first of month)."""
    r = ridership.withColumns({
        "station_id": F.split_part(F.col("station_name"), F.lit(":"), F.lit(1)),
        "date": F.to_date(F.concat(F.col("date"), F.lit("-01"))),
    })
    r = exclude_station(r)
    g = r.groupBy("station_id", "date").agg(F.sum("incoming").alias("incoming"), F.sum("outgoing").alias("outgoing"))
    return g.withColumn("total_ridership", F.col("incoming") + F.col("outgoing"))


RIDERSHIP_OUT = ["incoming_ridership_within_1km", "outgoing_ridership_within_1km", "total_ridership_within_1km"]


def ridership_near(props: DataFrame, stations: DataFrame, station_totals: DataFrame, radius_km: float = 1.0,
                   prop_id: str = "records_id", prop_date: str = "date", zone: int = 48,
                   lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Adds incoming/outgoing/total ridership of rail stations within
    ``radius_km`` (projected metres) whose month equals the property's month."""
    rail = stations.filter(F.col("feature_type") == "rail station")
    sr = rail.select("station_id", F.col(lat).alias("s_lat"), F.col(lon).alias("s_lon")).join(
        station_totals.select("station_id", F.col("date").alias("month"), "incoming", "outgoing", "total_ridership"),
        "station_id", "inner")  # stations without ridership can never match a month
    sx, sy = utm_xy("s_lat", "s_lon", zone)
    sr = sr.select("station_id", "month", "incoming", "outgoing", "total_ridership",
                   sx.alias("s_x"), sy.alias("s_y"))
    px, py = utm_xy(lat, lon, zone)
    # sales of one month at one point share their sums: each distinct (point, month) is searched once
    p = props.select(F.col(lat).alias("_plat"), F.col(lon).alias("_plon"), F.col(prop_date).cast("date").alias("month"),
                     px.alias("p_x"), py.alias("p_y")).distinct()
    pairs = radius_join(p, sr, radius_km * 1000.0, "planar", "p_y", "p_x", "s_y", "s_x", extra_keys=["month"])
    sums = pairs.groupBy("_plat", "_plon", F.col("month").alias("_pmonth")).agg(
        F.sum("incoming").alias(RIDERSHIP_OUT[0]), F.sum("outgoing").alias(RIDERSHIP_OUT[1]),
        F.sum("total_ridership").alias(RIDERSHIP_OUT[2]))
    here = (F.col(lat) == F.col("_plat")) & (F.col(lon) == F.col("_plon")) & (F.col(prop_date).cast("date") == F.col("_pmonth"))
    return props.join(sums, here, "left").drop("_plat", "_plon", "_pmonth").fillna(0, subset=RIDERSHIP_OUT)


def _projected(shapes: DataFrame, zone: int) -> DataFrame:
    """Shapes with every vertex in UTM metres."""
    x, y = utm_sql("v.lat", "v.lon", zone)
    return shapes.withColumn("parts", F.expr(f"transform(parts, p -> transform(p, v -> named_struct('lon', {x}, 'lat', {y})))"))


def ridership_near_roads(props: DataFrame, roads: DataFrame, stations: DataFrame, station_totals: DataFrame,
                         radius_km: float = 1.0, road_id: str = "way_id", station: str = "osm_id",
                         prop_date: str = "date", zone: int = 48) -> DataFrame:
    """``ridership_near`` from the line (``parts``) of each sale's road, in
    projected metres. Roads meet stations once, whatever the months; sales of a
    road in one month share their sums. A sale whose road has no line gets 0."""
    sx, sy = utm_xy("lat", "lon", zone)
    rail = (stations.filter(F.col("feature_type") == "rail station")
                    .select(F.col(station).alias("_station"), "station_id", sx.alias("s_x"), sy.alias("s_y")))
    near = shape_join(_projected(roads, zone), points_as_shapes(rail, "s_y", "s_x"), radius_km * 1000.0, road_id, "_station")
    at = near.join(rail.select("_station", "station_id"), "_station").select(road_id, "station_id")
    wanted = props.select(road_id, F.col(prop_date).cast("date").alias("_pmonth")).distinct()
    totals = station_totals.select("station_id", F.col("date").alias("_pmonth"), "incoming", "outgoing", "total_ridership")
    sums = (wanted.join(at, road_id).join(totals, ["station_id", "_pmonth"]).groupBy(road_id, "_pmonth")
                  .agg(*[F.sum(c).alias(name) for c, name in zip(("incoming", "outgoing", "total_ridership"), RIDERSHIP_OUT)]))
    return (props.withColumn("_pmonth", F.col(prop_date).cast("date")).join(sums, [road_id, "_pmonth"], "left")
                 .drop("_pmonth").fillna(0, subset=RIDERSHIP_OUT))


def ridership_profile(df: DataFrame) -> DataFrame:
    """Count and share of properties with ridership; avg/max among them."""
    t = F.col(RIDERSHIP_OUT[2])
    has = t > 0
    aggs = [F.count_if(has).alias("n_with_ridership"),
            (F.count_if(has) / F.count(F.lit(1)) * 100.0).alias("pct_with_ridership")]
    for c, short in zip(RIDERSHIP_OUT, ("incoming", "outgoing", "total")):
        aggs += [F.avg(F.when(has, F.col(c))).alias(f"avg_{short}"), F.max(F.when(has, F.col(c))).alias(f"max_{short}")]
    return df.agg(*aggs)


def ridership_gap_check(df: DataFrame, exclude_ids: list[str], train_ids: str = "train_ids") -> DataFrame:
    """Properties with stations nearby but zero ridership and no excluded
    station among their ids, counted per id list (most frequent first)."""
    ids = F.transform(F.split(F.col(train_ids), ","), lambda x: F.btrim(x))
    excluded = F.array(*[F.lit(str(i)) for i in exclude_ids]) if exclude_ids else F.array().cast("array<string>")
    mask = ((F.col(train_ids) != "") & (F.col(RIDERSHIP_OUT[2]) == 0)
            & ~F.coalesce(F.arrays_overlap(ids, excluded), F.lit(False)))
    return df.filter(mask).groupBy(train_ids).agg(F.count(F.lit(1)).alias("count"))


def date_overlap(props: DataFrame, station_totals: DataFrame, prop_date: str = "date") -> DataFrame:
    """Distinct months present in both property and ridership data."""
    return (props.select(F.col(prop_date).cast("date").alias("date"))
                 .intersect(station_totals.select(F.col("date").cast("date").alias("date"))))
