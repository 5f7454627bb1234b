"""Ridership chain: §2.5 monthly sums, §2.4 ridership joins, §2.7 date overlap."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.config import KM_PER_DEGREE
from plotwise.functions.geo import utm_sql
from plotwise.operators import transit
from plotwise.operators.amenities import radius_count
from plotwise.plans.common import SQL, deg, sig_sql, with_views
from plotwise.plans.registry import query
from plotwise.sources import proxies
from plotwise.sources.proxies import ALL_STATIONS

SINCE = "1996-01-01"
RADIUS_KM = 1.0
EXCLUDE_IDS = ["3", "17"]


def _deg_lit(km: float) -> str:
    return f"{km / KM_PER_DEGREE:.17e}"


SQL["monthly"] = f"""
SELECT strftime(date, '%Y-%m') AS date, service, origin, destination, sum(passengers) AS passengers
FROM od_ridership WHERE date >= TIMESTAMP '{SINCE}' GROUP BY ALL"""
SQL["alls"] = f"SELECT * FROM monthly WHERE origin = '{ALL_STATIONS}' OR destination = '{ALL_STATIONS}'"
SQL["outg"] = "SELECT origin AS station_name, date, sum(passengers) AS outgoing FROM alls GROUP BY ALL"
SQL["inc"] = "SELECT destination AS station_name, date, sum(passengers) AS incoming FROM alls GROUP BY ALL"
SQL["ridership"] = """
SELECT o.station_name, o.date, CAST(o.outgoing AS BIGINT) AS outgoing, CAST(coalesce(i.incoming, 0) AS BIGINT) AS incoming
FROM outg o LEFT JOIN inc i USING (station_name, date)"""
SQL["st"] = """
SELECT station_id, date, incoming, outgoing, incoming + outgoing AS total_ridership
FROM (SELECT split_part(station_name, ':', 1) AS station_id, CAST(date || '-01' AS DATE) AS date,
             CAST(sum(incoming) AS BIGINT) AS incoming, CAST(sum(outgoing) AS BIGINT) AS outgoing
      FROM ridership WHERE split_part(station_name, ':', 1) IS DISTINCT FROM 'A0' GROUP BY ALL)"""
_RIDER_VIEWS = ("od_ridership", "monthly", "alls", "outg", "inc", "ridership", "st")

_sx, _sy = utm_sql("r.lat", "r.lon")
_px, _py = utm_sql("lat", "lon")
SQL["near_sums"] = f"""
SELECT records_id, CAST(sum(incoming) AS BIGINT) AS inc, CAST(sum(outgoing) AS BIGINT) AS outg,
       CAST(sum(total_ridership) AS BIGINT) AS tot
FROM (SELECT records_id, date AS month, {_px} AS p_x, {_py} AS p_y FROM properties) p
JOIN (SELECT r.station_id, st.date AS month, incoming, outgoing, total_ridership, {_sx} AS s_x, {_sy} AS s_y
      FROM stations r JOIN st USING (station_id) WHERE r.feature_type = 'rail station') s
  ON p.month = s.month AND {deg('p.p_y', 'p.p_x', 's.s_y', 's.s_x')} <= {RADIUS_KM * 1000.0}
GROUP BY records_id"""
SQL["near"] = """
SELECT records_id, coalesce(inc, 0) AS incoming_ridership_within_1km, coalesce(outg, 0) AS outgoing_ridership_within_1km,
       coalesce(tot, 0) AS total_ridership_within_1km
FROM properties LEFT JOIN near_sums USING (records_id)"""


def monthly(spark, sf):
    return transit.monthly_ridership(proxies.od_ridership(spark, sf), since=SINCE)


def ridership(spark, sf):
    return transit.ridership_in_out(monthly(spark, sf))


def station_totals(spark, sf):
    return transit.station_month_total(ridership(spark, sf))


def near(spark, sf):
    props = proxies.properties(spark, sf).select("records_id", "date", "lat", "lon")
    return transit.ridership_near(props, proxies.stations(spark, sf), station_totals(spark, sf), RADIUS_KM)


@query("scan_parquet_month_filter", with_views(f"""
SELECT date, service, origin, destination, passengers FROM od_ridership WHERE date >= TIMESTAMP '{SINCE}'""",
                                               "od_ridership"))
def q_scan_parquet_month_filter(spark, sf):
    od = proxies.od_ridership(spark, sf)
    return od.filter(F.col("date") >= F.lit(SINCE).cast("timestamp_ntz"))


@query("monthly_ridership", with_views("\nSELECT * FROM monthly", "od_ridership", "monthly"))
def q_monthly_ridership(spark, sf):
    return monthly(spark, sf)


@query("station_outgoing", with_views("\nSELECT * FROM outg", "od_ridership", "monthly", "alls", "outg"))
def q_station_outgoing(spark, sf):
    return transit.station_outgoing(transit.all_station_filter(monthly(spark, sf)))


@query("station_incoming", with_views("\nSELECT * FROM inc", "od_ridership", "monthly", "alls", "inc"))
def q_station_incoming(spark, sf):
    return transit.station_incoming(transit.all_station_filter(monthly(spark, sf)))


@query("ridership_in_out", with_views("\nSELECT * FROM ridership", "od_ridership", "monthly", "alls", "outg",
                                      "inc", "ridership"))
def q_ridership_in_out(spark, sf):
    return ridership(spark, sf)


@query("exclude_station", with_views("""
SELECT station_name, date, split_part(station_name, ':', 1) AS station_id, outgoing, incoming FROM ridership
WHERE split_part(station_name, ':', 1) IS DISTINCT FROM 'A0'""", "od_ridership", "monthly", "alls", "outg",
                                     "inc", "ridership"))
def q_exclude_station(spark, sf):
    r = ridership(spark, sf).withColumn("station_id", F.split_part("station_name", F.lit(":"), F.lit(1)))
    return transit.exclude_station(r)


@query("station_month_total", with_views("\nSELECT * FROM st", *_RIDER_VIEWS))
def q_station_month_total(spark, sf):
    return station_totals(spark, sf)


@query("ridership_near", with_views("\nSELECT * FROM near", "properties", "stations", *_RIDER_VIEWS,
                                    "near_sums", "near"))
def q_ridership_near(spark, sf):
    return near(spark, sf).select("records_id", *transit.RIDERSHIP_OUT)


@query("ridership_profile", with_views(f"""
SELECT count_if(total_ridership_within_1km > 0) AS n_with_ridership,
       count_if(total_ridership_within_1km > 0) / count(*) * 100.0 AS pct_with_ridership,
       {sig_sql('avg(incoming_ridership_within_1km) FILTER (WHERE total_ridership_within_1km > 0)')} AS avg_incoming,
       max(incoming_ridership_within_1km) FILTER (WHERE total_ridership_within_1km > 0) AS max_incoming,
       {sig_sql('avg(outgoing_ridership_within_1km) FILTER (WHERE total_ridership_within_1km > 0)')} AS avg_outgoing,
       max(outgoing_ridership_within_1km) FILTER (WHERE total_ridership_within_1km > 0) AS max_outgoing,
       {sig_sql('avg(total_ridership_within_1km) FILTER (WHERE total_ridership_within_1km > 0)')} AS avg_total,
       max(total_ridership_within_1km) FILTER (WHERE total_ridership_within_1km > 0) AS max_total
FROM near""", "properties", "stations", *_RIDER_VIEWS, "near_sums", "near"))
def q_ridership_profile(spark, sf):
    r = transit.ridership_profile(near(spark, sf))
    return r.withColumns({c: F.expr(f"`{c}`") for c in r.columns}).transform(
        lambda d: d.withColumns({c: _sig(c) for c in ("avg_incoming", "avg_outgoing", "avg_total")}))


def _sig(c):
    from plotwise.functions.numeric import sig
    return sig(F.col(c))


@query("ridership_gap_check", with_views(f"""
, pairs AS (SELECT p.records_id, s.osm_id FROM properties p JOIN stations s
            ON {deg('p.lat', 'p.lon', 's.lat', 's.lon')} <= {_deg_lit(RADIUS_KM)}),
tid AS (SELECT records_id,
               array_to_string(list_transform(list_sort(list_distinct(list(osm_id))), lambda x: CAST(x AS VARCHAR)), ', ')
               AS train_ids FROM pairs GROUP BY records_id),
j AS (SELECT n.records_id, coalesce(t.train_ids, '') AS train_ids, n.total_ridership_within_1km
      FROM near n LEFT JOIN tid t USING (records_id))
SELECT train_ids, count(*) AS count FROM j
WHERE train_ids <> '' AND total_ridership_within_1km = 0
  AND NOT list_has_any(list_transform(string_split(train_ids, ','), lambda x: trim(x)), {EXCLUDE_IDS!r})
GROUP BY train_ids""", "properties", "stations", *_RIDER_VIEWS, "near_sums", "near"))
def q_ridership_gap_check(spark, sf):
    st = proxies.stations(spark, sf)
    props = near(spark, sf)
    counted = radius_count(props, st, radius_km=RADIUS_KM, metric="degrees", types=["rail station"])
    return transit.ridership_gap_check(counted, EXCLUDE_IDS)


@query("date_overlap", with_views("""
SELECT DISTINCT date FROM properties INTERSECT SELECT date FROM st""", "properties", *_RIDER_VIEWS))
def q_date_overlap(spark, sf):
    return transit.date_overlap(proxies.properties(spark, sf), station_totals(spark, sf))
