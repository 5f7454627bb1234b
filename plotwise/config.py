"""Fixed values that results depend on.

FIXED VALUES (must equal the reference's for equal results): feature column
lists, amenity types and their OSM tags, default thresholds, cluster prefixes,
price bands, validation ranges. Stated plainly, in their natural order.
"""

# --- feature columns -------------------------------------------------------
DISTANCE_COLS = [
    "walk_dist_to_mall", "walk_dist_to_school", "walk_dist_to_park",
    "walk_dist_to_river", "walk_dist_to_lake", "walk_dist_to_rail_station",
    "dist_to_mall", "dist_to_school", "dist_to_park",
    "dist_to_river", "dist_to_lake", "dist_to_rail_station",
]
COUNT_COLS = [
    "mall_count", "school_count", "park_count",
    "river_count", "lake_count", "rail_station_count",
]
PROPERTY_COLS = ["property_m2", "unit_level"]
RIDERSHIP_COLS = ["incoming_ridership_within_1km", "outgoing_ridership_within_1km"]
CONTINUOUS_FEATURES = PROPERTY_COLS + DISTANCE_COLS + COUNT_COLS + RIDERSHIP_COLS
CATEGORICAL_FEATURES = ["property_type", "market_cluster_id", "freehold", "transit", "district"]
COLUMNS_TO_DROP = [
    "records_id", "geometry", "x_coord", "y_coord", "way_id", "train_ids",
    "Unnamed: 0", "date", "mukim", "road_name", "scheme_name",
    "market_cluster", "clustering_method", "is_noise",
    "transaction_price", "land_m2", "total_ridership_within_1km",
]
TARGET = "price_m2"

# --- amenities -------------------------------------------------------------
AMENITY_TYPES = ["mall", "school", "park", "river", "lake", "rail station"]
# category -> tag pairs that must all match (notebook defaults)
AMENITY_TAGS = {
    "school": {"amenity": "school"},
    "mall": {"shop": "supermarket"},
    "park": {"leisure": "park"},
    "river": {"waterway": "river"},
    "lake": {"natural": "water", "water": "lake"},
    "rail station": {"railway": "station"},
}
AMENITY_RADIUS_KM = 1.0
TRAIN_TYPE_NAME = "rail station"
EXCLUDED_STATION_ID = "A0"
ALL_STATIONS_MARKER = "A0"

# --- fills, splits, seeds --------------------------------------------------
MAX_DISTANCE_KM = 21.0
TEMPORAL_SPLIT_YEAR = 2025
RANDOM_STATE = 42
TEST_SIZE = 0.3
CV_FOLDS = 10

# --- clustering ------------------------------------------------------------
DBSCAN_EPS_PERCENTILE_MIN = 0.90
DBSCAN_EPS_PERCENTILE_MAX = 0.95
DBSCAN_MIN_SAMPLES = 5
DBSCAN_MAX_NOISE_THRESHOLD = 0.15
KMEANS_N_CLUSTERS = 238
CLUSTER_PREFIXES = {
    "gombak": "GO",
    "hulu langat": "HU",
    "hulu selangor": "HU",
    "kuala lumpur": "KL",
    "kuala langat": "KU",
    "kuala selangor": "KU",
    "petaling": "PE",
    "putrajaya": "PU",
    "sabak bernam": "SA",
    "sepang": "SE",
    "klang": "KL",
}
UNKNOWN_PREFIX = "XX"
NOISE_LABEL = "NOISE"

# --- validation ranges (feature -> (min, max)) -------------------------------
DEFAULT_FEATURE_RANGES = {
    "property_m2": (10, 10000),
    "unit_level": (0, 100),
    "price_m2": (100, 200000),
}
DISTANCE_RANGE = (0, 50)
LAT_RANGE = (1.0, 7.0)
LON_RANGE = (99.0, 120.0)

# --- evaluation ------------------------------------------------------------
PRICE_BANDS = [("Budget", 0.0, 3000.0), ("Mid-tier", 3000.0, 8000.0), ("Luxury", 8000.0, float("inf"))]
ZERO_EPS = 1e-10
TOLERANCE = 0.15

# --- geodesy ---------------------------------------------------------------
EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_M = 6371000.0
KM_PER_DEGREE = 111.0  # the reference's buffer rule: radius_km / 111 degrees

# --- geocoding bbox (lat_min, lat_max, lon_min, lon_max) --------------------
GEOCODE_BBOX = (2.553, 3.716, 100.841, 102.39)
ROAD_SEARCH_RADIUS_M = 50.0
