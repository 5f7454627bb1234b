"""Scalar cleaning: projections, casts and row-local fixes.

All operators are ``DataFrame -> DataFrame`` column expressions: they stay in
whole-stage codegen, need no shuffle, and push nothing through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotwise.config import COLUMNS_TO_DROP

# FIXED VALUE: characters Python's str.strip() removes for ASCII text
WHITESPACE = " \t\n\r\x0b\x0c"


def clean_price_m2(df: DataFrame, price: str = "transaction_price", land: str = "land_m2",
                   out: str = "price_m2") -> DataFrame:
    """price per land m²; zero land → NULL, ±inf → NULL, negative land still divides."""
    if out in df.columns:
        df = df.drop(out)
    if price not in df.columns or land not in df.columns:
        return df
    q = F.try_divide(F.col(price).cast("double"), F.col(land).cast("double"))
    q = F.when(F.col(land) == 0, F.lit(None).cast("double")).otherwise(q)
    return df.withColumn(out, F.when(F.abs(q) == float("inf"), F.lit(None).cast("double")).otherwise(q))


def clean_unit_level(df: DataFrame, col: str = "unit_level") -> DataFrame:
    """Negative floors → 0; NULL stays NULL."""
    if col not in df.columns:
        return df
    c = F.col(col)
    return df.withColumn(col, F.when(c < 0, F.lit(0).cast(df.schema[col].dataType)).otherwise(c))


def drop_redundant(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = COLUMNS_TO_DROP if columns is None else columns
    return df.drop(*[c for c in names if c in df.columns])


def clean_property_data(df: DataFrame) -> DataFrame:
    """The reference's cleaning step: price by land area, floors, drops."""
    return df.transform(clean_price_m2).transform(clean_unit_level).transform(drop_redundant)


def rescale_area(df: DataFrame, cols: tuple[str, ...] = ("property_m2", "land_m2"), factor: float = 100.0) -> DataFrame:
    return df.withColumns({c: F.col(c) / factor for c in cols if c in df.columns})


def np_round(c: Column, digits: int) -> Column:
    """NumPy/pandas rounding: scale, round half to even, unscale."""
    s = float(10 ** digits)
    return F.rint(c * s) / s


def price_per_property_m2(df: DataFrame, price: str = "transaction_price", area: str = "property_m2",
                          out: str = "price_m2") -> DataFrame:
    q = F.try_divide(F.col(price).cast("double"), F.col(area).cast("double"))
    return df.withColumn(out, np_round(q, 2))


def flag_freehold(df: DataFrame, tenure: str = "tenure", out: str = "freehold") -> DataFrame:
    """1 where tenure is exactly 'Freehold' (tested before lower-casing), else 0."""
    return df.withColumn(out, F.coalesce((F.col(tenure) == "Freehold").cast("int"), F.lit(0)))


def standardise_strings(df: DataFrame, skip: tuple[str, ...] = ("geometry",)) -> DataFrame:
    """Strip surrounding whitespace and lower-case every string column."""
    cols = {f.name: F.lower(F.btrim(F.col(f.name), F.lit(WHITESPACE)))
            for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip}
    return df.withColumns(cols) if cols else df


def parse_dates(df: DataFrame, cols: tuple[str, ...] = ("date",), fmt: str | None = None) -> DataFrame:
    conv = {}
    for c in cols:
        if c not in df.columns:
            continue
        src = F.col(c).cast("string") if fmt is None else F.col(c)
        ts = F.try_to_timestamp(src) if fmt is None else F.try_to_timestamp(src, F.lit(fmt))
        conv[c] = ts.cast("timestamp_ntz")  # wall-clock time, independent of the session zone
    return df.withColumns(conv) if conv else df


def month_key(df: DataFrame, col: str = "date", out: str = "year_month") -> DataFrame:
    return df.withColumn(out, F.date_format(F.col(col), "yyyy-MM"))


def split_station_id(df: DataFrame, col: str = "station_name", out: str = "station_id") -> DataFrame:
    return df.withColumn(out, F.split_part(F.col(col), F.lit(":"), F.lit(1)))


def parse_coordinate(df: DataFrame, col: str = "coordinates", lat: str = "lat", lon: str = "lon",
                     ok: str = "coord_parsed") -> DataFrame:
    """"lat, lon" text → two doubles; anything else → NULLs and ``ok`` false."""
    parts = F.split(F.col(col), ",")
    two = F.size(parts) == 2
    la = F.when(two, F.expr(f"try_cast(btrim(element_at(split({col}, ','), 1)) AS DOUBLE)"))
    lo = F.when(two, F.expr(f"try_cast(btrim(element_at(split({col}, ','), 2)) AS DOUBLE)"))
    good = la.isNotNull() & lo.isNotNull()
    return df.withColumns({lat: F.when(good, la), lon: F.when(good, lo), ok: F.coalesce(good, F.lit(False))})


def rename_prefix(df: DataFrame, old: str = "dist_to_", new: str = "walk_dist_to_") -> DataFrame:
    mapping = {c: new + c[len(old):] for c in df.columns if c.startswith(old)}
    return df.withColumnsRenamed(mapping) if mapping else df


def resolve_suffixes(df: DataFrame, round_prefix: str = "dist_to", digits: int = 4) -> DataFrame:
    """Drop ``*_y`` columns, strip ``_x``, round distance columns to 4 places."""
    df = df.drop(*[c for c in df.columns if c.endswith("_y")])
    df = df.withColumnsRenamed({c: c[:-2] for c in df.columns if c.endswith("_x")})
    return df.withColumns({c: np_round(F.col(c), digits) for c in df.columns if round_prefix in c})


def log1p_target(df: DataFrame, col: str = "price_m2", out: str = "log_price_m2") -> DataFrame:
    return df.withColumn(out, F.log1p(F.col(col)))


def expm1_prediction(df: DataFrame, col: str = "prediction_log", out: str = "prediction") -> DataFrame:
    return df.withColumn(out, F.expm1(F.col(col)))


def clip_prediction(df: DataFrame, col: str = "prediction", mode: str = "reference") -> DataFrame:
    """``reference``: if any prediction ≤ 0, every prediction becomes max(p, 1)
    (one scalar subquery decides). ``row``: only rows ≤ 0 become 1."""
    p = F.col(col)
    if mode == "row":
        return df.withColumn(col, F.when(p <= 0, F.lit(1.0)).otherwise(p))
    if mode != "reference":
        raise ValueError(f"unknown clip mode {mode!r}")
    any_nonpos = df.select(F.coalesce(F.bool_or(p <= 0), F.lit(False))).scalar()
    return df.withColumn(col, F.when(any_nonpos & p.isNotNull(), F.greatest(p, F.lit(1.0))).otherwise(p))
