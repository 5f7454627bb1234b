"""Shared pieces of the registered queries and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.functions.geo import degree_dist_sql, haversine_sql
from plotwise.functions.numeric import sig, sig_sql
from plotwise.sources.proxies import SQL, with_views

__all__ = ["F", "SQL", "with_views", "sig", "sig_sql", "hav", "deg", "npround_sql", "sig_cols"]


def hav(la1: str, lo1: str, la2: str, lo2: str) -> str:
    return haversine_sql(la1, lo1, la2, lo2)


def deg(la1: str, lo1: str, la2: str, lo2: str) -> str:
    return degree_dist_sql(la1, lo1, la2, lo2)


def npround_sql(expr: str, digits: int) -> str:
    s = float(10 ** digits)
    return f"(round_even(({expr}) * {s!r}, 0) / {s!r})"


def sig_cols(df, cols, digits: int = 10):
    """Round the named double columns to ``digits`` significant digits."""
    return df.withColumns({c: sig(F.col(c), digits) for c in cols})


def KM_DEG(km: float) -> str:  # noqa: N802 - reads like a unit
    """The reference's buffer radius in degrees (km / 111) as a DOUBLE literal."""
    from plotwise.config import KM_PER_DEGREE
    return f"{km / KM_PER_DEGREE:.17e}"
