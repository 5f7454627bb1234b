"""Numeric helpers shared by queries and their SQL oracles.

``sig`` rounds a double to a number of significant digits with operations
that are exact in IEEE arithmetic on both Spark and DuckDB (integer powers of
ten, round-half-away-from-zero), so sums that differ only in the order of
addition compare equal. ``sig_sql`` is the same expression as DuckDB text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sig(c: Column | str, digits: int = 10) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    x = x.cast("double")
    e = F.floor(F.log10(F.abs(x)))
    s = F.lit(digits - 1) - e
    up = F.round(x * F.pow(F.lit(10.0), s), 0) / F.pow(F.lit(10.0), s)
    down = F.round(x / F.pow(F.lit(10.0), -s), 0) * F.pow(F.lit(10.0), -s)
    finite = x.isNotNull() & (x != 0) & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.when(finite, F.when(s >= 0, up).otherwise(down)).otherwise(x)


def sig_sql(expr: str, digits: int = 10) -> str:
    x = f"CAST(({expr}) AS DOUBLE)"
    s = f"({digits - 1} - floor(log10(abs({x}))))"
    return (
        f"(CASE WHEN {x} IS NULL OR {x} = 0 OR isnan({x}) OR isinf({x}) THEN {x} "
        f"WHEN {s} >= 0 THEN round({x} * pow(10.0, {s})) / pow(10.0, {s}) "
        f"ELSE round({x} / pow(10.0, -{s})) * pow(10.0, -{s}) END)"
    )
