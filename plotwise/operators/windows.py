"""Group-relative fills, ranks, bands and histograms.

Group statistics that the reference computes with ``groupby().transform`` are
built as a grouped aggregate (partial aggregation before the shuffle) joined
back on the group key, not as a window: a window over a district holding a
third of all rows would put that third into one task. The aggregated side is
one row per group; AQE sees its measured size at the shuffle boundary and
broadcasts it when small, else keeps a sort-merge join with skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotwise.config import DISTANCE_COLS, MAX_DISTANCE_KM
from plotwise.operators.clean import np_round


def fill_district_max(df: DataFrame, cols: list[str] | None = None, group: str = "district",
                      cap: float = MAX_DISTANCE_KM, digits: int = 3) -> DataFrame:
    """NULL → max of the column within the group → ``cap``; then round to 3.
    Rows with a NULL group go straight to ``cap`` (pandas drops NULL keys)."""
    cols = [c for c in (DISTANCE_COLS if cols is None else cols) if c in df.columns]
    if not cols:
        return df
    gmax = (df.filter(F.col(group).isNotNull())
              .groupBy(group)
              .agg(*[F.max(c).alias(f"__max_{c}") for c in cols]))
    out = df.join(gmax, group, "left")
    filled = {c: np_round(F.coalesce(F.col(c), F.col(f"__max_{c}"), F.lit(cap)), digits) for c in cols}
    return out.withColumns(filled).drop(*[f"__max_{c}" for c in cols]).select(*df.columns)


def ridership_tier(df: DataFrame, col: str = "total_ridership", out: str = "ridership_tier") -> DataFrame:
    """>50M, >20M, >5M, >0, else (the legend tiers of the ridership map)."""
    c = F.col(col)
    tier = (F.when(c > 50_000_000, "> 50M").when(c > 20_000_000, "20M - 50M")
             .when(c > 5_000_000, "5M - 20M").when(c > 0, "0 - 5M").otherwise("No data"))
    return df.withColumn(out, tier)


def top_percentile_band(df: DataFrame, col: str = "price_m2", q: float = 0.90) -> DataFrame:
    """Rows at or above the q-quantile (linear) → ``is_top``; the others get
    ``price_norm`` = (p − min) / (max − min) over the rows below (divisor 1
    when they are all equal). NULL price → NULL for both. The threshold and
    the range are scalar subqueries, not driver round trips."""
    from plotwise.operators.quantiles import exact_percentiles
    p = F.col(col).cast("double")
    thr = F.lit(exact_percentiles(df.select(p.alias("_p")), "_p", [q]).first()[0]).cast("double")
    below = df.filter(p < thr)
    lo = below.select(F.min(p)).scalar()
    hi = below.select(F.max(p)).scalar()
    span = F.when((hi - lo) == 0, F.lit(1.0)).otherwise(hi - lo)
    return df.withColumns({
        "is_top": F.when(p.isNotNull(), p >= thr),
        "price_norm": F.when(p < thr, (p - lo) / span),
    })


def global_index(df: DataFrame, order_cols: list[str], out: str = "rank_index", partitions: int | None = None) -> DataFrame:
    """0-based position in the total order of ``order_cols`` without a
    single-partition window: range-partition, sort each partition, number
    rows by their in-partition id, add per-partition offsets (one small
    aggregate: one row per partition, so its size is bounded)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = ranged.withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    # materialise once: range boundaries come from sampling, and both uses
    # below must see the same partitioning (reliable checkpoint, shared dir)
    tagged = tagged.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)).checkpoint()
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_pid", "_off")
    return (tagged.join(F.broadcast(offs), "_pid")  # ≤ one row per partition
                  .withColumn(out, F.col("_off") + F.col("_local"))
                  .drop("_pid", "_mid", "_local", "_off"))


def residual_histogram(df: DataFrame, y: str = "y", p: str = "p", bins: int = 50) -> DataFrame:
    """Equal-width histogram of residuals y − p over [min, max]; the last bin
    is closed. Min and max are scalar subqueries."""
    r = F.col(y) - F.col(p)
    lo = df.select(F.min(r)).scalar()
    hi = df.select(F.max(r)).scalar()
    width = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
    idx = F.least(F.floor((r - lo) * (F.lit(float(bins)) / width)), F.lit(bins - 1)).cast("int")
    return (df.filter(r.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count")))


def model_ranking(metrics: DataFrame, score: str = "test_r2", name: str = "model") -> DataFrame:
    """Rank models by score (desc, name as tie-break). One row per model, so
    the single global window partition is the right plan here."""
    w = Window.orderBy(F.desc(score), F.asc(name))
    return metrics.withColumn("rank", F.row_number().over(w))
