"""Exact percentiles (linear interpolation, as NumPy / ``percentile`` /
``quantile_cont``) per group, without holding a group's values in one task.

``percentile`` merges every distinct value of a group in one task, so a
group holding a third of the data does not fit. Instead, per group and
target rank:

1. if the group has at most ``LIMIT`` distinct values, their (value, count)
   pairs are ranked directly;
2. otherwise a bounded-memory ``percentile_approx`` sketch (partial
   aggregation) brackets the target rank, rows below the bracket are
   counted, and only the bracket is kept. This repeats until the bracket
   holds at most ``LIMIT`` distinct values. The sketch's rank error is bounded, so the
   margin around the target rank keeps the true value inside, and the
   counts check it (a miss widens the bracket).

The selection itself runs on (value, count) pairs, so ties collapse: a key
where a third of the rows share one value is a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LIMIT = 100_000
#: So many targets (groups x ranks) at most are broadcast.
FEW_TARGETS = 10_000
ACCURACY = 10_000
GRID = 1000


def exact_percentiles(df: DataFrame, col: str, qs: list[float], by: list[str] | None = None,
                      limit: int = LIMIT, accuracy: int = ACCURACY) -> DataFrame:
    """One row per group: ``by`` columns plus ``p0, p1, …`` for ``qs`` (NULLs ignored)."""
    glob = not by
    by = ["_g"] if glob else list(by)
    base = df.select(*([F.lit(0).alias("_g")] if glob else [F.col(c) for c in by]),
                     F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    n = base.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    qarr = F.array(*[F.struct(F.lit(i).alias("_qi"), F.lit(float(q)).alias("_q")) for i, q in enumerate(qs)])
    t = n.select(*by, "_n", F.explode(qarr).alias("_t")).select(*by, "_n", "_t._qi", "_t._q")
    t = t.withColumn("_pos", F.col("_q") * (F.col("_n") - 1))
    targets = (t.select(*by, "_qi", "_pos", F.explode(F.array(F.floor("_pos"), F.ceil("_pos"))).alias("_r"))
                .dropDuplicates(by + ["_qi", "_r"])).checkpoint()
    keys = by + ["_qi", "_r"]
    # bracket per target: values lo <= v <= hi, with `below` rows under lo
    state = targets.select(*keys).withColumns({"_lo": F.lit(float("-inf")), "_hi": F.lit(float("inf")),
                                               "_below": F.lit(0).cast("long")}).checkpoint()
    done = []
    few = glob or targets.count() <= FEW_TARGETS

    def small_side(d):
        # a row per target: broadcast, so that the rows of a large group stay where they are and a bracket's values
        # meet in one task only once they are few
        return F.broadcast(d) if few else d

    while True:
        st_side = small_side(state)
        inb = (base.join(st_side, by).filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
                   .select(*keys, "_v"))
        # (value, count) pairs in each bracket: ties collapse to one row
        vcount = inb.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_k")).checkpoint()
        size = vcount.groupBy(*keys).agg(F.sum("_k").alias("_c"), F.count(F.lit(1)).alias("_d"))
        st = state.join(size, keys, "left").fillna(0, subset=["_c", "_d"]).checkpoint()
        valid = (F.col("_below") <= F.col("_r")) & (F.col("_r") < F.col("_below") + F.col("_c"))
        small = st.filter(valid & (F.col("_d") <= limit))
        big = st.filter(valid & (F.col("_d") > limit))
        miss = st.filter(~valid)
        # exact selection: running count over the bracket's distinct values
        w = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        vc = (vcount.join(small_side(small.select(*keys, "_below")), keys)
                    .withColumn("_cum", F.col("_below") + F.sum("_k").over(w)))
        done.append(vc.filter(F.col("_cum") > F.col("_r")).groupBy(*keys).agg(F.min("_v").alias("_val")).checkpoint())
        if big.isEmpty() and miss.isEmpty():
            break
        # narrow large brackets with a bounded sketch of the bracket's values:
        # a fixed grid of GRID+1 quantiles, the target's cell ± 2 cells kept
        rel = (F.col("_r") - F.col("_below")) / F.greatest(F.col("_c") - 1, F.lit(1))
        grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
        m = max(2, -(-2 * GRID // accuracy))  # margin (cells) ≥ twice the sketch's rank error
        lo_i = F.greatest(F.floor(rel * GRID) - m, F.lit(0)).cast("int") + 1
        hi_i = F.least(F.ceil(rel * GRID) + m, F.lit(GRID)).cast("int") + 1
        approx = (inb.join(small_side(big.select(*keys, "_c", "_below")), keys)
                     .groupBy(*keys, "_c", "_below")
                     .agg(F.percentile_approx("_v", grid, accuracy).alias("_b"))
                     .select(*keys, "_below", F.element_at("_b", lo_i).alias("_lo"), F.element_at("_b", hi_i).alias("_hi")))
        under = (inb.join(small_side(approx.select(*keys, F.col("_lo").alias("_nlo"))), keys).filter(F.col("_v") < F.col("_nlo"))
                    .groupBy(*keys).agg(F.count(F.lit(1)).alias("_add")))
        narrowed = (approx.join(under, keys, "left").fillna(0, subset=["_add"])
                          .select(*keys, "_lo", "_hi", (F.col("_below") + F.col("_add")).alias("_below")))
        # a bracket that lost its rank (sketch error) restarts unbounded
        widened = miss.select(*keys, F.lit(float("-inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"),
                              F.lit(0).cast("long").alias("_below"))
        state = narrowed.unionByName(widened).checkpoint()
    vals = done[0]
    for d in done[1:]:
        vals = vals.unionByName(d)
    # interpolate: (higher − pos)·v_lo + (pos − lower)·v_hi
    tv = targets.join(vals, keys)
    per_q = tv.groupBy(*by, "_qi", "_pos").agg(F.min_by("_val", "_r").alias("_vl"), F.max_by("_val", "_r").alias("_vh"))
    lower, higher = F.floor("_pos"), F.ceil("_pos")
    per_q = per_q.withColumn("_p", F.when(lower == higher, F.col("_vl")).otherwise(
        (higher - F.col("_pos")) * F.col("_vl") + (F.col("_pos") - lower) * F.col("_vh")))
    out = (per_q.groupBy(*by).pivot("_qi", list(range(len(qs)))).agg(F.first("_p"))
                .withColumnsRenamed({str(i): f"p{i}" for i in range(len(qs))}))
    if glob:
        # always one row, NULLs when there are no values
        one = df.sparkSession.range(1).select(F.lit(0).alias("_g"))
        return one.join(out, "_g", "left").drop("_g")
    groups = df.select(*by).distinct()  # groups whose values are all NULL get NULLs
    return groups.join(out, by, "left")


def exact_median(df: DataFrame, col: str, by: list[str] | None = None, out: str | None = None) -> DataFrame:
    r = exact_percentiles(df, col, [0.5], by)
    return r.withColumnRenamed("p0", out or f"median_{col}")
