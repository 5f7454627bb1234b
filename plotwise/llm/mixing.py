"""Mixing sources to target weights by entropy balancing.

Every document gets a rate (expected copies). Among all rates that meet the token
target of each source, entropy balancing takes the one of least relative entropy to the
prior rates, with rates capped. Its solution is an exponential tilt by the constrained quantity, the
tokens: rate = min(cap, prior * exp(lambda[source] * size / mean size)). Each lambda
solves a convex dual whose slope is tokens taken - target. Documents of equal
source, prior and size share a rate, so they are pre-aggregated into cells, and each Newton step
is one grouped sum over all cells of all sources.

Rates become whole copies: everybody gets the whole part. The fractions are
added up over a source's cells in order of size, and a cell gets as many further
copies as the sum passes whole numbers: their tokens then differ from what was asked by no more
than the largest document. Two repairs per source move the one copy that brings its total nearest to its target.
In a cell, where all documents are equally long, those of least hash get the copies.

Each step is written and read back, so that every plan holds a join or two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotwise.llm.common import materialise, text_of, word_count
from plotwise.operators.windows import global_index

#: Fixed values of the production mix: weights by source in code-point order, repeating; share of all sizes; most copies.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2.0
#: A source is met when its tokens are this share of its target from it, or its bracket is this narrow.
TOLERANCE = 1e-13
#: Rates are kept in billionths, so that their sums are exact.
UNITS = 1_000_000_000
REPAIRS = 2
#: Documents of a cell that are ranked together.
RANKED = 1024
#: Cells with more than one in so many of all documents are joined by broadcast; there are fewer than that many.
HOT_SHARE = 1000


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """source, source_size, target: ``budget`` times all tokens shared by weight;
    a target stops at ``cap`` times its source and the excess is shared again.

    Weights go by the rank of a source. The common level at which the shares add up is found by filling: sources
    whose cap lies below it are full and leave the rest to the others, until no more are.
    Only two sums a round come to the driver.
    """
    by_source = materialise(sizes.groupBy("_source").agg(F.sum("_size").alias("source_size")), "mix-sources")
    named = by_source.filter("_source is not null")
    ranked = global_index(named, ["_source"], "_rank").unionByName(
        by_source.filter("_source is null").withColumn("_rank", F.lit(named.count()).cast("long")))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    facts = materialise(ranked.select("_source", "source_size", w.alias("_w"), (F.col("source_size") * F.lit(float(cap))).alias("_cap")), "mix-facts")
    every, weight = facts.agg(F.sum("source_size"), F.sum("_w")).first()
    level, full = (every * budget / weight if weight else 0.0), -1
    while True:
        over = F.col("_cap") <= F.lit(level) * F.col("_w")
        n, held, open_ = facts.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("_cap"))), F.sum(F.when(~over, F.col("_w")))).first()
        if n == full or not open_:
            break
        level, full = (every * budget - (held or 0.0)) / open_, n
    return facts.select("_source", "source_size", F.least("_cap", F.lit(level) * F.col("_w")).alias("target"))


def balance(cells: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """Newton on the dual: cells (_source, _prior, _x, _mass), _x the scaled size and _mass the cell's tokens,
    and targets (_source, target) give _source, _lambda. Each source's dual is one-dimensional and convex; a
    target of 0 or of all capped mass has its solution at the border and is set there."""
    mass = cells.groupBy(F.col("_source").alias("_s")).agg(F.sum("_mass").alias("_all"))
    state = targets.join(mass, _same("_source", "_s"), "left").select(
        "_source", "target", F.when((F.col("target") <= 0) | F.col("_all").isNull(), -F.lit(float("inf")))
        .when(F.col("target") >= cap * F.col("_all") * (1 - 1e-12), F.lit(float("inf"))).otherwise(F.lit(0.0)).alias("_lambda"),
        F.lit(-float("inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"))
    state = materialise(state.withColumn("_open", F.abs("_lambda") < float("inf")), "mix-newton")
    c = cells.select(F.col("_source").alias("_cs"), "_prior", "_x", "_mass")
    while not state.filter("_open").isEmpty():
        rate = F.col("_prior") * F.exp(F.col("_lambda") * F.col("_x"))
        sums = (c.join(state.filter("_open").select("_source", "_lambda"), _same("_cs", "_source"))
                 .groupBy(F.col("_cs").alias("_s")).agg(F.sum(F.col("_mass") * F.least(rate, F.lit(cap))).alias("_taken"),
                                                        F.sum(F.when(rate < cap, F.col("_mass") * F.col("_x") * rate).otherwise(0.0)).alias("_slope")))
        gap = F.col("target") - F.col("_taken")
        step = F.when(F.col("_slope") > 0, gap / F.col("_slope")).otherwise(F.signum(gap))
        bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), step))
        aim = F.col("_lambda") + F.col("_step")
        # the root stays between _lo and _hi: a step out of it (the cap bends the slope) becomes half of what is left
        held = F.when((aim <= F.col("_lo")) | (aim >= F.col("_hi")), (F.col("_lo") + F.col("_hi")) / 2).otherwise(aim)
        near = (F.abs(gap) <= TOLERANCE * F.col("target")) | (F.col("_hi") - F.col("_lo") <= TOLERANCE * F.abs("_lambda"))
        moved = (state.join(sums, _same("_source", "_s"), "left").withColumn("_step", bounded)
                      .withColumn("_lo", F.when(F.col("_open") & (gap > 0), F.col("_lambda")).otherwise(F.col("_lo")))
                      .withColumn("_hi", F.when(F.col("_open") & (gap < 0), F.col("_lambda")).otherwise(F.col("_hi"))))
        state = materialise(moved.select("_source", "target", F.when(F.col("_open") & ~near, held).otherwise(F.col("_lambda")).alias("_lambda"),
                                         "_lo", "_hi", (F.col("_open") & ~near & (held != F.col("_lambda"))).alias("_open")), "mix-newton")
    return state.select("_source", "_lambda")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        prior_col: str | None = None, weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """One row per row of ``docs``: its id, size, source, source_size, target, copies, taken
    (copies * size) and text_hash.

    Size is the number of words; null or empty text has size 0 and takes 0 words and no copy beyond the whole part of
    its prior. A null source is a source of its own, last in order; a null prior is 1. Rows are told apart by id and
    text; rows equal in both are ranked as they come, so their copies may be exchanged among them, and reruns agree on all
    others. Extra columns are not read. An empty table gives an empty table.
    """
    prior = F.lit(1.0) if prior_col is None else F.coalesce(F.col(prior_col).cast("double"), F.lit(1.0))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    slim = materialise(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(text_of(text_col)).alias("_size"),
        prior.alias("_prior"), F.xxhash64(text_of(text_col)).alias("_text"), F.md5(name).alias("_hash")), "mix-sizes")
    targets = source_targets(slim, weights, budget, cap)
    targets = materialise(targets.withColumnRenamed("_source", "_ts"), "mix-targets")
    counts = slim.groupBy("_source", "_prior", "_size").agg(F.count(F.lit(1)).alias("_n"))
    # sizes are scaled by their mean in the source, which keeps lambdas near 1
    means = slim.groupBy(F.col("_source").alias("_ms")).agg(F.avg("_size").alias("_mean"))
    cells = materialise(counts.join(means, _same("_source", "_ms")).select(
        "_source", "_prior", "_size", "_n", F.when(F.col("_mean") > 0, F.col("_size") / F.col("_mean")).otherwise(0.0).alias("_x"),
        (F.col("_n") * F.col("_size")).cast("double").alias("_mass")), "mix-cells")
    lam = balance(cells.filter("_size > 0"), targets.select(F.col("_ts").alias("_source"), "target"), cap).withColumnRenamed("_source", "_ls")
    tilt = F.when(F.col("_x") == 0, F.col("_prior")).when(F.col("_lambda") == -float("inf"), F.lit(0.0)).otherwise(F.col("_prior") * F.exp(F.col("_lambda") * F.col("_x")))
    rated = (cells.join(lam, _same("_source", "_ls")).join(targets, _same("_source", "_ts"))
                  .withColumn("_rate", F.round(F.least(F.lit(cap), tilt) * UNITS).cast("long"))
                  .select("_source", "_prior", "_size", "_n", "source_size", "target", F.floor(F.col("_rate") / UNITS).alias("_base"), (F.col("_rate") % UNITS).alias("_part")))
    rounded = _rounded(materialise(rated, "mix-rates"), cap)
    return _dealt(slim, rounded).select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_source").alias(source_col), "source_size", "target",
        F.col("_copies").cast("int").alias("copies"), (F.col("_copies") * F.col("_size")).cast("long").alias("taken"), F.col("_text").alias("text_hash"))


def _rounded(cells: DataFrame, cap: float) -> DataFrame:
    """Cells with ``_extra``, the number of their documents that get one copy more than ``_base``.

    A source's cells, one per size and prior, are summed in one window each; documents don't enter."""
    order = Window.partitionBy("_source").orderBy("_size", "_prior").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = F.when(F.col("_size") > 0, F.col("_n") * F.col("_part")).otherwise(0).cast("decimal(38,0)")
    upto = F.sum(parts).over(order)
    half = F.lit(UNITS // 2)
    passed = F.floor((upto + half) / UNITS) - F.floor((upto - parts + half) / UNITS)
    c = materialise(cells.withColumn("_extra", F.least(passed.cast("long"), F.col("_n"))), "mix-extras")
    taken = F.sum((F.col("_n") * F.col("_base") + F.col("_extra")) * F.col("_size"))
    for _ in range(REPAIRS):
        missing = c.groupBy(F.col("_source").alias("_ms")).agg((F.first("target") - taken).alias("_missing"))
        # one copy more where a document still has room, one less where one was added
        tries = c.join(missing, _same("_source", "_ms")).filter("_part > 0 and _size > 0").withColumn(
            "_move", F.explode(F.array(F.when(F.col("_extra") < F.col("_n"), F.lit(1)), F.when(F.col("_extra") > 0, F.lit(-1))))).filter("_move is not null")
        after = F.abs(F.col("_missing") - F.col("_move") * F.col("_size"))
        best = (tries.filter(after < F.abs("_missing")).groupBy(F.col("_source").alias("_bs"))
                     .agg(F.min(F.struct(after.alias("a"), "_size", "_prior", "_move")).alias("_best"))
                     .select("_bs", F.col("_best._size").alias("_bsize"), F.col("_best._prior").alias("_bprior"), F.col("_best._move").alias("_bmove")))
        hit = _same("_source", "_bs") & (F.col("_size") == F.col("_bsize")) & (F.col("_prior") == F.col("_bprior"))
        c = materialise(c.join(best, hit, "left").withColumn("_extra", F.col("_extra") + F.coalesce("_bmove", F.lit(0))).drop("_bs", "_bsize", "_bprior", "_bmove"), "mix-repair")
    return c


def _with_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows with their cell's facts. Cells that hold more than one in ``HOT_SHARE`` of all rows, fewer than that many, are broadcast."""
    total = cells.agg(F.sum("_n")).first()[0] or 0
    c = cells.select(F.struct("_source", "_prior", "_size").alias("_k"), "_n", "source_size", "target", "_base", "_extra")
    keyed = rows.withColumn("_rk", F.struct("_source", "_prior", "_size"))
    hot, cold = c.filter(F.col("_n") * HOT_SHARE > total), c.filter(F.col("_n") * HOT_SHARE <= total)
    same = F.col("_rk").eqNullSafe(F.col("_k"))
    out = keyed.join(F.broadcast(hot), same).unionByName(
        keyed.join(F.broadcast(hot.select(F.col("_k").alias("_h"))), F.col("_rk").eqNullSafe(F.col("_h")), "left_anti").join(cold, same))
    return out.drop("_k", "_rk")


def _dealt(slim: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows with ``_copies``. Cells of which only some documents get the further copy are cut by hash into buckets of about
    ``RANKED``; counts say in which bucket the last copy falls, and only there documents are ranked."""
    share = F.conv(F.substring("_hash", 1, 12), 16, 10).cast("double") / float(1 << 48)
    rows = _with_cells(slim, cells).withColumn("_all", F.when(F.col("_extra") == F.col("_n"), 1).when(F.col("_extra") == 0, 0))
    rows = materialise(rows.withColumn("_bucket", F.floor(share * F.ceil(F.col("_n") / RANKED))), "mix-rows")
    some = rows.filter("_all is null")
    per = some.groupBy("_source", "_prior", "_size", "_bucket").agg(F.count(F.lit(1)).alias("_in"), F.first("_extra").alias("_want"))
    before = F.sum("_in").over(Window.partitionBy("_source", "_prior", "_size").orderBy("_bucket")) - F.col("_in")
    left = per.select(F.struct("_source", "_prior", "_size", "_bucket").alias("_k"), (F.col("_want") - before).alias("_left"))
    placed = some.withColumn("_rk", F.struct("_source", "_prior", "_size", "_bucket")).join(left, F.col("_rk").eqNullSafe(F.col("_k")))
    rank = F.row_number().over(Window.partitionBy("_rk").orderBy("_hash", F.col("_id").asc_nulls_first(), "_text"))
    ranked = placed.withColumn("_all", (rank <= F.col("_left")).cast("int")).drop("_rk", "_k", "_left")
    return rows.filter("_all is not null").unionByName(ranked).withColumn("_copies", F.col("_base") + F.col("_all"))


def apply_mix(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` repeated as often as ``mixed`` says (0 drops them).

    Rows are matched by id and text. Where several rows share both, they get together
    as many copies as ``mix`` gave them together, spread evenly. Null ids match each other; an empty table stays empty."""
    copies = mixed.groupBy(F.struct(F.col(id_col).alias("id"), F.col("text_hash").alias("text")).alias("mk")).agg(
        F.sum("copies").alias("together"), F.count(F.lit(1)).alias("rows"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text")).alias("rk"))
    met = keyed.join(copies.filter("together > 0"), F.col("rk").eqNullSafe(F.col("mk")))
    nth = F.row_number().over(Window.partitionBy("rk").orderBy("row"))
    alone = met.filter("rows = 1").withColumn("copies", F.col("together"))
    shared = met.filter("rows > 1").withColumn("copies", F.floor(F.col("together") / F.col("rows")) + (nth <= F.col("together") % F.col("rows")).cast("long"))
    return (alone.unionByName(shared).filter("copies > 0")
                 .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long")))).select("row.*"))
