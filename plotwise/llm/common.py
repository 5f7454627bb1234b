"""Column expressions and scratch helpers shared by the operators here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.session import ensure_checkpoint_dir, scratch_path

#: White space of every contract: space, tab, line feed, vertical tab, form feed, carriage return.
WS = " \t\n\x0b\x0c\r"
WS_RUN = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(col: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def strip_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(WS))


def word_array(c: Column) -> Column:
    """Maximal runs of non-space characters, in order; empty array without any."""
    t = strip_ws(c)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WS_RUN))


def word_count(c: Column) -> Column:
    t = strip_ws(c)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, WS_RUN))).cast("long")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once per row: a one-element
    ``transform`` binds it, so lambdas inside ``body`` reuse the result."""
    return F.element_at(F.transform(F.array(value), body), 1)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: later passes read
    the narrow table, not the texts, and a lost executor costs no rescan."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``key`` isn't in the one column of ``gone``. Rows travel as one
    struct, so no column of theirs can clash with the join's."""
    bad = gone.toDF("gone").distinct()
    return (docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"))
                .join(bad, F.col("key") == F.col("gone"), "left_anti").select("row.*"))
