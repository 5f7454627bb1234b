"""Structured Streaming form of the monthly ridership roll-up.

The same operator as ``transit.monthly_ridership`` – sums of passengers by
month, service, origin and destination – over a file stream of trip
records. The aggregate state is one row per output group (months × services
× origin–destination pairs), so it is bounded by the result size, not by the
input. Progress and state live under the shared checkpoint directory, so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.session import scratch_path
from plotwise.sources.proxies import ALL_STATIONS

LINEITEM_SCHEMA = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                   "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                   "l_linestatus string, l_shipdate timestamp")


def od_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """Trip records as a stream (the same projection as ``proxies.od_ridership``)."""
    li = (spark.readStream.schema(LINEITEM_SCHEMA).option("maxFilesPerTrigger", max_files)
               .parquet(os.path.join(sf_dir, "lineitem*.parquet")))

    def label(k):
        return F.concat(k.cast("string"), F.lit(": Station "), k.cast("string"))

    return li.select(
        F.col("l_shipdate").alias("date"), F.col("l_returnflag").alias("service"),
        F.when(F.col("l_linenumber") == 2, F.lit(ALL_STATIONS)).otherwise(label(F.col("l_suppkey"))).alias("origin"),
        F.when(F.col("l_linenumber") == 1, F.lit(ALL_STATIONS)).otherwise(label(F.col("l_partkey") % 100)).alias("destination"),
        F.col("l_quantity").alias("passengers"))


def monthly_ridership_stream(spark: SparkSession, sf_dir: str, since: str = "1996-01-01",
                             query_name: str | None = None) -> DataFrame:
    """Run the roll-up over everything available (``availableNow``) and return
    the final result table."""
    from plotwise.operators.transit import monthly_ridership
    agg = monthly_ridership(od_stream(spark, sf_dir), since=since)
    out = scratch_path(spark, "stream-ridership")

    def write(batch: DataFrame, _epoch: int) -> None:
        # complete mode: each batch holds the whole result so far, written by the executors
        batch.write.mode("overwrite").parquet(out)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write).queryName(query_name or f"monthly_ridership_{os.getpid()}")
            .option("checkpointLocation", scratch_path(spark, "stream-ckpt"))
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(agg.schema).parquet(out)
