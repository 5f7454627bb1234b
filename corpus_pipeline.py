"""A corpus from documents: toxicity filter, line de-duplication, near-duplicate
removal, mixing to source weights, packing into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.llm.common import materialise, without
from plotwise.llm.line_dedup import drop_repeated_lines
from plotwise.llm.mixing import apply_mix, mix
from plotwise.llm.near_dedup import near_duplicates
from plotwise.llm.packing import best_fit_pack
from plotwise.llm.toxicity import fit, score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; every row is judged by its own text, whatever its id."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))
    scored = score(docs.select(key.alias("key"), "text"), model, "key")
    return without(docs, key, scored.filter("predicted = 1").select("key"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars follows the text."""
    return drop_repeated_lines(docs).select(*[
        F.when(F.col("n_chars").isNull(), None).otherwise(F.char_length("text").cast("long")).alias("n_chars") if c == "n_chars" else F.col(c)
        for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of smallest id."""
    return without(docs, F.col("doc_id"), near_duplicates(docs).filter("not kept").select("doc_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 0, 1 or 2 times."""
    return apply_mix(docs, mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in their bins."""
    return best_fit_pack(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("near dedup", drop_near_duplicates),
          ("mixing", mix_sources), ("packing", pack)]

#: A recurrent network, a MinHash search and a packing are no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order on the documents table, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
