"""Line de-duplication: explode normalised lines, hash, count documents per
hash, drop lines over the threshold, reassemble by position.

Only 128-bit line hashes with ids and positions are shuffled for the counts;
each text is shuffled once, to meet the positions it loses. A line shared by
a third of all documents is pre-aggregated before the count's shuffle, and its
hits are dealt back by a sort-merge join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import lower_ascii, strip_ws, text_of

#: Stands for a null doc_id: such rows count as one document that comes last.
LAST_ID = 9223372036854775807


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """Keys (lines stripped and A-Z lowered) of at least ``min_chars`` code
    points found in at least ``min_docs`` documents lose all their lines except
    in the smallest id that holds them.

    Returns the rows of ``docs`` with ``text_col`` cut down and ``n_lines``,
    ``n_dropped`` (long) added; extra columns pass through unless they bear
    those two names, which are replaced. Null or empty text is one empty
    line. Rows with a null id count as one document after all others. Repeated
    rows of one id are one document: each keeps or loses the same lines. An
    empty table gives an empty table.
    """
    carried = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    base = docs.select(
        F.struct(*carried).alias("_row"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        text_of(text_col).alias("_text")).withColumn("_rk", F.xxhash64("_text"))
    key = lower_ascii(strip_ws(F.col("_line")))
    lines = (base.select("_id", "_rk", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
                 .select("_id", "_rk", "_pos", key.alias("_key"))
                 .filter(F.char_length("_key") >= min_chars)
                 .select("_id", "_rk", "_pos", F.xxhash64("_key").alias("_h1"),
                         F.xxhash64(F.lit("line"), "_key").alias("_h2")))
    shared = (lines.groupBy("_h1", "_h2", "_id").agg(F.lit(1).alias("_one"))
                   .groupBy("_h1", "_h2").agg(F.count("_one").alias("_n"), F.min("_id").alias("_first"))
                   .filter(F.col("_n") >= min_docs).drop("_n"))
    gone = (lines.join(shared, ["_h1", "_h2"]).filter(F.col("_id") > F.col("_first"))
                 .groupBy("_id", "_rk").agg(F.collect_set("_pos").alias("_gone")))
    split = F.split("_text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), F.col("_gone"))
    return (base.join(gone, ["_id", "_rk"], "left")
                .withColumn("n_lines", F.size(split).cast("long"))
                .withColumn("n_dropped", F.coalesce(F.size("_gone"), F.lit(0)).cast("long"))
                .select("_row.*",
                        F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(_pick(split, kept)).alias(text_col),
                        "n_lines", "n_dropped"))


def _pick(lines, positions):
    """The lines at ``positions``, joined by line feeds; the list is bound once."""
    return F.element_at(F.transform(
        F.array(lines), lambda ls: F.array_join(F.transform(positions, lambda p: F.get(ls, p)), "\n")), 1)
