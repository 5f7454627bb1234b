"""Quality rules as a short-circuit cascade, in column expressions only.

Each rule's cost (seconds on a sample, over an empty pass) and selectivity (rows that it rejects) are
estimated first; then the rule that rejects most of what is left per second
comes first, and so on. The cascade is one CASE expression, which evaluates a rule only
for rows that all earlier rules let pass. The order changes what is computed, never which rows are kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import let, strip_ws, text_of, word_array

#: Rows of the sample that costs and selectivities are estimated on (first by hash).
SAMPLE_ROWS = 2000
WINDOW = 5
#: Base limits (words; per cent of words in repeated windows) and symbols.
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
SYMBOLS = "[#*$%&|<>]+"

# Columns that rules may read: _text, _words (array), n_words, word_chars, n_symbols, n_dup_lines, _lines (array)


def _share_over(count: Column, of: Column, per_cent: int) -> Column:
    return count * 100 > of * per_cent


def _without(pattern: str) -> Column:
    """Code points of the text that match ``pattern``."""
    return F.char_length("_text") - F.char_length(F.regexp_replace("_text", pattern, ""))


def _stutter() -> Column:
    """Words equal to the word before."""
    return let(F.col("_words"), lambda w: F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))))


#: name -> true where the rule rejects
RULES: dict[str, Callable[[], Column]] = {
    "symbols": lambda: _share_over(F.col("n_symbols"), F.col("n_words"), 10),
    "word_length": lambda: (F.col("word_chars") < F.col("n_words") * 3) | (F.col("word_chars") > F.col("n_words") * 10),
    "repeated_lines": lambda: F.col("n_dup_lines") * 3 > F.size("_lines"),
    "capitals": lambda: _share_over(_without("\\p{Lu}+"), F.col("word_chars"), 30),
    "exclamations": lambda: _share_over(_without("!+"), F.col("n_words"), 10),
    "stutter": lambda: _share_over(_stutter(), F.col("n_words"), 20),
}


def repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words covered by ``width``-word windows found twice or more, the first
    occurrence included. Windows are 64-bit hashes; texts whose windows are all
    different (the usual case) end after one hash-set pass, the others sort
    (hash, place) pairs and add up the places' disjoint reach."""
    def hashes(w: Column) -> Column:
        return F.transform(F.slice(w, F.lit(1), F.size(w) - (width - 1)),
                           lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, width)]))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        repeated = let(pairs, lambda p: F.filter(p, lambda x, k: (
            (k > 0) & (x["h"] == F.get(p, k - 1)["h"])) | F.coalesce(x["h"] == F.get(p, k + 1)["h"], F.lit(False))))
        places = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))), F.lit(0), lambda a, x: a + x))

    counted = let(words, lambda w: let(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))
    return F.when(F.size(words) < width, 0).otherwise(counted).cast("long")


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts that rules read."""
    with_word = F.filter(F.split("_text", "\n", -1), lambda x: strip_ws(x) != "")
    return (docs.withColumn("_text", text_of(text_col)).withColumn("_words", word_array(F.col("_text"))).withColumn("_lines", with_word)
                .withColumn("n_words", F.size("_words").cast("long"))
                .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
                .withColumn("n_symbols", _without(SYMBOLS).cast("long"))
                .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
                .withColumn("n_repeat_words", repeat_words(F.col("_words")))
                .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)))


def plan_cascade(docs: DataFrame, text_col: str = "text", rules: dict[str, Callable[[], Column]] | None = None,
                 sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names in the order of rejection per cost, greedily: what counts for
    a rule is what the rules before it leave."""
    rules = rules or RULES
    # the cut is found on hashes alone, so that no task gathers texts beyond the sample
    place = F.xxhash64(*docs.columns)
    last = docs.select(place.alias("h")).orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    picked = docs.filter(place <= F.lit(last)).select(F.col(text_col).alias("text")).limit(sample_rows)
    sample = features(picked).filter(~F.col("base_failed")).select(
        "_text", "_words", "_lines", "n_words", "word_chars", "n_symbols", "n_dup_lines").persist()
    try:
        verdicts = sample.select(*[F.coalesce(r(), F.lit(False)).alias(n) for n, r in rules.items()])
        patterns = [(tuple(row[n] for n in rules), row["count"]) for row in verdicts.groupBy(*rules).count().collect()]

        def seconds(rule: Column) -> float:
            began = time.perf_counter()
            sample.agg(F.count_if(rule)).collect()
            return time.perf_counter() - began

        seconds(F.col("n_words") < 0)
        empty = min(seconds(F.col("n_words") < 0) for _ in range(2))
        cost = {n: max(seconds(r()) - empty, 1e-3) for n, r in rules.items()}
    finally:
        sample.unpersist()
    names, order = list(rules), []
    while len(order) < len(names):
        def gain(n: str) -> float:
            k = names.index(n)
            left = sum(c for p, c in patterns if p[k] and not any(p[names.index(o)] for o in order))
            return left / cost[n]
        order.append(max((n for n in names if n not in order), key=lambda n: (gain(n), -cost[n], n)))
    return order


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            rules: dict[str, Callable[[], Column]] | None = None, order: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, the five counts, base_failed, kept and
    rejected_by (base, or the first rule of the cascade that rejects; null if kept).

    Null or empty text has no words and fails the base rule. Equal texts get equal verdicts.
    Null ids and repeated rows are kept as rows; extra columns are not read. An empty table gives an empty table.
    """
    rules = rules or RULES
    order = order or plan_cascade(docs.select(id_col, text_col), text_col, rules)
    f = features(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")))
    cascade = F.when(F.col("base_failed"), "base")
    for n in order:
        cascade = cascade.when(rules[n](), n)
    return (f.withColumn("rejected_by", cascade)
             .select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     "base_failed", F.col("rejected_by").isNull().alias("kept"), "rejected_by"))
