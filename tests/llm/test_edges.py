"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns: each operator's stated result."""

import hashlib

import pytest
from pyspark.sql import functions as F

from plotwise.llm import fingerprints, html_text, line_dedup, mixing, near_dedup, packing, pii, quality, token_counts, toxicity

LONG = "word " * 30_000 + "end"
CLASH = ("id", "node", "size", "n_lines", "score", "copies", "fp", "found", "row", "_id", "_text", "th", "key", "copy")
ROWS = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, LONG, "b"), (5, "same text here\nagain and again", "b"),
        (5, "same text here\nagain and again", "b"), (6, "same text here\nagain and again", "b"), (None, "no id on this row at all, really none", "c"),
        (7, "x" * 20_000, "c"), (8, "\U0001f600 smile \U0001f600 a b c d e f", None)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumn("lang", F.lit(None).cast("string"))
    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_packing(docs, none):
    rows = packing.best_fit_pack(docs).collect()
    assert sum(r["size"] for r in rows) == sum(len((t or "").split()) for _, t, _ in ROWS)
    assert [r for r in rows if r["doc_id"] == 1][0]["bin_id"] is None
    assert sum(r["doc_id"] == 5 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 1
    assert sum(r["doc_id"] == 4 for r in rows) == -(-30_001 // 4096)
    assert packing.best_fit_pack(none).count() == 0


def test_quality(docs, none):
    r = by_id(quality.quality(docs))
    assert quality.quality(docs).count() == len(ROWS)
    assert r[1]["n_words"] == 0 and r[1]["base_failed"] and not r[1]["kept"]
    assert r[4]["n_repeat_words"] == 30_000 and r[4]["base_failed"]
    assert r[8]["word_chars"] == 2 + 5 + 6
    assert quality.quality(none).count() == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(4, 0), (5, 1), (6, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    r = toxicity.toxicity(docs, labels)
    assert r.count() == len(ROWS)
    scores = by_id(r)
    assert scores[1]["score"] == scores[2]["score"] == 0.0 and scores[1]["predicted"] == 0
    assert scores[5]["score"] == scores[6]["score"]
    assert not scores[None]["held_out"]
    assert toxicity.toxicity(none, labels.filter("false")).count() == 0


def test_near_dedup(docs, none):
    df = near_dedup.near_duplicates(docs)
    r = by_id(df)
    assert df.count() == len(ROWS)
    assert r[1]["n_shingles"] == 0 and r[1]["component_id"] == 1 and r[1]["kept"]
    assert r[6]["component_id"] == 5 and not r[6]["kept"] and r[5]["kept"]
    assert r[7]["n_shingles"] == 1 and r[4]["n_shingles"] == 2
    assert r[None]["component_id"] is None and r[None]["kept"]
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_dedup_id_with_two_texts(spark):
    a, b = ("one two three four five six seven", "eight nine ten eleven twelve thirteen")
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(df).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_fingerprints(docs, none):
    df = fingerprints.edited_fingerprints(docs)
    r = by_id(df)
    assert df.count() == len(ROWS)
    assert r[1]["fingerprint"] == "" and r[1]["n_chars"] == 0
    assert r[5]["fingerprint"] == r[6]["fingerprint"]
    text = ROWS[7][1]
    cut = text[:len(text) - len(text) // 4]
    assert r[None]["edited_sha256"] == hashlib.sha256(cut.encode()).hexdigest() and r[None]["near_next"] == 0
    assert fingerprints.edited_fingerprints(none).count() == 0


def test_token_counts(docs, none):
    df = token_counts.token_counts(docs)
    r = by_id(df)
    assert df.count() == len(ROWS) and r[1]["n_bytes"] == r[1]["n_tokens"] == 0
    assert r[4]["over_limit"] and not r[5]["over_limit"]
    assert token_counts.token_counts(none).count() == 0


def test_pii(docs, none):
    df = pii.personal_data(docs)
    assert df.count() == len(ROWS) and all(r["spans"] == "" for r in df.collect())
    assert pii.personal_data(none).count() == 0


def test_mixing(docs, none):
    df = mixing.mix(docs)
    r = by_id(df)
    assert df.count() == len(ROWS)
    assert r[1]["size"] == 0 and r[1]["taken"] == 0
    assert all(x["taken"] <= 2 * x["size"] for x in df.collect())
    assert sorted(map(str, df.collect())) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(none).count() == 0
    applied = mixing.apply_mix(docs, df)
    assert applied.columns == docs.columns
    assert mixing.apply_mix(none, mixing.mix(none)).count() == 0


def test_line_dedup(docs, none):
    df = line_dedup.drop_repeated_lines(docs)
    r = by_id(df)
    assert df.count() == len(ROWS)
    assert r[1]["n_lines"] == 1 and r[1]["n_dropped"] == 0 and r[1]["text"] == ""
    assert r[5]["n_dropped"] == 0 and r[6]["n_dropped"] == 2 and r[6]["text"] == ""
    assert r[6]["id"] == "clash" and set(df.columns) == set(docs.columns) | {"n_lines", "n_dropped"}
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_html(spark):
    schema = "page_id long, url string, html string, text string, host string, cut string"
    rows = [(1, None, None, "x", "x", "x"), (2, "http://a.example/1", "", "x", "x", "x"), (3, "not a url", "<p>plain", "x", "x", "x"),
            (3, "not a url", "<p>plain", "x", "x", "x"), (None, "http://a.example/2", "<article>" + "<p>long text</p>" * 20_000, "x", "x", "x"),
            (5, "http://a.example/3", "<a \"" * 3000, "x", "x", "x")]
    df = html_text.extract(spark.createDataFrame(rows, schema))
    r = {x["page_id"]: x for x in df.collect()}
    assert df.count() == len(rows)
    assert r[1]["text"] == "" and r[1]["n_chars"] == 0 and r[3]["text"] == "plain"
    assert r[None]["text"].count("long text") == 20_000
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0
