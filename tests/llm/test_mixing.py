"""Mixing against its SQL, and what a recipe promises."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortcast.llm import mixing

RECIPES = {"production": mixing.PRODUCTION, "one epoch": mixing.Recipe(share=0.8, max_epochs=1),
           "scarce": mixing.Recipe(weights={"domain": {f"domain{k}": 10.0 ** k for k in range(4)}, "lang": {"de": 50.0}}, share=1.4, max_epochs=3),
           "nothing": mixing.Recipe(share=0.0)}


def corpus(n=400):
    langs = ["en", "en", "en", "de", "fr", None]
    return [(i, " ".join(["w"] * (i * 37 % 90)) if i % 11 else (None if i % 2 else ""), langs[i % 6],
             None if i % 29 == 0 else "src0" if i % 3 else f"src{i % 8}") for i in range(n)]


def mixed(spark, rows, recipe):
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, lang string, source string, tokens int, epoch string")
    out = mixing.mix(docs.repartition(3), recipe)
    assert out.columns == ["doc_id", "text", "lang", "source", "tokens", "epoch"]
    return out


@pytest.mark.parametrize("name", RECIPES)
@pytest.mark.parametrize("bucket_rows", [2048, 10])
def test_equals_sql(spark, monkeypatch, name, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    rows = corpus()
    got = sorted(((r.doc_id, r.lang, r.source, r.epoch) for r in mixed(spark, rows, RECIPES[name]).collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    assert got == sorted(con.sql(mixing.oracle(RECIPES[name])).fetchall(), key=str)


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10, 1), ("a", "x", "2", 1000, 1), ("b", "x", "1", 1000, 1)],
                                   "domain string, lang string, source string, tokens long, rows long")
    quota = {(r.domain, r.source): r.quota for r in mixing.leaf_budgets(leaves, mixing.Recipe(share=0.5, max_epochs=1)).collect()}
    assert quota == {("a", "1"): 10, ("a", "2"): 492, ("b", "1"): 502}


def test_weight_zero_repeated_rows_and_empty_table(spark):
    rows = corpus(60)
    none = mixed(spark, rows, mixing.Recipe(weights={"lang": {"en": 0.0}}, share=1.0)).where("lang = 'en' AND text <> ''")
    assert none.count() == 0
    twice = mixed(spark, rows + rows, mixing.Recipe(share=0.5, max_epochs=1)).groupBy("doc_id", "text").count()
    assert {r["count"] for r in twice.collect()} == {2}
    assert mixed(spark, rows, mixing.PRODUCTION).limit(0).count() == 0
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0
    assert mixing.mix(spark.createDataFrame([(1, None, None, None)], "doc_id long, text string, lang string, source string")).count() <= 2
    assert mixing.mix(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("en").alias("lang"),
                                            F.lit("s").alias("source")), domain=F.lit("d")).count() >= 1
