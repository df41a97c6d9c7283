"""Language ID: gradients, held-out accuracy, odd rows."""

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from cohortcast.llm import langid


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    x, mask = rng.integers(0, 256, (7, 3)), np.ones((7, 3))
    mask[5:, 1] = 0
    way = langid._Direction(rng.normal(size=(256, 12)), rng.normal(size=(4, 12)), rng.normal(size=12))
    out = rng.normal(size=(7, 3, 4))
    loss = lambda: float((way.forward(x, mask) * out).sum())
    loss()
    grads = way.backward(x, out)
    for value, grad in zip((way.table, way.recur, way.bias), grads):
        for at in [tuple(rng.integers(0, n) for n in value.shape) for _ in range(6)] + ([(int(x[2, 1]), 5)] if value.shape[0] == 256 else []):
            old = value[at]
            value[at] = old + 1e-6
            up = loss()
            value[at] = old - 1e-6
            down = loss()
            value[at] = old
            assert abs((up - down) / 2e-6 - grad[at]) < 1e-5


def test_reader_equals_training_network():
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 110, n, np.uint8).tobytes() for n in (40, 90, 128)]
    model = langid.train(texts, ["a", "b", "c"], langid.Settings(steps=3))
    p = langid.Reader(model).documents(texts)
    for t, got in zip(texts, p):
        x = np.frombuffer(t, np.uint8)[:, None]
        f, b = (langid._Direction(model.tables[d], model.recurs[d], model.biases[d]) for d in (0, 1))
        ones = np.ones(x.shape)
        each = langid._softmax(f.forward(x, ones) @ model.outs[0] + b.forward(x[::-1], ones)[::-1] @ model.outs[1] + model.offset)
        assert np.allclose(got, each.mean((0, 1)), atol=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 20 and (got.lang_pred == got.lang).mean() > 0.9
    assert got.score.between(0, 1).all()


def test_odd_rows(spark):
    texts = ["the and of to", None, "", " 123 !? ", "der und die", "x" * 40_000, "漢字", "the and of to"]
    rows = [(i, t, "en" if i % 2 else None, "x", 1.0) for i, t in enumerate(texts)] + [(None, "the", "en", "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (1, 2, 3))
    assert got[0].lang_pred == "en" and (got[0].lang_pred, got[0].score) == (got[7].lang_pred, got[7].score)
    kept = langid.predict(docs, langid.learn(docs, F.lit(False)))
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert {r.lang_pred for r in kept.collect()} == {"und"}  # nothing to learn from
    assert langid.identify(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 5000])
def test_sample_is_bounded(spark, n):
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("some words " * 40).alias("text"), F.lit("en").alias("lang"))
    s = langid.Settings(docs_per_language=50)
    assert 1 <= len(langid.sample(docs, F.lit(True), s)) <= 50 * s.windows_per_doc


def test_every_language_is_sampled(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some words " * 40).alias("text"),
                                    F.when(F.col("id") < 2800, "en").otherwise(F.concat(F.lit("l"), F.col("id").cast("string"))).alias("lang"))
    s = langid.Settings(sample_docs=402)
    got = langid.sample(docs, F.lit(True), s)
    assert {lang for _, lang in got} == {"en", *(f"l{k}" for k in range(2800, 3000))}
    assert len([1 for _, lang in got if lang == "en"]) == 2 * s.windows_per_doc


def test_sample_shuffles_no_texts(spark, monkeypatch):
    """The bound of a language goes to the texts, not the texts to the bound."""
    docs = spark.createDataFrame([(i, "some words " * 40, "en" if i % 9 else "de") for i in range(90)], "doc_id long, text string, lang string")
    plans, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: (plans.append(self._jdf.queryExecution().executedPlan().toString()), collect(self))[1])
    got = langid.sample(docs, F.lit(True))
    assert sorted({lang for _, lang in got}) == ["de", "en"] and len(got) == 90 * langid.Settings().windows_per_doc
    below = plans[-1].partition("Window")[2]
    assert "BroadcastHashJoin" in below and "SortMergeJoin" not in below
