"""Held-out accuracy and edge rows of the three classifiers."""

import numpy as np
import pytest

from groundtrack.llm import langid, quality_model, queries, toxicity

D = "/root/testdata/sf0.01"
EDGES = [(1, None, "x"), (2, "", "x"), (3, " \n\t", "x"), (4, "12 34 ...", "x"), (5, "the cat and the dog " * 4000, "x"), (6, "die Katze und der Hund", "x"),
         (6, "die Katze und der Hund", "x"), (None, "una casa", "x")]


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"))
    return (rank[y == 1].mean() - ((y == 1).sum() - 1) / 2) / (y == 0).sum()


def test_language_held_out(spark):
    got = queries.op8_language(spark, D).toPandas().merge(spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang == held.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()


@pytest.fixture(scope="module")
def two_languages(spark):
    rows = [(i, t, lang) for i in range(40) for t, lang in (("the cat and the other dog went there", "en"), ("die Katze und der andere Hund gingen", "de"))]
    return langid.fit(spark.createDataFrame([*rows, (99, None, "de"), (100, "text", None)], "doc_id long, text string, lang string"))


def test_language_edges(spark, two_languages):
    df = spark.createDataFrame(EDGES, "doc_id long, text string, score string")
    got = [r.asDict() for r in langid.identify_language(df, two_languages, prefix="p_").collect()]
    assert [r["p_lang_pred"] for r in got[:7]] == ["und"] * 4 + ["en", "de", "de"]
    assert all(r["score"] == "x" for r in got) and got[0]["p_score"] == 0
    none = langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in langid.identify_language(df.drop("score"), none).collect()} == {"und"}


@pytest.mark.parametrize("k", [1, 2, 4, 7, 12, 60])
def test_codewords_differ(k):
    code = langid.codebook(k).astype(int)
    distance = (code.shape[1] - code @ code.T) // 2
    assert k == 1 or distance[~np.eye(k, dtype=bool)].min() >= (1 if k < 4 else code.shape[1] // 5)


def test_quality_held_out(spark):
    got = queries.op2_quality(spark, D).toPandas().merge(spark.read.parquet(f"{D}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert ((held.predicted == 1) == (held.score >= 0.3)).all() and got.score.between(0, 1).all()


def test_quality_edges(spark):
    df = spark.createDataFrame(EDGES, "doc_id long, text string, token string")
    from pyspark.sql import functions as F
    for labels in ([], [(1, 1), (2, 1)], [(i, i % 2) for i in range(1, 7)] + [(3, None), (None, 1)]):
        net = quality_model.fit(df, spark.createDataFrame(labels, "doc_id long, label int"))
        s = [r[0] for r in df.select(quality_model.score(F.col("text"), net, df)).collect()]
        assert len(s) == len(EDGES) and all(0 <= x <= 1 for x in s) and s[5] == s[6]
    empty = df.limit(0)
    assert quality_model.context_vectors(empty).shape == (quality_model.VOCABULARY, quality_model.DIMENSIONS)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    logit = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-logit))).astype(float)
    assert quality_model.temperature_of(3 * logit, y) == pytest.approx(3, rel=0.25)


def planted(n=400):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "nu") for b in ("ra", "se", "ti", "vo", "zu", "pe")]
    text = [list(rng.choice(words, 80)) for _ in range(n)]
    for t in text[: n // 8]:
        for at in rng.choice(80, 4, replace=False):
            t[at] = "vileword"
    return [" ".join(t) for t in text]


def test_toxicity_learns_from_positives_only(spark):
    texts = planted()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame([(i,) for i in range(0, 50, 2)], "doc_id long"), prior=50 / 400)
    score = model.score([t.encode() for t in texts])
    assert (score[:50] >= 0.5).all() and (score[50:] < 0.5).all()          # the odd ones were never labelled


def test_toxicity_held_out(spark):
    got = queries.op4_toxicity(spark, "/root/testdata/sf0.1").toPandas().merge(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert auc(held.score.to_numpy(), held.toxic.to_numpy()) > 0.93
    assert held[held.toxic == 0].predicted.mean() < 0.01 and held[held.toxic == 1].predicted.mean() > 0.8


def test_toxicity_edges(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGES, "doc_id long, text string, k string")
    for rows, prior in (([], 0.0), ([(5,)], 0.3), ([(5,), (5,), (77,)], 1.0)):
        model = toxicity.fit(df, spark.createDataFrame(rows, "doc_id long"), prior)
        s = [r[0] for r in df.select(toxicity.score(F.col("text"), model, df)).collect()]
        assert all(0 <= x <= 1 for x in s) and s[5] == s[6] and s[0] == s[1]
    assert toxicity.fit(df.limit(0), spark.createDataFrame([], "doc_id long"), 0.0).score([b""])[0] < 0.01
