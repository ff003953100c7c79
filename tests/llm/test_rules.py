"""Quality rules: counts against Python, cutoffs against exact arithmetic."""

import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from groundtrack.llm import queries, quality_rules as qr

D = "/root/testdata/sf0.001"
W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w, lines = W.findall(t), [x for x in t.split("\n") if W.search(x)]
    runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n, covered = Counter(runs), set()
    for i, r in enumerate(runs):
        if n[r] > 1:
            covered.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    texts = dict(spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op7_quality_rules(spark, D).collect()
    assert len(rows) == len(texts)
    for r in rows:
        b = brute(texts[r["doc_id"]])
        assert tuple(r[c] for c in qr.COUNTS) == b
        assert r["base_failed"] == (b[0] < 20 or 100 * b[4] > 30 * b[0])
        assert not (r["kept"] and r["base_failed"])


@pytest.mark.parametrize("text", [None, "", "  \n\t", "a", "a a a a a a a a a", "a\nb\na\n\n \na", "x" * 50_000, "q w e r t y u i " * 3000, "#*$%&|<> é ß x\x85y"])
def test_edge_texts(spark, text):
    r = qr.measured(spark.createDataFrame([(text, 5)], "text string, n_lines int")).first()
    assert tuple(r[c] for c in qr.COUNTS) == brute(text) and r["n_lines"] == 5


@pytest.mark.parametrize("n,k,rate", [(1, 0, 0.02), (50, 3, 0.1), (400, 2, 0.02), (400, 30, 0.02), (3000, 40, 0.02), (0, 0, 0.02)])
def test_binomial_tail_is_exact(spark, n, k, rate):
    p = Fraction(rate).limit_denominator(1000)
    exact = float(sum(comb(n, j) * p**j * (1 - p)**(n - j) for j in range(k + 1)))
    got = spark.range(1).select(qr.binomial_tail(F.lit(n), F.lit(k), rate)).first()[0]
    assert got == (1.0 if k > n * rate else pytest.approx(exact, rel=1e-9))


def labelled(spark, n_good, n_bad, bad_x):
    cols = "label int, stratum int, " + ", ".join(f"x_{r} double" for r in qr.RULES)
    good = [(1, 1, 0.0, 0.01 * (i % 5), 0.0, 0.02, 0.2) for i in range(n_good)]
    bad = [(0, 1, bad_x, 0.0, 0.0, 0.02, 0.2) for _ in range(n_bad)]
    return spark.createDataFrame(good + bad + [(None, 1, 9.0, 0.0, 0.0, 0.0, 0.0)], cols)


def test_cutoffs_need_evidence_and_use(spark):
    assert qr.fit(labelled(spark, 30, 30, 0.9)) == {}                  # too few good rows to bound the risk
    assert qr.fit(labelled(spark, 800, 30, 0.9)) == {(1, "symbols"): 0.85}
    assert qr.fit(labelled(spark, 800, 0, 0.9)) == {}                  # nothing to reject
    assert qr.fit(labelled(spark, 0, 0, 0.9)) == {}


def test_allowed_cutoffs_bound_the_risk(spark):
    rows = qr.tested_cutoffs(labelled(spark, 800, 30, 0.9)).filter("allowed").collect()
    assert rows and all(r["good_rejected"] <= qr.RISK / len(qr.RULES) * r["n_good"] for r in rows)


def test_native_plan_and_empty_table(spark):
    df = qr.measured(spark.createDataFrame([], "doc_id long, text string"))
    assert df.count() == 0
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
