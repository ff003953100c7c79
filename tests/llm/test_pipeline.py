"""The pipeline: stages take effect, columns stay, edge rows pass."""

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from groundtrack.llm import common

D = "/root/testdata/sf0.001"
WORDS = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{D}/documents.parquet"), []
    for name, stage in cp.STAGES:
        nxt = cp.saved(stage(spark, docs, D), name)
        out.append((name, docs, nxt))
        docs = nxt
    return out


def test_stages_keep_the_columns(stages):
    assert [n for n, _, _ in stages] == ["language_id", "quality_rules", "near_duplicates", "mixing", "packing"]
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns and 0 < after.count()


def test_decisions_take_effect(stages):
    _, before, after = stages[1]
    n = F.regexp_count("text", F.lit(WORDS))
    assert after.filter(n < 20).count() == 0 and after.count() <= before.filter(n >= 20).count()
    _, before, after = stages[2]
    assert after.join(before, before.columns, "left_anti").count() == 0
    _, before, after = stages[3]
    words = [d.agg(F.sum(n)).first()[0] for d in (before, after)]
    assert abs(words[0] - words[1]) <= before.select("source").distinct().count()
    _, docs, pieces = stages[4]
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
    assert pieces.filter("start + length = doc_tokens").count() == docs.count()


def test_run_equals_its_stages(spark, stages):
    got, want = cp.run(spark, D), stages[-1][2]
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert got.count() == want.count() and got.agg(F.sum("length")).first() == want.agg(F.sum("length")).first()
    assert got.select(cols).exceptAll(want.select(cols)).count() <= got.count() // 20      # cuts may move with the order


EDGES = [(1, None, "en", "s", 0, 1), (2, "", None, None, 0, 1), (3, "12345 " * 40, "en", "s", 0, 1), (None, "the cat sat on the mat and " * 5, "en", "s", 0, 1)] + [
    (10 + i, " ".join(f"w{(i * 37 + j * j) % 997}" for j in range(60)), "en", "s", 0, 1) for i in range(6)] + 2 * [
    (30, " ".join(f"q{j * j % 997}" for j in range(50)), "en", None, 0, 1)]


def test_edge_rows_pass_every_stage(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string, n_chars long, size int")
    for name, stage in cp.STAGES[:-1]:
        for d in (docs, docs.limit(0)):
            out = cp.saved(stage(spark, cp.saved(d, "in"), D), name)
            assert out.columns == docs.columns
            out.count()
    near = cp.near_duplicate_stage(spark, cp.saved(docs, "in"), D)
    assert near.filter("doc_id = 30").count() == 1 and near.filter("doc_id is null").count() == 1
    assert cp.language_stage(spark, cp.saved(docs, "in"), D).filter("doc_id in (1, 2, 3)").count() == 0


def test_unlike_documents_of_one_id_stay(spark):
    def text(a, n=60):
        return " ".join(f"{a}{j * j % 997}" for j in range(n))
    rows = [(5, text("a"), "s"), (5, text("b"), "s"), (5, text("a"), "r"), (6, text("b"), "s"), (4, text("c"), "s"),
            (9, text("c") + " end", "s"), (None, text("a"), "s"), (7, None, "s"), (7, None, "s"), (7, "", "s"), (8, "few words", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for parts in (1, 5):
        got = cp.near_duplicate_stage(spark, cp.saved(docs.repartition(parts), "in"), D)
        assert got.columns == docs.columns
        want = [(5, text("a"), "r"), (5, text("b"), "s"), (4, text("c"), "s"), (None, text("a"), "s"), (7, None, "s"), (7, "", "s"),
                (8, "few words", "s")]
        rows_of = lambda rs: sorted(((i, t and t[:5] + t[-9:], s) for i, t, s in rs), key=str)
        assert rows_of(got.collect()) == rows_of(want)


def test_partial_documents_are_cut_at_words(spark):
    df = spark.createDataFrame([("a  b\nc d", 1, 3), ("x", 0, 1)], "t string, a int, z int")
    assert [r[0] for r in df.select(cp._words_between("t", "a", "z")).collect()] == ["b\nc", "x"]


def test_batches_to_python_workers_stay_small(spark):
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(conf, None)
    try:
        spark.conf.unset(conf)
        common.bounded_batches(spark)
        assert int(str(spark.conf.get(conf)).rstrip("b")) <= 4 << 20         # several workers of an executor hold one each, a few times over
    finally:
        spark.conf.unset(conf) if old is None else spark.conf.set(conf, old)
