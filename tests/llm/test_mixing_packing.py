"""Mixing against its SQL and invariants; packing against the tokenizers library."""

import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from groundtrack.llm import mixing, packing, queries

D = "/root/testdata/sf0.001"


def duck(sql, d=D):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "embeddings", "benchmark"):
        con.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    return con.sql(sql).df()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    a, b = queries.queries()[name](spark, D).toPandas(), duck(queries.oracle_sql()[name])
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    def rows(x):
        return sorted((tuple(None if pd.isna(v) else v for v in r) for r in x[cols].itertuples(index=False)), key=str)
    assert rows(a) == rows(b)


def mixed(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, no int")
    return mixing.mix(df, **kw)


def test_mix_edges(spark):
    rows = [(1, "a " * 50, "s", 1, 1), (1, "a " * 50, "s", 1, 1), (2, None, "s", 1, 1), (3, "", None, 1, 1), (4, "b " * 900, None, 1, 1), (5, "c", "Z", 1, 1),
            (None, "d e f", "t", 1, 1), (7, "x " * 30_000, "u", 1, 1), (8, " ", "empty", 1, 1)]
    plan, laid, parts = mixed(spark, rows, block=64)
    out = mixing.taken(plan, laid, parts).toPandas()
    assert len(out) == len(rows) and (out.taken <= 3 * out["size"]).all() and (out[out["size"] == 0].taken == 0).all()
    p = plan.toPandas().sort_values("no")
    assert p.source.tolist() == ["Z", "empty", "s", "t", "u", None] and p.weight.tolist() == [5, 2, 1, 5, 2, 1]
    assert out.taken.sum() == p.quota.sum() and p.target.sum() == pytest.approx(p.source_size.sum())
    assert (p.target <= 3 * p.source_size + 1e-9).all()
    assert mixing.taken(*mixed(spark, rows, block=64)).toPandas().astype(str).sort_values(["doc_id", "size"]).values.tolist() == out.astype(str).sort_values(["doc_id", "size"]).values.tolist()


def test_mix_of_nothing(spark):
    for rows in ([], [(1, None, "a", 1, 1)]):
        plan, laid, parts = mixed(spark, rows)
        assert parts.count() == 0 and mixing.taken(plan, laid, parts).count() == len(rows)


def test_schedule_is_even_and_exact(spark, monkeypatch):
    rows = [(i, "w " * 400, f"s{i % 4}", 1, 1) for i in range(200)]
    plan, laid, parts = mixed(spark, rows, block=16)
    s = mixing.schedule(plan, 16).toPandas().sort_values("slot")
    p = plan.toPandas().set_index("no").sort_index()
    assert (s.groupby("no").apply(lambda g: (g.hi - g.lo).sum(), include_groups=False) == p.quota[p.quota > 0]).all()
    share = p.quota / p.quota.sum()
    for upto in (100, 500, 2000):                                    # every beginning is near the shares
        got = s.head(upto).no.value_counts() / upto
        assert (got.reindex(share.index).fillna(0) - share).abs().max() < 0.05
    assert s.groupby("no").apply(lambda g: (g["rank"].to_numpy() == np.arange(len(g))).all(), include_groups=False).all()


EDGES = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "no id"), (5, "a long text of words " * 6000), (6, "<|endoftext|> inside"), (7, "  two  spaces\n\n\tand\x0b more é日本")]


@pytest.fixture(scope="module")
def expected():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_packing_edges(spark, expected):
    df = spark.createDataFrame([(i, t, 1) for i, t in EDGES], "doc_id long, text string, at int").repartition(3)
    out = packing.pack(df, queries.tokenizer_path()).toPandas()
    want = sorted(sum((expected(t) for _, t in EDGES), []))
    got = np.concatenate([np.frombuffer(bytes(b), "<u4") for b in out.ids])
    assert sorted(got.tolist()) == want
    g = out.sort_values(["sequence_id", "offset"])
    assert ((g.sequence_id * 1024 + g.offset).to_numpy() == np.concatenate([[0], g.length.cumsum()[:-1]])).all()
    assert packing.pack(df.limit(0), queries.tokenizer_path()).count() == 0


def test_packing_whole_table(spark, expected):
    texts = dict(spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect())
    out = queries.op9_packing(spark, D).toPandas()
    ids = {k: np.array(expected(t), "<u4") for k, t in texts.items()}
    for r in out.itertuples():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
    assert out.length.sum() == sum(map(len, ids.values()))


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 300_000 + "x", "a" * 1_000_000, "é" * 60_000, "word " * 5 + "\t" * 25_000 + " end", "!?" * 30_000, "日本" * 20_000])
def test_endless_words_have_the_library_s_ids(expected, text):
    assert [*packing.encoder(queries.tokenizer_path())(text), 0] == expected(text)


def test_five_million_blanks_pack(spark):
    df = spark.createDataFrame([(1, 5_000_000, " "), (2, 5_000_000, "\n"), (3, 3, "a b")], "doc_id long, n int, c string").repartition(3)
    out = packing.pack(df.selectExpr("doc_id", "repeat(c, n) as text"), queries.tokenizer_path()).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert len(out) == 3 and all(r[1] == r[2] > 1 for r in out)


def test_files_with_another_rule_go_to_the_library(tmp_path):
    import json
    spec = json.load(open(queries.tokenizer_path(), encoding="utf-8"))
    spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Whitespace"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
    (tmp_path / "t.json").write_text(json.dumps(spec))
    from tokenizers import Tokenizer
    text = "some words, and 12 more."
    assert packing.Encoder(str(tmp_path / "t.json"))(text) == Tokenizer.from_file(str(tmp_path / "t.json")).encode(text, add_special_tokens=False).ids


def test_sequences_are_padded(spark):
    out = packing.sequences(packing.pack(spark.createDataFrame([(1, "word " * 3000), (2, "x")], "doc_id long, text string"), queries.tokenizer_path())).toPandas()
    assert out.n_tokens.tolist().count(1024) == len(out) - 1 and out.ids.map(len).eq(1024).all()


def test_ids_leave_a_worker_in_small_parts(spark):
    docs = spark.range(0, 400, 1, 1).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 5000), x -> cast(hash(id, x) as string))) as text")
    tokens = packing.tokenized(docs, queries.tokenizer_path())
    groups = [pq.ParquetFile(f.removeprefix("file://")).num_row_groups for f in tokens.inputFiles()]
    assert max(groups) > 1 and tokens.agg(F.count("*"), F.max(F.col("at") + F.col("n")) == F.sum("n")).first() == (400, True)


def test_large_ids_stay_exact_beside_a_null_id(spark):
    ids = [2**62 + 1, 2**62 + 3, None, -(2**60) - 7]
    docs = spark.createDataFrame([(i, f"some words {n}") for n, i in enumerate(ids)], "doc_id long, text string").coalesce(1)
    got = packing.pack(docs, queries.tokenizer_path(), length=8)
    assert {r[0] for r in got.select("doc_id").collect()} == set(ids) and got.schema["doc_id"].dataType.simpleString() == "bigint"


def test_idle_workers_hold_no_encoder(spark):
    """They wait beside the workers of the stages that follow."""
    docs = spark.range(400).selectExpr("id doc_id", "concat('some words about ', id) text").repartition(16)
    assert packing.pack(docs, queries.tokenizer_path()).count() > 0

    def held(batches):
        for pdf in batches:
            yield pd.DataFrame({"n": [len(packing._encoders)] * len(pdf)})

    assert spark.range(64).repartition(16).mapInPandas(held, "n bigint").agg(F.max("n")).first()[0] == 0
