"""Closed syncmers against a plain Python version."""

import hashlib
import re
import struct

import pytest
import xxhash

from groundtrack.llm import queries, syncmers


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def _chain(values, seed=42):
    """Spark's xxhash64 of several longs (ints where marked)."""
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v), seed)
    return _signed(seed)


def brute(text):
    h = [_signed(xxhash.xxh64_intdigest(u.encode(), 42)) for u in re.findall(syncmers.UNIT, text or "")]
    if not h:
        return []
    k, s = syncmers.K, syncmers.S
    inner = [_chain(h[i:i + s]) for i in range(len(h) - s + 1)]
    found = set()
    for i in range(len(h) - k + 1):
        run = inner[i:i + k - s + 1]
        if min(run) in (run[0], run[-1]):
            found.add(_chain([(k,), *h[i:i + k]]) & 0xFFFFFFFF)
    return sorted(found or {_chain([(0,), *h]) & 0xFFFFFFFF})[: syncmers.SIZE]


def near(a, b):
    union = sorted(set(a) | set(b))[: syncmers.SIZE]
    return 1.0 if not union else len(set(a) & set(b) & set(union)) / len(union)


def expected(rows):
    """Rows of (id, text), by descending id."""
    out = {}
    for i, (k, t) in enumerate(rows):
        t, n = t or "", rows[(i + 1) % len(rows)][1] or ""
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        a, b, c = brute(t), brute(e), brute(n)
        hexed = ["".join(f"{x:08x}" for x in s) for s in (a, b)]
        out[k] = (len(t), hashlib.sha256(e.encode()).hexdigest(), *hexed, near(a, b), near(a, c))
    return out


def got(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"))
            for r in df.collect()}


def check(df, rows):
    a, b = got(df), expected(rows)
    assert a.keys() == b.keys()
    for k in b:
        assert a[k][:4] == b[k][:4]
        assert a[k][4:] == pytest.approx(b[k][4:])


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.op1_syncmers(spark, d), sorted(rows, reverse=True))


def test_edge_rows(spark):
    rows = [(9, None), (7, ""), (5, "one"), (4, "one"), (3, " \t\n "), (2, "x" * 100_000), (1, "word " * 30_000), (-4, "é ü ñ 日本語 end of it all")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, sketch string, __b int")
    out = syncmers.fingerprint_edits(df)
    check(out, rows)
    g = got(out)
    assert g[5][2] == g[4][2] != "" and g[9][2] == g[7][2] == ""


def test_empty_single_and_null_id(spark):
    schema = "doc_id long, text string"
    assert syncmers.fingerprint_edits(spark.createDataFrame([], schema)).count() == 0
    check(syncmers.fingerprint_edits(spark.createDataFrame([(1, "only one row here")], schema)), [(1, "only one row here")])
    rows = [(3, "a b c d e"), (3, "a b c d e"), (1, "z"), (None, "last of all")]
    assert syncmers.fingerprint_edits(spark.createDataFrame(rows, schema)).count() == 4


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", 7)
    rows = [(i * i * (-1) ** i, f"text {i} " * (i % 9)) for i in range(300)]
    check(syncmers.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")), sorted(rows, reverse=True))


def test_anchors_match_by_position(spark):
    body = " ".join(f"w{i * 7919 % 1000}" for i in range(200))
    df = spark.createDataFrame([(1, body), (2, "some other words first " + body), (3, "nothing alike")], "doc_id long, text string")
    a = syncmers.anchors(df)
    m = syncmers.matches(a.filter("doc_id = 1"), a.filter("doc_id > 1")).collect()
    assert [(r["right_id"], r["offset"]) for r in m] == [(2, 4)] and m[0]["n_anchors"] > 50


def test_native_plan(spark):
    plan = queries.op1_syncmers(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
