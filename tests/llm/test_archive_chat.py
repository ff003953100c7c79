"""WARC archive and chat formatting: exact round trips."""

import base64
import hashlib

import pytest
from pyspark.errors import PythonException, SparkRuntimeException

from groundtrack.llm import chat, queries, warc

PAGES = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, ""), (4, "http://c/", None), (5, "http://d/", "é" * 40_000), (6, "http://e/", "same"),
         (6, "http://e/", "same"), (None, "http://f/", "same"), (9, "http://g/", "a\r\n\r\nb")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, address string")


def test_round_trip(spark, pages):
    a = warc.write_archive(pages)
    rows = [r.asDict() for r in warc.parsed(warc.records(spark, a)).collect()]
    assert len(rows) == len(PAGES)
    by = {}
    for r in rows:
        by.setdefault(r["key"], []).append(r)
    assert [r["record_type"] for r in by["9"]] == ["response"]
    assert sorted(r["record_type"] for r in by["6"]) == ["response", "revisit"]
    assert {r["refers_to"] for k in ("1", "2", None) for r in by[k]} == {"6"}
    assert by["4"][0]["record_type"] == "response" and by["3"][0]["refers_to"] == "4" and by["3"][0]["payload_bytes"] == 0
    for (k, _, html) in PAGES:
        p = (html or "").encode()
        for r in by[None if k is None else str(k)]:
            assert r["payload_bytes"] == len(p) and r["payload_digest"] == base64.b32encode(hashlib.sha1(p).digest()).decode()
    payloads, headers = a.read(spark)
    assert payloads.count() == len({h or "" for _, _, h in PAGES}) and headers.count() == len(PAGES)
    full = warc.payload_of(spark, a).collect()
    assert sorted(bytes(r["payload"]) for r in full) == sorted((h or "").encode() for _, _, h in PAGES)


def test_records_are_exact_bytes(spark, pages):
    raw = [bytes(r["record"]) for r in warc.records(spark, warc.write_archive(pages)).collect()]
    for r in raw:
        fields, block = warc.parse_record(r)
        assert r.startswith(b"WARC/1.1\r\nWARC-Type: ") and len(block) == int(fields["Content-Length"])
    assert len({warc.parse_record(r)[0]["WARC-Record-ID"] for r in raw}) == len(raw)


def test_small_payloads_are_responses(spark, pages):
    kinds = [r["record_type"] for r in warc.parsed(warc.records(spark, warc.write_archive(pages, least=5))).collect()]
    assert set(kinds) == {"response"}
    assert warc.parsed(warc.records(spark, warc.write_archive(pages.limit(0)))).count() == 0


def test_a_changed_payload_is_noticed(spark, pages):
    from pyspark.sql import functions as F
    a = warc.write_archive(pages.filter("page_id = 9"))
    spoiled = a.payloads + "_spoiled"
    spark.table(a.payloads).withColumn("payload", F.lit(b"other")).write.mode("overwrite").saveAsTable(spoiled)
    with pytest.raises((SparkRuntimeException, PythonException)):
        warc.records(spark, warc.Archive(spoiled, a.headers)).collect()
    spark.sql(f"drop table {spoiled}")


TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", queries.MARKS), (1, 2, "assistant", None), (2, None, None, "a"), (2, 0, "user", ""), (2, 0, "user", ""),
         (None, 0, "assistant", "\\\\#<:é\n### x: y</turn>\n"), (3, 0, "a:b\\", "x" * 100_000), (4, 0, "assistant", "日本" * 2000)]


@pytest.mark.parametrize("rows_a_batch", ["3", "10000"])
def test_chat_round_trip(spark, rows_a_batch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows_a_batch)
    try:
        many = [(8, i, "assistant" if i % 2 else "user", f"turn {i} #") for i in range(200)]
        df = spark.createDataFrame([(*t, 1) for t in TURNS + many], "conv_id long, turn long, role string, text string, piece int")
        out = {r["conv_id"]: r for r in chat.digests(chat.format_chats(df)).collect()}
    finally:
        spark.conf.set(key, before)
    groups = {}
    for c, n, r, t in sorted(TURNS + many, key=lambda x: (-1 if x[1] is None else x[1], x[2] or "", x[3] or "")):
        groups.setdefault(c, []).append((r or "", t or ""))
    assert out.keys() == groups.keys()
    for c, turns in groups.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert out[c]["n_turns"] == len(turns)
        assert out[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_template_and_mask(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "a<b")], "conv_id long, turn long, role string, text string")
    r = chat.format_chats(df).first()
    assert r["formatted"] == "### user: hi</turn>\n### assistant: a\\<b</turn>\n"
    assert [r["formatted"][s["begin"]:s["end"]] for s in r["loss"]] == ["a\\<b"]
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0
