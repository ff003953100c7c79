"""The dealt operators bound to the test tables: ``queries()`` and
``oracle_sql()``. Each query is a thin layer over its operator."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtrack.llm import (
    chat, langid, lexical, mixing, neardup, packing, products, quality_model, quality_rules, spelling, syncmers, toxicity, warc,
)
from groundtrack.llm.common import crc_mod, saved


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(n: int, rest: int):
    """crc32 of the id modulo ``n`` is ``rest``; never null."""
    return F.coalesce(crc_mod("doc_id", n) == rest, F.lit(False))


def op1_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return syncmers.fingerprint_edits(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the held-out fold are unseen."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    known = _table(spark, sf_dir, "labels").filter(~_fold(5, 0)).select("doc_id", F.col("quality").alias("label"))
    net = quality_model.fit(docs, known)
    return (docs.select("doc_id", _fold(5, 0).alias("held_out"), quality_model.score(F.col("text"), net, docs).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken(*mixing.mix(docs))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of the held-out fold are unseen."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    known = _table(spark, sf_dir, "labels").filter(~_fold(5, 0) & F.col("toxic").isNotNull())
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    model = toxicity.fit(docs.filter(~_fold(5, 0)), known.filter("toxic = 1"), prior)
    return (docs.select("doc_id", _fold(5, 0).alias("held_out"), toxicity.score(F.col("text"), model, docs).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back from it."""
    archive = warc.write_archive(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.parsed(warc.records(spark, archive)).select(
        F.col("key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


#: A conversation whose texts spell the template's marks.
MARKS = r"\### Assistant: </turn> ok"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, and one that spells the marks."""
    rows = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.format_chats(rows.unionByName(extra)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document; cutoffs from all labelled rows."""
    rows = saved(quality_rules.measured(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "measures")
    known = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).distinct()
    cutoffs = quality_rules.fit(rows.join(known, "doc_id"))
    return (rows.withColumn("base_failed", quality_rules.base_failed())
            .select("doc_id", *quality_rules.COUNTS, "base_failed",
                    (~F.col("base_failed") & ~quality_rules.rejected(cutoffs)).alias("kept"), "stratum"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows of the held-out fold do not train."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~_fold(4, 2)))
    return (langid.identify_language(docs.select("doc_id", _fold(4, 2).alias("held_out"), "text"), model)
            .select("doc_id", "held_out", "lang_pred", "score", "ambiguous"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in windows of 1024 ids."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.with_crc(packing.pack(docs, tokenizer_path())).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents alike by 0.8 on shingles of four words."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), words=4)


def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector with all others."""
    return products.top_products(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


#: One (document, run) in so many loses a letter.
DROP_RATE = 199


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their forms and roots."""
    return spelling.spelling_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"), edit=spelling.dropped_letters(DROP_RATE))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.ranked_search(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 _table(spark, sf_dir, "benchmark").select("item_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_syncmers": op1_syncmers,
        "op2_quality": op2_quality,
        "op3_mixing": op3_mixing,
        "op4_toxicity": op4_toxicity,
        "op5_warc": op5_warc,
        "op6_chat": op6_chat,
        "op7_quality_rules": op7_quality_rules,
        "op8_language": op8_language,
        "op9_packing": op9_packing,
        "op10_near_duplicates": op10_near_duplicates,
        "op11_top_products": op11_top_products,
        "op12_spelling": op12_spelling,
        "op13_lexical": op13_lexical,
        "pipeline": corpus_pipeline.run,
    }


#: Sizes, capped targets and the words taken, in closed form: a source's words
#: are taken in passes over its shuffled order, the last pass up to the target.
OP3_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS no FROM sources),
weighted AS (
  SELECT *, [5, 2, 1][(no % 3 + 1)::INT]::BIGINT AS weight, 3 * source_size AS cap FROM numbered),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER up, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER up, 0))::DOUBLE AS level
  FROM weighted WINDOW up AS (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
free AS (SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, no LIMIT 1),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce((SELECT level FROM free) * weight, cap::DOUBLE)) AS target FROM weighted),
placed AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, round(t.target)::BIGINT AS quota,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY md5('0|' || coalesce(r.doc_id::VARCHAR, 'null')), r.size, r.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "at"
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0
            ELSE (quota // source_size) * size + greatest(0, least(size, quota % source_size - "at")) END::BIGINT AS taken
FROM placed
"""


#: Base32 by way of a string of bits.
OP5_SQL = r"""
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha1 FROM pages),
leaders AS (SELECT sha1, max(page_id) AS leader FROM rows GROUP BY sha1),
digests AS (
  SELECT sha1, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + list_sum(list_transform(range(5), lambda j: substr(bits, (5 * i + j + 1)::INT, 1)::INT * (16 >> j::INT)))::INT, 1)), '') AS base32
  FROM (SELECT sha1, array_to_string(list_transform(range(40), lambda i: lpad(
                 bin(instr('0123456789abcdef', substr(sha1, (i + 1)::INT, 1)) - 1), 4, '0')), '') AS bits FROM leaders))
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, base32 AS payload_digest,
       CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> leader THEN leader END AS refers_to
FROM rows JOIN leaders USING (sha1) JOIN digests USING (sha1)
"""

OP6_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
per_turn AS (
  SELECT *, length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
            + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) + length('### : </turn>' || chr(10)) AS formatted FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(formatted)::BIGINT AS formatted_chars
FROM per_turn GROUP BY conv_id
"""

#: Counts, the exact binomial test of every cutoff, and the verdict.
OP7_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
eights AS (
  SELECT doc_id, unnest(r) AS run, unnest(range(1, len(r) + 1)) AS i
  FROM (SELECT doc_id, list_transform(range(1, len(w) - 6), lambda i: md5(array_to_string(w[i:i + 7], ' '))) AS r FROM words WHERE len(w) >= 8)),
runs AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM eights),
repeats AS (
  SELECT doc_id, sum(least(8, coalesce(after - i, 8)))::BIGINT AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM runs WHERE n > 1) GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper, len(list_distinct(w)) AS n_distinct
  FROM words LEFT JOIN repeats r USING (doc_id)),
shares AS (
  SELECT *, CASE WHEN n_words < 50 THEN 0 WHEN n_words < 200 THEN 1 WHEN n_words < 1000 THEN 2 ELSE 3 END::INT AS stratum,
         [CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END,
          CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END, CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0 END,
          CASE WHEN n_words > 0 THEN 1.0::DOUBLE - n_distinct / n_words ELSE 0 END]::DOUBLE[] AS x FROM counts),
grid AS (SELECT r, (c * 5 / 100.0)::DOUBLE AS cutoff FROM unnest(range(1, 6)) AS a(r), unnest(range(1, 21)) AS b(c)),
tested AS (
  SELECT s.stratum, r, cutoff, count(*) FILTER (quality = 1) AS n, count(*) FILTER (quality = 1 AND x[r] > cutoff) AS k,
         count(*) FILTER (quality = 0 AND x[r] > cutoff) AS bad
  FROM shares s JOIN (SELECT DISTINCT doc_id, quality FROM labels) USING (doc_id), grid WHERE quality IN (0, 1) GROUP BY ALL),
tails AS (
  SELECT *, CASE WHEN k > n * 0.02 THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda j:            exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln(0.02) + (n - j) * ln(0.98)))) END AS p FROM tested),
cutoffs AS (
  SELECT stratum, r, arg_max(cutoff, (bad - 10.0 * k) * 1000 + cutoff) AS cutoff FROM tails
  WHERE p <= 0.05 / 20 AND bad - 10.0 * k > 0 GROUP BY stratum, r),
refused AS (SELECT DISTINCT doc_id FROM shares s JOIN cutoffs c ON s.stratum = c.stratum AND s.x[c.r] > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND doc_id NOT IN (SELECT doc_id FROM refused) AS kept, stratum
FROM shares
"""

#: Sets by exact shingles, links by shared shingles, components by recursion.
OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
digests AS (SELECT *, CASE WHEN len(s) > 0 THEN md5(array_to_string(list_sort(s), '|')) END AS digest FROM sets),
classes AS (SELECT digest, min(doc_id) AS rep, any_value(s) AS s, len(any_value(s)) AS n FROM digests WHERE digest IS NOT NULL GROUP BY digest),
shingles AS (SELECT rep, n, unnest(s) AS shingle FROM classes),
links AS (
  SELECT a.rep AS u, b.rep AS v FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(rep, c) AS (SELECT rep, rep FROM classes UNION SELECT e.v, r.c FROM reach r JOIN edges e ON e.u = r.rep AND r.c < e.v),
component AS (SELECT rep, min(c) AS c FROM reach GROUP BY rep)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(c.c, s.doc_id) AS component_id, coalesce(c.c, s.doc_id) = s.doc_id AS kept
FROM digests s LEFT JOIN classes k ON s.digest = k.digest LEFT JOIN component c ON c.rep = k.rep
"""


OP11_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5
"""

#: The checksum by its table of 256 remainders; near words meet at equal texts
#: with one letter masked, or left out.
OP12_SQL = r"""
WITH RECURSIVE remainders AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS r),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
summed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(strlen(s)), lambda i: ('0x' || substr(hex(encode(s)), (2 * i + 1)::INT, 2))::BIGINT),
           lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM (SELECT *, coalesce(doc_id::VARCHAR, 'null') || ':' || run AS s FROM runs WHERE length(run) >= 6), remainders),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM summed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT *, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON b.word = a.head || a.tail
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON b.word = a.head || a.tail),
best AS (
  SELECT word, count(*) AS n_near, min({'m': -other_n, 'w': encode(other), 'o': other}) AS m FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -m.m >= 5 * w.n THEN m.o END AS form, CASE WHEN -m.m >= 5 * w.n THEN -m.m END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain(word, here) AS (
  SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.here WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.here AS root FROM chain c JOIN forms f ON f.word = c.here WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN ends USING (word)
"""

OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
size AS (SELECT count(*) FILTER (len(t) > 0)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM docs),
tf AS (SELECT doc_id, len(t) AS n, term, count(*) AS tf FROM (SELECT doc_id, t, unnest(t) AS term FROM docs) GROUP BY ALL),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term), size GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": OP3_SQL, "op5_warc": OP5_SQL, "op6_chat": OP6_SQL, "op7_quality_rules": OP7_SQL, "op10_near_duplicates": OP10_SQL,
            "op11_top_products": OP11_SQL, "op12_spelling": OP12_SQL, "op13_lexical": OP13_SQL}
