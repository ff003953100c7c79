"""From raw documents to packed sequences: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet to the shared folder and reads again as the next stage's
documents. All but the last return the columns of their input, extra ones
included; rows with an id that occurs again are told apart by their content.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from groundtrack.llm import langid, mixing, neardup, packing, quality_rules
from groundtrack.llm.common import WORD, saved
from groundtrack.llm.membership import may_be_in

NEAR_WORDS = 5
SEQUENCE = 1024


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language: those without a letter and those whose
    codeword is ambiguous go. Without any language to learn only the former go."""
    model = langid.fit(docs)
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    out = langid.identify_language(docs, model, prefix="__gt_")
    return out.filter("__gt_lang_pred != 'und' and not __gt_ambiguous").select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a risk-controlled cutoff rejects."""
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label")).distinct()
    counts = saved(quality_rules.measured(docs.select("doc_id", "text")).drop("text"), "measures")
    cutoffs = quality_rules.fit(counts.join(known, "doc_id"))
    out = quality_rules.measured(docs, prefix="__gt_")
    return (out.filter(~quality_rules.base_failed("__gt_") & ~quality_rules.rejected(cutoffs, "__gt_"))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest
    id. Rows that share an id are documents of their own, told apart by their
    text: only near duplicates go. Of rows equal in id and text one stays, the
    one whose other columns come first as JSON. Rows without an id stay."""
    repeated = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        found = saved(neardup.near_duplicates(docs, words=NEAR_WORDS), "near")
        return _without(docs, found.filter("not kept").select("doc_id"), "doc_id")
    apart = may_be_in(repeated)(F.col("doc_id"))      # a 64-bit key of id and text; other ids may be among them
    keyed = saved(docs.withColumn("__gt_key", F.when(apart & F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.md5(F.col("text").cast("binary"))))
                                  .otherwise(F.col("doc_id").cast("bigint"))), "keyed")
    found = saved(neardup.near_duplicates(keyed, key="__gt_key", words=NEAR_WORDS), "near")
    rows = keyed.filter("__gt_key is not null")
    classes = found.filter("__gt_key is not null").select("__gt_key", "component_id").distinct()
    stay = (classes.join(rows.select("__gt_key", "doc_id").distinct(), "__gt_key")
            .groupBy("component_id").agg(F.min(F.struct("doc_id", "__gt_key")).alias("m")).select("m.__gt_key"))
    left = _without(keyed, classes.select("__gt_key").join(stay, "__gt_key", "left_anti"), "__gt_key")
    equal = rows.groupBy("__gt_key").count().filter("count > 1").select("__gt_key")
    some = F.col("__gt_key").isNotNull() & may_be_in(equal)(F.col("__gt_key"))
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    one = (left.filter(some).groupBy("__gt_key").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), others).alias("r"))
           .select("r.*"))
    return left.filter(~some).select(docs.columns).unionByName(one)


def _without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``docs`` but for the rows whose key is in ``gone``."""
    gone = gone.distinct()
    asked = may_be_in(gone)(F.col(key))               # most rows need no join, and stay where they are
    return docs.filter(~asked).unionByName(docs.filter(asked).join(gone, key, "left_anti").select(docs.columns))


@F.pandas_udf(StringType())
def _words_between(text: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
    """The text from its word ``first`` to before its word ``last``."""
    out = []
    for t, a, z in zip(text, first, last, strict=True):
        spans = [m.span() for i, m in enumerate(re.finditer(WORD, t)) if a <= i < z] or [(0, 0)]
        out.append(t[spans[0][0]:spans[-1][1]])
    return pd.Series(out)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document comes once for each pass that takes it, and where a
    source's target ends inside it, with the words taken. Wordless ones go."""
    def content(d: DataFrame) -> DataFrame:
        return d.withColumn("__gt_row", F.xxhash64("doc_id", "source", "text"))
    keyed = content(docs)
    plan, laid, parts = mixing.mix(keyed, key="__gt_row")
    # blocks of one pass follow each other, so a row's words in a pass are one range
    takes = parts.groupBy("no", "at", "doc_id", "size", "pass").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    takes = takes.select(F.col("doc_id").alias("__gt_row"), F.col("size").alias("__gt_size"), F.col("first").alias("__gt_first"), F.col("last").alias("__gt_last"))
    if not laid.groupBy("doc_id").count().filter("count > 1").isEmpty():
        keyed = keyed.dropDuplicates(["__gt_row"])           # equal rows have their own takes
    whole = (F.col("__gt_first") == 0) & (F.col("__gt_last") == F.col("__gt_size"))
    out = keyed.join(takes, "__gt_row")
    text = F.when(whole, F.col("text")).otherwise(_words_between(
        F.when(whole, F.lit("")).otherwise(F.col("text")), F.when(whole, 0).otherwise(F.col("__gt_first")),
        F.when(whole, 0).otherwise(F.col("__gt_last"))))
    return out.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token stream in sequences of 1024 ids."""
    return packing.with_crc(packing.pack(docs, tokenizer_path(), length=SEQUENCE))


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Classifiers, sketches and token ids are beyond SQL; tests hold the run
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
