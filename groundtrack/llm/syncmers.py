"""Document fingerprints from closed syncmers, in native expressions only.

A text is a sequence of units: words, those of more than 16 code points cut
into pieces of 16. A run of ``k`` units is a closed syncmer when the smallest
hash among its inner runs of ``s`` units stands at its first or last place. The
choice looks at nothing outside the run, so equal passages give equal anchors
wherever they stand, which lets two documents be matched by position.

``fingerprint`` keeps the ``size`` smallest anchor hashes (a bottom-k sketch) as
a string of eight hex digits each; ``likeness`` estimates the Jaccard index of
two documents' anchors from their sketches. ``anchors`` returns every anchor
with its position; ``matches`` lines two sets of documents up by offset.

Defined results: null counts as empty; a text without a unit has the empty
fingerprint; one with units but without a syncmer has one anchor over all of
them; two empty fingerprints are alike by 1, an empty and another by 0; equal
texts have equal fingerprints; rows with the same id are separate rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundtrack.llm.exprs import filled, hashes, let, pieces, positions, windows

UNIT = r"[^\x20\x09-\x0D]{1,16}"
K, S, SIZE = 4, 2, 64
#: Rows per bucket when rows are put in order, and buckets at most.
BUCKET_ROWS, MAX_BUCKETS = 1000, 4096


def _starts(h: Column, k: int, s: int) -> Column:
    """Positions of the closed syncmers in an array of unit hashes."""
    def chosen(inner: Column) -> Column:
        last = k - s
        def edge(i: Column) -> Column:
            ends = F.least(inner[i], inner[i + last])
            return ends <= F.least(*(inner[i + j] for j in range(1, last))) if last > 2 else (
                ends <= inner[i + 1] if last == 2 else F.lit(True))
        return F.filter(positions(F.size(h) - (k - 1)), edge)
    return let(windows(h, s), chosen)


def _anchor(h: Column, i: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *(h[i + j] for j in range(k))).bitwiseAND(F.lit(0xFFFFFFFF))


def sketch(text: Column, k: int = K, s: int = S, size: int = SIZE) -> Column:
    """The ``size`` smallest distinct anchors of a text, ascending."""
    def of(h: Column) -> Column:
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(F.lit(0), h).bitwiseAND(F.lit(0xFFFFFFFF)))).otherwise(
            F.array().cast("array<bigint>"))
        found = F.transform(_starts(h, k, s), lambda i: _anchor(h, i, k))
        return let(found, lambda a: F.when(F.size(a) > 0, F.slice(F.sort_array(F.array_distinct(a)), 1, size)).otherwise(whole))
    return let(hashes(pieces(text, UNIT)), of)


def fingerprint(sketched: Column) -> Column:
    """A sketch as text: eight hex digits an anchor."""
    return F.array_join(F.transform(sketched, lambda a: F.lower(F.lpad(F.hex(a), 8, "0"))), "")


def likeness(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard index of the anchors behind two sketches."""
    def of(union: Column) -> Column:
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union))
    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, size), of)


def anchors(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """(key, position, anchor) of every closed syncmer; positions count units."""
    h = df.select(F.col(key), hashes(pieces(F.col(text), UNIT)).alias("__gt_h"))
    found = let(F.col("__gt_h"), lambda a: F.transform(_starts(a, k, s), lambda i: F.struct(
        i.alias("position"), _anchor(a, i, k).alias("anchor"))))
    return h.select(F.col(key), F.inline(found))


def matches(left: DataFrame, right: DataFrame, key: str = "doc_id") -> DataFrame:
    """Shared anchors of two ``anchors`` tables that occur once in their own
    document, per pair of documents and offset between them. ``left`` is a
    stated query set; ``right`` may be every document."""
    def single(d: DataFrame) -> DataFrame:
        return d.groupBy(key, "anchor").agg(F.count("*").alias("n"), F.min("position").alias("position")).filter("n = 1").drop("n")
    a = single(left).withColumnsRenamed({key: "left_id", "position": "p"})
    b = single(right).withColumnsRenamed({key: "right_id", "position": "q"})
    return (a.join(b, "anchor").groupBy("left_id", "right_id", (F.col("q") - F.col("p")).alias("offset"))
            .agg(F.count("*").alias("n_anchors"), F.min("p").alias("first"), F.max("p").alias("last")))


def _bucket(k: Column, bounds: list[int], width: int = 64) -> Column:
    """How many of the sorted bounds are below ``k``, in two short steps."""
    def constant(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    if not bounds:
        return F.lit(0)
    full = F.size(F.filter(constant(bounds[width - 1::width]), lambda x: x < k)) if len(bounds) >= width else F.lit(0)
    return let(full, lambda c: c * width + F.size(F.filter(F.slice(constant(bounds), c * width + 1, F.lit(width)), lambda x: x < k)))


def with_next(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``df`` (an integer key and ``columns``) with ``next_<column>``: the values
    of the next row by descending key, of the first row after the last. Equal
    keys go by the columns, descending; a null key comes last.

    Rows are dealt into ranges of the key, each put in order by itself. The
    last row of a range needs the first of the range below, which is sent
    along as an extra row; so each row moves once, and no range grows with the
    table (up to ``MAX_BUCKETS`` ranges).
    """
    k = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))
    ids = df.select(k.alias("k"))
    rows = ids.count()
    n = max(1, min(MAX_BUCKETS, rows // BUCKET_ROWS))
    bounds: list[int] = []
    if n > 1:
        cut = ids.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 20 * n)).first()[0]
        bounds = sorted(set(cut))
    tops = sorted(ids.groupBy(_bucket(F.col("k"), bounds).alias("b")).agg(F.max("k").alias("top")).collect())   # n rows at most
    wanted = [(tops[i - 1]["top"], tops[i]["b"]) for i in range(len(tops))]       # the first range gets the very top
    ghosts = F.broadcast(df.sparkSession.createDataFrame(wanted or [(0, -1)], "__top bigint, __to int"))
    order = [F.col("__ghost"), F.col("__k").desc(), *(F.col(c).desc() for c in columns)]
    w = Window.partitionBy("__b").orderBy(*order)
    return (df.withColumn("__k", k).withColumn("__b", _bucket(F.col("__k"), bounds))
            .join(ghosts, F.col("__k") == F.col("__top"), "left")
            .withColumn("__at", F.explode(F.when(F.col("__to").isNull(), F.array(F.struct(F.col("__b").alias("b"), F.lit(0).alias("g")))).otherwise(
                F.array(F.struct(F.col("__b").alias("b"), F.lit(0).alias("g")), F.struct(F.col("__to").alias("b"), F.lit(1).alias("g"))))))
            .select(key, *columns, "__k", F.col("__at.b").alias("__b"), F.col("__at.g").alias("__ghost"))
            .withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
            .filter("__ghost = 0").drop("__k", "__b", "__ghost"))


def fingerprint_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, whose second half is
    replaced by the beginning of the next document's text."""
    docs = df.select(F.col(key), filled(F.col(text)).alias("text")).withColumn("sketch", sketch(F.col("text")))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"),
                      F.col("next_text").substr(F.lit(1), half))
    return (with_next(docs, key, ["text", "sketch"])
            .select(F.col(key), F.length("text").cast("bigint").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
            .withColumn("edited_sketch", sketch(F.col("edited")))
            .select(F.col(key), "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                    fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
                    likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next")))
