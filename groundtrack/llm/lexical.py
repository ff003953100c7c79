"""Ranked lexical search without random access (NRA).

Every document is tokenized once; of its terms, those that a query asks for are
kept with their counts. The counts of documents (N), terms (L) and documents a
term is in are sums over all rows. Documents then lie in shards of bounded size,
each an inverted index of its own: per term, the shard's documents by descending
impact. For every query a shard reads its terms' lists sequentially, in steps
that grow fourfold. A document that was met has a lower bound, the impacts read
so far, and an upper bound, that plus the next unread impact of each list it was
not met in; a document not met at all has the sum of those impacts. Reading goes
on until no other document can reach the k-th lower bound, ties included, and the
bounds of all that can agree: membership, ties and scores are then final. A first
pass over a share of the documents gives each query a threshold that every shard
starts with; the shards' results, at most k a query each, are merged.

Queries are shared with the tasks in slices of bounded size, one pass each.

Defined results: a null or termless text matches nothing; a query without terms
has no result; rows of one id are documents of their own; among equal scores a
null id comes last; equal queries (id and text) count once, unlike texts under
one id are ranked each; an empty table gives no row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundtrack.llm.common import bounded_batches, saved

#: A term in UTF-8: ASCII letters and digits, and all bytes beyond ASCII.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Documents, and their kept terms, of a shard.
SHARD_ROWS, SHARD_TERMS = 16_384, 2_000_000
#: Terms of the queries that one pass shares with the tasks.
SLICE_TERMS = 1_000_000
#: One document in so many gives the first thresholds.
PILOT = 64
#: Postings read of each list in the first step.
STEP = 64


def terms(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode().lower())


def counted(docs: DataFrame, key: str, text: str, vocabulary) -> DataFrame:
    """Per document: key, n (its terms), and the numbers and counts of those in
    ``vocabulary``, a shared dictionary, as 32-bit arrays."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = vocabulary.value
        for pdf in batches:
            out = []
            for t in pdf["t"]:
                all_ = Counter(terms(t))
                own = [(number[w], c) for w, c in all_.items() if w in number]
                out.append((sum(all_.values()), np.array([x for x, _ in own], np.int32).tobytes(), np.array([c for _, c in own], np.int32).tobytes()))
            yield pd.DataFrame({"k": pdf["k"], **{c: [r[i] for r in out] for i, c in enumerate(("n", "terms", "tf"))}})

    return docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t")).mapInPandas(run, "k bigint, n bigint, terms binary, tf binary")


def _document_frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter[int] = Counter()
    for pdf in batches:
        if len(pdf):
            t, c = np.unique(np.frombuffer(b"".join(pdf["terms"]), np.int32), return_counts=True)
            total.update(dict(zip(t.tolist(), c.tolist(), strict=True)))
    yield pd.DataFrame({"term": pd.Series(list(total.keys()), dtype="int32"), "df": pd.Series(list(total.values()), dtype="int64")})


class Shard:
    """Impact-sorted lists of some documents."""

    def __init__(self, keys: pd.Series, n: np.ndarray, term_bytes: list[bytes], tf_bytes: list[bytes], n_docs: int, n_terms: int):
        known = keys.notna().to_numpy()
        self.keys = keys.fillna(0).to_numpy(np.int64)
        self.order = np.empty(len(keys), np.int64)                     # rank by key, without one last
        self.order[np.lexsort((self.keys, ~known))] = np.arange(len(keys))
        self.known = known
        term = np.frombuffer(b"".join(term_bytes), np.int32)
        tf = np.frombuffer(b"".join(tf_bytes), np.int32).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), [len(x) // 4 for x in term_bytes])
        m = 100 - 75 + (75 * n * n_docs) // max(1, n_terms)
        gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        by = np.lexsort((-gain, term))
        self._doc, self._gain = doc[by], gain[by]
        self._terms, start = np.unique(term[by], return_index=True)
        self._bounds = np.append(start, len(by))

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = int(np.searchsorted(self._terms, term))
        if at == len(self._terms) or self._terms[at] != term:
            return self._doc[:0], self._gain[:0]
        s = slice(self._bounds[at], self._bounds[at + 1])
        return self._doc[s], self._gain[s]

    def search(self, query: list[tuple[int, int]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (row numbers) and scores of the k best with ``least`` or more
        (and above 0). ``query``: terms with their weights."""
        lists = [(d, w * g) for t, w in query if w > 0 for d, g in [self.postings(t)] if len(d)]
        low = np.zeros(len(self.keys), np.int64)
        met = np.zeros((len(lists), len(self.keys)), bool)
        open_ = np.ones(len(self.keys), bool)                          # documents that may still be among the best
        at, step, closed = 0, STEP, False
        while lists:
            ends = [min(len(d), at + step) for d, _ in lists]
            for i, (d, gain) in enumerate(lists):
                new, more = d[at:ends[i]], gain[at:ends[i]]
                if closed:
                    own = open_[new]
                    new, more = new[own], more[own]
                low[new] += more
                met[i, new] = True
            at, step = at + step, 4 * step
            following = np.array([gain[e] if e < len(gain) else 0 for (_, gain), e in zip(lists, ends, strict=True)], np.int64)
            unmet = int(following.sum())
            seen = np.flatnonzero(met.any(0) & open_)
            if closed and not len(seen):
                break
            bound = low[seen] + unmet - following @ met[:, seen]
            kth = int(np.partition(low[seen], len(seen) - k)[len(seen) - k]) if len(seen) >= k else 0
            threshold = max(1, least, kth)
            can = bound >= threshold
            if not closed and unmet < threshold:                       # nothing that was not met can come in any more
                closed = True
            if closed:
                open_[:] = False
                open_[seen[can]] = True
                if (bound[can] == low[seen[can]]).all():
                    break
            if not unmet:
                break
        found = np.flatnonzero(open_ & (low >= max(1, least)))
        best = found[np.lexsort((self.order[found], -low[found]))[:k]]
        return best, low[best]


def _shards(queries, k: int, least, n_docs: int, n_terms: int):
    """Documents of a partition, shard by shard, against all queries of a slice."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def shard() -> pd.DataFrame:
            pdf = pd.concat(held, ignore_index=True)
            s = Shard(pdf["k"], pdf["n"].to_numpy(np.int64), pdf["terms"].tolist(), pdf["tf"].tolist(), n_docs, n_terms)
            no, doc, score = [], [], []
            for i, q in enumerate(queries.value):
                d, x = s.search(q, k, least.value[i])
                no.append(np.full(len(d), i))
                doc.append(d)
                score.append(x)
            d = np.concatenate(doc)
            key = pd.Series(s.keys[d], dtype="Int64").mask(~s.known[d])
            return pd.DataFrame({"no": np.concatenate(no), "doc": key, "score": np.concatenate(score)})

        for pdf in batches:
            pdf = pdf[pdf["n"] > 0]
            for a in range(0, len(pdf), 1024):
                part = pdf.iloc[a:a + 1024]
                held.append(part)
                size += int(part["terms"].str.len().sum()) // 4
                if sum(map(len, held)) >= SHARD_ROWS or size >= SHARD_TERMS:
                    yield shard()
                    held, size = [], 0
        if held and queries.value:
            yield shard()
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("no").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _searched(docs: DataFrame, items: list[tuple[object, list[bytes]]], key: str, text: str, k: int) -> DataFrame:
    """(no, doc, score, rank) of one slice of queries."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    number = {t: i for i, t in enumerate(dict.fromkeys(t for _, ts in items for t in ts))}
    rows = saved(counted(docs, key, text, share(number)), "term-counts")
    n_docs, n_terms = rows.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["term"]: r["df"] for r in rows.mapInPandas(_document_frequencies, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    queries = share([[(number[t], c * weight[number[t]]) for t, c in Counter(ts).items() if number[t] in weight] for _, ts in items])
    kind = "no int, doc bigint, score bigint"
    pilot = _ranked(rows.filter(F.pmod(F.xxhash64("k", "n", "terms"), F.lit(PILOT)) == 0)
                    .mapInPandas(_shards(queries, k, share([0] * len(items)), n_docs, n_terms), kind), k).filter(F.col("rank") == k)
    least = [0] * len(items)
    for r in pilot.select("no", "score").collect():                     # one row a query
        least[r["no"]] = r["score"]
    return _ranked(rows.mapInPandas(_shards(queries, k, share(least), n_docs, n_terms), kind), k)


def ranked_search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", query_key: str = "item_id",
                  query_text: str = "text", k: int = 10) -> DataFrame:
    """query_key, rank, key and score of the k best documents of each query."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = queries.schema[query_key].dataType
    rows = queries.select(F.col(query_key).alias("id"), F.coalesce(F.col(query_text), F.lit("")).alias("t")).distinct()
    size = F.length("t").cast("bigint")
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    n_slices = -(-total // (2 * SLICE_TERMS)) or 1                      # a term and what parts it are two characters or more
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("id", "t"), F.lit(n_slices)))
    out = None
    for s in range(n_slices):
        items = sorted(((r["id"], terms(r["t"])) for r in rows.filter(F.col("slice") == s).collect()), key=repr)
        found = _searched(docs.select(key, text), items, key, text, k)
        named = F.broadcast(spark.createDataFrame([(i, x) for i, (x, _) in enumerate(items)], f"no int, id {kind.simpleString()}"))
        found = found.join(named, "no").select(F.col("id").alias(query_key), "rank", F.col("doc").alias(key), "score")
        out = found if out is None else out.unionByName(found)
    return out
