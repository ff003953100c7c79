"""Spelling variants by K-d trees over letter counts.

Words are counted over whole texts. One edit changes letter counts by an L1
distance of two at most (one more or less letter: one). So for each length, and
for each pair of lengths that differ by one, near words are found by a range
search: the words of a length are dealt over the leaves of a K-d tree (its top,
split by a bounded sample, decides the Spark partition; within a partition a
tree over that leaf's own words goes on), every word visits the leaves whose
box lies within its range, and pairs within range are verified letter by
letter. A word with a much more frequent near word is a variant of it, its
form; following forms leads to its root.

Defined results: a null text or id counts as empty text or the id ``null``; a
document without letters gives no word; equal rows count each; an empty table
gives no row; a word of any length is compared.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtrack.llm.common import bounded_batches, saved

#: A letter of a run, in lower case but for capitals beyond ASCII.
RUN = re.compile("[a-zÀ-ÿ]+")
LETTERS = 26 + 64
#: Words of a leaf of the top tree (by its sample) and of a tree within.
CELL, LEAF = 4096, 24
#: Words that the top trees are split by, at most.
SAMPLE = 50_000
#: Different words that a task counts before it sends its counts on.
HELD = 200_000
#: Longer words are verified one by one.
WIDE = 256

Edit = Callable[[str, str], str]


def dropped_letters(rate: int) -> Edit:
    """The run without one letter, for one (id, run) in ``rate``, by a checksum."""
    def edit(key: str, run: str) -> str:
        h = zlib.crc32(f"{key}:{run}".encode())
        if h % rate:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return edit


def counted(df: DataFrame, key: str, text: str, least_length: int, edit: Edit | None = None) -> DataFrame:
    """(word, n) over all texts; ``edit`` may change a run, given the id."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        for pdf in batches:
            for k, t in zip(pdf["k"], pdf["t"], strict=True):
                for w, n in Counter(RUN.findall((t or "").encode().lower().decode())).items():
                    if len(w) >= least_length:
                        if edit is not None and len(w := edit(k, w)) < least_length:
                            continue
                        total[w] += n
                if len(total) > HELD:
                    yield pd.DataFrame({"word": list(total.keys()), "n": list(total.values())})
                    total = Counter()
        if total:
            yield pd.DataFrame({"word": list(total.keys()), "n": list(total.values())})

    rows = df.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("k"), F.col(text).alias("t"))
    return rows.mapInPandas(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def letter_counts(words) -> np.ndarray:
    """One row of counts a word: a-z, then U+00C0 to U+00FF."""
    out = np.zeros((len(words), LETTERS), np.int32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.where(code < 0xC0, code - 97, code - 0xC0 + 26)
    np.add.at(out, (np.repeat(np.arange(len(words)), lengths), letter), 1)
    return out


class Tree:
    """A K-d tree: nodes with a box (inclusive), leaves with a number."""

    def __init__(self, points: np.ndarray, leaf: float, tight: bool):
        """Splits at medians of the axis with the widest spread until a leaf has
        at most ``leaf`` points. Boxes are those of the points if ``tight``, else
        what the splits leave of the whole space, so that any point has a leaf."""
        self.nodes: list[tuple[np.ndarray, np.ndarray, int, int, int, int]] = []      # lo, hi, axis, split, left or -1 - leaf, right
        self.members: list[np.ndarray] = []
        self._points, self._leaf, self._tight = points, leaf, tight
        d = points.shape[1]
        self._grow(np.arange(len(points)), np.zeros(d, np.int32), np.full(d, np.iinfo(np.int32).max, np.int32))

    def _grow(self, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> int:
        p = self._points[at]
        if self._tight and len(at):
            lo, hi = p.min(0), p.max(0)
        me = len(self.nodes)
        self.nodes.append((lo, hi, -1, 0, -1 - len(self.members), 0))
        if len(at) > self._leaf:
            for axis in np.argsort(-p.std(0), kind="stable")[:3]:
                split = int(np.median(p[:, axis]))
                right = p[:, axis] > split
                if not right.any():
                    split -= 1
                    right = p[:, axis] > split
                if right.any() and not right.all():
                    hi_left, lo_right = hi.copy(), lo.copy()
                    hi_left[axis], lo_right[axis] = split, split + 1
                    left = self._grow(at[~right], lo, hi_left)
                    self.nodes[me] = (lo, hi, int(axis), split, left, self._grow(at[right], lo_right, hi))
                    return me
        self.members.append(at)
        return me

    def reach(self, x: np.ndarray, radius: int, at: np.ndarray | None = None, node: int = 0) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of x) for all leaves whose box is within ``radius``."""
        at = np.arange(len(x)) if at is None else at
        lo, hi, _, _, left, right = self.nodes[node]
        q = x[at]
        at = at[(np.maximum(lo - q, 0) + np.maximum(q - hi, 0)).sum(1) <= radius]
        if not len(at):
            return
        if left < 0:
            yield -1 - left, at
        else:
            yield from self.reach(x, radius, at, left)
            yield from self.reach(x, radius, at, right)


def one_edit(a: str, b: str) -> bool:
    """Whether two words, the first not longer, differ by one code point
    replaced (equal lengths) or inserted."""
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and a[i + (len(a) == len(b)):] == b[i + 1:]


def _verified(a: np.ndarray, b: np.ndarray, words_a: list[str], words_b: list[str]) -> np.ndarray:
    """Which pairs (rows a of words_a, rows b of words_b, of one length each, the
    first not longer) are one edit apart."""
    if not len(a):
        return np.zeros(0, bool)
    la, lb = len(words_a[0]), len(words_b[0])
    if lb > WIDE:
        return np.array([one_edit(words_a[i], words_b[j]) for i, j in zip(a, b, strict=True)])
    x = np.array(words_a, f"U{la}").view(np.uint32).reshape(-1, la)
    y = np.array(words_b, f"U{lb}").view(np.uint32).reshape(-1, lb)
    out = np.zeros(len(a), bool)
    for s in range(0, len(a), 65536):
        p, q = x[a[s:s + 65536]], y[b[s:s + 65536]]
        if la == lb:
            out[s:s + 65536] = (p != q).sum(1) == 1
        else:                                 # letters that agree from the left and from the right make up the shorter word
            left = np.cumprod(p == q[:, :la], 1).sum(1)
            right = np.cumprod((p == q[:, 1:])[:, ::-1], 1).sum(1)
            out[s:s + 65536] = left + right >= la
    return out


def _near_in(members: list[str], n: np.ndarray, tree: Tree, counts: np.ndarray, words: list[str], own_n: np.ndarray,
             radius: int) -> Iterator[pd.DataFrame]:
    """Pairs of ``words`` (all of one length) with the near members of a leaf."""
    x = letter_counts(words)
    pairs_q, pairs_m = [], []
    for leaf, at in tree.reach(x, radius):
        inside = tree.members[leaf]
        for s in range(0, len(at), 2048):
            q = at[s:s + 2048]
            i, j = np.nonzero(np.abs(x[q][:, None, :] - counts[inside][None, :, :]).sum(2) <= radius)
            pairs_q.append(q[i])
            pairs_m.append(inside[j])
    if not pairs_q:
        return
    i, j = np.concatenate(pairs_q), np.concatenate(pairs_m)
    near = _verified(j, i, members, words)
    i, j = i[near], j[near]
    if not len(i):
        return
    w, m = np.array(words, object), np.array(members, object)
    yield pd.DataFrame({"word": w[i], "near": m[j], "near_n": n[j]})
    if radius == 1:                           # a longer word has found a shorter one: told both ways
        yield pd.DataFrame({"word": m[j], "near": w[i], "near_n": own_n[i]})


def _searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (cell, role, word, n) sorted by cell and role: the words of a leaf
    (role 0) are held, those that visit it (role: range) stream by."""
    cell, held, tree = None, [], None
    for pdf in batches:
        edges = np.flatnonzero(np.concatenate([[True], (pdf["cell"].to_numpy()[1:] != pdf["cell"].to_numpy()[:-1])
                                               | (pdf["role"].to_numpy()[1:] != pdf["role"].to_numpy()[:-1])])) if len(pdf) else []
        for a, z in zip(edges, [*edges[1:], len(pdf)], strict=True):
            part = pdf.iloc[a:z]
            if part["cell"].iloc[0] != cell:
                cell, held, tree = part["cell"].iloc[0], [], None
            radius = int(part["role"].iloc[0])
            if not radius:
                held.append(part)
                continue
            if not held:
                continue
            if tree is None:
                own = pd.concat(held, ignore_index=True)
                members, n = own["word"].tolist(), own["n"].to_numpy(np.int64)
                counts = letter_counts(members)
                tree = Tree(counts, LEAF, tight=True)
            yield from _near_in(members, n, tree, counts, part["word"].tolist(), part["n"].to_numpy(np.int64), radius)


def top_trees(words: DataFrame) -> dict[int, Tree | None]:
    """The top tree of each length, split by a bounded sample of its words; None
    stands for one leaf. One small row a length comes to the driver."""
    sizes = {r["length"]: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
    share = min(1.0, SAMPLE / max(1, sum(sizes.values())))
    large = [length for length, n in sizes.items() if n > CELL]
    trees: dict[int, Tree | None] = dict.fromkeys(sizes)
    if large:
        unit = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < F.lit(share * (1 << 20))
        some = words.filter(F.length("word").isin(large) & unit).select("word").limit(2 * SAMPLE).toPandas()
        for length, own in some.groupby(some["word"].str.len())["word"]:
            tree = Tree(letter_counts(own.tolist()), CELL * len(own) / sizes[length], tight=False)
            tree.members, tree._points = [m[:0] for m in tree.members], None
            trees[int(length)] = tree
    return trees


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of ``words`` (word, n; distinct)
    that are one edit apart."""
    trees = words.sparkSession.sparkContext.broadcast(top_trees(words))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for length, part in pdf.groupby(pdf["word"].str.len()):
                x = None
                # the word's own leaf, the leaves it visits among its like, and among words shorter by one
                for to, role, radius in ((length, 0, 0), (length, 2, 2), (length - 1, 1, 1)):
                    if to not in trees.value:
                        continue
                    tree = trees.value[to]
                    if tree is None:
                        yield pd.DataFrame({"length": to, "leaf": 0, "role": role, "word": part["word"], "n": part["n"]})
                        continue
                    x = letter_counts(part["word"].tolist()) if x is None else x
                    for leaf, at in tree.reach(x, radius):
                        yield pd.DataFrame({"length": to, "leaf": leaf, "role": role, "word": part["word"].to_numpy()[at], "n": part["n"].to_numpy()[at]})

    routed = words.select("word", "n").mapInPandas(route, "length int, leaf int, role int, word string, n bigint")
    cell = F.col("length").cast("bigint") * F.lit(1 << 32) + F.col("leaf")
    return (routed.select(cell.alias("cell"), "role", "word", "n").repartition("cell").sortWithinPartitions("cell", "role")
            .mapInPandas(_searched, "word string, near string, near_n bigint"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words that have a form: pointers are doubled until
    none moves, so a chain of any length takes few rounds."""
    at = saved(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        more = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(at.join(more, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return at


def spelling_groups(df: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 6, least_n: int = 5, ratio: int = 5,
                    edit: Edit | None = None) -> DataFrame:
    """Per word of ``least_length`` letters and ``least_n`` occurrences or more:
    word, form (its near word of largest n, ties by code points, if that is
    ``ratio`` times as frequent or more), root, n, n_near, form_n."""
    words = saved(counted(df, key, text, least_length, edit).filter(F.col("n") >= least_n), "words")
    pairs = saved(near_words(words), "near-words")
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("m"))
    out = words.join(best, "word", "left").withColumn("is_form", F.coalesce(-F.col("m.n") >= ratio * F.col("n"), F.lit(False)))
    out = saved(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                           F.when(F.col("is_form"), F.col("m.near")).alias("form"), F.when(F.col("is_form"), -F.col("m.n")).alias("form_n")), "variants")
    found = roots(out.filter("form is not null"))
    return out.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
