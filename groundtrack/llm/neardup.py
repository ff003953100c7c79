"""Near duplicates by a chosen-path set similarity join.

A document's set is its distinct shingles (hashes of ``words`` consecutive
words). Equal sets fold into one class, whose smallest id stands for it. Each
class has a sketch of ``COORDINATES`` minwise tokens. In each of ``TREES``
independent trees all classes start at the root; a node picks some coordinates
(``BRANCHES`` on average, by its depth) by a hash of its path, and every class
follows its own minwise tokens at those coordinates into child nodes. Two sets
whose Jaccard index is at least SIMILARITY part at a root with a chance of 0.16.
A pair's paths multiply faster than they part below it, so that wherever its
nodes end, down to ``DEPTH``, it is in one of them in some tree but for a chance
of 1e-9 (``missed``). A node of at most ``LEAF``
classes is compared exhaustively by sketch. A larger one branches on, unless a
sample of it shows one tight group, or the path is ``DEPTH`` long: it is then
one candidate group as a whole. A node of at most ``HELD`` classes is followed
down to all its leaves by the task that reads it; larger ones are dealt anew
level by level.

Candidates group into connected blocks, and links are confirmed there on full
sets. Within a block a central set is compared with all; what it does not link
is compared with all, so that no link between different parts is lost while
most pairs of a large group need no comparison. Blocks of many sets are divided
and go in rounds: some sets outside the block's largest group so far meet all
sets of the block, the groups are formed anew, and ``MORE`` times as many are
asked next, until every set is in the largest group or has met all others. A task
takes one part of the members and one slice of the asked sets, both bounded,
and links an asked set once to each group it is not yet connected with.
Classes are then joined to their components.

Defined results: null and wordless texts have an empty set and are linked with
nothing; texts with fewer words have one shingle, the whole sequence; rows of
one id are one vertex; a null id gets a null component and is kept.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtrack.llm.bytewords import mix64, word_hashes
from groundtrack.llm.common import bounded_batches, saved
from groundtrack.llm.components import EDGES, components, star_forest
from groundtrack.llm.membership import may_be_in

WORDS, SIMILARITY = 5, 0.8
COORDINATES, TREES, LEAF, DEPTH = 96, 14, 64, 10
#: Classes of a node that one task follows down the rest of its tree: 2 MB of sketches.
HELD = 20_000
#: Coordinates a node branches on, on average: at the root, one level below (the
#: first with large nodes only), and at all deeper levels. At least 1 / SIMILARITY
#: each; where it is just that, a pair's chance falls with each level.
BRANCHES = (1 / SIMILARITY, 4, 2)
#: Coordinates that must agree for a candidate: a pair at the least similarity
#: has fewer with a chance of 8e-10.
AGREE = 51
#: Sets, and shingles, of a part (and of a slice of asked sets) that one task confirms.
PART_ROWS, PART_SHINGLES = 1000, 4_000_000
#: Sets of a divided block that meet all others in the first round; ``MORE`` times as many in each further one.
CENTRES, MORE = 64, 8
#: Steps between a node's coordinates: prime to their number, so none comes twice.
_STEPS = np.array([i for i in range(1, COORDINATES) if math.gcd(i, COORDINATES) == 1], np.uint64)
_A = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_B = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(words, len(h))
    g = h[: len(h) - k + 1]
    for j in range(1, k):
        g = mix64(g * np.uint64(0x9FB21C651E98DF25) + h[j: len(h) - k + 1 + j])
    return np.unique(mix64(g + np.uint64(k)))


def sketch(s: np.ndarray) -> np.ndarray:
    """The minwise token of each coordinate, 32 bits each."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 2048):
        np.minimum(least, (s[a:a + 2048, None] * _A + _B).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketched(df: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Per row: k, n_shingles, a digest of the set, the sketch, and the text's MD5."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t in pdf["t"]:
                s = shingles(t.encode("utf-8", "replace"), words) if t else np.zeros(0, np.uint64)
                out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None,
                            sketch(s).tobytes() if len(s) else None))
            yield pd.DataFrame({"k": pdf["k"], "known": pdf["known"], "md5": pdf["md5"], **{c: [r[i] for r in out] for i, c in enumerate(("n_shingles", "digest", "sketch"))}})

    k = F.col(key).cast("bigint")                     # pandas would round large ids beside a null one
    return (df.select(F.coalesce(k, F.lit(0)).alias("k"), k.isNotNull().alias("known"), F.col(text).alias("t"), F.md5(F.col(text).cast("binary")).alias("md5"))
            .mapInPandas(run, "k bigint, known boolean, md5 string, n_shingles bigint, digest binary, sketch binary")
            .withColumn("k", F.when(F.col("known"), F.col("k"))).drop("known"))


# -- the trees ---------------------------------------------------------------

def missed(depth: int, similarity: float = SIMILARITY) -> float:
    """The chance that a pair whose nodes all end at ``depth`` shares none of
    them in any tree, over the sketch that all trees share. A pair that fails
    the sketch test is not counted."""
    agree = np.arange(COORDINATES + 1) / COORDINATES
    part = np.zeros(COORDINATES + 1)
    for level in reversed(range(depth)):
        b = BRANCHES[min(level, len(BRANCHES) - 1)]
        one = 1 - agree + agree * part
        part = one ** int(b) * (1 - b % 1 + b % 1 * one)
    chance = np.array([math.comb(COORDINATES, n) * similarity ** n * (1 - similarity) ** (COORDINATES - n) for n in range(COORDINATES + 1)])
    return float((chance * part ** TREES)[AGREE:].sum())


def _choices(node: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The coordinates that nodes at ``level`` (0: roots) branch on: one entry per
    branch, with the index of its node. All of a node's coordinates differ."""
    b = BRANCHES[min(level, len(BRANCHES) - 1)]
    h = mix64(node ^ np.uint64(0xA0761D6478BD642F))
    first, step = h % np.uint64(COORDINATES), _STEPS[((h >> np.uint64(8)) % np.uint64(len(_STEPS))).astype(np.int64)]
    more = (h >> np.uint64(40)).astype(np.float64) / float(1 << 24) < b % 1
    at = np.concatenate([np.arange(len(node))] * int(b) + [np.flatnonzero(more)])
    turn = np.repeat(np.arange(int(b) + 1, dtype=np.uint64), [len(node)] * int(b) + [int(more.sum())])
    return at, ((first[at] + turn * step[at]) % np.uint64(COORDINATES)).astype(np.int64)


def _below(node: np.ndarray, tokens: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The child nodes of rows by their own tokens: index of the row, child."""
    at, c = _choices(node, level)
    return at, mix64(node[at] * np.uint64(0x9E3779B97F4A7C15) + (c.astype(np.uint64) << np.uint64(33)) + tokens[at, c].astype(np.uint64))


def _by_row(at: np.ndarray, node: np.ndarray, n: int) -> list[np.ndarray]:
    """The nodes of each of ``n`` rows."""
    return np.split(node[np.argsort(at, kind="stable")].view(np.int64), np.cumsum(np.bincount(at, minlength=n))[:-1])


def _planted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per class its nodes below the roots of all trees, and its sketch with one
    byte a coordinate."""
    for pdf in batches:
        for a in range(0, len(pdf), 2000):
            part = pdf.iloc[a:a + 2000]
            tokens = np.stack([np.frombuffer(bytes(x), np.uint32) for x in part["sketch"]])
            short = (mix64(tokens) & np.uint64(0xFF)).astype(np.uint8)
            roots = mix64(np.arange(1, TREES + 1, dtype=np.uint64))
            at, node = (np.concatenate(c) for c in zip(*(_below(np.full(len(part), r), tokens, 0) for r in roots), strict=True))
            nodes = _by_row(at, node, len(part))
            yield pd.DataFrame({"class": part["class"].to_numpy(), "rep": part["rep"].to_numpy(), "sketch": [x.tobytes() for x in short], "nodes": nodes})


def _linked(s: np.ndarray) -> np.ndarray:
    """Labels (least index) of the groups of sketches that agree enough."""
    near = (s[:, None, :] == s[None, :, :]).sum(2) >= AGREE
    label = np.arange(len(s))
    while True:
        new = np.where(near, label[None, :], len(s)).min(1)
        if (new == label).all():
            return label
        label = new


def _tight(s: np.ndarray, depth: int) -> bool:
    """Whether a large node, by its first rows, is one candidate group."""
    return depth == DEPTH or bool(((s[:LEAF, None, :] == s[None, :LEAF, :]).sum(2) >= AGREE).mean() > 0.5)


def _pairs(rep: np.ndarray, s: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate edges of nodes of two rows."""
    hit = (s[one] == s[two]).sum(1) >= AGREE
    return rep[two[hit]], rep[one[hit]]


def _descend(node: np.uint64, rep: np.ndarray, s: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate edges among the classes of one node at ``depth`` and of all nodes
    below it: depth first, so it holds the rows of one path of nodes."""
    if len(rep) <= LEAF:
        label = _linked(s)
        other = np.flatnonzero(label != np.arange(len(s)))
        yield rep[other], rep[label[other]]
        return
    if _tight(s, depth):
        yield rep, np.full(len(rep), rep[0])
        return
    at, child = _below(np.full(len(rep), node), s, depth)
    order = np.argsort(child, kind="stable")
    at, child = at[order], child[order]
    first = np.flatnonzero(np.concatenate([[True], child[1:] != child[:-1]]))
    n = np.diff(np.append(first, len(child)))
    two = first[n == 2]
    yield _pairs(rep, s, at[two], at[two + 1])
    for f, m in zip(first[n > 2], n[n > 2], strict=True):
        yield from _descend(child[f], rep[at[f:f + m]], s[at[f:f + m]], depth + 1)


def _visit(depth: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows (of nodes at ``depth``) sorted by node: a node of at most ``HELD`` rows
    is held and followed down to its leaves, which give candidate edges (of a task,
    as star forests); the classes of larger nodes stream and give their child nodes
    (``nodes`` not null)."""
    def edges(held: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        a, b = star_forest(*(np.concatenate(c) for c in zip(*held, strict=True)))
        return pd.DataFrame({"class": pd.array([None] * len(a), dtype="Int64"), "rep": a, "other": b, "nodes": None})

    def below(node: np.ndarray, own: np.ndarray, rep: np.ndarray, s: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"class": pd.array(own, dtype="Int64"), "rep": rep, "other": pd.array([None] * len(rep), dtype="Int64"),
                             "nodes": _by_row(*_below(node, s, depth), len(rep))})

    def visited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | tuple[np.ndarray, np.ndarray]]:
        held, open_node, centre, tight = None, None, None, False
        for pdf in _with_end(batches):
            if pdf is None:
                if held is None:
                    return
                rows = held
            elif not len(pdf):
                continue
            else:
                rows = pdf["node"].to_numpy().view(np.uint64), pdf["class"].to_numpy(), pdf["rep"].to_numpy(), _bytes(pdf)
                rows = rows if held is None else tuple(np.concatenate(c) for c in zip(held, rows, strict=True))
            node, _, rep, s = rows
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            n = np.diff(np.append(first, len(node)))
            held = None
            if pdf is not None and n[-1] <= HELD and node[-1] != open_node:       # may go on in the next batch
                held = tuple(c[first[-1]:] for c in rows)
                first, n = first[:-1], n[:-1]
            large = (n > HELD) | np.array([x == open_node for x in node[first]], bool)
            two = first[(n == 2) & ~large]
            yield _pairs(rep, s, two, two + 1)
            some = (n > 2) & ~large
            for f, m in zip(first[some], n[some], strict=True):
                yield from _descend(node[f], rep[f:f + m], s[f:f + m], depth)
            for f, m in zip(first[large], n[large], strict=True):
                part = tuple(c[f:f + m] for c in rows)
                if node[f] != open_node:                               # the rest of it may be in later batches
                    open_node, centre, tight = node[f], rep[f], _tight(part[3], depth)
                yield (part[2], np.full(m, centre)) if tight else below(*part)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for x in visited(batches):
            if isinstance(x, pd.DataFrame):
                yield x
                continue
            held.append(x)
            n += len(x[0])
            if n > EDGES:
                yield edges(held)
                held, n = [], 0
        if n:
            yield edges(held)

    return run


def _with_end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from batches
    yield None


def _bytes(pdf: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, pdf["sketch"])), np.uint8).reshape(len(pdf), COORDINATES)


def candidates(reps: DataFrame) -> DataFrame:
    """Candidate edges (u, v) between classes (``digest``, ``rep``, ``sketch``): a
    forest of each leaf's candidate pairs, over all trees."""
    classes = saved(reps.select(F.xxhash64("digest").alias("class"), "rep", "sketch")
                    .mapInPandas(_planted, "class bigint, rep bigint, sketch binary, nodes array<bigint>"), "planted")
    sketches, below, found = classes.select("class", "rep", "sketch"), classes.select("class", "nodes"), None
    even = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for depth in range(1, DEPTH + 1):
        # most nodes hold one class: only the classes of the others bring their sketch along
        placed = saved(below.repartition(even).select("class", F.explode("nodes").alias("node")), f"placed-{depth}")
        shared = placed.groupBy("node").count().filter("count > 1").select("node")
        rows = placed.join(shared, "node").join(sketches, "class").select("node", "class", "rep", "sketch")
        level = saved(rows.repartition("node").sortWithinPartitions("node", "rep")
                      .mapInPandas(_visit(depth), "class bigint, rep bigint, other bigint, nodes array<bigint>"), f"level-{depth}")
        edges = level.filter("nodes is null and rep != other").select(F.col("rep").alias("u"), F.col("other").alias("v"))
        found = edges if found is None else found.unionByName(edges)
        below = level.filter("nodes is not null").select("class", "nodes")
        if below.isEmpty():
            break
    return found


# -- confirming on full sets -------------------------------------------------

class _Sets:
    """Sets of a part, with exact intersection sizes of one against all."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(flat, kind="stable")
        self._keys, self._owner = flat[order], owner[order]

    def links(self, s: np.ndarray) -> np.ndarray:
        """Which sets have 100 * intersection >= 100 * SIMILARITY * union with ``s``."""
        lo, hi = np.searchsorted(self._keys, s, "left"), np.searchsorted(self._keys, s, "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(self._owner[at], minlength=len(self.size))
        return 100 * both >= round(100 * SIMILARITY) * (self.size + len(s) - both)

    def central(self) -> int:
        """The set that shares most with the others, for its size."""
        _, inverse, count = np.unique(self._keys, return_inverse=True, return_counts=True)
        return int(np.argmax(np.bincount(self._owner, count[inverse], minlength=len(self.size)) / np.maximum(1, self.size)))


def _confirm(words: int):
    """Rows of (part, rep, role, grp, divided, text) sorted by part: exact links
    (u, v) of each part. Roles: 0 a member, 1 a set of a divided block that meets
    the members. ``grp`` is what a set is connected with already; in a divided
    block's part the links form a forest over these groups."""
    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        texts, rep, role, divided = pdf["text"].to_numpy(), pdf["rep"].to_numpy(), pdf["role"].to_numpy(), bool(pdf["divided"].iloc[0])

        def shingled(i: int) -> np.ndarray:
            return shingles(texts[i].encode("utf-8", "replace"), words)

        members = np.flatnonzero(role == 0)
        sets = [shingled(i) for i in members]
        all_ = _Sets(sets)
        ids, out = rep[members], []
        if divided:
            group = pdf["grp"].to_numpy().copy()
            for i in np.flatnonzero(role == 1):
                hit = np.flatnonzero(all_.links(shingled(i)))
                new, at = np.unique(group[members[hit]], return_index=True)
                at = at[new != group[i]]
                out.append((np.full(len(at), rep[i]), ids[hit[at]]))
                group[np.isin(group, new)] = group[i]
        elif len(members) > 1:
            c = all_.central() if len(members) > 2 else 0
            hit = all_.links(sets[c])
            out.append((np.full(int(hit.sum()), ids[c]), ids[hit]))
            for i in np.flatnonzero(~hit):
                also = np.flatnonzero(all_.links(sets[i]))
                # one link into what the centre holds is enough; all others count
                held = also[hit[also]][:1]
                also = np.concatenate([held, also[~hit[also]]])
                out.append((np.full(len(also), ids[i]), ids[also]))
        a, b = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (ids[:0], ids[:0])
        keep = a != b
        return pd.DataFrame({"u": a[keep], "v": b[keep]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None
        for pdf in _with_end(batches):
            if pdf is None:
                if carry is not None:
                    yield part(carry)
                return
            pdf = pdf if carry is None else pd.concat([carry, pdf], ignore_index=True)
            if not len(pdf):
                continue
            key = pdf["part"].to_numpy()
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            for a, z in zip(first[:-1], first[1:], strict=True):
                yield part(pdf.iloc[a:z])
            carry = pdf.iloc[first[-1]:].copy()

    return run


def _bounded() -> Column:
    """Parts that keep rows of (n_shingles) within the bounds of a task."""
    return F.ceil(F.greatest(F.count("*") / PART_ROWS, F.sum("n_shingles") / PART_SHINGLES)).cast("int")


def confirmed(docs: DataFrame, reps: DataFrame, edges: DataFrame, words: int) -> DataFrame:
    """Exact links (u, v) between classes that connect whatever is linked inside
    the blocks that candidate ``edges`` form. ``docs`` has k and t; ``reps`` has
    rep and md5, which tell the text that stands for a class among the rows of
    its id. Each class has one row in a part, however often the row occurs."""
    block = components(edges).join(reps.select(F.col("rep").alias("v"), "md5", "n_shingles"), "v")
    size = block.groupBy("component").agg(_bounded().alias("parts"))
    member = saved(block.join(size, "component").withColumn("own", F.pmod(F.xxhash64("v", "md5"), F.col("parts")).cast("int"))
                   .select("v", "md5", "component", "parts", "own", "n_shingles"), "members")
    wanted = may_be_in(member.select("v"))
    texts = (docs.filter("t is not null").filter(wanted(F.col("k")))
             .select(F.col("k").alias("v"), F.md5(F.col("t").cast("binary")).alias("md5"), F.col("t").alias("text")))
    classes = member.select("v", "md5")
    texts = texts.join(classes, ["v", "md5"], "left_semi").groupBy("v", "md5").agg(F.first("text").alias("text"))

    def in_parts(rows: DataFrame) -> DataFrame:
        part = F.xxhash64("component", "at", "slice")
        return (rows.select(part.alias("part"), F.col("v").alias("rep"), "role", "grp", (F.col("parts") > 1).alias("divided"), "text")
                .repartition("part").sortWithinPartitions("part", "role", "rep")
                .mapInPandas(_confirm(words), "u bigint, v bigint"))

    def with_text(m: DataFrame) -> DataFrame:
        return m.join(texts, ["v", "md5"])

    columns = ["component", "at", "slice", "v", "role", "grp", "parts", "text"]
    links = in_parts(with_text(member.filter("parts = 1")).withColumns(
        {"at": F.col("own"), "slice": F.lit(0), "role": F.lit(0), "grp": F.col("v")}).select(columns))
    divided = member.filter("parts > 1")
    if divided.isEmpty():
        return links
    held = saved(with_text(divided), "divided")
    ids = divided.select("v").distinct()
    group = ids.withColumn("grp", F.col("v"))
    found, asked, n = None, None, CENTRES
    while True:
        now = divided.join(group, "v")
        largest = (now.groupBy("component", "grp").count().groupBy("component")
                   .agg(F.max(F.struct("count", "grp")).alias("m")).select("component", F.col("m.grp").alias("largest")))
        rest = now.join(largest, "component").filter("grp != largest")
        if asked is not None:
            rest = rest.join(asked, "v", "left_anti")           # these have met all
        rest = saved(rest.select("v", "component", "n_shingles"), f"rest-{n}")
        if rest.isEmpty():
            return links.unionByName(found) if found is not None else links
        ask = saved(rest.join(rest.groupBy("component").agg(F.count("*").alias("of")), "component")
                    .filter(F.pmod(F.xxhash64(F.lit(n), F.col("v")), F.col("of")) < n).drop("of"), f"asked-{n}")
        slices = ask.groupBy("component").agg(_bounded().alias("slices"))
        rows = (held.join(group, "v").join(ask.select("v", F.lit(True).alias("asks")).distinct(), "v", "left")
                .join(slices, "component"))
        each = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
        members = rows.withColumns({"at": F.col("own"), "slice": each, "role": F.lit(0)}).select(columns)
        each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        asking = rows.filter("asks").withColumns(
            {"at": each, "slice": F.pmod(F.xxhash64(F.lit("slice"), F.col("v"), F.col("md5")), F.col("slices")).cast("int"), "role": F.lit(1)}).select(columns)
        new = saved(in_parts(members.unionByName(asking)), f"links-{n}")
        found = new if found is None else found.unionByName(new)
        met = ask.select("v").distinct()
        asked = met if asked is None else asked.unionByName(met)
        group = saved(ids.join(components(found).withColumnRenamed("component", "grp"), "v", "left")
                      .select("v", F.coalesce("grp", "v").alias("grp")), f"groups-{n}")
        n *= MORE


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """Per row: key, n_shingles, component_id (the smallest id reachable), kept."""
    docs = df.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"))
    rows = saved(sketched(df, key, text, words), "sketches")
    some = rows.filter("k is not null and digest is not null")
    reps = saved(some.groupBy("digest").agg(F.min(F.struct("k", "md5")).alias("m"), F.first("n_shingles").alias("n_shingles"),
                                            F.first("sketch").alias("sketch"))
                 .select("digest", F.col("m.k").alias("rep"), F.col("m.md5").alias("md5"), "n_shingles", "sketch"), "classes")
    links = confirmed(docs, reps, candidates(reps), words)
    # ids with several rows tie their classes together
    twice = some.groupBy("k").agg(F.countDistinct("digest").alias("n")).filter("n > 1").select("k")
    ties = (some.join(twice, "k", "left_semi").join(reps.select("digest", "rep"), "digest")
            .select(F.col("k").alias("u"), F.col("rep").alias("v")))
    group = components(links.unionByName(ties))
    own = F.coalesce(F.col("component"), F.col("rep"), F.col("k"))
    return (rows.join(reps.select("digest", "rep"), "digest", "left")
            .join(group.withColumnRenamed("v", "__v"), F.coalesce("rep", "k") == F.col("__v"), "left")
            .select(F.col("k").alias(key), "n_shingles", own.alias("component_id"),
                    F.coalesce(F.col("k") == own, F.lit(True)).alias("kept")))
