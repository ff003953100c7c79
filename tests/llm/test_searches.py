"""Top-k products, spelling variants and ranked search against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from groundtrack.llm import lexical, products, queries, spelling

D = "/root/testdata/sf0.001"


# -- top-k products ----------------------------------------------------------

def products_brute(rows, asks, k=5, scale=256):
    fine = {(i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, qv in fine:
        if asks(q):
            scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in fine if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def products_of(spark, rows, every, extra=False):
    df = spark.createDataFrame([(i, v, 9, 9) for i, v in rows], "vec_id long, embedding array<float>, score int, block int")
    return sorted(map(tuple, products.top_products(df, F.col("vec_id") % every == 0).collect()))


def test_products_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(products, "BLOCK", 64)
    monkeypatch.setattr(products, "STRIP", 16)
    monkeypatch.setattr(products, "TILE", 8)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=12) * rng.choice([0.1, 1, 5]) * np.linspace(3, 0.1, 12)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 12) for i in range(150)]                           # a common vector: ties by id
    want = products_brute([(i, np.float32(v).tolist()) for i, v in rows], lambda q: q % 10 == 0)
    assert products_of(spark, rows, 10) == want


def test_products_edges(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-1.0, 0.5]), (10, None), (20, [1.0, None]), (30, [float("nan"), 1.0]), (40, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (50, []), (51, [3.0]), (52, [1.0, 1.0, 1.0]), (53, [-2.0, -2.0]), (60, [0.0, 0.0])]
    want = products_brute(rows, lambda q: q % 10 == 0)
    assert products_of(spark, rows, 10) == want
    assert {r[0] for r in want} == {0, 50, 60} and all(r[2] != r[0] for r in want)
    assert products_of(spark, rows[:1], 10) == []
    assert products_of(spark, [(1, [1.0])], 10) == []
    assert products_of(spark, [], 10) == []


def test_huge_components_are_summed_in_integers(spark):
    rows = [(0, [1e6 + 1, 3.0]), (1, [1e6, 1e6]), (2, [1e6, 1e6 + 1 / 256])]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    assert products_of(spark, rows, 10) == products_brute(rows, lambda q: q % 10 == 0)


def test_lengths_prune_blocks(spark, monkeypatch):
    """Few long vectors settle all queries: later blocks are not met."""
    monkeypatch.setattr(products, "BLOCK", 32)
    met = []
    real = products.best_of
    monkeypatch.setattr(products, "best_of", lambda *a: met.append(1) or real(*a))
    q = np.ones((4, 3), np.int64)
    best, ids = products.best_of(np.arange(4), q, np.full(4, products._NONE), np.arange(10, 30), np.ones((20, 3), np.int64), np.eye(3), 5)
    assert best.tolist() == [[3] * 5] * 4 and ids.tolist() == [[10, 11, 12, 13, 14]] * 4
    tops = np.array([100.0, 10.0, 1.0, 0.5])
    import pandas as pd
    pdf = pd.DataFrame({"id": [0, 1], "mark": [0, 0], "v": [[1, 0], [0, 1]], "norm": [1.0, 1.0], "least": [5, 50]})
    out = list(products._tiles(2, tops, 1, 4)([pdf]))
    assert [r["last"].iloc[0] for r in out] == [1]


# -- spelling ----------------------------------------------------------------

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling_brute(docs, rate=None):
    n = Counter()
    for key, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'null' if key is None else key}:{w}".encode())
            if rate and h % rate == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    words = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    nears = defaultdict(list)
    for a in words:
        for b in words:
            if a != b and near(a, b):
                nears[a].append((-words[b], b))
    form = {w: min(x)[1] for w, x in nears.items() if -min(x)[0] >= 5 * words[w]}
    out = []
    for w, c in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, c, len(nears[w]), words[form[w]] if w in form else None))
    return sorted(out)


def spelled(spark, docs, rate=None):
    df = spark.createDataFrame([(k, t, "x", 3) for k, t in docs], "doc_id long, text string, word string, n int").repartition(3)
    out = spelling.spelling_groups(df, edit=spelling.dropped_letters(rate) if rate else None)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, out.collect()))


def test_spelling_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 12)
    monkeypatch.setattr(spelling, "LEAF", 3)
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcé"), size=rng.integers(6, 9))) for _ in range(250)]
    docs = [(i, " ".join(rng.choice(words, size=300, p=(p := 1 / np.arange(1, 251)) / p.sum()))) for i in range(40)]
    docs += [(100, "zzzzzza " * 5), (101, "zzzzzzb " * 30), (102, "zzzzzzbb " * 200)]
    want = spelling_brute(docs, 13)
    assert spelled(spark, docs, 13) == want
    assert any(r[1] for r in want) and any(r[2] != r[1] for r in want if r[1])        # chains, too


def test_spelling_edges(spark):
    long = "q" * 1000
    docs = [(1, None), (2, ""), (None, "Ligature ligature LIGATURE ligature ligature"), (3, "123 ... \n"), (4, f"{long} " * 30), (5, f"{long[1:]} " * 5),
            (6, "ligatura " * 30), (6, "ligatura " * 30), (7, "ÀÉÎõüÿ " * 5 + "ÀÉÎõüþ " * 25), (8, "short " * 50), (9, "abcdef×÷" * 3)]
    assert spelled(spark, docs) == spelling_brute(docs)
    assert spelled(spark, docs[:2]) == [] and spelled(spark, []) == []


@pytest.mark.parametrize("a,b", [("abcdef", "abcdeg"), ("abcdef", "abcdfe"), ("abcdef", "abcdef"), ("abcdef", "abcdeff"), ("abcdef", "xabcdef"), ("aaaaaa", "aaaaaaa"), ("abcdef", "abcxdey")])
def test_one_edit(a, b):
    assert spelling.one_edit(a, b) == near(a, b)
    got = spelling._verified(np.array([0]), np.array([0]), [a], [b])
    assert bool(got[0]) == near(a, b)


def test_tree_reaches_all_in_range():
    rng = np.random.default_rng(2)
    p = rng.integers(0, 4, size=(300, 8)).astype(np.int32)
    for tight in (True, False):
        tree = spelling.Tree(p, 5, tight)
        found = {(int(i), int(j)) for leaf, at in tree.reach(p, 2) for i in at for j in tree.members[leaf]}
        d = np.abs(p[:, None] - p[None]).sum(2)
        assert {tuple(x) for x in np.argwhere(d <= 2).tolist()} <= found and sorted(np.concatenate(tree.members).tolist()) == list(range(300))
    assert len(found) < 300 * 300 / 2


# -- ranked search -----------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def tokens(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def search_brute(docs, items, k=10):
    bags = [(d, Counter(tokens(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    N, L = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scored = []
        for d, b in bags:
            m = 100 - 75 + (75 * sum(b.values()) * N) // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in tokens(text) if t in b)
            if s > 0:
                scored.append((-s, d is None, d, -s))
        out += [(item, r + 1, x[2], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def searched(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, item_id int, score int").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    out = lexical.ranked_search(d, q, **kw)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("shard,step,slice_", [(16, 1, 10**6), (50, 4, 40), (10**6, 64, 10**6)])
def test_search_equals_brute_force(spark, monkeypatch, shard, step, slice_):
    monkeypatch.setattr(lexical, "SHARD_ROWS", shard)
    monkeypatch.setattr(lexical, "STEP", step)
    monkeypatch.setattr(lexical, "SLICE_TERMS", slice_)
    monkeypatch.setattr(lexical, "PILOT", 4)
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(120)]
    p = (p := 1 / np.arange(1, 121)) / p.sum()
    docs = [(i, " ".join(rng.choice(vocab, size=rng.integers(1, 120), p=p))) for i in range(300)]
    docs += [(1000 + i, "w100 w101 w3") for i in range(40)]                          # ties beyond the tenth
    items = [(i, " ".join(rng.choice(vocab, size=rng.integers(1, 12)))) for i in range(12)] + [(50, "w100 w100 w101 unknown")]
    assert searched(spark, docs, items) == search_brute(docs, items)


def test_search_edges(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "Ünï code ÉÉ x"), (4, "code x"), (None, "code x"), (6, "code " * 30_000), (7, "x" * 100_000), (8, "rare")]
    items = [(1, "CODE x"), (1, "CODE x"), (2, None), (3, "?!"), (None, "rare"), (5, "ünï ÉÉ"), (6, "absent"), (1, "rare")]
    assert searched(spark, docs, items) == search_brute(docs, items)
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == [] and searched(spark, docs[:3], items) == []


def test_search_reads_little_where_scores_are_clear():
    """Rare terms settle the ten best: the long list of the common one is read
    only for them."""
    import pandas as pd
    n = 5000
    terms_ = [np.array([0, 1], np.int32).tobytes() if i < 10 else np.array([1], np.int32).tobytes() for i in range(n)]
    tf = [np.ones(len(t) // 4, np.int32).tobytes() for t in terms_]
    s = lexical.Shard(pd.Series(np.arange(n), dtype="Int64"), np.full(n, 50), terms_, tf, n, 50 * n)
    best, score = s.search([(0, 5000), (1, 1)], 10, 0)
    assert sorted(best.tolist()) == list(range(10)) and len(set(score.tolist())) == 1
    assert s.search([(0, 5000), (1, 1)], 10, int(score[0]) + 1)[0].tolist() == []


def test_queries_cover_the_tables(spark):
    assert {r[0] for r in queries.op13_lexical(spark, D).select("item_id").distinct().collect()} <= set(range(40))
    n = spark.read.parquet(f"{D}/embeddings.parquet").filter("vec_id % 50 = 0").count()
    assert queries.op11_top_products(spark, D).count() == 5 * n
