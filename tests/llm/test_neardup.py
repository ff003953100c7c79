"""Near duplicates and components against brute force."""

import json
import random
import uuid
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from groundtrack.llm import neardup, queries
from groundtrack.llm.components import components


def groups(ids, links):
    parent = {i: i for i in ids}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, words):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i)
             if (both := len(sets[i] & sets[j])) and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)]
    return groups([r[0] for r in rows], links), {r[0]: len(s) for r, s in zip(rows, sets, strict=True)}


def check(spark, rows, words=4):
    out = neardup.near_duplicates(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rep int"), words=words).collect()
    comp, size = brute(rows, words)
    assert len(out) == len(rows)
    for r in out:
        assert r["component_id"] == comp[r["doc_id"]] and r["kept"] == (comp[r["doc_id"]] == r["doc_id"]) and r["n_shingles"] == size[r["doc_id"]]


def copies(n, length=60, edits=2, seed=0):
    """Variants of one text; each differs from it in a few words."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        t = list(base)
        for at in rng.sample(range(length), rng.randrange(edits + 1)):
            t[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    comp, _ = brute(rows, 4)
    assert {r["doc_id"]: r["component_id"] for r in queries.op10_near_duplicates(spark, d).collect()} == comp


def test_edges(spark):
    check(spark, [(9, None), (8, ""), (7, "A b C"), (6, "a B c"), (5, " \n"), (4, "a b c d"), (3, "a b c d e"), (2, "w " * 30_000), (1, "w " * 29_000)])
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(5, "one two three four five"), (5, "one two three four five"), (4, "six seven eight nine ten"), (5, "six seven eight nine ten"), (None, "six seven eight nine ten")]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in out if r["doc_id"]) == [(4, 4, True)] + 3 * [(5, 4, False)]
    assert [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(4, True)] or [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(None, True)]


@pytest.mark.parametrize("part_rows", [1000, 40])
def test_large_group_and_chain(spark, monkeypatch, part_rows):
    """A group larger than a leaf, whole and divided over parts, and a chain
    whose ends are unlike."""
    monkeypatch.setattr(neardup, "PART_ROWS", part_rows)
    texts = copies(230) + copies(40, length=200, edits=12, seed=5)
    words = [f"c{i}" for i in range(200)]
    texts += [" ".join(words[i * 5:i * 5 + 100]) for i in range(20)]
    check(spark, list(enumerate(texts)))


def bridged(n=120):
    """Two groups of copies whose bases share most shingles, but too few for a link."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    other = base[:240] + [f"y{rng.randrange(10**6)}" for _ in range(60)]
    out = []
    for i in range(2 * n):
        t = list((base, other)[i % 2])
        for at in rng.sample(range(300), 3):
            t[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def tasks_of(monkeypatch, scratch):
    """Counts what the confirming tasks do: a function that returns, per task, the
    rows of its largest part and its links."""
    real = neardup._confirm

    def counted(words):
        run = real(words)

        def wrapped(batches):
            rows, links = Counter(), 0

            def seen():
                for pdf in batches:
                    rows.update(pdf["part"].tolist())
                    yield pdf
            for out in run(seen()):
                links += len(out)
                yield out
            Path(scratch, uuid.uuid4().hex).write_text(json.dumps([max(rows.values(), default=0), links]))
        return wrapped

    monkeypatch.setattr(neardup, "_confirm", counted)
    return lambda: [json.loads(f.read_text()) for f in Path(scratch).iterdir()]


def test_both_sides_of_a_divided_task_are_bounded(spark, monkeypatch, scratch):
    """What the first centres do not link is dealt over tasks, too, and linked
    once to each group, not to every member of a second group."""
    tasks = tasks_of(monkeypatch, scratch)
    monkeypatch.setattr(neardup, "PART_ROWS", 20)
    monkeypatch.setattr(neardup, "CENTRES", 2, raising=False)
    texts = bridged()
    check(spark, list(enumerate(texts)))
    assert max(rows for rows, _ in tasks()) <= 3 * 2 * 20
    assert sum(links for _, links in tasks()) < 10 * len(texts)


def test_a_repeated_row_meets_its_block_once(spark, monkeypatch, scratch):
    """A row that occurs many times, and an id with several sets, add one member a class."""
    tasks = tasks_of(monkeypatch, scratch)
    a = copies(1)[0]
    b, c = a + " tail", a + " end"
    far = "quite another text of few words"
    rows = [(1, a)] * 300 + [(1, far)] * 50 + [(2, b), (3, c), (4, far + " and more words here"), (5, far.upper())]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    assert {(r["doc_id"], r["component_id"]) for r in out} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 1)} and len(out) == len(rows)
    assert max(n for n, _ in tasks()) <= 4


def test_pairs_meet_at_every_depth():
    """Few pairs at the least similarity part in all trees, however deep their
    large nodes go: by the formula, and by following sketches down."""
    assert all(neardup.missed(d) <= 1e-9 for d in range(1, neardup.DEPTH + 1))
    rng = np.random.default_rng(4)
    met, n, trees, deep = 0, 200, 2, 7
    for _ in range(n):
        s = rng.integers(0, 256, (2, neardup.COORDINATES), dtype=np.uint8)
        same = rng.random(neardup.COORDINATES) < neardup.SIMILARITY
        s[1, same], s[1, ~same] = s[0, same], s[0, ~same] + 1
        nodes = [np.unique(rng.integers(0, 2**63, trees).astype(np.uint64))] * 2
        for level in range(deep):
            down = [neardup._below(x, np.repeat(s[i:i + 1], len(x), 0), level)[1] for i, x in enumerate(nodes)]
            both = np.intersect1d(*down)
            nodes = [both, both]
        met += len(both) > 0
    assert met >= 0.95 * n                       # two of the trees; with 1.25 branches a level, about six in ten


@pytest.mark.parametrize("held", [20_000, 100])
def test_a_node_is_followed_down_by_its_task(monkeypatch, held):
    """Classes that share many tokens, too few for a link, give no rows for each
    level: only a forest of candidates, whatever a task holds and reads at once."""
    monkeypatch.setattr(neardup, "HELD", held, raising=False)
    rng = np.random.default_rng(1)
    base, s = rng.integers(0, 256, neardup.COORDINATES, dtype=np.uint8), rng.integers(0, 256, (600, neardup.COORDINATES), dtype=np.uint8)
    same = rng.random(s.shape) < 0.45
    s[same] = np.broadcast_to(base, s.shape)[same]
    s[500:] = s[400:500]                                                # equal sketches
    rows = pd.DataFrame({"node": 7, "class": range(600), "rep": range(600), "sketch": [x.tobytes() for x in s]})
    edges, level = [], 1
    while len(rows):
        out = pd.concat(neardup._visit(level)(rows[i:i + 250] for i in range(0, len(rows), 250)))
        edges.append(out[out["nodes"].isna()])
        below = out[out["nodes"].notna()].explode("nodes")
        assert held < 600 or not len(below)
        rows = pd.DataFrame({"node": below["nodes"].astype("int64"), "class": below["class"].astype("int64"), "rep": below["rep"].astype("int64")})
        rows = rows.assign(sketch=[s[c].tobytes() for c in rows["class"]]).sort_values(["node", "rep"])
        level += 1
    edges = pd.concat(edges)
    found = groups(range(600), zip(edges["rep"].astype(int), edges["other"].astype(int), strict=True))
    near = [(int(a), int(b)) for a, b in zip(*np.nonzero((s[:, None] == s[None]).sum(2) >= neardup.AGREE), strict=True)]
    want = groups(range(600), near)
    assert all(found[i] == found[i - 100] for i in range(500, 600)) and (held < 600 or len(edges) < 600)
    assert all(want[i] == want[found[i]] for i in range(600)) or level > neardup.DEPTH


def test_components_of_several_parts(spark, monkeypatch):
    """Edges beyond one task's bound go on by stars."""
    from groundtrack.llm import components as module
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(100)]
    want = groups({x for e in edges if e[0] != e[1] for x in e}, edges)
    df = spark.createDataFrame(edges, "u long, v long").repartition(7)
    for bound in (module.EDGES, 60):
        monkeypatch.setattr(module, "EDGES", bound)
        assert dict(components(df).collect()) == want


def test_components_of_a_path_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100), (200, 150), (150, 170), (None, 3)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    want = groups([*range(1, 61), 150, 170, 200], [e for e in edges[:-1] if e != (100, 100)])
    assert got == want


def test_shingles_across_chunks(monkeypatch):
    from groundtrack.llm import bytewords
    text = b"some words \xc3\xa9 " * 50 + b"x" * 300 + b"\n tail"
    whole = bytewords.word_hashes(text)
    monkeypatch.setattr(bytewords, "CHUNK", 64)
    assert (bytewords.word_hashes(text) == whole).all() and len(whole) == len(text.split())


def test_membership_filter_has_no_false_negative(spark):
    from pyspark.sql import functions as F

    from groundtrack.llm.membership import may_be_in
    ids = spark.range(-500, 4000, 3).withColumnRenamed("id", "v")
    for bits in (1 << 26, 64):
        asked = spark.range(-500, 4000).select("id", may_be_in(ids, bits)(F.col("id")).alias("m"))
        assert asked.filter("(id + 500) % 3 = 0 and not m").count() == 0
    assert asked.filter("m").count() == 4500                       # a full filter lets everything through
    assert spark.range(2000).filter(may_be_in(ids)(F.col("id") + 10**6)).count() < 5
    assert spark.range(5).filter(may_be_in(ids.limit(0))(F.col("id"))).count() == 0
    assert spark.range(1).filter(may_be_in(ids)(F.lit(None).cast("long"))).count() == 1
