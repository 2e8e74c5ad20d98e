"""The pipeline's near-duplicate stage against brute-force Jaccard similarity."""

import itertools
import random
from collections import Counter

import numpy as np

import corpus_pipeline
from onomast.llm import jaccard, simhash
from onomast.llm.common import table

SF = "/root/testdata/sf0.01"


def plain_sets(rows):
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for _, t in rows]
    return [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]


def alike(a, b):
    both = len(a & b)
    return 5 * both >= 4 * (len(a) + len(b) - both)


def plain_components(sets):
    root = list(range(len(sets)))
    by = {}
    for i, s in enumerate(sets):
        by.setdefault(frozenset(s), []).append(i)
    least = [min(g) for g in by.values()]
    todo = [(g[0], x) for g in by.values() for x in g] + [(a, b) for a, b in itertools.combinations(least, 2) if sets[a] and sets[b] and alike(sets[a], sets[b])]
    while any(root[a] != root[b] for a, b in todo):
        for a, b in todo:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_stage_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    sets = plain_sets(rows)
    root = plain_components(sets)
    kept = corpus_pipeline.drop_copies(spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({rows[r][0] for r in root}) and kept.columns == docs.columns
    # the radius of the query leaves such pairs apart
    fps = [simhash.fingerprint(t or "") for _, t in rows]
    assert any(root[i] == root[j] and (fps[i] ^ fps[j]).bit_count() > 4 and alike(sets[i], sets[j]) for i in range(len(rows)) for j in range(i))


def test_chains_null_and_repeated_ids(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows, chain = [], list(base)
    for i in range(60):  # neighbours are alike, ends are not
        rows.append((i, " ".join(chain)))
        chain[rng.randrange(120)] = f"x{i}"
    loose = [f"y{i}" for i in range(100)]
    rows += [(100 + i, " ".join(loose[:60] + [f"z{i}_{j}" for j in range(40)])) for i in range(30)]  # a long common passage, none alike
    rows += [(7, "quite another text under the same id as one of the chain"), (None, "no id and no copy of it anywhere here"), (None, rows[5][1]), (200, None), (201, ""), (202, " \n"), (203, "one"), (204, "One")]
    sets = plain_sets(rows)
    root = plain_components(sets)
    want = Counter(min(((rows[j][0] is None, rows[j][0] or 0) for j in range(len(rows)) if root[j] == r)) for r in set(root))
    got = jaccard.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == want
    assert sum(r["doc_id"] == 7 for r in got) == 1 and sum(r["doc_id"] is None for r in got) == 1
    assert jaccard.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bucket_links_are_whole():
    rng = np.random.default_rng(1)
    for _ in range(40):
        sets = [np.unique(rng.choice(12, rng.integers(1, 12)).astype(np.uint64)) for _ in range(25)]
        root = np.arange(25)
        u, v = jaccard.bucket_links(sets, root)
        want = [(i, j) for i, j in itertools.combinations(range(25), 2) if alike(set(sets[i].tolist()), set(sets[j].tolist()))]
        a, b = (simhash._forest(25, [(np.array([x for x, _ in e], int), np.array([y for _, y in e], int))]) for e in (list(zip(u, v)), want))
        assert (a == b).all() and set(map(lambda e: tuple(sorted(e)), zip(u, v))) <= set(want)


def test_crowds_that_share_a_passage_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWD", 6)
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(70))
    pool = [" ".join(f"q{k}_{i}" for i in range(12)) for k in range(6)]  # stretches that many texts share too
    rows = []
    for i in range(90):
        own = " ".join(rng.sample(pool, 2)) + " " + " ".join(f"u{i}_{j}" for j in range(rng.randrange(3, 12)))
        rows.append((i, f"{passage} {own}"))
        if i % 5 == 0:
            rows.append((1000 + i, f"{passage} {own} tail{i}"))
    sets = plain_sets(rows)
    root = plain_components(sets)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    least = {r: min(rows[j][0] for j in range(len(rows)) if root[j] == r) for r in set(root)}
    assert got == {rows[i][0]: least[root[i]] for i in range(len(rows))}


def test_tight_ball_is_joined_by_a_star():
    rng = np.random.default_rng(2)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 3), replace=False)) for _ in range(3000)]
    points = np.unique(np.uint64(0x0123456789ABCDEF) ^ np.array(flips, np.uint64))
    out = simhash.vp_links(points, whole=False)
    root = simhash._forest(len(points), out)
    assert (root == 0).all() and sum(len(a) for a, _ in out) < 40 * len(points)
    some = np.unique(np.r_[points[:400], rng.integers(0, 1 << 63, 400, dtype=np.uint64)])
    a, b = (simhash._forest(len(some), simhash.vp_links(some, whole=w)) for w in (True, False))
    assert (a == b).all()


def test_stage_links_by_vantage_points_first(spark, monkeypatch):
    rng = random.Random(12)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
        rows += [(i, " ".join(words)), (100 + i, " ".join(words[:-1] + ["end"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    points = jaccard._rows(docs).groupBy("node").agg({"fp": "min"}).withColumnRenamed("min(fp)", "fp")
    fp = {r["node"]: r["fp"] & (1 << 64) - 1 for r in points.collect()}
    found = {frozenset((r["u"], r["v"])) for r in jaccard._vantage(points).collect()}
    near = {frozenset(x) for x in itertools.combinations(fp, 2) if (fp[x[0]] ^ fp[x[1]]).bit_count() <= 4}
    assert len(near) >= 10 and found <= near and set().union(*found) == set().union(*near)
    calls = []
    monkeypatch.setattr(simhash, "links", lambda *a, f=simhash.links, **k: calls.append(1) or f(*a, **k))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert calls and got == {i: i % 100 for i, _ in rows}
