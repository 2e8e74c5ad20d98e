"""The forest over all rule statistics, on the labelled rows of sf0.1: recall on label 0 and loss on label 1 by kind."""

import numpy as np
import pyarrow.parquet as pq

from onomast.llm import isolation, textstats

SF = "/root/testdata/sf0.1"


def test_recall_and_loss_by_kind():
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if r["quality"] is not None}
    docs = [r for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist() if r["doc_id"] in labels]
    st = textstats.stats([r["text"] or "" for r in docs])
    y = np.array([labels[r["doc_id"]] for r in docs])
    failed = isolation.base_failed(st["n_words"], st["n_repeat_words"])
    x = isolation.rule_matrix(st)
    forest = isolation.fit(x, y, failed)
    out = forest.score(x) > forest.threshold
    stutter = np.isin([r["doc_id"] for r in docs], [1847, 2667, 4974, 7628, 7695])
    assert (y[stutter] == 0).all() and not failed[stutter].any() and out[stutter].all()
    symbols = (y == 0) & ~failed & ~stutter
    good = (y == 1) & ~failed
    print("symbols", out[symbols].sum(), symbols.sum(), "stutter", out[stutter].sum(), stutter.sum(), "good lost", out[good].sum(), good.sum())
    assert out[symbols].mean() >= 0.97 and out[good].mean() <= 0.006


def test_stutter_and_digits_are_isolated_without_being_seen():
    rng = np.random.default_rng(5)
    vocabulary = [f"{a}{b}" for a in "river stone amber quiet maple".split() for b in ("", "s", "ing", "ed", "er", "est", "ly", "ful")]
    good = [" ".join(rng.choice(vocabulary, rng.integers(20, 200))) for _ in range(600)]
    odd = ["thhant thhant thhant thhant ininti ininti ininti ininti qovak qovak qovak qovak melur melur melur melur", " ".join(str(10**9 + int(v)) for v in rng.integers(0, 10**8, 120))]
    st = textstats.stats([*good, *odd])
    failed = isolation.base_failed(st["n_words"], st["n_repeat_words"])
    x, y = isolation.rule_matrix(st), np.r_[np.ones(600, int), 0, 0]
    assert not failed[600:].any()
    forest = isolation.fit(x[:600], y[:600], failed[:600])
    assert (forest.score(x[600:]) > forest.threshold).all()


def test_bounds_and_cut_off_come_from_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(isolation, "FEW", 16)
    monkeypatch.setattr(isolation, "BINS", 8)
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(rng.choice(["river", "stone", "amber!", "Quiet", "m4ple", "a|b"], rng.integers(12, 80)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i, _ in rows], "doc_id long, quality int")
    c = isolation.Config(sample_rows=50, trees=20)
    forest = isolation.train(docs, labels, c)
    st = textstats.stats([t for _, t in rows])
    x, good = isolation.rule_matrix(st), (np.arange(300) % 10 > 0) & ~isolation.base_failed(st["n_words"], st["n_repeat_words"])
    assert good.sum() > 100
    np.testing.assert_allclose(forest.bound, isolation.bounds(x[good]), rtol=1e-9, atol=1e-12)
    assert abs(forest.threshold - isolation.calibrate(forest.score(x), good, c.keep_share)) < 1e-9
