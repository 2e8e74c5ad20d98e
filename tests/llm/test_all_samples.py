"""Every sampled segmentation is decoded and returned."""

import numpy as np

import corpus_pipeline
from onomast.llm import pieces


def test_round_trip_looks_at_every_sample():
    v = pieces.vocabulary("", 1.0)
    got = pieces.encode_texts(["the cat sat"], np.array([1]), pieces.Config(samples=2))[0][0]
    assert len(got) == 2 and pieces.round_trip(got, "the cat sat", v)
    assert not pieces.round_trip([got[0], got[1][:-1]], "the cat sat", v)


def test_token_stage_returns_all_samples(spark):
    rows = [(1, "river stone amber"), (2, ""), (3, "one  two")]
    v = pieces.vocabulary("", 1.0)
    for r in corpus_pipeline.tokenise(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect():
        samples = [r["pieces"], *r["more_pieces"]]
        assert [len(p) for p in samples] == r["n_pieces"] and len(samples) == len(r["log_prob"])
        assert all(pieces.decode(p, v) == dict(rows)[r["doc_id"]] for p in samples)


def test_round_trip_spells_in_bulk():
    v = pieces.vocabulary("", 1.0)
    rng = np.random.default_rng(6)
    known = np.flatnonzero([len(b) > 0 for b in v.bytes])
    for n in (1, 2, 500):
        ids = rng.choice(known, n)
        assert pieces.spelt(ids, v).to_pybytes() == b"".join(v.bytes[i] for i in ids.tolist())
    for text in ("", "a", "é\ud800 \U0001f600", " two  spaces "):
        got = pieces.encode_texts([text], np.array([3]))[0][0]
        assert pieces.round_trip(got, text, v) and not pieces.round_trip(got, text + "x", v)
