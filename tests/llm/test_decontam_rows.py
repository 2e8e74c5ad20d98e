"""Rows that share an id, or have none, are judged each by its own text."""

from collections import Counter

from onomast.llm import decontam

ITEM = "A train leaves Boston at 60 km per hour and meets a second train from Dayton after 3 hours of travel . How far apart were they ?"


def test_null_and_repeated_ids(spark):
    words = ITEM.split()
    first, second = " ".join(words[:14]), " ".join(words[14:])
    c = decontam.Config(share=0.8, run=len(words))
    assert not any(set(w) - set(words) for w in (first.split(), second.split()))
    rows = [(None, ITEM), (None, "a clean text without an id"), (None, ITEM), (1, ITEM), (1, "another clean text under the same id"), (2, first), (2, second), (None, first), (None, second), (3, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    alone = {t: decontam.query(spark.createDataFrame([(1, t)], "doc_id long, text string"), bench, c).first()["contaminated"] for t in (first, second)}
    assert alone == {first: False, second: False}
    left = decontam.decontaminate(docs, bench, c)
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(r for r in rows if r[1] != ITEM) and left.columns == docs.columns
    got = Counter((r["doc_id"], r["contaminated"]) for r in decontam.query(docs, bench, c).collect())
    assert got == Counter((i, t == ITEM) for i, t in rows)
