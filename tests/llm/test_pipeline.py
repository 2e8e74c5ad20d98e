"""The pipeline whole, against plain versions of its five stages, and its stages on nulls, empty tables and clashing columns."""

import json
import random

import numpy as np
import pytest
from test_decontam_brute import plain
from test_near_duplicates import plain_components, plain_sets
from test_personal import plain_field, plain_pii

import corpus_pipeline
from onomast.llm import decontam, pieces, pii, quality, textstats
from onomast.llm.common import SETTLED, drop_settled

WORDS = "river stone amber quiet maple lantern harbor violet copper meadow signal winter garden puzzle thunder velvet orchid canyon".split()
ITEM = "A train leaves Boston at 60 km per hour and meets a second train from Dayton after 3 hours of travel"


def text(rng, n):
    out = [rng.choice(WORDS) + rng.choice(["", "", "s", "ing"]) for _ in range(n)]
    return " ".join(w.capitalize() if i % 12 == 0 else w + "." * (i % 12 == 11) for i, w in enumerate(out))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    rows = []
    for i in range(60):
        rows.append((i, text(rng, rng.randrange(20, 120))))
    rows += [(100 + i, rows[i][1]) for i in range(0, 20, 2)] + [(200 + i, rows[i][1] + " tail") for i in range(1, 20, 2)]
    rows += [(300 + i, "### $$$ !! " + " ".join(rng.choice(["***", "BUY!!", "a|b", "%%%"]) for _ in range(40))) for i in range(25)]
    rows += [(400, text(rng, 20) + " " + ITEM), (401, ITEM.replace("60", "75").replace("Boston", "Lisbon")), (None, text(rng, 30)), (None, text(rng, 30) + " " + ITEM), (7, text(rng, 50))]
    rows += [(500, text(rng, 30) + " mail a@b.co or +1 (555) 010-9999. Dear Mr. Otto Kern, hello"), (501, None), (502, ""), (503, text(rng, 20_000)), (None, None)]
    where = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame([(i, t, "en", f"s{n % 3}", len(t or ""), n, "x") for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars int, row int, node string")
    docs.repartition(3).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(i, int(not 300 <= i < 400), 0) for i, _ in rows if i is not None and i != 7], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, "another item of nine words about the quiet harbor today"), (3, "two words")], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where, rows


def test_run_by_brute_force(spark, tables):
    where, rows = tables
    docs = spark.read.parquet(f"{where}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{where}/labels.parquet"))
    st = textstats.stats([t or "" for _, t in rows])
    score = model.score(np.array([st[f] for f in textstats.FEATURES]).T)
    good = [r for r, x in zip(rows, score) if x >= quality.Config.cut]
    root = plain_components(plain_sets(good))
    key = lambda k: (good[k][0] is None, good[k][0] or 0)
    alone = [good[min((k for k in range(len(good)) if root[k] == r), key=key)] for r in sorted(set(root))]
    bench = [(1, ITEM), (2, "another item of nine words about the quiet harbor today"), (3, "two words")]
    clean = [r for n, r in enumerate(alone) if not plain([r], bench, decontam.Config())[0][1]]
    seen, private = pii.Seen(pii.train()), []
    for i, t in clean:
        base = plain_pii(t or "")
        more = [x for x in plain_field(seen, t or "") if all(x[2] <= b[1] or b[2] <= x[1] for b in base)]
        private.append((i, pii.redact(t, [*base, *more]) if t else ""))
    v = pieces.vocabulary("", 1.0)
    before = len(SETTLED)
    out = corpus_pipeline.run(spark, where)
    got = [(r["doc_id"], pieces.decode(r["pieces"], v), [pieces.decode(p, v) for p in r["more_pieces"]]) for r in out.collect()]
    assert len(SETTLED) <= before + 1  # only what the result reads
    assert sorted((repr(i), t) for i, t, _ in got) == sorted((repr(i), t) for i, t in private)
    assert all(t == x for _, t, more in got for x in more)
    assert 20 < len(private) < len(alone) < len(good) < len(rows) and any("[EMAIL]" in t and "[NAME]" in t for _, t in private)


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_empty_tables_and_clashing_columns(spark, tables, stage):
    where, rows = tables
    name, fn = corpus_pipeline.STAGES[stage]
    docs = spark.read.parquet(f"{where}/documents.parquet").withColumn("clean", docs_column := json_column()).withColumn("__key", docs_column).withColumn("bands", docs_column)
    empty = fn(spark, docs.limit(0), where)
    assert empty.count() == 0
    if name != "tokens":
        got = fn(spark, docs, where)
        assert got.columns == docs.columns and 0 < got.count() <= len(rows)
        assert {r[0] for r in got.select("__key").collect()} == {json.dumps({})}
    else:
        assert fn(spark, docs, where).count() == len(rows)
    drop_settled(spark)


def json_column():
    from pyspark.sql import functions as F

    return F.lit(json.dumps({}))
