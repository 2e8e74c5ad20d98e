"""What an operator leaves in a worker goes when another operator's task comes, and comes back with the same results."""

import random

import numpy as np
import pytest

from onomast.llm import pieces, pii
from onomast.llm.common import per_slice

WORDS = "river stone amber quiet maple lantern harbor violet copper meadow Otto Kern".split()


@pytest.mark.parametrize("stage", ["tokens", "personal data"])
def test_other_tasks_find_nothing_left(spark, stage):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(rng.choices(WORDS, k=30))) for i in range(200)], "doc_id long, text string").repartition(8)
    run = pieces.encode if stage == "tokens" else pii.redacted
    first = sorted(map(repr, run(docs).collect()))

    def left(part):
        return {"n": np.full(part.num_rows, pieces.store.cache_info().currsize + len(pii._SEEN), np.int32)}

    assert {r.n for r in per_slice(docs, left, "n int").collect()} == {0}
    assert sorted(map(repr, run(docs).collect())) == first
