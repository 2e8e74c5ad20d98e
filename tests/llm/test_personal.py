"""Personal data: the field against enumeration and a plain decoder, its accuracy, and every column of the query by brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest

from test_operators import plain_pii

from onomast.llm import pii


@pytest.fixture(scope="module")
def seen():
    return pii.Seen(pii.train())


def numbers(seen, words):
    return np.array([0, 0, *map(seen.__getitem__, words), 0, 0])


def test_viterbi_by_enumeration(seen):
    f = seen.f
    e = pii.scores(f, seen, numbers(seen, "Herr Otto Kern , 5".split()))[2:-2]
    score = lambda y: e[range(5), y].sum() + sum(f.trans[a, b] for a, b in itertools.pairwise(y)) + f.trans[0, y[0]]
    best = max(itertools.product(range(len(pii.LABELS)), repeat=5), key=lambda y: score(list(y)))
    assert score(pii.decode(f, e).tolist()) == pytest.approx(score(list(best)), abs=1e-2)


def test_field_is_accurate_on_held_out_sentences(seen):
    got = pii.accuracy(seen.f)
    assert all(p >= 0.9 and r >= 0.8 for p, r in got.values()), got
    texts = ["Please write to Mr. Walter Kimble, he knows.", "She lives at 22 Elm Street now.", "His SSN: 111-22-3333 ok", "The Big Dog ran. Then Anna went home.", "", "a 4929000000006111 b"]
    found = [[t[a:b] for _, a, b in x] for t, x in zip(texts, pii.learned_spans(texts, seen.f, seen))]
    assert found == [["Walter Kimble"], ["22 Elm Street"], ["111-22-3333"], [], [], ["4929000000006111"]]


def plain_field(seen, text):
    """Spans of the field by a decoder over the whole text, one step for each word."""
    f, at, places, words = seen.f, 0, [], []
    for i, line in enumerate(text.split("\n")):
        if i:
            places.append(None)
            words.append(pii.LINE)
            at += 1
        for w in line.split():
            k = text.index(w, at)
            places.append((k, k + len(w)))
            words.append(w)
            at = k + len(w)
        at = sum(len(x) + 1 for x in text.split("\n")[: i + 1]) - 1
    if not words:
        return []
    e = pii.scores(f, seen, numbers(seen, words))[2:-1]  # with the edge behind the text
    score, back = e[0] + f.trans[0], []
    for x in e[1:]:
        z = score[:, None] + f.trans
        back.append(z.argmax(0))
        score = z.max(0) + x
    labels = [int(score.argmax())]
    for b in reversed(back):
        labels.append(int(b[labels[-1]]))
    labels.reverse()
    labels.pop()
    out, j = [], 0
    while j < len(labels):
        name = pii.LABELS[labels[j]]
        if name == "O" or places[j] is None:
            j += 1
            continue
        k = j + 1
        while k < len(labels) and places[k] is not None and pii.LABELS[labels[k]] == f"I-{name[2:]}":
            k += 1
        lo, hi = places[j][0], places[k - 1][1]
        while lo < hi and text[lo] in "([{\"'":
            lo += 1
        while lo < hi and text[hi - 1] in ".,;:!?)]}\"'#$%*&|":
            hi -= 1
        if lo < hi:
            out.append((name[2:], lo, hi))
        j = k
    return out


def test_query_columns_by_brute_force(spark, seen):
    rng = random.Random(9)
    bits = ["Mr. Walter Kimble,", "my name is Rosa Vidal", "she lives at 5 Elm Road", "SSN: 111-22-3333", "a@b.co", "10.0.0.1", "4111 1111 1111 1111", "4929000000006111", "+1 (555) 010-9999", "The end.", "stone", "Name:", "\n", "\n\n", "river of glass", "(12)"]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "word " * 30_000 + "Dear Mr. Otto Kern, x"), (None, "Dear Mrs. Ina Kern, x"), (7, "a@b.co twice"), (7, "a@b.co twice")]
    got = sorted(map(tuple, pii.query(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()), key=repr)
    order = [*pii.KINDS, *pii.LEARNED]
    want = []
    for i, t in rows:
        base = plain_pii(t or "")
        more = [x for x in plain_field(seen, t or "") if all(x[2] <= b[1] or b[2] <= x[1] for b in base)]
        line = lambda xs: ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(xs, key=lambda x: (order.index(x[0]), x[1])))
        want.append((i, *(sum(x[0] == k for x in base) for k in pii.KINDS), hashlib.sha256(line(base).encode()).hexdigest(), line([*base, *more]), len(base) + len(more)))
    assert got == sorted(want, key=repr)
    assert any("name:" in x[6] for x in got) and any("idnum:" in x[6] for x in got) and any("street:" in x[6] for x in got)


def test_redaction_of_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "mail a@b.co now", 15, "x"), (2, None, None, "y"), (None, "clean", 5, "z"), (3, "", 0, "w")], "doc_id long, text string, n_chars int, clean string")
    got = sorted(map(tuple, pii.redacted(df).collect()), key=repr)
    assert got == sorted([(1, "mail [EMAIL] now", 16, "x"), (2, None, None, "y"), (None, "clean", 5, "z"), (3, "", 0, "w")], key=repr)
    assert pii.redacted(df).columns == df.columns and pii.redacted(df.limit(0)).count() == 0
