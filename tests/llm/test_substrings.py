"""Substring removal against brute force: shared and null ids, ties, repeated rows, long texts, and time in proportion."""

import hashlib
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from onomast.llm import exact_substring


def brute(rows, length=100):
    """The contract by a dictionary of all strings; rows of one id and text are one, a null id comes last."""
    key = lambda r: ((1 << 63) - 1 if r[0] is None else r[0])
    seen, out = {}, []
    for r in rows:
        b = (r[1] or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            seen[w] = min(seen.get(w, (key(r), i)), (key(r), i))
    for r in rows:
        b = (r[1] or "").encode()
        hit = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] < (key(r), i):
                hit[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if hit[i] and (i == 0 or not hit[i - 1]))
        out.append((r[0], len(b), sum(hit), spans, hashlib.sha256(bytes(x for x, h in zip(b, hit) if not h)).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, parts=4):
    return sorted(map(tuple, exact_substring.query(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()), key=repr)


@pytest.mark.parametrize("hot", [2, 1024])
def test_by_brute_force(spark, monkeypatch, hot):
    rng = random.Random(1)
    base = ["".join(rng.choice("ab") for _ in range(400)) for _ in range(5)]
    rows = []
    for i in range(120):
        parts = [rng.choice([rng.choice(base)[rng.randrange(200) :][: rng.randrange(60, 250)], "".join(rng.choice("abcd é") for _ in range(rng.randrange(200))), "a" * rng.randrange(300)]) for _ in range(rng.randrange(5))]
        rows.append((i * 7 % 127, "".join(parts)))
    # ids that several texts share, rows without an id, equal rows, ties at one start
    rows += [(rng.choice([None, 3, 64]), base[i % 5][: 150 + i] + rng.choice(["", "tail " * 20])) for i in range(40)]
    rows += [(None, base[0]), (None, base[0]), (5, base[1]), (5, base[1]), (5, base[1] + "x"), (None, None), (400, None), (401, "xyz" * 100), (402, "q" * 9000), (403, "long words " * 30_000)]
    monkeypatch.setattr(exact_substring, "repeats", lambda d, f=exact_substring.repeats: f(d, hot=hot))
    assert run(spark, rows) == brute(rows)


def test_many_rows_without_an_id_take_time_in_proportion(spark):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    text = lambda i: f"{i} " + "".join(rng.choice("abcdefgh ") for _ in range(80)) + passage + f" {i}"
    took = []
    for rows in ([(i, text(i)) for i in range(20_000)], [(None, text(i)) for i in range(20_000)], [(7, passage + "same")] * 20_000):
        began = time.time()
        got = exact_substring.query(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).groupBy("n_removed").count().collect()
        took.append(time.time() - began)
        assert sum(r["count"] for r in got) == 20_000
    assert max(took[1:]) < 4 * took[0] + 5, took


def test_tries_of_all_groups_equal_one_trie_each():
    rng = np.random.default_rng(3)
    for _ in range(200):
        length, shallow, n = int(rng.integers(8, 20)), int(rng.choice([0, 4, 8, 32])), int(rng.integers(20, 400))
        data = bytes(rng.integers(97, 97 + int(rng.integers(1, 4)), n).astype(np.uint8))
        at = np.sort(rng.choice(n - length + 1, int(rng.integers(1, n - length + 2)), replace=False))
        group = np.sort(rng.integers(0, 3, len(at)))
        found, name = exact_substring.deep_shallow(data, at, group, length, shallow)
        want = []
        for g in set(group.tolist()):
            trie = exact_substring.BlindTrie(data, length)
            for x in at[group == g].tolist():
                trie.insert(x)
            want += [tuple(sorted(x)) for x in trie.leaves() if len(x) > 1]
        assert sorted(tuple(sorted(found[name == k].tolist())) for k in np.unique(name)) == sorted(want)


def test_sorting_holds_a_bounded_part_of_a_partition():
    rng = np.random.default_rng(4)
    many, n = 30_000, 61
    own = rng.integers(97, 123, (many // 2, n + 99)).astype(np.uint8)
    own = np.concatenate([own, own])
    own[:, -1] = rng.integers(97, 123, many)
    cols = [np.tile(np.arange(many // 2), 2), np.arange(many), np.arange(many), np.zeros(many, np.int32), np.full(many, n, np.int32)]
    part = pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array([x.tobytes() for x in own], pa.binary())], names=["m", "doc", "th", "lo", "n", "data"])
    tracemalloc.start()
    got = list(exact_substring._sort(iter([part]), 100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in got) == many // 2 and all(60 <= x <= 61 for b in got for x in b.column(4).to_pylist())
    assert peak < 25 * own.size, peak / own.size
