"""The training-data operators against brute force, and on nulls, empty and repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from onomast.llm import decontam, exact_substring, isolation, langid, licenses, pieces, pii, quality, secrets, simhash, textstats

WORDS = "river stone amber quiet maple lantern harbor violet copper meadow signal winter garden puzzle thunder velvet orchid canyon".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [text(rng, rng.randrange(5, 80)) for _ in range(40)]
    out = [(i, t) for i, t in enumerate(base)]
    out += [(100 + i, base[i % 7]) for i in range(20)]
    out += [(200 + i, base[i] + " extra tail") for i in range(10)]
    return [*out, (300, None), (301, ""), (302, " \n\t"), (303, "one"), (304, "x" * 500), (305, "ab " * 300), (None, base[3])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.withColumn("score", F.lit("clash")).withColumn("kind", F.lit(1)).withColumn("row", F.lit(2)).withColumn("lang", F.lit("en"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")


def queries(docs, labels, bench):
    return {
        1: lambda d: quality.query(d, labels), 2: langid.query, 3: exact_substring.query, 4: lambda d: decontam.query(d, bench), 5: licenses.query,
        6: pii.query, 7: secrets.query, 8: lambda d: isolation.query(d, labels), 9: pieces.query, 10: simhash.query,
    }


@pytest.mark.parametrize("n", range(1, 11))
def test_each_row_gives_a_row_and_empty_tables_none(spark, docs, labels, rows, n):
    bench = spark.createDataFrame([(1, "which of the four rivers is longest in the northern plain today")], "item_id long, text string")
    run = queries(docs, labels, bench)[n]
    got = run(docs)
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert Counter(ids) == Counter(i for i, _ in rows)
    assert run(docs.limit(0)).count() == 0


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_quality_columns_equal_numpy_and_folds(spark, docs, labels):
    rng = np.random.default_rng(0)
    x = rng.random((400, len(textstats.FEATURES)))
    y = ((x[:, 1] > 0.5) & (x[:, 5] < 0.7)).astype(float)
    model = quality.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97
    df = spark.createDataFrame([[float(v) for v in r] for r in x], textstats.FEATURES)
    assert np.allclose([r[0] for r in df.select(model.column()).collect()], model.score(x))
    # texts that share an id count once, ids of the held-out fold never
    twice = docs.unionByName(docs.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" more"))))
    assert quality._features(quality.labelled(twice, labels, 100)).num_rows == quality.labelled(docs.dropDuplicates(["doc_id"]), labels, 100).count()
    for r in quality.query(docs, labels).where("doc_id is not null").collect():
        assert r["held_out"] == (fold(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    assert {r["doc_id"] for r in quality.labelled(docs, labels, 100).collect()} & {i for i in range(400) if fold(i, 5) == 0} == set()


def test_repeat_words_by_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        w = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(0, 30))]
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        hit = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
        assert textstats.repeat_words(w) == len(hit)


def test_isolation_counts_and_rare_rows():
    st = textstats.stats(["a b\na b\n\na  b", "##! x|y", "", "é ü"])
    assert st["n_words"].tolist() == [6, 2, 0, 2] and st["n_dup_lines"].tolist() == [1, 0, 0, 0]
    assert st["n_symbols"].tolist() == [0, 3, 0, 0] and st["word_chars"].tolist() == [6, 6, 0, 2]
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(0, 1, (500, 4)), rng.normal(9, 0.1, (5, 4))]
    forest = isolation.grow(x)
    s = forest.score(x)
    assert s[500:].min() > np.quantile(s[:500], 0.98)


def test_language_network_learns_and_covers_whole_texts():
    rng = random.Random(2)
    a, b = "the and with under other thing".split(), "der und mit unter ander ding".split()
    texts = [" ".join(rng.choice(v) for _ in range(40)) for v in (a, b) for _ in range(60)]
    net = langid.train(texts, ["en"] * 60 + ["de"] * 60)
    assert (langid.predict(net, texts).argmax(1) == np.array([1] * 60 + [0] * 60)).mean() > 0.98
    x, of = langid.windows([b"x" * 1000, b"", b"ab"], 256)
    assert np.bincount(of).tolist() == [4, 1, 1] and (x[of == 0] > 0).sum() >= 1000
    assert [r for r in langid.predict(net, [texts[0]]).sum(1)] == pytest.approx([1.0])


def test_blind_trie_orders_and_groups():
    rng = random.Random(3)
    data = "".join(rng.choice("ab") for _ in range(400)).encode()
    trie = exact_substring.BlindTrie(data, 6)
    for i in range(len(data) - 6):
        trie.insert(i)
    leaves = list(trie.leaves())
    keys = [data[x[0] : x[0] + 6] for x in leaves]
    assert keys == sorted(set(data[i : i + 6] for i in range(len(data) - 6)))
    assert all(len({data[i : i + 6] for i in x}) == 1 for x in leaves)


def test_decontamination_of_copies_and_new_parameters(spark):
    item = "A train leaves Boston at 60 km per hour and meets a second train from Dayton after 3 hours of travel . How far apart were they ?"
    other = item.replace("60", "85").replace("3", "7").replace("Boston", "Lisbon").replace("Dayton", "Madrid")
    mixed = "A train leaves Boston at 60 km"
    rng = random.Random(4)
    rows = [(1, text(rng, 30) + " " + item + " " + text(rng, 10)), (2, text(rng, 50) + " " + other), (3, text(rng, 90)), (4, mixed), (5, None), (6, item.upper())]
    bench = spark.createDataFrame([(7, item), (8, None), (9, "two words")], "item_id long, text string")
    for c in (decontam.Config(), decontam.Config(broadcast_windows=1)):
        got = {r["doc_id"]: r for r in decontam.query(spark.createDataFrame(rows, "doc_id long, text string"), bench, c).collect()}
        assert {i for i, r in got.items() if r["contaminated"]} == {1, 2, 6}
        assert got[1]["items"] == [7] and got[2]["changed"]
    assert decontam.one_to_one([([1, 2], [5, 6]), ([1], [6]), ([3], [7])]) == [True, False, True]
    left = decontam.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert {r["doc_id"] for r in left.collect()} == {3, 4, 5}


_PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_pii(t):
    ok = {
        "email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")),
        "card": lambda s: 13 <= len(d := re.sub("[ -]", "", s)) <= 19 and pii.luhn(d), "phone": lambda s: 9 <= len(re.sub(r"\D", "", s)) <= 15,
    }
    return [(k, *m.span()) for k, p in _PLAIN.items() for m in re.finditer(p, t) if ok[k](m[0])]


def test_pii_base_spans():
    rng = random.Random(2)
    bits = ["1", "2", "255", "256", ".", "-", " ", "+", "(", ")", "a", "b.c", "@", "@x.y", "4111111111111111", "+1 (555) ", "٣", "\n"]
    for _ in range(5000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(25)))
        assert pii.base_spans(t) == plain_pii(t)
    assert pii.redact("mail a@b.co now", [("email", 5, 11)]) == "mail [EMAIL] now"


def test_secrets_base_and_battery(spark):
    rng = random.Random(2)
    bits = ["token", "TOKEN", " = ", ":", '"', "apikey", "ſecret", "secret=", "0123456789abcdef", "deadbeef", "AKIA", "AKIAABCDEFGHIJKL", "Z", " ", "abcd1234", "password", "\n"]
    plain = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for _ in range(5000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        want = [("assign", *m.span()) for m in plain.finditer(t) if len(m[2]) >= 8]
        want += [(k, *m.span()) for k, p, n in (("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)) for m in re.finditer(p, t) if len(m[0]) >= n]
        assert secrets.base_spans(t) == sorted(want, key=lambda x: (x[1], secrets.KINDS.index(x[0])))
    rows = [(i, f"key {''.join(random.Random(i).choices(dict(secrets.ENCODINGS)['alnum'], k=40))} end") for i in range(20)]
    rows += [(50, "z1y2" * 9), (51, None), (52, "Plain_words_in_a_long_identifier")]
    got = {r["doc_id"]: r["spans"] for r in secrets.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum("random:" in got[i] for i in range(20)) >= 18 and got[50] == got[51] == got[52] == ""


def test_pieces_do_not_depend_on_what_the_store_keeps(monkeypatch):
    texts = ["", " ", "  a", "▁x ▁", "ééé", "中文 😀", "x" * 3000, "a b  c\n", *(f"word{i % 7} number {i} again and again" for i in range(120))]
    keys = np.arange(len(texts))

    def run():
        pieces.store.cache_clear()
        got = [x for i in range(0, len(texts), 16) for x in pieces.encode_texts(texts[i : i + 16], keys[i : i + 16])]
        return [([p.tolist() for p in a], b, c) for a, b, c in got]

    large = run()
    monkeypatch.setattr(pieces.Store, "NODES", 400)
    monkeypatch.setattr(pieces.Store, "KEPT", 150)
    assert run() == large
    pieces.store.cache_clear()


def test_pieces_round_trip_distinct_and_distribution():
    v, c = pieces.vocabulary("", 1.0), pieces.Config(samples=4)
    texts = ["", "a", " ", "Hello  wörld\n\tfoo  é　x ﬁ", "▁x ▁", "日本語 テスト 😀", "x" * 300, "river stone " * 50]
    for t, got in zip(texts, pieces.encode_texts(texts, np.arange(len(texts)), c)):
        assert all(pieces.decode(p.tolist(), v) == t for p in got[0]) and len({tuple(p.tolist()) for p in got[0]}) == len(got[0]) >= 1
        assert all(0 <= q <= 1 + 1e-12 for q in got[2])
    alone, together = pieces.encode_texts([texts[7]], np.array([7]), c)[0], pieces.encode_texts(texts, np.arange(8), c)[7]
    assert [p.tolist() for p in alone[0]] == [p.tolist() for p in together[0]]
    n = 3000
    got = pieces.encode_texts(["the cat"] * n, np.arange(n), pieces.Config(samples=3))
    prob = {tuple(p.tolist()): math.exp(x) for g in got for p, x in zip(g[0], g[1])}
    first = Counter(tuple(g[0][0].tolist()) for g in got)
    assert sum(prob.values()) == pytest.approx(1, abs=1e-3)
    top = max(prob, key=prob.get)
    assert first[top] / n == pytest.approx(prob[top], abs=0.04)
    second = Counter(tuple(g[0][1].tolist()) for g in got if tuple(g[0][0].tolist()) == top)
    for k, m in second.most_common(2):
        assert m / first[top] == pytest.approx(prob[k] / (1 - prob[top]), abs=0.05)


def test_every_segmentation_by_enumeration():
    v = pieces.vocabulary("", 1.0)
    weight = {v.bytes[int(i)]: float(w) for i, w in zip(v.ids, v.weights)}

    def all_of(b):
        return [()] if not b else [(b[:n], *rest) for n in range(1, len(b) + 1) if b[:n] in weight for rest in all_of(b[n:])]

    for text in ("cats", "a cat", "éa"):
        got = pieces.encode_texts([text], np.array([5]), pieces.Config(samples=100))[0]
        mine = {tuple(v.bytes[i] for i in p.tolist()): x for p, x in zip(got[0], got[1])}
        head = b"".join(next(iter(mine)))
        want = {s: sum(weight[x] for x in s) for s in all_of(head)}
        total = math.log(sum(math.exp(x) for x in want.values()))
        assert head.strip() == text.encode() and set(mine) == set(want)
        assert all(mine[s] == pytest.approx(x - total, abs=1e-4) for s, x in want.items())


def test_language_sample_is_drawn_over_whole_texts(spark):
    rows = [(i, "x" * 250 * 40, "en") for i in range(6)] + [(9, "y", "de")] * 50 + [(10, None, "fr"), (None, "z", "it"), (11, "q", None)]
    c = langid.Config(per_lang=4, windows_per_text=5)
    x, langs = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), c)
    n = sum(fold(i, 3) != 1 for i in range(6))
    assert Counter(langs) == {"en": 5 * min(n, 4), "de": 1} if fold(9, 3) != 1 else True
    w, of = langid.windows([b"a" * 250 * 40], 256)
    assert langid.drawn(w, of, np.array([7]), c).max() > 5  # not a prefix


def plain_network(net, data):
    """Mean probabilities of a text by the network as it was trained: embedding, filters, maximum, softmax."""
    lap = max(langid.WIDTHS) - 1
    step, out = net.window - lap, []
    for at in range(0, max(1, len(data) - lap), step):
        x = np.frombuffer(data[at : at + net.window].ljust(net.window, b"\0"), np.uint8)
        h = [np.max([sum(net.embed[x[i + j]] @ f[j] for j in range(w)) + b for i in range(len(x) - w + 1)], 0) for f, b, w in zip(net.filters, net.bias, langid.WIDTHS)]
        z = np.maximum(np.concatenate(h), 0) @ net.out + net.out_bias
        e = np.exp(z - z.max())
        out.append(e / e.sum())
    return np.mean(out, 0)


def test_language_query_by_the_unfolded_network(spark):
    rng = random.Random(12)
    words = {"en": "the and with under other thing".split(), "de": "der und mit unter ander ding".split()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randrange(1, 90))), k) for i in range(60) for k in [rng.choice(["en", "de"])]]
    rows += [(200, None, "en"), (201, "", None), (202, "12 34 !", "de"), (None, "the other thing", None), (203, "the ÜNDER " * 700, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    net = langid.train_windows(*langid.sample(df))
    want = []
    for i, t, _ in rows:
        p = plain_network(net, (t or "").lower().encode())
        ok = any(ch.isalpha() for ch in t or "")
        want.append((i, None if i is None else fold(i, 3) == 1, net.langs[int(p.argmax())] if ok else "und", round(float(p.max()), 4) if ok else 0.0))
    got = [(r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 4)) for r in langid.query(df).collect()]
    key = lambda r: (repr(r[:3]), r[3])
    assert all(a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=2e-3) for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True))


def test_quality_and_rules_queries_by_brute_force(spark, rows, docs, labels):
    """Scores, folds and verdicts of each row by the model's own arithmetic; counts by plain Python."""
    model, forest = quality.train(docs, labels), isolation.train(docs, labels)
    st = textstats.stats([t or "" for _, t in rows])
    score = model.score(np.array([st[f] for f in textstats.FEATURES]).T)
    want = sorted(((i, None if i is None else fold(i, 5) == 0, round(float(x), 6), int(x >= 0.3)) for (i, _), x in zip(rows, score)), key=repr)
    assert sorted(((r[0], r[1], round(r[2], 6), r[3]) for r in quality.query(docs, labels).collect()), key=repr) == want
    out = []
    for (i, t), anomaly in zip(rows, forest.score(isolation.rule_matrix(st))):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        often = Counter(grams)
        again = len({k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(5)})
        failed = len(w) < 10 or 100 * again > 20 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t or ""), len(lines) - len(set(lines)), again, failed, bool(not failed and anomaly <= forest.threshold)))
    got = isolation.query(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(out, key=repr) and any(x[-1] for x in out)


def plain_fingerprint(t):
    w = re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in t or ""))
    w = [x for x in w if x]
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_components_by_brute_force(spark, docs, rows):
    got = {r["doc_id"]: r for r in simhash.query(docs).where("doc_id is not null").collect()}
    fp = {i: plain_fingerprint(t) for i, t in rows if i is not None}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{x:016x}" for i, x in fp.items()}
    comp = {i: i for i in fp}
    changed = True
    while changed:
        changed = False
        for a in fp:
            for b in fp:
                if comp[b] < comp[a] and bin(fp[a] ^ fp[b]).count("1") <= 4:
                    comp[a], changed = comp[b], True
    assert {i: r["component_id"] for i, r in got.items()} == comp


@pytest.mark.parametrize("rows", [20, 2])
def test_vantage_point_links_are_whole(spark, rows):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for _ in range(600)]
    points = np.unique(seeds[rng.integers(0, 40, 600)] ^ np.array(flips, np.uint64))
    want = {(i, j) for i in range(len(points)) for j in range(i + 1, len(points)) if int(points[i] ^ points[j]).bit_count() <= 4}
    got = {(min(i, j), max(i, j)) for a, b in simhash.vp_links(points) for i, j in zip(a.tolist(), b.tolist())}
    assert got == want
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    pairs = simhash.links(df, shard_rows=rows).collect()
    where = {int(x): i for i, x in enumerate(points.view(np.int64))}
    root = simhash._forest(len(points), [(np.array([where[r["u"]] for r in pairs]), np.array([where[r["v"]] for r in pairs]))])
    whole = simhash._forest(len(points), [(np.array([i for i, _ in want]), np.array([j for _, j in want]))])
    assert (root == whole).all()
