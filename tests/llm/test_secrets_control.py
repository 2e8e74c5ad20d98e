"""Control of false secrets: precision and recall by length, few secrets among many identifiers, and every column by brute force."""

import hashlib
import random
import re

import numpy as np

from onomast.llm import secrets


def step_up(ps, rate):
    """How many are reported by the exact rule."""
    ps = np.sort(ps)
    fine = np.flatnonzero(ps <= rate * np.arange(1, len(ps) + 1) / len(ps))
    return int(fine[-1]) + 1 if len(fine) else 0


def token(rng, n=44, name="alnum"):
    return "".join(rng.choices(dict(secrets.ENCODINGS)[name], k=n))


def test_precision_and_recall_by_length():
    got = secrets.accuracy()
    assert all(p >= 0.93 and r >= 0.95 for p, r in got.values()), got


def test_few_secrets_among_identifiers(spark):
    rng = random.Random(1)
    rows = [(i, f"key {secrets.identifier(rng, rng.randrange(40, 50), secrets.HELD_WORDS)} end") for i in range(980)]
    rows += [(1000 + i, f"key {token(rng)} end") for i in range(20)]  # 2 %
    rows += [(2000, f"key {'z1y2' * 11} end")]
    got = {r["doc_id"]: r["spans"] for r in secrets.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum("random:" in got[1000 + i] for i in range(20)) >= 18
    assert sum("random:" in got[i] for i in range(980)) <= 4 and not got[2000]
    alone = secrets.query(spark.createDataFrame([(1, "key order_2019_page_user_1234")], "doc_id long, text string")).first()
    assert alone["spans"] == ""


def test_binned_control_is_close_to_exact_at_any_share():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.001, 0.02, 0.05, 0.09, 0.5):
        n = int(10_000 * share)
        ps = np.r_[np.full(n, 1e-12), rng.random(10_000 - n)]
        counts: dict = {}
        for p in ps.tolist():
            counts[0, secrets.p_bin(p)] = counts.get((0, secrets.p_bin(p)), 0) + 1
        cut = secrets.cut_offs(counts, 0.05)[0]
        called = sum(k for (_, b), k in counts.items() if b >= cut)
        assert n <= called <= step_up(ps, 0.05) <= called + max(3, 0.02 * called)
    assert secrets.p_bin(1.0) == 0 and secrets.p_bin(0.0) == secrets.BINS - 1 == secrets.p_bin(1e-300)


def plain_base(t):
    plain = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    got = [("assign", *m.span()) for m in plain.finditer(t) if len(m[2]) >= 8]
    got += [(k, *m.span()) for k, p, n in (("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)) for m in re.finditer(p, t) if len(m[0]) >= n]
    return sorted(got, key=lambda x: (x[1], secrets.KINDS.index(x[0])))


def test_every_column_by_brute_force(spark):
    rng = random.Random(6)
    bits = ["token = abcd12345", "AKIAABCDEFGHIJKL", "0123456789abcdef" * 2, "stone", "é", "\n"]
    rows = [(i, " ".join([rng.choice(bits + [token(rng, rng.choice([22, 44, 80])), secrets.identifier(rng, 30)]) for _ in range(rng.randrange(9))])) for i in range(120)]
    rows += [(200, None), (201, ""), (None, token(rng)), (None, "plain"), (7, "twice AKIAABCDEFGHIJKL"), (7, "twice AKIAABCDEFGHIJKL"), (202, "word " * 30_000 + token(rng))]
    nulls, found = secrets.null_tails(), []
    for _, t in rows:
        base, more = plain_base(t or ""), []
        for m in re.finditer(r"[A-Za-z0-9+/_=-]+", t or ""):
            name = secrets.encoding(m[0]) if len(m[0]) >= 20 else None
            if name and all(b[2] <= m.start() or m.end() <= b[1] for b in base):
                cls = max(i for i, low in enumerate(secrets.LENGTHS) if low <= len(m[0]))
                more.append((m.span(), cls, secrets.p_bin(secrets.chance(secrets.combined(secrets.battery(m[0], name)), nulls[cls]))))
        found.append((base, more))
    sure = set()
    for cls in range(len(secrets.LENGTHS)):
        bins = [b for _, more in found for _, k, b in more if k == cls]
        for cut in sorted(set(bins), reverse=True):  # the largest set that the control allows
            if 10 ** (-cut / secrets.DECADE) <= 0.05 * sum(b >= cut for b in bins) / len(bins):
                sure |= {(cls, b) for b in bins if b >= cut}
    want = []
    for (i, _), (base, more) in zip(rows, found):
        spans = sorted([*base, *(("random", *at) for at, k, b in more if (k, b) in sure)], key=lambda x: (x[1], secrets.KINDS.index(x[0])))
        line = lambda xs: ",".join(f"{k}:{a}:{b}" for k, a, b in xs)
        want.append((i, *(sum(x[0] == k for x in base) for k in secrets.KINDS[:3]), hashlib.sha256(line(base).encode()).hexdigest(), line(spans), len(spans)))
    got = secrets.query(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sum("random:" in x[5] for x in want) > 20
