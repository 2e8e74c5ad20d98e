"""License scan: exact containment by brute force, recall of the bands on edited templates at any offset, no Python in the plan."""

import random

import regex

from onomast.llm import licenses

WORDS = "river stone amber quiet maple lantern harbor violet copper meadow signal winter garden puzzle thunder velvet orchid canyon".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def shingles(t):
    w = [x for x in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if x]
    return [tuple(w[i : i + 3]) for i in range(len(w) - 2)]


def contained(t, template, size):
    """The largest share of a template's shingles in a stretch as long as the scan looks at."""
    h, own = shingles(t), shingles(template)
    n, best = len(own), 0.0
    for at in range(max(1, len(h))):
        best = max(best, len(set(own) & set(h[max(0, at - n) : max(0, at - n) + 2 * n + size])) / len(set(own)))
    return best


def edited(rng, words, share):
    """Words changed until about `share` of the shingles are left."""
    out = list(words)
    for _ in range(int((1 - share) * len(words) / 3 + 0.5)):
        out[rng.randrange(len(out))] = rng.choice(WORDS)
    return " ".join(out)


def test_found_templates_are_those_of_brute_force(spark):
    rng, c = random.Random(5), licenses.Config()
    names = sorted(licenses.TEMPLATES)
    rows = []
    for i in range(240):
        t = licenses.TEMPLATES[rng.choice(names)]
        rows.append((i, f"{text(rng, rng.randrange(60))} {edited(rng, t.split(), rng.choice([1, 1, 0.95, 0.9, 0.85, 0.8, 0.7]))} {text(rng, rng.randrange(30))}"))
    rows += [(500, None), (501, ""), (502, "Licensed under the"), (503, text(rng, 3000)), (None, licenses.TEMPLATES["mit"]), (504, licenses.TEMPLATES["isc"].upper()), (504, licenses.TEMPLATES["isc"].upper()), (505, text(rng, 20_000) + licenses.TEMPLATES["zlib"])]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), overlapping=True).collect()
    size = {k: licenses.window_size(len(shingles(t)), c) for k, t in licenses.TEMPLATES.items()}
    wanted = met = exact = 0
    for (i, t), r in zip(rows, got):
        assert i == r["doc_id"]
        real = {k: contained(t, licenses.TEMPLATES[k], size[k]) for k in names} if i is None or i < 505 else {"zlib": 1.0}
        true = {k for k, v in real.items() if v >= c.share}
        assert set(r["licenses"]) <= true
        wanted += len(true)
        met += len(set(r["licenses"]) & true)
        exact += any(v == 1 and k not in r["licenses"] for k, v in real.items())
    assert wanted > 150 and met / wanted >= 0.97 and not exact, (wanted, met, exact)


def test_one_name_for_one_place(spark):
    t = licenses.TEMPLATES
    rows = [(1, "x y " + t["lgpl-2.1"]), (2, t["gpl-2.0"] + " " + t["gpl-warranty"]), (3, t["mit-text"].replace("free of charge", "without a charge", 1)), (4, t["apache-2.0"].upper())]
    got = {r["doc_id"]: r["licenses"] for r in licenses.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "lgpl-2.1", 2: "gpl-2.0,gpl-warranty", 3: "mit-text", 4: "apache-2.0"}


def test_plan_is_native(spark):
    plan = licenses.query(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Exchange", "Pandas"))
