"""Decontamination against a plain version without hashes or joins, and its rules for short items, numbers and ties."""

import random
import string

from onomast.llm import decontam

MARKS = string.punctuation + "«»“”‘’„…–—¿¡·"
WORDS = "river stone amber quiet maple lantern harbor violet copper meadow signal winter".split()


def plain_words(text):
    """(template, value, kind) of each word."""
    out, ended, before = [], True, None
    for raw in (text or "").split():
        w = raw.strip(MARKS)
        low = w.lower()
        ends = raw.rstrip("\"')]»”’")[-1:] in tuple(".!?:")
        if not w:
            ended = ends
            continue
        numeric = w[0].isdigit() and not any(ch.isalpha() for ch in w)
        unit = low in decontam.UNITS and before == "number"
        name = bool(out) and not ended and len(w) > 1 and w[0].isupper() and w[1:].islower()
        kind = "number" if numeric else "unit" if unit else "name" if name else "word"
        out.append((f"<{kind}>" if kind != "word" else low, low, kind))
        ended, before = ends, kind
    return out


def plain_key(part):
    real = sum(k == "word" for _, _, k in part)
    return ("values", *(v for _, v, _ in part)) if real < min(2, len(part)) else tuple(t for t, _, _ in part)


def plain_judge(hits, total, c):
    best, longest, changed = 0.0, 0, False
    for d in sorted({a - b for a, b, *_ in hits}):
        there, back, cover, differs = {}, {}, [False] * total, False
        for at, item_at, size, slots, item_slots in sorted((h for h in hits if d <= h[0] - h[1] <= d + 5), key=lambda h: (h[1], h[0], h[2])):
            t, b = dict(there), dict(back)
            if all(t.setdefault(x, y) == y and b.setdefault(y, x) == x for x, y in zip(item_slots, slots)):
                there, back = t, b
                cover[item_at : item_at + size] = [True] * size
                differs |= slots != item_slots
        run = max(len(x) for x in "".join("x" if v else " " for v in cover).split(" "))
        if sum(cover) / total > best or run > longest:
            changed = differs
        best, longest = max(best, sum(cover) / total), max(longest, run)
    return best, longest, changed


def plain(rows, bench, c):
    out = []
    for i, text in rows:
        doc = plain_words(text)
        items, share, changed, keys = [], 0.0, False, {}
        for item, t in bench:
            it = plain_words(t)
            if not it:
                continue
            if len(it) < c.least:
                if any([v for _, v, _ in plain_words(line)] == [v for _, v, _ in it] for line in (text or "").split("\n")):
                    items, share = [*items, item], 1.0
                continue
            size = min(c.window, len(it))
            slots = lambda part: [v for _, v, k in part if k != "word"]
            if size not in keys:
                keys[size] = [plain_key(doc[a : a + size]) for a in range(len(doc) - size + 1)]
            own = [plain_key(it[b : b + size]) for b in range(len(it) - size + 1)]
            hits = [(a, b, size, slots(doc[a : a + size]), slots(it[b : b + size])) for a, k in enumerate(keys[size]) if k in own for b, x in enumerate(own) if k == x]
            if hits:
                s, run, ch = plain_judge(hits, len(it), c)
                if s >= c.share or run >= c.run:
                    items, share, changed = [*items, item], max(share, s), changed or ch
        out.append((i, bool(items), sorted({x for x in items if x is not None}), share, changed))
    return sorted(out, key=repr)


def sentence(rng, n):
    kinds = [lambda: rng.choice(WORDS), lambda: rng.choice(WORDS).capitalize(), lambda: str(rng.randrange(30)), lambda: rng.choice(["km", "kg", "hours"]), lambda: rng.choice(WORDS) + rng.choice(".,!")]
    return " ".join(rng.choices(kinds, [8, 2, 2, 1, 1])[0]() for _ in range(n))


def test_query_by_brute_force(spark):
    rng = random.Random(3)
    bench = [(i, sentence(rng, rng.randrange(3, 30))) for i in range(25)]
    bench += [(90, "1 2 3 4 5 6 7 8 9 10 11 12"), (91, "Two words."), (92, "Same"), (93, None), (94, "..."), (95, bench[0][1]), (None, "an item that has no id at all but nine words")]
    rows = []
    for i in range(150):
        t = bench[rng.randrange(25)][1].split()
        for _ in range(rng.randrange(4)):  # new parameters and edits
            k = rng.randrange(len(t))
            t[k] = str(rng.randrange(99)) if t[k].isdigit() else rng.choice(WORDS).capitalize() if t[k].istitle() else t[k]
        if rng.random() < 0.4:
            t.insert(rng.randrange(len(t)), rng.choice(WORDS))
        cut = rng.randrange(len(t))
        rows.append((rng.choice([i, i, 5, None]), f"{sentence(rng, rng.randrange(15))} {' '.join(t[: len(t) if rng.random() < 0.6 else cut])} {sentence(rng, rng.randrange(15))}"))
    rows += [(200, None), (201, ""), (202, "5 6 7 8 9 10 11 12 13 14 15 16 17 18"), (203, "x\ntwo words!\ny"), (204, "x two words y"), (205, "1 2 3 4 5 6 7 8 9 10 11 12"), (206, "the an item that has no id at all but nine words"), (207, "0 " * 300)]
    rows += [rows[0], rows[0], (208, sentence(rng, 5_000) + " " + bench[3][1])]
    c = decontam.Config()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain(rows, bench, c)
    for conf in (c, decontam.Config(broadcast_windows=1)):
        got = decontam.query(df, spark.createDataFrame(bench, "item_id long, text string"), conf).collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert sum(r["contaminated"] for r in got) > 40
    assert decontam.query(df, spark.createDataFrame([], "item_id long, text string")).where("contaminated").count() == 0
