"""Secrets: exact base patterns, and a battery of randomness tests on other tokens.

A long token whose characters fit an encoding of random bytes is tested for what random digits show: a uniform alphabet
(chi-squared, over classes that words use unevenly), runs of character classes, and no serial correlation. The combined
statistic is small for random tokens. Its null hypothesis is an ordinary identifier: words, numbers and separators put
together by rule give its distribution for each length class, and a token's p-value is the chance that such an identifier looks
as random. Step-up control over all tokens of a length class then bounds the share of false secrets among those reported;
a token too short to tell has no small p-value and is not reported.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_slice, settle_table, texts_of

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_HINT = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+")
_DIGIT = re.compile(r"[0-9]")
#: Encodings of random bytes, by their alphabets, the narrowest first.
ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Lower ends of the length classes; the control counts p-values in so many bins a decade, down to 1e-300.
LENGTHS, DECADE, BINS = (20, 24, 28, 34, 40, 52, 64, 96, 128), 20, 6001
# Letters that words use most, and words of the identifiers of the null hypothesis and of the held-out ones.
FREQUENT = "etaoinsrhl"
WORDS = "user order item page index table report config service module data value test build version release image product session request server client handler manager factory default system public window update search result filter message account".split()
HELD_WORDS = "invoice widget parser channel profile storage gateway pattern customer monitor backup archive journal schema cluster vector".split()
Span = tuple[str, int, int]


@dataclass(frozen=True)
class Config:
    """`false_rate` bounds the share of false secrets among those reported in a length class; `null` is the number of identifiers
    that stand for the null hypothesis in each."""

    false_rate: float = 0.05
    null: int = 1500


def base_spans(text: str) -> list[Span]:
    """The base contract's spans by start, then kind. An assign span runs over the whole match."""
    out: list[Span] = []
    if _HINT.search(text):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    if _DIGIT.search(text) or len(text) >= 32:
        out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def encoding(token: str) -> str | None:
    """The narrowest alphabet that holds the token; None unless digits and letters mix as random bytes' would."""
    core = token.rstrip("=")
    digits = sum(ch.isdigit() for ch in core)
    if digits < max(2, len(core) // 16) or len(core) - digits < 4:
        return None
    for name, alphabet in ENCODINGS:
        if set(core) <= set(alphabet):
            return name
    return None


def _upper_chi2(x: float, k: int) -> float:
    """P(chi-squared with k degrees > x), by Wilson and Hilferty."""
    if k <= 0:
        return 1.0
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _class(ch: str) -> int:
    """0 digit, 1 frequent and 2 other lower case, 3 frequent and 4 other upper case, 5 mark."""
    if ch in "0123456789":
        return 0
    if not ch.isalpha():
        return 5
    return (1 if ch.islower() else 3) + (ch.lower() not in FREQUENT)


def battery(token: str, name: str) -> tuple[float, float, float]:
    """p-values of uniformity over the classes of the alphabet, of runs of digits, lower and upper case, and of serial correlation."""
    core = token.rstrip("=")
    alphabet = dict(ENCODINGS)[name]
    kind = np.array([_class(ch) for ch in alphabet])
    x = np.array([alphabet.index(ch) for ch in core])
    n, a = len(x), len(alphabet)
    # classes with less than one expected character join the next one
    share = np.bincount(kind, minlength=6) / a
    seen = np.bincount(kind[x], minlength=6)
    used = share > 0
    size, got = share[used] * n, seen[used]
    while len(size) > 2 and size.min() < 1:
        i = int(size.argmin())
        j = i - 1 if i else 1
        size[j] += size[i]
        got[j] += got[i]
        size, got = np.delete(size, i), np.delete(got, i)
    uniform = _upper_chi2(float(((got - size) ** 2 / size).sum()), len(size) - 1) if len(size) > 1 else 1.0
    # symbols that come more often than chance allows, too
    many = np.bincount(x, minlength=a)
    pairs = float((many * (many - 1)).sum())
    mean = n * (n - 1) / a
    uniform = min(1.0, 2 * min(uniform, 0.5 * math.erfc((pairs - mean) / math.sqrt(4 * max(mean, 1e-9)))))
    case = np.array([0, 1, 1, 2, 2, 3])[kind]
    p = np.bincount(case, minlength=4) / a
    stay = float((p * p).sum())
    runs, expect = 1 + int((case[x][1:] != case[x][:-1]).sum()), 1 + (n - 1) * (1 - stay)
    p_runs = math.erfc(abs(runs - expect) / math.sqrt(2 * max((n - 1) * stay * (1 - stay), 1e-9)))
    d = x - (a - 1) / 2
    r = float((d[1:] * d[:-1]).sum()) / math.sqrt(n - 1) / ((a * a - 1) / 12)
    return uniform, p_runs, math.erfc(abs(r) / math.sqrt(2))


def combined(ps: tuple[float, ...]) -> float:
    """Fisher's combination, as a logarithm: about 1.6 for random tokens, larger for others."""
    return math.log(max(-2 * sum(math.log(max(p, 1e-300)) for p in ps), 1e-9))


def identifier(rng: random.Random, length: int, words: list[str] = WORDS) -> str:
    """A token of words, numbers and separators, at least `length` long, with digits and letters as `encoding` wants them."""
    while True:
        style, sep = rng.choice(["camel", "snake", "kebab", "plain", "upper", "path", "hexish", "version"]), rng.choice("_-")
        out: list[str] = []
        while sum(map(len, out)) < length:
            r = rng.random()
            if r < 0.3:
                w = "".join(rng.choice("0123456789") for _ in range(rng.randrange(1, 7)))
            elif r < 0.36:
                w = f"{rng.choice('vVrRxX')}{rng.randrange(100)}"
            elif r < 0.42:
                w = f"{rng.randrange(1990, 2030)}{rng.randrange(1, 13):02d}{rng.randrange(1, 29):02d}"
            else:
                w = rng.choice(words)
                w = w[: rng.randrange(2, len(w) + 1)] if rng.random() < 0.2 else w
                w = w.capitalize() if style == "camel" and (out or rng.random() < 0.5) else w.upper() if style == "upper" else w
            out.append(w)
            if style in ("snake", "kebab", "path", "version", "hexish") or rng.random() < 0.1:
                out.append("/" if style == "path" else sep)
        token = "".join(out).strip("_-/")
        if style == "path" and rng.random() < 0.5:
            token = token.replace("_", "").replace("-", "")
        if len(token) >= length and encoding(token):
            return token


@lru_cache(maxsize=2)
def null_tails(c: Config = Config()) -> tuple[tuple[np.ndarray, float], ...]:
    """For each length class the sorted statistics of identifiers, and the scale of their lower tail beyond the first percent."""
    rng, out = random.Random(17), []
    for low, high in zip(LENGTHS, [*LENGTHS[1:], 2 * LENGTHS[-1]], strict=True):
        tokens = (identifier(rng, rng.randrange(low, high))[: high - 1] for _ in range(c.null))
        got = np.sort([combined(battery(t, encoding(t) or "base64")) if encoding(t) else math.inf for t in tokens])
        edge = got[len(got) // 100]
        out.append((got, max(float((edge - got[: len(got) // 100]).mean()), 0.02)))
    return tuple(out)


def chance(statistic: float, null: tuple[np.ndarray, float]) -> float:
    """The share of identifiers that look as random; beyond their lowest percent the tail is exponential."""
    got, scale = null
    edge = len(got) // 100
    if statistic < got[edge]:
        return (edge + 1) / (len(got) + 1) * math.exp(-(got[edge] - statistic) / scale)
    return (int(np.searchsorted(got, statistic, "right")) + 1) / (len(got) + 1)


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def suspects(text: str, base: list[Span], nulls: tuple) -> list[tuple[int, int, int, float]]:
    """(begin, end, length class, p) of tokens beside the base spans that fit an encoding."""
    if _DIGIT.search(text) is None:
        return []
    out = []
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        if any(x[1] < b and a < x[2] for x in base) or (name := encoding(m[0])) is None:
            continue
        cls = length_class(b - a)
        out.append((a, b, cls, chance(combined(battery(m[0], name)), nulls[cls])))
    return out


def p_bin(p: float) -> int:
    """The bin of a p-value: bin b holds those from 10 ** (-(b + 1) / DECADE) up to 10 ** (-b / DECADE), the last one all below."""
    return min(int(-DECADE * math.log10(max(min(p, 1.0), 1e-300))), BINS - 1)


def cut_offs(counts: dict[tuple[int, int], int], false_rate: float) -> dict[int, int]:
    """For each length class the first bin that is reported, with all of smaller p-values (BINS: none): step-up control on
    counts, each bin at its upper edge."""
    out = {}
    for cls in {k for k, _ in counts}:
        total = sum(n for (k, _), n in counts.items() if k == cls)
        seen, out[cls] = 0, BINS
        for b in reversed(range(BINS)):
            seen += counts.get((cls, b), 0)
            if seen and 10 ** (-b / DECADE) <= false_rate * seen / total:
                out[cls] = b
    return out


def accuracy(c: Config = Config(), n: int = 400, seed: int = 5) -> dict[str, tuple[float, float]]:
    """Precision and recall by length class, over as many random tokens (all encodings) as identifiers of held-out words, with the
    control over them."""
    rng, nulls, out = random.Random(seed), null_tails(c), {}
    for cls, (low, high) in enumerate(zip(LENGTHS, [*LENGTHS[1:], 2 * LENGTHS[-1]], strict=True)):
        rows = []
        while len(rows) < n:
            t = "".join(rng.choices(rng.choice(ENCODINGS)[1], k=rng.randrange(low, high)))
            if encoding(t):
                rows.append((t, True))
        while len(rows) < 2 * n:
            t = identifier(rng, rng.randrange(low, high), HELD_WORDS)[: high - 1]
            if encoding(t):
                rows.append((t, False))
        bins = [p_bin(chance(combined(battery(t, encoding(t))), nulls[cls])) for t, _ in rows]
        counts: dict[tuple[int, int], int] = {}
        for b in bins:
            counts[cls, b] = counts.get((cls, b), 0) + 1
        cut = cut_offs(counts, c.false_rate)[cls]
        called = [b >= cut for b in bins]
        hit = sum(x and y for x, (_, y) in zip(called, rows, strict=True))
        out[f"{low}+"] = (hit / max(sum(called), 1), hit / n)
    return out


_ONE = "array<struct<kind:string,begin:int,end:int,cls:int,bin:int>>"


def scan(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """doc_id, base, random: arrays of (kind, begin, end) in code points, of every row of `docs`.

    Two passes: spans and suspects of each text are settled, counts of suspects by length class and bin of p-value (at
    most 54,009 rows) give the cut-offs, and these are applied. Null and empty texts have none. Repeated rows each
    give a row and count; columns besides doc_id and text are ignored; an empty table gives none.
    """

    nulls = null_tails(c)

    def run(part: pa.RecordBatch) -> dict:
        base, more = [], []
        for t in texts_of(part):
            b = base_spans(t)
            base.append([{"kind": k, "begin": x, "end": y, "cls": -1, "bin": -1} for k, x, y in b])
            more.append([{"kind": "random", "begin": x, "end": y, "cls": k, "bin": p_bin(p)} for x, y, k, p in suspects(t, b, nulls)])
        return {"doc_id": part.column(0), "base": base, "random": more}

    found = settle_table(per_slice(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"doc_id long, base {_ONE}, random {_ONE}"))
    rows = found.select(F.explode("random").alias("x")).groupBy("x.cls", "x.bin").count().collect()  # at most classes x bins
    cut = cut_offs({(r["cls"], r["bin"]): r["count"] for r in rows}, c.false_rate)
    keep = F.lit(False)
    limit = F.create_map(*[F.lit(v) for kv in cut.items() for v in kv]) if cut else None
    sure = F.filter("random", lambda x: x["bin"] >= F.element_at(limit, x["cls"])) if cut else F.filter("random", lambda x: keep)
    return found.select("doc_id", "base", sure.alias("random"))


def query(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """op7: the contract's columns, then n_spans, the number of all spans.

    Null and empty texts have none. Repeated rows each give a row; columns besides doc_id and text are ignored; an empty table gives
    none.
    """
    order = {k: i for i, k in enumerate(KINDS)}

    def run(part: pa.RecordBatch) -> dict:
        base, more = part.column(1).to_pylist(), part.column(2).to_pylist()
        joined = lambda xs: ",".join(f"{x['kind']}:{x['begin']}:{x['end']}" for x in sorted(xs, key=lambda x: (x["begin"], order[x["kind"]])))
        out: dict[str, list] = {f"n_{k}": [sum(x["kind"] == k for x in b) for b in base] for k in KINDS[:3]}
        out["base_sha256"] = [hashlib.sha256(joined(b).encode()).hexdigest() for b in base]
        out["spans"] = [joined([*b, *m]) for b, m in zip(base, more, strict=True)]
        return out | {"doc_id": part.column(0), "n_spans": [len(b) + len(m) for b, m in zip(base, more, strict=True)]}

    return per_slice(scan(docs, c), run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long", text="")


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the number of base spans of each kind, of every row of `docs`."""
    return query(docs).select("doc_id", *[f"n_{k}" for k in KINDS[:3]])
