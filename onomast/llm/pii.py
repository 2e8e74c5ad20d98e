"""Personal data: exact base patterns, and a linear-chain conditional random field over word shapes.

The field is trained in numpy from the small labelled table of `pii_table`, once, on the driver, and decoded by Viterbi over
batches of windows that cover every word of every text. What it labels is reported as it is; only spans that overlap a
base span are left out. Base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pii_table
from .common import LEFT, carried, per_slice, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Kinds that the field adds.
LEARNED = ("name", "street", "idnum")
LABELS = ["O", *(f"{p}-{k}" for k in LEARNED for p in "BI")]

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from each @: what stands before it is taken back to the previous match at most."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > last and text[lo - 1] in _LOCAL_CHARS:
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append(("email", lo, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[Span]:
    """The base contract's spans, by kind, then start. Look-behinds only skip starts inside a digit run whose first start failed."""
    out = emails(text)
    if _DIGIT.search(text) is None:
        return out
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(ch in "0123456789" for ch in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def _shape(word: str) -> str:
    """Letter case, digit runs by length, and marks; inner repeats are cut."""
    out = []
    for m in re.finditer(r"(?P<d>[0-9]+)|(?P<u>[^\W\d_a-zß-öø-ÿ]+)|(?P<l>[^\W\d_]+)|(?P<o>.)", word):
        if m.lastgroup == "d":
            n = len(m[0])
            out.append(f"d{n if n < 6 else '6-9' if n < 10 else '10-12' if n < 13 else '13-19' if n < 20 else '20+'}")
        else:
            out.append(("X" if len(m[0]) == 1 else "XX") if m.lastgroup == "u" else "x" if m.lastgroup == "l" else m[0])
        if len(out) > 9:
            break
    return "".join(out)


def _class(ch: str) -> str:
    return "d" if ch in "0123456789" else ("X" if ch.isupper() else "x") if ch.isalpha() else ch if ch in ".,;:!?\"'()-@/" else "o"


def _coarse(word: str) -> str:
    """The classes of the first, second and last character, and whether a digit is there: known for words of any shape."""
    return f"{_class(word[0])}{_class(word[1]) if len(word) > 2 else ''} {_class(word[-1])} {'d' if any(ch in '0123456789' for ch in word) else ''}"


_STREET_END = re.compile(rf".+({'|'.join(pii_table.GERMAN_WORDS)})$")


def _core(word: str) -> str:
    """The word without marks, in lower case; of a street's name in one word its end."""
    low = word.strip("\"'()[]{}.,;:!?").lower()
    m = _STREET_END.match(low)
    return f"-{m[1]}" if m else low


def _again(number: np.ndarray) -> np.ndarray:
    """Whether a word is the one before it or after it: SAME or OTHER."""
    same = np.zeros(number.shape, bool)
    same[..., 1:] = number[..., 1:] == number[..., :-1]
    same[..., :-1] |= same[..., 1:]
    return np.where(same, SAME, OTHER)


#: Numbers of a shape or word: 0 is one that the table lacks, and says nothing; 1 is the edge of a text or line.
UNKNOWN, EDGE = 0, 1
#: Numbers of a word that is repeated, and of one that is not.
SAME, OTHER = 2, 3
PLACES = (-2, -1, 0, 1, 2)


@dataclass
class Field:
    """Weights: one table for each place (-2 to +2) of shapes, coarse shapes and words, and repetition, and transitions."""

    shapes: dict[str, int]
    coarse: dict[str, int]
    words: dict[str, int]
    shape_w: np.ndarray
    coarse_w: np.ndarray
    word_w: np.ndarray
    again_w: np.ndarray
    trans: np.ndarray
    start: np.ndarray


def _forward_backward(e: np.ndarray, mask: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of labels, and the expected number of each pair of neighbouring labels, for padded sentences; in probabilities
    that each step scales to 1."""
    n, t, k = e.shape
    p, move = np.exp(e - e.max(2, keepdims=True)), np.exp(trans - trans.max())
    a, b = np.zeros((n, t, k)), np.ones((n, t, k))
    a[:, 0] = p[:, 0] * np.exp(start - start.max())
    a[:, 0] /= a[:, 0].sum(1, keepdims=True)
    for i in range(1, t):
        z = (a[:, i - 1] @ move) * p[:, i]
        a[:, i] = np.where(mask[:, i, None], z / z.sum(1, keepdims=True), a[:, i - 1])
    for i in range(t - 2, -1, -1):
        z = (b[:, i + 1] * p[:, i + 1]) @ move.T
        b[:, i] = np.where(mask[:, i + 1, None], z / z.sum(1, keepdims=True), b[:, i + 1])
    node = a * b
    node *= mask[..., None] / node.sum(2, keepdims=True)
    left, right = a[:, :-1], b[:, 1:] * p[:, 1:]
    total = np.einsum("ntj,jk,ntk->nt", left, move, right, optimize=True)
    pair = np.einsum("ntj,ntk->jk", left * (mask[:, 1:] / total)[..., None], right, optimize=True) * move
    return node, pair


class _Adder:
    """Sums rows by number; the numbers stay the same from round to round, so they are sorted once."""

    def __init__(self, ids: np.ndarray, size: int) -> None:
        flat = ids.ravel()
        self.order = np.argsort(flat, kind="stable")
        seen = flat[self.order]
        self.begin = np.flatnonzero(np.r_[True, seen[1:] != seen[:-1]])
        self.at, self.size = seen[self.begin], size

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((self.size, rows.shape[-1]))
        out[self.at] = np.add.reduceat(rows.reshape(-1, rows.shape[-1])[self.order], self.begin)
        return out


def _labels(kinds: list[str]) -> list[int]:
    last, out = "", []
    for kind in kinds:
        out.append(LABELS.index(f"{'I' if kind == last else 'B'}-{kind}") if kind else 0)
        last = kind
    return out


@lru_cache(maxsize=1)
def train(rounds: int = 120, penalty: float = 0.05, rate: float = 0.15) -> Field:
    """Gradient ascent on the penalised log likelihood of the table; deterministic.

    Words are features where they stand outside the slots or are words of streets, so that names and numbers are known by shape
    and company alone.
    """
    # an edge, outside, before and after each sentence, as in `learned_spans`
    rows = [(["", *(w for w, _ in s), ""], [0, *_labels([k for _, k in s]), 0]) for s in pii_table.sentences()]
    street = {_core(w) for w in (*pii_table.STREET_WORDS, *pii_table.FRENCH_WORDS, *pii_table.SPANISH_WORDS, *(f"x{w}" for w in pii_table.GERMAN_WORDS))}
    common: dict[str, int] = {}
    for ws, ls in rows:
        for w, x in zip(ws[1:-1], ls[1:-1], strict=True):
            if x == 0 or _core(w) in street:
                common[_core(w)] = common.get(_core(w), 0) + 1
    number = lambda names: {"": EDGE} | {x: i for i, x in enumerate(dict.fromkeys(names), 2)}
    every = [w for ws, _ in rows for w in ws if w]
    tables = [number(map(_shape, every)), number(map(_coarse, every)), number(w for w, n in common.items() if w and n > 1)]  # words of the chance prose come once
    t, k = max(len(ws) for ws, _ in rows), len(LABELS)
    of, number_of = np.full((4, len(rows), t), EDGE), {}
    y, mask = (np.zeros((len(rows), t), int) for _ in range(2))
    for i, (ws, ls) in enumerate(rows):
        for table, key, at in zip(tables, (_shape, _coarse, _core), of, strict=False):
            at[i, 1 : len(ws) - 1] = [table.get(key(w), UNKNOWN) for w in ws[1:-1]]
        of[3, i, 1 : len(ws) - 1] = _again(np.array([number_of.setdefault(w, len(number_of)) for w in ws[1:-1]]))
        y[i, : len(ws)], mask[i, : len(ws)] = ls, 1
    sizes = [*(len(table) + 1 for table in tables), OTHER + 1]
    weights = [np.zeros((5, n, k)) for n in sizes]
    ids = [np.stack([_moved(x, p) for p in PLACES]) for x in of]
    adders = [[_Adder(x, n) for x in at] for at, n in zip(ids, sizes, strict=True)]
    trans, start = np.zeros((k, k)), np.zeros(k)
    gold = np.eye(k)[y] * mask[..., None]
    gold_pair = ((gold[:, :-1, :, None] * gold[:, 1:, None]) * mask[:, 1:, None, None]).sum((0, 1))
    params, m2 = [*weights, trans, start], None
    for r in range(rounds):
        for w in weights:
            w[:, UNKNOWN] = 0
        e = sum(w[j][at[j]] for w, at in zip(weights, ids, strict=True) for j in range(5))
        node, pair = _forward_backward(e, mask, trans, start)
        diff = gold - node
        grads = [*(np.stack([add(diff) for add in adder]) for adder in adders), gold_pair - pair, diff[:, 0].sum(0)]
        grads = [g - penalty * p for g, p in zip(grads, params, strict=True)]
        m2 = [g * g for g in grads] if m2 is None else [0.9 * a + 0.1 * g * g for a, g in zip(m2, grads, strict=True)]
        for p, g, a in zip(params, grads, m2, strict=True):
            p += rate * (1 - r / rounds) * g / (np.sqrt(a) + 1e-3)
    for w in weights:
        w[:, UNKNOWN] = 0
    for k2 in range(len(LABELS)):  # an I label continues its own kind
        for k1 in range(len(LABELS)):
            if LABELS[k2][0] == "I" and LABELS[k1][1:] != LABELS[k2][1:]:
                trans[k1, k2] = -1e3
        if LABELS[k2][0] == "I":
            start[k2] = -1e3
    return Field(*tables, *(x.astype(np.float32) for x in params))


def _moved(x: np.ndarray, place: int) -> np.ndarray:
    out = np.full_like(x, EDGE)
    if place < 0:
        out[:, -place:] = x[:, :place]
    elif place > 0:
        out[:, :-place] = x[:, place:]
    else:
        out[:] = x
    return out


#: Stands for the end of a line among the words of a text.
LINE = "\n"


class Seen(dict):
    """Word -> its number; bounded. `weights` has what a word of each number adds to the labels at each place. Number 0 is the
    edge of a text or line."""

    LIMIT = 100_000

    def __init__(self, f: Field) -> None:
        super().__init__()
        self.f = f
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.numbers = array("i", [EDGE]), array("i", [EDGE]), array("i", [EDGE])
        self.made = np.zeros((0, len(PLACES), len(LABELS)), np.float32)
        self[LINE] = 0

    def __missing__(self, w: str) -> int:
        for x, table, key in zip(self.numbers, (self.f.shapes, self.f.coarse, self.f.words), (_shape, _coarse, _core), strict=True):
            x.append(table.get(key(w), UNKNOWN))
        self[w] = len(self.numbers[0]) - 1
        return self[w]

    def weights(self) -> np.ndarray:
        n = len(self.made)
        if n < len(self.numbers[0]):
            new = sum(w[:, np.array(x[n:])] for w, x in zip((self.f.shape_w, self.f.coarse_w, self.f.word_w), self.numbers, strict=True))
            self.made = np.concatenate([self.made, new.transpose(1, 0, 2)])
        return self.made

    def trim(self) -> None:
        if len(self) > self.LIMIT:
            self.reset()


CORE, MARGIN = 96, 12


def scores(f: Field, seen: Seen, number: np.ndarray) -> np.ndarray:
    """What the words of a stream, by number, and their neighbours say for each label."""
    n = len(number)
    beside = lambda x: np.r_[np.full(2, x[1], x[0].dtype), x[0], np.full(2, x[1], x[0].dtype)]
    words, again = beside((number, 0)), beside((np.where(number == 0, EDGE, _again(number)), EDGE))
    e = np.tile(f.again_w[:, OTHER].sum(0), (n, 1))
    table = seen.weights()
    for j in range(len(PLACES)):
        e += table[:, j][words[j : j + n]]
        some = np.flatnonzero(again[j : j + n] != OTHER)
        e[some] += (f.again_w[j] - f.again_w[j, OTHER])[again[j : j + n][some]]
    e[number == 0, 1:] = -50  # edges are outside
    return e


def decode(f: Field, e: np.ndarray, rows: int = 512) -> np.ndarray:
    """Labels of a stream of words by Viterbi, in windows of CORE words that see MARGIN words on either side."""
    n, k = e.shape
    out = np.zeros(n, np.int8)
    if not n:
        return out
    width, count = CORE + 2 * MARGIN, -(-n // CORE)
    full = np.zeros((count * CORE + 2 * MARGIN, k), np.float32)
    full[MARGIN : MARGIN + n] = e
    # all labels but O are out beside the text
    full[:MARGIN, 1:] = full[MARGIN + n :, 1:] = -50
    view = np.lib.stride_tricks.sliding_window_view(full, width, 0)[::CORE].transpose(2, 0, 1)
    for lo in range(0, count, rows):
        w = np.ascontiguousarray(view[:, lo : lo + rows])
        score = w[0] + f.start
        back = np.zeros((width, w.shape[1], k), np.int8)
        for t in range(1, width):
            z = score[:, None, :] + f.trans.T[None]
            back[t] = z.argmax(2)
            score = z.max(2) + w[t]
        at = score.argmax(1)
        labels = np.zeros((width, w.shape[1]), np.int8)
        for t in range(width - 1, -1, -1):
            labels[t] = at
            at = back[t][np.arange(len(at)), at]
        flat = labels[MARGIN : MARGIN + CORE].T.ravel()
        out[lo * CORE : lo * CORE + len(flat)] = flat[: n - lo * CORE]
    return out


def words_of(text: str) -> list[str]:
    """The words between white space, with LINE at the ends of lines."""
    if "\n" not in text:
        return text.split()
    out: list[str] = []
    for i, line in enumerate(text.split("\n")):
        if i:
            out.append(LINE)
        out += line.split()
    return out


def learned_spans(texts: list[str], f: Field, seen: Seen) -> list[list[Span]]:
    """Spans of the field in each text, as the field labels its words; marks around them are left out."""
    seen.trim()
    ids, count, get = [], np.zeros(len(texts), np.int64), seen.__getitem__
    split = []
    for i, t in enumerate(texts):
        words = words_of(t)
        split.append(words)
        count[i] = len(words) + 2
        ids.extend(map(get, words))
        ids.extend((0, 0))  # two edges between texts
    number = np.array(ids, np.int64)
    lab = decode(f, scores(f, seen, number))
    begin = np.r_[0, np.cumsum(count)]
    out: list[list[Span]] = [[] for _ in texts]
    hits = np.flatnonzero(lab)
    for i in np.unique(np.searchsorted(begin, hits, "right") - 1).tolist():
        mine = lab[begin[i] : begin[i + 1] - 2].tolist()
        at, place = 0, []
        for w in split[i]:
            at = texts[i].index(w, at)
            place.append((at, at + len(w)))
            at += len(w)
        j = 0
        while j < len(mine):
            if not mine[j]:
                j += 1
                continue
            kind, k = LABELS[mine[j]][2:], j + 1
            while k < len(mine) and LABELS[mine[k]] == f"I-{kind}":
                k += 1
            lo, hi = place[j][0], place[k - 1][1]
            raw = texts[i][lo:hi].rstrip(".,;:!?)]}\"'#$%*&|")
            lead = len(raw) - len(raw.lstrip("([{\"'"))
            if len(raw) > lead:
                out[i].append((kind, lo + lead, lo + len(raw)))
            j = k
    return out


def accuracy(f: Field) -> dict[str, tuple[float, float]]:
    """Precision and recall of whole spans by kind, on the held-out templates and fillers of the table."""
    gold: list[set[Span]] = []
    texts = []
    for s in pii_table.sentences(held_out=True):
        at, mine, last = 0, [], ""
        for w, kind in s:
            if kind and kind == last:
                mine[-1] = (kind, mine[-1][1], at + len(w))
            elif kind:
                mine.append((kind, at, at + len(w)))
            last, at = kind, at + len(w) + 1
        texts.append(" ".join(w for w, _ in s))
        gold.append({(k, a, a + len(texts[-1][a:b].rstrip(".,;:!?"))) for k, a, b in mine})
    found = [set(x) for x in learned_spans(texts, f, Seen(f))]
    out = {}
    for kind in LEARNED:
        of = lambda xs: {(i, x) for i, y in enumerate(xs) for x in y if x[0] == kind}  # noqa: E731,B023
        a, b = of(found), of(gold)
        out[kind] = (len(a & b) / max(len(a), 1), len(a & b) / max(len(b), 1))
    return out


def all_spans(texts: list[str], seen: Seen) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans, and those of the field that do not overlap them."""
    base = [base_spans(t) for t in texts]
    more = learned_spans(texts, seen.f, seen)
    return base, [[x for x in m if all(x[2] <= b[1] or b[2] <= x[1] for b in bs)] for bs, m in zip(base, more, strict=True)]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, base, learned: arrays of (kind, begin, end) in code points, of every row of `docs`.

    Null and empty texts have none. Repeated rows each give a row; columns besides doc_id and text are ignored.
    """
    one, f = "array<struct<kind:string,begin:int,end:int>>", train()

    def run(part: pa.RecordBatch) -> dict:
        base, more = all_spans(texts_of(part), _seen(f))
        return {"doc_id": part.column(0)} | {n: [[{"kind": k, "begin": a, "end": b} for k, a, b in x] for x in y] for n, y in (("base", base), ("learned", more))}

    return per_slice(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"doc_id long, base {one}, learned {one}")


_SEEN: dict[bytes, Seen] = {}


def _seen(f: Field) -> Seen:
    """The words that this process has met with a field; fields are told apart by their weights."""
    key = hashlib.sha256(f.trans.tobytes() + f.shape_w.tobytes()).digest()
    if key not in _SEEN:
        _SEEN.clear()
        _SEEN[key] = Seen(f)
    return _SEEN[key]


def _forget() -> bool:
    held = bool(_SEEN)
    _SEEN.clear()
    return held


LEFT[__name__] = _forget


def redact(text: str, found: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, named by the first."""
    out, at = [], 0
    for k, a, b in sorted(found, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
            at = b
        else:
            at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, with personal data in `text` replaced by its kind; n_chars, if there is one, follows.

    Null texts stay null, empty and clean ones as they are, with their n_chars. Repeated rows each give a row; columns of any name
    are carried; an empty table gives none.
    """
    f = train()

    def run(part: pa.RecordBatch) -> dict:
        raw = part.column(1).to_pylist()
        texts = [x or "" for x in raw]
        base, more = all_spans(texts, _seen(f))
        return {"clean": [r if not (b or m) else redact(t, [*b, *m]) for r, t, b, m in zip(raw, texts, base, more, strict=True)]}

    got = carried(docs, run, "clean string")
    changed = ~F.col("clean").eqNullSafe(F.col("row.text"))
    new = {"text": F.col("clean"), "n_chars": F.when(changed, F.length("clean").cast(dict(docs.dtypes).get("n_chars", "long"))).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return got.select(*[new[c].alias(c) if new.get(c) is not None else F.col(f"row.`{c}`") for c in docs.columns])


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the number of base spans of each kind, of every row of `docs`."""
    return query(docs).select("doc_id", *[f"n_{k}" for k in KINDS])


def query(docs: DataFrame) -> DataFrame:
    """op6: the contract's columns, then n_spans, the number of all spans.

    Null and empty texts have no span. Repeated rows each give a row; columns besides doc_id and text are ignored; an empty table
    gives none.
    """
    order, f = {k: i for i, k in enumerate((*KINDS, *LEARNED))}, train()

    def run(part: pa.RecordBatch) -> dict:
        base, more = all_spans(texts_of(part), _seen(f))
        out: dict[str, list] = {f"n_{k}": [sum(x[0] == k for x in b) for b in base] for k in KINDS}
        out["base_sha256"] = [hashlib.sha256(_joined(sorted(b, key=lambda x: (order[x[0]], x[1]))).encode()).hexdigest() for b in base]
        out["spans"] = [_joined(sorted([*b, *m], key=lambda x: (order[x[0]], x[1]))) for b, m in zip(base, more, strict=True)]
        return out | {"doc_id": part.column(0), "n_spans": [len(b) + len(m) for b, m in zip(base, more, strict=True)]}

    return per_slice(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")
