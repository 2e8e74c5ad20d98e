"""Language identification by a small convolutional network over bytes, trained and applied in numpy.

A text is lower-cased and read as UTF-8 in windows of fixed length that cover all of it. Each window passes an embedding,
filters of several widths, a maximum over its positions and a softmax; a text's probabilities are the mean of
its windows'. For prediction, embedding and filters are folded into one table for each filter offset.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, per_slice, texts_of

LETTER = regex.compile(r"\p{L}")
WIDTHS = (2, 3, 4)


@dataclass(frozen=True)
class Config:
    """`per_lang` bounds the texts of a language that the network learns from, and `all_langs` those of all languages together: with many
    languages each has fewer. `windows_per_text` bounds the windows of each, drawn over the whole text by a hash. Only these windows
    come to the driver. Every language of the labels can be predicted."""

    per_lang: int = 400
    all_langs: int = 25_600
    window: int = 256
    embedding: int = 6
    filters: int = 12
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    windows_per_text: int = 8
    seed: int = 3


@dataclass
class Net:
    langs: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    window: int

    def params(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.out, self.out_bias]


def new_net(langs: list[str], c: Config) -> Net:
    rng = np.random.default_rng(c.seed)
    return Net(
        langs, rng.normal(0, 0.5, (256, c.embedding)).astype(np.float32), [rng.normal(0, (2 / (w * c.embedding)) ** 0.5, (w, c.embedding, c.filters)).astype(np.float32) for w in WIDTHS],
        [np.zeros(c.filters, np.float32) for _ in WIDTHS], rng.normal(0, 0.2, (len(WIDTHS) * c.filters, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32), c.window,
    )


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _train_step(net: Net, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy over windows x (rows of bytes, zero padded)."""
    e = net.embed[x]
    pooled, arg = [], []
    for f, b, w in zip(net.filters, net.bias, WIDTHS, strict=True):
        n = x.shape[1] - w + 1
        z = sum(e[:, j : j + n] @ f[j] for j in range(w)) + b
        k = z.argmax(1)
        pooled.append(np.take_along_axis(z, k[:, None], 1)[:, 0])
        arg.append(k)
    h = np.concatenate(pooled, 1)
    a = np.maximum(h, 0)
    p = _softmax(a @ net.out + net.out_bias)
    p[np.arange(len(y)), y] -= 1
    p /= len(y)
    dh = (p @ net.out.T) * (h > 0)
    d_embed, d_filters, d_bias, rows = np.zeros_like(net.embed), [], [], np.arange(len(y))[:, None]
    for i, (f, k, w) in enumerate(zip(net.filters, arg, WIDTHS, strict=True)):
        g = dh[:, i * f.shape[2] : (i + 1) * f.shape[2]]
        df = np.zeros_like(f)
        for j in range(w):
            at = k + j
            df[j] = np.einsum("bfe,bf->ef", e[rows, at], g)
            np.add.at(d_embed, x[rows, at], g[:, :, None] * f[j].T[None])
        d_filters.append(df)
        d_bias.append(g.sum(0))
    return [d_embed, *d_filters, *d_bias, a.T @ p, p.sum(0)]


def windows(data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover each text (they overlap by the widest filter less one), zero padded, and the text of each."""
    lap = max(WIDTHS) - 1
    step = length - lap
    size = np.fromiter(map(len, data), np.int64, len(data))
    count = np.maximum(1, -(-(size - lap) // step))
    of = np.repeat(np.arange(len(data)), count)
    begin = np.r_[0, np.cumsum(size)][:-1]
    nth = np.arange(len(of)) - np.repeat(np.r_[0, np.cumsum(count)][:-1], count)
    joined = np.concatenate([np.frombuffer(b"".join(data), np.uint8), np.zeros(length, np.uint8)])
    at = begin[of] + nth * step
    x = np.lib.stride_tricks.sliding_window_view(joined, length)[at].copy()
    left = size[of] - nth * step
    short = np.flatnonzero(left < length)
    x[short] *= np.arange(length)[None] < left[short, None]
    return x, of


def drawn(x: np.ndarray, of: np.ndarray, keys: np.ndarray, c: Config) -> np.ndarray:
    """Numbers of the windows that training uses: of each text the `windows_per_text` whose hashes with the text's key are least."""
    nth = np.arange(len(of)) - np.searchsorted(of, of)
    mixed = (keys.astype(np.int64).view(np.uint64)[of] + nth.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.lexsort((mixed ^ (mixed >> np.uint64(29)), of))
    rank = np.arange(len(of)) - np.searchsorted(of[order], of[order])
    return np.sort(order[rank < c.windows_per_text])


def encoded(texts: list[str]) -> list[bytes]:
    return [t.lower().encode("utf-8", "surrogatepass") for t in texts]


def train(texts: list[str], langs: list[str], c: Config = Config()) -> Net:
    """A network of labelled texts."""
    if not texts:
        return new_net([], c)
    x, of = windows(encoded(texts), c.window)
    some = drawn(x, of, np.arange(len(texts)), c)
    return train_windows(x[some], [langs[i] for i in of[some]], c)


def train_windows(x: np.ndarray, langs: list[str], c: Config = Config()) -> Net:
    """A network of labelled windows, languages drawn alike often."""
    names = sorted(set(langs))
    net = new_net(names, c)
    if not len(x):
        return net
    rng = np.random.default_rng(c.seed)
    number = {k: i for i, k in enumerate(names)}
    y = np.array([number[v] for v in langs])
    share = np.bincount(y, minlength=len(names)).astype(float)
    weight = 1 / share[y]
    weight /= weight.sum()
    m, v, t = [np.zeros_like(p) for p in net.params()], [np.zeros_like(p) for p in net.params()], 0
    steps = max(c.epochs * len(y) // c.batch, 60)
    for _ in range(steps):
        pick = rng.choice(len(y), min(c.batch, len(y)), p=weight)
        t += 1
        for i, (p, g) in enumerate(zip(net.params(), _train_step(net, x[pick], y[pick]), strict=True)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            p -= c.rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-7)
    return net


def fold(net: Net) -> list[list[np.ndarray]]:
    """For each width and offset, what a byte there adds to the filters: 256 x filters."""
    return [[net.embed @ f[j] for j in range(w)] for f, w in zip(net.filters, WIDTHS, strict=True)]


def predict(net: Net, texts: list[str], tables: list[list[np.ndarray]] | None = None, rows: int = 128) -> np.ndarray:
    """Mean probabilities, a row for each text."""
    tables = tables or fold(net)
    x, of = windows(encoded(texts), net.window)
    total = np.zeros((len(texts), len(net.langs)))
    for lo in range(0, len(x), rows):
        part = x[lo : lo + rows]
        pooled = []
        for table, b, w in zip(tables, net.bias, WIDTHS, strict=True):
            n = part.shape[1] - w + 1
            z = table[0].take(part[:, :n], 0)
            for j in range(1, w):
                z += table[j].take(part[:, j : j + n], 0)
            pooled.append(z.max(1) + b)
        p = _softmax(np.maximum(np.concatenate(pooled, 1), 0) @ net.out + net.out_bias)
        np.add.at(total, of[lo : lo + rows], p)
    return total / np.bincount(of, minlength=len(texts))[:, None]


def sample(docs: DataFrame, c: Config = Config()) -> tuple[np.ndarray, list[str]]:
    """Windows of labelled texts outside the held-out fold, and their languages.

    Texts are chosen by a hash of id and text, and equal rows count once, so no id or group of copies fills the sample. The driver
    gets one row for each language, then about 2 x `per_lang` x `windows_per_text` windows of each.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", 3) != 1))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", F.xxhash64("doc_id", "text").alias("h"))
    total = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not total:
        return np.zeros((0, c.window), np.uint8), []
    per_lang = max(1, min(c.per_lang, c.all_langs // len(total)))
    # a share of each language that holds about twice the bound, then the bound itself
    odds = F.element_at(F.from_json(F.lit(json.dumps({k: min(1.0, 2.0 * per_lang / n) for k, n in total.items()})), "map<string,double>"), F.col("lang"))
    spread = F.pmod("h", F.lit(1_000_003)) / F.lit(1_000_003.0)
    some = known.where(spread < odds).groupBy("lang", "doc_id", "h").agg(F.first("text").alias("text"))

    def run(part: pa.RecordBatch) -> dict:
        x, of = windows(encoded(part.column(3).to_pylist()), c.window)
        pick = drawn(x, of, part.column(2).to_numpy(), c)
        who = of[pick]
        return {"lang": part.column(0).take(pa.array(who)), "doc_id": part.column(1).take(pa.array(who)), "h": part.column(2).take(pa.array(who)), "nth": pick - np.searchsorted(of, who), "x": [x[i].tobytes() for i in pick]}

    got = per_slice(some.select("lang", "doc_id", "h", "text"), run, "lang string, doc_id long, h long, nth long, x binary").toArrow()
    rows = sorted(zip(*(got.column(k).to_pylist() for k in ("lang", "doc_id", "h", "nth", "x")), strict=True))
    texts: dict[str, set] = {}
    kept = [(k, x) for k, d, h, _, x in rows if (d, h) in texts.setdefault(k, set()) or len(texts[k]) < per_lang and not texts[k].add((d, h))]
    return np.frombuffer(b"".join(x for _, x in kept), np.uint8).reshape(-1, c.window), [k for k, _ in kept]


def identify(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, lang_pred, score of every row of `docs`.

    `und` with score 0 where the text is null, empty or without a letter, or no language was learned. Repeated rows
    each give a row; columns besides doc_id and text are ignored; an empty table gives none.
    """

    def run(part: pa.RecordBatch) -> dict:
        texts = texts_of(part)
        lettered = np.array([bool(LETTER.search(t)) for t in texts])
        if not net.langs:
            return {"doc_id": part.column(0), "lang_pred": ["und"] * len(texts), "score": np.zeros(len(texts))}
        p = predict(net, texts, tables)
        best = p.argmax(1)
        return {"doc_id": part.column(0), "lang_pred": [net.langs[i] if ok else "und" for i, ok in zip(best, lettered, strict=True)], "score": np.where(lettered, np.clip(p.max(1), 0, 1), 0.0)}

    tables = fold(net) if net.langs else []
    return per_slice(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, lang_pred string, score double")


def query(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """op2: the contract's columns; `held_out` is null where the doc_id is. The rest as in `identify`."""
    got = identify(docs, train_windows(*sample(docs, c), c))
    return got.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
