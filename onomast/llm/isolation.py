"""Quality rules with an isolation forest over rule statistics.

A document fails the base rules on its word count or its repeated words. Of the rest, those whose statistics random
splits isolate after few cuts are dropped; the cut-off in path length is calibrated from all labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_slice, settle_table, texts_of
from .quality import one_of_each
from .textstats import COUNTS, stats

#: Shares that the forest splits on, drawn towards 0 as if PRIOR more characters (or words) without a hit were there, so
#: that short texts are not outliers for their length alone; then by logarithm above FLOOR, so that splits see their spread.
RULES = ["symbol_share", "bang_share", "pipe_share", "upper_share"]
PRIOR, FLOOR = 300, 1e-2
#: The other statistics: shares are drawn towards 0 in the same way (PRIOR_WORDS for words), mean word length towards
#: WORD characters; `repeats` is 1 - log(distinct words) / log(words), which does not rise with length as the share does.
#: Good texts differ widely in these, so the forest sees only how far a text lies beyond the good rows' TAIL quantiles, up
#: to FAR times their distance.
OTHERS = ["digit_share", "dup_lines", "repeat_words", "repeats", "top_word", "word_len", "longest_word"]
PRIOR_WORDS, WORD, TAIL, FAR = 60, 5, 0.005, 3
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


@dataclass(frozen=True)
class Config:
    """`sample_rows` bounds the labelled rows that trees draw from on the driver; `keep_share` is the share of label 1 that the cut-off
    must keep; `rare` is the share of label 0 beside label 1 in the rows that the forest is grown on."""

    sample_rows: int = 6000
    trees: int = 200
    subsample: int = 256
    rare: float = 0.02
    keep_share: float = 0.995
    seed: int = 7


def rule_matrix(st: dict[str, np.ndarray]) -> np.ndarray:
    """RULES, then OTHERS before `tails`."""
    of = {f: np.asarray(st[f], float) for f in [*RULES, "word_chars", "n_words", "digit_share", "dup_lines", "repeat_words", "distinct_words", "top_word", "longest_word"]}
    n, words = of["word_chars"], of["n_words"]
    drawn = words / (words + PRIOR_WORDS)
    others = [
        of["digit_share"] * n / (n + PRIOR), of["dup_lines"] * drawn, of["repeat_words"] * drawn,
        1 - np.log(np.maximum(of["distinct_words"] * words, 1)) / np.log(np.maximum(words, 2)),
        of["top_word"] * drawn, (n + PRIOR_WORDS * WORD) / (words + PRIOR_WORDS), np.log10(1 + of["longest_word"]),
    ]
    return np.stack([np.log10(of[f] * n / (n + PRIOR) + FLOOR) for f in RULES] + others, 1)


def bounds(x: np.ndarray) -> np.ndarray:
    """The TAIL quantiles, low and high, of the columns of OTHERS in good rows."""
    return np.quantile(x[:, len(RULES) :], [TAIL, 1 - TAIL], 0)


def tails(x: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """The rule matrix with each of OTHERS as its signed excess over the bounds."""
    low, high = bound
    over = np.maximum(x[:, len(RULES) :] - high, 0) - np.maximum(low - x[:, len(RULES) :], 0)
    return np.concatenate([x[:, : len(RULES)], np.clip(over / np.maximum(high - low, FLOOR), -FAR, FAR)], 1)


@dataclass
class Forest:
    """Trees as arrays: feature (-1 in a leaf), cut, children, path length."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    length: np.ndarray
    norm: float
    threshold: float = 1.0
    bound: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / norm): near 1 for rows that few splits isolate."""
        x = x if self.bound is None else tails(x, self.bound)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            while True:
                f = self.feature[t, at]
                if (f < 0).all():
                    break
                right = (x[rows, np.maximum(f, 0)] > self.cut[t, at]).astype(np.int64)
                at = np.where(f < 0, at, self.child[t, at] + right)
            total += self.length[t, at]
        return 2.0 ** (-total / max(len(self.feature), 1) / self.norm)


def _mean_path(n: float) -> float:
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, c: Config = Config()) -> Forest:
    """A forest over the rows of x. An empty x gives leaves only."""
    rng = np.random.default_rng(c.seed)
    size = min(c.subsample, len(x))
    depth = int(np.ceil(np.log2(max(size, 2))))
    nodes = 2 ** (depth + 2)
    feature, cut = np.full((c.trees, nodes), -1, np.int64), np.zeros((c.trees, nodes))
    child, length = np.zeros((c.trees, nodes), np.int64), np.zeros((c.trees, nodes))
    for t in range(c.trees):
        free, todo = 1, [(0, rng.choice(len(x), size, replace=False) if size else np.zeros(0, int), 0)]
        while todo:
            at, rows, d = todo.pop()
            length[t, at] = d + _mean_path(len(rows))
            if d >= depth or len(rows) <= 1:
                continue
            lo, hi = x[rows].min(0), x[rows].max(0)
            open_ = np.flatnonzero(hi > lo)
            if not len(open_):
                continue
            f = int(rng.choice(open_))
            feature[t, at], cut[t, at], child[t, at] = f, rng.uniform(lo[f], hi[f]), free
            right = x[rows, f] > cut[t, at]
            todo += [(free, rows[~right], d + 1), (free + 1, rows[right], d + 1)]
            free += 2
    return Forest(feature, cut, child, length, max(_mean_path(size), 1.0))


def calibrate(scores: np.ndarray, good: np.ndarray, keep_share: float) -> float:
    """The least score cut-off that keeps this share of the good rows."""
    return float(np.quantile(scores[good], keep_share)) + 1e-9 if good.any() else 1.0


def fit(x: np.ndarray, y: np.ndarray, failed: np.ndarray, c: Config = Config()) -> Forest:
    """Grown on rows that pass the base rules, label 0 thinned until it is rare (a forest isolates what is rare); the
    cut-off comes from all labelled rows that pass. Without a good row the forest is grown on all rows and drops none."""
    good, bad = (y == 1) & ~failed, np.flatnonzero((y == 0) & ~failed)
    rows = x[np.r_[np.flatnonzero(good), bad[: int(c.rare * good.sum())]]] if good.any() else x
    bound = bounds(x[good] if good.any() else x) if len(x) else None
    forest = grow(rows if bound is None else tails(rows, bound), c)
    forest.bound = bound
    forest.threshold = calibrate(forest.score(x), good, c.keep_share)
    return forest


def base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


#: Values that the driver sorts; bins that a longer column is cut into, again and again.
FEW, BINS = 1 << 16, 1 << 10


def order_statistics(rows: DataFrame, wanted: dict[str, list[int]]) -> dict[str, list[float]]:
    """Of each named column the values at these places (from 0) in its order, exact: all rows are counted in bins, the bin of a place is cut
    into bins again, until it holds FEW rows or one value. The driver gets counts of bins, and FEW values of one bin."""
    out: dict[str, list[float]] = {}
    for name, places in wanted.items():
        x, known = F.col(name), {}
        for place in places:
            part, before = rows.select(x), 0
            while place not in known:
                n, lo, hi = part.agg(F.count("*"), F.min(x), F.max(x)).first()
                if lo == hi or n <= FEW:
                    values = None if lo == hi else np.sort(part.toArrow().column(0).to_numpy())
                    known |= {p: lo if values is None else float(values[p - before]) for p in places if before <= p < before + n}
                    break
                step = (hi - lo) / BINS
                at = F.least(F.floor((x - lo) / step), F.lit(BINS - 1)) if step > 0 else (x > lo).cast("long")
                for b, many in sorted((r[0], r[1]) for r in part.groupBy(at.alias("at")).count().collect()):  # BINS rows at most
                    if place < before + many:
                        break
                    before += many
                part = part.where(at == b)
        out[name] = [known[p] for p in places]
    return out


def _between(places: list[float]) -> list[int]:
    return sorted({int(f(p)) for p in places for f in (np.floor, np.ceil)})


def quantiles(rows: DataFrame, n: int, wanted: dict[str, list[float]]) -> dict[str, list[float]]:
    """Exact quantiles of columns of `n` rows, between neighbours in proportion, as np.quantile has them."""
    places = {k: [q * (n - 1) for q in qs] for k, qs in wanted.items()}
    found = {k: dict(zip(_between(v), x, strict=True)) for (k, v), x in zip(places.items(), order_statistics(rows, {k: _between(v) for k, v in places.items()}).values(), strict=True)}
    return {k: [found[k][int(np.floor(p))] + (p - np.floor(p)) * (found[k][int(np.ceil(p))] - found[k][int(np.floor(p))]) for p in v] for k, v in places.items()}


MATRIX = [*RULES, *OTHERS]


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """quality, failed, MATRIX of one text of each labelled id, all of them: statistics meet labels, not texts."""
    ids = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("long").alias("quality"))

    def run(part: pa.RecordBatch) -> dict:
        st = stats(texts_of(part))
        x = rule_matrix(st)
        return dict(zip(MATRIX, x.T, strict=True)) | {"doc_id": part.column(0), "h": part.column(2), "failed": base_failed(st["n_words"], st["n_repeat_words"])}

    schema = f"doc_id long, h long, failed boolean, {', '.join(f'{k} double' for k in MATRIX)}"
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h")).where("doc_id is not null")
    met = per_slice(known, run, schema).join(ids, "doc_id")
    return settle_table(one_of_each(met, ["failed", *MATRIX]))


def train(docs: DataFrame, labels: DataFrame, c: Config = Config()) -> Forest:
    """The forest with bounds and cut-off from all labelled rows, exact. Only the rows that its trees draw from, `subsample` each of
    `sample_rows` by hash, are bounded: drawing few rows for each tree is the method."""
    rows = _labelled(docs, labels)
    passed = rows.where("quality = 1 and not failed")
    good = passed.count()
    base = passed if good else rows
    n = good or rows.count()
    by = [F.xxhash64("doc_id"), "doc_id"]
    matrix = lambda d: np.stack([d.column(k).to_numpy() for k in MATRIX], 1)
    grown = matrix(base.orderBy(*by).limit(c.sample_rows).select(*MATRIX).toArrow())
    if good:
        bad = rows.where("quality = 0 and not failed").orderBy(*by).limit(int(c.rare * len(grown))).select(*MATRIX)
        grown = np.concatenate([grown, matrix(bad.toArrow())])
    bound = None
    if n:
        tail = quantiles(base, n, {k: [TAIL, 1 - TAIL] for k in OTHERS})
        bound = np.array([tail[k] for k in OTHERS]).T
    forest = grow(grown if bound is None else tails(grown, bound), c)
    forest.bound = bound
    if good:
        names = passed.select(*MATRIX)
        scores = settle_table(per_slice(names, lambda part: {"score": forest.score(np.stack([x.to_numpy() for x in part.columns], 1))}, "score double", text=""))
        forest.threshold = quantiles(scores, good, {"score": [c.keep_share]})["score"][0] + 1e-9
    return forest


def judge(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, COUNTS, base_failed, anomaly (0 to 1), kept of every row of `docs`.

    Null and empty texts have no words and fail the base rules. Repeated rows each give a row; columns besides
    doc_id and text are ignored; an empty table gives none.
    """

    def run(part: pa.RecordBatch) -> dict:
        st = stats(texts_of(part))
        failed = base_failed(st["n_words"], st["n_repeat_words"])
        anomaly = forest.score(rule_matrix(st))
        return {k: st[k] for k in COUNTS} | {"doc_id": part.column(0), "base_failed": failed, "anomaly": anomaly, "kept": ~failed & (anomaly <= forest.threshold)}

    return per_slice(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"doc_id long, {', '.join(f'{k} long' for k in COUNTS)}, base_failed boolean, kept boolean, anomaly double")


def base_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, COUNTS and base_failed of every row of `docs`: the part of `judge` that no model decides."""
    return judge(docs, train(docs, labels)).select("doc_id", *COUNTS, "base_failed")


def query(docs: DataFrame, labels: DataFrame, c: Config = Config()) -> DataFrame:
    """op8: the contract's columns, then the anomaly score."""
    return judge(docs, train(docs, labels, c))
