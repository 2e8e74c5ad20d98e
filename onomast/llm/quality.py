"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Boosted shallow regression trees propose rules: every path from a root to a node is a conjunction of thresholds. A
lasso logistic regression weighs them, most to zero. The rest are compiled into one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, crc_mod, per_slice, texts_of
from .textstats import FEATURES, SCHEMA, stats, with_stats

#: (feature, goes above the threshold, threshold)
Term = tuple[str, bool, float]


@dataclass(frozen=True)
class Config:
    """`sample_rows` bounds the labelled rows that are brought to the driver for fitting."""

    sample_rows: int = 6000
    trees: int = 60
    depth: int = 3
    leaf_rows: int = 8
    rate: float = 0.1
    thresholds: int = 32
    penalty: float = 0.0005
    rounds: int = 500
    cut: float = 0.3


@dataclass
class RuleModel:
    rules: list[tuple[Term, ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0

    def column(self) -> Column:
        """The score as an expression over the statistics' columns."""
        total = F.lit(float(self.bias))
        for rule, w in zip(self.rules, self.weights, strict=True):
            total = total + F.when(_condition(rule), F.lit(float(w))).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The same in numpy, for tests."""
        return 1 / (1 + np.exp(-(self.bias + _matrix(self.rules, x) @ np.array(self.weights)))) if self.rules else np.full(len(x), 1 / (1 + np.exp(-self.bias)))


def _condition(rule: tuple[Term, ...]) -> Column:
    out = F.lit(True)
    for name, above, cut in rule:
        out = out & (F.col(name) > cut if above else F.col(name) <= cut)
    return out


def _matrix(rules: list[tuple[Term, ...]], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)), bool)
    for j, rule in enumerate(rules):
        for name, above, cut in rule:
            v = x[:, FEATURES.index(name)]
            out[:, j] &= v > cut if above else v <= cut
    return out.astype(np.float64)


def _split(x: np.ndarray, g: np.ndarray, cuts: list[np.ndarray], leaf: int) -> tuple[int, float] | None:
    """The split of least squared error in the residuals g."""
    best, found = 1e-9 + g.sum() ** 2 / len(g), None
    for j, at in enumerate(cuts):
        if not len(at):
            continue
        bucket = np.searchsorted(at, x[:, j], "left")
        n = np.cumsum(np.bincount(bucket, minlength=len(at) + 1))[:-1]
        s = np.cumsum(np.bincount(bucket, g, len(at) + 1))[:-1]
        ok = (n >= leaf) & (len(g) - n >= leaf)
        if ok.any():
            gain = np.where(ok, s**2 / np.maximum(n, 1) + (g.sum() - s) ** 2 / np.maximum(len(g) - n, 1), -1)
            if gain.max() > best:
                best, found = gain.max(), (j, float(at[gain.argmax()]))
    return found


def _grow(x: np.ndarray, g: np.ndarray, cuts: list[np.ndarray], c: Config, rule: tuple[Term, ...], found: list, step: np.ndarray, rows: np.ndarray) -> None:
    if rule:
        found.append(rule)
    split = _split(x[rows], g[rows], cuts, c.leaf_rows) if len(rule) < c.depth else None
    if split is None:
        step[rows] = g[rows].mean()
        return
    j, cut = split
    above = x[rows, j] > cut
    _grow(x, g, cuts, c, (*rule, (FEATURES[j], False, cut)), found, step, rows[~above])
    _grow(x, g, cuts, c, (*rule, (FEATURES[j], True, cut)), found, step, rows[above])


def fit(x: np.ndarray, y: np.ndarray, c: Config = Config()) -> RuleModel:
    """Fits rules and weights; with no rows, or one class, the score is the smoothed share of label 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = RuleModel(bias=float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, c.thresholds)).round(9)) for j in range(x.shape[1])]
    raw, found = np.full(len(y), model.bias), []
    for _ in range(c.trees):
        g, step = y - 1 / (1 + np.exp(-raw)), np.zeros(len(y))
        _grow(x, g, cuts, c, (), found, step, np.arange(len(y)))
        raw += 4 * c.rate * step
    rules, columns, seen = [], [], set()
    for rule in dict.fromkeys(found):
        col = _matrix([rule], x)[:, 0]
        if 0 < col.mean() < 1 and (key := col.tobytes()) not in seen and (1 - col).tobytes() not in seen:
            seen.add(key)
            rules.append(rule)
            columns.append(col)
    if not rules:
        return model
    z = np.stack(columns, 1)
    w, b = _lasso(z, y, model.bias, c)
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleModel([rules[i] for i in kept], [float(w[i]) for i in kept], float(b))


def _lasso(z: np.ndarray, y: np.ndarray, bias: float, c: Config) -> tuple[np.ndarray, float]:
    """Logistic loss with an absolute penalty, by accelerated proximal steps."""
    n, m = z.shape
    mean = z.mean(0)
    zc = z - mean
    step = 4.0 * n / max(np.linalg.norm(zc, 2) ** 2 + n, 1.0)
    w, b, t = np.zeros(m), bias, 1.0
    vw, vb = w.copy(), b
    for _ in range(c.rounds):
        g = 1 / (1 + np.exp(-(zc @ vw + vb))) - y
        nw = vw - step * (zc.T @ g) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * c.penalty, 0)
        nb = vb - step * g.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b - mean @ w


def labelled(docs: DataFrame, labels: DataFrame, rows: int, held_mod: int = 5) -> DataFrame:
    """At most `rows` labelled texts outside the held-out fold, chosen by a hash of the id: doc_id, text, quality."""
    ids = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", held_mod) != 0)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")  # `rows` bounds the broadcast


def one_of_each(rows: DataFrame, names: list[str]) -> DataFrame:
    """doc_id, quality and statistics of one text of each id, that of the least hash: `rows` of labels bound what the driver gets, however
    many texts share an id."""
    return rows.groupBy("doc_id").agg(F.min_by(F.struct("quality", *names), "h").alias("x")).select("doc_id", "x.*")


def train(docs: DataFrame, labels: DataFrame, c: Config = Config()) -> RuleModel:
    rows = labelled(docs, labels, c.sample_rows)
    got = _features(rows)
    x = np.array([got.column(f).to_numpy() for f in FEATURES]).T if got.num_rows else np.zeros((0, len(FEATURES)))
    y = got.column("quality").to_numpy().astype(np.float64) if got.num_rows else np.zeros(0)
    order = np.lexsort([got.column("doc_id").to_numpy()]) if got.num_rows else slice(0)
    return fit(x[order], y[order], c)


def _features(rows: DataFrame):
    """Statistics and label of the sample, without its texts; a row for each label."""

    def run(part) -> dict:
        return stats(texts_of(part)) | {"doc_id": part.column(0), "quality": part.column(2), "h": part.column(3)}

    got = per_slice(rows.select("doc_id", "text", F.col("quality").cast("long").alias("quality"), F.xxhash64("text").alias("h")), run, f"doc_id long, quality long, h long, {SCHEMA}")
    return one_of_each(got, FEATURES).toArrow()


def score(docs: DataFrame, model: RuleModel, cut: float = Config.cut) -> DataFrame:
    """doc_id, score, predicted and the statistics of every row of `docs`.

    Null and empty texts have zero statistics and so a defined score; repeated rows each give a row; columns of
    `docs` besides doc_id and text are ignored; an empty table gives none.
    """
    got = with_stats(docs).withColumn("score", model.column())
    return got.select("doc_id", "score", (F.col("score") >= cut).cast("int").alias("predicted"), *FEATURES)


def keep_good(docs: DataFrame, model: RuleModel, cut: float = Config.cut) -> DataFrame:
    """The rows of `docs` that the model predicts as good, all columns.

    Null and empty texts have zero statistics and are judged by them; repeated rows stay or go together; columns of any name are
    carried; an empty table gives none.
    """
    got = carried(docs, lambda part: stats(texts_of(part)), SCHEMA)
    return got.where(model.column() >= cut).select("row.*")


def query(docs: DataFrame, labels: DataFrame, c: Config = Config()) -> DataFrame:
    """op1: the contract's columns; `held_out` is null where the doc_id is. The rest as in `score`."""
    got = score(docs, train(docs, labels, c), c.cut)
    return got.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
