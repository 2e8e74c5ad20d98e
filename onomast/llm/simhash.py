"""SimHash near-duplicates with vantage-point partitions.

Fingerprints that differ in at most `radius` bits are linked exactly. The partition has two levels:

* shards: the 64 bits are cut into `blocks` parts. At most `radius` of them can hold a difference, so a linked pair
  has distance 0 in each part of some set of `blocks - radius` parts. In the metric of such a set the triangle
  bound around any vantage point is tight (a pair at distance 0 is in the same ring of every vantage point), so
  rings do not overlap: the rings around the unit vectors name the bits themselves, which serve as the shard key.
  Rings of the whole 64-bit metric would overlap for most points (see the README).
* inside a shard, a vantage-point tree over the whole 64-bit metric: both halves are searched on their own and
  the points within `radius` of the boundary are queried across it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jaccard
from .common import per_slice, settle, settle_table, texts_of
from .components import components, least_of_root

SHINGLE, SEED, RADIUS = 4, 42, 4
#: A shard with more fingerprints than this is cut again by a second set of parts.
SHARD_ROWS = 20_000
LEAF = 24


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of the 4-word shingles; 0 without a word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return h(joined, SEED)
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
    return of_hashes(np.array([h(joined[i:j], SEED) for i, j in zip(at[:-SHINGLE].tolist(), (at[SHINGLE:] - 1).tolist(), strict=True)], np.uint64))


def of_hashes(hashes: np.ndarray) -> int:
    """The SimHash of shingle hashes; 0 of none."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[lo : lo + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row."""

    def run(part: pa.RecordBatch) -> dict:
        return {"doc_id": part.column(0), "fp": np.array([fingerprint(t) for t in texts_of(part)], np.uint64).view(np.int64)}

    return per_slice(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, fp long")


def _cuts(bits: list[int], blocks: int) -> list[int]:
    """Masks that deal the given bits out to so many blocks."""
    at = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in itertools.pairwise(at)]


def shard_masks(blocks: int, radius: int = RADIUS) -> list[int]:
    """One mask for each set of blocks that a linked pair may share."""
    cuts = _cuts(list(range(64)), blocks)
    return [sum(c) for c in itertools.combinations(cuts, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keyed(fps: DataFrame, masks: list[int], prefix: str | None = None) -> DataFrame:
    """A row for each fingerprint and mask: shard key and fingerprint."""
    parts = [F.lit(0) if prefix is None else F.col(prefix)]
    keys = F.array(*[F.xxhash64(*parts, F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])
    return fps.select(F.explode(keys).alias("key"), "fp")


def _near(x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of x times y within the radius, block by block."""
    a, b, step = [], [], max(1, (1 << 21) // max(1, len(y)))
    for lo in range(0, len(x), step):
        i, j = np.nonzero(np.bitwise_count(x[lo : lo + step, None] ^ y[None]) <= radius)
        a.append(i + lo)
        b.append(j)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def vp_links(points: np.ndarray, radius: int = RADIUS, whole: bool = True) -> list[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of distinct 64-bit points, by a vantage-point tree; index arrays into `points`.

    All pairs, or, if not `whole`, enough of them to join what is linked: the points within the radius of a vantage point form a
    star, and a set of points that are joined already is not searched again. So a tight ball costs one star, not its square.
    """
    out, todo, group = [], [np.arange(len(points))], np.arange(len(points))

    def join(a: np.ndarray, b: np.ndarray) -> None:
        out.append((a, b))
        if not whole and len(a):
            names, at = np.unique(group[np.r_[a, b]], return_inverse=True)
            root = names[_forest(len(names), [(at[: len(a)], at[len(a) :])])]
            where = np.searchsorted(names, group)
            known = (where < len(names)) & (names[np.minimum(where, len(names) - 1)] == group)
            group[known] = root[where[known]]

    def apart(at: np.ndarray) -> bool:
        return whole or bool((group[at] != group[at[0]]).any())

    while todo:
        at = todo.pop()
        if len(at) < 2 or not apart(at):
            continue
        if len(at) <= LEAF:
            i, j = _near(points[at], points[at], radius)
            join(at[i[i < j]], at[j[i < j]])
            continue
        far = np.bitwise_count(points[at] ^ points[at[0]])
        if not whole:
            ball = at[(far <= radius) & (far > 0)]
            join(np.full(len(ball), at[0]), ball)
            if not apart(at):
                continue
        mid = int(np.median(far))
        inner = far <= mid
        if inner.all():
            inner = far < mid
        if not inner.any() or inner.all():  # all at one distance from the vantage point: no ring tells them apart
            i, j = _near(points[at], points[at], radius)
            join(at[i[i < j]], at[j[i < j]])
            continue
        edge = int(far[inner].max())
        x, y = at[inner & (far >= int(far[~inner].min()) - radius)], at[~inner & (far <= edge + radius)]
        if len(x) and len(y) and apart(np.r_[x, y]):
            i, j = _near(points[x], points[y], radius)
            join(x[i], y[j])
        todo += [at[inner], at[~inner]]
    return out


def _forest(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least index reachable from each of n points."""
    root = np.arange(n)
    a = np.concatenate([x for x, _ in links]) if links else np.zeros(0, int)
    b = np.concatenate([y for _, y in links]) if links else np.zeros(0, int)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _shard_links(batches: Iterator[pa.RecordBatch], radius: int, direct: bool = False) -> Iterator[pa.RecordBatch]:
    """Of one partition of shards: a spanning star of each linked group of each shard; if `direct`, of each fingerprint its least link
    within the radius."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    key = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in got])
    fp = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in got])
    order = np.lexsort((fp, key))
    key, fp = key[order], fp[order].view(np.uint64)
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    length = np.diff(np.r_[start, len(key)])
    links = []
    small = np.repeat(length <= LEAF, length)
    for d in range(1, min(LEAF, int(length.max()))):
        i = np.flatnonzero(small[:-d] & (key[:-d] == key[d:]))
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= radius]
        links.append((i, i + d))
    for s, n in zip(start[length > LEAF].tolist(), length[length > LEAF].tolist(), strict=True):
        links += [(a + s, b + s) for a, b in vp_links(fp[s : s + n], radius, whole=False)]
    if direct:
        root = np.arange(len(fp))
        for a, b in links:
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
    else:
        root = _forest(len(fp), links)
    tied = np.flatnonzero(root != np.arange(len(fp)))
    u, v = fp[tied].view(np.int64), fp[root[tied]].view(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def links(fps: DataFrame, blocks: int = 6, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, direct: bool = False) -> DataFrame:
    """(u, v): links between distinct fingerprints that connect every group of them that is linked in some shard. If `direct`, only pairs
    within the radius, the least for each fingerprint and shard, which may leave groups in parts.

    `fps` holds each fingerprint once. `blocks` sets how finely shards are cut: 6 gives 15 keys of about 21 bits,
    7 gives 35 of about 27, for tables beyond 10**8 fingerprints. A shard beyond `shard_rows` is dealt out once
    more by parts of the bits that its key leaves open, with the same guarantee.
    """
    masks = shard_masks(blocks, radius)
    keyed = _keyed(fps, masks)
    hot = keyed.groupBy("key").count().where(F.col("count") > shard_rows).select("key")
    hot = settle(hot)
    if not hot.isEmpty():
        again = keyed.join(hot, "key", "left_semi")
        # the second level cuts all 64 bits into more parts: any linked pair shares a set of these too
        finer = again.select(F.explode(F.array(*[F.xxhash64("key", F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(shard_masks(blocks + 2, radius))])).alias("key"), "fp")
        keyed = keyed.join(hot, "key", "left_anti").unionByName(finer)
    return keyed.repartition("key").mapInArrow(lambda it: _shard_links(it, radius, direct), "u long, v long")


def ball_components(docs: DataFrame, blocks: int = 6, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id of every row of `docs` (doc_id, text; other columns are ignored).

    Null and empty texts have fingerprint zero and are linked like any other. Rows with one fingerprint are one
    point of the search, so groups of copies cost one row after the first, combining, shuffle. A null doc_id
    takes part in links but never names a component; a component of null ids alone has a null id. Repeated
    rows each give a row.
    """
    fps = settle(fingerprints(docs))
    points = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(points.select("fp"), blocks, radius).distinct(), rounds=40)
    named = settle_table(points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    of = least_of_root(named, "least", "component_id").select("fp", "component_id")
    return fps.join(of, "fp", "left").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, component_id of every row of `docs` by the task's default, similarity 0.8 of 5-word shingles: vantage-point links of SimHash
    that are checked on the sets, then what lies beyond the radius (see `jaccard`)."""
    return jaccard.near_duplicates(docs)


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that stay when each component of `near_duplicates` keeps its row of least id."""
    return jaccard.deduplicate(docs)


def query(docs: DataFrame) -> DataFrame:
    """op10: the contract's columns."""
    got = ball_components(docs)
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
