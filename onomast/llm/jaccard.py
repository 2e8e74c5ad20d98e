"""Near-duplicates by the Jaccard similarity of word shingles, each link checked exactly.

The method's own links come first: vantage-point trees over the SimHashes of the shingle sets find pairs within their radius
(`simhash.links`), and a pair counts only if the sets themselves are similar enough. The radius cannot reach similarity 0.8
(see the README), so what it leaves apart is completed: texts that share a band of MinHash values, which a pair of similarity
0.8 does for none of the 30 bands of 4 with probability (1 - 0.8**4)**30, about 1e-7. That takes two rounds: every text of a bucket
against the bucket's least one, unless they are linked already, then, in buckets that this leaves in more than one component,
every text against every other.

A bucket of over `CROWD` texts that are not alike (they share a long passage) is cut again: of each text only the rarest
shingles count, by their number among all texts of such buckets, as many as a similar text cannot miss altogether. Texts that
share one of these meet; this loses nothing. A crowd that even then meets is compared in blocks, each a task of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, per_slice, release, settle_table, texts_of
from .components import components, least_of_root

#: Words of a shingle; similarity of a link as a fraction; MinHash bands and values in each.
SHINGLE, ALIKE, BANDS, BAND = 5, (4, 5), 30, 4
SEED = 42
#: Texts of a bucket, or of a block, that are compared in one task.
CROWD = 1000
#: Products of a hash and a multiplier that a worker holds at once.
BLOCK = 1 << 18
_rng = np.random.default_rng(SEED)
_MUL = _rng.integers(0, 1 << 63, BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, BANDS * BAND, dtype=np.uint64)


def shingles(text: str) -> np.ndarray:
    """The sorted distinct hashes of the shingles; a text of fewer words is one shingle, one without a word has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return np.array([h(joined, SEED)], np.uint64)
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
    return np.unique(np.array([h(joined[i:j], SEED) for i, j in zip(at[:-SHINGLE].tolist(), (at[SHINGLE:] - 1).tolist(), strict=True)], np.uint64))


def bands(found: np.ndarray) -> np.ndarray:
    """A key for each band of the MinHash values of a set; none of an empty set."""
    if not len(found):
        return np.zeros(0, np.uint64)
    least = np.full(len(_MUL), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, BLOCK // len(_MUL))
    for lo in range(0, len(found), step):
        np.minimum(least, (found[None, lo : lo + step] * _MUL[:, None] + _ADD[:, None]).min(1), out=least)
    data = least.tobytes()
    return np.array([xxhash.xxh64_intdigest(data[8 * BAND * i : 8 * BAND * (i + 1)], i) for i in range(BANDS)], np.uint64)


def similar(a: int, b: int, both):
    """Whether `both` shared shingles of a and b make them alike, in whole numbers."""
    return both * ALIKE[1] >= (a + b - both) * ALIKE[0]


def bucket_links(sets: list[np.ndarray], root: np.ndarray) -> tuple[list[int], list[int]]:
    """Of one bucket whose sets have these roots: links between similar sets that join all that are linked in it."""
    size = np.array([len(s) for s in sets])
    start = np.r_[0, np.cumsum(size)[:-1]]
    names, at = np.unique(np.concatenate(sets), return_inverse=True)
    root = np.unique(root, return_inverse=True)[1]
    u, v = [], []
    for i in range(len(sets)):
        if (root == root[0]).all():
            break
        mark = np.zeros(len(names), bool)
        mark[at[start[i] : start[i] + size[i]]] = True
        both = np.add.reduceat(mark[at], start, dtype=np.int64)
        for j in np.flatnonzero(similar(size[i], size, both) & (root != root[i])).tolist():
            if root[j] != root[i]:
                u.append(i)
                v.append(j)
                root[root == root[j]] = root[i]
    return u, v


def _rows(docs: DataFrame) -> DataFrame:
    """rid, row, node, fp, bands of every row: a number, the row, a hash of its shingle set, its SimHash, the band keys."""
    from .simhash import of_hashes

    def run(part: pa.RecordBatch) -> dict:
        found = [shingles(t) for t in texts_of(part)]
        node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in found], np.uint64).view(np.int64)
        keys = [bands(s) for s in found]
        at = np.r_[0, np.cumsum([len(k) for k in keys])].astype(np.int32)
        flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
        return {"node": pa.array(node), "fp": np.array([of_hashes(x) for x in found], np.uint64).view(np.int64), "bands": pa.ListArray.from_arrays(pa.array(at), pa.array(flat))}

    return settle_table(carried(docs, run, "node long, fp long, bands array<long>").withColumn("rid", F.monotonically_increasing_id()))


def _sets(rows: DataFrame, rids: DataFrame) -> DataFrame:
    """node, found, size: the shingle sets of these rows."""

    def run(part: pa.RecordBatch) -> dict:
        found = [shingles(t) for t in texts_of(part)]
        at = np.r_[0, np.cumsum([len(s) for s in found])].astype(np.int32)
        flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
        return {"node": part.column(0), "found": pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), "size": np.diff(at)}

    some = rows.join(rids, "rid", "left_semi").select("node", F.col("row.text").alias("text"))
    return settle_table(per_slice(some, run, "node long, found array<long>, size int"))


def _across(members: DataFrame) -> DataFrame:
    """(u, v) of all buckets of (key, n, node, root, found). A bucket of n over CROWD is dealt out in pairs of blocks."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("node")
        found = t.column("found").combine_chunks()
        at, flat = found.offsets.to_numpy(), found.values.to_numpy().view(np.uint64)
        u, v = bucket_links([flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], t.column("root").to_numpy())
        node = t.column("node").to_numpy()
        release()
        return pa.table({"u": pa.array(node[u], pa.int64()), "v": pa.array(node[v], pa.int64())})

    blocks = F.ceil(F.col("n") / CROWD).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(1)), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    dealt = members.select("key", own.alias("own"), other, "node", "root", "found")
    dealt = dealt.select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "node", "root", "found")
    return dealt.groupBy("key", "a", "b").applyInArrow(run, "u long, v long")


def _rarest(crowd: DataFrame) -> DataFrame:
    """key, n, node, root, found: the texts of (node, root, found) by each of their rarest shingles that others have too.

    Of sets that share 4 in 5 of either, the first `size - ceil(size * 4 / 5) + 1` shingles in any common order have one in common.
    """
    each = crowd.select("node", F.explode("found").alias("key"))
    often = each.groupBy("key").count().where("count > 1")
    ranked = each.join(often, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "key"))).alias("shared"))  # at most the text's own shingles
    size = F.size("found")
    first = size - F.ceil(size * ALIKE[0] / F.lit(ALIKE[1])).cast("int") + 1
    # shingles that no other text has come first of all
    left = first - (size - F.size("shared"))
    keyed = crowd.join(ranked, "node").where(left > 0).select("node", F.explode(F.slice("shared", F.lit(1), left)).alias("x")).select("node", "x.key")
    met = settle_table(keyed.join(crowd.select("node", "root"), "node"))
    open_ = met.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key", "n")
    return met.join(open_, "key").join(crowd.select("node", "found"), "node").select("key", "n", "node", "root", "found")


def _vantage(points: DataFrame) -> DataFrame:
    """(u, v): nodes whose SimHashes vantage-point trees find within the radius, and nodes of one SimHash with the least of them."""
    from . import simhash

    at = settle_table(points.groupBy("fp").agg(F.min("node").alias("hub"), F.count("*").alias("n")))
    same = points.join(at.where("n > 1").select("fp", "hub"), "fp").where("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v"))
    near = simhash.links(at.select("fp"), direct=True).distinct()
    a, b = (at.select(F.col("fp").alias(k), F.col("hub").alias(f"of_{k}")) for k in "uv")
    return same.unionByName(near.join(a, "u").join(b, "v").select(F.col("of_u").alias("u"), F.col("of_v").alias("v")))


def _alike(rows: DataFrame, points: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of the pairs (u, v) of nodes those whose shingle sets are similar."""
    pairs = settle_table(pairs.distinct())
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = _sets(rows, points.join(nodes, "node", "left_semi").select("best.rid"))
    a, b = (sets.select(F.col("node").alias(k), F.col("found").alias(f"of_{k}"), F.col("size").alias(f"n_{k}")) for k in "uv")
    met = pairs.join(a, "u").join(b, "v")
    return settle_table(met.where(similar(F.col("n_u"), F.col("n_v"), F.size(F.array_intersect("of_u", "of_v")))).select("u", "v"))


def _keyed(points: DataFrame, roots: DataFrame) -> DataFrame:
    """key, node, root: a row for each band of each node."""
    named = points.join(roots.withColumnRenamed("root", "to"), "node", "left")
    return named.select("node", F.coalesce("to", "node").alias("root"), F.explode("bands").alias("key"))


def _roots(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """node, best of every shingle set (`best` is the row that stays of its copies), and node, root of the linked ones."""
    best = F.min(F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").cast("long").alias("doc_id"), "rid")).alias("best")
    points = settle_table(rows.groupBy("node").agg(best, F.first("bands").alias("bands"), F.first("fp").alias("fp")))
    near = _alike(rows, points, _vantage(points.where(F.size("bands") > 0)))
    first = components(near)
    # what the radius leaves apart: texts that share a band with the bucket's least one
    keyed = settle_table(_keyed(points, first))
    hubs = keyed.groupBy("key").agg(F.min(F.struct("node", "root")).alias("hub"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    hubs = hubs.select(F.col("key").alias("of"), F.col("hub.node").alias("u"), F.col("hub.root").alias("to"))
    pairs = keyed.join(hubs, (F.col("key") == F.col("of")) & (F.col("root") != F.col("to"))).select("u", F.col("node").alias("v"))
    near = near.unionByName(_alike(rows, points, pairs))
    first = components(near)
    now = _keyed(points, first)
    # buckets of the same members are compared once
    open_ = now.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("node").alias("x"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("sign")).where("lo < hi and n > 2")
    once = settle_table(open_.groupBy("x", "n", "sign").agg(F.min("key").alias("key")).select("key", "n"))
    members = settle_table(now.join(once, "key").select("key", "n", "node", "root"))
    sets = _sets(rows, points.join(members.select("node").distinct(), "node", "left_semi").select("best.rid")).select("node", "found")
    more = _across(members.where(F.col("n") <= CROWD).join(sets, "node"))
    crowded = members.where(F.col("n") > CROWD)
    if not crowded.isEmpty():
        crowd = settle_table(crowded.select("node", "root").dropDuplicates(["node"]).join(sets, "node").select("node", "root", "found"))
        more = more.unionByName(_across(_rarest(crowd)))
    more = settle_table(more)
    return points, first if more.isEmpty() else components(near.unionByName(more))


def _named(rows: DataFrame) -> DataFrame:
    """node, best: of every shingle set, the row that its component keeps, the one of least id."""
    points, roots = _roots(rows)
    named = settle_table(points.join(roots, "node", "left").select("node", F.col("best").alias("own"), F.coalesce("root", "node").alias("root")))
    return least_of_root(named, "own", "best").select("node", "best", "own")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, component_id of every row of `docs` (doc_id, text; other columns are ignored).

    Texts without a word are copies of each other. A null doc_id takes part in links but never names a component; a
    component of null ids alone has a null id. Sets are told apart by 64-bit hashes.
    """
    rows = _rows(docs)
    return rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), "node").join(_named(rows).select("node", "best"), "node").select("doc_id", F.col("best.doc_id").alias("component_id"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that stay when each component keeps its row of least id.

    Rows are judged by their texts: rows that share an id, or have none, stay if their texts are not alike. Null and empty texts are
    copies of each other; of equal rows one stays; columns of any name are carried; an empty table gives none. The numbers of
    the rows that go are settled first: where their measured size is below Spark's broadcast threshold, no text is shuffled.
    """
    rows = _rows(docs)
    kept = settle_table(_named(rows).select("best.rid").distinct())
    gone = settle_table(rows.select("rid").join(kept, "rid", "left_anti"))
    return rows.join(gone, "rid", "left_anti").select("row.*")
