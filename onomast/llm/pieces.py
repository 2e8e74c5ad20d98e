"""SentencePiece encoding and decoding with sampled segmentations: Gumbel top-k without replacement.

The lattice of a text has a node for each character and an edge for each vocabulary piece. Edge weights are
`-alpha * (log rank + log log vocabulary)`, Zipf's law on the merge rank, as the model itself stores ranks only. Backward
sums over the lattice turn weights into the exact probability of each next piece. Perturbed A* search then pops
the prefix whose best completion has the largest Gumbel-perturbed log probability: bounds are exact, so each pop
leads straight to one new segmentation and leaves one deviation bound for each of its nodes. The k+1-st largest
value gives each sample's inclusion probability.

Pieces with a space sign after their first character are left out, 14 runs of spaces in the installed model: segmentations that
use them have probability 0 here, and log probabilities and inclusion are those of the lattice without them.

Random numbers are hashes of the row key, the sample, the unit and the step: results do not depend on batches or tasks.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LEFT, per_slice, texts_of

SPACE = "▁"
SLICE = 1 << 19


@dataclass(frozen=True)
class Config:
    """`model` is the path of a SentencePiece model file; empty: the public model that is installed."""

    model: str = ""
    samples: int = 2
    alpha: float = 1.0
    seed: int = 11


class Vocabulary:
    """Pieces of a model: a sorted table of hashes of their characters, weights, and the bytes that each id stands for."""

    def __init__(self, path: str, alpha: float) -> None:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        size = m.get_piece_size()
        self.bytes: list[bytes] = [b""] * size
        self.byte_id = np.zeros(256, np.int64)
        text, ids = [], []
        for i in range(size):
            p = m.id_to_piece(i)
            if m.is_byte(i):
                self.bytes[i] = bytes([int(p[3:5], 16)])
                self.byte_id[int(p[3:5], 16)] = i
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or SPACE in p[1:]):
                self.bytes[i] = p.replace(SPACE, " ").encode()
                text.append(p)
                ids.append(i)
        self.table = pa.array(self.bytes, pa.binary())
        self.longest = max(map(len, text))
        self.width = -(-self.longest // 8) * 8  # columns of a lattice, eight to a word
        self.id_type = np.int16 if size < 1 << 15 else np.int32
        rank = np.maximum(np.array([-m.get_score(i) for i in ids]), 1.0)
        weight = -alpha * (np.log(rank + 1) + np.log(np.log(size)))
        self.byte_weight = -alpha * (np.log(size) + np.log(np.log(size)))
        key = np.array([self.key(np.array([ord(ch) for ch in p], np.uint64)) for p in text], np.uint64)
        order = np.argsort(key)
        self.keys, self.ids, self.weights = key[order], np.array(ids)[order], weight[order].astype(np.float32)
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        # tables over 22 bits of the hash: of whole pieces, and of what begins a longer piece
        slot = (self.keys >> np.uint64(42)).astype(np.int64)
        self.slot = np.full(1 << 22, -1, np.int32)  # where a hash's first key stands among the sorted ones; few slots have more
        self.slot[slot[::-1]] = np.arange(len(slot), dtype=np.int32)[::-1]
        self.shared = int(np.bincount(slot).max())
        heads = np.array([self.key(np.array([ord(ch) for ch in p], np.uint64)) for p in {p[:j] for p in text for j in range(1, len(p))}], np.uint64)
        self.head = np.zeros(1 << 22, bool)
        self.head[(heads >> np.uint64(42)).astype(np.int64)] = True

    MULT = np.uint64(0x9E3779B97F4A7C15)

    @classmethod
    def key(cls, chars: np.ndarray) -> np.uint64:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for ch in chars:
                h = cls.step(h, ch)
        return h

    @classmethod
    def step(cls, h, ch):
        h = (h + ch + np.uint64(1)) * cls.MULT
        return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=2)
def vocabulary(path: str, alpha: float) -> Vocabulary:
    if not path:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return Vocabulary(path, alpha)


@dataclass
class Lattice:
    """Nodes of all distinct units. Column j of a row is the edge over j+1 characters; `rest` is the exact probability of
    all edges but the likeliest, `top`."""

    start: np.ndarray
    end: np.ndarray
    prob: np.ndarray
    cum: np.ndarray
    piece: np.ndarray
    points: np.ndarray
    is_end: np.ndarray
    top: np.ndarray
    rest: np.ndarray


def lattice(units: list[str], v: Vocabulary, into: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> Lattice:
    """The lattice of the units; `into` are rows of a larger one's prob, cum and piece to write to."""
    chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, units), np.int64, len(units))
    end = np.cumsum(size)
    start = end - size
    n = len(chars)
    left = np.repeat(end, size) - np.arange(n)
    edges: list[tuple[np.ndarray, ...]] = []
    spelt = np.ones(n, bool)
    # a space is an edge's first character only at a unit's head; elsewhere the sign itself is spelt in bytes
    inner = chars == ord(SPACE)
    inner[start[size > 0]] = False
    spaced = bool(inner.any())
    # nodes next to their unit's end first: the backward sums take them in this order
    h, rows = np.zeros(n, np.uint64), np.argsort(left.astype(np.uint16) if n and left.max() < 1 << 16 else left, kind="stable")
    rank = np.empty(n, np.int32)
    rank[rows] = np.arange(n, dtype=np.int32)
    if spaced:
        rows = rows[~inner[rows]]
        h = h[: len(rows)]
    for j in range(v.longest):
        if not len(rows):
            break
        h = Vocabulary.step(h, chars[rows + j])
        bits = (h >> np.uint64(42)).astype(np.int64)
        at = v.slot[bits]
        some = np.flatnonzero(at >= 0)
        at, mine = at[some], h[some]
        ok = v.keys[at] == mine
        for more in range(1, v.shared):
            missed = np.flatnonzero(~ok)
            nxt = np.minimum(at[missed] + more, len(v.keys) - 1)
            hit = v.keys[nxt] == mine[missed]
            at[missed[hit]], ok[missed[hit]] = nxt[hit], True
        edges.append((rows[some[ok]], np.full(int(ok.sum()), j), v.weights[at[ok]].astype(np.float64), v.ids[at[ok]]))
        if j == 0:
            spelt[edges[0][0]] = False
        ok = v.head[bits] & (left[rows] > j + 1)
        if spaced:
            ok &= ~inner[np.minimum(rows + j + 1, n - 1)]
        rows, h = rows[ok], h[ok]
    # characters that are no piece: bytes, marked by piece -2
    none = np.flatnonzero(spelt)
    none = none[np.argsort(rank[none])]
    c = chars[none]
    edges.insert(0, (none, np.zeros(len(none), int), v.byte_weight * (1 + (c > 0x7F).astype(int) + (c > 0x7FF) + (c > 0xFFFF)), np.full(len(none), -2)))
    node, col, weight, ids = (np.concatenate(x) for x in zip(*edges, strict=True))
    # backward sums, from the nodes next to their unit's end; each node has an edge
    order = np.argsort(rank[node], kind="stable")  # a merge: each column's edges are in order already
    node, col, weight, ids = node[order], col[order], weight[order], ids[order]
    head = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if n else np.zeros(0, int)
    many = np.diff(np.r_[head, len(node)])
    level = np.searchsorted(left[node], np.arange(1, (int(left.max()) if n else 0) + 2))
    heads = np.searchsorted(head, level)
    beta = np.zeros(n + 1)
    after = np.where(col + 1 == left[node], n, node + col + 1)
    for lo, hi, x, y in zip(level[:-1], level[1:], heads[:-1], heads[1:], strict=True):
        if lo == hi:
            continue
        z, at, size = weight[lo:hi] + beta[after[lo:hi]], head[x:y] - lo, many[x:y]
        top = np.maximum.reduceat(z, at)
        beta[node[head[x:y]]] = top + np.log(np.add.reduceat(np.exp(z - np.repeat(top, size)), at))
    p = np.exp(weight + beta[after] - beta[node])
    best, rest = np.zeros(n, np.int8), np.zeros(n)
    prob, cum, piece = into or (np.empty((n, v.width), np.float32), np.empty((n, v.width), np.float32), np.empty((n, v.width), v.id_type))
    prob[:], piece[:] = 0, -1
    prob[node, col], piece[node, col] = p, ids
    if n:
        nth = np.repeat(np.maximum.reduceat(p, head), many) == p
        nth &= np.r_[True, (node[1:] != node[:-1]) | ~nth[:-1]]  # one likeliest edge, or ties side by side
        best[node[nth]] = col[nth]
        others = np.where(best[node] == col, 0.0, p)
        rest[node[head]] = np.add.reduceat(others, head)
        cum[:] = prob
        tail = np.r_[head[1:], len(node)] - 1
        cum[node[tail], col[tail]] = 2.0  # rounding must not lead past a node's last edge
        for j in range(1, v.width):
            cum[:, j] += cum[:, j - 1]
    is_end = np.zeros(n + 1, bool)
    is_end[end] = True
    return Lattice(start, end, prob, cum, piece, chars, is_end, best, rest)


class Store:
    """The lattices of the units seen so far, until they hold NODES nodes; then those used most stay, up to KEPT nodes."""

    NODES, KEPT = 600_000, 300_000

    def __init__(self, v: Vocabulary) -> None:
        self.v, self.need = v, 0
        self._room(self.NODES)

    def _room(self, cap: int) -> None:
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.used, self.cap, width = 0, cap, self.v.width
        self.start, self.end, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.prob, self.cum, self.piece = np.empty((cap, width), np.float32), np.empty((cap, width), np.float32), np.empty((cap, width), self.v.id_type)
        self.points, self.is_end, self.top, self.rest = np.zeros(cap, np.uint32), np.zeros(cap + 1, bool), np.zeros(cap, np.int8), np.zeros(cap)

    def _shrink(self, names: list[str]) -> None:
        """Forgets all units but the most used of `names`, whose uses count half from now on."""
        size = self.end - self.start
        order = np.argsort(-self.uses, kind="stable")
        stay = np.sort(order[np.cumsum(size[order]) <= self.KEPT])
        rows, n = _ranges(self.start[stay], size[stay]), int(size[stay].sum())
        for x in (self.prob, self.cum, self.piece, self.points, self.top, self.rest):
            x[:n] = x[rows]
        self.end = np.cumsum(size[stay])
        self.start, self.uses, self.used = self.end - size[stay], self.uses[stay] >> 1, n
        self.is_end[:] = False
        self.is_end[self.end] = True
        self.known.clear()
        self.known.update(zip([names[i] for i in stay.tolist()], range(len(stay)), strict=True))

    def _numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        before, kinds, count = len(self.known), [], np.zeros(len(texts), np.int64)
        number = self.known.__getitem__
        for i, t in enumerate(texts):
            parts = t.split(" ") if t else []
            count[i] = len(parts)
            kinds.extend(map(number, parts))
        return np.array(kinds, np.int64), count, [SPACE + p for p in islice(self.known, before, None)]

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each unit of the texts, and how many each text has."""
        if self.used + self.need > self.cap and len(self.uses):  # as many new nodes as last time would not fit
            self._shrink(list(self.known))
        kinds, count, new = self._numbers(texts)
        self.need = need = sum(map(len, new))
        if self.used + need > self.cap and len(self.uses):
            self._shrink(list(islice(self.known, len(self.uses))))
            kinds, count, new = self._numbers(texts)
            need = sum(map(len, new))
        if self.used + need > self.cap or (self.cap > self.NODES and self.used + need <= self.NODES):
            self._room(self.NODES)
            kinds, count, new = self._numbers(texts)
            need = sum(map(len, new))
            if need > self.cap:  # a very long text: room for it alone
                self._room(need)
                kinds, count, new = self._numbers(texts)
        if new:
            self._add(new, need)
        self.uses += np.bincount(kinds, minlength=len(self.uses))
        return kinds, count

    def _add(self, new: list[str], n: int) -> None:
        at = slice(self.used, self.used + n)
        part = lattice(new, self.v, (self.prob[at], self.cum[at], self.piece[at]))
        self.points[at], self.top[at], self.rest[at] = part.points, part.top, part.rest
        self.is_end[self.used : self.used + n + 1] |= part.is_end
        self.start, self.end = np.r_[self.start, part.start + self.used], np.r_[self.end, part.end + self.used]
        self.uses = np.r_[self.uses, np.zeros(len(new), np.int64)]
        self.used += n

    def lattice(self) -> Lattice:
        return Lattice(self.start, self.end, self.prob, self.cum, self.piece, self.points, self.is_end, self.top, self.rest)


@lru_cache(maxsize=1)
def store(path: str, alpha: float) -> Store:
    return Store(vocabulary(path, alpha))


def _forget() -> bool:
    """Drops the store; the vocabulary, which is small and slow to make, stays."""
    held = store.cache_info().currsize > 0
    store.cache_clear()
    return held


LEFT[__name__] = _forget


def _uniform(*parts: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from a hash of integer parts."""
    h = np.uint64(0x2545F4914F6CDD1D)
    for p in parts:
        h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    h = h ^ (h >> np.uint64(32))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _walk(lat: Lattice, cur: np.ndarray, end: np.ndarray, key: np.ndarray, unit: np.ndarray, sample: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random paths from `cur` to `end`: (row, node, edge) of every step, in the order of rows, then steps."""
    rows, out = np.arange(len(cur)), []
    cur = cur.copy()
    alive = cur < end
    rows, step = rows[alive], 0
    while len(rows):
        node = cur[rows]
        u = _uniform(key[rows], sample[rows], unit[rows], np.uint64(step) + np.zeros(len(rows), np.uint64))
        passed = lat.cum.take(node, 0) < u.astype(np.float32)[:, None]
        edge = np.bitwise_count(passed.view(np.uint64)).sum(1, dtype=np.int64)
        out.append((rows, node, edge))
        cur[rows] = node + edge + 1
        rows = rows[cur[rows] < end[rows]]
        step += 1
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z
    r, n, e = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(r, kind="stable")
    return r[order], n[order], e[order]


def _gumbel_below(top: np.ndarray, where: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at location `where`, given that they are under `top`."""
    with np.errstate(divide="ignore"):
        return -np.logaddexp(-top, np.log(-np.log(u)) - where)


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(lo - np.r_[0, np.cumsum(n)][:-1], n) + np.arange(n.sum())


@dataclass
class Sample:
    """One segmentation of each text: steps of all texts in order, with their bounds, and values for each text."""

    at: np.ndarray
    node: np.ndarray
    edge: np.ndarray
    logp: np.ndarray
    log_prob: np.ndarray
    value: np.ndarray
    exists: np.ndarray


def sample_slice(texts: list[str], keys: np.ndarray, st: Store, k: int, seed: int) -> tuple[Lattice, list[Sample], np.ndarray]:
    """k distinct segmentations of each text, by falling perturbed value, and the value of the next one (-inf: none)."""
    kind, count = st.units(texts)
    lat = st.lattice()
    doc = np.repeat(np.arange(len(texts)), count)
    unit_at = np.r_[0, np.cumsum(count)]
    n = len(texts)
    key = _mixkey(keys, seed)
    value = -np.log(-np.log(_uniform(key, np.full(n, 1 << 40))))  # of the whole text, whose log probability is 0
    r, node, edge = _walk(lat, lat.start[kind], lat.end[kind], key[doc], np.arange(len(kind)) - unit_at[doc], np.zeros(len(kind), np.int64))
    path = _Paths(doc[r], node, edge, _log(lat.prob[node, edge]))
    exists = count > 0
    samples: list[Sample] = []
    pool = {x: np.zeros(0, t) for x, t in (("doc", int), ("g", float), ("sample", int), ("pos", int), ("mask", int))}
    new_from, out_mask = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for s in range(k):
        at = np.searchsorted(path.doc, np.arange(n + 1))
        total = np.r_[0.0, np.cumsum(path.logp)]
        samples.append(Sample(at, path.node, path.edge, path.logp, total[at[1:]] - total[at[:-1]], value, exists))
        # what leaves this path at one of its new steps: its location, and a Gumbel value under the path's own
        fresh = _ranges(at[:-1] + new_from, at[1:] - at[:-1] - new_from)
        d = path.doc[fresh]
        pos = fresh - at[d]
        e = path.edge[fresh]
        p = lat.prob[path.node[fresh], e].astype(np.float64)
        mask = np.int64(1) << e
        node = path.node[fresh]
        rest = np.where(lat.top[node] == e, lat.rest[node], 1 - p)
        fork = np.flatnonzero(pos == new_from[d])  # where it left its parent, the parent's edges are out as well
        mask[fork] |= out_mask[d[fork]]
        rest[fork] = _rest(lat, node[fork], mask[fork])
        where = total[fresh] - total[at[d]] + _log(rest)
        a = np.log(-np.log(_uniform(key[d], np.full(1, (1 << 41) + s), pos))) - where
        pick = _least(a, d, n, k - s)
        g = -np.logaddexp(-value[d[pick]], a[pick])
        pool = {x: np.concatenate([pool[x], y]) for x, y in (("doc", d[pick]), ("g", g), ("sample", np.full(len(pick), s)), ("pos", pos[pick]), ("mask", mask[pick]))}
        order = np.lexsort((-pool["g"], pool["doc"]))
        pool = {x: y[order] for x, y in pool.items()}
        first = np.flatnonzero(np.r_[True, pool["doc"][1:] != pool["doc"][:-1]]) if len(order) else np.zeros(0, int)
        following = np.full(n, -np.inf)
        following[pool["doc"][first]] = pool["g"][first]
        if s == k - 1:
            break
        # the best bound of each text becomes its next path
        best = {x: y[first] for x, y in pool.items()}
        keep = np.ones(len(order), bool)
        keep[first] = False
        pool = {x: y[keep] for x, y in pool.items()}
        path = _branch(lat, samples, best, n, key, unit_at, kind, s + 1)
        new_from, out_mask, exists = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        new_from[best["doc"]], out_mask[best["doc"]], exists[best["doc"]] = best["pos"], best["mask"], True
        value = following
    return lat, samples, following


def _log(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(x.astype(np.float64))


def _least(a: np.ndarray, doc: np.ndarray, n: int, many: int) -> np.ndarray:
    """Positions of the `many` least finite values of each document; `doc` is in order."""
    out, a = [], a.copy()
    if not len(a):
        return np.zeros(0, int)
    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    size = np.diff(np.r_[begin, len(a)])
    for _ in range(many):
        low = np.minimum.reduceat(a, begin)
        hit = np.flatnonzero((a == np.repeat(low, size)) & np.isfinite(a))
        hit = hit[np.r_[True, doc[hit[1:]] != doc[hit[:-1]]]] if len(hit) else hit
        out.append(hit)
        a[hit] = np.inf
    return np.concatenate(out)


def _mixkey(keys: np.ndarray, seed: int) -> np.ndarray:
    return (keys.astype(np.uint64) ^ np.uint64(seed * 0x9E3779B1)) * np.uint64(0xD6E8FEB86659FD93)


def _rest(lat: Lattice, node: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Probability of the edges outside the masks; exactly 0 where none is left."""
    bits = (mask[:, None] >> np.arange(lat.prob.shape[1])) & 1
    return (lat.prob[node].astype(np.float64) * (bits == 0)).sum(1)


@dataclass
class _Paths:
    """Steps of all texts, in order: text, node, edge, log probability."""

    doc: np.ndarray
    node: np.ndarray
    edge: np.ndarray
    logp: np.ndarray


def _branch(lat: Lattice, samples: list[Sample], pick: dict, n: int, key: np.ndarray, unit_at: np.ndarray, kind: np.ndarray, s: int) -> _Paths:
    """New paths: the parent's steps up to the bound, another edge there, fresh steps after it."""
    doc, pos = pick["doc"], pick["pos"]
    heads, node_at = [], np.zeros(len(doc), np.int64)
    for q, smp in enumerate(samples):
        mine = np.flatnonzero(pick["sample"] == q)
        lo = smp.at[doc[mine]]
        idx = _ranges(lo, pos[mine])
        heads.append((np.repeat(doc[mine], pos[mine]), smp.node[idx], smp.edge[idx], smp.logp[idx]))
        node_at[mine] = smp.node[lo + pos[mine]]
    hd, hn, he, hl = (np.concatenate(x) for x in zip(*heads, strict=True))
    done = np.bincount(hd, lat.is_end[hn + he + 1], n).astype(np.int64)[doc]  # units that the parent's steps complete
    open_ = lat.prob[node_at].astype(np.float64) * (((pick["mask"][:, None] >> np.arange(lat.prob.shape[1])) & 1) == 0)
    cum = np.cumsum(open_, 1)
    u = _uniform(key[doc], np.full(len(doc), (1 << 42) + s), pos)
    edge = np.minimum((cum <= (u * cum[:, -1])[:, None]).sum(1), open_.shape[1] - 1)
    # the rest of that unit, then the units behind it
    unit = unit_at[doc] + done
    behind = unit_at[doc + 1] - unit
    rows = _ranges(unit, behind)
    rdoc = np.repeat(doc, behind)
    start, end = lat.start[kind[rows]], lat.end[kind[rows]]
    start[np.r_[0, np.cumsum(behind)][:-1]] = node_at + edge + 1
    r, node, e = _walk(lat, start, end, key[rdoc], rows - unit_at[rdoc], np.full(len(rows), s))
    d = np.concatenate([hd, doc, rdoc[r]])
    order = np.argsort(d, kind="stable")
    tail = _log(lat.prob[np.r_[node_at, node], np.r_[edge, e]])
    return _Paths(d[order], np.concatenate([hn, node_at, node])[order], np.concatenate([he, edge, e])[order], np.concatenate([hl, tail])[order])


def piece_ids(lat: Lattice, node: np.ndarray, edge: np.ndarray, at: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the steps, characters without a piece spelt in bytes; and the bounds of each text."""
    ids = lat.piece[node, edge].astype(np.int64)
    spelt = np.flatnonzero(ids == -2)
    if not len(spelt):
        return ids, at
    many = np.ones(len(ids), np.int64)
    raw = [chr(int(ch)).encode("utf-8", "surrogatepass") for ch in lat.points[node[spelt]]]
    many[spelt] = [len(b) for b in raw]
    out = np.repeat(ids, many)
    begin = np.r_[0, np.cumsum(many)]
    out[_ranges(begin[spelt], many[spelt])] = v.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    return out, begin[at]


def decode(ids: list[int], v: Vocabulary) -> str:
    """The text of piece ids; the space that begins every text is dropped."""
    b = b"".join(map(v.bytes.__getitem__, ids))
    return b[1:].decode("utf-8", "surrogatepass")


_OUT = "doc_id long, pieces array<array<int>>, log_prob array<double>, inclusion array<double>"


def inclusion(log_prob: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Probability that a sample's perturbed value exceeds the k+1-st: 1 where all segmentations were emitted."""
    return np.where(np.isneginf(following), 1.0, -np.expm1(-np.exp(np.minimum(log_prob - following, 700))))


def encode_texts(texts: list[str], keys: np.ndarray, c: Config = Config()) -> list[tuple[list[np.ndarray], list[float], list[float]]]:
    """For each text: piece ids, log probability and inclusion score of its samples. An empty text has one, empty, sample."""
    v = vocabulary(c.model, c.alpha)
    out: list[tuple[list, list, list]] = [([], [], []) if t else ([np.zeros(0, np.int64)], [0.0], [1.0]) for t in texts]
    lat, samples, following = sample_slice(texts, keys, store(c.model, c.alpha), c.samples, c.seed)
    for smp in samples:
        ids, at = piece_ids(lat, smp.node, smp.edge, smp.at, v)
        score = inclusion(smp.log_prob, following)
        for i in np.flatnonzero(smp.exists).tolist():
            out[i][0].append(ids[at[i] : at[i + 1]])
            out[i][1].append(float(smp.log_prob[i]))
            out[i][2].append(float(score[i]))
    return out


def _run(part: pa.RecordBatch, c: Config):
    ids = part.column(0).to_numpy(zero_copy_only=False) if part.column(0).null_count == 0 else np.array([-1 if x is None else x for x in part.column(0).to_pylist()])
    texts = texts_of(part)
    return texts, encode_texts(texts, ids.astype(np.int64), c)


def encode(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """doc_id, pieces (up to `samples` distinct segmentations, by falling perturbed value), log_prob, inclusion.

    Null and empty texts give one empty segmentation with probability 1; a text with fewer segmentations gives all of
    them. The row key is the doc_id (null: -1), so repeated rows repeat their samples. Other columns are ignored.
    """

    def run(part: pa.RecordBatch) -> dict:
        _, got = _run(part, c)
        return {"doc_id": part.column(0), "pieces": _nested([x[0] for x in got]), "log_prob": [x[1] for x in got], "inclusion": [x[2] for x in got]}

    return _sliced(docs, run, _OUT)


def _nested(samples: list[list[np.ndarray]]) -> pa.Array:
    """Lists of lists of ids, without a Python object for each id."""
    flat = [p for x in samples for p in x]
    inner = pa.array(np.r_[0, np.cumsum([len(p) for p in flat])].astype(np.int32))
    outer = pa.array(np.r_[0, np.cumsum([len(x) for x in samples])].astype(np.int32))
    ids = pa.array(np.concatenate(flat).astype(np.int32) if flat else np.zeros(0, np.int32))
    return pa.ListArray.from_arrays(outer, pa.ListArray.from_arrays(inner, ids))


def _sliced(docs: DataFrame, run, schema: str) -> DataFrame:
    return per_slice(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema, limit=SLICE)


def spelt(ids: np.ndarray, v: Vocabulary) -> pa.Buffer:
    """The bytes of piece ids, with the space that begins every text."""
    return v.table.take(pa.array(ids)).buffers()[2]


def round_trip(samples: list[np.ndarray], text: str, v: Vocabulary) -> bool:
    """Whether every sample decodes to the text."""
    want = pa.py_buffer(b" " + text.encode("utf-8", "surrogatepass"))
    return all(spelt(p, v).equals(want) if len(p) else not text for p in samples)


def query(docs: DataFrame, c: Config = Config()) -> DataFrame:
    """op9: of each text's samples, sizes, log probabilities, inclusion scores and a digest of the ids; and whether all of them are
    distinct and decode to the text."""

    def run(part: pa.RecordBatch) -> dict:
        v = vocabulary(c.model, c.alpha)
        texts, got = _run(part, c)
        digest = [[hashlib.sha256(p.astype("<i4").tobytes()).hexdigest() for p in x[0]] for x in got]
        exact = [round_trip(x[0], t, v) and len(set(d)) == len(d) for x, t, d in zip(got, texts, digest, strict=True)]
        return {"doc_id": part.column(0), "n_pieces": [[len(p) for p in x[0]] for x in got], "log_prob": [x[1] for x in got], "inclusion": [x[2] for x in got], "ids_sha256": digest, "round_trip": exact}

    return _sliced(docs, run, "doc_id long, n_pieces array<int>, log_prob array<double>, inclusion array<double>, ids_sha256 array<string>, round_trip boolean")
