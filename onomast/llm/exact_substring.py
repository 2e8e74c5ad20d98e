"""Removal of repeated byte strings, with suffixes sorted by the deep-shallow method.

Every start of a `length`-byte string belongs to the least hash of the `GRAM`-byte strings inside it. Equal strings have
equal least hashes, so runs of starts that share one (segments) can be compared apart from all others:

1. each task finds segments and combines equal ones, byte for byte by a 128-bit hash, over `HELD` segments at a time: the
   starts of all but the first repeat, and only firsts are dealt out.
2. firsts are dealt out by least hash. Equal segments of different tasks meet: all but the first repeat. A least hash
   with one segment is settled; one with several different segments is contested.
3. contested segments fetch their bytes and are dealt out again. Their suffixes are sorted to `length` bytes: by
   words of 8 bytes (lexsort, in place of a multikey quicksort) to a shallow depth, then blind tries, all at once, for the groups that still
   agree. All but the first of
   equal strings repeat.
4. a least hash with more than `hot` different segments (a passage in many contexts) is split by whole strings instead:
   an aggregation keeps the first start of each string, combined before the shuffle.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_slice, release, settle_table, slices, small_batches

LENGTH, GRAM = 100, 40
#: Bytes of a text that are hashed at once, and starts that a segment may hold.
PIECE, RUN = 1 << 20, 4096
#: Segments that a task combines before they are dealt out.
HELD = 1 << 19
SHALLOW = 32
FIRST, REPEAT, CONTEST, HOT, LOOP = 0, 1, 2, 3, 4
#: A row is known by its doc_id and `th`, the XXH64 of its text: rows that share an id, or have none, stay apart.
_ROW = "kind int, m long, sh long, doc long, th long, lo int, n int"
_MULT = 0x9E3779B97F4A7C15 | 1
_MULT2 = 0xD6E8FEB86659FD93 | 1


def _powers(n: int, mult: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(mult, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, mult, np.uint64)], dtype=np.uint64)
        down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, np.uint64)], dtype=np.uint64)
    return up, down


_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _sums(data: np.ndarray, mult: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over the bytes, and what shifts a difference of them to exponent 0."""
    if mult not in _CACHE or len(_CACHE[mult][0]) <= len(data):
        _CACHE[mult] = _powers(max(len(data), PIECE), mult)
    up, down = _CACHE[mult]
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=s[1:])
    return s, down


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    size, low = 1, h
    while size * 2 <= width:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    return np.minimum(low[: len(h) - width + 1], low[width - size : len(h) - size + 1])


def segments(data: np.ndarray, valid: np.ndarray, owner: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of valid starts of one owner with one least hash: begin, size, least hash, content hash, may repeat itself."""
    s, down = _sums(data, _MULT)
    h = _mix((s[gram:] - s[:-gram]) * down[: len(data) - gram + 1])
    width = length - gram + 1
    m = _sliding_min(h, width)
    new = np.r_[True, (m[1:] != m[:-1]) | (valid[1:] != valid[:-1]) | (owner[1 : len(m)] != owner[: len(m) - 1])]
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, len(m)])
    # a segment can hold a string twice only where its least gram recurs within one window
    top = ~_sliding_min(~np.r_[np.zeros(width - 1, np.uint64), m, np.zeros(width - 1, np.uint64)], width)
    least = np.flatnonzero(h == top)
    pair = np.flatnonzero((h[least[1:]] == h[least[:-1]]) & (np.diff(least) <= width))
    near = np.zeros(len(m) + 1, np.int64)
    if len(pair):
        np.add.at(near, np.clip(least[pair] - 2 * width, 0, len(m)), 1)
        np.add.at(near, np.clip(least[pair] + 2 * width, 0, len(m)), -1)
    keep = valid[begin]
    begin, size = begin[keep], size[keep]
    if len(size) and size.max() > RUN:  # cut long runs
        parts = -(-size // RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.r_[0, np.cumsum(parts)][:-1], parts)
        begin, size = np.repeat(begin, parts) + nth * RUN, np.minimum(RUN, np.repeat(size, parts) - nth * RUN)
    end = begin + size + length - 1
    content = _mix((s[end] - s[begin]) * down[begin] + size.astype(np.uint64))
    loops = np.r_[0, np.cumsum(np.cumsum(near[:-1]) > 0)]
    return begin, size, m[begin], content, loops[begin + size] > loops[begin]


def _hash(b: bytes) -> int:
    """XXH64 with seed 42 as a signed number: what Spark's xxhash64 gives for the text."""
    h = xxhash.xxh64_intdigest(b, 42)
    return h - (1 << 64) if h >> 63 else h


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Lists of (doc_id, text hash, offset, bytes) that hold about PIECE starts; longer texts are cut with an overlap."""
    held, size = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            b = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if len(b) < length:
                continue
            d = doc.as_py()
            th = _hash(b)
            for at in range(0, len(b) - length + 1, PIECE):
                part = b[at : at + PIECE + length - 1]
                held.append(((1 << 63) - 1 if d is None else d, th, at, part))
                size += len(part)
                if size >= PIECE:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _segments_of(held: list[tuple[int, int, int, bytes]], length: int, gram: int) -> dict[str, np.ndarray]:
    """The segments of pieces: least and content hash, place, size, whether it may repeat itself."""
    ids = np.array([x[0] for x in held], np.int64)
    ths = np.array([x[1] for x in held], np.int64)
    offs = np.array([x[2] for x in held], np.int64)
    lens = np.array([len(x[3]) for x in held], np.int64)
    at = np.r_[0, np.cumsum(lens)]
    data = np.frombuffer(b"".join(x[3] for x in held), np.uint8)
    owner = np.repeat(np.arange(len(held), dtype=np.int32), lens)
    starts = np.arange(len(data) - length + 1)
    valid = starts + length <= at[1:][owner[: len(starts)]]
    begin, size, m, content, loop = segments(data, valid, owner, length, gram)
    who = owner[begin]
    return {"m": m, "sh": content, "doc": ids[who], "th": ths[who], "lo": (offs[who] + begin - at[who]).astype(np.int32), "n": size.astype(np.int32), "loop": loop}


def _combined(c: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Equal segments as one first, at the least (doc, lo), and repeats; one at the very same place (a repeated row) is not earlier: it
    is the same first, and goes. Neighbouring repeats of a text become one row; their `m` only spreads them."""
    key = _mix(c["m"] ^ (c["sh"] << np.uint64(1)))
    order = np.argsort(key, kind="stable")
    meets = key[order][1:] == key[order][:-1]
    shared = np.r_[meets, False] | np.r_[False, meets] if len(order) else np.zeros(0, bool)
    alone = {k: v[order[~shared]] for k, v in c.items()}
    c = {k: v[order[shared]] for k, v in c.items()}
    order = np.lexsort((c["th"], c["lo"], c["doc"], c["n"], c["sh"], c["m"]))
    c = {k: v[order] for k, v in c.items()}
    twice = same_rows(c, ("m", "sh", "n", "doc", "lo", "th"))
    c = {k: v[~twice] for k, v in c.items()}
    new = ~same_rows(c, ("m", "sh", "n"))
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    again = (c["doc"] != c["doc"][head]) | (c["lo"] != c["lo"][head])
    first = {k: np.concatenate([v[~again], alone[k]]) for k, v in c.items()}
    r = {k: v[again] for k, v in c.items()}
    order = np.lexsort((r["lo"], r["th"], r["doc"]))
    r = {k: v[order] for k, v in r.items()}
    joins = np.zeros(len(order), bool)
    if len(order):
        joins[1:] = (r["doc"][1:] == r["doc"][:-1]) & (r["th"][1:] == r["th"][:-1]) & (r["lo"][:-1] + r["n"][:-1] == r["lo"][1:])
    top = np.flatnonzero(~joins)
    total = np.bincount(np.cumsum(~joins) - 1, r["n"], len(top)).astype(np.int32) if len(order) else np.zeros(0, np.int32)
    spread = _mix(r["th"].view(np.uint64)[top] + r["lo"][top].astype(np.uint64)).view(np.int64)
    rows = {
        "kind": np.r_[np.where(first["loop"], LOOP, FIRST), np.full(len(top), REPEAT)].astype(np.int32), "m": np.r_[first["m"].view(np.int64), spread],
        "sh": np.r_[first["sh"].view(np.int64), np.zeros(len(top), np.int64)], "doc": np.r_[first["doc"], r["doc"][top]], "th": np.r_[first["th"], r["th"][top]],
        "lo": np.r_[first["lo"], r["lo"][top]], "n": np.r_[first["n"], total],
    }
    return pa.RecordBatch.from_arrays([pa.array(x) for x in rows.values()], names=list(rows))


def same_rows(c: dict[str, np.ndarray], names: tuple[str, ...]) -> np.ndarray:
    """Whether a row has the same values as the one before it."""
    out = np.zeros(len(c[names[0]]), bool)
    if len(out):
        out[1:] = np.logical_and.reduce([c[k][1:] == c[k][:-1] for k in names])
    return out


def _find(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for pieces in _pieces(batches, length):
        held.append(_segments_of(pieces, length, gram))
        size += len(held[-1]["m"])
        if size >= HELD:
            yield _combined({k: np.concatenate([c[k] for c in held]) for k in held[0]})
            held, size = [], 0
    if held:
        yield _combined({k: np.concatenate([c[k] for c in held]) for k in held[0]})


def _columns(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray] | None:
    got = [b for b in batches if b.num_rows]
    if not got:
        return None
    return {n: np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in got]) for i, n in enumerate(got[0].schema.names)}


def _meet(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """Of one partition of segments: repeats as they are, later equal segments as repeats, contested ones."""
    c = _columns(batches)
    if c is None:
        return
    old = c["kind"] == REPEAT
    r = {k: v[~old] for k, v in c.items()}
    order = np.lexsort((r["th"], r["lo"], r["doc"], r["n"], r["sh"], r["m"]))
    r = {k: v[order] for k, v in r.items()}
    r = {k: v[~again] for again in [same_rows(r, ("m", "sh", "n", "doc", "lo", "th"))] for k, v in r.items()}  # repeated rows
    if len(r["m"]):
        new_m = ~same_rows(r, ("m",))
        new = ~same_rows(r, ("m", "sh", "n"))
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        kind = np.where((r["doc"] == r["doc"][head]) & (r["lo"] == r["lo"][head]), FIRST, REPEAT)
        gid = np.cumsum(new_m) - 1
        different = np.bincount(gid, new)[gid]
        kind = np.where((kind == FIRST) & (different > 1), np.where(different > hot, HOT, CONTEST), kind)
        kind = np.where((kind == FIRST) & (r["kind"] == LOOP), CONTEST, kind)
        keep = kind > 0
        r = {k: v[keep] for k, v in r.items()} | {"kind": kind[keep].astype(np.int32)}
    for part in ({k: v[old] for k, v in c.items()}, r):
        if len(part["kind"]):
            yield pa.RecordBatch.from_arrays([pa.array(part[n]) for n in ("kind", "m", "doc", "th", "lo", "n")], names=["kind", "m", "doc", "th", "lo", "n"])


def _cut(batches: Iterator[pa.RecordBatch], length: int, remember: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The contested segments of texts, with their bytes. Of hot ones, the first start of each string among the texts of a slice, by a
    128-bit hash: later ones cannot be the first of all. A row that came before, as far as the task remembers, is left out."""
    seen: set[tuple[int, int]] = set()
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    for batch in batches:
        for part in slices(batch, "text"):
            out: dict[str, list] = {k: [] for k in ("m", "h", "doc", "th", "lo", "n", "data")}
            hot: list[tuple[np.ndarray, ...]] = []
            for doc, th, text, at in zip(*(part.column(i) for i in range(4)), strict=True):
                row = (doc.as_py(), th.as_py())
                if row in seen:
                    continue
                if len(seen) >= remember:
                    seen.clear()
                seen.add(row)
                b = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for x in at.as_py():
                    lo, n = x["lo"], x["n"]
                    own = b[lo : lo + n + length - 1]
                    if x["kind"] == CONTEST:
                        for k, v in (("m", x["m"]), ("h", 0), ("doc", row[0]), ("th", row[1]), ("lo", lo), ("n", n), ("data", own)):
                            out[k].append(v)
                    else:
                        arr, h = np.frombuffer(own, np.uint8), []
                        for mult in (_MULT, _MULT2):
                            s, down = _sums(arr, mult)
                            h.append(_mix((s[length:] - s[:-length]) * down[:n]).view(np.int64))
                        hot.append((*h, np.full(n, row[0]), np.full(n, row[1]), np.arange(lo, lo + n)))
            if hot:
                c = dict(zip(("m", "h", "doc", "th", "lo"), (np.concatenate(x) for x in zip(*hot, strict=True)), strict=True))
                order = np.lexsort((c["th"], c["lo"], c["doc"], c["h"], c["m"]))
                c = {k: v[order] for k, v in c.items()}
                head = np.maximum.accumulate(np.where(~same_rows(c, ("m", "h")), np.arange(len(order)), 0))
                first = (c["doc"] == c["doc"][head]) & (c["lo"] == c["lo"][head])  # with ties of rows that share an id
                many = int(first.sum())
                yield pa.RecordBatch.from_arrays([*(pa.array(v[first], t) for v, t in zip(c.values(), types, strict=False)), pa.array(np.zeros(many, np.int32)), pa.nulls(many, pa.binary())], names=list(out))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))
    release()


class BlindTrie:
    """Equal strings among those inserted: a trie that stores only the places where strings part.

    A node is [depth, {byte: child}]; a leaf is the list of the starts whose strings are equal.
    """

    def __init__(self, data: bytes, length: int) -> None:
        self.data, self.length, self.root = data, length, None

    def insert(self, at: int) -> None:
        data, length = self.data, self.length
        if self.root is None:
            self.root = ([at],)
            return
        node = self.root
        while len(node) == 2:  # blind descent: unknown bytes lead to any child
            kids = node[1]
            node = kids.get(data[at + node[0]]) or next(iter(kids.values()))
        other = node[0][0]
        if data[at : at + length] == data[other : other + length]:
            node[0].append(at)
            return
        lo, hi = 0, length  # the first byte that differs
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if data[at : at + mid] == data[other : other + mid] else (lo, mid)
        parent, node = None, self.root
        while len(node) == 2 and node[0] < lo:
            parent, node = node, node[1][data[at + node[0]]]
        if len(node) == 2 and node[0] == lo:
            node[1][data[at + lo]] = ([at],)
            return
        fork = (lo, {data[other + lo]: node, data[at + lo]: ([at],)})
        if parent is None:
            self.root = fork
        else:
            parent[1][data[at + parent[0]]] = fork

    def leaves(self) -> Iterator[list[int]]:
        """Groups of equal strings, in the order of the strings."""
        todo = [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if len(node) == 1:
                yield node[0]
            else:
                todo.extend(node[1][k] for k in sorted(node[1], reverse=True))


def blind_tries(data: bytes, word: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts whose `length`-byte strings equal another one's, and the class of each, among those of a group, which agree to `depth`.

    The blind tries of all groups are built at once. The first string of a group is a path; each other one is compared with it up to the
    place where they part, and hangs there under its own byte. What hangs under one byte of one place is a group of the next round.
    `word` has the 8 bytes from every place; `at` is ordered by group.
    """
    arr = np.frombuffer(data, np.uint8)
    depth = np.full(len(at), depth, np.int64)
    found, names, made = [], [], 0
    while len(at):
        new = np.r_[True, group[1:] != group[:-1]]
        nth = np.cumsum(new) - 1
        path = at[np.flatnonzero(new)[nth]]
        part = np.full(len(at), length, np.int64)  # where each string parts from the path of its group
        open_ = np.flatnonzero(~new)
        while len(open_):
            x = word[at[open_] + depth[open_]] ^ word[path[open_] + depth[open_]]
            differ = np.flatnonzero(x)
            x, i = x[differ], open_[differ]
            same = sum((x < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8))
            part[i] = np.minimum(depth[i] + same, length)
            open_ = np.delete(open_, differ)
            depth[open_] += 8
            open_ = open_[depth[open_] < length]
        equal = part == length
        several = np.bincount(nth, equal)[nth] > 1
        found.append(at[equal & several])
        names.append(nth[equal & several] + made)
        made += int(nth[-1]) + 1
        rest = np.flatnonzero(~equal)
        at, part = at[rest], part[rest]
        key = (nth[rest] * length + part) * 256 + arr[at + part]
        order = np.argsort(key)
        at, depth, group = at[order], part[order] + 1, key[order]
        meets = group[1:] == group[:-1]
        keep = np.r_[meets, False] | np.r_[False, meets] if len(at) else np.zeros(0, bool)
        at, depth, group = at[keep], depth[keep], group[keep]
    none = np.zeros(0, np.int64)
    return (np.concatenate(found), np.concatenate(names)) if found else (none, none)


def deep_shallow(data: bytes, at: np.ndarray, group: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Starts whose `length`-byte strings equal those of other starts of the same group, and the class of each.

    Lexsort on words of 8 bytes, in place of a multikey quicksort, all groups in one pass, down to `shallow` bytes; then a blind trie for
    each group that is left.
    """
    arr = np.frombuffer(data + b"\0" * 8, np.uint8)
    word = np.zeros(len(data) + 1, np.uint64)
    for j in range(8):
        word = (word << np.uint64(8)) | arr[j : j + len(word)]
    deep = 0
    for depth in range(0, min(shallow, length - 7), 8):
        deep = depth + 8
        w = word[at + depth]
        order = np.lexsort((w, group))
        at, group, w = at[order], group[order], w[order]
        new = np.r_[True, (group[1:] != group[:-1]) | (w[1:] != w[:-1])] if len(at) else np.zeros(0, bool)
        group = np.cumsum(new)
        alone = np.bincount(group)[group] == 1 if len(at) else new
        at, group = at[~alone], group[~alone]
    return blind_tries(data, word, at, group, deep, length)


def _sort(batches: Iterator[pa.RecordBatch], length: int, bound: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Repeats among contested segments of one partition, in blocks of whole groups of about `bound` bytes."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    table = pa.Table.from_batches(got)
    cols = {n: table.column(n).to_numpy() for n in ("m", "doc", "th", "lo", "n")}
    order = np.lexsort((cols["lo"], cols["doc"], cols["m"]))
    cols = {k: v[order] for k, v in cols.items()}
    data = table.column("data")
    size = cols["n"].astype(np.int64) + length - 1
    block = np.cumsum(size) // bound
    new_m = np.r_[True, cols["m"][1:] != cols["m"][:-1]]
    first_of = np.maximum.accumulate(np.where(new_m, np.arange(len(order)), 0))
    block = block[first_of]  # a group stays whole
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
        c = {k: v[lo:hi] for k, v in cols.items()}
        text = b"".join(data.take(pa.array(order[lo:hi])).to_pylist())
        begin = np.r_[0, np.cumsum(size[lo:hi])][:-1]
        n = c["n"].astype(np.int64)
        seg = np.repeat(np.arange(hi - lo), n)
        nth = np.arange(len(seg)) - np.repeat(np.r_[0, np.cumsum(n)][:-1], n)
        at = begin[seg] + nth
        gid = np.cumsum(new_m[lo:hi])[seg]
        owner = np.zeros(len(text), np.int32)
        owner[at] = seg
        at, name = deep_shallow(text, at, gid, length)
        if not len(at):
            continue
        o = owner[at]
        d, p = c["doc"][o], c["lo"][o] + (at - begin[o])
        order_ = np.lexsort((p, d, name))
        at, name, d, p = at[order_], name[order_], d[order_], p[order_]
        top = np.maximum.accumulate(np.where(np.r_[True, name[1:] != name[:-1]], np.arange(len(at)), 0))
        marks = np.sort(at[(d != d[top]) | (p != p[top])])
        if not len(marks):
            continue
        new = np.r_[True, (np.diff(marks) != 1) | (owner[marks[1:]] != owner[marks[:-1]])]
        top = np.flatnonzero(new)
        run = np.diff(np.r_[top, len(marks)])
        o = owner[marks[top]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(top), REPEAT, np.int32)), pa.array(c["doc"][o]), pa.array(c["th"][o]), pa.array((c["lo"][o] + marks[top] - begin[o]).astype(np.int32)), pa.array(run.astype(np.int32))],
            names=["kind", "doc", "th", "lo", "n"],
        )
    del table, got, data, cols
    release()


def covered(size: int, starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under strings that begin in any of the (start, count) runs."""
    out: list[list[int]] = []
    for lo, n in sorted(starts):
        hi = min(lo + n - 1 + length, size)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _starts(events: list[dict]) -> list[tuple[int, int]]:
    """Runs of repeated starts of a text: repeats, and hot runs without the starts that were first of their string."""
    out = [(x["lo"], x["n"]) for x in events if x["kind"] == REPEAT]
    first = sorted({x["lo"] for x in events if x["kind"] == FIRST})
    for x in events:
        if x["kind"] == HOT:
            at, end = x["lo"], x["lo"] + x["n"]
            for f in first[bisect.bisect_left(first, at) : bisect.bisect_left(first, end)]:
                if f > at:
                    out.append((at, f - at))
                at = f + 1
            if at < end:
                out.append((at, end - at))
    return out


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = 1024) -> DataFrame:
    """doc_id, text, spans (array of begin, end in bytes: what repeats) of every row of `docs`.

    Order is by (doc_id, start); a null doc_id comes last. Rows that share a doc_id, or have none, are told apart by a 64-bit hash
    of their text; a string at the same id and start as another is not earlier, so fully repeated rows keep what either one
    keeps. Null is empty; texts under `length` bytes have no span. Other columns are ignored; an empty table gives none.

    Rows meet their events by id and text hash, and equal events are combined before they move: many rows of one id, or none,
    are as many keys, and copies of one row share one list of events.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = base.mapInArrow(lambda it: _find(it, length, gram), _ROW)
    met = settle_table(found.repartition("m").mapInArrow(lambda it: _meet(it, hot), "kind int, m long, doc long, th long, lo int, n int"))
    keyed = base.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("th"), "doc_id", "text")
    open_ = met.where(F.col("kind") >= CONTEST).groupBy("doc", "th").agg(F.collect_set(F.struct("kind", "m", "lo", "n")).alias("at"))
    small_batches(docs.sparkSession)
    bytes_ = settle_table(keyed.join(open_, ["doc", "th"]).select("doc", "th", "text", "at").mapInArrow(lambda it: _cut(it, length), "m long, h long, doc long, th long, lo int, n int, data binary"))
    sorted_ = bytes_.where("data is not null").repartition("m").mapInArrow(lambda it: _sort(it, length), "kind int, doc long, th long, lo int, n int")
    firsts = bytes_.where("data is null").groupBy("m", "h").agg(F.min(F.struct("doc", "lo")).alias("x"))
    # a string that begins at one place of several rows of an id is first in each of them
    firsts = bytes_.where("data is null").select("m", "h", "doc", "lo", "th").join(firsts, ["m", "h"]).where("doc = x.doc and lo = x.lo").select(F.lit(FIRST).alias("kind"), "doc", "th", "lo", F.lit(1).alias("n"))
    same = ["kind", "doc", "th", "lo", "n"]
    events = met.where(F.col("kind") != CONTEST).select(*same).unionByName(sorted_).unionByName(firsts.select(*same))
    of = events.groupBy("doc", "th").agg(F.collect_set(F.struct("kind", "lo", "n")).alias("at"))
    joined = keyed.join(of, ["doc", "th"], "left").select("doc_id", "text", "at")

    def run(part: pa.RecordBatch) -> dict:
        spans = []
        for text, at in zip(part.column(1), part.column(2), strict=True):
            if not at.is_valid:
                spans.append([])
                continue
            b = (text.as_py() or "").encode("utf-8", "surrogatepass")
            spans.append([{"begin": x, "end": y} for x, y in covered(len(b), _starts(at.as_py()), length)])
        return {"doc_id": part.column(0), "text": part.column(1), "spans": spans}

    return per_slice(joined, run, "doc_id long, text string, spans array<struct<begin:long,end:long>>")


def remove(b: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for lo, hi in spans:
        out.append(b[at:lo])
        at = hi
    return b"".join([*out, b[at:]])


def query(docs: DataFrame) -> DataFrame:
    """op3: the contract's columns. Nulls, ties and repeated rows as in `repeats`."""

    def run(part: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for text, spans in zip(part.column(1), part.column(2), strict=True):
            b = (text.as_py() or "").encode("utf-8", "surrogatepass")
            cut = [(x["begin"], x["end"]) for x in spans.as_py()]
            out["n_bytes"].append(len(b))
            out["n_removed"].append(sum(y - x for x, y in cut))
            out["n_spans"].append(len(cut))
            out["kept_sha256"].append(hashlib.sha256(remove(b, cut)).hexdigest())
        return out | {"doc_id": part.column(0)}

    return per_slice(repeats(docs), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
