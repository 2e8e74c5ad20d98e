"""Benchmark decontamination by template canonicalisation.

Words are lower-cased and stripped of marks; numbers, units after a number and names (title case inside a sentence) become
typed placeholders. Windows of template words are hash-joined with those of the benchmark. A hit counts if the values in
its slots map one to one onto the item's; an item whose words such hits cover makes a document contaminated, also
when every number and name in the question was replaced. A window with fewer than `WORDS` real words would be met by any table of
numbers: it is known by its values instead. An item too short for a window counts where a line holds exactly its words.
"""

from __future__ import annotations

import string
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_slice, settle_table, texts_of

#: Bytes of text whose words' arrays are held at once: a quarter of the common slice takes no more time.
SLICE = 1 << 19
# Unit words that form a slot after a number.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg lb oz ml l s sec ms min h hr hours hour minutes seconds days weeks months years percent dollars euros pounds cents miles meters metres kilometers kilometres grams kilograms liters litres degrees mph kmh usd eur".split())
MARKS = string.punctuation + "«»“”‘’„…–—¿¡·"
WORD, NUMBER, UNIT, NAME = range(4)
TITLE, ENDS, NUMERIC, UNIT_WORD = 1, 2, 4, 8
#: Real words that a window needs to be known by its template.
WORDS = 2
_SLOT = np.array([0, 0x51ED270B0A1B5A3D, 0x6C62272E07BB0142, 0x27D4EB2F165667C5], np.uint64)
_MULT = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Config:
    """`window` template words make a window; items with fewer use all of theirs, down to `least`; items below that are compared
    with lines. `broadcast_windows` bounds the rows of benchmark windows that travel to the tasks; a larger benchmark is joined
    by a shuffle."""

    window: int = 8
    least: int = 4
    share: float = 0.5
    run: int = 20
    broadcast_windows: int = 2_000_000


class Words(dict):
    """Raw word -> number, filled as words come; the attributes of each number stand in arrays."""

    LIMIT = 100_000

    def __init__(self) -> None:
        super().__init__()
        self.hash, self.flag = array("Q"), array("B")

    def __missing__(self, raw: str) -> int:
        word = raw.strip(MARKS)
        low = word.lower()
        flag = 0
        if word and word[0].isdigit() and not any(ch.isalpha() for ch in word):
            flag |= NUMERIC
        if len(word) > 1 and word[0].isupper() and word[1:].islower():
            flag |= TITLE
        if low in UNITS:
            flag |= UNIT_WORD
        if raw.rstrip("\"')]»”’")[-1:] in ".!?:":
            flag |= ENDS
        self.hash.append(xxhash.xxh64_intdigest(low, 1) | 1 if word else 0)
        self.flag.append(flag)
        self[raw] = len(self.hash) - 1
        return self[raw]

    def trim(self) -> None:
        if len(self) > self.LIMIT:
            self.clear()
            self.hash, self.flag = array("Q"), array("B")


def canonical(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all template words of the texts: template hash, kind of slot, value hash, text number."""
    words.trim()
    get, ids, count = words.__getitem__, [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        split = t.split()
        count[i] = len(split)
        ids.extend(map(get, split))
    number = np.array(ids, np.int64)
    value, flag = np.frombuffer(words.hash, np.uint64)[number], np.frombuffer(words.flag, np.uint8)[number]
    of = np.repeat(np.arange(len(texts)), count)
    real = value != 0
    # a mark on its own may end a sentence: carry that over to the next word
    ended = np.r_[True, (flag[:-1] & ENDS) > 0] if len(flag) else np.zeros(0, bool)
    value, flag, of, ended = value[real], flag[real], of[real], ended[real]
    first = np.r_[True, of[1:] != of[:-1]] if len(of) else np.zeros(0, bool)
    numeric = (flag & NUMERIC) > 0
    unit = ((flag & UNIT_WORD) > 0) & np.r_[False, numeric[:-1]] & ~first if len(of) else first
    name = ((flag & TITLE) > 0) & ~first & ~ended
    kind = np.where(numeric, NUMBER, np.where(unit, UNIT, np.where(name, NAME, WORD)))
    return np.where(kind == WORD, value, _SLOT[kind]), kind, value, of


def window_hashes(h: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and begin of every window of `size` words within one text."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total = total * _MULT + h[j : j + n]
    at = np.flatnonzero(of[:n] == of[size - 1 :])
    total = total[at] ^ (total[at] >> np.uint64(31))
    return total * _MULT, at


def _sizes(c: Config) -> list[int]:
    return list(range(c.least, c.window + 1))


def _windows(c: Config, wanted: dict[int, np.ndarray] | None, all_sizes: bool):
    """A function of a slice: for each text its windows (only wanted ones, if given)."""
    bits = {}
    for size, keys in (wanted or {}).items():
        bits[size] = np.zeros(1 << 20, bool)
        bits[size][(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    words = Words()

    def run(texts: list[str]) -> tuple[list[list[dict]], np.ndarray]:
        h, kind, value, of = canonical(texts, words)
        begin = np.searchsorted(of, np.arange(len(texts)))
        total = np.bincount(of, minlength=len(texts))
        out: list[list[dict]] = [[] for _ in texts]
        for size in _sizes(c):
            if wanted is not None and size not in wanted:
                continue
            key, at = window_hashes(h, of, size)
            if len(at):
                real = np.r_[0, np.cumsum(kind == WORD)]
                poor = real[at + size] - real[at] < min(WORDS, size)
                if poor.any():
                    plain, _ = window_hashes(value, of, size)
                    key = np.where(poor, ~plain, key)
            if wanted is not None:
                some = np.flatnonzero(bits[size][(key & np.uint64((1 << 20) - 1)).astype(np.int64)])
                some = some[np.isin(key[some], wanted[size])]
                key, at = key[some], at[some]
            elif all_sizes is False:  # of benchmark items: the window, or all of a shorter item
                some = np.flatnonzero((size == c.window) | (total[of[at]] == size))
                key, at = key[some], at[some]
            for k, p in zip(key.view(np.int64).tolist(), at.tolist(), strict=True):
                slot = value[p : p + size][kind[p : p + size] != WORD].view(np.int64).tolist()
                out[of[p]].append({"key": k, "size": size, "at": int(p - begin[of[p]]), "slots": slot})
        return out, total

    return run


_WINDOWS = "array<struct<key:long,size:int,at:int,slots:array<long>>>"


def item_windows(benchmark: DataFrame, c: Config = Config()) -> DataFrame:
    """item_id, words, then key, size, at, slots of each of the item's windows."""
    run_of = _windows(c, None, False)

    def run(part: pa.RecordBatch) -> dict:
        hits, total = run_of(texts_of(part))
        return {"item_id": part.column(0), "words": total, "w": hits}

    got = per_slice(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), run, f"item_id long, words int, w {_WINDOWS}")
    return got.select("item_id", "words", F.inline("w"))


#: The size that marks the key of a whole short line.
LINE = 0


def _line_key(words: list[str]) -> int | None:
    """A hash of the words of a line without marks; None without any."""
    low = [w for w in (x.strip(MARKS).lower() for x in words) if w]
    return xxhash.xxh64_intdigest(" ".join(low), 3) - (1 << 63) if low else None


def short_items(benchmark: DataFrame, c: Config = Config()) -> DataFrame:
    """item_id, key, words of the items with fewer than `least` words, but for those without any."""

    def run(part: pa.RecordBatch) -> dict:
        split = [t.split() for t in texts_of(part)]
        keys = [_line_key(x) for x in split]
        count = [sum(bool(w.strip(MARKS)) for w in x) for x in split]
        return {"item_id": part.column(0), "key": pa.array([k if n < c.least else None for k, n in zip(keys, count, strict=True)], pa.int64()), "words": count}

    return per_slice(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), run, "item_id long, key long, words int").where("key is not null")


def one_to_one(pairs: list[tuple[list[int], list[int]]]) -> list[bool]:
    """Which hits keep the slot values a bijection, in order: a hit that breaks it is left out."""
    there, back, out = {}, {}, []
    for a, b in pairs:
        # the hit itself must be one, and agree with those before it
        own = dict(zip(a, b, strict=False))
        ok = len(a) == len(b) and len(set(own.values())) == len(own) and all(own[x] == y and there.get(x, y) == y and back.get(y, x) == x for x, y in zip(a, b, strict=True))
        if ok:
            there.update(own)
            back.update((y, x) for x, y in own.items())
        out.append(ok)
    return out


BAND = 5


def judge(hits: list[dict], c: Config) -> tuple[float, int, bool]:
    """Of the hits of one item in one text: the best share of its words that consistent hits on one diagonal band cover, the
    longest run of them, and whether a slot value differs from the item's. A hit is in BAND + 1 bands at most."""
    by: dict[int, list[dict]] = {}
    for x in hits:
        by.setdefault(x["at"] - x["item_at"], []).append(x)
    best, longest, changed = 0.0, 0, False
    for d in sorted(by):
        band = [x for e in range(d, d + BAND + 1) for x in by.get(e, ())]  # a few words put in or left out move the diagonal
        band.sort(key=lambda x: (x["item_at"], x["at"], x["size"]))
        ok = one_to_one([(x["item_slots"], x["slots"]) for x in band])
        cover = np.zeros(band[0]["words"], bool)
        for x, fine in zip(band, ok, strict=True):
            if fine:
                cover[x["item_at"] : x["item_at"] + x["size"]] = True
        edge = np.flatnonzero(np.diff(np.r_[0, cover.astype(np.int8), 0]))
        run = int((edge[1::2] - edge[::2]).max()) if len(edge) else 0
        if cover.mean() > best or run > longest:
            changed = any(x["item_slots"] != x["slots"] for x, fine in zip(band, ok, strict=True) if fine)
        best, longest = max(best, float(cover.mean())), max(longest, run)
    return best, longest, changed


def _key():
    """A row's id and text in 128 bits: rows that share an id, or have none, are judged each by its own text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))))).alias("__key")


def found(docs: DataFrame, benchmark: DataFrame, c: Config = Config()) -> DataFrame:
    """__key, doc_id, item_id, share, run, changed: documents with an item's template.

    A document is named once for each item, rows of one id and text together. Null and empty texts and items without a word
    match nothing; repeated items are found each by its id, one without an id contaminates but is not named; empty tables give no row.
    """
    items, lines = settle_table(item_windows(benchmark, c)), settle_table(short_items(benchmark, c))
    small = items.limit(c.broadcast_windows + 1).count() + lines.limit(c.broadcast_windows + 1).count() <= c.broadcast_windows
    any_line = not lines.isEmpty()
    wanted = wanted_lines = None
    if small:
        known = items.select("size", "key").distinct().toArrow()  # at most `broadcast_windows` rows
        size, keys = known.column("size").to_numpy(), known.column("key").to_numpy().astype(np.int64).view(np.uint64)
        wanted = {int(s): np.sort(keys[size == s]) for s in np.unique(size)}
        wanted_lines = frozenset(lines.select("key").distinct().toArrow().column("key").to_pylist())
    run_of = _windows(c, wanted, True)

    def run(part: pa.RecordBatch) -> dict:
        texts = texts_of(part)
        hits, _ = run_of(texts)
        if any_line:
            for t, mine in zip(texts, hits, strict=True):
                keys = {_line_key(w) for w in map(str.split, t.split("\n")) if w}
                mine += [{"key": k, "size": LINE, "at": 0, "slots": []} for k in sorted(keys - {None}) if wanted_lines is None or k in wanted_lines]
        return {"__key": part.column(0), "doc_id": part.column(1), "w": hits}

    hits = per_slice(docs.select(_key(), F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"__key binary, doc_id long, w {_WINDOWS}", limit=SLICE)
    hits = hits.where(F.size("w") > 0).select("__key", "doc_id", F.inline("w"))
    right = items.select("item_id", "words", "key", "size", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    none = F.array().cast("array<long>")
    right = right.unionByName(lines.select("item_id", "words", "key", F.lit(LINE).alias("size"), F.lit(0).alias("item_at"), none.alias("item_slots")))
    if small:
        right = F.broadcast(right)  # at most `broadcast_windows` rows
    pairs = hits.join(right, ["key", "size"]).groupBy("__key", "doc_id", "item_id").agg(F.collect_set(F.struct("at", "size", "slots", "item_at", "item_slots", "words")).alias("hits"))

    def decide(part: pa.RecordBatch) -> dict:
        got = [(1.0, x[0]["words"], False) if x[0]["size"] == LINE else judge(x, c) for x in part.column(3).to_pylist()]
        return {"__key": part.column(0), "doc_id": part.column(1), "item_id": part.column(2), "share": [x[0] for x in got], "run": [x[1] for x in got], "changed": [x[2] for x in got]}

    out = per_slice(pairs, decide, "__key binary, doc_id long, item_id long, share double, run int, changed boolean", text="")
    return out.where((F.col("share") >= c.share) | (F.col("run") >= c.run))


def decontaminate(docs: DataFrame, benchmark: DataFrame, c: Config = Config()) -> DataFrame:
    """The rows of `docs`, all columns, without contaminated ones.

    Rows are judged by their own texts, whatever their ids. Null and empty texts stay; repeated rows stay or go together; columns of
    any name are carried; an empty table gives none. The keys of contaminated rows are settled first: where their measured size
    is below Spark's broadcast threshold, no text is shuffled.
    """
    bad = settle_table(found(docs, benchmark, c).select("__key").distinct())
    whole = docs.select(_key(), F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row"))
    return whole.join(bad, "__key", "left_anti").select("row.*")


def query(docs: DataFrame, benchmark: DataFrame, c: Config = Config()) -> DataFrame:
    """op4: doc_id, contaminated, items (sorted ids), share, changed; a row for each row of `docs`, as in `found`."""
    named = settle_table(found(docs, benchmark, c).groupBy("__key").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("share").alias("share"), F.bool_or("changed").alias("changed")))
    got = docs.select(_key(), F.col("doc_id").cast("long").alias("doc_id")).join(named, "__key", "left")
    none = F.array().cast("array<long>")
    return got.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", none).alias("items"), F.coalesce("share", F.lit(0.0)).alias("share"), F.coalesce("changed", F.lit(False)).alias("changed"))
