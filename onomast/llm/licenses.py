"""License scans with native expressions: MinHash bands over text windows retrieve templates, exact containment verifies.

A text becomes words (letters and digits, lower case) and hashes of its 3-word shingles. Windows of several sizes, each overlapping
the next by half, cover it. Every window has `bands` MinHash bands of `rows` values, and each band is looked up in a hash index
of the bands of all templates' windows; the templates found there, and no others, are candidates. A candidate counts if the text around
the window holds at least `share` of its shingles exactly. Of templates found at one place the one with the largest share stays.

A template uses the largest window size of which it holds one and a half, so an exact copy holds a whole window at any offset; the index
has the template's windows at every offset, so that window is met for certain. A window of similarity s is met with probability
1 - (1 - s^rows)^bands: at the defaults 0.998 at 0.8 and 0.97 at 0.6; a copy has several.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import TEMPLATES

SHINGLE = 3
#: Slots of the band index.
SLOTS = 4096


@dataclass(frozen=True)
class Config:
    """`sizes` are window sizes in shingles, the first for templates too short for the others. `most_templates` bounds the library, whose
    band index travels as one constant."""

    sizes: tuple[int, ...] = (1, 6, 24)
    bands: int = 4
    rows: int = 1
    share: float = 0.8
    most_templates: int = 500


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once: a projection may be merged into the next one and evaluated for every element
    of a lambda there, a lambda's argument is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Hashes of the 3-word shingles; fewer words have none."""

    def of(w: Column) -> Column:
        hashed = lambda: F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))
        return F.when(F.size(w) >= SHINGLE, hashed()).otherwise(F.array().cast("array<bigint>"))

    return let(words, of)


def _pivot(k: int) -> int:
    """The k-th of fixed 64-bit numbers, as a signed one."""
    x = (k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 % (1 << 64)
    x ^= x >> 29
    return x - (1 << 64) if x >> 63 else x


def bands_of(window: Column, size: int, c: Config) -> Column:
    """The band hashes of a window: each of `rows` minima, a minimum being the hash nearest to a fixed number. One shingle is one band."""
    if size == 1:
        return F.array(F.xxhash64(F.lit(-1), F.get(window, F.lit(0))))
    least = lambda k: F.array_min(F.transform(window, lambda h: h.bitwiseXOR(F.lit(_pivot(k)))))
    return F.array(*[F.xxhash64(F.lit(size), F.lit(b), *[least(b * c.rows + r) for r in range(c.rows)]) for b in range(c.bands)])


def window_size(n: int, c: Config) -> int:
    """The window size of a template of n shingles."""
    return max((s for s in c.sizes if 2 * n >= 3 * s - 2), default=min(c.sizes))


def _windows(h: Column, size: int, step: int, c: Config) -> Column:
    """The bands of the windows of one size, one after the other."""
    starts = F.when(F.size(h) >= size, F.sequence(F.lit(0), F.size(h) - size, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: let(F.slice(h, i + 1, F.lit(size)), lambda w: bands_of(w, size, c)))


def library(spark: SparkSession, templates: dict[str, str], c: Config) -> tuple[list[dict], list[list[dict]]]:
    """For each template name, shingles and window size; and the band index: for each slot, pairs of band and template number."""
    if len(templates) > c.most_templates:
        raise ValueError(f"more than {c.most_templates} templates")
    df = spark.createDataFrame(sorted(templates.items()), "name string, text string").select("name", shingles_of(words_of(F.col("text"))).alias("h")).where("size(h) > 0")
    rows = df.orderBy("name").collect()  # at most `most_templates`
    lib = [{"name": r["name"], "n": len(r["h"]), "size": window_size(len(r["h"]), c), "h": sorted(set(r["h"]))} for r in rows]
    number = {t["name"]: i for i, t in enumerate(lib)}
    index: list[list[dict]] = [[] for _ in range(SLOTS)]
    for size in sorted({t["size"] for t in lib}):
        own = df.where(F.col("name").isin([t["name"] for t in lib if t["size"] == size]))
        for r in own.select("name", F.array_distinct(F.flatten(_windows(F.col("h"), size, 1, c))).alias("bands")).collect():
            for k in r["bands"]:
                index[k % SLOTS].append({"k": k, "t": number[r["name"]]})
    return lib, index


def candidates(h: Column, size: int, index: Column, c: Config) -> Column:
    """(at, found): windows of one size with a band in the index, and the templates that it names there."""
    look = lambda k: F.transform(F.filter(F.get(index, k.bitwiseAND(F.lit(SLOTS - 1)).cast("int")), lambda x: x["k"] == k), lambda x: x["t"])
    step = max(size // 2, 1)
    met = F.transform(_windows(h, size, step, c), lambda bands, i: F.struct((i * step).alias("at"), F.array_distinct(F.flatten(F.transform(bands, look))).alias("found")))
    return F.filter(met, lambda x: F.size(x["found"]) > 0)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, c: Config = Config(), overlapping: bool = False) -> DataFrame:
    """doc_id, licenses (sorted names), best (largest share of a template's shingles found) of every row of `docs`.

    Null, empty and short texts have none. Repeated rows each give a row; columns besides doc_id and text are ignored; an
    empty table gives none. Equal shares at one place all stay; `overlapping` keeps smaller ones too. There is no shuffle: the
    library has a bound and is a constant.
    """
    lib, slots = library(docs.sparkSession, TEMPLATES if templates is None else templates, c)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not lib:
        return ids.select("doc_id", F.array().cast("array<string>").alias("licenses"), F.lit(0.0).alias("best"))
    index = F.from_json(F.lit(json.dumps(slots)), "array<array<struct<k:bigint,t:int>>>")
    known = F.from_json(F.lit(json.dumps(lib)), "array<struct<name:string,n:int,size:int,h:array<bigint>>>")

    def verified(h: Column, x: Column, number: Column) -> Column:
        t = F.get(known, number)
        around = F.slice(h, F.greatest(x["at"] - t["n"], F.lit(0)) + 1, F.lit(2) * t["n"] + t["size"])
        share = F.size(F.array_intersect(t["h"], around)) / F.size(t["h"]).cast("double")
        return F.struct(share.alias("share"), (-x["at"]).alias("before"), t["name"].alias("name"), t["n"].alias("n"))

    def found(h: Column) -> Column:
        met = F.concat(*[candidates(h, size, index, c) for size in sorted({t["size"] for t in lib})])
        all_ = F.flatten(F.transform(met, lambda x: F.transform(x["found"], lambda number: verified(h, x, number))))
        fine = F.array_distinct(F.filter(all_, lambda y: y["share"] >= c.share))
        first = lambda xs: F.filter(xs, lambda x: ~F.exists(xs, lambda y: (y["name"] == x["name"]) & (y > x)))
        alone = lambda xs: xs if overlapping else F.filter(xs, lambda x: ~F.exists(xs, lambda y: (y["share"] > x["share"]) & (F.abs(y["before"] - x["before"]) < F.greatest(x["n"], y["n"]))))
        return let(fine, lambda xs: let(first(xs), alone))

    all_ = let(shingles_of(words_of(F.col("text"))), found)
    digest = let(all_, lambda x: F.struct(F.array_sort(F.transform(x, lambda y: y["name"])).alias("licenses"), F.coalesce(F.array_max(F.transform(x, lambda y: y["share"])), F.lit(0.0)).alias("best")))
    return ids.select("doc_id", digest.alias("x")).select("doc_id", "x.licenses", "x.best")


def query(docs: DataFrame) -> DataFrame:
    """op5: names of the licenses in each document, as text, their number and the best containment; a row for each row of `docs`, as in `scan`."""
    got = scan(docs)
    return got.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.size("licenses").cast("long").alias("n_licenses"), "best")
