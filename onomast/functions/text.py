"""Text normalisation and label functions as native column expressions."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Particles that may lead a label, and titles that may lead a query.
PARTICLES = "le la les l du de des d un une the el il lo sainct saint sainte st ste s m mr monsieur".split()
TITLES = r"s\.?|st\.?|ste\.?|saincte?|sainte?|monsieur|mr\.?|le sieur|sieur"
RELIGIOUS = r"s\.?|st\.?|ste|sainct|sainte?"


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, str, str]:
    """From the compatibility decompositions of Latin characters and punctuation: those that fold to one character, and what to; those that
    fold to several, as JSON and as a regex class. All scripts would make literals of 30 KB, which every plan repeats."""
    src, dst, longer = [], [], {}
    for cp in [*range(0xA0, 0x300), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0xFB00, 0xFB07)]:
        ch = chr(cp)
        flat = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if flat != ch and len(flat) == 1:
            src.append(ch)
            dst.append(flat)
        elif flat != ch:
            longer[ch] = flat
    return "".join(src), "".join(dst), json.dumps(longer, ensure_ascii=False), f"[{''.join(longer)}]"


def strip_diacritics(c: Column) -> Column:
    """F1. Compatibility decomposition without combining marks, for Latin text; all native. ASCII passes as it is; characters that fold to
    several are taken one by one where a text has any.

    Characters beyond the Latin blocks stay as they are; `strip_diacritics_any` decomposes those too.
    """
    src, dst, longer, several = _folds()
    table = F.from_json(F.lit(longer), "map<string,string>")
    whole = lambda p: F.when(p.rlike(several), F.array_join(F.transform(F.split(p, ""), lambda ch: F.coalesce(F.element_at(table, ch), ch)), "")).otherwise(p)
    return let(c, lambda x: F.when(x.rlike(r"[^\x00-\x7F]"), F.regexp_replace(let(F.translate(x, src, dst), whole), r"\p{M}+", "")).otherwise(x))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that stands in the plan, and is computed, once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))


def strip_diacritics_any(c: Column) -> Column:
    """F1 for every script, in Arrow batches."""
    return F.pandas_udf(_nfkd, StringType())(c)


def norm_label(c: Column, fold: Callable[[Column], Column] = strip_diacritics) -> Column:
    """F2, F3. The clustering key of a label: folded lower-case words without leading particles."""
    x = fold(F.trim(F.lower(c)))
    x = F.replace(F.replace(x, F.lit("ſ"), F.lit("s")), F.lit("&"), F.lit(" et "))
    x = F.regexp_replace(x, r"(?U)[^a-z0-9\s']", " ")
    x = F.trim(F.regexp_replace(x, r"(?U)\s+", " "))
    return F.trim(F.regexp_replace(x, rf"^(?:(?:{'|'.join(PARTICLES)})\b[\s']*)+", ""))


def match_key(c: Column, fold: Callable[[Column], Column] = strip_diacritics) -> Column:
    """F4. The matching key of a name: articles stay, apostrophes go."""
    x = F.replace(fold(F.lower(c)), F.lit("ſ"), F.lit("s"))
    return F.trim(F.regexp_replace(F.regexp_replace(x, "[^a-z0-9 ]", " "), " +", " "))


def clean_query(c: Column) -> Column:
    """F6. A search text without outer punctuation and without one leading title."""
    x = F.btrim(F.trim(c), F.lit(".,;:'\""))
    return F.trim(F.regexp_replace(x, rf"(?i)^(?:{TITLES})\s+", ""))


def spelling_variants(c: Column) -> Column:
    """F7. Early modern spellings of a label, in a fixed order, at most six of three characters or more."""
    base = F.btrim(F.trim(c), F.lit(".,;:"))
    swaps = [("v", "u"), ("u", "v"), ("j", "i"), ("i", "j"), ("ç", "c"), ("œ", "oe")]
    forms = [c, base, *[F.replace(base, F.lit(a), F.lit(b)) for a, b in swaps]]
    forms.append(F.regexp_replace(base, rf"(?i)^(?:{RELIGIOUS})\s+", ""))
    forms.append(F.when(F.lower(base).endswith("e"), F.concat(F.substr(base, F.lit(1), F.length(base) - 1), F.lit("us"))))
    kept = F.filter(F.array(*forms), lambda x: x.isNotNull() & (F.length(x) >= 3))
    return F.slice(F.array_distinct(kept), 1, 6)


def label_score(form: Column, freq: Column) -> Column:
    """F8. How good a form is as a display label."""
    lower_only = (form == F.lower(form)) & (form != F.upper(form))
    upper = F.when(form < "\x80", (form >= "A") & (form < "[")).otherwise(form.rlike(r"^\p{Lu}"))  # no regex for an ASCII start
    bonus = lambda cond, n: F.when(cond, n).otherwise(0)
    return (
        2 * freq
        + bonus(upper, 3)
        + bonus(form.contains(" "), 2)
        + bonus(F.length(form) >= 4, 1)
        - bonus(F.length(form) <= 2, 5)
        - bonus((F.length(form) < 5) & lower_only, 2)
    )


def name_similarity(key: Column, names: Column) -> Column:
    """F9. 3 equal, 2 one holds the other, 1 same last word, null none. A name without a letter or digit has an empty key, which every other
    key holds."""
    last = lambda x: F.element_at(F.split(x, " "), -1)
    return F.when(F.array_contains(names, key), 3).when(F.exists(names, lambda n: n.contains(key) | F.contains(key, n)), 2).when(F.exists(names, lambda n: last(n) == last(key)), 1)


def xml_escape(c: Column) -> Column:
    """F10."""
    x = F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(x, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def common_prefix(a: Column, b: Column) -> Column:
    """F15. Length of the common prefix."""
    hits = F.filter(F.sequence(F.lit(0), F.least(F.length(a), F.length(b))), lambda n: F.substr(a, F.lit(1), n) == F.substr(b, F.lit(1), n))
    return F.array_max(hits)


def folded(c: Column) -> Column:
    """What variants are compared by: no marks, lower case, trimmed."""
    return F.trim(F.lower(strip_diacritics(c)))


def related_variant(main: Column, variant: Column) -> Column:
    """F14-F16. Whether a folded variant is a plausible spelling of a folded label."""
    shorter, longer = F.least(F.length(main), F.length(variant)), F.greatest(F.length(main), F.length(variant))
    bound = F.greatest(F.lit(1), F.floor(longer * 0.34).cast("int"))
    last = lambda x: F.element_at(F.split(x, " "), -1)
    return F.when((variant == "") | (variant == main), False).otherwise(
        main.contains(variant)
        | variant.contains(main)
        | let(common_prefix(main, variant), lambda n: (n >= 4) & (n * 2 >= shorter))
        | ((longer >= 4) & (F.levenshtein(main, variant) <= bound))
        | ((last(main) == last(variant)) & (F.length(last(main)) >= 4))
    )


def entity_prefix(c: Column) -> Column:
    return F.regexp_extract(c, "^([a-zA-Z]+)-", 1)


def ref_id(c: Column) -> Column:
    """S5. A reference without its leading signs; empty is null."""
    x = F.regexp_replace(c, "^#+", "")
    return F.when(x != "", x)
