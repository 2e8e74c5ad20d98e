"""The nine entity types: prefixes, register layout, caps and acceptance rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _any(*pids: str) -> Callable[[Column, Column], Column]:
    return lambda pids_, p31: F.arrays_overlap(pids_, F.array(*map(F.lit, pids)))


def _any_class(pids: Column, p31: Column) -> Column:
    return F.size(p31) > 0


# Properties and classes that make a candidate acceptable.
HUMAN = "Q5"
HUMANLIKE = ("Q178885", "Q20643955", "Q3512563", "Q51626", "Q22989102")
PERSON_PIDS = ("P569", "P570", "P106", "P22", "P25")
PLACE_PIDS = ("P625", "P1566", "P17", "P131")
ORG_PIDS, NOT_ORG_PIDS = ("P571", "P159", "P112", "P488"), ("P569", "P570", "P625")
WORK_PIDS = ("P50", "P577", "P136", "P1476", "P407")
EVENT_PIDS = ("P585", "P580", "P582", "P276", "P710")
AUTHORITY_PIDS = ("P213", "P214", "P227", "P268", "P1566")
KEPT_PIDS = "P31 P569 P570 P106 P22 P25 P21 P27 P625 P1566 P17 P131 P571 P159 P112 P488 P50 P577 P136 P1476 P407 P585 P580 P582 P276 P710 P213 P214 P227 P268 P244 P1014 P18 P373".split()
PLAUSIBLE_COUNTRIES = "Q142 Q38 Q41 Q43 Q801 Q219060 Q79 Q183 Q29 Q145 Q237 Q31 Q55 Q39 Q45 Q40 Q36 Q213 Q28 Q224 Q221 Q2277 Q12544 Q83958 Q1747689 Q3024240 Q200464 Q5743 Q858 Q796 Q810".split()


def _person(pids: Column, p31: Column) -> Column:
    return F.array_contains(p31, HUMAN) | F.arrays_overlap(p31, F.array(*map(F.lit, HUMANLIKE))) | _any(*PERSON_PIDS)(pids, p31)


def _org(pids: Column, p31: Column) -> Column:
    return F.when(_any(*ORG_PIDS)(pids, p31), True).when(_any(*NOT_ORG_PIDS)(pids, p31), False).otherwise(_any_class(pids, p31))


def _thing(pids: Column, p31: Column) -> Column:
    return F.array_contains(pids, "P1014") | _any_class(pids, p31)


@dataclass(frozen=True)
class TypeProfile:
    """One entity type. `last_year` bounds birth or event years; `cap` bounds the variants in a register."""

    type: str
    prefix: str
    register: str
    root: str
    id_prefix: str
    cap: int
    accept: Callable[[Column, Column], Column] = _any_class
    last_year: int | None = None


# Layout, caps and last years of the types.
PROFILES = (
    TypeProfile("person", "pers", "persons", "pb-persons", "person-", 12, _person, 1660),
    TypeProfile("place", "place", "places", "pb-places", "place-", 12, _any(*PLACE_PIDS)),
    TypeProfile("org", "org", "organizations", "pb-organizations", "org-", 12, _org),
    TypeProfile("work", "work", "works", "pb-works", "work-", 8, _any(*WORK_PIDS)),
    TypeProfile("event", "event", "events", "pb-events", "event-", 6, _any(*EVENT_PIDS), 1700),
    TypeProfile("artwork", "artwork", "artworks", "pb-artworks", "artwork-", 6, _thing),
    TypeProfile("material", "mat", "materials", "pb-materials", "material-", 8, _thing),
    TypeProfile("technique", "tech", "techniques", "pb-techniques", "technique-", 8, _thing),
    TypeProfile("date", "date", "dates", "pb-dates", "date-", 5),
)
BY_TYPE = {p.type: p for p in PROFILES}


def type_of_prefix(prefix: Column) -> Column:
    """P1. Entity type of an id prefix, exact and case-sensitive; null for others."""
    return F.get(F.filter(F.array(*[F.when(prefix == p.prefix, p.type) for p in PROFILES]), lambda x: x.isNotNull()), F.lit(0))


def type_of_id(ident: Column) -> Column:
    """P1. Entity type of an id by what it starts with: the same as `type_of_prefix` of its prefix, without a regex for each row."""
    out = F.lit(None).cast("string")
    for p in PROFILES:
        out = F.when(ident.startswith(f"{p.prefix}-"), p.type).otherwise(out)
    return out


def by_type(type_: Column, value: Callable[[TypeProfile], Column | None]) -> Column:
    """A value that depends on the type; null for types without one."""
    out = F.lit(None)
    for p in PROFILES:
        if (v := value(p)) is not None:
            out = F.when(type_ == p.type, v).otherwise(out)
    return out


def dimension(spark: SparkSession) -> DataFrame:
    """J14. The types as a table of nine rows."""
    return spark.createDataFrame([(p.type, p.prefix, p.register, p.root, p.id_prefix, p.cap) for p in PROFILES], "type string, prefix string, register string, root string, id_prefix string, cap int")


def accept(type_: Column, pids: Column, p31: Column) -> Column:
    """P5-P12. Whether a knowledge-base entity can be of the type."""
    return F.coalesce(by_type(type_, lambda p: p.accept(pids, p31)), F.size(p31) > 0)


def in_time(type_: Column, birth_year: Column, event_year: Column) -> Column:
    """P13. False for persons and events that are too late; unknown years pass."""
    late = F.when(type_ == "person", F.coalesce(birth_year, F.lit(-9999)) > BY_TYPE["person"].last_year).when(type_ == "event", F.coalesce(event_year, F.lit(-9999)) > BY_TYPE["event"].last_year)
    return ~F.coalesce(late, F.lit(False))


def fame(sitelinks: Column) -> Column:
    return F.least(F.coalesce(sitelinks, F.lit(0)), F.lit(60))


def geo_bonus(type_: Column, country: Column) -> Column:
    """F27, J11. For places: 0 without a country, 1 in a plausible one, -3 in another."""
    return F.when((type_ != "place") | country.isNull(), 0).when(country.isin(PLAUSIBLE_COUNTRIES), 1).otherwise(-3)


def confidence(type_: Column, sim: Column, sitelinks: Column, has_auth: Column, has_aat: Column) -> Column:
    """F39."""
    level = F.when((sim == 3) & ((sitelinks >= 6) | has_auth), "high").when((sim >= 2) & ((sitelinks >= 3) | has_auth), "medium").otherwise("low")
    return F.when(type_.isin("material", "technique", "artwork") & ~has_aat, "low").otherwise(level)
