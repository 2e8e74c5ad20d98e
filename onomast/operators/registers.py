"""Register numbering, id mapping, entry rendering and register files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import date_attribute, format_time, pad_year
from ..functions.text import folded, let, related_variant, xml_escape
from ..profiles import PROFILES, TypeProfile, by_type
from ..settle import settle
from ..sources import files

KEY = ["type", "label_norm"]


def _ordered(found: DataFrame) -> DataFrame:
    """`nth`, from 1, by type: frequent first, then by label. A range sort, whatever the number of types: rows are numbered in their partitions,
    and a table of counts by partition and type gives each partition's offset."""
    at = F.monotonically_increasing_id()
    rows = settle(found.orderBy("type", F.desc("mentions"), F.lower("label"), "label_norm").withColumn("__at", at).withColumn("__part", F.shiftright("__at", 33)))
    parts = rows.groupBy("type", "__part").agg(F.count("*").alias("n"), F.min("__at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("type").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("type", "__part", (before - F.col("first") + 1).alias("__shift"))
    return rows.join(F.broadcast(parts), ["type", "__part"]).withColumn("nth", (F.col("__at") + F.col("__shift")).cast("int")).drop("__at", "__part", "__shift")  # types x partitions


def number(found: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """W2, F13. seq and register_id, by type: frequent first, then by label.

    With `earlier` (type, label_norm, register_id) known clusters keep their id and new ones are numbered after the last.
    """
    prefix = by_type(F.col("type"), lambda p: F.lit(p.id_prefix))
    named = lambda n: F.format_string("%s%06d", prefix, n)
    if earlier is None:
        return _ordered(found).withColumnRenamed("nth", "seq").withColumn("register_id", named(F.col("seq")))
    old = earlier.select(*KEY, F.col("register_id").alias("old_id"))
    last = earlier.groupBy("type").agg(F.max(F.regexp_extract("register_id", r"(\d+)$", 1).cast("int")).alias("last"))
    got = found.join(old, KEY, "left")
    known = got.where("old_id is not null").select("*", F.regexp_extract("old_id", r"(\d+)$", 1).cast("int").alias("seq"))
    fresh = _ordered(got.where("old_id is null")).join(F.broadcast(last), "type", "left")  # one row for each of nine types
    fresh = fresh.withColumn("seq", F.coalesce("last", F.lit(0)) + F.col("nth")).drop("last", "nth")
    return known.unionByName(fresh).withColumn("register_id", F.coalesce("old_id", named(F.col("seq")))).drop("old_id")


def id_mapping(numbered: DataFrame) -> DataFrame:
    """ner_uuid, register_id, type; `files.write_mapping` sorts them (O6)."""
    return numbered.select(F.explode("ner_ids").alias("ner_uuid"), "register_id", "type")


def filtered_variants(label: Column, variants: Column, cap: Column) -> Column:
    """F17, W5. Related variants, one for each folded form, first ones first, at most `cap`."""
    start = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("out"))

    def step(main: Column, acc: Column, x: Column) -> Column:
        take = (F.size(acc["out"]) < cap) & ~F.array_contains(acc["seen"], x["k"]) & related_variant(main, x["k"])
        return F.when(take, F.struct(F.concat(acc["seen"], F.array(x["k"])).alias("seen"), F.concat(acc["out"], F.array(x["v"])).alias("out"))).otherwise(acc)

    # label and variants are folded once each, not wherever they are compared
    keyed = F.transform(F.coalesce(variants, F.array().cast("array<string>")), lambda v: F.struct(v.alias("v"), folded(v).alias("k")))
    return let(folded(label), lambda main: F.aggregate(keyed, start, lambda acc, x: step(main, acc, x), lambda acc: acc["out"]))


def asserted() -> Column:
    """P14. Whether a match is sure enough for its data to be shown."""
    return F.coalesce(F.col("match_confidence").isin("high", "medium"), F.lit(False))


LISTS = ("occupation_qids", "citizenship_qids", "place_type_qids", "org_type_qids", "author_qids", "genre_qids", "class_qids")
ONES = ("gender_qid", "country_qid", "admin_qid", "hq_qid", "lang_qid", "location_qid")
TEXTS = ("wikidata_qid", "wikidata_label", "description", "viaf", "isni", "gnd", "bnf", "lccn", "geonames", "aat", "birth", "death", "inception", "pub_date", "when", "start", "end", "match_confidence")


def with_all_fields(records: DataFrame) -> DataFrame:
    """Records with every optional column; those that are missing are null."""
    kinds = {**dict.fromkeys(LISTS + ("wikidata_alts",), "array<string>"), **dict.fromkeys(ONES + TEXTS, "string"), "lat": "double", "lon": "double"}
    return records.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in records.columns})


def _pointed() -> Column:
    """The ids that a record points at."""
    return F.array_compact(F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in LISTS], F.array(*ONES)))


def secondary_qids(records: DataFrame) -> DataFrame:
    """A18, U7. Distinct ids that asserted records point at, by the fields of their types (see `of_type`)."""
    return with_all_fields(records).where(asserted()).select(F.explode(_pointed()).alias("qid")).distinct()


def missing_labels(wanted: DataFrame, labels: DataFrame) -> DataFrame:
    """J13."""
    return wanted.join(labels.select("qid"), "qid", "left_anti")


# Labels that go before any fetched one.
GENDER = {"Q6581097": "masculin", "Q6581072": "féminin", "Q1097630": "intersexe", "Q1052281": "femme transgenre", "Q2449503": "homme transgenre"}


def resolve_labels(wanted: DataFrame, labels: DataFrame) -> DataFrame:
    """S12, J7. `wanted` with label: a fixed label, a known one, or the id itself."""
    fixed = F.coalesce(*[F.when(F.col("qid") == q, v) for q, v in GENDER.items()])
    got = wanted.join(labels.select("qid", F.col("label").alias("__label")), "qid", "left")
    return got.select(*wanted.columns, F.coalesce(fixed, "__label", "qid").alias("label"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """J7. Joined rows with `label_of`, a map of the labels of the ids that each asserted row points at."""
    wanted = rows.where(asserted()).select(*KEY, F.explode(F.array_distinct(_pointed())).alias("qid"))
    maps = resolve_labels(wanted, labels).groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("qid", "label"))).alias("label_of"))
    return rows.join(maps, KEY, "left")


def joined(numbered: DataFrame, records: DataFrame) -> DataFrame:
    """J6. Every cluster with its record, if there is one."""
    own = with_all_fields(records)
    return numbered.join(own.select(*KEY, *[c for c in own.columns if c not in numbered.columns]), KEY, "left")


def _lines(*parts: Column) -> Column:
    """Lines that are there, in order: arrays of lines are flattened, null lines left out."""
    return F.filter(F.flatten(F.array(*parts)), lambda x: x.isNotNull())


def _line(indent: int, *parts: Column | str) -> Column:
    """A line; null if any part is."""
    return F.concat(F.lit(" " * indent), *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _element(tag: str, value: Column, attributes: str = "", indent: int = 8) -> Column:
    """An array of one line, or of none if the value is null."""
    return F.array(_line(indent, f"<{tag}{' ' + attributes if attributes else ''}>", F.when(value.isNotNull(), xml_escape(value)), f"</{tag}>"))


def render(rows: DataFrame, label_of: Column | None = None) -> DataFrame:
    """G1-G10. type, seq, register_id, mentions, xml of each joined row. `label_of` maps ids to labels (a map column, see `with_labels`)."""
    sure = asserted()
    shown = lambda c: F.when(sure, F.col(c))
    lab = lambda q: F.coalesce(F.element_at(label_of, q), q) if label_of is not None else q
    cap = by_type(F.col("type"), lambda p: F.lit(p.cap))
    rows = rows.withColumn("__v", filtered_variants(F.col("label"), F.col("variants"), cap))
    standard = F.when(F.col("wikidata_label") != "", shown("wikidata_label"))

    def variants(tag: str, indent: int = 8) -> Column:
        return F.transform("__v", lambda v: _line(indent, f'<{tag} type="variant">', xml_escape(v), f"</{tag}>"))

    def names(tag: str, sort: bool, indent: int = 8) -> Column:
        parts = [_element(tag, F.col("label"), 'type="main"', indent)]
        if sort:
            parts.append(_element(tag, F.coalesce(F.when(F.col("wikidata_label") != "", F.col("wikidata_label")), "label"), 'type="sort"', indent))
        return _lines(*parts, _element(tag, standard, 'type="standard"', indent), variants(tag, indent))

    def keyed(tag: str, column: str, extra: str = "") -> Column:
        if column in LISTS:
            ids = F.coalesce(shown(column), F.array().cast("array<string>"))
            return F.transform(ids, lambda q: _line(8, f"<{tag}{extra} key=\"", q, '">', xml_escape(lab(q)), f"</{tag}>"))
        return F.array(_line(8, f"<{tag}{extra} key=\"", shown(column), '">', xml_escape(lab(shown(column))), f"</{tag}>"))

    def dated(column: str, before: str, after: str) -> Column:
        return F.array(_line(8, before, pad_year(format_or_keep(shown(column))), after))

    def ids(*kinds: str) -> Column:
        own = [F.array(_line(8, '<idno type="wikidata" cert="', F.col("match_confidence"), '">', shown("wikidata_qid"), "</idno>"))]
        order = [k for k in ("viaf", "isni", "gnd", "bnf", "lccn", "geonames", "aat") if k in kinds]
        return _lines(*own, *[_element("idno", F.when(F.col("wikidata_qid").isNotNull() & (F.col(k) != ""), shown(k)), f'type="{k}"') for k in order])

    described = lambda tag, attributes="": _element(tag, F.when(F.col("description") != "", shown("description")), attributes)
    listed = lambda c: F.when(F.size(c) > 0, F.array_join(c, "|"))
    trace = [_element("note", F.col("mentions").cast("string"), 'type="mentions"'), _element("note", listed("source_docs"), 'type="sources"')]
    linked = [_element("note", F.col("match_confidence"), 'type="reconciliation-confidence"'), _element("note", listed("wikidata_alts"), 'type="wikidata-candidates"')]
    geo = F.array(_line(8, "<location><geo>", F.when(shown("lat").isNotNull(), F.format_string("%.5f %.5f", "lat", "lon")), "</geo></location>"))
    sex = F.array(_line(8, '<sex value="', shown("gender_qid"), '">', xml_escape(lab(shown("gender_qid"))), "</sex>"))
    note = described("note", 'type="description"')
    terms = _lines(F.array(F.lit("        <catDesc>")), names("term", False, 10), F.array(F.lit("        </catDesc>")))
    category = ("category", [terms, ids("aat"), note, *trace, *linked])
    when = date_attribute(F.col("label"))
    item = F.array(F.concat(F.lit("        <date"), F.coalesce(F.concat(F.lit(' when="'), when, F.lit('"')), F.lit("")), F.lit(">"), xml_escape(F.col("label")), F.lit("</date>")))
    bodies = {
        "person": ("person", [names("persName", True), dated("birth", '<birth><date when="', '"/></birth>'), dated("death", '<death><date when="', '"/></death>'), sex, keyed("occupation", "occupation_qids"), keyed("nationality", "citizenship_qids"), ids("viaf", "isni", "gnd", "bnf", "lccn"), note, *trace, *linked]),
        "place": ("place", [names("placeName", True), geo, keyed("country", "country_qid"), ids("geonames"), note, *trace, *linked]),
        "org": ("org", [names("orgName", True), dated("inception", '<event type="foundation"><date when="', '"/></event>'), ids("isni", "viaf", "gnd"), note, *trace, *linked]),
        "work": ("bibl", [names("title", False), keyed("author", "author_qids"), dated("pub_date", '<date type="publication" when="', '"/>'), keyed("textLang", "lang_qid"), keyed("note", "genre_qids", ' type="genre"'), ids(), note, *trace, *linked]),
        "event": ("event", [names("label", False), dated("when", '<date when="', '"/>'), dated("start", '<date notBefore="', '"/>'), dated("end", '<date notAfter="', '"/>'), keyed("placeName", "location_qid"), ids(), described("desc"), *trace, *linked]),
        "artwork": ("object", [names("objectName", False), keyed("objectType", "class_qids"), ids("aat"), note, *trace, *linked]),
        "material": category,
        "technique": category,
        "date": ("item", [item, variants("date"), *trace]),
    }

    def entry(tag: str, parts: list[Column]) -> Column:
        head = F.array(F.concat(F.lit(f'      <{tag} xml:id="'), F.col("register_id"), F.lit('" n="'), F.col("mentions").cast("string"), F.lit('">')))
        return F.array_join(_lines(head, *parts, F.array(F.lit(f"      </{tag}>"))), "\n")

    xml = by_type(F.col("type"), lambda p: entry(*bodies[p.type]))
    return rows.select("type", "seq", "register_id", "mentions", xml.alias("xml"))


def format_or_keep(c: Column) -> Column:
    """A date as recorded: knowledge-base times are shortened, others stay."""
    return F.coalesce(format_time(c), c)


# What stands around the entries of each register.
_WRAP = {
    "person": ("<listPerson>", "</listPerson>"),
    "place": ("<listPlace>", "</listPlace>"),
    "org": ("<listOrg>", "</listOrg>"),
    "work": ('<listBibl type="work">', "</listBibl>"),
    "event": ("<listEvent>", "</listEvent>"),
    "artwork": ("<listObject>", "</listObject>"),
    "material": ('<taxonomy xml:id="materials">', "</taxonomy>"),
    "technique": ('<taxonomy xml:id="techniques">', "</taxonomy>"),
    "date": ('<list type="chronology">', "</list>"),
}


@dataclass(frozen=True)
class Header:
    """G11. What register headers say."""

    corpus: str = "Corpus"
    publisher: str = "Authority registers"
    licence: str = "https://creativecommons.org/licenses/by/4.0/"
    changed: str = "2026-01-01"


def _frame(p: TypeProfile, header: Header) -> tuple[str, str]:
    """What stands before and behind the entries of a register file."""
    title = xml_text(f"{p.register.capitalize()} of {header.corpus}")
    before, after = _WRAP[p.type]
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<TEI xmlns="http://www.tei-c.org/ns/1.0" xml:id="{p.root}">\n  <teiHeader>\n    <fileDesc>\n      <titleStmt><title>{title}</title></titleStmt>\n'
    head += f'      <publicationStmt><publisher>{xml_text(header.publisher)}</publisher><availability><licence target="{xml_text(header.licence)}"/></availability></publicationStmt>\n      <sourceDesc><p>Named-entity annotation</p></sourceDesc>\n    </fileDesc>\n'
    revision = f'    <revisionDesc><change when="{xml_text(header.changed)}"/></revisionDesc>\n  </teiHeader>\n'
    if p.type in ("material", "technique"):
        return f"{head}    <encodingDesc><classDecl>\n    {before}\n", f"    {after}\n    </classDecl></encodingDesc>\n{revision}  <text><body><p/></body></text>\n</TEI>\n"
    return f"{head}{revision}  <standOff>\n    {before}\n", f"    {after}\n  </standOff>\n  <text><body><p/></body></text>\n</TEI>\n"


def write_registers(entries: DataFrame, folder: str, header: Header = Header()) -> dict[str, int]:
    """K6. Nine files, entries in order. Entries are settled once; each file's parts are sorted and written by the tasks and then put
    together as byte streams: no entry passes through the driver's memory."""
    rows = settle(entries.select("type", "seq", "xml"))
    counts = {r["type"]: r["count"] for r in rows.groupBy("type").count().collect()}  # nine rows
    for p in PROFILES:
        files.write_text(rows.where(F.col("type") == p.type).orderBy("seq").select("xml"), f"{folder}/{p.register}.xml", *_frame(p, header))
    return {p.type: counts.get(p.type, 0) for p in PROFILES}


def xml_text(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def coverage(found: DataFrame, records: DataFrame) -> DataFrame:
    """A17, F30. type, entries, matched, percent; all nine types, 0 where there is nothing."""
    from ..profiles import dimension

    got = found.join(records.select(*KEY, "match_confidence"), KEY, "left").groupBy("type").agg(F.count("*").alias("entries"), F.count_if(asserted()).alias("matched"))
    all_ = dimension(found.sparkSession).select("type").join(got, "type", "left").fillna(0, ["entries", "matched"])
    percent = F.when(F.col("entries") > 0, F.bround(100.0 * F.col("matched") / F.col("entries"), 0)).otherwise(0.0)
    return all_.select("type", "entries", "matched", percent.cast("int").alias("percent"))


def match_sample(found: DataFrame, records: DataFrame, n: int = 12) -> DataFrame:
    """W6. The most mentioned high-confidence matches of each type."""
    w = Window.partitionBy("type").orderBy(F.desc("mentions"), F.lower("label"), "label_norm")
    high = records.where(F.col("match_confidence") == "high").select(*KEY, "wikidata_qid")
    return found.join(high, KEY).withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n).select("type", "nth", "label", "mentions", "wikidata_qid")
