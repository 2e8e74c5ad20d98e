"""The catalogue's queries in SQL for DuckDB, written on their own: the same results by other means."""

from __future__ import annotations

from ..functions.dates import MONTHS
from ..functions.text import PARTICLES, RELIGIOUS, TITLES
from ..profiles import AUTHORITY_PIDS, EVENT_PIDS, HUMANLIKE, NOT_ORG_PIDS, ORG_PIDS, PERSON_PIDS, PLACE_PIDS, PLAUSIBLE_COUNTRIES, PROFILES, WORK_PIDS
from .inputs import CACHE, EVENTS, KB_BASE, KB_CLAIMS, KB_NAMES, LABELS, ansi


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _norm(x: str) -> str:
    x = f"replace(replace(strip_accents(trim(lower({x}))), 'ſ', 's'), '&', ' et ')"
    x = rf"trim(regexp_replace(regexp_replace({x}, '[^a-z0-9\s'']', ' ', 'g'), '\s+', ' ', 'g'))"
    return rf"trim(regexp_replace({x}, '^(?:(?:{'|'.join(PARTICLES)})\b[\s'']*)+', ''))"


def _key(x: str) -> str:
    x = f"replace(strip_accents(lower({x})), 'ſ', 's')"
    return f"trim(regexp_replace(regexp_replace({x}, '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


def _fold(x: str) -> str:
    return f"trim(lower(strip_accents({x})))"


_PREFIX = " ".join(f"WHEN '{p.prefix}' THEN '{p.type}'" for p in PROFILES)


def _type(ident: str) -> str:
    return f"CASE regexp_extract({ident}, '^([a-zA-Z]+)-', 1) {_PREFIX} END"


def _case(of: str, value) -> str:
    return f"CASE {of} " + " ".join(f"WHEN '{p.type}' THEN {value(p)}" for p in PROFILES) + " END"


_SCORE = r"""2 * cnt + CASE WHEN regexp_matches(form, '^\p{Lu}') THEN 3 ELSE 0 END + CASE WHEN contains(form, ' ') THEN 2 ELSE 0 END
 + CASE WHEN length(form) >= 4 THEN 1 ELSE 0 END - CASE WHEN length(form) <= 2 THEN 5 ELSE 0 END
 - CASE WHEN form = lower(form) AND form <> upper(form) AND length(form) < 5 THEN 2 ELSE 0 END"""

#: Common table expressions, each of which may use those before it.
_CTE = {
    "raw": ansi(EVENTS),
    "ev": f"SELECT * FROM (SELECT *, {_type('ner_id')} AS type FROM raw) WHERE type IS NOT NULL",
    "ef": "SELECT ner_id, type, form, CAST(count(*) FILTER (kind = 'mention') AS BIGINT) AS cnt, min(seq) AS first_seen FROM ev WHERE form <> '' GROUP BY ALL",
    "en": "SELECT ner_id, type, CAST(count(*) FILTER (kind = 'mention') AS BIGINT) AS mentions, list_sort(list(DISTINCT doc)) AS docs, min(seq) AS first_seen, arg_max(form, seq) FILTER (kind = 'def' AND form <> '') AS canon FROM ev GROUP BY ner_id, type",
    "bl": f"SELECT ner_id, form AS label FROM ef QUALIFY row_number() OVER (PARTITION BY ner_id ORDER BY {_SCORE} DESC, first_seen) = 1",
    "kn": f"SELECT * FROM (SELECT en.*, label, {_norm('label')} AS label_norm FROM en JOIN bl USING (ner_id)) WHERE label <> '' AND label_norm <> ''",
    "vo": "SELECT type, label_norm, label, sum(greatest(1, mentions)) AS w, min(first_seen) AS o FROM kn GROUP BY ALL",
    "di": "SELECT type, label_norm, label FROM vo QUALIFY row_number() OVER (PARTITION BY type, label_norm ORDER BY w DESC, o) = 1",
    "idl": "SELECT type, label_norm, CAST(sum(mentions) AS BIGINT) AS mentions, list_sort(list(ner_id)) AS ner_ids, list_sort(list_distinct(flatten(list(docs)))) AS source_docs FROM kn GROUP BY type, label_norm",
    "fo": "SELECT type, label_norm, form, sum(cnt) AS cnt, min([kn.first_seen, f.first_seen]) AS o FROM kn JOIN (SELECT ner_id, form, cnt, first_seen FROM ef) f USING (ner_id) GROUP BY ALL",
    "fl": "SELECT type, label_norm, list(form ORDER BY cnt DESC, o) AS forms FROM fo GROUP BY ALL",
    "cl": "SELECT type, label, label_norm, list_filter(forms, lambda x: x <> label)[1:40] AS variants, len(forms) AS n_variants, ner_ids, len(ner_ids) AS n_ner_ids, source_docs, mentions FROM idl JOIN di USING (type, label_norm) JOIN fl USING (type, label_norm)",
    "nu": f"SELECT *, {_case('type', lambda p: repr(p.id_prefix))} || lpad(CAST(seq AS VARCHAR), 6, '0') AS register_id FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY mentions DESC, lower(label), label_norm) AS seq FROM cl)",
    "names": ansi(KB_NAMES),
    "claims": ansi(KB_CLAIMS),
    "base": ansi(KB_BASE),
    "dn": """SELECT qid, first(value ORDER BY CASE lang WHEN 'fr' THEN 0 WHEN 'la' THEN 1 WHEN 'en' THEN 2 ELSE 3 END) FILTER (kind = 'label') AS wikidata_label, first(value ORDER BY CASE lang WHEN 'fr' THEN 0 WHEN 'en' THEN 1 WHEN 'la' THEN 2 ELSE 3 END) FILTER (kind = 'description') AS description FROM names GROUP BY qid""",
    "pr0": """SELECT qid, sitelinks, coalesce(pids, []) AS pids, coalesce(p31, []) AS p31, coalesce(has_auth, false) AS has_auth, coalesce(has_aat, false) AS has_aat, t569, t570, t585, country, coalesce(keys, []) AS keys FROM base
 LEFT JOIN (SELECT qid, list_sort(list(DISTINCT pid)) AS pids, list_sort(list(DISTINCT v_id) FILTER (pid = 'P31' AND v_id IS NOT NULL)) AS p31,
   bool_or(pid IN (%s) AND coalesce(v_str, v_id, v_time) IS NOT NULL) AS has_auth, bool_or(pid = 'P1014' AND v_str IS NOT NULL) AS has_aat, min(v_time) FILTER (pid = 'P569') AS t569, min(v_time) FILTER (pid = 'P570') AS t570, min(v_time) FILTER (pid = 'P585') AS t585, min(v_id) FILTER (pid = 'P17') AS country
   FROM claims GROUP BY qid) USING (qid)
 LEFT JOIN (SELECT qid, list_sort(list(DISTINCT %s)) AS keys FROM (SELECT qid, value FROM names WHERE kind = 'alias' UNION ALL SELECT qid, wikidata_label FROM dn) WHERE value <> '' GROUP BY qid) USING (qid)""" % (", ".join(f"'{p}'" for p in AUTHORITY_PIDS), _key("value")),
    "pr": r"SELECT *, CAST(regexp_extract(coalesce(t569, t570), '^[+]?(-?)0*(\d+)-', 1) || regexp_extract(coalesce(t569, t570), '^[+-]?0*(\d+)-', 1) AS INT) AS birth_year, CAST(regexp_extract(t585, '^[+-]?0*(\d+)-', 1) AS INT) AS event_year FROM pr0",
    "wl": "SELECT * FROM cl WHERE mentions >= 1 AND type <> 'date'",
    "p0": rf"SELECT *, trim(trim(label), '.,;:') AS b, trim(regexp_replace(trim(trim(label), '.,;:''\"'), '^(?:{TITLES})\s+', '', 'i')) AS f1a FROM wl",
    "p1": f"SELECT *, CASE WHEN {_key('f1a')} <> {_key('label')} AND f1a <> '' THEN f1a END AS f1 FROM p0",
    "p2": rf"""SELECT type, label_norm, label, f1, unnest(list_concat([label, b, replace(b, 'v', 'u'), replace(b, 'u', 'v'), replace(b, 'j', 'i'), replace(b, 'i', 'j'), replace(b, 'ç', 'c'), replace(b, 'œ', 'oe'), regexp_replace(b, '^(?:{RELIGIOUS})\s+', '', 'i'),
   CASE WHEN lower(b) LIKE '%e' THEN b[1:-2] || 'us' END], [])) AS q, unnest(range(10)) AS i FROM p1 WHERE mentions >= 5""",
    "p3": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY type, label_norm ORDER BY i) AS nth FROM (SELECT * FROM p2 WHERE length(q) >= 3 QUALIFY row_number() OVER (PARTITION BY type, label_norm, q ORDER BY i) = 1)) WHERE nth <= 6",
    "p4": "SELECT type, label_norm, label, f1, q, nth FROM p3 UNION ALL SELECT type, label_norm, label, f1, unnest(variants[1:3]), 100 + unnest(range(1, len(variants[1:3]) + 1)) FROM p1 WHERE mentions >= 5",
    "p5": f"SELECT *, row_number() OVER (PARTITION BY type, label_norm ORDER BY nth) AS e FROM (SELECT * FROM p4 WHERE {_key('q')} <> {_key('label')} AND (f1 IS NULL OR {_key('q')} <> {_key('f1')}) QUALIFY row_number() OVER (PARTITION BY type, label_norm, {_key('q')} ORDER BY nth) = 1)",
    "plan": """SELECT type, label_norm, label, query, lang, row_number() OVER (PARTITION BY type, label_norm ORDER BY o) - 1 AS stage FROM (
   SELECT type, label_norm, label, label AS query, 'fr' AS lang, 0 AS o FROM p1 UNION ALL SELECT type, label_norm, label, f1, 'fr', 1 FROM p1 WHERE f1 IS NOT NULL
   UNION ALL SELECT type, label_norm, label, label, 'la', 2 FROM p1 UNION ALL SELECT type, label_norm, label, f1, 'la', 3 FROM p1 WHERE f1 IS NOT NULL AND mentions >= 5
   UNION ALL SELECT type, label_norm, label, q, 'fr', 10 + 2 * e FROM p5 WHERE e <= 4 UNION ALL SELECT type, label_norm, label, q, 'la', 11 + 2 * e FROM p5 WHERE e <= 4
   UNION ALL SELECT type, label_norm, label, label, 'en', 1000 FROM p1 WHERE mentions >= 5)""",
    "se": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, t ORDER BY sitelinks DESC, CAST(substr(qid, 2) AS BIGINT)) AS pos FROM (SELECT DISTINCT lang, lower(value) AS t, qid FROM names WHERE kind <> 'description') JOIN base USING (qid)) WHERE pos <= 7",
    "ca": "SELECT type, label_norm, label, qid, stage, pos, row_number() OVER (PARTITION BY type, label_norm ORDER BY stage, pos) - 1 AS rank FROM (SELECT plan.type, label_norm, label, stage, pos, qid FROM plan JOIN se ON plan.lang = se.lang AND lower(substr(query, 1, 200)) = t QUALIFY row_number() OVER (PARTITION BY plan.type, label_norm, qid ORDER BY stage, pos) = 1)",
    "si": f"""SELECT *, CASE WHEN list_contains(keys, k) THEN 3 WHEN len(list_filter(keys, lambda n: contains(n, k) OR contains(k, n))) > 0 THEN 2
   WHEN len(list_filter(keys, lambda n: string_split(n, ' ')[-1] = string_split(k, ' ')[-1])) > 0 THEN 1 END AS s0 FROM (SELECT ca.*, pr.* EXCLUDE (qid), {_key('label')} AS k FROM ca LEFT JOIN pr USING (qid))""",
}


def _has(pids) -> str:
    return f"list_has_any(pids, {_list(pids)})"


_THING = "list_contains(pids, 'P1014') OR len(p31) > 0"
_ACCEPT = {
    "person": f"list_contains(p31, 'Q5') OR list_has_any(p31, {_list(HUMANLIKE)}) OR {_has(PERSON_PIDS)}",
    "place": _has(PLACE_PIDS),
    "org": f"CASE WHEN {_has(ORG_PIDS)} THEN true WHEN {_has(NOT_ORG_PIDS)} THEN false ELSE len(p31) > 0 END",
    "work": _has(WORK_PIDS),
    "event": _has(EVENT_PIDS),
    "artwork": _THING,
    "material": _THING,
    "technique": _THING,
    "date": "len(p31) > 0",
}
_OK = f"({_case('type', lambda p: '(' + _ACCEPT[p.type] + ')')}) AND NOT (type = 'person' AND coalesce(birth_year, -9999) > 1660) AND NOT (type = 'event' AND coalesce(event_year, -9999) > 1700)"
_GEO = f"CASE WHEN country IS NULL THEN 0 WHEN list_contains({_list(PLAUSIBLE_COUNTRIES)}, country) THEN 1 ELSE -3 END"
_SF = f"least(sitelinks, 60) + 12 * CASE WHEN type = 'place' THEN {_GEO} ELSE 0 END"
_CTE |= {
    "sc": f"SELECT type, label_norm, label, qid, stage, pos, rank, sitelinks, has_auth, has_aat, CASE WHEN {_OK} THEN s0 END AS sim, {_SF} AS sf0 FROM si",
    "st": """SELECT DISTINCT a.type, a.label_norm, a.stage, b.sim, b.sitelinks, b.has_auth, b.qid FROM (SELECT DISTINCT type, label_norm, stage FROM sc) a JOIN sc b ON a.type = b.type AND a.label_norm = b.label_norm AND b.stage <= a.stage AND b.sim IS NOT NULL
   QUALIFY row_number() OVER (PARTITION BY a.type, a.label_norm, a.stage ORDER BY b.sim DESC, b.sf0 DESC, b.rank) = 1""",
    "so": "SELECT type, label_norm, coalesce(min(st.stage) FILTER ((sim = 3 AND (sitelinks >= 6 OR has_auth)) OR (sim >= 2 AND sitelinks >= 25)), max(mx)) AS stop FROM st JOIN (SELECT type, label_norm, max(stage) AS mx FROM sc GROUP BY ALL) USING (type, label_norm) GROUP BY type, label_norm",
    "be": "SELECT s.type, s.label_norm, s.qid, s.sim, s.sitelinks, s.has_auth, s.has_aat, so.stop FROM sc s JOIN so ON s.type = so.type AND s.label_norm = so.label_norm AND s.stage <= so.stop AND s.sim IS NOT NULL QUALIFY row_number() OVER (PARTITION BY s.type, s.label_norm ORDER BY s.sim DESC, s.sf0 DESC, s.rank) = 1",
    "al": "SELECT be.type, be.label_norm, list(sc.qid ORDER BY rank) FILTER (sc.qid <> be.qid AND sc.stage <= be.stop) AS alts FROM be JOIN sc ON be.type = sc.type AND be.label_norm = sc.label_norm GROUP BY ALL",
    "ma": """SELECT type, label_norm, qid AS wikidata_qid, sim, sitelinks AS wikidata_sitelinks, stop, coalesce(alts, [])[1:3] AS wikidata_alts,
   CASE WHEN type IN ('material', 'technique', 'artwork') AND NOT has_aat THEN 'low' WHEN sim = 3 AND (sitelinks >= 6 OR has_auth) THEN 'high' WHEN sim >= 2 AND (sitelinks >= 3 OR has_auth) THEN 'medium' ELSE 'low' END AS match_confidence
   FROM be JOIN al USING (type, label_norm)""",
    "re": """SELECT qid, coalesce(list(v_id ORDER BY ord) FILTER (pid = 'P50' AND v_id IS NOT NULL), [])[1:3] AS author_qids, coalesce(list(v_id ORDER BY ord) FILTER (pid = 'P31' AND v_id IS NOT NULL), [])[1:3] AS class_qids,
   min(v_id) FILTER (pid = 'P21') AS gender_qid, min(v_id) FILTER (pid = 'P17') AS country_qid, min(v_time) FILTER (pid = 'P569') AS birth, min(v_time) FILTER (pid = 'P571') AS inception, min(v_time) FILTER (pid = 'P577') AS pub_date, min(v_time) FILTER (pid = 'P585') AS whn,
   min(v_str) FILTER (pid = 'P214') AS viaf, min(v_str) FILTER (pid = 'P1014') AS aat, min(v_lat) FILTER (pid = 'P625') AS lat, min(v_lon) FILTER (pid = 'P625') AS lon FROM claims GROUP BY qid""",
    "tr": """SELECT ma.*, CASE WHEN type = 'work' THEN author_qids ELSE [] END AS author_qids, CASE WHEN type IN ('material', 'technique', 'artwork') THEN class_qids ELSE [] END AS class_qids,
   CASE WHEN type = 'place' THEN class_qids ELSE [] END AS place_type_qids, CASE WHEN type = 'org' THEN class_qids ELSE [] END AS org_type_qids, CASE WHEN type = 'person' THEN gender_qid END AS gender_qid,
   CASE WHEN type = 'place' THEN country_qid END AS country_qid, CASE WHEN type = 'person' THEN birth END AS birth, CASE WHEN type = 'org' THEN inception END AS inception, CASE WHEN type = 'work' THEN pub_date END AS pub_date,
   CASE WHEN type = 'event' THEN whn END AS whn, CASE WHEN type = 'place' THEN lat END AS lat, CASE WHEN type = 'place' THEN lon END AS lon, viaf, aat FROM ma LEFT JOIN re ON wikidata_qid = re.qid""",
    "sq": "SELECT DISTINCT q AS qid FROM (SELECT unnest(list_concat(author_qids, class_qids, place_type_qids, org_type_qids, [gender_qid, country_qid])) AS q FROM tr WHERE match_confidence IN ('high', 'medium')) WHERE q IS NOT NULL",
    "labels_": ansi(LABELS),
    "lr": "SELECT sq.qid, CASE sq.qid WHEN 'Q6581097' THEN 'masculin' WHEN 'Q6581072' THEN 'féminin' ELSE coalesce(label, sq.qid) END AS label FROM sq LEFT JOIN labels_ ON sq.qid = labels_.qid",
    "done": f"SELECT 'person' AS type, {_norm('c_name')} AS label_norm FROM customer WHERE c_custkey % 2 = 0",
    "ids": "SELECT type AS file, register_id AS id FROM nu WHERE seq % 10 <> 0 UNION ALL SELECT type, register_id FROM nu WHERE seq % 7 = 0",
    "hr": "SELECT page_id, unnest(regexp_extract_all(html, '\\shref=\"([^\"]*)\"', 1)) AS href FROM pages",
    "mp": "SELECT DISTINCT href AS ner_uuid, 'reg-' || md5(href) AS register_id FROM hr WHERE NOT regexp_matches(href, '\\s') AND length(href) > 0 AND length(href) % 2 = 0",
}


def _with(body: str) -> str:
    """The body behind the expressions that it needs, found by name."""
    import re

    need, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name, sql in _CTE.items():
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                todo.append(sql)
    parts = [f"{n} AS {'MATERIALIZED ' if n in ('ev', 'cl', 'sc', 'pr', 'ca', 'kn') else ''}({s})" for n, s in _CTE.items() if n in need]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _bar(c: str) -> str:
    return f"array_to_string({c}, '|')"


_WORDS = "(SELECT DISTINCT word FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '')"
_FM, _FV = _fold("label"), _fold("v")
_LONG, _SHORT = f"greatest(length({_FM}), length({_FV}))", f"least(length({_FM}), length({_FV}))"
_CP = f"list_max(list_filter(range(0, {_SHORT} + 1), lambda n: left({_FM}, n) = left({_FV}, n)))"
_RELATED = f"""CASE WHEN {_FV} = '' OR {_FV} = {_FM} THEN false ELSE contains({_FM}, {_FV}) OR contains({_FV}, {_FM}) OR ({_CP} >= 4 AND {_CP} * 2 >= {_SHORT})
 OR ({_LONG} >= 4 AND levenshtein({_FM}, {_FV}) <= greatest(1, CAST(floor(0.34 * {_LONG}) AS INT))) OR (string_split({_FM}, ' ')[-1] = string_split({_FV}, ' ')[-1] AND length(string_split({_FM}, ' ')[-1]) >= 4) END"""
_MONTH = "CASE " + " ".join(f"WHEN contains(f, '{m}') THEN {i}" for i, m in enumerate(MONTHS, 1)) + " END"
_TIME = r"'^([+-]?)0*(\d+)-(\d\d)-(\d\d)'"
_FMT = f"""CASE WHEN regexp_extract(v_time, {_TIME}, 1) = '-' THEN '-' ELSE '' END || regexp_extract(v_time, {_TIME}, 2) || CASE WHEN regexp_extract(v_time, {_TIME}, 3) = '00' THEN '' WHEN regexp_extract(v_time, {_TIME}, 4) = '00' THEN '-' || regexp_extract(v_time, {_TIME}, 3)
 ELSE '-' || regexp_extract(v_time, {_TIME}, 3) || '-' || regexp_extract(v_time, {_TIME}, 4) END"""
_fmt = lambda c: f"CASE WHEN {c} IS NOT NULL THEN {_FMT.replace('v_time', c)} END"
_E = lambda x: f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_TRACE = "'        <note type=\"mentions\">' || mentions || '</note>' || chr(10) || '        <note type=\"sources\">' || array_to_string(source_docs, '|') || '</note>' || chr(10)"
_LINKED = "CASE WHEN match_confidence IS NULL THEN '' ELSE '        <note type=\"reconciliation-confidence\">' || match_confidence || '</note>' || chr(10) || CASE WHEN len(wikidata_alts) > 0 THEN '        <note type=\"wikidata-candidates\">' || array_to_string(wikidata_alts, '|') || '</note>' || chr(10) ELSE '' END END"
_SURE = "coalesce(match_confidence IN ('high', 'medium'), false)"


def _vtags(tag: str, indent: int) -> str:
    return f"array_to_string(list_transform(coalesce(vs, []), lambda v: '{' ' * indent}<{tag} type=\"variant\">' || {_E('v')} || '</{tag}>' || chr(10)), '')"


_VS = f"SELECT type, label_norm, list(v ORDER BY i) AS vs FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY type, label_norm ORDER BY i) AS n FROM (SELECT * FROM (SELECT type, label_norm, label, unnest(variants) AS v, unnest(range(len(variants))) AS i FROM cl) WHERE {_RELATED} QUALIFY row_number() OVER (PARTITION BY type, label_norm, {_FV} ORDER BY i) = 1)) WHERE n <= {_case('type', lambda p: p.cap)}) GROUP BY ALL"
_WD = "CASE WHEN " + _SURE + " AND {c} IS NOT NULL THEN {line} || chr(10) ELSE '' END"
_SURELY = lambda c, line: _WD.format(c=c, line=line)
_TEXT = lambda tag, c, attr="", indent=8: f"'{' ' * indent}<{tag}{attr}>' || {_E(c)} || '</{tag}>'"
_LABEL = lambda q: _E(f"coalesce(map_extract(lm, {q})[1], {q})")


def _pad(c: str) -> str:
    """A time as it stands in a date attribute."""
    part = lambda i: f"regexp_extract({c}, {_TIME}, {i})"
    return f"CASE WHEN {part(1)} = '-' THEN '-' ELSE '' END || lpad({part(2)}, CAST(greatest(4, length({part(2)})) AS INT), '0') || CASE WHEN {part(3)} = '00' THEN '' WHEN {part(4)} = '00' THEN '-' || {part(3)} ELSE '-' || {part(3)} || '-' || {part(4)} END"


def _names(tag: str, sort: bool, indent: int = 8) -> str:
    line = lambda x: f"{x} || chr(10)"
    first = line(_TEXT(tag, "label", ' type="main"', indent))
    if sort:
        first += " || " + line(_TEXT(tag, "coalesce(wikidata_label, label)", ' type="sort"', indent))
    return f"{first} || {_SURELY('wikidata_label', _TEXT(tag, 'wikidata_label', ' type=' + chr(34) + 'standard' + chr(34), indent))} || {_vtags(tag, indent)}"


def _one(tag: str, c: str, attr: str = "key") -> str:
    return _SURELY(c, f"'        <{tag} {attr}=\"' || {c} || '\">' || {_LABEL(c)} || '</{tag}>'")


def _many(tag: str, c: str) -> str:
    return f"CASE WHEN {_SURE} THEN array_to_string(list_transform({c}, lambda q: '        <{tag} key=\"' || q || '\">' || {_LABEL('q')} || '</{tag}>' || chr(10)), '') ELSE '' END"


def _ids(*kinds: str) -> str:
    own = _SURELY("wikidata_qid", "'        <idno type=\"wikidata\" cert=\"' || match_confidence || '\">' || wikidata_qid || '</idno>'")
    return " || ".join([own, *[_SURELY(k, f"'        <idno type=\"{k}\">' || {k} || '</idno>'") for k in kinds]])


def _dated(c: str, before: str, after: str) -> str:
    return _SURELY(c, f"'        {before}' || {_pad(c)} || '{after}'")


def _entry(tag: str, *parts: str) -> str:
    return f"'      <{tag} xml:id=\"' || register_id || '\" n=\"' || mentions || '\">' || chr(10) || {' || '.join(parts)} || '      </{tag}>'"


_NOTE = _SURELY("description", "'        <note type=\"description\">' || " + _E("description") + " || '</note>'")
_CATEGORY = _entry("category", "'        <catDesc>' || chr(10)", _names("term", False, 10), "'        </catDesc>' || chr(10)", _ids("aat"), _NOTE, _TRACE, _LINKED)
_XML = {
    "person": _entry("person", _names("persName", True), _dated("birth", '<birth><date when="', '"/></birth>'), _one("sex", "gender_qid", "value"), _ids("viaf"), _NOTE, _TRACE, _LINKED),
    "place": _entry("place", _names("placeName", True), _SURELY("lat", "'        <location><geo>' || printf('%.5f %.5f', lat, lon) || '</geo></location>'"), _one("country", "country_qid"), _ids(), _NOTE, _TRACE, _LINKED),
    "org": _entry("org", _names("orgName", True), _dated("inception", '<event type="foundation"><date when="', '"/></event>'), _ids("viaf"), _NOTE, _TRACE, _LINKED),
    "work": _entry("bibl", _names("title", False), _many("author", "author_qids"), _dated("pub_date", '<date type="publication" when="', '"/>'), _ids(), _NOTE, _TRACE, _LINKED),
    "event": _entry("event", _names("label", False), _dated("whn", '<date when="', '"/>'), _ids(), _TRACE, _LINKED),
    "artwork": _entry("object", _names("objectName", False), _many("objectType", "class_qids"), _ids("aat"), _NOTE, _TRACE, _LINKED),
    "material": _CATEGORY,
    "technique": _CATEGORY,
}
_DATE = f"""'      <item xml:id="' || register_id || '" n="' || mentions || '">' || chr(10) || '        <date' || CASE WHEN y = '' THEN '' WHEN m IS NULL THEN ' when="' || y || '"' ELSE ' when="' || y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '"' END || '>' || {_E('label')} || '</date>' || chr(10)
 || {_vtags('date', 8)} || {_TRACE} || '      </item>'"""
_YEAR = r"regexp_extract(f, '\b(1[4-7][0-9]{2})\b', 1)"

_BODY = {
    "q01_norm_label": f"SELECT word, {_norm('word')} AS label_norm FROM {_WORDS}",
    "q02_match_key": f"SELECT word, {_key('word')} AS match_key FROM {_WORDS}",
    "q03_id_type": f"SELECT '##' || ner_id AS ref, ner_id, {_type('ner_id')} AS type FROM (SELECT DISTINCT ner_id FROM raw)",
    "q04_entity_forms": "SELECT ner_id, type, form, cnt, first_seen FROM ef",
    "q05_best_label": "SELECT ner_id, label FROM bl",
    "q06_clusters": f"SELECT type, label_norm, label, mentions, n_variants, n_ner_ids, {_bar('variants')} AS variants, {_bar('ner_ids')} AS ner_ids, {_bar('source_docs')} AS source_docs FROM cl",
    "q07_cluster_summary": "SELECT type, count(*) AS clusters, CAST(sum(mentions) AS BIGINT) AS mentions, CAST(sum(n_ner_ids) AS BIGINT) AS ids FROM cl GROUP BY ROLLUP (type)",
    "q08_csv_projection": f"SELECT type, label, label_norm, mentions, n_ner_ids, len(source_docs) AS n_docs, n_variants, {_bar('source_docs')} AS source_docs, {_bar('ner_ids')} AS ner_ids FROM cl",
    "q09_work_list": "SELECT type, label_norm, label, mentions FROM cl WHERE mentions >= 3 AND type IN ('work', 'person', 'org') ORDER BY mentions DESC, type, lower(label) LIMIT 50",
    "q10_resume_antijoin": "SELECT type, label_norm, mentions FROM wl ANTI JOIN done USING (type, label_norm)",
    "q11_stage_plan": "SELECT type, label_norm, stage, query, lang FROM plan",
    "q12_candidates": "SELECT type, label_norm, stage, pos, qid, rank FROM ca",
    "q13_accept": "SELECT qid, array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN {_ACCEPT[p.type]} THEN '{p.type}' END" for p in PROFILES) + "], lambda x: x IS NOT NULL)), '|') AS types FROM pr",
    "q14_anachronism": "SELECT qid, CAST(birth_year AS BIGINT) AS birth_year, CAST(event_year AS BIGINT) AS event_year, coalesce(birth_year, -9999) <= 1660 AS person_ok, coalesce(event_year, -9999) <= 1700 AS event_ok FROM pr",
    "q15_similarity": "SELECT type, label_norm, qid, CAST(s0 AS BIGINT) AS sim FROM si WHERE sitelinks IS NOT NULL",
    "q16_fame_geo": f"SELECT qid, CAST(least(sitelinks, 60) AS BIGINT) AS fame, CAST({_GEO} AS BIGINT) AS geo, CAST(least(sitelinks, 60) + 12 * ({_GEO}) AS BIGINT) AS sf FROM pr",
    "q17_reconcile": "SELECT type, label_norm, wikidata_qid, CAST(sim AS BIGINT) AS sim, CAST(wikidata_sitelinks AS BIGINT) AS wikidata_sitelinks, stop FROM ma",
    "q18_confidence": "SELECT type, match_confidence, count(*) AS n FROM ma GROUP BY ALL",
    "q19_record": f"SELECT qid, {_bar('author_qids')} AS author_qids, {_bar('class_qids')} AS class_qids, gender_qid, country_qid, birth, inception, pub_date, viaf, aat, lat, lon FROM re",
    "q20_alternatives": f"SELECT type, label_norm, {_bar('wikidata_alts')} AS alternatives FROM ma",
    "q21_register_ids": "SELECT type, label_norm, register_id, seq FROM nu",
    "q22_id_mapping": "SELECT unnest(ner_ids) AS ner_uuid, register_id, type FROM nu",
    "q23_related_variants": f"SELECT type, label_norm, v AS variant, {_RELATED} AS related FROM (SELECT type, label_norm, label, unnest(variants) AS v FROM cl)",
    "q24_filtered_variants": f"SELECT type, label_norm, coalesce({_bar('vs')}, '') AS variants FROM cl LEFT JOIN ({_VS}) USING (type, label_norm)",
    "q25_date_norm": f"SELECT form, nullif(y, '') AS year, CAST(m AS BIGINT) AS month, CASE WHEN y = '' THEN NULL WHEN m IS NULL THEN y ELSE y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') END AS attribute FROM (SELECT form, {_YEAR} AS y, {_MONTH} AS m FROM (SELECT DISTINCT form, {_fold('form')} AS f FROM ev WHERE type = 'date'))",
    "q26_fmt_time": rf"SELECT v_time, t AS formatted, regexp_extract(t, '^(-?)', 1) || lpad(y, CAST(greatest(4, length(y)) AS INT), '0') || regexp_extract(t, '^-?\d+(.*)$', 1) AS padded, CAST(regexp_extract(t, '^(-?)', 1) || y AS BIGINT) AS year FROM (SELECT v_time, {_FMT} AS t, regexp_extract(v_time, {_TIME}, 2) AS y FROM (SELECT DISTINCT v_time FROM claims WHERE v_time IS NOT NULL))",
    "q27_register_xml": f"SELECT register_id, CASE type {' '.join(f'WHEN {t!r} THEN {x}' for t, x in _XML.items())} ELSE {_DATE} END AS xml FROM (SELECT nu.*, vs, tr.* EXCLUDE (type, label_norm), wikidata_label, description, lm, {_YEAR} AS y, {_MONTH} AS m FROM (SELECT *, {_fold('label')} AS f FROM nu) nu LEFT JOIN ({_VS}) USING (type, label_norm) LEFT JOIN tr USING (type, label_norm) LEFT JOIN dn ON wikidata_qid = dn.qid CROSS JOIN (SELECT map(list(qid), list(label)) AS lm FROM lr))",
    "q28_secondary_labels": "SELECT qid, label FROM lr",
    "q29_coverage": "SELECT type, coalesce(n, 0) AS entries, coalesce(k, 0) AS matched, CASE WHEN n > 0 THEN CAST(round_even(100.0 * k / n, 0) AS BIGINT) ELSE 0 END AS percent FROM (SELECT unnest(" + _list(p.type for p in PROFILES) + ") AS type) LEFT JOIN (SELECT cl.type, count(*) AS n, count(*) FILTER (match_confidence IN ('high', 'medium')) AS k FROM cl LEFT JOIN ma USING (type, label_norm) GROUP BY cl.type) USING (type)",
    "q30_match_sample": "SELECT type, nth, label, mentions, wikidata_qid FROM (SELECT cl.type, label, mentions, wikidata_qid, row_number() OVER (PARTITION BY cl.type ORDER BY mentions DESC, lower(label), cl.label_norm) AS nth FROM cl JOIN ma USING (type, label_norm) WHERE match_confidence = 'high') WHERE nth <= 12",
    "q33_duplicate_ids": "SELECT 'duplicate-id' AS \"check\", file AS subject, id AS detail FROM ids GROUP BY file, id HAVING count(*) > 1",
    "q34_mapping_check": "SELECT count(*) AS total, count(*) FILTER (id IS NULL) AS missing FROM (SELECT unnest(ner_ids) AS ner_uuid, register_id FROM nu) LEFT JOIN (SELECT DISTINCT id FROM ids) ON register_id = id",
    "q35_dangling_refs": "SELECT DISTINCT 'reference' AS \"check\", doc AS subject, ner_id AS detail FROM raw WHERE kind = 'mention' AND ner_id NOT IN (SELECT ner_id FROM ev WHERE type <> 'event') AND NOT (regexp_matches(ner_id, '-[0-9a-f]{8}-'))",
    "q36_cache_slim": f"SELECT CASE WHEN key LIKE 's::%' THEN 's' ELSE 'e2' END AS kind, count(*) AS kept, count(DISTINCT value) AS \"values\" FROM ({ansi(CACHE)}) WHERE regexp_matches(key, '^(s|e|e2)::') GROUP BY 1",
    "q37_purge_types": "SELECT type, label_norm, mentions FROM cl WHERE type NOT IN ('material', 'technique', 'artwork', 'event')",
    "q38_typed_mentions": f"SELECT ner_id, type, mentions, {_bar('docs')} AS docs, first_seen, canon FROM en",
    "q39_kb_profile": f"SELECT qid, {_bar('list_sort(list(DISTINCT pid))')} AS pids, coalesce({_bar('list_sort(list(DISTINCT v_id) FILTER (pid = ' + chr(39) + 'P31' + chr(39) + '))')}, '') AS p31 FROM claims GROUP BY qid",
    "q40_display_names": "SELECT qid, wikidata_label, description FROM dn",
    "q41_cluster_left_reconciled": f"SELECT nu.type, nu.label_norm, register_id, CASE WHEN {_SURE} THEN wikidata_qid END AS asserted_qid, CASE WHEN {_SURE} THEN wikidata_label END AS asserted_label, match_confidence FROM nu LEFT JOIN ma USING (type, label_norm) LEFT JOIN dn ON wikidata_qid = dn.qid",
    "q42_missing_labels": "SELECT qid FROM sq ANTI JOIN labels_ USING (qid)",
    "q43_merge_results": "SELECT type, source, count(*) AS records, count(q) AS matched FROM (SELECT type, label_norm, NULL AS source, wikidata_qid AS q FROM ma UNION ALL SELECT type, label_norm, 'old', NULL FROM (SELECT DISTINCT type, label_norm FROM done) ANTI JOIN ma USING (type, label_norm)) GROUP BY type, source",
    "q44_ref_extract": "SELECT page_id, href, count(*) AS n FROM hr GROUP BY ALL",
    "q45_first_failures": "SELECT * FROM (SELECT 'duplicate-id' AS \"check\", file AS subject, id AS detail, row_number() OVER (ORDER BY file, id) AS nth FROM ids GROUP BY file, id HAVING count(*) > 1) WHERE nth <= 5",
    "q46_ordered_clusters": f"SELECT type, label, mentions, {_bar('variants[1:5]')} AS top_variants, {_bar('source_docs[1:5]')} AS first_docs FROM cl",
}
_BODY["q47_cache_statistics"] = f"SELECT CASE WHEN key LIKE 's::%' THEN 's' ELSE 'e2' END AS kind, count(*) AS kept, CAST(sum(strlen(key) + strlen(value) + CASE WHEN key LIKE 'e::%' THEN 1 ELSE 0 END) AS BIGINT) AS bytes FROM ({ansi(CACHE)}) WHERE regexp_matches(key, '^(s|e|e2)::') GROUP BY 1"
_BODY["q48_totals"] = "SELECT (SELECT count(DISTINCT doc) FROM raw) AS files, (SELECT count(*) FROM en) AS entities, count(*) AS clusters, CAST(sum(n_ner_ids) AS BIGINT) AS ids, count(DISTINCT type) AS types FROM cl"
_BODY["q49_unknown_targets"] = "SELECT 'mapping' AS \"check\", unnest(ner_ids) AS subject, register_id AS detail FROM nu WHERE seq % 10 = 0"
_BODY["q50_typed_records"] = f"SELECT type, label_norm, wikidata_qid, {', '.join(f'{_bar(c)} AS {c}' for c in ('author_qids', 'class_qids', 'place_type_qids', 'org_type_qids'))}, gender_qid, country_qid, {', '.join(f'{_fmt(c)} AS {chr(34)}{n}{chr(34)}' for c, n in (('birth', 'birth'), ('inception', 'inception'), ('pub_date', 'pub_date'), ('whn', 'when')))}, lat, lon, aat, viaf FROM tr"
_BODY["q51_match_names"] = f"SELECT qid, {_bar('keys')} AS keys, has_auth, has_aat FROM pr"
_BODY["q32_rewrite_counts"] = "SELECT file, CAST(sum(n) AS BIGINT) AS changed FROM (SELECT page_id AS file, (SELECT count(*) FROM (SELECT unnest(regexp_extract_all(html, '\\shref=\"([^\"]*)\"', 1)) AS h) WHERE h IN (SELECT ner_uuid FROM mp)) AS n FROM pages) GROUP BY ROLLUP (file)"
_BODY["q31_rewrite_refs"] = """SELECT file, i - 1 AS line_no, md5(array_to_string(list_transform(range(1, len(gaps) + 1), lambda j: gaps[j] || coalesce(done[j], '')), '')) AS new_md5, len(list_filter(hits, lambda h: len(map_extract(m, h)) > 0)) AS changed FROM (
 SELECT *, list_transform(range(1, len(hits) + 1), lambda j: heads[j] || '#' || coalesce(map_extract(m, hits[j])[1], hits[j]) || '"') AS done FROM (
  SELECT file, i, m, string_split_regex(line, '\\shref="#[^"]*"') AS gaps, regexp_extract_all(line, '(\\shref=")#([^"]*)"', 2) AS hits, regexp_extract_all(line, '(\\shref=")#([^"]*)"', 1) AS heads FROM (
   SELECT file, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT page_id AS file, string_split(replace(html, 'href="', 'href="#'), chr(10)) AS ls FROM pages)), (SELECT map(list(ner_uuid), list(register_id)) AS m FROM mp)))"""

ORACLES = {name: _with(sql) for name, sql in sorted(_BODY.items())}
