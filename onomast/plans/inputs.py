"""Mentions and a knowledge base derived from the driver's tables, in SQL that Spark and DuckDB read alike.

These are inputs, not operators: they give the operators something to work on that an oracle can see too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


def _seq(doc: str, k: str, pas: int = 1) -> str:
    return f"({doc} % 50 * 2 + {pas}) * 1000000000000000 + {k}"


def _doc(key: str) -> str:
    return f"'DOC' || lpad(CAST({key} % 50 AS STRING), 2, '0')"


EVENTS = f"""
SELECT {_doc('l_orderkey')} AS doc, 'mention' AS kind, 'work-' || CAST(l_partkey AS STRING) AS ner_id,
  CASE l_linenumber % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(substr(p_name, 1, 1)) || substr(p_name, 2) WHEN 2 THEN 'le ' || p_name ELSE upper(p_name) END AS form,
  {_seq('l_orderkey', '(l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey')} AS seq
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
UNION ALL SELECT {_doc('p_partkey')}, 'def', 'work-' || CAST(p_partkey AS STRING), p_name, {_seq('p_partkey', 'p_partkey', 0)} FROM {{part}}
UNION ALL SELECT {_doc('o_orderkey')}, 'mention', 'pers-' || CAST(o_custkey AS STRING), c_name, {_seq('o_orderkey', 'o_orderkey')} FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
UNION ALL SELECT {_doc('l_orderkey')}, 'mention', 'org-' || CAST(l_suppkey AS STRING), s_name, {_seq('l_orderkey', 'l_orderkey * 10 + l_linenumber')} FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey
UNION ALL SELECT {_doc('c_custkey')}, 'mention', 'place-' || CAST(c_nationkey AS STRING), n_name, {_seq('c_custkey', 'c_custkey')} FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
UNION ALL SELECT {_doc('p_partkey')}, 'mention', 'mat-' || CAST(p_partkey AS STRING), p_type, {_seq('p_partkey', 'p_partkey')} FROM {{part}}
UNION ALL SELECT {_doc('p_partkey')}, 'mention', 'artwork-' || CAST(p_partkey AS STRING), p_type, {_seq('p_partkey', 'p_partkey')} FROM {{part}} WHERE p_partkey % 3 = 0
UNION ALL SELECT {_doc('p_partkey')}, 'mention', 'tech-' || CAST(p_partkey AS STRING), p_brand, {_seq('p_partkey', 'p_partkey')} FROM {{part}} WHERE p_partkey % 5 = 0
UNION ALL SELECT {_doc('event_id')}, 'mention', 'event-' || CAST(user_id AS STRING), event_type, {_seq('event_id', 'event_id')} FROM {{events}}
UNION ALL SELECT {_doc('o_orderkey')}, 'mention', 'date-' || CAST(o_custkey AS STRING),
  'le ' || CAST(day(o_orderdate) AS STRING) || ' ' || CASE month(o_orderdate) WHEN 1 THEN 'janvier' WHEN 2 THEN 'février' WHEN 3 THEN 'mars' WHEN 4 THEN 'avril' WHEN 5 THEN 'mai' WHEN 6 THEN 'juin' WHEN 7 THEN 'juillet' WHEN 8 THEN 'août' WHEN 9 THEN 'septembre' WHEN 10 THEN 'octobre' WHEN 11 THEN 'novembre' ELSE 'décembre' END || ' ' || CAST(year(o_orderdate) - 400 AS STRING),
  {_seq('o_orderkey', 'o_orderkey')} FROM {{orders}}
UNION ALL SELECT {_doc('o_orderkey')}, 'mention', 'xx-' || CAST(o_orderkey AS STRING), o_orderpriority, {_seq('o_orderkey', 'o_orderkey')} FROM {{orders}} WHERE o_orderkey % 10 = 0
"""


def _q(base: int, key: str) -> str:
    return f"'Q' || CAST({base} + {key} AS STRING)"


KB_NAMES = f"""
SELECT {_q(1000000, 'p_partkey')} AS qid, 'fr' AS lang, 'label' AS kind, 0 AS ord, p_name AS value FROM {{part}}
UNION ALL SELECT {_q(1000000, 'p_partkey')}, 'la', 'alias', 0, upper(p_name) || ' ' || p_brand FROM {{part}} WHERE p_partkey % 2 = 0
UNION ALL SELECT {_q(1000000, 'p_partkey')}, 'en', 'description', 0, p_type FROM {{part}}
UNION ALL SELECT {_q(2000000, 'c_custkey')}, 'la', 'label', 0, c_name FROM {{customer}}
UNION ALL SELECT {_q(2000000, 'c_custkey')}, 'fr', 'alias', 0, lower(c_name) FROM {{customer}} WHERE c_custkey % 3 = 0
UNION ALL SELECT {_q(2500000, 'c_custkey')}, 'fr', 'label', 0, c_name || ' ' || c_mktsegment FROM {{customer}} WHERE c_custkey % 5 = 0
UNION ALL SELECT {_q(2500000, 'c_custkey')}, 'fr', 'alias', 0, c_name FROM {{customer}} WHERE c_custkey % 5 = 0
UNION ALL SELECT {_q(3000000, 'n_nationkey')}, 'fr', 'label', 0, n_name FROM {{nation}}
UNION ALL SELECT {_q(3000000, 'n_nationkey')}, 'it', 'description', 0, 'nazione ' || lower(n_name) FROM {{nation}}
UNION ALL SELECT {_q(4000000, 's_suppkey')}, 'en', 'label', 0, s_name FROM {{supplier}}
UNION ALL SELECT {_q(6000000, 'min(p_partkey)')}, 'fr', 'label', 0, p_type FROM {{part}} GROUP BY p_type
UNION ALL SELECT {_q(5000000, 'min(event_id)')}, 'la', 'label', 0, event_type FROM {{events}} GROUP BY event_type
"""


def _claims(qid: str, pid: str, table: str, where: str = "true", ord_: str = "0", id_: str = "NULL", text: str = "NULL", time: str = "NULL", lat: str = "NULL", lon: str = "NULL", group: str = "") -> str:
    c = lambda x, t: f"CAST({x} AS {t})"
    return f"SELECT {qid} AS qid, '{pid}' AS pid, {ord_} AS ord, {c(id_, 'STRING')} AS v_id, {c(text, 'STRING')} AS v_str, {c(time, 'STRING')} AS v_time, {c(lat, 'DOUBLE')} AS v_lat, {c(lon, 'DOUBLE')} AS v_lon FROM {{{table}}} WHERE {where} {group}"


_W, _P, _P2, _N, _O = _q(1000000, "p_partkey"), _q(2000000, "c_custkey"), _q(2500000, "c_custkey"), _q(3000000, "n_nationkey"), _q(4000000, "s_suppkey")
_M, _E = _q(6000000, "min(p_partkey)"), _q(5000000, "min(event_id)")
KB_CLAIMS = " UNION ALL ".join([
    _claims(_W, "P31", "part", id_="'Q571'"),
    _claims(_W, "P50", "part", "p_partkey % 3 <> 0", id_=_q(2000000, "p_partkey % 100")),
    _claims(_W, "P50", "part", "p_partkey % 4 = 0", "1", id_=_q(2000000, "p_partkey % 90")),
    _claims(_W, "P577", "part", "p_partkey % 5 = 0", time="'+' || CAST(1500 + p_partkey % 200 AS STRING) || '-00-00T00:00:00Z'"),
    _claims(_W, "P214", "part", "p_partkey % 7 = 0", text="CAST(p_partkey AS STRING)"),
    _claims(_W, "P136", "part", "p_partkey % 6 = 0"),
    _claims(_P, "P31", "customer", "c_custkey % 4 <> 0", id_="'Q5'"),
    _claims(_P, "P569", "customer", "c_custkey % 3 <> 1", time="CASE WHEN c_custkey % 11 = 0 THEN '-0' ELSE '+' END || CAST(1400 + c_custkey % 400 AS STRING) || '-0' || CAST(c_custkey % 9 AS STRING) || '-' || lpad(CAST(c_custkey % 28 AS STRING), 2, '0') || 'T00:00:00Z'"),
    _claims(_P, "P21", "customer", "true", id_="CASE WHEN c_custkey % 2 = 0 THEN 'Q6581097' ELSE 'Q6581072' END"),
    _claims(_P2, "P31", "customer", "c_custkey % 5 = 0", id_="'Q5'"),
    _claims(_N, "P17", "nation", "n_nationkey % 3 <> 2", id_="CASE WHEN n_nationkey % 3 = 0 THEN 'Q142' ELSE 'Q30' END"),
    _claims(_N, "P625", "nation", "n_nationkey % 2 = 0", lat="n_nationkey * 2.5", lon="n_nationkey * -1.25"),
    _claims(_O, "P571", "supplier", "s_suppkey % 2 = 0", time="'+' || CAST(1300 + s_suppkey % 300 AS STRING) || '-06-00T00:00:00Z'"),
    _claims(_O, "P569", "supplier", "s_suppkey % 3 = 0", time="'+1500-01-01T00:00:00Z'"),
    _claims(_O, "P31", "supplier", "true", id_="'Q43229'"),
    _claims(_M, "P31", "part", id_="'Q214609'", group="GROUP BY p_type"),
    _claims(_M, "P1014", "part", text="CAST(300000000 + min(p_partkey) AS STRING)", group="GROUP BY p_type HAVING length(p_type) % 2 = 0"),
    _claims(_E, "P585", "events", time="'+' || CAST(1680 + length(event_type) * 3 AS STRING) || '-10-02T00:00:00Z'", group="GROUP BY event_type"),
])
KB_BASE = f"""
SELECT {_W} AS qid, CAST(p_size AS INT) AS sitelinks FROM {{part}}
UNION ALL SELECT {_P}, CAST(c_custkey % 70 AS INT) FROM {{customer}}
UNION ALL SELECT {_P2}, CAST(c_custkey % 30 AS INT) FROM {{customer}} WHERE c_custkey % 10 = 0
UNION ALL SELECT {_N}, CAST(2 + n_nationkey AS INT) FROM {{nation}}
UNION ALL SELECT {_O}, CAST(s_suppkey % 12 AS INT) FROM {{supplier}}
UNION ALL SELECT {_M}, 12 FROM {{part}} GROUP BY p_type
UNION ALL SELECT {_E}, 8 FROM {{events}} GROUP BY event_type
"""
#: Display labels that are known already.
LABELS = f"SELECT {_P} AS qid, 'Auteur ' || c_name AS label FROM {{customer}} WHERE c_custkey % 2 = 0 UNION ALL SELECT 'Q142', 'France' FROM {{region}} WHERE r_regionkey = 0"
#: A response cache.
CACHE = "SELECT CASE user_id % 6 WHEN 0 THEN 's::fr::' WHEN 1 THEN 'e::' WHEN 2 THEN 'e2::' WHEN 3 THEN 'g::' WHEN 4 THEN 'g2::' ELSE 'x' END || CAST(event_id AS STRING) AS key, event_type AS value FROM {events}"


def read(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def ansi(sql: str) -> str:
    """The same for DuckDB, where the tables are views."""
    return sql.format(**{t: t for t in TABLES})
