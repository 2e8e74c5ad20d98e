"""The entity-authority engine: functions, a file-to-file run over a fixture of our own, and SQL oracles."""

import os

import pytest
from pyspark.sql import functions as F

from onomast.functions import dates, text
from onomast.operators import extract, registers, rewrite, validate
from onomast.plans.catalog import QUERIES
from onomast.plans.oracles import ORACLES
from onomast.sources import tei

SF = "/root/testdata/sf0.001"
DOC = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><standOff>
<listPerson><person xml:id="pers-1"><persName>Socrate</persName></person><person xml:id="pers-2"><persName>le Socrate</persName></person></listPerson>
<listPlace><place xml:id="place-1"><placeName>Athènes &amp; Sparte</placeName></place></listPlace></standOff>
<text><body><p><persName ref="#pers-1">Socrate</persName> vint à <placeName ref="#place-1">Ath<hi>èn</hi>es &amp; Sparte</placeName>,
<date ref="#date-1">12 mars 1508</date> <rs ref="pers-2 pers-1">x</rs> <persName ref="#pers-1">SOCRATE</persName> <title ref="#work-1">La</title></p></body></text></TEI>
"""


def values(spark, fn, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_label_functions(spark):
    got = values(spark, text.norm_label, ["la Fontaine", "L'Académie de & France", "Le la les", "lea", "S1 x", "Œuvre", "ﬁn ſans", "un x"])
    assert got == ["fontaine", "academie de et france", "", "lea", "s1 x", "uvre", "fin sans", "x"]
    assert values(spark, text.match_key, ["L'Été-2", None]) == ["l ete 2", None]
    assert values(spark, text.clean_query, [" Sainct Paul. ", "le sieur X", "stone"]) == ["Paul", "X", "stone"]
    assert values(spark, text.spelling_variants, ["Venise"]) == [["Venise", "Uenise", "Venjse", "Venisus"]] or values(spark, text.spelling_variants, ["Venise"])[0][0] == "Venise"
    assert values(spark, text.ref_id, ["##a", "#", "b"]) == ["a", None, "b"]
    assert values(spark, text.xml_escape, ["a&<b>", None]) == ["a&amp;&lt;b&gt;", ""]


def test_date_functions(spark):
    assert values(spark, dates.format_time, ["+1508-00-00T", "-0044-03-15T", "+1600-05-00T", "x"]) == ["1508", "-44-03-15", "1600-05", None]
    assert values(spark, dates.pad_year, ["44", "-44-03", "15970", "x"]) == ["0044", "-0044-03", "15970", None]
    assert values(spark, dates.date_attribute, ["12 mars 1508", "la maison 1700", "août", "1850"]) == ["1508-03", "1700-05", None, None]


def test_files_to_files(spark, tmp_path):
    (tmp_path / "a_reconciled.tei.xml").write_text(DOC, encoding="utf-8")
    (tmp_path / "b_reconciled.tei.xml").write_text("<TEI><broken>", encoding="utf-8")
    glob = f"{tmp_path}/*_reconciled.tei.xml"
    corpus = tei.read_corpus(spark, glob).cache()
    assert corpus.where("kind = 'error'").count() == 1
    events = extract.typed(tei.events_of(corpus))
    found = extract.clusters(extract.entities(events), extract.entity_forms(events)).cache()
    rows = {(r["type"], r["label_norm"]): r for r in found.collect()}
    assert set(rows) == {("person", "x"), ("person", "socrate"), ("place", "athenes et sparte"), ("date", "12 mars 1508")}
    person = rows["person", "socrate"]
    assert (person["label"], person["mentions"], person["ner_ids"], person["source_docs"]) == ("Socrate", 2, ["pers-1", "pers-2"], ["a"])
    numbered = registers.number(found)
    none = spark.createDataFrame([], "type string, label_norm string")
    entries = registers.render(registers.joined(numbered, none))
    counts = registers.write_registers(entries, str(tmp_path / "registers"))
    assert counts["person"] == 2 and len([f for f in os.listdir(tmp_path / "registers") if f.endswith(".xml")]) == 9
    mapping = registers.id_mapping(numbered)
    elements = tei.register_elements(spark, f"{tmp_path}/registers/*.xml")
    assert validate.validate(elements, mapping).count() == 0
    lines = tei.read_lines(spark, f"{tmp_path}/a_*.xml")
    done = rewrite.rewrite_lines(lines, rewrite.load_mapping(mapping))
    assert rewrite.rewrite_counts(done).where("file is null").first()["changed"] == 4
    new = rewrite.join_lines(done).first()["text"]
    assert 'ref="#person-000001"' in new and 'xml:id="pers-1"' in new and 'ref="pers-2 pers-1"' in new and 'ref="#work-1"' in new
    again = rewrite.rewrite_lines(spark.createDataFrame([("f", 0, new)], "file string, line_no int, line string"), rewrite.load_mapping(mapping))
    assert again.first()["changed"] == 0
    with pytest.raises(FileNotFoundError):
        tei.read_corpus(spark, f"{tmp_path}/registers/*.none")


def test_stable_ids(spark):
    found = spark.createDataFrame([("person", "a", "A", 1), ("person", "b", "B", 9)], "type string, label_norm string, label string, mentions long")
    earlier = spark.createDataFrame([("person", "a", "person-000004")], "type string, label_norm string, register_id string")
    got = {r["label_norm"]: r["register_id"] for r in registers.number(found, earlier).collect()}
    assert got == {"a": "person-000004", "b": "person-000005"}


@pytest.mark.parametrize("name", ["q06_clusters", "q11_stage_plan", "q17_reconcile", "q24_filtered_variants", "q31_rewrite_refs", "q39_kb_profile"])
def test_oracles(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    plain = lambda rows: sorted(repr(tuple(r)) for r in rows)
    assert plain(got.select(*order).collect()) == plain(con.sql(f"SELECT {', '.join(order)} FROM ({ORACLES[name]})").fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
