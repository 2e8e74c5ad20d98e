"""Files to files through the command line, with a knowledge base; readers of missing and broken files; streaming refresh; folds."""

import json
import os
import unicodedata
from xml.etree import ElementTree

from pyspark.sql import functions as F

from onomast import cli
from onomast.functions import text
from onomast.operators import extract, registers
from onomast.sources import files, kb
from onomast.streaming import corpus

NAMES = {"pers": "persName", "place": "placeName", "org": "orgName", "work": "title", "mat": "material", "date": "date", "tech": "rs", "event": "rs", "artwork": "objectName"}
LABELS = {"pers": "Théodore Valmont", "place": "Port Clair", "org": "Guilde des Tisserands", "work": "Le Traité du Vent", "mat": "albâtre", "date": "3 juin 1622", "tech": "gravure", "event": "Siège de Brisac", "artwork": "Vase bleu"}


def write_corpus(folder):
    body = "\n".join(f'<p>de <{t} ref="#{k}-1">{LABELS[k]}</{t}> et <{t} ref="#{k}-2">{LABELS[k].upper()}</{t}></p>' for k, t in NAMES.items())
    (folder / "a_reconciled.tei.xml").write_bytes(f'<TEI xmlns="http://www.tei-c.org/ns/1.0"><standOff><listPerson><person xml:id="pers-1"><persName>Théodore Valmont</persName></person></listPerson></standOff><text><body>\r\n{body}\n<p><persName ref="#pers-9">Inconnue</persName></p></body></text></TEI>'.encode())
    (folder / "b_reconciled.tei.xml").write_text('<TEI><text><rs ref="#zz-1">x</rs></text></TEI>\n', encoding="utf-8")


def entity(qid, label, claims, n, alias=()):
    snak = lambda v: {"mainsnak": {"datavalue": {"value": v}}}
    return {"qid": qid, "labels": {"fr": {"value": label}}, "descriptions": {"fr": {"value": f"desc {qid}"}}, "aliases": {"la": [{"value": a} for a in alias]}, "claims": {p: [snak(v) for v in vs] for p, vs in claims.items()}, "sitelinks": {str(i): "x" for i in range(n)}}


def test_command_line(spark, tmp_path, capsys):
    write_corpus(tmp_path)
    raw = [
        entity("Q1", "Théodore Valmont", {"P31": [{"id": "Q5"}], "P569": [{"time": "+1590-00-00T00:00:00Z"}], "P106": [{"id": "Q77"}], "P214": ["123"], "P999": ["no"]}, 9),
        entity("Q2", "Port Clair", {"P625": [{"latitude": 1.5, "longitude": 2.0}], "P17": [{"id": "Q142"}]}, 30),
        entity("Q3", "albâtre", {"P31": [{"id": "Q8"}]}, 40),
    ]
    (tmp_path / "kb.jsonl").write_text("\n".join(map(json.dumps, raw)), encoding="utf-8")
    env = {"TEI_GLOB": f"{tmp_path}/*_reconciled.tei.xml", "NER_OUT": f"{tmp_path}/ner", "REGISTERS_DIR": f"{tmp_path}/reg", "KB_PATH": f"{tmp_path}/kb.jsonl", "CORPUS_NAME": "Essai & Co"}
    run = lambda *a: (cli.main(list(a), spark, env), capsys.readouterr().out)
    assert run("extract")[1].split("\n")[:2] == ["files 2", "entities 19"]
    found = json.load(open(tmp_path / "ner" / files.CLUSTERS_FILE, encoding="utf-8"))
    assert len({c["type"] for c in found}) == 9 and [c["label"] for c in found if c["type"] == "person"] == ["Théodore Valmont", "Inconnue"]
    assert "matched 3" in run("reconcile")[1]
    records = {r["label"]: r for r in json.load(open(tmp_path / "ner" / files.RECONCILED_FILE, encoding="utf-8"))}
    assert records["Théodore Valmont"]["birth"] == "1590" and records["Théodore Valmont"]["viaf"] == "123" and "lat" not in records["Théodore Valmont"]
    assert records["albâtre"]["match_confidence"] == "low" and "wikidata_qid" not in records["Inconnue"]
    assert "records 9" in run("reconcile")[1]  # all done: the same
    run("registers")
    assert len([f for f in os.listdir(tmp_path / "reg") if f.endswith(".xml")]) == 9
    persons = ElementTree.parse(tmp_path / "reg" / "persons.xml").getroot()
    assert [e.get("{http://www.w3.org/XML/1998/namespace}id") for e in persons.iter() if e.tag.endswith("}person")] == ["person-000001", "person-000002"]
    assert "Essai &amp; Co" in (tmp_path / "reg" / "persons.xml").read_text(encoding="utf-8")
    rows = (tmp_path / "reg" / files.MAPPING_FILE).read_text().split()
    assert rows[0] == "ner_uuid,register_id,type" and rows[1:] == sorted(rows[1:]) and len(rows) == 20
    assert "Q1" in (tmp_path / "ner" / files.REPORT_FILE).read_text(encoding="utf-8")
    doc = tmp_path / "a_reconciled.tei.xml"
    before = doc.read_bytes()
    both = [str(doc), str(tmp_path / "b_reconciled.tei.xml")]
    assert run("rewrite", "--dry-run", *both)[1].split("\n")[:3] == ["COUNT 19 a_reconciled.tei.xml", "COUNT 0 b_reconciled.tei.xml", "TOTAL 19"]
    assert doc.read_bytes() == before
    run("rewrite", "--out", str(tmp_path / "out"), *both)
    assert doc.read_bytes() == before and (tmp_path / "out" / "b_reconciled.tei.xml").read_bytes() == (tmp_path / "b_reconciled.tei.xml").read_bytes()
    run("rewrite", *both)
    after = doc.read_bytes()
    assert after == (tmp_path / "out" / "a_reconciled.tei.xml").read_bytes() and b'xml:id="pers-1"' in after and b"<body>\r\n" in after
    assert b'ref="#work-000001"' in after and b"#pers-" not in after
    assert run("rewrite", *both)[1].endswith("TOTAL 0\n")
    assert run("validate", f"{tmp_path}/reg", "--docs", str(doc))[0] == 0
    assert run("validate", f"{tmp_path}/reg", "--docs", f"{tmp_path}/none*.xml")[0] == 1 and run("validate", f"{tmp_path}/gone")[0] == 1
    assert "matched 3" in run("finalize")[1]


def test_missing_and_broken_files_give_nothing(spark, tmp_path):
    assert files.read_reconciled(spark, f"{tmp_path}/none.json").count() == 0 and kb.read_raw(spark, f"{tmp_path}/none").count() == 0
    (tmp_path / "bad.json").write_text('[{"type": "person"')
    (tmp_path / "kb.jsonl").write_text('{"qid": "Q1"}\n{"qid": ')
    assert files.read_reconciled(spark, f"{tmp_path}/bad.json").count() == 0 and kb.read_raw(spark, f"{tmp_path}/kb.jsonl").count() == 0
    (tmp_path / "two.json").write_text(json.dumps([{"type": "a", "label_norm": "x", "label": k} for k in "12"] + [{"type": "b", "label_norm": "x"}]))
    assert {(r["type"], r["label"]) for r in files.read_reconciled(spark, f"{tmp_path}/two.json").collect()} == {("a", "2"), ("b", None)}


def test_numbers_follow_the_order_across_partitions(spark):
    rows = [(t, f"l{i:03d}", f"L{i:03d}", i * 7 % 5) for t in ("person", "place") for i in range(200)]
    got = registers.number(spark.createDataFrame(rows, "type string, label_norm string, label string, mentions long").repartition(7)).collect()
    for t in ("person", "place"):
        mine = sorted((r for r in got if r["type"] == t), key=lambda r: (-r["mentions"], r["label"].lower()))
        assert [r["seq"] for r in mine] == list(range(1, 201)) and mine[9]["register_id"] == f"{t}-000010"


def test_folds_of_latin_characters(spark):
    chars = [chr(cp) for cp in [*range(0x20, 0x370), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0xFB00, 0xFB07)]]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(chars)), "i int, c string").orderBy("i").select(text.strip_diacritics(F.col("c"))).collect()]
    want = ["".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x)) for ch in chars]
    assert [(a, b) for a, b in zip(got, want) if a != b and not unicodedata.category(b or "x").startswith("M")] == []


def test_refresh_of_changed_clusters_equals_all(spark):
    ev = lambda rows: spark.createDataFrame(rows, corpus.EVENT)
    first = [("d", "mention", f"pers-{i}", f"Name{i % 4}", i) for i in range(12)]
    new = [("e", "mention", "pers-1", "Other", 100 + i) for i in range(5)] + [("e", "mention", "pers-30", "Name2", 200)]
    before, all_ = extract.typed(ev(first)), extract.typed(ev(first + new))
    changed = corpus.affected(all_, ev(new), before)
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(corpus.refresh(all_, corpus.refresh(before), changed)) == plain(corpus.refresh(all_))
