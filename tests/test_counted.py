"""Clusters from counted events against clusters from entities and forms."""

from pyspark.sql import functions as F

from onomast.functions import text
from onomast.operators import extract
from onomast.plans import catalog
from onomast.profiles import PROFILES, type_of_id, type_of_prefix

EVENT = "doc string, kind string, ner_id string, form string, seq long"


def test_counted_clusters_equal_those_of_entities(spark):
    """More than 64 documents (two blocks at least), a null document, empty and null forms, unknown prefixes, ids with one key."""
    rows = [(f"d{i:03}", "mention", f"pers-{i % 7}", ["Socrate", "le Socrate", "", None, "Zénon"][i % 5], i) for i in range(300)]
    rows += [(None, "mention", "pers-1", "Socrate", 300), ("d000", "def", "pers-2", "Socrate", 301), ("d001", "mention", "xx-1", "a", 302), ("d002", "mention", "date-1", "", 303)]
    events = spark.createDataFrame(rows, EVENT)
    known = extract.typed(events)
    want = extract.clusters(extract.entities(known), extract.entity_forms(known))
    got = extract.clusters_of(*extract.counted(events))
    plain = lambda df: sorted(map(repr, df.collect()))
    assert plain(got) == plain(want) and want.count() == 2
    blocks = {r["block"] for r in extract.counted(events)[1].select("block").collect()}
    assert len(blocks) >= 5


def test_type_of_id_is_that_of_its_prefix(spark):
    ids = [*[f"{p.prefix}-1" for p in PROFILES], "pers", "PERS-1", "xpers-1", "pers1-1", "", None, "mat-", "xx-1"]
    got = spark.createDataFrame([(x,) for x in ids], "x string").select(type_of_id(F.col("x")).alias("a"), type_of_prefix(text.entity_prefix(F.col("x"))).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]


def test_label_score_of_starts(spark):
    """The shortcut for ASCII starts gives what the regex gives."""
    forms = ["Abc", "abc", "Zbc", "[bc", "@bc", "Ébc", "ébc", "", "1bc", "Ωbc", "ſbc", "Z"]
    df = spark.createDataFrame([(x,) for x in forms], "x string")
    plain = F.col("x").rlike(r"^\p{Lu}")
    base = lambda up: text.label_score(F.col("x"), F.lit(0)) - F.when(up, 3).otherwise(0)
    rest = {r["x"]: r["s"] for r in df.select("x", base(plain).alias("s")).collect()}
    bonus = lambda x: (" " in x) * 2 + (len(x) >= 4) - 5 * (len(x) <= 2) - 2 * (x == x.lower() and x != x.upper() and len(x) < 5)
    assert rest == {x: bonus(x) for x in forms}


def test_clusters_are_made_once(spark, monkeypatch):
    """A query that reads the numbered clusters several times makes them once."""
    made = []
    own = catalog._clusters
    monkeypatch.setattr(catalog, "_clusters", lambda s, d: made.append(d) or own(s, d))
    catalog.QUERIES["q34_mapping_check"](spark, "/root/testdata/sf0.001")
    assert len(made) == 1
