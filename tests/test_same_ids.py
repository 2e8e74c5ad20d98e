"""A knowledge base in which several rows claim one id, as larger tables of the driver have it: results against SQL."""

import os

import pytest

from onomast.operators.reconcile import display_names
from onomast.plans.catalog import QUERIES
from onomast.plans.oracles import ORACLES
from onomast.sources.kb import profile

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """The smallest tables, parts and customers repeated so that their entity numbers meet those of customers and nations."""
    import duckdb

    folder, con = tmp_path_factory.mktemp("same-ids"), duckdb.connect()
    for f in os.listdir(SF):
        os.symlink(f"{SF}/{f}", folder / f)
    for name, key, shift in (("part", "p_partkey", 1000000), ("customer", "c_custkey", 500000)):
        (folder / f"{name}.parquet").unlink()
        rows = f"SELECT * FROM '{SF}/{name}.parquet'"
        con.sql(f"COPY ({rows} UNION ALL SELECT * REPLACE ({key} + {shift} AS {key}) FROM ({rows})) TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", ["q13_accept", "q19_record"])
def test_rows_of_one_id(spark, tables, name):
    import duckdb

    con = duckdb.connect(config={"threads": 1})  # its lists are in table order then
    for f in os.listdir(tables):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{tables}/{f}'")
    got = QUERIES[name](spark, tables)
    order = sorted(got.columns)
    plain = lambda rows: sorted(repr(tuple(r)) for r in rows)
    assert plain(got.select(*order).collect()) == plain(con.sql(f"SELECT {', '.join(order)} FROM ({ORACLES[name]})").fetchall())


def test_first_label_of_the_table(spark):
    """Labels of one language and `ord`: SQL leaves them open, here the first row counts."""
    rows = [("Q1", "fr", "label", 0, "b"), ("Q1", "fr", "label", 0, "a"), ("Q1", "fr", "alias", 0, "c")]
    names = spark.createDataFrame(rows, "qid string, lang string, kind string, ord int, value string").coalesce(1)
    assert display_names(names).first()["wikidata_label"] == "b"
    claims = spark.createDataFrame([], "qid string, pid string, ord int, v_id string, v_str string, v_time string, v_lat double, v_lon double")
    assert profile(names, claims, spark.createDataFrame([("Q1", 1)], "qid string, sitelinks int")).first()["keys"] == ["b", "c"]
