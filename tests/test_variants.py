"""Variants of a register entry."""

from pyspark.sql import functions as F

from onomast.operators import registers


def test_variants_are_folded_once(spark):
    """The plan of the variants holds the fold of the label once and that of a variant once, not one for each comparison."""
    df = spark.createDataFrame([("Socrate", ["socrate", "Sócrates", "Platon", "Socrates"])], "label string, variants array<string>")
    got = df.select(registers.filtered_variants(F.col("label"), F.col("variants"), F.lit(5)).alias("v"))
    assert got.first()["v"] == ["Sócrates"]
    assert got._jdf.queryExecution().analyzed().toString().count("translate(") == 2
