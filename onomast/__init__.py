"""Onomast: entity authority over annotated corpora, on Spark DataFrames."""
