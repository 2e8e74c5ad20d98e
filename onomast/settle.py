"""Settling of intermediate tables: written once, read by several branches of a plan."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame


def settle(df: DataFrame) -> DataFrame:
    """A Parquet table of the rows in the folder of spark.checkpoint.dir; only in local mode one is chosen where none is set. It survives lost
    executors, and the planner knows its size."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = os.path.join(tempfile.gettempdir(), "onomast-checkpoints")
    path = f"{folder.rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
