"""A corpus pipeline of five stages: quality, near-duplicates, benchmark passages, personal data, tokens.

Each stage works on all rows that the stage before kept, and its decisions take effect; between stages the rows are
written as Parquet and read again. All stages but the last return the columns of `documents`, and carry columns beyond them.
In every stage null ids and ids that rows share are allowed (a row is judged by its text), null and empty texts have a defined
result, repeated rows are treated alike, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onomast.llm import decontam, pieces, pii, quality, simhash
from onomast.llm.common import SETTLED, drop_settled, settle_table, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns outside the held-out fold. Null and empty texts are judged by their
    statistics, all zero; without a label of both kinds the score is constant."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose 5-word shingles are similar by 0.8 or more: the one of least id, a null id last. Texts
    without a word, null ones too, are copies of each other. Of equal rows one stays."""
    return simhash.deduplicate(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item's template. Null and empty texts stay; an empty benchmark drops nothing."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind. Null texts stay null."""
    return pii.redacted(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the first sampled segmentation, the others, and sizes, log probabilities and inclusion scores of all samples. Null and
    empty texts have one empty segmentation."""
    got = pieces.encode(docs)
    return got.select("doc_id", F.get("pieces", F.lit(0)).alias("pieces"), F.slice("pieces", 2, F.size("pieces")).alias("more_pieces"), F.transform("pieces", F.size).alias("n_pieces"), "log_prob", "inclusion")


STAGES = [("quality", keep_quality), ("near_duplicates", drop_copies), ("decontamination", drop_benchmark), ("personal_data", redact_personal), ("tokens", tokenise)]

#: Stages train models and hash with XXH64, which SQL cannot express; a test compares the rows with plain versions of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. What a stage settled on its way goes as soon as its rows are written."""
    docs, first = table(spark, sf_dir, "documents"), len(SETTLED)
    for i, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = settle_table(docs)
            drop_settled(spark, first, keep=docs)
    return docs
