"""The queries of the training-data operators, over their whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, exact_substring, isolation, langid, licenses, pieces, pii, quality, secrets, simhash
from .common import table
from .oracles import ORACLES as ORACLES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_quality_rules_lasso": lambda s, d: quality.query(table(s, d, "documents"), table(s, d, "labels")),
    "op2_language_convnet": lambda s, d: langid.query(table(s, d, "documents")),
    "op3_suffix_dedup": lambda s, d: exact_substring.query(table(s, d, "documents")),
    "op4_template_decontam": lambda s, d: decontam.query(table(s, d, "documents"), table(s, d, "benchmark")),
    "op5_license_minhash": lambda s, d: licenses.query(table(s, d, "documents")),
    "op6_pii_crf": lambda s, d: pii.query(table(s, d, "documents")),
    "op7_secret_randomness": lambda s, d: secrets.query(table(s, d, "documents")),
    "op8_isolation_rules": lambda s, d: isolation.query(table(s, d, "documents"), table(s, d, "labels")),
    "op9_gumbel_pieces": lambda s, d: pieces.query(table(s, d, "documents")),
    "op10_simhash_vptree": lambda s, d: simhash.query(table(s, d, "documents")),
    # what no model decides of op6, op7 and op8, by the same operators: SQL can express these
    "personal_counts": lambda s, d: pii.base_counts(table(s, d, "documents")),
    "secret_counts": lambda s, d: secrets.base_counts(table(s, d, "documents")),
    "rule_counts": lambda s, d: isolation.base_counts(table(s, d, "documents"), table(s, d, "labels")),
}
