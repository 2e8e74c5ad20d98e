"""Checks of registers, mapping and documents. Each gives rows (check, subject, detail)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..profiles import PROFILES
from ..settle import settle
from ..sources import files, tei
from .rewrite import extract_refs, first_failures, tokens


def _problem(df: DataFrame, check: str, subject: str, detail: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.col(subject).cast("string").alias("subject"), F.col(detail).cast("string").alias("detail"))


def malformed(elements: DataFrame) -> DataFrame:
    """V1. Files that did not parse."""
    return _problem(elements.where("kind = 'error'"), "well-formed", "path", "form")


def duplicate_ids(ids: DataFrame) -> DataFrame:
    """V2, A20. `ids` has file, id."""
    return _problem(ids.groupBy("file", "id").count().where("count > 1"), "duplicate-id", "file", "id")


def unknown_targets(mapping: DataFrame, ids: DataFrame) -> DataFrame:
    """V3, J9. Mapping rows whose register id no register has."""
    return _problem(mapping.join(ids.select(F.col("id").alias("register_id")).distinct(), "register_id", "left_anti"), "mapping", "ner_uuid", "register_id")


def mapping_totals(mapping: DataFrame, ids: DataFrame) -> DataFrame:
    """A21. total, missing."""
    known = ids.select(F.col("id").alias("register_id"), F.lit(True).alias("known")).distinct()
    return mapping.join(known, "register_id", "left").agg(F.count("*").alias("total"), F.count_if(F.col("known").isNull()).alias("missing"))


def tolerated(ref: Column) -> Column:
    """P18. Ids of the recogniser's own form are no problem where they were not mapped."""
    prefixes = "|".join(p.prefix for p in PROFILES)
    return ref.rlike(rf"^({prefixes})-") & ref.rlike("-[0-9a-f]{8}-")


def dangling_refs(docs: DataFrame, ids: DataFrame, attribute: str = "ref") -> DataFrame:
    """V4, J10. References of documents (file, text) that no register has."""
    refs = docs.select("file", F.explode(F.flatten(F.transform(extract_refs(F.col("text"), attribute), tokens))).alias("token")).where("token like '#%'")
    refs = refs.select("file", F.substr("token", F.lit(2)).alias("id")).where(~tolerated(F.col("id")))
    return _problem(refs.join(ids.select("id").distinct(), "id", "left_anti").distinct(), "reference", "file", "id")


def validate(elements: DataFrame, mapping: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """V1-V5. All problems. `elements` are those of the register files: path, kind ('id' or 'error'), form."""
    ids = elements.where("kind = 'id'").select(F.col("path").alias("file"), F.col("form").alias("id"))
    out = malformed(elements).unionByName(duplicate_ids(ids)).unionByName(unknown_targets(mapping, ids))
    return out if docs is None else out.unionByName(dangling_refs(docs, ids))


def check(spark: SparkSession, folder: str, docs_glob: str = "", attribute: str = "ref") -> DataFrame:
    """V1-V5. All problems of a folder of registers with its mapping, and of documents. A folder, mapping or glob that is not there is one."""
    gone = lambda name, what: spark.createDataFrame([(name, what, "missing")], "check string, subject string, detail string")
    if not files.exists(spark, folder):
        return gone("registers", folder)
    elements = tei.register_elements(spark, f"{folder}/*.xml")
    ids = elements.where("kind = 'id'").select(F.col("path").alias("file"), F.col("form").alias("id"))
    out = malformed(elements).unionByName(duplicate_ids(ids))
    path = f"{folder}/{files.MAPPING_FILE}"
    out = out.unionByName(unknown_targets(files.read_mapping(spark, path), ids) if files.exists(spark, path) else gone("mapping", path))
    if docs_glob:
        try:
            lines = spark.read.option("lineSep", "\n").text(docs_glob).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
            out = out.unionByName(dangling_refs(lines, ids, attribute))
        except AnalysisException:
            out = out.unionByName(gone("documents", docs_glob))
    return out


def summary(problems: DataFrame, shown: int = 5) -> tuple[list[str], int]:
    """V5, W7. Lines that name the first problems of each check and their number; 1 if there is any."""
    problems = settle(problems)
    first = first_failures(problems, shown).orderBy("check", "nth").collect()  # at most `shown` for each check
    lines = [f"FAIL {r['check']} {r['subject']}: {r['detail']}" for r in first]
    n = problems.count()
    return [*lines, f"{n} problem(s)"], int(n > 0)
