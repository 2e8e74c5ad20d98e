"""The files of the pipeline: clusters, reconciled records, mapping, reports and rewritten documents.

Ordered single files are written by the tasks in sorted parts and put together as byte streams through Spark's file systems.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settle import settle

CLUSTER = "type string, label string, label_norm string, variants array<string>, n_variants int, ner_ids array<string>, n_ner_ids int, source_docs array<string>, mentions bigint"
RECORD = CLUSTER + (
    ", wikidata_qid string, wikidata_label string, description string, match_confidence string, wikidata_sitelinks int, wikidata_alts array<string>, isni string, viaf string, gnd string, bnf string, lccn string, "
    "aat string, geonames string, image string, commons string, birth string, death string, occupation_qids array<string>, gender_qid string, citizenship_qids array<string>, lat double, lon double, "
    "country_qid string, admin_qid string, place_type_qids array<string>, inception string, org_type_qids array<string>, hq_qid string, author_qids array<string>, pub_date string, genre_qids array<string>, "
    "lang_qid string, class_qids array<string>, `when` string, start string, `end` string, location_qid string"
)
CLUSTERS_FILE, CSV_FILE, RECONCILED_FILE, MAPPING_FILE, REPORT_FILE = "entities_clusters.json", "entities.csv", "entities_reconciled.json", "id_mapping.csv", "reconciliation_report.md"


def _at(spark: SparkSession, path: str):
    """The file system and path object of a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file; 0 if it is not there."""
    fs, where = _at(spark, path)
    return fs.getFileStatus(where).getLen() if fs.exists(where) else 0


def put(spark: SparkSession, path: str, parts: list[str], head: str = "", tail: str = "", cut: int = 0) -> None:
    """Puts part files together, between a head and a tail, less the last `cut` bytes; the file is there whole or not at all."""
    fs, where = _at(spark, path)
    fs.mkdirs(where.getParent())
    temporary = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
    copy, out = spark._jvm.org.apache.commons.io.IOUtils.copyLarge, fs.create(temporary, True)
    if head:
        out.write(bytearray(head.encode()))
    sizes = [size(spark, p) for p in parts]
    last = max((i for i, n in enumerate(sizes) if n), default=-1)
    for i, (p, n) in enumerate(zip(parts, sizes, strict=True)):
        part_fs, part = _at(spark, p)
        source = part_fs.open(part)
        copy(source, out, 0, n - (cut if i == last else 0))
        source.close()
    if tail:
        out.write(bytearray(tail.encode()))
    out.close()
    if fs.exists(where):
        fs.delete(where, False)
    if not fs.rename(temporary, where):
        raise OSError(f"could not write {path}")


def parts_of(spark: SparkSession, folder: str) -> list[str]:
    fs, where = _at(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(p for p in (str(f.getPath().toString()) for f in fs.listStatus(where)) if p.rpartition("/")[2].startswith("part-"))


def write_text(lines: DataFrame, path: str, head: str = "", tail: str = "") -> None:
    """One file of the one text column of sorted rows."""
    spark = lines.sparkSession
    folder = f"{path}.{uuid.uuid4().hex}.parts"
    lines.write.text(folder)
    put(spark, path, parts_of(spark, folder), head, tail)
    fs, where = _at(spark, folder)
    fs.delete(where, True)


def write_json(rows: DataFrame, path: str, order: list) -> None:
    """K1, K3. A JSON array, a record in a line; null fields are left out. Rows have distinct (type, label_norm)."""
    if (first := rows.orderBy(*order).first()) is None:
        write_text(rows.limit(0).select(F.lit("").alias("x")), path, "[", "]")
        return
    text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "true"})
    is_first = (F.col("type") == first["type"]) & (F.col("label_norm") == first["label_norm"])
    head = rows.where(is_first).select(text).first()[0]
    write_text(rows.where(~is_first).orderBy(*order).select(F.concat(F.lit(","), text)), path, f"[{head}\n", "]\n")


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """S8. Clusters of a JSON array (one task reads it), or of a Parquet table."""
    return spark.read.schema(CLUSTER).parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.schema(CLUSTER).json(path, multiLine=True)


def read_reconciled(spark: SparkSession, path: str) -> DataFrame:
    """S9. Records by (type, label_norm), the last of equal keys; a file that is not there, or does not parse, gives none."""
    try:
        rows = spark.read.schema(f"{RECORD}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path, multiLine=True)
    except AnalysisException:
        return spark.createDataFrame([], RECORD)
    rows = settle(rows.withColumn("__at", F.monotonically_increasing_id()))
    last = rows.groupBy("type", "label_norm").agg(F.max(F.struct("__at", F.struct(*[c for c in rows.columns if c != "__at"]).alias("r"))).alias("x")).select("x.r.*")
    return last.where(F.col("_bad").isNull() & F.col("type").isNotNull()).drop("_bad")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """S10. ner_uuid, register_id, type, pos: rows of the file but for its first line; rows of one field are out."""
    return spark.read.schema("ner_uuid string, register_id string, type string").csv(path, header=True, enforceSchema=True).where("register_id is not null").withColumn("pos", F.monotonically_increasing_id())


def _csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    line = F.concat(F.to_csv(F.struct(*columns)), F.lit("\r"))
    write_text(rows.select(line), path, ",".join(columns) + "\r\n")


def write_clusters(found: DataFrame, csv: DataFrame, folder: str) -> None:
    """K1, K2, O1. The clusters as JSON and as a flat table, in order."""
    order = ["type", F.desc("mentions"), F.lower("label"), "label_norm"]
    write_json(found, f"{folder}/{CLUSTERS_FILE}", order)
    _csv(csv.orderBy(*order), f"{folder}/{CSV_FILE}", ["type", "label", "label_norm", "mentions", "n_ner_ids", "n_docs", "n_variants", "source_docs", "ner_ids"])


def write_mapping(mapping: DataFrame, path: str) -> None:
    """K7, O6."""
    _csv(mapping.orderBy("ner_uuid", "register_id", "type"), path, ["ner_uuid", "register_id", "type"])


def write_report(coverage: DataFrame, sample: DataFrame, path: str) -> str:
    """K8. Coverage by type and a sample of sure matches, in Markdown: at most nine rows and twelve for each type."""
    lines = ["# Reconciliation", "", "| Type | Entries | With an id | Share |", "|---|---:|---:|---:|"]
    types = coverage.collect()
    lines += [f"| {r['type']} | {r['entries']} | {r['matched']} | {r['percent']}% |" for r in types]
    by: dict[str, list] = {}
    for r in sample.orderBy("type", "nth").collect():
        by.setdefault(r["type"], []).append(f"- **{r['label']}**: {r['wikidata_qid']} ({r['wikidata_label'] or ''}) {r['description'] or ''}".rstrip())
    for r in types:
        if r["type"] in by:
            lines += ["", f"## {r['type']}", "", *by[r["type"]]]
    text = "\n".join(lines) + "\n"
    put(sample.sparkSession, path, [], text)
    return text


def rewrite_files(spark: SparkSession, paths: list[str], mapping: DataFrame, mode: str = "in_place", out: str = "", attribute: str = "ref") -> list[tuple[str, int]]:
    """K9, K10. Rewrites the references of files by the mapping; path and number of changed tokens of each.

    `in_place` replaces files with a change, `out` writes all of them to a folder, `dry_run` none. A row holds one line, so files of any size pass;
    parts are put together in the order of lines. A file without a last line ending keeps none.
    """
    from ..operators.rewrite import rewrite_lines

    names = spark.createDataFrame([(i, str(_at(spark, p)[0].getFileStatus(_at(spark, p)[1]).getPath().toString())) for i, p in enumerate(paths)], "file int, path string")
    # lines end with \n alone: a \r before it stays with the line
    lines = spark.read.option("lineSep", "\n").text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("line_no"))
    path = F.regexp_replace("path", "^file:/+", "file:/")
    lines = lines.withColumn("path", path).join(F.broadcast(names.withColumn("path", path)), "path").select("file", "line_no", "line")  # one row for each file named
    done = settle(rewrite_lines(lines, mapping, attribute))
    counts = {r["file"]: r["n"] for r in done.groupBy("file").agg(F.sum("changed").cast("long").alias("n")).collect()}  # as many rows as files
    changed = [i for i in range(len(paths)) if counts.get(i, 0)]
    wanted = [] if mode == "dry_run" else changed if mode == "in_place" else list(range(len(paths)))
    if wanted:
        folder = f"{out or paths[0]}.{uuid.uuid4().hex}.parts"
        done.where(F.col("file").isin(wanted)).repartitionByRange("file", "line_no").sortWithinPartitions("file", "line_no").select("file", "new_line").write.partitionBy("file").text(folder)
        for i in wanted:
            fs, where = _at(spark, paths[i])
            n, open_end = fs.getFileStatus(where).getLen(), 0
            if n:
                source = fs.open(where)
                source.seek(n - 1)
                open_end = int(source.read() != 10)
                source.close()
            put(spark, f"{out.rstrip('/')}/{where.getName()}" if mode == "out" else paths[i], parts_of(spark, f"{folder}/file={i}"), cut=open_end)
        fs, where = _at(spark, folder)
        fs.delete(where, True)
    return [(p, counts.get(i, 0)) for i, p in enumerate(paths)]
