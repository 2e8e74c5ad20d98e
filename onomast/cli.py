"""The pipeline as a job: extract, reconcile, registers, rewrite, validate, slim-cache, finalize.

`python -m onomast.cli STEP ...`. Folders and names come from the environment, as `Settings` lists them.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .operators import extract, reconcile, registers, rewrite, validate
from .settle import settle
from .sources import files, kb, tei

#: U6. Small vocabularies that are scored again at the end.
SMALL = ("event", "material", "technique", "artwork")


@dataclass(frozen=True)
class Settings:
    """S19. TEI_GLOB, NER_OUT, REGISTERS_DIR, CORPUS_NAME; KB_PATH is a file or folder of raw entities, LABELS_PATH a table of (qid, label) in JSON lines."""

    tei_glob: str = "data/*_reconciled.tei.xml"
    ner_out: str = "build/ner"
    registers_dir: str = "data/registers"
    corpus_name: str = "Corpus"
    kb_path: str = "build/ner/kb.jsonl"
    labels_path: str = "build/ner/labels.jsonl"

    @classmethod
    def of(cls, env: Mapping[str, str]) -> Settings:
        return cls(**{k: env[k.upper()] for k in cls.__dataclass_fields__ if env.get(k.upper())})


def run_extract(spark: SparkSession, s: Settings) -> list[str]:
    """S1-S7, K1, K2, K11. Clusters of all documents."""
    corpus = settle(tei.read_corpus(spark, s.tei_glob))
    events = extract.typed(tei.events_of(corpus))
    ents = settle(extract.entities(events))
    found = settle(extract.clusters(ents, settle(extract.entity_forms(events))))
    files.write_clusters(found, extract.csv_rows(found), s.ner_out)
    t = extract.totals(corpus, ents, found).first()
    by = extract.summary(found).where("type is not null").orderBy("type").collect()  # nine types
    return [f"files {t['files']}", f"entities {t['entities']}", f"clusters {t['clusters']}", f"ids {t['ids']}", *(f"{r['type']} {r['clusters']} clusters {r['mentions']} mentions" for r in by)]


def run_reconcile(spark: SparkSession, s: Settings, min_mentions: int = 1, types: tuple[str, ...] = (), limit: int = 0) -> list[str]:
    """R6, K3. New records beside those that are there already; a knowledge base that is not there matches nothing."""
    path = f"{s.ner_out}/{files.RECONCILED_FILE}"
    found, done = files.read_clusters(spark, f"{s.ner_out}/{files.CLUSTERS_FILE}"), settle(files.read_reconciled(spark, path))
    work = settle(extract.work_list(found, None, min_mentions, types, limit))
    work = work.join(done.select("type", "label_norm"), ["type", "label_norm"], "left_anti")
    flat = {k: settle(v) for k, v in kb.flatten(kb.read_raw(spark, s.kb_path)).items()}
    matches = reconcile.reconcile(work, flat["kb_name"], settle(kb.profile(flat["kb_name"], flat["kb_claim"], flat["kb_base"])))
    wide = reconcile.record_fields(flat["kb_claim"]).join(reconcile.display_names(flat["kb_name"]), "qid", "full").withColumnRenamed("qid", "wikidata_qid")
    new = work.join(matches.join(wide, "wikidata_qid", "left"), ["type", "label_norm"], "left")
    names = spark.createDataFrame([], files.RECORD)
    new = reconcile.of_type(new).select(*[c for c in names.columns])
    all_ = settle(done.unionByName(new))
    files.write_json(all_, path, ["type", "label_norm"])
    n = all_.selectExpr("count(*) as n", "count(wikidata_qid) as matched").first()
    return [f"records {n['n']}", f"matched {n['matched']}"]


def _labels(spark: SparkSession, s: Settings) -> DataFrame:
    """S12. Known labels; none where the table is not there."""
    schema = "qid string, label string"
    return spark.read.schema(schema).json(s.labels_path) if files.exists(spark, s.labels_path) else spark.createDataFrame([], schema)


def run_registers(spark: SparkSession, s: Settings) -> list[str]:
    """K6-K8. Registers, mapping and report."""
    found, records = settle(files.read_clusters(spark, f"{s.ner_out}/{files.CLUSTERS_FILE}")), settle(files.read_reconciled(spark, f"{s.ner_out}/{files.RECONCILED_FILE}"))
    numbered = settle(registers.number(found))
    rows = registers.with_labels(registers.joined(numbered, records), _labels(spark, s))
    counts = registers.write_registers(registers.render(rows, rows["label_of"]), s.registers_dir, registers.Header(corpus=s.corpus_name))
    files.write_mapping(registers.id_mapping(numbered), f"{s.registers_dir}/{files.MAPPING_FILE}")
    sample = registers.match_sample(found, records).join(records.select("wikidata_qid", "type", "wikidata_label", "description").dropDuplicates(["wikidata_qid", "type"]), ["wikidata_qid", "type"])
    files.write_report(registers.coverage(found, records), sample, f"{s.ner_out}/{files.REPORT_FILE}")
    return [f"{k} {n}" for k, n in counts.items()]


def run_rewrite(spark: SparkSession, paths: list[str], mapping: str, out: str = "", dry_run: bool = False) -> list[str]:
    """K9, K10."""
    mode = "dry_run" if dry_run else "out" if out else "in_place"
    done = files.rewrite_files(spark, paths, rewrite.load_mapping(files.read_mapping(spark, mapping)), mode, out)
    return [*(f"COUNT {n} {p.rpartition('/')[2]}" for p, n in done), f"TOTAL {sum(n for _, n in done)}"]


def run_slim(spark: SparkSession, source: str, target: str) -> list[str]:
    """R7, A23. A response cache (key, value in JSON lines) without what can go."""
    cache = spark.read.schema("key string, value string").json(source)
    slim = settle(reconcile.slim_cache(cache))
    slim.write.mode("overwrite").json(target)
    return [f"{r['kind']} {r['kept']} {r['bytes']} bytes" for r in reconcile.cache_statistics(slim).orderBy("kind").collect()]  # two kinds


def run_finalize(spark: SparkSession, s: Settings) -> list[str]:
    """R8. Records of the small vocabularies go and are made again, then the registers."""
    path = f"{s.ner_out}/{files.RECONCILED_FILE}"
    files.write_json(settle(reconcile.purge_types(files.read_reconciled(spark, path), SMALL)), path, ["type", "label_norm"])
    return [*run_reconcile(spark, s, types=SMALL), *run_registers(spark, s)]


def main(argv: list[str] | None = None, spark: SparkSession | None = None, env: Mapping[str, str] = os.environ) -> int:
    p = argparse.ArgumentParser(prog="onomast")
    step = p.add_subparsers(dest="step", required=True)
    step.add_parser("extract")
    r = step.add_parser("reconcile")
    r.add_argument("--min-mentions", type=int, default=1)
    r.add_argument("--limit", type=int, default=0)
    r.add_argument("--types", default="")
    step.add_parser("registers")
    w = step.add_parser("rewrite")
    w.add_argument("files", nargs="+")
    w.add_argument("--mapping", default="")
    w.add_argument("--out", default="")
    w.add_argument("--dry-run", action="store_true")
    v = step.add_parser("validate")
    v.add_argument("folder", nargs="?", default="")
    v.add_argument("--docs", default="")
    c = step.add_parser("slim-cache")
    c.add_argument("source")
    c.add_argument("target")
    step.add_parser("finalize")
    a, s = p.parse_args(argv), Settings.of(env)
    spark = spark or SparkSession.builder.appName("onomast").getOrCreate()
    status = 0
    if a.step == "extract":
        lines = run_extract(spark, s)
    elif a.step == "reconcile":
        lines = run_reconcile(spark, s, a.min_mentions, tuple(t.strip() for t in a.types.split(",") if t.strip()), a.limit)
    elif a.step == "registers":
        lines = run_registers(spark, s)
    elif a.step == "rewrite":
        lines = run_rewrite(spark, a.files, a.mapping or f"{s.registers_dir}/{files.MAPPING_FILE}", a.out, a.dry_run)
    elif a.step == "validate":
        lines, status = validate.summary(validate.check(spark, a.folder or s.registers_dir, a.docs))
    elif a.step == "slim-cache":
        lines = run_slim(spark, a.source, a.target)
    else:
        lines = run_finalize(spark, s)
    print("\n".join(lines))
    return status


if __name__ == "__main__":
    raise SystemExit(main())
