"""Rewriting of references to register ids, as column expressions over lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ref_pattern(attribute: str = "ref") -> str:
    return rf'(\s{attribute}=")([^"]*)(")'


def load_mapping(rows: DataFrame) -> DataFrame:
    """S10. ner_uuid, register_id: rows without a key are out; of a key that comes twice the last stays, by `pos`; rows
    without `pos` are taken in the order in which they are read."""
    if "pos" not in rows.columns:
        rows = rows.withColumn("pos", F.monotonically_increasing_id())
    rows = rows.where("ner_uuid is not null and ner_uuid <> '' and register_id is not null")
    return rows.groupBy("ner_uuid").agg(F.max(F.struct("pos", "register_id")).alias("x")).select("ner_uuid", "x.register_id")


def extract_refs(text: Column, attribute: str = "ref") -> Column:
    """F20. Values of the attribute in raw text."""
    return F.regexp_extract_all(text, F.lit(rf'\s{attribute}="([^"]*)"'), F.lit(1))


def tokens(value: Column) -> Column:
    """F18. Tokens of a value, at any white space."""
    return F.filter(F.split(F.trim(F.regexp_replace(value, r"(?U)\s+", " ")), " "), lambda x: x != "")


def rewrite_with_map(line: Column, mapping: Column, attribute: str = "ref") -> Column:
    """F19. The line with known tokens of its attributes replaced; `mapping` is a map column. For mappings of a checked size."""
    pattern = ref_pattern(attribute)
    known = lambda t: F.when(t.startswith("#"), F.element_at(mapping, F.substr(t, F.lit(2))))
    new = lambda t: F.coalesce(F.concat(F.lit("#"), known(t)), t)
    gaps = F.split(line, pattern, -1)
    hits = F.regexp_extract_all(line, F.lit(pattern), F.lit(0))
    value = lambda h: F.regexp_extract(h, pattern, 2)
    done = F.transform(hits, lambda h: F.concat(F.regexp_extract(h, pattern, 1), F.array_join(F.transform(tokens(value(h)), new), " "), F.lit('"')))
    return F.array_join(F.zip_with(gaps, done, lambda g, d: F.concat(g, F.coalesce(d, F.lit("")))), "")


def count_with_map(line: Column, mapping: Column, attribute: str = "ref") -> Column:
    """A19. Tokens of a line that the mapping changes."""
    all_ = F.flatten(F.transform(extract_refs(line, attribute), tokens))
    return F.size(F.filter(all_, lambda t: t.startswith("#") & F.map_contains_key(mapping, F.substr(t, F.lit(2)))))


def rewrite_lines(lines: DataFrame, mapping: DataFrame, attribute: str = "ref") -> DataFrame:
    """F18, F19, J8, A19. `lines` (file, line_no, line) with `new_line` and `changed`, for mappings of any size.

    Only lines with the attribute leave the map side: their tokens are joined to the mapping (adaptive execution broadcasts
    it where its measured size allows), the answers of a line come back as one small map.
    """
    has = lines.where(F.size(extract_refs(F.col("line"), attribute)) > 0)
    asked = has.select("file", "line_no", F.explode(F.array_distinct(F.flatten(F.transform(extract_refs(F.col("line"), attribute), tokens)))).alias("token")).where("token like '#%'")
    answers = asked.join(mapping, F.substr("token", F.lit(2)) == F.col("ner_uuid")).groupBy("file", "line_no").agg(F.map_from_entries(F.collect_list(F.struct("ner_uuid", "register_id"))).alias("map"))
    none = F.create_map().cast("map<string,string>")
    got = lines.join(answers, ["file", "line_no"], "left").withColumn("map", F.coalesce("map", none))
    changed = F.when(F.size("map") > 0, count_with_map(F.col("line"), F.col("map"), attribute)).otherwise(0)
    # without a known token a line still has its references' white space collapsed
    new = F.when(F.size(extract_refs(F.col("line"), attribute)) > 0, rewrite_with_map(F.col("line"), F.col("map"), attribute)).otherwise(F.col("line"))
    return got.select("file", "line_no", "line", new.alias("new_line"), changed.alias("changed"))


def rewrite_counts(rewritten: DataFrame) -> DataFrame:
    """A19, K10. Changed tokens of each file, and in total (file null)."""
    return rewritten.rollup("file").agg(F.sum("changed").cast("long").alias("changed"))


def join_lines(rewritten: DataFrame, mode: str = "in_place") -> DataFrame:
    """K9. file, text: the files to write. In-place mode leaves files without a change alone, dry runs write none."""
    if mode == "dry_run":
        return rewritten.select("file", F.col("new_line").alias("text")).limit(0)
    got = rewritten.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "new_line"))), lambda x: x["new_line"]), "").alias("text"), F.sum("changed").alias("n"))
    return (got.where("n > 0") if mode == "in_place" else got).select("file", "text")


def first_failures(problems: DataFrame, n: int = 5) -> DataFrame:
    """W7. The first problems of each check."""
    w = Window.partitionBy("check").orderBy("subject", "detail")
    return problems.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n)
