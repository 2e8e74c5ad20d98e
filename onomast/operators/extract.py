"""From mentions to deduplicated clusters.

`events` has doc, kind ('def' or 'mention'), ner_id, form, seq. `seq` orders events as they are met (file, definitions
before mentions, element), which settles every tie. Two shuffles do the work: by (ner_id, form), where mentions are combined
before they move, and by (type, label_norm), which carries entities and forms only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import label_score, norm_label
from ..profiles import type_of_id
from ..settle import settle

KEY, VARIANTS = ["type", "label_norm"], 40


def typed(events: DataFrame) -> DataFrame:
    """P1, P2. Events whose id has a known prefix, with their type."""
    return events.withColumn("type", type_of_id(F.col("ner_id"))).where("type is not null")


def entity_forms(events: DataFrame) -> DataFrame:
    """A2, W1. Forms of each entity with their counts; definitions count 0, empty forms are none."""
    return events.where("form <> ''").groupBy("ner_id", "type", "form").agg(F.sum(F.when(F.col("kind") == "mention", 1).otherwise(0)).alias("cnt"), F.min("seq").alias("first_seen"))


def entities(events: DataFrame) -> DataFrame:
    """J1, A1, A3, A4. One row for each id: mentions, documents, first event, last defined label."""
    is_def = (F.col("kind") == "def") & (F.col("form") != "")
    return events.groupBy("ner_id", "type").agg(
        F.sum(F.when(F.col("kind") == "mention", 1).otherwise(0)).alias("mentions"),
        F.array_sort(F.collect_set("doc")).alias("docs"),
        F.min("seq").alias("first_seen"),
        F.max_by(F.when(is_def, F.col("form")), F.when(is_def, F.col("seq"))).alias("canon"),
    )


def best_labels(forms: DataFrame) -> DataFrame:
    """A5. The display label of each entity: best score, then first seen."""
    rank = F.struct(label_score(F.col("form"), F.col("cnt")).alias("s"), (-F.col("first_seen")).alias("o"), "form")
    return forms.groupBy("ner_id").agg(F.max(rank).alias("x")).select("ner_id", F.col("x.form").alias("label"))


def labelled(ents: DataFrame, forms: DataFrame) -> DataFrame:
    """P3. Entities with a label and its key; those without either are dropped."""
    got = ents.join(best_labels(forms), "ner_id").withColumn("label_norm", norm_label(F.col("label")))
    return got.where("label <> '' and label_norm <> ''")


def clusters(ents: DataFrame, forms: DataFrame) -> DataFrame:
    """J2, A6-A10. One row for each (type, label_norm). Labelled entities are settled, as several branches read them."""
    known = settle(labelled(ents, forms))
    own = known.select(*KEY, "ner_id", F.col("first_seen").alias("e_seen")).join(forms.select("ner_id", "form", "cnt", "first_seen"), "ner_id")
    docs = known.groupBy(*KEY).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("docs")))).alias("source_docs"))
    return _gathered(known, own, docs)


def _gathered(known: DataFrame, own: DataFrame, docs: DataFrame) -> DataFrame:
    """Clusters of labelled entities (type, label_norm, label, ner_id, mentions, first_seen), their forms (type, label_norm, form, cnt, e_seen,
    first_seen) and the documents of each cluster. Forms are cut to those that a cluster keeps before they are gathered."""
    votes = known.groupBy(*KEY, "label").agg(F.sum(F.greatest(F.lit(1), "mentions")).alias("w"), F.min("first_seen").alias("o"))
    display = votes.groupBy(*KEY).agg(F.max(F.struct("w", (-F.col("o")).alias("o"), "label")).alias("x")).select(*KEY, "x.label")
    ids = known.groupBy(*KEY).agg(F.sum("mentions").alias("mentions"), F.sort_array(F.collect_list("ner_id")).alias("ner_ids"))
    # forms, in the order in which a cluster first meets them: its entities' order, then their own
    merged = own.groupBy(*KEY, "form").agg(F.sum("cnt").alias("cnt"), F.min(F.struct("e_seen", "first_seen")).alias("o"))
    of = Window.partitionBy(*KEY)
    ranked = merged.select(*KEY, "form", F.row_number().over(of.orderBy(F.desc("cnt"), "o")).alias("nth"), F.count("*").over(of).alias("n_variants"))
    # the label may be among the first forms: one more than are kept
    kept = ranked.where(F.col("nth") <= VARIANTS + 1).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("nth", "form"))).alias("forms"), F.first("n_variants").cast("int").alias("n_variants"))
    out = ids.join(display, KEY).join(kept, KEY).join(docs, KEY)
    names = F.transform("forms", lambda x: x["form"])
    return out.select(
        "type", "label", "label_norm",
        F.slice(F.filter(names, lambda x: x != F.col("label")), 1, VARIANTS).alias("variants"),
        "n_variants", "ner_ids", F.size("ner_ids").alias("n_ner_ids"), "source_docs", "mentions",
    )


def counted(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events by id, form and block of 64 documents, whose bits say which of them: all that clusters need, in one shuffle of the events and
    without a sort; and the blocks with their documents. Both are settled; ids of unknown types go after that, not row by row before."""
    docs = settle(events.select("doc").distinct()).withColumn("__at", F.monotonically_increasing_id())
    docs = settle(docs.select("doc", F.shiftright("__at", 6).alias("block"), F.expr("shiftleft(1L, cast(__at % 64 as int))").alias("bit")))
    rows = events.join(docs, "doc", "left")
    seen = settle(rows.groupBy("ner_id", "form", "block").agg(F.count_if(F.col("kind") == "mention").alias("cnt"), F.min("seq").alias("first_seen"), F.bit_or("bit").alias("docs")))
    return typed(seen), docs.groupBy("block").agg(F.collect_list(F.struct("bit", "doc")).alias("of_block"))


def clusters_of(seen: DataFrame, blocks: DataFrame) -> DataFrame:
    """A5, P3, J2, A6-A10. The same as `clusters`, of what `counted` gives."""
    forms = seen.repartition("ner_id").groupBy("ner_id", "type", "form").agg(F.sum("cnt").alias("cnt"), F.min("first_seen").alias("first_seen"))
    rank = F.when(F.col("form") != "", F.struct(label_score(F.col("form"), F.col("cnt")).alias("s"), (-F.col("first_seen")).alias("o"), "form"))
    ents = forms.groupBy("ner_id", "type").agg(F.sum("cnt").alias("mentions"), F.min("first_seen").alias("first_seen"), F.max(rank)["form"].alias("label"))
    known = settle(ents.withColumn("label_norm", norm_label(F.col("label")))).where("label <> '' and label_norm <> ''")  # named once, then filtered
    own = seen.drop("type").join(known.select(*KEY, "ner_id", F.col("first_seen").alias("e_seen")), "ner_id")
    own = own.groupBy(*KEY, "form", "block").agg(F.sum("cnt").alias("cnt"), F.min(F.struct("e_seen", "first_seen")).alias("at"), F.bit_or("docs").alias("docs"))
    own = settle(own.select(*KEY, "form", "block", "cnt", "at.*", "docs"))
    docs = own.where("docs is not null").groupBy(*KEY, "block").agg(F.bit_or("docs").alias("docs")).join(blocks, "block")
    inside = F.filter("of_block", lambda x: F.col("docs").bitwiseAND(x["bit"]) != 0)
    docs = docs.groupBy(*KEY).agg(F.sort_array(F.flatten(F.collect_list(F.transform(inside, lambda x: x["doc"])))).alias("source_docs"))
    return _gathered(known, own.where("form <> ''"), docs)


def totals(corpus: DataFrame, ents: DataFrame, found: DataFrame) -> DataFrame:
    """A13, K11, A22. files, entities, clusters, ids, types: one row."""
    files = corpus.agg(F.count_distinct("path").alias("files"))
    own = found.agg(F.count("*").alias("clusters"), F.sum("n_ner_ids").cast("long").alias("ids"), F.count_distinct("type").alias("types"))
    return files.crossJoin(ents.agg(F.count("*").alias("entities"))).crossJoin(own)  # one row each


def ordered(found: DataFrame) -> DataFrame:
    """O1."""
    return found.orderBy("type", F.desc("mentions"), F.lower("label"))


def summary(found: DataFrame) -> DataFrame:
    """A11-A13, K11. Clusters, mentions and ids by type, and in total (type null)."""
    return found.rollup("type").agg(F.count("*").alias("clusters"), F.sum("mentions").alias("mentions"), F.sum("n_ner_ids").cast("long").alias("ids"))


def csv_rows(found: DataFrame) -> DataFrame:
    """K2. The nine columns of the flat file."""
    return found.select("type", "label", "label_norm", "mentions", "n_ner_ids", F.size("source_docs").alias("n_docs"), "n_variants", F.concat_ws("|", "source_docs").alias("source_docs"), F.concat_ws("|", "ner_ids").alias("ner_ids"))


def work_list(found: DataFrame, done: DataFrame | None = None, min_mentions: int = 1, types: tuple[str, ...] = (), limit: int = 0) -> DataFrame:
    """P4, J3, O2, O3. Clusters to reconcile: no dates, frequent first, without those that are done."""
    out = found.where((F.col("mentions") >= min_mentions) & (F.col("type") != "date"))
    if types:
        out = out.where(F.col("type").isin(list(types)))
    if done is not None:
        out = out.join(done.select("type", "label_norm").distinct(), ["type", "label_norm"], "left_anti")
    if limit:
        out = out.orderBy(F.desc("mentions"), "type", F.lower("label")).limit(limit)
    return out
