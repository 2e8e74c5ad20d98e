"""Incremental extraction: new documents arrive in a folder, their forms are appended, and only affected clusters change."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import norm_label
from ..operators.extract import best_labels, clusters, entities, entity_forms, labelled, typed

EVENT = "doc string, kind string, ner_id string, form string, seq bigint"


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of JSON files as they arrive."""
    return spark.readStream.schema(EVENT).json(folder)


def append_events(stream: DataFrame, table: str, checkpoint: str, then: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Appends typed events to a Parquet table, one folder for each batch, so that a batch that runs again replaces itself."""

    def store(batch: DataFrame, number: int) -> None:
        typed(batch).write.mode("overwrite").parquet(f"{table}/batch={number}")
        if then is not None:
            then(batch, number)

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def affected(events: DataFrame, batch: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The keys (type, label_norm) that a batch may change: those of its entities by the labels that all events give, and, with the events from
    before the batch, those that its entities had then: an entity whose label changes leaves a cluster and joins another."""
    ids = typed(batch).select("ner_id").distinct()

    def keys(some: DataFrame) -> DataFrame:
        mine = some.join(ids, "ner_id", "left_semi")
        labels = best_labels(entity_forms(mine)).join(entities(mine).select("ner_id", "type"), "ner_id")
        return labels.select("type", norm_label(F.col("label")).alias("label_norm"))

    return (keys(events) if before is None else keys(events).unionByName(keys(before))).distinct()


def refresh(events: DataFrame, old: DataFrame | None = None, changed: DataFrame | None = None) -> DataFrame:
    """Clusters of all stored events. With the old clusters and the changed keys only clusters of these keys are made anew, from the entities that
    have or had them; the others stay as they are."""
    if old is None or changed is None:
        return clusters(entities(events), entity_forms(events))
    key = ["type", "label_norm"]
    labels = labelled(entities(events), entity_forms(events)).select("ner_id", *key)
    mine = events.join(labels.join(changed, key, "left_semi").select("ner_id").distinct(), "ner_id", "left_semi")
    new = clusters(entities(mine), entity_forms(mine))
    return new.unionByName(old.join(changed, key, "left_anti"))


def event_windows(stream: DataFrame, size: str = "1 day", late: str = "1 day") -> DataFrame:
    """An addition beyond the pipeline: counts and sums of timed events in tumbling windows, late ones up to `late`."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
