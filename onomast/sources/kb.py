"""The knowledge base as flat tables; raw entity JSON is flattened once, at load."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import time_year
from ..functions.text import match_key
from ..profiles import AUTHORITY_PIDS, KEPT_PIDS
from ..settle import settle

_LANGS = ("fr", "la", "en", "it")
_TEXT = "map<string,struct<value:string>>"
_RAW = (
    f"qid string, labels {_TEXT}, descriptions {_TEXT}, aliases map<string,array<struct<value:string>>>, "
    "claims map<string,array<struct<mainsnak:struct<datavalue:struct<value:string>>>>>, sitelinks map<string,string>, _slc bigint"
)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """S11. Raw entities, one JSON object in a line, with `qid`. Values of claims stay JSON text, whatever their kind. A path that is not
    there gives none, and so does a file with a line that does not parse: what is cached can be fetched again."""
    try:
        rows = spark.read.schema(f"{_RAW}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path).withColumn("__file", F.col("_metadata.file_path"))
        rows = settle(rows)  # parsed once
    except AnalysisException:
        return spark.createDataFrame([], _RAW)
    bad = rows.select("__file", F.col("_bad").isNotNull().alias("b")).groupBy("__file").agg(F.max("b").alias("b")).where("b").select("__file")
    return rows.join(bad, "__file", "left_anti").drop("_bad", "__file")


def flatten(raw: DataFrame) -> dict[str, DataFrame]:
    """P16, F28, F36. kb_name, kb_claim, kb_base. Only kept properties and four languages remain; an entity that was
    slimmed before keeps its stored count."""
    texts = lambda c, kind: raw.select("qid", F.explode(c).alias("lang", "v")).where(F.col("lang").isin(*_LANGS)).select("qid", "lang", F.lit(kind).alias("kind"), F.lit(0).alias("ord"), F.col("v.value").alias("value"))
    alias = raw.select("qid", F.explode("aliases").alias("lang", "vs")).where(F.col("lang").isin(*_LANGS)).select("qid", "lang", F.lit("alias").alias("kind"), F.posexplode("vs").alias("ord", "v")).select("qid", "lang", "kind", "ord", F.col("v.value").alias("value"))
    names = texts("labels", "label").unionByName(texts("descriptions", "description")).unionByName(alias)
    claims = raw.select("qid", F.explode("claims").alias("pid", "vs")).where(F.col("pid").isin(KEPT_PIDS)).select("qid", "pid", F.posexplode("vs").alias("ord", "v")).select("qid", "pid", "ord", F.col("v.mainsnak.datavalue.value").alias("raw"))
    is_object = F.col("raw").startswith("{")
    part = lambda p: F.when(is_object, F.get_json_object("raw", p))
    claims = claims.select("qid", "pid", "ord", part("$.id").alias("v_id"), F.when(~is_object, F.col("raw")).alias("v_str"), part("$.time").alias("v_time"), part("$.latitude").cast("double").alias("v_lat"), part("$.longitude").cast("double").alias("v_lon"))
    base = raw.select("qid", F.coalesce("_slc", F.size(F.map_keys("sitelinks")), F.lit(0)).cast("int").alias("sitelinks"))
    return {"kb_name": names, "kb_claim": claims, "kb_base": base}


def label_rank(lang: Column) -> Column:
    """F11. The order in which a label's language is taken: fr, la, en, it, any."""
    return F.coalesce(*[F.when(lang == x, i) for i, x in enumerate(_LANGS)], F.lit(9))


def claim_sets(claims: DataFrame) -> tuple[Column, ...]:
    """A15, U4, F36. pids, p31 of each entity: property and class sets; a property counts as present without a value."""
    return F.array_sort(F.collect_set("pid")).alias("pids"), F.array_sort(F.collect_set(F.when(F.col("pid") == "P31", F.col("v_id")))).alias("p31")


def placed(rows: DataFrame) -> DataFrame:
    """The rows with `at`, their place in the table: what language and `ord` leave open goes to the row that comes first."""
    return rows if "at" in rows.columns else rows.withColumn("at", F.monotonically_increasing_id())


def profile(names: DataFrame, claims: DataFrame, base: DataFrame) -> DataFrame:
    """A15, P19, F9, F22, F23. What scoring needs of each entity, in one row. `keys` are those of its label, one by the order of languages,
    and of its aliases."""
    first_time = lambda pid: F.min_by(F.when(F.col("pid") == pid, F.col("v_time")), F.when((F.col("pid") == pid) & F.col("v_time").isNotNull(), F.struct("ord", "v_time")))
    has = lambda *pids: F.coalesce(F.bool_or(F.col("pid").isin(*pids) & (any_value() != "")), F.lit(False))
    sets = claims.groupBy("qid").agg(
        *claim_sets(claims), has(*AUTHORITY_PIDS).alias("has_auth"), has("P1014").alias("has_aat"),
        *[first_time(p).alias(p) for p in ("P569", "P570", "P585", "P580", "P582")],
        F.min_by(F.when(F.col("pid") == "P17", F.col("v_id")), F.when((F.col("pid") == "P17") & F.col("v_id").isNotNull(), F.struct("ord", "v_id"))).alias("country"),
    )
    is_label, is_alias = F.col("kind") == "label", F.col("kind") == "alias"
    named = placed(names).where((is_label | is_alias) & (F.col("value") != "")).groupBy("qid").agg(
        F.min_by(F.when(is_label, F.col("value")), F.when(is_label, F.struct(label_rank(F.col("lang")), "ord", "lang", "at"))).alias("label"), F.collect_set(F.when(is_alias, F.col("value"))).alias("aliases")
    )
    keys = F.transform(F.array_compact(F.concat(F.array("label"), "aliases")), lambda v: match_key(v))
    named = named.select("qid", F.array_sort(F.array_distinct(keys)).alias("keys"))
    none = F.array().cast("array<string>")
    got = base.join(sets, "qid", "left").join(named, "qid", "left")
    return got.select(
        "qid", "sitelinks", F.coalesce("p31", none).alias("p31"), F.coalesce("pids", none).alias("pids"), F.coalesce("has_auth", F.lit(False)).alias("has_auth"), F.coalesce("has_aat", F.lit(False)).alias("has_aat"),
        F.coalesce(time_year(F.col("P569")), time_year(F.col("P570"))).alias("birth_year"),
        F.coalesce(time_year(F.col("P585")), time_year(F.col("P580")), time_year(F.col("P582"))).alias("event_year"),
        "country", F.coalesce("keys", none).alias("keys"),
    )


def any_value() -> Column:
    """F34. A claim's value, whatever its kind, as text."""
    return F.coalesce("v_str", "v_id", "v_time", F.concat_ws(" ", F.col("v_lat").cast("string"), F.col("v_lon").cast("string")))
