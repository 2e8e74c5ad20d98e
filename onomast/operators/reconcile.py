"""Entity linking: a staged search without loops.

Each cluster has an ordered plan of searches. Candidates keep the rank of their first appearance; a running best over the
stages finds the first stage at which the search may stop, and the answer is the best up to there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_query, match_key, name_similarity, spelling_variants
from ..functions.dates import format_time
from ..profiles import accept, confidence, fame, geo_bonus, in_time
from ..settle import settle
from ..sources.kb import any_value, claim_sets, label_rank, placed

KEY = ["type", "label_norm"]
PER_SEARCH, FREQUENT, EXTRAS = 7, 5, 4


def stage_plan(work: DataFrame) -> DataFrame:
    """R1. type, label_norm, label, stage, query, lang. Rare clusters get the short plan."""
    stage = lambda q, lang: F.struct(q.alias("query"), F.lit(lang).alias("lang"))
    base = work.select("type", "label_norm", "label", "mentions", "variants", clean_query(F.col("label")).alias("f1"))
    base = base.withColumns({"k0": match_key(F.col("label")), "k1": match_key(F.col("f1"))})
    base = base.withColumns({"f1": F.when((F.col("k1") != F.col("k0")) & (F.col("f1") != ""), F.col("f1"))})
    # extra forms: spellings, then the first variants, new by key, in order
    pool = F.concat(spelling_variants(F.col("label")), F.slice("variants", 1, 3))
    keyed = base.withColumn("pool", F.when(F.col("mentions") >= FREQUENT, F.transform(pool, lambda q: F.struct(q.alias("q"), match_key(q).alias("k")))).otherwise(F.array().cast("array<struct<q:string,k:string>>")))
    seen = F.filter(F.array(F.col("k0"), F.when(F.col("f1").isNotNull(), F.col("k1"))), lambda k: k.isNotNull())
    start = F.struct(seen.alias("seen"), F.array().cast("array<string>").alias("out"))
    extras = F.aggregate(
        "pool", start,
        lambda acc, x: F.when(F.array_contains(acc["seen"], x["k"]) | (F.size(acc["out"]) >= EXTRAS), acc).otherwise(F.struct(F.concat(acc["seen"], F.array(x["k"])).alias("seen"), F.concat(acc["out"], F.array(x["q"])).alias("out"))),
        lambda acc: acc["out"],
    )
    many = F.col("mentions") >= FREQUENT
    steps = F.concat(
        F.array(stage(F.col("label"), "fr"), F.when(F.col("f1").isNotNull(), stage(F.col("f1"), "fr")), stage(F.col("label"), "la"), F.when(many & F.col("f1").isNotNull(), stage(F.col("f1"), "la"))),
        F.flatten(F.transform("extras", lambda q: F.array(stage(q, "fr"), stage(q, "la")))),
        F.array(F.when(many, stage(F.col("label"), "en"))),
    )
    keyed = keyed.withColumn("extras", extras).withColumn("steps", F.filter(steps, lambda s: s.isNotNull()))
    return keyed.select("type", "label_norm", "label", F.posexplode("steps").alias("stage", "s")).select("type", "label_norm", "label", "stage", "s.query", "s.lang")


def search(names: DataFrame, kb: DataFrame) -> DataFrame:
    """S13. lang, text_lc, pos, qid: what a text search returns, famous entities first, then by number; at most 7.

    Equal search texts are one key, so the ranking runs once for each, however many clusters ask for it.
    """
    own = names.where(F.col("kind").isin("label", "alias")).select("lang", F.lower("value").alias("text_lc"), "qid").distinct()
    w = Window.partitionBy("lang", "text_lc").orderBy(F.desc("sitelinks"), F.substr("qid", F.lit(2)).cast("long"))
    return own.join(kb.select("qid", "sitelinks"), "qid").withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= PER_SEARCH).select("lang", "text_lc", "pos", "qid")


def candidates(plan: DataFrame, found: DataFrame) -> DataFrame:
    """R2, J4, J12, W3. Each candidate at its first stage, with its rank from 0."""
    hits = plan.join(found, (plan["lang"] == found["lang"]) & (F.lower(F.substr(plan["query"], F.lit(1), F.lit(200))) == found["text_lc"])).select("type", "label_norm", "label", "stage", "pos", "qid")
    first = hits.groupBy("type", "label_norm", "qid").agg(F.min(F.struct("stage", "pos")).alias("at"), F.first("label").alias("label"))
    w = Window.partitionBy(*KEY).orderBy("at.stage", "at.pos")
    return first.select("type", "label_norm", "label", "at.stage", "at.pos", "qid", (F.row_number().over(w) - 1).alias("rank"))


def scored(cand: DataFrame, kb: DataFrame) -> DataFrame:
    """R3, J5. sim and sf of each candidate; null for those rejected or unknown, which keep their rank.

    `kb` has qid, sitelinks, p31, pids, has_auth, has_aat, birth_year, event_year, country, keys (matching keys of its names).
    """
    got = cand.join(kb, "qid", "left").withColumn("__key", match_key(F.col("label")))
    ok = accept(F.col("type"), F.col("pids"), F.col("p31")) & in_time(F.col("type"), F.col("birth_year"), F.col("event_year"))
    sim = F.when(ok, name_similarity(F.col("__key"), F.col("keys")))
    return got.select("type", "label_norm", "label", "stage", "pos", "qid", "rank", sim.alias("sim"), F.when(sim.isNotNull(), fame(F.col("sitelinks")) + 12 * geo_bonus(F.col("type"), F.col("country"))).alias("sf"), "sitelinks", "has_auth", "has_aat")


def decide(rows: DataFrame) -> DataFrame:
    """R4, W4, A14, F39, F40. One row for each cluster with a match: the best at the stop, its confidence, alternatives."""
    upto = Window.partitionBy(*KEY).orderBy("stage").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    all_ = Window.partitionBy(*KEY)
    score = F.when(F.col("sim").isNotNull(), F.struct("sim", "sf", (-F.col("rank")).alias("r"), "qid", "sitelinks", "has_auth", "has_aat"))
    run = rows.withColumn("best", F.max(score).over(upto))
    stop = (((F.col("best.sim") == 3) & ((F.col("best.sitelinks") >= 6) | F.col("best.has_auth"))) | ((F.col("best.sim") >= 2) & (F.col("best.sitelinks") >= 25)))
    run = run.withColumn("stop", F.coalesce(F.min(F.when(stop, F.col("stage"))).over(all_), F.max("stage").over(all_))).where("stage <= stop")
    got = run.groupBy(*KEY).agg(F.max_by("best", F.struct("stage", "rank")).alias("best"), F.first("stop").alias("stop"), F.sort_array(F.collect_list(F.struct("rank", "qid"))).alias("seen"))
    got = got.where("best is not null")
    others = F.slice(F.filter(F.transform("seen", lambda x: x["qid"]), lambda q: q != F.col("best.qid")), 1, 3)
    return got.select(*KEY, F.col("best.qid").alias("wikidata_qid"), F.col("best.sim").alias("sim"), F.col("best.sitelinks").alias("wikidata_sitelinks"), "stop", confidence(F.col("type"), F.col("best.sim"), F.col("best.sitelinks"), F.col("best.has_auth"), F.col("best.has_aat")).alias("match_confidence"), others.alias("wikidata_alts"))


def reconcile(work: DataFrame, names: DataFrame, kb: DataFrame) -> DataFrame:
    """R5. Matches of the clusters of a work list; clusters without one are absent."""
    return decide(settle(scored(settle(candidates(settle(stage_plan(work)), search(names, kb))), kb)))


def record_fields(claims: DataFrame) -> DataFrame:
    """F31-F35, F38, O5. One wide row for each entity: first values and capped lists, in claim order. Of values with one `ord` a list takes
    the one that comes first in the table, a single field the least."""

    def ids(pid: str, n: int) -> Column:
        got = F.sort_array(F.collect_list(F.when((F.col("pid") == pid) & F.col("v_id").isNotNull(), F.struct("ord", "at", "v_id"))))
        return F.slice(F.transform(got, lambda x: x["v_id"]), 1, n)

    def first(pid: str, value: str) -> Column:
        mine = (F.col("pid") == pid) & F.col(value).isNotNull()
        return F.min_by(F.when(mine, F.col(value)), F.when(mine, F.struct("ord", value)))

    lists = {"occupation_qids": ("P106", 4), "citizenship_qids": ("P27", 2), "class_qids": ("P31", 3), "place_type_qids": ("P31", 3), "org_type_qids": ("P31", 3), "author_qids": ("P50", 3), "genre_qids": ("P136", 3)}
    ones = {"gender_qid": ("P21", "v_id"), "country_qid": ("P17", "v_id"), "admin_qid": ("P131", "v_id"), "hq_qid": ("P159", "v_id"), "lang_qid": ("P407", "v_id"), "location_qid": ("P276", "v_id"), "birth": ("P569", "v_time"), "death": ("P570", "v_time"), "inception": ("P571", "v_time"), "pub_date": ("P577", "v_time"), "when": ("P585", "v_time"), "start": ("P580", "v_time"), "end": ("P582", "v_time"), "isni": ("P213", "v_str"), "viaf": ("P214", "v_str"), "gnd": ("P227", "v_str"), "bnf": ("P268", "v_str"), "lccn": ("P244", "v_str"), "aat": ("P1014", "v_str"), "geonames": ("P1566", "v_str"), "image": ("P18", "v_str"), "commons": ("P373", "v_str"), "lat": ("P625", "v_lat"), "lon": ("P625", "v_lon")}
    texts = {k: p for k, (p, v) in ones.items() if v == "v_str"}
    value = any_value()
    some = lambda p: F.min_by(F.when(F.col("pid") == p, value), F.when((F.col("pid") == p) & value.isNotNull() & (value != ""), F.struct("ord", value.alias("v"))))
    return placed(claims).groupBy("qid").agg(*[ids(p, n).alias(k) for k, (p, n) in lists.items()], *[some(texts[k]).alias(k) if k in texts else first(p, v).alias(k) for k, (p, v) in ones.items()])


# Fields that only the records of some types have.
TYPE_FIELDS = {
    "person": ("birth", "death", "occupation_qids", "gender_qid", "citizenship_qids"),
    "place": ("lat", "lon", "country_qid", "admin_qid", "place_type_qids"),
    "org": ("inception", "org_type_qids", "hq_qid"),
    "work": ("author_qids", "pub_date", "genre_qids", "lang_qid"),
    "event": ("when", "start", "end", "location_qid"),
    "material": ("class_qids",), "technique": ("class_qids",), "artwork": ("class_qids",),
}
TIMES = ("birth", "death", "inception", "pub_date", "when", "start", "end")


def of_type(records: DataFrame) -> DataFrame:
    """F38, P17. Records with the fields of their type alone; times are formatted; empty texts and lists are null."""
    kinds = dict(records.dtypes)
    new = {}
    for field in {f for fs in TYPE_FIELDS.values() for f in fs} & set(kinds):
        value = format_time(F.col(field)) if field in TIMES else F.col(field)
        new[field] = F.when(F.col("type").isin([t for t, fs in TYPE_FIELDS.items() if field in fs]), value)
    return pruned(records.withColumns(new))


def pruned(records: DataFrame) -> DataFrame:
    """P17. Empty texts and lists as null; numbers stay, 0 too."""
    full = lambda c, k: F.when(F.size(c) > 0, F.col(c)) if k.startswith("array") else F.when(F.col(c) != "", F.col(c)) if k == "string" else F.col(c)
    return records.select(*[full(c, k).alias(c) for c, k in records.dtypes])


def kb_profile(claims: DataFrame) -> DataFrame:
    """A15, U4, F36. The sets that scoring uses, of each entity with claims."""
    return claims.groupBy("qid").agg(*claim_sets(claims))


def display_names(names: DataFrame) -> DataFrame:
    """F11, F12, O8. Label (fr, la, en, it, any) and description (fr, en, la, it) of each entity."""
    desc = F.coalesce(*[F.when(F.col("lang") == x, i) for i, x in enumerate(["fr", "en", "la", "it"])], F.lit(9))
    is_label, is_desc = F.col("kind") == "label", (F.col("kind") == "description") & F.col("lang").isin("fr", "en", "la", "it")
    return placed(names).groupBy("qid").agg(
        F.min_by(F.when(is_label, F.col("value")), F.when(is_label, F.struct(label_rank(F.col("lang")), "ord", "lang", "at"))).alias("wikidata_label"),
        F.min_by(F.when(is_desc, F.col("value")), F.when(is_desc, F.struct(desc, "ord", "at"))).alias("description"),
    )


def merge_results(done: DataFrame, new: DataFrame) -> DataFrame:
    """U3, S9. Earlier and new records; of a key that comes twice the new one stays."""
    both = done.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*KEY).orderBy(F.desc("__new"))
    return both.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__new")


def purge_types(records: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """U6. Records without those of the types, which will be scored again."""
    return records.where(~F.col("type").isin(list(types)))


def slim_cache(cache: DataFrame) -> DataFrame:
    """U8, R7. key, value of a response cache: searches stay, old entity keys are renamed, all others go."""
    key = F.when(F.col("key").startswith("e::"), F.concat(F.lit("e2::"), F.substr("key", F.lit(4)))).otherwise(F.col("key"))
    return cache.where(F.col("key").rlike("^(s|e|e2)::")).select(key.alias("key"), "value")


def cache_statistics(cache: DataFrame) -> DataFrame:
    """A23. kind (s, e2), kept, bytes of keys and values."""
    return cache.groupBy(F.substring_index("key", "::", 1).alias("kind")).agg(F.count("*").alias("kept"), F.sum(F.octet_length("key") + F.coalesce(F.octet_length("value"), F.lit(0))).alias("bytes"))
