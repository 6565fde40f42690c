"""Entity resolution: from observations to canonical records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import acronym, core_tokens, jaccard, match_text, normal_url
from ..sources.shared import grows

#: Grades of identity, what nearness in days and other signs add, and the least scores (fixed values).
IDENTITY = (("equal", 100), ("bare", 95), ("acronym", 92), ("subset", 90), ("subunit", 88), ("alike", 85))
NEAR_DAYS, UNDATED = ((3, 20), (14, 12)), 4
SAME_COUNTRY, ONE_COUNTRY, OTHER_COUNTRY, SAME_CATEGORY, SAME_FAMILY, SAME_ACTOR, BY_URL = 8, 2, -4, 6, 4, 4, 10
LEAST, LEAST_ABROAD, URL_QUALITY = 95, 110, 85
#: Families of attack categories by their prefix (fixed values).
CATEGORY_FAMILIES = (("data_breach_", "data_compromise"), ("ransomware_", "data_compromise"), ("third_party", "vendor_compromise"), ("supply_chain", "vendor_compromise"))
#: What follows a name when a part of it is meant: how the words after it start (fixed values).
SUBUNITS = ("academy", "center", "centre", "college of ", "department of ", "faculty of ", "hospital", "institute of ", "laboratory", "labs", "library", "medical center", "medical school", "school of ")
#: Part of a name's words that another must share to be alike.
COVER = 0.6


def canonical_key(identity: Column, day: Column, country: Column, source_id: Column) -> Column:
    """A record's key: the start of a hash over who, when, where and, where they are missing, its source."""
    unsure = F.when(identity.isNull() | day.isNull(), source_id)
    return F.left(F.sha2(F.concat_ws("|", F.coalesce(match_text(identity), F.lit("")), F.coalesce(day.cast("string"), F.lit("")), F.coalesce(F.upper(country), F.lit("")), F.coalesce(unsure, F.lit(""))), 256), F.lit(24))


def _subunit(whole: Column, base: Column) -> Column:
    """A name that goes on, after another, with a part of it: a library, a school of something."""
    rest = F.substring(whole, F.length(base) + 2, F.length(whole))
    starts = F.lit(False)
    for suffix in SUBUNITS:
        starts = starts | rest.startswith(suffix)
    return (base != "") & whole.startswith(F.concat(base, F.lit(" "))) & starts


def identity_quality(a: Column, b: Column) -> Column:
    """How surely two names mean one institution: 100 equal down to 85 alike, 0 not."""
    bare = lambda c: match_text(F.regexp_replace(c, r"\s+\([A-Za-z0-9&.\- ]{2,}\)\s*$", ""))
    at, bt, aw, bw = match_text(a), match_text(b), core_tokens(a), core_tokens(b)
    few, many, shared = F.least(F.size(aw), F.size(bw)), F.greatest(F.size(aw), F.size(bw)), F.size(F.array_intersect(aw, bw))
    tests = {
        "equal": at == bt,
        "bare": ((bare(a) == bare(b)) & (bare(a) != "")) | ((aw == bw) & (few > 0)),
        "acronym": (acronym(a) == bt) | (acronym(b) == at),
        "subset": (shared == few) & (few >= 2) & (few / many >= 0.7),
        "subunit": _subunit(at, bt) | _subunit(bt, at),
        "alike": jaccard(aw, bw) >= COVER,
    }
    out = F.lit(0)
    for name, grade in reversed(IDENTITY):
        out = F.when(tests[name], grade).otherwise(out)
    return F.when((at == "") | (bt == "") | at.isNull() | bt.isNull(), 0).otherwise(out)


def category_family(c: Column) -> Column:
    """The family of an attack category; others are their own, empty ones have none."""
    low = F.nullif(F.lower(F.trim(c)), F.lit(""))
    out = low
    for prefix, family in reversed(CATEGORY_FAMILIES):
        out = F.when(low.startswith(prefix), family).otherwise(out)
    return out


def match_score(quality: Column, left: str = "l", right: str = "r", abroad: bool = False) -> Column:
    """Identity, nearness in time, country, category, family and actor, added up; null where the two can't be one.

    Days over a fortnight apart rule a match out, as do two different countries. With
    ``abroad``, equal names within three days in one family of categories may differ in country.
    """
    of = lambda side, c: F.col(f"{side}.{c}")
    same = lambda c: F.coalesce(of(left, c) == of(right, c), F.lit(False))
    gap = F.abs(F.datediff(of(left, "day"), of(right, "day")))
    near = F.when(gap.isNull(), UNDATED)
    for days, plus in NEAR_DAYS:
        near = near.when(gap <= days, plus)
    both_known = of(left, "country").isNotNull() & of(right, "country").isNotNull()
    fits = F.lit(False)
    if abroad:
        fits = (quality >= 100) & F.coalesce(gap <= 3, F.lit(False)) & F.coalesce(category_family(of(left, "category")) == category_family(of(right, "category")), F.lit(False))
    country = F.when(same("country"), SAME_COUNTRY).when(both_known & fits, OTHER_COUNTRY).when(both_known, None).when(of(left, "country").isNotNull() | of(right, "country").isNotNull(), ONE_COUNTRY).otherwise(0)
    more = sum((F.when(same(c), plus).otherwise(0) for c, plus in (("category", SAME_CATEGORY), ("family", SAME_FAMILY), ("actor", SAME_ACTOR))), F.lit(0))
    return F.when(quality > 0, quality + near + country + more)


def name_candidates(observations: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs (source_id, canonical_id) of names that may have a grade: common words make no pairs by themselves.

    Names that are alike share COVER of the longer one's words, so the rarest words of each,
    all but that part, hold a common one; a subunit's parent stands whole in its name. So it
    is enough that the rarest words of one name meet any word of the other. Whole texts and
    acronyms are words too.
    """
    whole = F.array_distinct(F.array_compact(F.array(F.nullif(match_text(F.col("name")), F.lit("")), acronym(F.col("name")))))
    sides = []
    for df, key in ((observations, "source_id"), (records, "canonical_id")):
        named = df.where(F.col("name").isNotNull()).select(key, core_tokens(F.col("name")).alias("words"), whole.alias("whole"))
        sides.append((key, named.select(key, F.explode("words").alias("word"), F.size("words").alias("n")), named.select(key, F.explode("whole").alias("word"))))
    often = sides[0][1].select("word").unionByName(sides[1][1].select("word")).groupBy("word").agg(F.count("*").alias("rows"))
    pairs = None
    rare = {}
    for key, words, _ in sides:
        ranked = words.join(often, "word").withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy("rows", "word")))
        rare[key] = ranked.where(F.col("nth") <= F.col("n") - F.ceil(F.col("n") * COVER) + 1).select(key, "word")
    (left, left_words, left_whole), (right, right_words, right_whole) = sides
    bare = lambda words: words.drop("n")
    for a, b in ((rare[left], bare(right_words)), (bare(left_words), rare[right]), (left_whole, right_whole)):
        met = a.join(b, "word").select(left, right)
        pairs = met if pairs is None else pairs.unionByName(met)
    return pairs.distinct()


def _scored(both: DataFrame) -> DataFrame:
    """Scores of pairs of an observation ``l`` and a record ``r`` with by_url and quality."""
    nameless = F.coalesce(match_text(F.col("l.name")), F.lit("")) == ""
    url_bonus = F.when(F.col("by_url") & (F.col("quality") >= URL_QUALITY), BY_URL).otherwise(0)
    return both.select("source_id", "canonical_id", "by_url", nameless.alias("nameless"), (match_score(F.col("quality")) + url_bonus).alias("score"), match_score(F.col("quality"), abroad=True).alias("wide"))


def find_existing(observations: DataFrame, records: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """Per observation the record it belongs to: (source_id, canonical_id, match_type, score).

    Both sides carry name, day, country, category, family, actor. Candidates share a url
    (``urls``: source_id, url, and canonical_id of records) or have names that may mean one
    institution. The best score of at least LEAST decides, a shared url adding BY_URL; then
    equal names abroad of at least LEAST_ABROAD. Without a name, a shared url alone does.
    Ties go to the smaller id.
    """
    # Names are judged once each; only pairs with a grade meet the rows that bear them.
    once = lambda df, key: df.where("name IS NOT NULL").select("name").distinct().withColumn(key, F.col("name"))
    graded = name_candidates(once(observations, "source_id"), once(records, "canonical_id")).select(F.col("source_id").alias("l_name"), F.col("canonical_id").alias("r_name"), identity_quality(F.col("source_id"), F.col("canonical_id")).alias("quality")).where("quality > 0")
    left, right = grows(observations).alias("l"), grows(records).alias("r")
    both = graded.join(right, F.col("r_name") == F.col("r.name")).join(left, F.col("l_name") == F.col("l.name")).withColumn("by_url", F.lit(False))
    scored = _scored(both)
    if urls is not None:
        keyed = urls.withColumn("key", normal_url(F.col("url"))).where("key IS NOT NULL")
        shared = keyed.where("source_id IS NOT NULL").select("source_id", "key").join(keyed.where("canonical_id IS NOT NULL").select("canonical_id", "key"), "key").select("source_id", "canonical_id", F.lit(True).alias("by_url"))
        # A pair that shares a url and has a grade comes twice; the row with the url never loses to the other.
        scored = scored.unionByName(_scored(shared.distinct().join(left, "source_id").join(right, "canonical_id").withColumn("quality", identity_quality(F.col("l.name"), F.col("r.name")))))
    stage = F.when(F.col("nameless") & F.col("by_url"), 0).when(F.col("score") >= LEAST, F.when(F.col("by_url"), 0).otherwise(1)).when(F.col("wide") >= LEAST_ABROAD, 2)
    value = F.when(F.col("nameless"), 100).when(F.col("stage") < 2, F.col("score")).otherwise(F.col("wide"))
    placed = scored.withColumn("stage", stage).where("stage IS NOT NULL").withColumn("value", value)
    best = placed.groupBy("source_id").agg(F.min(F.struct((F.col("stage") == 2).alias("late"), (-F.col("value")).alias("less"), "canonical_id", "stage")).alias("b"))
    return best.select("source_id", F.col("b.canonical_id").alias("canonical_id"), F.element_at(F.array(F.lit("url_exact"), F.lit("name_date"), F.lit("exact_identity_same_event")), F.col("b.stage") + 1).alias("match_type"), (-F.col("b.less")).cast("long").alias("score"))


def seed_records(observations: DataFrame, matched: DataFrame) -> DataFrame:
    """New records for observations that none exists for: one for each canonical key, its first source kept."""
    rest = observations.join(matched.select("source_id"), "source_id", "left_anti")
    keyed = rest.withColumn("canonical_key", canonical_key(F.col("name"), F.col("day"), F.col("country"), F.col("source_id").cast("string")))
    return keyed.groupBy("canonical_key").agg(F.min("source_id").alias("first_source"), F.count("*").alias("members"))


def primary_members(members: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """``members`` with is_primary: the highest score of each record, ties to the smaller ``tie``."""
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(score), tie)
    return members.withColumn("is_primary", F.row_number().over(w) == 1)


def retired(records: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """``records`` whose status is `excluded` where no member is left."""
    left = members.select(key, F.lit(True).alias("__has")).distinct()
    return records.join(left, key, "left").withColumn("status", F.when(F.col("__has").isNull(), "excluded").otherwise(F.col("status"))).drop("__has")


def merge_documents(members: DataFrame, key: str, order: list[Column], scalars: list[str], lists: list[str], source: str) -> DataFrame:
    """One record per key: scalars from the first member that has them, lists joined without repeats, and who gave what.

    Provenance is a map from field to the sorted sources that hold it.
    """
    rank = F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])
    has = lambda f: F.col(f).isNotNull()
    aggs = [F.min_by(F.col(f), F.when(has(f), rank)).alias(f) for f in scalars]
    aggs += [F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.when(has(f), F.struct(rank.alias("o"), F.col(f).alias("v"))))), lambda x: x["v"]))).alias(f) for f in lists]
    sources = F.create_map(*[x for f in (*scalars, *lists) for x in (F.lit(f), F.array_sort(F.collect_set(F.when(has(f), F.col(source)))))])
    return members.groupBy(key).agg(*aggs, sources.alias("provenance"), F.count("*").alias("members"))
