"""The domain layer on hand-made records: dates, vocabularies, resolution, campaigns, star schema, read models."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from cairnflow.functions import dates, vocab
from cairnflow.operators import campaigns, readmodels, resolution, star

D = datetime.date
ANCHOR = D(2024, 5, 15)  # a Wednesday


def day_of(spark, text):
    return spark.createDataFrame([(text, ANCHOR)], "t string, a date").select(dates.relative_date(F.col("t"), F.col("a")).alias("d")).first().d


@pytest.mark.parametrize(
    ("text", "expected"),
    [("Three days ago the", D(2024, 5, 12)), ("it began 2 weeks ago", D(2024, 5, 1)), ("one month ago", D(2024, 4, 15)), ("on Monday staff", None), ("past Monday", D(2024, 5, 13)), ("last Wednesday", D(2024, 5, 8)), ("yesterday", D(2024, 5, 14)), ("twelve weeks ago", D(2024, 2, 21)), ("last year", D(2023, 1, 1)), ("earlier this month", D(2024, 5, 1)), ("0 days ago", None), ("no date", None), (None, None)],
)
def test_relative_dates(spark, text, expected):
    assert day_of(spark, text) == expected


def test_repair_and_guards(spark):
    rows = [(D(2024, 5, 1), ANCHOR), (D(2025, 4, 20), ANCHOR), (D(2030, 1, 1), ANCHOR), (None, ANCHOR), (D(2025, 1, 1), None)]
    got = spark.createDataFrame(rows, "v date, p date").select(dates.repaired(F.col("v"), F.col("p")).alias("r")).collect()
    assert [(r.r.value, r.r.reason) for r in got] == [(D(2024, 5, 1), None), (D(2024, 4, 20), "year shifted"), (None, "after publication"), (None, None), (D(2025, 1, 1), None)]
    line = spark.createDataFrame([([(D(2024, 5, 1), "attack"), (D(2025, 5, 1), "notice"), (None, "notice")], ANCHOR)], "e array<struct<date:date,event_type:string>>, p date")
    out = line.select(dates.filled(dates.guarded(F.col("e"), F.col("p")), {"notice": F.col("p")}).alias("e")).first().e
    assert [x.date for x in out] == [D(2024, 5, 1), ANCHOR, ANCHOR]
    levels = spark.createDataFrame([(1,), (30,), (31,), (200,), (None,)], "d int").select(dates.disclosure_level(F.col("d")).alias("l")).collect()
    assert [r.l for r in levels] == ["immediate", "prompt", "delayed", "late", None]


def test_canonical_names(spark):
    aliases = spark.createDataFrame([("lock bit", "LockBit"), ("clop", "Cl0p"), ("cl0p", "Cl0p")], "alias string, name string")
    df = spark.createDataFrame([(1, "Lock-Bit Ransomware"), (2, "CLOP"), (3, "Cl0p Gang"), (4, "unknown"), (5, " Akira "), (6, None), (7, "LOCKBIT")], "id int, f string")
    assert {r.id: r.c for r in vocab.canonical(df, "f", aliases, "c").collect()} == {1: "LockBit", 2: "Cl0p", 3: "Cl0p", 4: None, 5: "Akira", 6: None, 7: "LockBit"}


def test_enums_and_countries(spark):
    df = spark.createDataFrame([("Public University",), ("school-district",), ("k12",), ("shop",), (None,)], "x string")
    got = [r.y for r in df.select(vocab.enum_value(F.col("x"), ["university", "school_district"], {"k12": "school_district"}, "other").alias("y")).collect()]
    assert got == ["university", "school_district", "school_district", "other", None]
    countries = spark.createDataFrame([("US", "United States", "Americas", ["USA", "U.S."]), ("FR", "France", "Europe", None)], "code string, name string, region string, aliases array<string>")
    rows = spark.createDataFrame([("usa",), ("FRANCE",), ("fr",), ("Atlantis",), (None,)], "place string")
    out = {r.place: (r.country, r.country_code, r.region) for r in vocab.with_country(rows, "place", countries).collect()}
    assert out == {"usa": ("United States", "US", "Americas"), "FRANCE": ("France", "FR", "Europe"), "fr": ("France", "FR", "Europe"), "Atlantis": ("Atlantis", None, None), None: (None, None, None)}
    assert spark.range(1).select(vocab.flag(F.lit("fr")).alias("f")).first().f == "🇫🇷"
    assert spark.createDataFrame([("in France only",), ("France and Spain",)], "t string").select(vocab.mentioned_country(F.col("t"), ["France", "Spain"]).alias("c")).collect()[0].c == "France"


OBSERVED = "source_id long, name string, day date, country string, category string, family string, actor string"
RECORDS = OBSERVED.replace("source_id", "canonical_id")


def test_resolution(spark):
    records = spark.createDataFrame([(100, "Acme College", D(2024, 5, 1), "US", "ransomware", "x", None), (101, "Other School", D(2024, 1, 1), "US", None, None, None)], RECORDS)
    seen = [
        (1, "ACME College", D(2024, 5, 4), "US", "ransomware", "x", None),
        (2, "Acme College", D(2022, 1, 1), "FR", None, "y", None),
        (3, "Acme College Library", None, None, None, None, None),
        (4, "Nobody", D(2024, 5, 1), "US", None, None, None),
        (5, None, D(2024, 5, 1), "US", None, None, None),
    ]
    urls = spark.createDataFrame([(3, None, "http://www.a.org/p/"), (None, 100, "http://a.org/p?ref=1")], "source_id long, canonical_id long, url string")
    observations = spark.createDataFrame(seen, OBSERVED)
    got = {r.source_id: (r.canonical_id, r.match_type) for r in resolution.find_existing(observations, records, urls).collect()}
    assert got == {1: (100, "name_date"), 3: (100, "url_exact")}
    fresh = resolution.seed_records(observations, resolution.find_existing(observations, records, urls)).collect()
    assert sorted(r.first_source for r in fresh) == [2, 4, 5]
    members = spark.createDataFrame([(100, 1, 5.0), (100, 3, 5.0), (101, 9, None)], "canonical_id long, source_id long, score double")
    assert {(r.source_id, r.is_primary) for r in resolution.primary_members(members, "canonical_id", "score", "source_id").collect()} == {(1, True), (3, False), (9, True)}
    status = resolution.retired(records.withColumn("status", F.lit("open")), members.where("canonical_id = 100"), "canonical_id").collect()
    assert {(r.canonical_id, r.status) for r in status} == {(100, "open"), (101, "excluded")}


def test_acronyms_are_candidates(spark):
    day = D(2024, 5, 1)
    records = spark.createDataFrame([(100, "Massachusetts Institute of Technology", day, "US", None, None, None), (101, "nas", day, "US", None, None, None), (102, "Q & A", day, "US", None, None, None)], RECORDS)
    seen = spark.createDataFrame([(1, "MIT", day, "US", None, None, None), (2, "New Art School", day, "US", None, None, None), (3, "q a", day, "US", None, None, None), (4, "XYZ", day, "US", None, None, None), (5, "", day, "US", None, None, None)], OBSERVED)
    got = resolution.find_existing(seen, records)
    assert {(r.source_id, r.canonical_id) for r in got.collect()} == {(1, 100), (2, 101), (3, 102)}
    assert sorted(r.first_source for r in resolution.seed_records(seen, got).collect()) == [4, 5]


def test_identity_grades(spark):
    pairs = [("A B College", "a b college", 100), ("College of Acme", "Acme of College", 95), ("New Art School", "nas", 92), ("Acme Tech College of Art", "Acme Tech", 88), ("Acme Tech", "Acme Tech Library", 88), ("Acme Tech College", "Acme Tech", 85), ("Acme", "Acme Library", 88), ("Acme Tech", "Acme Technical", 0), ("x", None, 0), ("Red Hill", "Blue Lake", 0)]
    got = spark.createDataFrame(pairs, "a string, b string, g int").select(resolution.identity_quality(F.col("a"), F.col("b")).alias("q"), "g").collect()
    assert all(r.q == r.g for r in got), got


def test_merge_documents(spark):
    rows = spark.createDataFrame([(1, "s2", 2, None, ["b", "c"]), (1, "s1", 1, "x", ["a", "b"]), (1, "s3", 3, "z", None)], "k int, src string, o int, title string, tags array<string>")
    r = resolution.merge_documents(rows, "k", [F.col("o")], ["title"], ["tags"], "src").first()
    assert (r.title, r.tags, r.members) == ("x", ["a", "b", "c"], 3) and r.provenance == {"title": ["s1", "s3"], "tags": ["s1", "s2"]}


def test_campaigns(spark):
    base = D(2024, 1, 1)
    rows = [(k, ["moveit"], ["cve-x"] if k < 3 else [], base + datetime.timedelta(days=k), 1 + k % 2) for k in range(5)] + [(9, ["moveit"], [], base + datetime.timedelta(days=900), 1), (10, ["other"], [], base, 1)]
    found = spark.createDataFrame(rows, "id long, platforms array<string>, cves array<string>, day date, items int")
    edges = campaigns.campaign_edges(found, "id", shared=True)
    candidates, members = campaigns.campaigns(found, "id", edges)
    by = {r.value: r for r in candidates.collect()}
    assert set(by) == {"moveit", "cve-x"} and by["moveit"].member_count == 5 and by["moveit"].year == 2024
    assert 9 not in {r.member for r in members.collect()}
    again, _ = campaigns.campaigns(found, "id", edges)
    assert {r.campaign_id for r in again.collect()} == {r.campaign_id for r in candidates.collect()}
    tied = {r.campaign_id: r.family for r in campaigns.families(members).collect()}
    assert len(set(tied.values())) == 1
    assert campaigns.review_packets(candidates, members).count() == 2 and campaigns.signatures(candidates).count() == 2
    scored = {(r.a, r.b): (r.confidence, r.reasons) for r in edges.collect()}
    assert scored[0, 1] == (1.0, "shared_cve|shared_vendor_or_platform") and scored[0, 4] == (0.7, "shared_vendor_or_platform") and all(9 not in p for p in scored)
    undated = spark.createDataFrame([(1, ["v"], ["a"], None), (2, ["v"], ["a"], base)], "id long, vendors array<string>, hashes array<string>, day date")
    assert [tuple(r) for r in campaigns.campaign_edges(undated, "id").collect()] == [(1, 2, 1.0, "same_selected_article_content|shared_vendor_name", None)]
    kept = campaigns.consensus(found, members.select("campaign_id", "member"), ["campaign_id"], "id", "cves").collect()
    assert {r.cves_consensus for r in kept} == {"cve-x"}
    stored = spark.createDataFrame([("gone", "candidate"), ("kept", "reviewed")], "campaign_id string, status string")
    assert [r.campaign_id for r in campaigns.drop_stale(stored, candidates).collect()] == ["kept"]


def test_star(spark):
    doc = '{"attack":{"family":"Lock Bit","amount":"$1,000"},"data":{"stolen":"yes"},"types":["A b","a-b","c"],"one":"x y","mitre_attack_techniques":[{"technique_id":"t1078","technique_name":"old","tactic":"p"},{"technique_id":"T1078","technique_name":"new","tactic":"q"},{"technique_id":"bad"}],"iocs":["10.0.0.1","zzz"],"day":"2024-05"}'
    df = spark.createDataFrame([(1, doc, "see CVE-2021-44228"), (2, "{}", None)], "id long, projection string, notes string")
    f = {r.id: r for r in star.facts(df, "id", ["attack.family"], ["attack.amount"], ["data.stolen"], ["day"]).collect()}
    assert (f[1].amount, f[1].stolen, f[1].day) == (1000.0, True, D(2024, 5, 1)) and f[1].family_key is not None and f[2].family_key is None
    dim = star.dimension(spark.createDataFrame([("Lock-Bit",), ("lock bit",)], "f string"), "f", ["akira"]).collect()
    assert {r.slug: r.in_vocabulary for r in dim} == {"lock_bit": False, "akira": True} and f[1].family_key in {r.key for r in dim}
    assert sorted(r.slug for r in star.bridge(df, "id", "types").collect()) == ["a_b", "c"] and [r.slug for r in star.bridge(df, "id", "one").collect()] == ["x_y"]
    assert [(r.technique_id, r.name) for r in star.techniques(df, "id").collect()] == [("T1078", "new")]
    assert [r.cve for r in star.flaws(df, "id", ["notes"]).collect()] == ["CVE-2021-44228"] and [(r.kind, r.value) for r in star.indicators(df, "id").collect()] == [("ipv4", "10.0.0.1")]


def test_read_models(spark):
    df = spark.createDataFrame([(k, "t1" if k % 2 else "t2", f"x{k % 3}", k) for k in range(12)] + [(0, "t2", "x0", 0)], "i long, tactic string, tech string, v int")
    r = {(x.tactic, x.technique): (x.incidents, x["rows"], x["rank"], x.tactic_incidents) for x in readmodels.technique_analytics(df, "i", "tactic", "tech", 2).collect()}
    assert r["t2", "x0"] == (2, 3, 1, 6) and len(r) == 4
    steps = readmodels.funnel(df, {"all": F.lit(True), "some": F.col("v") > 3, "few": F.col("v") > 9}).collect()
    assert [(s.stage, s.n) for s in steps] == [("all", 13), ("some", 8), ("few", 2)] and steps[2].pct_of_previous == 25.0
    v = spark.range(1).select(*readmodels.vertices({"victim": [F.lit(True), F.lit(None).cast("boolean"), F.lit(True)], "adversary": [F.lit(False)]})).first()
    assert (v.victim_score, v.victim_confidence, v.adversary_confidence) == (2, "medium", "none")
    kids = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "id long, seq int, t string")
    got = {x.id: [k.t for k in x.events] for x in readmodels.detail(spark.range(1, 3), {"events": (kids, ["seq"])}, "id").collect()}
    assert got == {1: ["a", "b"], 2: []}
