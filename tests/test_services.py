import datetime

from pyspark.sql import functions as F

from orelode.functions import text
from orelode.operators import companies, exchange, geocode, ingest, reporting

MENTION = "array<struct<name:string,role:string>>"
RECORD = f"rec_id long, facility_id string, location struct<lat:double,lon:double>, company_mentions {MENTION}"
COMPANY = "company_id string, company_name string, hq_lat double, hq_lon double"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_companies_with_boost_gates_and_relationships(spark):
    facility = spark.createDataFrame(
        [
            (1, "a", (10.0, 10.0), [("Vasti Kora Mining Ltd", "operator"), ("Vasti Kora Mining", "Owner"), ("", "owner"), (None, "owner"), ("Vasti Kora Mining Ltd", "auditor")]), (2, "b", (10.5, 10.0), [("vasti (51%) kora mining", None), ("Nobody Knows", "operator")]),
            (3, "c", (0.0, 0.0), [("Kora Vasti Mining Ltd", "unknown")]), (4, None, None, None), (5, "e", None, []),
        ],
        RECORD,
    ).selectExpr("*", "1 AS score", "'x' AS gate")
    known = spark.createDataFrame([("c2", "Vasti Kora Mining Ltd", 10.01, 10.0), ("c1", "Kora Vasti Mining Ltd", None, None), ("c3", "Other Copper", 1.0, 1.0), (None, "Nobody Knows", 1.0, 1.0), ("c4", None, None, None)], COMPANY)
    mentions = companies.mentioned(facility)
    assert {(r["rec_id"], r["role"]) for r in mentions.collect()} == {(1, "operator"), (1, "owner"), (2, "operator"), (3, "operator")}
    rows = companies.resolved(mentions, companies.best_companies(mentions.select("name"), known)).cache()
    got = {(r["rec_id"], r["name"]): (r["company_id"], r["confidence"], r["gate"]) for r in rows.collect()}
    assert got == {
        (1, "Vasti Kora Mining Ltd"): ("c1", 1.0, "auto_accept"), (1, "Vasti Kora Mining"): ("c1", 0.857, "auto_accept"), (2, "vasti (51%) kora mining"): ("c1", 0.857, "auto_accept"), (2, "Nobody Knows"): (None, None, "pending"), (3, "Kora Vasti Mining Ltd"): ("c1", 1.0, "auto_accept"),
    }
    near = companies.resolved(mentions, companies.best_companies(mentions.select("name"), known.where("company_id = 'c2'")))
    assert {(r["rec_id"], r["name"]): r["confidence"] for r in near.collect() if r["company_id"]} == {(1, "Vasti Kora Mining Ltd"): 1.0, (1, "Vasti Kora Mining"): 0.957, (2, "vasti (51%) kora mining"): 0.907, (3, "Kora Vasti Mining Ltd"): 1.0}
    links = companies.relationships(rows)
    assert links.count() == 4 and links.select("relationship_id").distinct().count() == 4
    assert {r["rec_id"]: (r["operator_id"], r["owner_ids"]) for r in companies.linked(facility, rows).collect()} == {1: ("c1", "c1"), 2: ("c1", ""), 3: ("c1", ""), 4: (None, ""), 5: (None, "")}
    stats = companies.enrichment_stats(facility, rows).first()
    assert (stats["records"], stats["mentions"], stats["resolved"], stats["pending"]) == (5, 5, 4, 1)
    assert companies.best_companies(mentions.select("name"), known.limit(0)).count() == 0 and companies.enrichment_stats(facility.limit(0), rows.limit(0)).first()["mentions"] == 0


def test_best_companies_against_brute_force(spark):
    import random

    rng = random.Random(6)
    words = [a + b for a in "kvstr" for b in "aeio"]
    some = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))
    names, known = {some() for _ in range(80)}, [(f"c{i:03}", some(), None, None) for i in range(120)]
    want = {}
    for n in names:
        a = set(n.split())
        score = [(-round(200 * len(a & set(c[1].split())) / (len(a) + len(set(c[1].split()))), 4), c[0]) for c in known]
        if min(score)[0] <= -70:
            want[n] = min(score)[1]
    got = companies.best_companies(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(known, COMPANY))
    assert {r["name"]: r["company_id"] for r in got.collect()} == want


def test_mentions_are_filled_or_merged(spark):
    arr = lambda *v: F.array(*(F.lit(x) for x in v)).cast("array<string>")
    assert one(spark, companies.merged_mentions(arr(), arr("A"))) == ["A"] and one(spark, companies.merged_mentions(arr("B"), arr("A"))) == ["B"]
    assert one(spark, companies.merged_mentions(arr("B", None), arr("b", "A"), force=True)) == ["B", None, "A"]
    assert one(spark, companies.merged_mentions(F.lit(None).cast("array<string>"), arr("A"), force=True)) == ["A"]
    assert one(spark, companies.listed_companies(F.lit("A; b ;;a;B Ltd"))) == ["A", "b", "B Ltd"] and one(spark, companies.listed_companies(F.lit(None).cast("string"))) == []


def test_rows_go_out_and_come_back(spark):
    schema = (
        "rec_id long, facility_id string, name string, aliases array<string>, country_iso3 string, location struct<lat:double,lon:double,precision:string>, types array<string>, commodities array<struct<metal:string,is_primary:boolean>>, "
        "status string, company_mentions array<struct<name:string>>, sources array<struct<type:string,id:string,url:string>>, verification struct<status:string,confidence:double,last_checked:string,notes:string>"
    )
    rows = [
        (1, "dza-a-fac", "A", ["B"], "DZA", (1.0, 2.0, "site"), ["mine", "mill"], [("copper", True), ("gold", False), ("zinc", True), ("lead", False)], "closed", [("X",), ("X",), ("Y",)], [("web", "t1", "http://1"), ("csv", "t2", None)], ("human_verified", 0.9, "2024", "n")),
        (2, None, None, None, None, None, None, None, None, None, None, None),
    ]
    refs = spark.createDataFrame([("DZA", "Algeria")], "iso3 string, country_name string")
    flat = exchange.exchange_rows(spark.createDataFrame(rows, schema), refs)
    a, b = flat.orderBy("rec_id").collect()
    assert (a["primary_metal"], a["secondary_metal"], a["other_metals"], a["country"], a["company_names"], a["source"], a["is_verified"]) == ("zinc", "copper", "gold;lead", "Algeria", "X;Y", "web", True)
    assert b["commodities"] is None and b["evidence_urls"] == "" and b["confidence"] == 0.5 and b["source"] is None
    back = {r["rec_id"]: r for r in exchange.from_exchange(flat, refs).collect()}
    assert [tuple(c) for c in back[1]["commodities"]] == [("copper", True), ("gold", False), ("zinc", False), ("lead", False)]
    assert [tuple(s) for s in back[1]["sources"]] == [("web", "t1", "http://1"), ("web", "Imported row", None)]
    assert (back[2]["country_iso3"], back[2]["types"], back[2]["sources"][0]["type"], back[2]["verification"]["status"]) == ("UNK", ["mine"], "manual", "llm_suggested")


def test_import_counts(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    s = spark.createDataFrame([("a", 9), ("c", 8), (None, 7), ("c", 6)], "k string, v int")
    rows, counts = exchange.imported(t, s, "k")
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([("a", 1), ("b", 2), (None, 3), ("c", 8), ("c", 6)], key=str) and tuple(counts.first()) == (2, 1, 1)
    rows, counts = exchange.imported(t, s, "k", overwrite=True)
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([("b", 2), (None, 3), ("a", 9), ("c", 8), ("c", 6)], key=str) and tuple(counts.first()) == (3, 0, 1)


def test_name_scores(spark):
    none = F.lit(None).cast("array<string>")
    f = lambda a, b, al=none, **k: one(spark, geocode.match_score(F.lit(a).cast("string"), F.lit(b).cast("string"), al, **k))
    assert f("Vasti Mine (old)", "vasti mine!") == 1.0 and f("Kora", "Vasti", F.array(F.lit("KORA"))) == 1.0 and f(None, "x") == 0.0 and f("", "") == 0.0
    assert f("mine vasti", "vasti mine") == 1.0 and f("vasti pit", "vasti mine", similar=False) == 0.5 and 0.5 < f("vasti pit", "vasti bit") < 1.0


def test_sources_are_united_and_scored(spark):
    entry = "source string, source_id string, name string, aliases array<string>, country string, kind string, lat double, lon double"
    a = spark.createDataFrame([("nominatim", "1", "Kora", None, "DZA", "town", 1.0, 1.0), ("nominatim", "2", "Kora Nowhere", None, "DZA", "town", None, None)], entry)
    b = spark.createDataFrame([("overpass", "3", "Kora Mine", ["Vasti"], "DZA", "quarry", 2.0, 2.0), ("cadastre", "4", "Kora", None, "PER", "x", 3.0, 3.0)], entry)
    records = spark.createDataFrame([(1, "Kora Mine", "DZA"), (2, "Vasti", "DZA"), (3, "Else", "DZA"), (4, None, "DZA"), (5, "Kora", None)], "rec_id long, name string, country string")
    got = {r["rec_id"]: (r["source_id"], r["precision"], r["confidence"]) for r in geocode.candidates(records, [a, b]).collect()}
    assert got == {1: ("3", "site", 0.85), 2: ("3", "site", 0.85)}
    facility = spark.createDataFrame([(1, "DZA", (None, None)), (2, "DZA", (1.0, 1.0)), (3, "DZA", None)], "rec_id long, country_iso3 string, location struct<lat:double,lon:double>")
    done = geocode.geocoded(facility, geocode.candidates(records, [a, b]))
    assert {r["rec_id"]: (r["status"], r["lat"]) for r in done.collect()} == {1: ("updated", 2.0), 3: ("skipped", None)}
    assert tuple(geocode.backfill_stats(done, "country_iso3").first()) == ("DZA", 2, 1, 1, 0, 50.0)


def test_cached_answers(spark):
    t = datetime.datetime(2025, 1, 1)
    cache = spark.createDataFrame([("a", 1.0, 1.0, t), ("a", 2.0, 2.0, t - datetime.timedelta(9)), ("b", None, None, t), ("c", 1.0, 1.0, t - datetime.timedelta(400)), ("d", 1.0, 1.0, None)], "key string, lat double, lon double, ts timestamp")
    now = F.lit("2025-01-02 00:00:00").cast("timestamp")
    got = geocode.answered(spark.createDataFrame([(k,) for k in "abcde"], "key string"), cache, now)
    assert {r["key"]: (r["outcome"], r["lat"]) for r in got.collect()} == {"a": ("hit", 1.0), "b": ("negative", None), "c": ("miss", None), "d": ("miss", None), "e": ("miss", None)}
    assert geocode.pruned(cache, now).count() == 3


def test_small_expressions(spark):
    s = lambda v: F.lit(v).cast("string")
    assert one(spark, geocode.answer_position(s('{"found": true, "ref_lat": 0, "ref_lon": 0, "distance_km": 111.19, "direction": "n"}')))["lat"] > 0.99
    assert one(spark, geocode.answer_position(s('{"found": false, "lat": 1, "lon": 2}'))) is None and one(spark, geocode.answer_position(s("nonsense"))) is None
    assert one(spark, geocode.zone_town(F.lit(25.01), F.lit(55.10), F.lit("ARE"))) == "Dubai" and one(spark, geocode.zone_town(F.lit(24.354), F.lit(54.512), F.lit("ARE"))) is None and one(spark, geocode.zone_town(F.lit(25.01), F.lit(55.10), F.lit("OMN"))) is None
    assert one(spark, geocode.feature_query(s("cl"), s("Iron Ore"), s("El Teniente (B)"))).count('"resource"~"iron_ore"') == 1
    assert one(spark, geocode.name_pattern(s("A.b  (c)"))) == "a\\.b.*\\(c\\)"
    assert [one(spark, text.bearing(s(w))) for w in ("N", " ese ", None, "?")] == [0.0, 112.5, 0.0, 0.0]
    assert one(spark, text.same_ignoring_accents(s("Acería"), s("ACERIA"))) and not one(spark, text.same_ignoring_accents(s(""), s(""))) and not one(spark, text.same_ignoring_accents(s(None), s("a")))
    assert one(spark, text.with_note(s(None), "x")) == "x" and one(spark, text.with_note(s("a"), "x")) == "a | x"
    assert one(spark, ingest.joined_cells(s("a"), s("-"), s(None), s(" b "))) == "a, b"
    assert [one(spark, ingest.country_from_file(s(p))) for p in ("albania.txt", "x/algeria_mines.txt", "Finnish Mining.md", "-", None, "a.b")] == ["albania", "algeria", "Finland", None, None, None]
    assert one(spark, text.core_name(s("Vasti (Kora) A.B. Mine"), s("A.B."))) == "Vasti A.B." and one(spark, text.core_name(s("Kora Vasti Mine"), s("Kora"))) == "Vasti"


def test_collisions_and_import_stats(spark):
    f = spark.createDataFrame([("CHL", "s", i) for i in "dbaca"] + [(None, "t", "x"), (None, "t", "y"), ("CHL", "u", "z"), ("CHL", None, "q"), ("CHL", "", "q")], "country_iso3 string, canonical_slug string, facility_id string")
    got = [tuple(r) for r in reporting.collisions(f).orderBy("slug").collect()]
    assert got == [("CHL", "s", 5, "a,b,c"), ("???", "t", 2, "x,y")]
    rows = spark.createDataFrame([(None, (1.0, 1.0)), (None, (None, 1.0)), ("repeated", None), ("not a name", None)], "error string, location struct<lat:double,lon:double>")
    assert tuple(ingest.import_stats(rows).first()) == (4, 2, 1, 1, 1)
