"""Work that grows with the rows, not with the pairs: results against brute force and rows made by joins."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from orelode import services
from orelode.functions import fixed, text
from orelode.operators import companies, dedupe, geocode


def most_rows(df) -> int:
    """The most rows that any step of the plan of ``df`` puts out."""
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        df = df.select("*")  # planned anew, under this setting
        df.collect()
        left, most = [df._jdf.queryExecution().executedPlan()], 0
    finally:
        conf.set(key, before)
    while left:
        plan = left.pop()
        metric = plan.metrics().get("numOutputRows")
        most = max(most, metric.get().value() if metric.isDefined() else 0)
        left += [plan.children().apply(i) for i in range(plan.children().size())]
    assert most > 0
    return most


def test_companies_make_no_pairs(spark):
    """Names that all match all companies by their common words; the least id of the best score counts."""
    names = [f"aa{i} gold mines ltd" for i in range(400)] + ["Bb7 Mines Gold Ltd", "Ltd"]
    known = [(f"c{i:03d}", f"bb{i} gold mines ltd", None, None) for i in range(400)]
    df = companies.best_companies(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(known, "company_id string, company_name string, hq_lat double, hq_lon double"))
    got = {r["name"]: (r["company_id"], r["score"]) for r in df.collect()}
    assert got == {n: ("c000", 75.0) for n in names[:400]} | {"Bb7 Mines Gold Ltd": ("c007", 100.0)}
    assert most_rows(df) < 20_000


def test_companies_of_many_words(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(14)]
    some = lambda: " ".join(rnd.sample(words, rnd.randint(1, 13)))
    names, known = sorted({some() for _ in range(150)}), [(f"c{i % 70}", some(), float(i), 0.0) for i in range(140)]
    df = companies.best_companies(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(known, "company_id string, company_name string, hq_lat double, hq_lon double"))
    got = {r["name"]: (r["company_id"], r["company_name"], r["score"], r["hq_lat"]) for r in df.collect()}
    want = {}
    for n in names:
        a = set(n.split())
        best = min(((-round(200 * len(a & set(c.split())) / (len(a) + len(c.split())), 4), i, c, la) for i, c, la, _ in known), default=None)
        if -best[0] >= 70:
            want[n] = (best[1], best[2], -best[0], best[3])
    assert got == want and len(want) > 50


def _candidates(spark, records, entries):
    records = spark.createDataFrame(records, "rec_id long, name string, country string")
    return geocode.candidates(records, [spark.createDataFrame(entries, "source string, source_id string, name string, aliases array<string>, country string, kind string, lat double, lon double")])


def test_candidates_make_no_pairs(spark):
    """All records and entries of a country share a word."""
    records = [(i, f"Aa{i} Coal Mine", "ZAF") for i in range(400)] + [(900, "Bb7 Pit", "ZAF"), (901, "Coal Pit", "PER")]
    df = _candidates(spark, records, [("wikidata", f"r{i:03d}", f"Bb{i} Cc{i} Coal Ltd", None, "ZAF", "mine", float(i), 1.0) for i in range(400)])
    got = {r["rec_id"]: (r["source_id"], r["lat"], r["confidence"]) for r in df.collect()}
    assert got == {i: ("r000", 0.0, 0.6433) for i in range(400)} | {900: ("r007", 7.0, 0.71)}
    assert most_rows(df) < 20_000


def test_candidates_against_brute_force(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(16)]
    some = lambda most: " ".join(rnd.sample(words, rnd.randint(0, most)))
    records = [(i, rnd.choice([some(4), some(13), None]), rnd.choice(["PER", "CHL", None])) for i in range(120)]
    entries = [(rnd.choice(["wikidata", "nominatim", "overpass", "atlas"]), f"e{i % 50}", some(13 if i % 3 else 3), rnd.choice([None, [some(3), None]]), rnd.choice(["PER", "CHL"]), "mine", rnd.choice([None, float(i)]), 2.0) for i in range(100)]
    got = {r["rec_id"]: (r["source"], r["source_id"], r["lat"], r["confidence"]) for r in _candidates(spark, records, entries).collect()}
    want = {}
    for i, name, country in records:
        a, found = set((name or "").split()), []
        for source, id_, other, aliases, where, _, lat, _ in entries:
            sets = [s for x in [other, *(aliases or [])] if (s := set((x or "").split()))]
            score = max((len(a & s) / min(len(a), len(s)) for s in sets), default=0.0) if a else 0.0
            if lat is not None and where == country and score and (sure := round(0.6 * geocode.SOURCE_SCORES.get(source, 0.5) + 0.4 * score, 4)) >= 0.6:
                found.append((-sure, source, id_, lat))
        if found:
            want[i] = (*min(found)[1:], -min(found)[0])
    assert got == want and len(want) > 30


IMPORT = "rec_id long, facility_id string, name string, country_iso3 string, location struct<lat:double,lon:double>, aliases array<string>"


def test_similar_names_on_import_against_brute_force(spark):
    rnd = random.Random(3)

    def changed(text: str) -> str:
        text = list(text)
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(text))
            text[at : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "ö", "zc"])
        return "".join(text)

    base = ["kochubahe coal mine", "el tramu pit", "aaaaaaaaaaaaa zzzzzzzzz", "x" * 70 + " y", "grube ñandú öst"]
    names = [sorted({changed(rnd.choice(base)) for _ in range(150)} | {""}) for _ in range(2)]
    want = {(x, y) for x in names[0] for y in names[1] if x and y and SequenceMatcher(None, x, y).ratio() > 0.85}
    assert set(dedupe._similar(names[0], names[1], block=64)) == want | {("", "")} and len(want) > 300
    new, old = (spark.createDataFrame([("PER", n) for n in d], "country string, low string") for d in names)
    got = {tuple(r) for r in dedupe._name_pairs(new, old, True).select("low", "other").collect()}
    assert want <= got and all(SequenceMatcher(None, x, y).ratio() > 0.85 or set(x.split()) & set(y.split()) for x, y in got)


def test_similar_names_on_import_make_no_pairs(spark):
    """Names that share all but their first letters, so all their letter pairs are common."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("bdgklmrs") + rnd.choice("aeiou") for _ in range(4))
    rows = lambda at: spark.createDataFrame([(at + i, f"f{at + i}", f"{word()} Open Pit", "PER", None, None) for i in range(500)], IMPORT)
    df = dedupe.import_matches(rows(0), rows(1000))
    assert most_rows(df) < 20_000


def _facilities(spark, folder, rows: int):
    """Tables of ``backfill_all``: every tenth record lacks a position, all share the word coal."""
    f = spark.range(rows).selectExpr(
        "id AS rec_id", "concat('f', id) AS facility_id", "concat('Aa', id, ' Coal Mine (Zz', id, ')') AS name", "array('-') AS aliases", "'ZAF' AS country_iso3",
        "named_struct('lat', if(id % 10 = 3, NULL, -30.0D), 'lon', 25.0D, 'precision', 'site', 'town', if(id % 2 = 0, ' ', 'Own'), 'region', CAST(NULL AS STRING)) AS location", "array('smelter') AS types",
        "array(named_struct('metal', 'Cu', 'is_primary', true, 'chemical_formula', CAST(NULL AS STRING), 'category', CAST(NULL AS STRING))) AS commodities", "array(named_struct('name', concat('Bb', id % 7, ' Ltd'), 'role', 'operator')) AS company_mentions",
    )
    f.write.parquet(f"{folder}/facility.parquet")
    spark.range(7).selectExpr("concat('r', id) AS relationship_id", "concat('f', id) AS facility_id", "concat('c', id) AS company_id", "concat('Bb', id, ' Ltd') AS company_name").write.parquet(f"{folder}/facility_company_relationships.parquet")
    for name, sql in {
        "place": "SELECT 1L AS place_id, 'Coal' AS place_name, 'town' AS kind, 'ZAF' AS country_iso3, -29.0D AS lat, 24.0D AS lon", "country_ref": "SELECT 'ZAF' AS iso3, 'ZA' AS iso2, 'South Africa' AS country_name",
        "canonical_term": "SELECT 'commodity' AS field_name, 'copper' AS canonical, 'Cu' AS symbol, 'base' AS category",
    }.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")


def test_all_backfills_in_one_pass(spark, tmp_path, monkeypatch):
    """Positions are sought for the records without one, and each record is read for the rest once."""
    rows, sought = 400, []
    _facilities(spark, str(tmp_path), rows)
    monkeypatch.setattr(geocode, "candidates", lambda records, *more, was=geocode.candidates: (sought.append(records.count()), was(records, *more))[1])
    df = services.backfill_all(spark, str(tmp_path))
    got = {r["rec_id"]: r for r in df.collect()}
    assert len(got) == df.count() == rows and sought == [rows // 10]
    assert (got[3]["lat"], got[3]["lon"], got[3]["town"], got[3]["operator_id"], got[3]["n_commodities"]) == (-29.0, 25.0, "Own", "c3", 1)
    assert (got[4]["lat"], got[4]["town"], got[4]["display_name"], got[4]["canonical_name"]) == (-30.0, "Zz4", "Aa4 Coal", "Zz4 Bb4 Ltd Aa4 Coal Smelter")


def test_noise_words_in_one_pass(spark):
    rnd = random.Random(6)
    parts = [*fixed.NOISE_WORDS, "open", "Sx", "ew", "pits", "Aa", "é"]
    names = ["".join(rnd.choice(parts).upper() + rnd.choice([" ", "-", " ", "", "(x)"]) for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    c = F.regexp_replace(F.col("name"), r"\([^)]*\)", " ")
    for word in sorted(fixed.NOISE_WORDS, key=lambda w: (-len(w), w)):
        c = F.regexp_replace(c, rf"(?i)\b{word}\b", " ")
    c = F.trim(F.regexp_replace(c, r"\s+", " "))
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert df.where(text.core_name(F.col("name")) != F.when(c != "", c).otherwise(F.trim("name"))).count() == 0
    assert text.core_name(F.col("name"))._jc.toString().count("regexp_replace") < 20
