import random

from pyspark.sql import functions as F

from orelode.llm.sites import most_edits, parse_site, similar_cores, site_pairs
from orelode.llm.strings import damerau

SCHEMA = "rec_id long, facility_id string, name string, aliases array<string>, country_iso3 string, location struct<lat:double,lon:double>"
REF = [("CHL", "CL", "Chile"), ("PER", "PE", "Peru")]


def pairs(spark, data):
    f = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], SCHEMA).selectExpr("*", "'x' AS fid", "'y' AS core", "1 AS cls")
    c = spark.createDataFrame(REF, "iso3 string, iso2 string, country_name string")
    return {(r[0], r[1]) for r in site_pairs(f, c).collect()}


def test_same_sites_siblings_neighbours_and_namesakes(spark):
    at = (-20.10, -69.20)
    data = [
        ("chl-a-fac", "Staparabroth Project", [], "CHL", at), ("chl-b-fac", "Project Staparabrth", None, "CL", (-20.105, -69.205)), ("chl-c-fac", "Stapara broth Proj.", ["TBD"], "Chile", (None, None)), ("chl-d-fac", "Renamed Quarry", ["Ex-Staparabroth lease"], "CHL", (-20.1, -69.199)),
        ("chl-e-fac", "Vatrezeze Pit Shaft 3", [], "CHL", at), ("chl-f-fac", "Vatrezeze Pit Shaft 7", [], "CHL", at), ("chl-g-fac", "Lodrukaste Mine", ["Staparabroth claim"], "CHL", at), ("per-h-fac", "Staparabroth Project", [], "PER", (-12.0, -75.0)),
        ("chl-i-fac", "Staparabroth Project", [], "CHL", (-45.0, -71.0)), ("chl-j-fac", "Mine", [], "CHL", at), ("chl-k-fac", "Pit", [], "CHL", at), (None, "Staparabroth Project", [], "CHL", at), ("chl-l-fac", None, None, None, None), ("chl-m-fac", "", [""], "", (0.0, 0.0)),
        ("xx1", "Kogrudalis Mine", [], "peru", (-10.0, 75.0)), ("xx2", "Kogrudalis Mine", [], "PE", (-75.0, 10.0)), ("xx2", "Kogrudalis Mine", [], "PE", (-75.0, 10.0)),
    ]
    got = pairs(spark, data)
    located = {("chl-a-fac", "chl-b-fac"), ("chl-a-fac", "chl-d-fac"), ("chl-b-fac", "chl-d-fac"), ("xx1", "xx2")}
    assert located <= got and all("chl-c-fac" in p for p in got - located)  # c has two places to choose from in its country
    without = pairs(spark, [r for r in data if r[0] != "chl-i-fac"])
    assert without == located | {("chl-a-fac", "chl-c-fac"), ("chl-b-fac", "chl-c-fac"), ("chl-c-fac", "chl-d-fac")}
    assert pairs(spark, []) == set()


def test_recall_of_the_tables_against_brute_force(spark):
    rng = random.Random(2)
    syllables = [a + b for a in "k r l st dr m p t f".split() for b in "aeiou"]
    base = ["".join(rng.choice(syllables) for _ in range(4)) for _ in range(150)]
    cores = set(base)
    for w in base:
        i = rng.randrange(len(w))
        cores.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i + 1 :], w[:i] + "u" + w[i:]]))
    cores = sorted(c for c in cores if len(c) >= 9)
    df = spark.createDataFrame([("CHL", c) for c in cores], "country string, core string")
    got = {(r["core_a"], r["core_b"]) for r in similar_cores(df).collect()}
    near = {(a, b) for i, a in enumerate(cores) for b in cores[i + 1 :] if damerau(a, b, 1) <= 1}
    assert len(near & got) >= 0.9 * len(near)


def test_recall_at_every_edit_count(spark):
    rng = random.Random(5)
    letters = "aeioukrlstdmpf"
    want = set()
    for n in range(4, 24):
        for most in range(1, (3 if n >= 9 else 2 if n >= 6 else 1) + 1):
            for _ in range(20):
                a = b = "".join(rng.choice(letters) for _ in range(n))
                for i in sorted(rng.sample(range(n), most), reverse=True):
                    b = b[:i] + rng.choice(["x", "", b[i] + "y"]) + b[i + 1 :]
                if len(b) < 4 or damerau(a, b) > most_edits(max(len(a), len(b))):
                    continue
                want.add((min(a, b), max(a, b)))
    df = spark.createDataFrame([("CHL", c) for c in sorted({c for p in want for c in p})], "country string, core string")
    assert want <= {(r["core_a"], r["core_b"]) for r in similar_cores(df).collect()}


def test_three_letters_link_by_equality(spark):
    at = (-20.10, -69.20)
    assert pairs(spark, [("chl-a-fac", "Kra Mine", [], "CHL", at), ("chl-b-fac", "Mina Kra", [], "CHL", at), ("chl-c-fac", "Kro Mine", [], "CHL", at)]) == {("chl-a-fac", "chl-b-fac")}


def test_hot_name_makes_no_pairs_before_the_result(spark):
    f = spark.range(3000).select("id", F.concat(F.lit("chl-"), F.col("id").cast("string")).alias("facility_id"), F.lit("Mine").alias("name"))
    f = f.select(F.col("id").alias("rec_id"), "facility_id", "name", F.array(F.lit("-")).alias("aliases"), F.lit("CHL").alias("country_iso3"), F.struct(F.lit(-20.0).alias("lat"), F.lit(-70.0).alias("lon")).alias("location"))
    assert site_pairs(f, spark.createDataFrame(REF, "iso3 string, iso2 string, country_name string")).count() == 0


def test_parsing():
    assert parse_site("Saint-Menivutrol Pit, Chile") == ("menivutrol", "") and parse_site("Hasizubroth Plant Phase II") == ("hasisubroth", "2") and parse_site("Dasaheril claim") == ("", "")
