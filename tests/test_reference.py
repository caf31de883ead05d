import json

import pytest
from pyspark.sql import functions as F

from orelode.functions import text
from orelode.operators import dedupe, quality, timeline
from orelode.operators.spatial import haversine_km
from orelode.sources import files, reports
from orelode.streaming import results


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [("Test Mine (Algeria)", "test-mine"), ("El-Hadjar Steel Complex", "el-hadjar-steel-complex"), ("  Spaces & Special @#$ Chars  ", "spaces-special-chars")])
def test_slugify(spark, raw, want):
    assert one(spark, text.slugify(F.lit(raw))) == want


@pytest.mark.parametrize("raw,want", [("operational", "operating"), ("inactive", "closed"), ("care and maintenance", "suspended"), ("in development", "construction"), ("under construction", "unknown"), ("non-operational", "operating"), ("", "unknown")])
def test_status(spark, raw, want):
    assert one(spark, text.parse_status(F.lit(raw))) == want


@pytest.mark.parametrize(
    "raw,want", [("sx-ew", ("hydromet_plant", 0.95)), ("heap_leach", ("heap_leach", 0.9)), ("hydromet_plant", ("plant", 0.85)), ("rolling_mill", ("mill", 0.85)), ("undetermined", ("mine", 0.85)), ("16.797", ("facility", 0.1)), ("", ("facility", 0.2)), ("quarry", ("facility", 0.3))]
)
def test_type(spark, raw, want):
    got = one(spark, text.normalize_type(F.lit(raw)))
    assert (got["type"], float(got["confidence"])) == want


def test_lists(spark):
    assert one(spark, text.parse_types(F.lit("Open Pit Mine; quarry"))) == ["mine"] and one(spark, text.parse_types(F.lit("-"))) == ["mine"]
    got = one(spark, text.parse_commodities(F.lit("Cu, Au"), F.lit("Ag, Zn, gold")))
    assert [(g["metal"], g["primary"]) for g in got] == [("copper", True), ("gold", True), ("silver", False), ("zinc", False)]
    got = one(spark, text.owners(F.lit("BHP (60%), Rio Tinto 40%")))
    assert [(g["name"], g["percentage"], g["role"]) for g in got] == [("BHP", 60.0, "owner"), ("Rio Tinto", 40.0, "minority_owner")]


@pytest.mark.parametrize("lat,lon,want", [(40.6892, -74.0445, "dr5r7p4"), (-25.7479, 28.2293, "kekjd2e"), (0.0, 0.0, "7zzzzzz")])
def test_geohash(spark, lat, lon, want):
    assert one(spark, text.geohash(F.lit(lat), F.lit(lon))) == want


def test_distance_and_ratio(spark):
    assert one(spark, haversine_km(F.lit(40.7128), F.lit(-74.0060), F.lit(51.5074), F.lit(-0.1278))) == pytest.approx(5570.222, abs=1e-3)
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide")], "a string, b string")
    assert [r[0] for r in df.select(text.seq_ratio("a", "b")).collect()] == [0.25, 0.5]
    df = spark.createDataFrame([("two rivers", "two rivers platinum mine"), ("test mine", "different mine"), ("", "x")], "a string, b string")
    assert [r[0] for r in df.select(text.word_overlap(F.col("a"), F.col("b"))).collect()] == [1.0, 0.5, 0.0]


def test_score(spark):
    c = {"lat": F.lit(1.0), "commodities": F.array(F.lit(1)), "mentions": F.array(), "aliases": F.array(), "status": F.lit("unknown"), "confidence": F.lit(0.65), "verified": F.lit("csv_imported")}
    assert one(spark, text.completeness(c)) == 28.5


FACILITY = "rec_id long, facility_id string, name string, aliases array<string>, location struct<lat:double,lon:double>"


def test_star_clusters_match_the_sequential_greedy(spark):
    import random

    rng = random.Random(3)
    words = ["north", "gold", "mine", "hill", "river", "pit"]
    rows = [(i, f"f{i}", " ".join(rng.sample(words, rng.randint(1, 3))), [], (10.0 + rng.random() * 0.04, 20.0)) for i in range(60)]
    cls = dedupe.classes(spark.createDataFrame(rows, FACILITY)).cache()
    got = {r["class_id"]: r["seed"] for r in dedupe.star_clusters(cls).collect()}
    edges = {(r["id_a"], r["id_b"]) for r in dedupe.fuzzy_pairs(cls).collect()}
    want, left = {}, sorted(r["class_id"] for r in cls.collect())
    while left:
        seed = left[0]
        want.update({x: seed for x in left if x == seed or (seed, x) in edges})
        left = [x for x in left if x not in want]
    assert got == want


IMPORT = FACILITY + ", country_iso3 string"


def test_import_priorities(spark):
    new = [
        (10, "a", "Alpha", [], (1.0, 1.0)), (11, "n1", "Beta", [], (2.0, 2.0)), (12, "n2", "Gamma", None, (None, None)), (13, "n3", "Delta Rock", [], (2.0, 9.0)), (14, "n4", "Two Rivers", [], (5.05, 5.0)), (15, "n5", "Epsilon", [], (0.0, 0.0)),
        (16, "n6", "North Vasti Mine", [], (None, None)), (17, "n7", "Zeta", ["Old Zeta", None, ""], (None, None)), (18, "n8", None, None, None), (19, "n9", "Kochubahe", [], (None, None)), (20, "n10", "Unrelated", [], (40.0, 8.0)),
    ]
    old = [
        (1, "a", "Other", [], (9.0, 9.0)), (2, "b", "BETA", [], (2.001, 2.0)), (3, "c", "Third", ["gamma"], (None, None)), (4, "d", "Delta", [], (2.0, 2.0)), (5, "e", "Two Rivers Platinum Mine", [], (5.0, 5.0)), (6, "f", "epsilon", [], (7.0, 7.0)),
        (7, "g", "Vasti Mine", [], (9.0, 9.0)), (8, "h", "Quorn", ["old zeta"], (None, None)), (9, None, None, None, None), (21, "k", "Kochubahi", [], (50.0, 50.0)),
    ]
    df = lambda rows: spark.createDataFrame([(*r, "DZA") for r in rows], IMPORT).selectExpr("*", "1 AS priority", "'x' AS low")
    got = {r["rec_id"]: (r["existing_rec_id"], r["priority"]) for r in dedupe.import_matches(df(new), df(old)).collect()}
    assert got == {10: (1, 0), 11: (2, 1), 12: (3, 4), 13: (4, 3), 14: (5, 1), 15: (6, 2), 16: (7, 3), 17: (8, 4), 19: (21, 3)}
    native = {r["rec_id"] for r in dedupe.import_matches(df(new), df(old), similar=False).collect()}
    assert native == set(got) - {19}
    assert dedupe.import_matches(df(new), df(old).limit(0)).count() == 0


def test_import_against_brute_force(spark):
    import difflib
    import random

    rng = random.Random(4)
    words = "vasti mine north kochu bahe rivers old pit".split()
    make = lambda n, at: [(at + i, f"f{at + i}", " ".join(rng.sample(words, rng.randint(1, 3))) + rng.choice(["", "x", "s"]), [], (round(rng.uniform(0, 0.4), 3), round(rng.uniform(0, 0.4), 3)) if rng.random() < 0.7 else (None, None)) for i in range(n)]
    new, old = make(40, 100), make(60, 0)

    def hit(a, b):
        (x, (p, q)), (y, (r, s)) = (a[2], a[4]), (b[2], b[4])
        ratio, inside = difflib.SequenceMatcher(None, x, y).ratio(), x in y or y in x
        both = None not in (p, q, r, s)
        near = max(abs(p - r), abs(q - s)) if both else 9
        u, v = set(x.split()), set(y.split())
        rules = (near < 0.01 and (ratio > 0.6 or inside) or near < 0.1 and (ratio > 0.85 or inside), x == y and (near < 0.01 or not all((p, q, r, s))), ratio > 0.85 or len(u & v) / min(len(u), len(v)) > 0.8)
        return next((i + 1 for i, r in enumerate(rules) if r), None)

    want = {}
    for a in new:
        found = [(k, b[0]) for b in old if (k := hit(a, b))]
        if found:
            want[a[0]] = min(found)
    df = lambda rows: spark.createDataFrame([(*r, "DZA") for r in rows], IMPORT)
    assert {r["rec_id"]: (r["priority"], r["existing_rec_id"]) for r in dedupe.import_matches(df(new), df(old)).collect()} == want


def test_slugs_become_unique(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "x"), (4, "a", None), (5, "a-x", None), (6, "b", None)], "id long, s string, r string")
    got = {r["id"]: r["unique_slug"] for r in dedupe.disambiguated(df, F.col("s"), [F.col("r")], "id").collect()}
    assert (got[1], got[5], got[6]) == ("a", "a-x", "b") and len(set(got.values())) == 6
    hashed = {r["id"]: r["unique_slug"] for r in dedupe.disambiguated(df, F.col("s"), [F.col("r"), F.lit("7zzz")], "id").collect()}
    assert hashed[2] == "a-7zzz" and len(set(hashed.values())) == 6


def test_changes_over_partition_borders(spark):
    rows = [(k, i, "ab"[(i // 7) % 2]) for k in ("hot", "cold") for i in range(200 if k == "hot" else 5)]
    df = spark.createDataFrame(rows, "k string, i int, v string")
    got = sorted((r["k"], r["i"], r["previous"]) for r in timeline.changes(df, "k", "v", ["i"]).collect())
    want = []
    for k in ("cold", "hot"):
        last = None
        for kk, i, v in sorted(rows):
            if kk == k:
                if last is None or last != v:
                    want.append((k, i, last))
                last = v
    assert got == want


def test_bounds(spark):
    f = lambda a, o, c: one(spark, quality.bbox_checks(F.lit(a), F.lit(o), F.lit(c)))
    assert [f(-25.5, 28.3, "ZAF"), f(28.3, -25.5, "ZAF"), f(60.5, 100.5, "RUS"), f(-25.0, 28.0, "ZAF"), f(95.0, 1.0, "ZAF")] == [[], ["latlon_swap"], ["out_of_bounds"], ["suspicious_precision"], ["invalid_range"]]
    assert f(28.0, -25.0, "ZAF") == ["latlon_swap", "suspicious_precision"] and f(1.5, 1.5, "ARG") == ["out_of_bounds"]
    assert one(spark, quality.write_gate(F.lit(1.5), F.lit(1.5), F.lit("ARG"))) == "accept"
    assert one(spark, quality.in_bounds(F.lit(60.5), F.lit(100.5), F.lit("RUS"), antimeridian=True))


def test_documents_with_both_kinds_of_mentions(spark, tmp_path):
    for iso, docs in {"CHL": [{"facility_id": "a", "company_mentions": ["X", {"name": "Y", "role": "owner"}, ""]}], "PER": [{"facility_id": "b", "company_mentions": None}]}.items():
        (tmp_path / iso).mkdir()
        for i, doc in enumerate(docs):
            (tmp_path / iso / f"{i}.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "PER" / "bad.json").write_text('{"facility_id": ')
    df = files.read_documents(spark, str(tmp_path)).cache()
    assert df.where("_damaged is not null").count() == 1
    got = {r["facility_id"]: [(m["name"], m["role"]) for m in r["m"]] for r in df.where("_damaged is null").select("facility_id", files.mentions(F.col("company_mentions")).alias("m")).collect()}
    assert got == {"a": [("X", "unknown"), ("Y", "owner")], "b": []}
    assert files.read_documents(spark, str(tmp_path), ["CHL"]).count() == 1


def test_listing_round_trip_and_answers(spark, tmp_path):
    df = spark.createDataFrame([("a, b", 'quo"te', "line\nbreak")], "x string, y string, z string")
    files.write_listing(df.select("x"), str(tmp_path / "l"))
    assert files.read_listing(spark, str(tmp_path / "l")).first()["x"] == "a, b"
    raw = '{"elements": [{"id": 1, "lat": 1.5, "lon": 2.5, "tags": {"name": "N"}}, {"id": 2, "center": {"lat": 3, "lon": 4}}, {"id": 3}]}'
    assert [(x["id"], x["lat"]) for x in one(spark, files.overpass_features(F.lit(raw)))] == [(1, 1.5), (2, 3.0)] and one(spark, files.overpass_features(F.lit("{"))) == []
    assert tuple(one(spark, files.wkt_point(F.lit("Point(-70.5 -33.1)")))) == (-33.1, -70.5)


def test_report_tables(spark):
    doc = "Intro\n\nSite Name | Latitude | Longitude | Status\n--- | --- | --- | ---\nAlpha Mine | -1.5 | 20 | Operational\nBeta | 2 |\n\nName\tOperator\tLocation\nC\tD\tE\n\n- Gamma Hill Mine: closed\n"
    got = reports.parse_reports(spark.createDataFrame([(1, doc), (2, None), (3, ""), (4, "- Gamma Hill Mine: closed in 1998")], "doc_id long, text string")).collect()
    cells = {(r["doc_id"], r["format"], r["table_no"], r["row_no"], r["header"]): r["value"] for r in got}
    assert cells[1, "pipe", 0, 0, "name"] == "Alpha Mine" and cells[1, "pipe", 0, 1, "status"] == "" and cells[1, "tab", 1, 0, "operator"] == "D"
    assert cells[4, "narrative", 0, 0, "name"] == "Gamma Hill Mine" and cells[4, "narrative", 0, 0, "status"] == "closed"
    names = spark.createDataFrame([("Alpha",), ("n/a",), ("x",), (None,), ("no steel here",)], "n string")
    assert [r[0] for r in names.select(reports.valid_name(F.col("n"))).collect()] == [True, False, False, False, False]


def test_latest_stream_keeps_the_latest(spark, tmp_path):
    schema = "facility_key string, json_id string, as_of_date date, query_timestamp timestamp, confidence int, result_id string, accepted boolean"
    import datetime as dt

    day = lambda n: dt.date(2024, 1, n)
    for i, rows in enumerate([[("f", "j", day(1), None, 5, "r1", True), ("f", "k", day(1), None, 5, "r2", True)], [("f", "j", day(2), None, 5, "r3", True), ("f", "k", day(3), None, 5, "r4", False)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        results.latest_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["result_id"] for r in results.latest_state(spark, str(tmp_path / "out"), 2).collect()) == ["r2", "r3"]


def test_concatenated_tables():
    text_ = "Summary\nSite NameStatusCommodity\nAlpha MineoperationalGold\nBeta HillclosedIron\n\nEnd"
    assert reports.concatenated(text_.replace("Site Name", "Name").replace("Gold", "gold").replace("Iron", "iron")) == [("Alpha Mine", "operational", "gold"), ("Beta Hill", "closed", "iron")]
    assert reports.concatenated("nothing here") == []


def test_import_pieces(spark):
    from orelode.operators import enrich, ingest

    names = spark.createDataFrame([("Alpha (Old Alpha) Mine (1998)",), ("Beta (Pty)",), (None,)], "n string")
    assert [r[0] for r in names.select(ingest.parenthetical_aliases(F.col("n"))).collect()] == [["Old Alpha"], [], None]
    at = spark.createDataFrame([("-1.5", "20", ""), ("", "-", "3.5, 4"), ("x", "7", "1, 2"), (None, None, None)], "a string, o string, b string")
    assert [tuple(r[0]) for r in at.select(ingest.position(F.col("a"), F.col("o"), F.col("b"))).collect()] == [(-1.5, 20.0), (3.5, 4.0), (None, 7.0), (None, None)]
    got = one(spark, ingest.group_names(F.lit("Acme Mining Ltd; Old Name; Acme Mining Ltd;")))
    assert got["companies"] == ["Acme Mining Ltd"] and got["aliases"] == ["Old Name"]
    rows = ingest.numbered(spark.range(100).repartition(7).toDF("x")).select("row_no").collect()
    assert sorted(r[0] for r in rows) == list(range(2, 102))
    assert one(spark, enrich.town_from_names(F.lit("X (Mine 2)"), F.array(F.lit("Y (Calama)")))) == "Calama"
    assert one(spark, enrich.town_from_address(F.create_map(F.lit("village"), F.lit("V"), F.lit("town"), F.lit(" ")))) == "V"
    assert one(spark, enrich.same_country(F.lit("NCL"), F.lit("FRA"))) and not one(spark, enrich.same_country(F.lit("NCL"), F.lit("USA")))
    assert tuple(one(spark, enrich.extraction(F.lit('{"lat": 1}')))) == (False, 1.0, None, 0.0)
    assert one(spark, enrich.folded_slug(F.lit("Él Peñón"), F.lit("Mine"))) == "el-penon-mine"


def test_best_record_of_one_hot_group(spark):
    f = spark.range(5000).select(F.col("id").alias("rec_id"), F.lit("hot").alias("g"), F.struct(F.lit(1.0).alias("lat")).alias("location"), F.array(F.lit(1)).alias("commodities"), F.array().alias("company_mentions"), F.array().alias("aliases"), F.lit("unknown").alias("status"), F.struct((F.col("id") % 10 / 10).alias("confidence"), F.lit("csv_imported").alias("status")).alias("verification"))
    assert dedupe.best_records(f, "g").first()["rec_id"] == 9
