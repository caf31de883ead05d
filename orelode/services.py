"""Queries of company resolution, exchange, geocoding and reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orelode.catalogue import PRIMARY, SECOND, _box, _case, _in
from orelode.enrichment import CANON
from orelode.functions import fixed, text
from orelode.operators import companies, enrich, exchange, export, geocode, ingest, quality, reporting, spatial
from orelode.plans.runtime import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _facility(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "facility")


# Companies: one for each id of the relationships, seated at its first site with a position.


def _companies(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "facility_company_relationships").where("company_id is not null and trim(company_name) <> ''")
    ok = spatial.usable(quality.lat(), quality.lon())
    at = _facility(spark, d).where(ok).groupBy("facility_id").agg(F.min(F.struct("rec_id", "location.lat", "location.lon")).alias("p"))
    seat = r.join(at, "facility_id").groupBy("company_id").agg(F.min("p").alias("p"))
    named = r.groupBy("company_id").agg(F.min(F.trim("company_name")).alias("company_name"))
    return named.join(seat, "company_id", "left").select("company_id", "company_name", F.col("p.lat").alias("hq_lat"), F.col("p.lon").alias("hq_lon"))


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    mentions = companies.mentioned(_facility(spark, d))
    return companies.resolved(mentions, companies.best_companies(mentions.select("name"), _companies(spark, d)))


MATCHABLE = "trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '\\([^)]*\\)', '', 'g'), '[^a-z0-9\\s\\-]', '', 'g'), '\\s+', ' ', 'g'))"
PARTS = "list_distinct(list_filter(string_split_regex(" + MATCHABLE + ", '[\\s\\-]+'), lambda w: w <> ''))"
KM = "2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians({2} - {0}) / 2), 2) + cos(radians({0})) * cos(radians({2})) * pow(sin(radians({3} - {1}) / 2), 2))))"
GATE = fixed.GATES["moderate"]
RESOLVED = f"""WITH m AS (SELECT rec_id, facility_id, trim(m.name) AS name, CASE WHEN coalesce(lower(trim(m.role)), 'unknown') IN ('unknown', '') THEN 'operator' ELSE lower(trim(m.role)) END AS role,
  CASE WHEN lat <> 0 AND lon <> 0 THEN lat END AS lat, CASE WHEN lat <> 0 AND lon <> 0 THEN lon END AS lon FROM (SELECT rec_id, facility_id, location.lat AS lat, location.lon AS lon, unnest(company_mentions) AS m FROM facility)),
 k AS (SELECT * FROM m WHERE name <> '' AND role IN {_in(companies.ROLES)}), r AS (SELECT * FROM facility_company_relationships WHERE company_id IS NOT NULL AND trim(company_name) <> ''),
 p AS (SELECT facility_id, min(rec_id) AS rid, arg_min(location.lat, rec_id) AS la, arg_min(location.lon, rec_id) AS lo FROM facility WHERE abs(location.lat) <= 90 AND abs(location.lon) <= 180 AND NOT (location.lat = 0 AND location.lon = 0) GROUP BY 1),
 s AS (SELECT company_id, arg_min(la, rid) AS hq_lat, arg_min(lo, rid) AS hq_lon FROM r JOIN p USING (facility_id) GROUP BY 1), c0 AS (SELECT company_id, min(trim(company_name)) AS company_name FROM r GROUP BY 1),
 c AS (SELECT c0.*, hq_lat, hq_lon, {PARTS.format('company_name')} AS b FROM c0 LEFT JOIN s USING (company_id)), n AS (SELECT DISTINCT name, {PARTS.format('name')} AS a FROM k),
 x AS (SELECT name, company_id, company_name, hq_lat, hq_lon, round(200.0 * len(list_intersect(a, b)) / (len(a) + len(b)), 4) AS score FROM n JOIN c ON list_has_any(a, b)),
 t AS (SELECT * FROM x WHERE score >= 70 QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, company_id) = 1),
 g AS (SELECT k.rec_id, k.facility_id, k.name, k.role, company_id, company_name, score, CASE WHEN {KM.format('lat', 'lon', 'hq_lat', 'hq_lon')} < 10 THEN 0.10 WHEN {KM.format('lat', 'lon', 'hq_lat', 'hq_lon')} < 100 THEN 0.05 ELSE 0.0 END AS boost FROM k LEFT JOIN t USING (name)),
 v AS (SELECT *, CASE WHEN confidence >= {GATE[0]} THEN 'auto_accept' WHEN confidence >= {GATE[1]} THEN 'review' ELSE 'pending' END AS gate FROM (SELECT *, CASE WHEN score IS NOT NULL THEN CAST(round(least(1.0, score / 100 + boost), 3) AS DOUBLE) END AS confidence FROM g))
"""


@query(RESOLVED + "SELECT rec_id, name, role, company_id, confidence, gate FROM v")
def company_resolution(spark, d):
    """Every mention with the best company, its confidence and gate."""
    return _resolved(spark, d).select("rec_id", "name", "role", "company_id", "confidence", "gate")


@query(RESOLVED + "SELECT sha256(coalesce(facility_id, '') || '|' || company_id || '|' || role) AS relationship_id, facility_id, company_id, min(company_name) AS company_name, role, max(confidence) AS confidence FROM v WHERE gate = 'auto_accept' GROUP BY facility_id, company_id, role")
def company_relationships(spark, d):
    return companies.relationships(_resolved(spark, d))


@query(RESOLVED + """SELECT (SELECT count(*) FROM facility) AS records, count(*) AS mentions, count(company_id) AS resolved, count(*) FILTER (WHERE gate = 'auto_accept') AS auto_accept, count(*) FILTER (WHERE gate = 'review') AS review, count(*) FILTER (WHERE gate = 'pending') AS pending,
 count(DISTINCT rec_id) AS records_with_mentions, count(DISTINCT coalesce(facility_id, '') || '|' || company_id || '|' || role) FILTER (WHERE gate = 'auto_accept') AS relationships FROM v""")
def company_enrichment_stats(spark, d):
    return companies.enrichment_stats(_facility(spark, d), _resolved(spark, d))


@query(RESOLVED + """, a AS (SELECT * FROM v WHERE gate = 'auto_accept'), o AS (SELECT rec_id, arg_min(company_id, (-confidence, company_id)) AS operator_id FROM a WHERE role = 'operator' GROUP BY 1),
 w AS (SELECT rec_id, array_to_string(list_sort(list(DISTINCT company_id)), '|') AS owner_ids FROM a WHERE role <> 'operator' GROUP BY 1) SELECT rec_id, operator_id, coalesce(owner_ids, '') AS owner_ids FROM facility LEFT JOIN o USING (rec_id) LEFT JOIN w USING (rec_id)""")
def company_backfill(spark, d):
    return companies.linked(_facility(spark, d), _resolved(spark, d))


@query("""WITH a AS (SELECT lower(trim(company_name)) AS k, min(company_id) AS t FROM facility_company_relationships WHERE company_name IS NOT NULL GROUP BY 1), n AS (SELECT DISTINCT unnest(company_mentions).name AS name FROM facility)
 SELECT name, coalesce(t, name) AS canonical FROM n LEFT JOIN a ON lower(trim(name)) = k""")
def alias_map(spark, d):
    """Mentioned names mapped by a table of known spellings."""
    names = _facility(spark, d).select(F.explode("company_mentions.name").alias("name")).distinct()
    known = table(spark, d, "facility_company_relationships").select(F.col("company_name").alias("alias"), F.col("company_id").alias("canonical"))
    return companies.canonical_names(names, known)


MENTIONED = "list_filter(list_transform(coalesce(company_mentions, []), lambda m: m.name), lambda n: n IS NOT NULL)"
LISTED = "(SELECT facility_id, list_sort(list(DISTINCT trim(company_name))) AS added FROM facility_company_relationships WHERE trim(company_name) <> '' GROUP BY 1)"


@query(f"""WITH f AS (SELECT rec_id, {MENTIONED} AS own, coalesce(added, []) AS added FROM facility LEFT JOIN {LISTED} USING (facility_id))
 SELECT rec_id, array_to_string(CASE WHEN len(own) = 0 THEN added ELSE own END, '|') AS filled, array_to_string(CASE WHEN len(own) = 0 THEN added ELSE list_concat(own, list_filter(added, lambda x: NOT list_contains(list_transform(own, lambda y: lower(y)), lower(x)))) END, '|') AS merged FROM f""")
def mentions_backfill(spark, d):
    """Mentions after a backfill from the relationships, where there were none, and merged by force."""
    listed = table(spark, d, "facility_company_relationships").where("trim(company_name) <> ''").select("facility_id", F.trim("company_name").alias("n")).distinct().groupBy("facility_id").agg(F.array_sort(F.collect_list("n")).alias("added"))
    own = F.filter(F.coalesce("company_mentions.name", F.array().cast("array<string>")), lambda n: n.isNotNull())
    rows = _facility(spark, d).select("rec_id", "facility_id", own.alias("own")).join(listed, "facility_id", "left").withColumn("added", F.coalesce("added", F.array().cast("array<string>")))
    return rows.select("rec_id", F.array_join(companies.merged_mentions(F.col("own"), F.col("added")), "|").alias("filled"), F.array_join(companies.merged_mentions(F.col("own"), F.col("added"), force=True), "|").alias("merged"))


@query(f"""WITH p AS (SELECT rec_id, list_filter(list_transform(string_split(array_to_string({MENTIONED}, ';'), ';'), lambda x: trim(x)), lambda x: x <> '') AS l FROM facility)
 SELECT rec_id, coalesce(array_to_string(list_filter(l, lambda x, i: list_position(list_transform(l, lambda y: lower(y)), lower(x)) = i), '|'), '') AS companies FROM p""")
def listed_companies(spark, d):
    joined = F.array_join(F.filter(F.coalesce("company_mentions.name", F.array().cast("array<string>")), lambda n: n.isNotNull()), ";")
    return _facility(spark, d).select("rec_id", F.array_join(companies.listed_companies(joined), "|").alias("companies"))


# Exchange.
TEXTS = "list_filter(coalesce({0}, []), lambda x: x IS NOT NULL AND x <> '')"
SEMI = "CASE WHEN len({0}) > 0 THEN array_to_string({0}, ';') END"
_ALL = TEXTS.format("list_transform(commodities, lambda c: c.metal)")
_MARKED = "list_transform(list_filter(coalesce(commodities, []), lambda c: coalesce(c.is_primary, false) AND coalesce(c.metal, '') <> ''), lambda c: c.metal)"
ROWS = f"""WITH f AS (SELECT *, {_ALL} AS metals, ({_MARKED})[-1] AS prim, {TEXTS.format('list_transform(company_mentions, lambda m: m.name)')} AS nm FROM facility LEFT JOIN country_ref ON country_iso3 = iso3),
 g AS (SELECT *, list_filter(metals, lambda m: prim IS NULL OR m <> prim) AS rest FROM f),
 e AS (SELECT rec_id, facility_id, {SEMI.format('list_filter(nm, lambda x, i: list_position(nm, x) = i)')} AS company_names, name AS facility_name, coalesce(aliases, []) AS alt_names, types[1] AS facility_type, coalesce(country_name, country_iso3) AS country, country_iso3,
  location.lat AS lat, location.lon AS lon, coalesce(location.precision, 'unknown') AS geo_precision, {SEMI.format('metals')} AS commodities, prim AS primary_metal, rest[1] AS secondary_metal, {SEMI.format('rest[2:]')} AS other_metals, {SEMI.format(TEXTS.format('types'))} AS process_stages,
  coalesce(status, 'unknown') AS operating_status, coalesce(array_to_string({TEXTS.format('list_transform(sources, lambda s: s.url)')}, ';'), '') AS evidence_urls, {SEMI.format(TEXTS.format('list_transform(sources, lambda s: s.id)'))} AS evidence_titles, coalesce(verification.confidence, 0.5) AS confidence,
  coalesce(verification.status IN ('human_verified', 'llm_verified'), false) AS is_verified, verification.notes AS verification_notes, verification.last_checked AS last_seen_utc, CASE WHEN len(sources) > 0 THEN coalesce(sources[1].type, 'unknown') END AS source FROM g)
"""
SHOWN = "rec_id facility_id company_names facility_name facility_type country country_iso3 lat lon geo_precision commodities primary_metal secondary_metal other_metals process_stages operating_status evidence_urls evidence_titles confidence is_verified verification_notes last_seen_utc source".split()


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return exchange.exchange_rows(_facility(spark, d), table(spark, d, "country_ref"))


@query(ROWS + f"SELECT {', '.join(SHOWN)}, array_to_string(alt_names, '|') AS alt_names FROM e")
def sync_rows(spark, d):
    """The flat row of each record; columns that are null by definition are left out here."""
    return _rows(spark, d).select(*SHOWN, F.array_join("alt_names", "|").alias("alt_names"))


SPLIT = "list_filter(list_transform(string_split(coalesce({0}, ''), ';'), lambda x: trim(x)), lambda x: x <> '')"


@query(ROWS + f"""SELECT rec_id, facility_name AS name, coalesce(country_iso3, 'UNK') AS country_iso3, array_to_string(CASE WHEN len({SPLIT.format('process_stages')}) > 0 THEN {SPLIT.format('process_stages')} WHEN facility_type IS NOT NULL THEN [facility_type] ELSE ['mine'] END, '|') AS types,
 coalesce(array_to_string(list_transform({SPLIT.format('commodities')}, lambda m, i: m || CASE WHEN i = 1 THEN '*' ELSE '' END), '|'), '') AS commodities, operating_status AS status,
 CAST(greatest(1, len({SPLIT.format('evidence_urls')}) + CASE WHEN source IS NOT NULL THEN 1 ELSE 0 END) AS INTEGER) AS n_sources, CASE WHEN len({SPLIT.format('evidence_urls')}) > 0 AND trim(string_split(evidence_urls, ';')[1]) <> '' THEN nullif(trim(string_split(coalesce(evidence_titles, ''), ';')[1]), '') WHEN len({SPLIT.format('evidence_urls')}) = 0 THEN 'Imported row' END AS first_title,
 CASE WHEN is_verified THEN 'human_verified' ELSE 'llm_suggested' END AS verified, confidence FROM e""")
def sync_round_trip(spark, d):
    """Records written as flat rows and read back."""
    back = exchange.from_exchange(_rows(spark, d), table(spark, d, "country_ref"))
    return back.select(
        "rec_id", "name", "country_iso3", F.array_join("types", "|").alias("types"), F.array_join(F.transform("commodities", lambda c: F.concat(c["metal"], F.when(c["is_primary"], "*").otherwise(""))), "|").alias("commodities"), "status",
        F.size("sources").alias("n_sources"), F.get("sources", F.lit(0))["id"].alias("first_title"), F.col("verification.status").alias("verified"), F.col("verification.confidence").alias("confidence"),
    )


@query("""SELECT count(*) FILTER (WHERE facility_id IS NOT NULL AND facility_id NOT IN (SELECT facility_id FROM facility WHERE facility_id IS NOT NULL)) AS imported, count(*) FILTER (WHERE facility_id IN (SELECT facility_id FROM facility WHERE facility_id IS NOT NULL)) AS skipped,
 count(*) FILTER (WHERE facility_id IS NULL) AS failed FROM facility_company_relationships""")
def sync_import_counts(spark, d):
    """Relationship rows imported as records: skipped where the record exists, failed without an id."""
    target = _facility(spark, d).select("facility_id", F.col("name").alias("title"))
    return exchange.imported(target, table(spark, d, "facility_company_relationships").select("facility_id", F.col("company_name").alias("title")), "facility_id")[1]


# Geocoding.
CODES = "n AS (SELECT k, min(iso3) AS meant FROM (SELECT lower(trim(iso3)) AS k, iso3 FROM country_ref UNION ALL SELECT lower(trim(iso2)), iso3 FROM country_ref UNION ALL SELECT lower(trim(country_name)), iso3 FROM country_ref) WHERE k <> '' GROUP BY 1)"
BARE = "list_distinct(list_filter(string_split({0}, ' '), lambda w: w <> ''))"
FOUND = f"""WITH {CODES}, f AS (SELECT rec_id, country_iso3, location, {MATCHABLE.format('name')} AS nm, meant FROM facility JOIN n ON lower(trim(country_iso3)) = k),
 e AS (SELECT CASE WHEN kind = 'town' THEN 'nominatim' ELSE 'overpass' END AS source, CAST(place_id AS VARCHAR) AS id, {MATCHABLE.format('place_name')} AS nm, country_iso3 AS meant, lat, lon, kind FROM place
  UNION ALL SELECT 'wikidata', company_id, {MATCHABLE.format('company_name')}, meant, lat, lon, 'mine' FROM (SELECT min(relationship_id) AS company_id, company_name, meant, arg_min(lat, relationship_id) AS lat, arg_min(lon, relationship_id) AS lon
   FROM (SELECT relationship_id, company_name, meant, lat, lon FROM facility_company_relationships JOIN (SELECT facility_id, arg_min(meant, rec_id) AS meant, arg_min(facility.location.lat, rec_id) AS lat, arg_min(facility.location.lon, rec_id) AS lon
    FROM f JOIN facility USING (rec_id) WHERE abs(facility.location.lat) <= 90 AND abs(facility.location.lon) <= 180 AND facility.location.lat <> 0 AND facility.location.lon <> 0 GROUP BY 1) USING (facility_id) WHERE company_name IS NOT NULL AND relationship_id IS NOT NULL) GROUP BY 2, 3)),
 c AS (SELECT rec_id, source, id, lat, lon, kind, CASE source WHEN 'overpass' THEN 0.75 WHEN 'wikidata' THEN 0.85 ELSE 0.6 END AS trust, CASE WHEN f.nm = e.nm THEN 1.0 ELSE len(list_intersect({BARE.format('f.nm')}, {BARE.format('e.nm')})) / least(len({BARE.format('f.nm')}), len({BARE.format('e.nm')})) END AS sc
  FROM f JOIN e USING (meant) WHERE list_has_any({BARE.format('f.nm')}, {BARE.format('e.nm')})),
 b AS (SELECT *, round(0.6 * trust + 0.4 * sc, 4) AS confidence FROM c), t AS (SELECT * FROM b WHERE confidence >= 0.6 QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY confidence DESC, source, id) = 1)
"""


def _found(spark: SparkSession, d: str, wanted: str = "true") -> DataFrame:
    """The best entry of three sources for each record that ``wanted`` holds for."""
    codes = spatial.country_codes(table(spark, d, "country_ref"))
    records = geocode.with_country(_facility(spark, d), codes).where("country is not null")
    p = table(spark, d, "place")
    c = F.col
    kinds = [geocode.source_table(p.where(where), source, c("place_id"), c("place_name"), c("country_iso3"), c("kind"), c("lat"), c("lon")) for where, source in (("kind = 'town'", "nominatim"), ("kind is null or kind <> 'town'", "overpass"))]
    seat = records.where((spatial.usable(quality.lat(), quality.lon())) & (quality.lat() != 0) & (quality.lon() != 0) & c("facility_id").isNotNull()).groupBy("facility_id").agg(F.min(F.struct("rec_id", "country", "location.lat", "location.lon")).alias("s"))
    r = table(spark, d, "facility_company_relationships").where("company_name is not null and relationship_id is not null").select("relationship_id", "facility_id", "company_name")
    firms = r.join(seat, "facility_id").groupBy("company_name", F.col("s.country").alias("country")).agg(F.min(F.struct("relationship_id", "s.lat", "s.lon")).alias("x"))
    firms = geocode.source_table(firms, "wikidata", c("x.relationship_id"), c("company_name"), c("country"), F.lit("mine"), c("x.lat"), c("x.lon"))
    return geocode.candidates(records.where(wanted).select("rec_id", "name", "country"), [*kinds, firms])


@query(FOUND + """SELECT rec_id, source, id AS source_id, confidence, CASE source WHEN 'wikidata' THEN 'site' WHEN 'overpass' THEN 'region' ELSE CASE WHEN kind = 'town' THEN 'city' ELSE 'country' END END AS precision FROM t""")
def geocode_sources(spark, d):
    """The best entry of three sources for each record, with its precision."""
    return _found(spark, d).select("rec_id", "source", "source_id", "confidence", "precision")


@query(FOUND + f""", g AS (SELECT facility.country_iso3, CASE WHEN t.lat IS NULL THEN 'skipped' WHEN (round(t.lat, 7) = {fixed.SENTINEL[0]} AND round(t.lon, 7) = {fixed.SENTINEL[1]}) OR abs(t.lat) > 90 OR abs(t.lon) > 180 OR NOT coalesce({_box(fixed.WRITE_BBOX, 't.lat', 't.lon').replace('CASE country_iso3', 'CASE facility.country_iso3')}, true) THEN 'failed' ELSE 'updated' END AS s
  FROM facility LEFT JOIN t USING (rec_id) WHERE facility.location.lat IS NULL OR facility.location.lon IS NULL)
 SELECT country_iso3, count(*) AS processed, count(*) FILTER (WHERE s = 'updated') AS updated, count(*) FILTER (WHERE s = 'skipped') AS skipped, count(*) FILTER (WHERE s = 'failed') AS failed, round(100.0 * count(*) FILTER (WHERE s = 'updated') / count(*), 1) AS success_rate FROM g GROUP BY 1""")
def geocode_backfill_stats(spark, d):
    """Records without a position geocoded through the gate for writing, by country."""
    return geocode.backfill_stats(geocode.geocoded(_facility(spark, d), _found(spark, d)), "country_iso3")


KEY = "replace(lower(coalesce(name, '') || '_' || coalesce(country_iso3, '') || '_' || coalesce(array_to_string(list_sort(list_filter(list_transform(coalesce(commodities, []), lambda c: c.metal), lambda x: x IS NOT NULL)), '_'), '')), ' ', '_')"


@query(f"SELECT rec_id, {KEY} AS key FROM facility")
def query_keys(spark, d):
    return _facility(spark, d).select("rec_id", geocode.query_key(F.col("name"), F.col("country_iso3"), F.col("commodities.metal")).alias("key"))


@query(f"""WITH q AS (SELECT DISTINCT {KEY} AS key FROM facility), c AS (SELECT {KEY} AS key, loaded_at AS ts, location.lat AS lat, location.lon AS lon FROM facility WHERE loaded_at > TIMESTAMP '2025-12-01 00:00:00' - INTERVAL 90 DAYS),
 l AS (SELECT key, max(ts) AS ts FROM c GROUP BY 1), w AS (SELECT key, max(ts) AS ts, arg_max(CASE WHEN lat IS NULL THEN 'negative' ELSE 'hit' END, (ts, rn)) AS outcome FROM (SELECT *, 0 AS rn FROM c) GROUP BY 1)
 SELECT coalesce(outcome, 'miss') AS outcome, count(*) AS queries FROM q LEFT JOIN w USING (key) GROUP BY 1""")
def query_cache_outcomes(spark, d):
    """Cached answers by outcome: positions, negative answers, and misses with the expired ones."""
    f = _facility(spark, d)
    key = geocode.query_key(F.col("name"), F.col("country_iso3"), F.col("commodities.metal")).alias("key")
    cache = f.select(key, F.col("loaded_at").alias("ts"), F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"))
    got = geocode.answered(f.select(key).distinct(), cache, F.lit("2025-12-01 00:00:00+00:00").cast("timestamp"), 90)
    return got.groupBy("outcome").agg(F.count("*").alias("queries"))


@query("""WITH p AS (SELECT place_id, kind, lat, lon, radians(lat) AS f, 25.0 / 6371.0 AS d, radians(CASE kind WHEN 'port' THEN 67.5 ELSE 225.0 END) AS t FROM place)
 SELECT place_id, CASE kind WHEN 'town' THEN round(lat, 5) WHEN 'power_node' THEN NULL ELSE round(degrees(asin(sin(f) * cos(d) + cos(f) * sin(d) * cos(t))), 5) END AS lat,
 CASE kind WHEN 'town' THEN round(lon, 5) WHEN 'power_node' THEN NULL ELSE round(degrees(radians(lon) + atan2(sin(t) * sin(d) * cos(f), cos(d) - sin(f) * sin(asin(sin(f) * cos(d) + cos(f) * sin(d) * cos(t))))), 5) END AS lon FROM p""")
def answer_positions(spark, d):
    """Positions of JSON answers: stated, by distance and wind from a reference, or not found."""
    p = table(spark, d, "place")
    town = F.col("kind") == "town"
    raw = F.to_json(F.struct(
        (F.coalesce("kind", F.lit("")) != "power_node").alias("found"), F.when(town, F.col("lat")).alias("lat"), F.when(town, F.col("lon")).alias("lon"), F.col("lat").alias("ref_lat"), F.col("lon").alias("ref_lon"), F.lit(25.0).alias("distance_km"),
        F.when(F.col("kind") == "port", "ENE").otherwise("SW").alias("direction"),
    ))
    return p.select("place_id", geocode.answer_position(raw).alias("x")).select("place_id", F.round("x.lat", 5).alias("lat"), F.round("x.lon", 5).alias("lon"))


_AT = [("24.05 + (location.lat - floor(location.lat)) * 1.0", "55.00 + (location.lon - floor(location.lon)) * 0.8")]
ZONED = "CASE " + " ".join(f"WHEN sqrt(pow(a - {a}, 2) + pow(o - {o}, 2)) < 0.05 THEN '{t}'" for a, o, t in geocode.ZONES if t) + " END"


@query(f"SELECT rec_id, {ZONED} AS town FROM (SELECT rec_id, {_AT[0][0]} AS a, {_AT[0][1]} AS o FROM facility WHERE location.lat IS NOT NULL AND location.lon IS NOT NULL)")
def zone_towns(spark, d):
    """Towns of industrial zones near points laid over their region."""
    rows = _facility(spark, d).where("location.lat is not null and location.lon is not null").select("rec_id", *(F.expr(e).alias(n) for e, n in zip(_AT[0], "ao")))
    return rows.select("rec_id", geocode.zone_town(F.col("a"), F.col("o"), F.lit(geocode.ZONE_COUNTRY)).alias("town"))


PAREN = "list_filter(list_transform(list_concat(regexp_extract_all(coalesce(name, ''), '\\(([^)]+)\\)', 1), flatten(list_transform(list_filter(coalesce(aliases, []), lambda a: a IS NOT NULL), lambda a: regexp_extract_all(a, '\\(([^)]+)\\)', 1)))), lambda x: trim(x)), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)\\b(mine|plant|pit|smelter|refinery|project)\\b'))"


@query(f"""WITH {CODES}, p AS (SELECT country_iso3 AS meant, min(place_name) AS pt FROM place WHERE kind = 'town' GROUP BY 1) SELECT rec_id, coalesce(nullif(trim(location.town), ''), nullif(trim(({PAREN})[1]), ''), nullif(trim(pt), '')) AS town FROM facility LEFT JOIN n ON lower(trim(country_iso3)) = k LEFT JOIN p USING (meant)""")
def towns_backfill(spark, d):
    """Towns: as they are, else from names, else of a zone, else cached (here one of the country)."""
    return _with_town(spark, d, _facility(spark, d)).select("rec_id", F.col("_town").alias("town"))


def _with_town(spark: SparkSession, d: str, facility: DataFrame) -> DataFrame:
    """``facility`` with the backfilled ``_town``."""
    codes = spatial.country_codes(table(spark, d, "country_ref"))
    cached = table(spark, d, "place").where("kind = 'town'").groupBy(F.col("country_iso3").alias("country")).agg(F.min("place_name").alias("cached"))
    rows = geocode.with_country(facility, codes).join(cached, "country", "left")
    zoned = geocode.zone_town(quality.lat(), quality.lon(), F.col("country"))
    return rows.withColumn("_town", F.coalesce(F.nullif(F.trim("location.town"), F.lit("")), geocode.town_of(enrich.town_from_names(F.coalesce("name", F.lit("")), F.col("aliases")), zoned, F.col("cached"))))


ESCAPED = "array_to_string(list_transform(list_filter(string_split_regex(lower({0}), '\\s+'), lambda w: w <> ''), lambda w: regexp_replace(w, '([^a-z0-9_])', '\\\\\\1', 'g')), '.*')"


@query(f"""SELECT rec_id, '[out:json];area["ISO3166-1"="' || upper(iso2) || '"]->.searchArea;nwr' || CASE WHEN coalesce(r, '') <> '' THEN '["resource"~"' || {_case('r', geocode.OSM_TAGS, "replace(r, ' ', '_')")} || '"]' ELSE '' END
 || CASE WHEN coalesce(p, '') <> '' THEN '["name"~"' || p || '",i]' ELSE '' END || '(area.searchArea);out center tags;' AS ql FROM (SELECT rec_id, iso2, lower(trim(commodities[1].metal)) AS r, {ESCAPED.format('name')} AS p FROM facility JOIN country_ref ON country_iso3 = iso3)""")
def feature_queries(spark, d):
    """Texts of map queries by country, first metal and name."""
    rows = _facility(spark, d).join(F.broadcast(table(spark, d, "country_ref").select("iso3", "iso2")), F.col("country_iso3") == F.col("iso3"))
    return rows.select("rec_id", geocode.feature_query(F.col("iso2"), F.get("commodities", F.lit(0))["metal"], F.col("name")).alias("ql"))


# Notes, names and files.
@query("SELECT rec_id, CASE WHEN coalesce(verification.notes, '') = '' THEN 'checked' ELSE verification.notes || ' | checked' END AS notes FROM facility")
def verification_notes(spark, d):
    return _facility(spark, d).select("rec_id", text.with_note(F.col("verification.notes"), "checked").alias("notes"))


@query("SELECT rec_id, count(*) FILTER (WHERE lower(strip_accents(t)) = lower(strip_accents(coalesce(status, ''))) AND t <> '' AND status <> '') AS equal, count(*) FILTER (WHERE lower(strip_accents(t)) = lower(strip_accents(upper(t))) AND t <> '') AS own FROM (SELECT rec_id, status, unnest(types) AS t FROM facility) GROUP BY 1")
def accents_ignored(spark, d):
    """Types equal to the status, and to themselves in capitals, but for accents and case."""
    rows = _facility(spark, d).select("rec_id", "status", F.explode("types").alias("t"))
    same = text.same_ignoring_accents
    return rows.groupBy("rec_id").agg(F.count_if(same(F.col("t"), F.col("status"))).alias("equal"), F.count_if(same(F.col("t"), F.upper("t"))).alias("own"))


_BASE = "regexp_replace(lower(string_split(file_path, '/')[-1]), '(.)\\.[^.]*$', '\\1')"


@query(f"SELECT raw_id, CASE WHEN b IN ('', '-') OR b IS NULL THEN NULL {' '.join(f'''WHEN contains(b, '{k}') THEN '{v}' ''' for k, v in ingest.DEMONYMS.items())} WHEN length(trim(string_split_regex(b, '[_\\-\\s.]')[1])) >= 2 THEN trim(string_split_regex(b, '[_\\-\\s.]')[1]) END AS country FROM (SELECT raw_id, {_BASE} AS b FROM facility_raw)")
def country_from_files(spark, d):
    return table(spark, d, "facility_raw").select("raw_id", ingest.country_from_file(F.col("file_path")).alias("country"))


@query("SELECT rec_id, array_to_string(list_filter([trim(status), trim(location.town), trim(location.region)], lambda x: x IS NOT NULL AND x NOT IN ('', '-')), ', ') AS other FROM facility")
def other_columns(spark, d):
    """Several columns of one meaning as one cell."""
    return _facility(spark, d).select("rec_id", ingest.joined_cells(F.col("status"), F.col("location.town"), F.col("location.region")).alias("other"))


# Reports.
@query(CANON + """, d AS (SELECT b.rec_id, coalesce(f.country_iso3, '???') AS country, f.canonical_slug AS slug, trim(f.location.town) AS ft, len(list_filter(coalesce(company_mentions, []), lambda m: coalesce(m.role = 'operator' AND trim(m.name) <> '', false))) > 0 AS operated,
 len(list_filter(coalesce(company_mentions, []), lambda m: coalesce(m.role = 'operator', false))) > 0 AS anyop, t[1] AS pt, CAST(t[2] AS DOUBLE) AS tc, core, round(0.15 * CAST(town <> '' AS INTEGER) + 0.35 * CASE WHEN core <> nm THEN 0.9 ELSE 0.6 END + 0.30 * CAST(t[2] AS DOUBLE) + 0.20 * CAST(op <> '' AS INTEGER), 4) AS conf, nm, town, op
 FROM b JOIN facility f USING (rec_id))
 SELECT CASE WHEN grouping(country) = 1 THEN 'ALL' ELSE country END AS country, count(*) AS n, count(*) FILTER (WHERE coalesce(core, '') <> '' OR town <> '' OR op <> '' OR pt <> 'facility') AS canonical_name, count(*) FILTER (WHERE slug <> '') AS canonical_slug, count(*) FILTER (WHERE ft <> '') AS town, count(*) FILTER (WHERE pt <> '') AS primary_type,
 count(*) FILTER (WHERE core <> '') AS display_name, count(*) FILTER (WHERE operated) AS operator_display, count(*) FILTER (WHERE coalesce(ft = '', true)) AS town_missing, count(*) FILTER (WHERE NOT anyop) AS operator_unresolved, count(*) FILTER (WHERE conf < 0.5) AS canonical_name_incomplete,
 count(*) FILTER (WHERE tc IS NULL) AS type_none, count(*) FILTER (WHERE tc < 0.5) AS type_low, count(*) FILTER (WHERE tc >= 0.5 AND tc < 0.8) AS type_medium, count(*) FILTER (WHERE tc >= 0.8) AS type_high FROM d GROUP BY ROLLUP (country)""")
def quality_report(spark, d):
    """Coverage, flags and type confidence by country and over all."""
    f = _facility(spark, d)
    kinds = f.select("rec_id", text.normalize_type(F.try_element_at("types", F.lit(1)))["confidence"].cast("double").alias("tc"))
    return reporting.quality_report(reporting.described(f).join(kinds, "rec_id"), F.col("tc"))


@query("""WITH g AS (SELECT coalesce(country_iso3, '???') AS country, canonical_slug AS slug, count(*) AS holders, list_sort(list(DISTINCT facility_id)) AS ids FROM facility WHERE canonical_slug <> '' AND facility_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)
 SELECT country, slug, holders, array_to_string(ids[1:3], ',') AS examples FROM g ORDER BY holders DESC, country, slug LIMIT 10""")
def slug_collision_report(spark, d):
    """The ten largest groups that share a country and slug, with three of their ids."""
    return reporting.collisions(_facility(spark, d))


@query(f"""WITH f AS (SELECT location.lat AS a, location.lon AS o, coalesce({_box(fixed.BBOX, 'location.lat', 'location.lon')}, true) AS ins, coalesce({_box(fixed.BBOX, 'location.lon', 'location.lat')}, true) AS swp FROM facility),
 g AS (SELECT CASE WHEN a IS NULL OR o IS NULL THEN ['missing_coordinates'] WHEN abs(a) > 90 OR abs(o) > 180 THEN ['invalid_range'] ELSE list_filter([CASE WHEN NOT ins AND swp THEN 'latlon_swap' WHEN NOT ins THEN 'out_of_bounds' END, CASE WHEN a = floor(a) AND o = floor(o) THEN 'suspicious_precision' END], lambda x: x IS NOT NULL) END AS l FROM f)
 SELECT issue, count(*) AS records FROM (SELECT unnest(l) AS issue FROM g) GROUP BY 1""")
def validation_summary(spark, d):
    return reporting.validation_summary(_facility(spark, d))


@query(f"""WITH f AS (SELECT rec_id, location.lat AS a, location.lon AS o, coalesce({_box(fixed.BBOX, 'location.lat', 'location.lon')}, true) AS ins, coalesce({_box(fixed.BBOX, 'location.lon', 'location.lat')}, true) AS swp FROM facility),
 g AS (SELECT *, coalesce(abs(a) <= 90 AND abs(o) <= 180 AND NOT ins AND swp, false) AS fixed FROM f) SELECT rec_id, CASE WHEN fixed THEN o ELSE a END AS lat, CASE WHEN fixed THEN a ELSE o END AS lon, fixed FROM g""")
def bbox_fix_apply(spark, d):
    return quality.swapped_back(_facility(spark, d))


_NONE = "location.lat IS NULL OR location.lon IS NULL"


@query(f"""WITH f AS (SELECT facility_id AS id, country_iso3 AS c, location.lat AS a, location.lon AS o, {_box(fixed.FIX_BOUNDS, 'location.lat', 'location.lon')} AS ins, {_box(fixed.FIX_BOUNDS, 'location.lon', 'location.lat')} AS swp FROM facility WHERE NOT ({_NONE})),
 k AS (SELECT *, coalesce(id IN {_in(fixed.KNOWN_DELETES)}, false) AS gone, coalesce(id IN {_in(fixed.KNOWN_FIXES)}, false) AS known, a = 0 AND o = 0 AS zero FROM f), u AS (SELECT * FROM k WHERE NOT gone AND NOT known AND NOT zero),
 x AS (SELECT 'duplicate_to_delete' AS issue, true AS fixable FROM k WHERE gone UNION ALL SELECT 'known_fix', true FROM k WHERE known AND NOT gone UNION ALL SELECT 'null_island', false FROM k WHERE zero AND NOT gone AND NOT known
  UNION ALL SELECT 'wrong_hemisphere', true FROM u WHERE c IN {_in(fixed.NORTHERN)} AND a < 0 UNION ALL SELECT 'truncated_longitude', false FROM u WHERE NOT coalesce(c IN {_in(fixed.LON_NEAR_1)}, false) AND o BETWEEN 0.5 AND 1.5
  UNION ALL SELECT CASE WHEN swp THEN 'swapped' ELSE 'out_of_bounds' END, false FROM u WHERE NOT ins)
 SELECT issue, count(*) AS found, count(*) FILTER (WHERE fixable) AS fixable FROM x GROUP BY 1""")
def fix_summary(spark, d):
    return reporting.fix_summary(_facility(spark, d))


@query("""SELECT count(*) AS records, count(DISTINCT country_iso3) AS countries, round(100.0 * count(*) FILTER (WHERE coalesce(location.lat <> 0 AND location.lon <> 0, false)) / count(*), 1) AS pct_position, round(100.0 * count(*) FILTER (WHERE len(commodities) > 0) / count(*), 1) AS pct_commodities FROM facility""")
def stats_overview(spark, d):
    point = F.coalesce((quality.lat() != 0) & (quality.lon() != 0), F.lit(False))
    share = lambda c: F.round(100.0 * F.count_if(c) / F.count("*"), 1)
    return _facility(spark, d).agg(F.count("*").alias("records"), F.countDistinct("country_iso3").alias("countries"), share(point).alias("pct_position"), share(F.size("commodities") > 0).alias("pct_commodities"))


@query(f"SELECT rec_id, ({SECOND})[1] AS metal FROM facility WHERE len({SECOND}) > 0 ORDER BY rec_id LIMIT 5")
def secondary_metal_sample(spark, d):
    """The first five records with a secondary metal."""
    rest = export.metals(False)
    return _facility(spark, d).where(F.size(rest) > 0).select("rec_id", F.get(rest, F.lit(0)).alias("metal")).orderBy("rec_id").limit(5)


@query("SELECT rec_id, name FROM facility WHERE location.lat IS NULL OR location.lon IS NULL ORDER BY facility_id NULLS FIRST, rec_id LIMIT 20")
def geocode_todo(spark, d):
    """The first twenty records to be geocoded, in order of their id."""
    return _facility(spark, d).where("location.lat is null or location.lon is null").orderBy("facility_id", "rec_id").limit(20).select("rec_id", "name")


@query("SELECT rec_id, name FROM facility WHERE country_iso3 = 'CHL' ORDER BY rec_id LIMIT 50")
def browse_country(spark, d):
    return _facility(spark, d).where("country_iso3 = 'CHL'").orderBy("rec_id").limit(50).select("rec_id", "name")


@query("SELECT rec_id, name FROM facility WHERE len(list_filter(coalesce(commodities, []), lambda c: coalesce(contains(lower(c.metal), 'copp'), false))) > 0 ORDER BY rec_id LIMIT 30")
def browse_commodity(spark, d):
    hit = F.exists("commodities", lambda c: F.coalesce(F.lower(c["metal"]).contains("copp"), F.lit(False)))
    return _facility(spark, d).where(F.coalesce(hit, F.lit(False))).orderBy("rec_id").limit(30).select("rec_id", "name")


@query("SELECT country_iso3, count(*) AS written FROM facility WHERE country_iso3 IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def written_by_country(spark, d):
    return _facility(spark, d).where("country_iso3 is not null").groupBy("country_iso3").agg(F.count("*").alias("written")).orderBy(F.desc("written"), "country_iso3").limit(10)


@query()
def backfill_all(spark, d):
    """All backfills in their order: positions, metals, companies, towns, then names of the result.

    What a record tells by itself is added to its row; only positions, sought for the records without
    one, and companies are joined by ``rec_id``, and names are made in the same pass."""
    f = _facility(spark, d)
    found = _found(spark, d, "location.lat is null or location.lon is null")
    points = geocode.geocoded(f, found).where("status = 'updated'").select("rec_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    rows = _with_town(spark, d, f).withColumn("commodities", enrich.commodities_filled(table(spark, d, "canonical_term")))
    rows = rows.where("rec_id is not null").join(points, "rec_id", "left").join(companies.operators(_resolved(spark, d)), "rec_id", "left")
    spot = F.struct(F.coalesce("location.lat", "_lat").alias("lat"), F.coalesce("location.lon", "_lon").alias("lon"), F.col("location.precision").alias("precision"), F.col("_town").alias("town"), F.col("location.region").alias("region"))
    done = rows.withColumn("location", spot).withColumns({"lat": F.col("location.lat"), "lon": F.col("location.lon"), "town": F.col("location.town"), "n_commodities": F.size("commodities")})
    return enrich.canonical(done, "lat", "lon", "town", "operator_id", "n_commodities")
