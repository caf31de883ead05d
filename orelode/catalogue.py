"""Queries over facility records, each with the same result in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orelode.functions import fixed, text
from orelode.operators import dedupe, export, geocode, quality, spatial
from orelode.plans.runtime import bounded, table

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


def _in(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def _case(expr: str, mapping: dict, default: str) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {default} END"


def _box(table_: dict, lat: str, lon: str) -> str:
    return "CASE country_iso3 " + " ".join(f"WHEN '{k}' THEN ({lat} BETWEEN {a} AND {b} AND {lon} BETWEEN {c} AND {e})" for k, (a, b, c, e) in table_.items()) + " END"


LIST = "coalesce({0}, [])"
PRIMARY = "list_filter(list_transform(list_filter(coalesce(commodities, []), lambda c: coalesce(c.is_primary, false)), lambda c: c.metal), lambda m: m IS NOT NULL)"
SECOND = "list_filter(list_transform(list_filter(coalesce(commodities, []), lambda c: NOT coalesce(c.is_primary, false)), lambda c: c.metal), lambda m: m IS NOT NULL)"
AUDIT = f"""
WITH f AS (SELECT *, coalesce(location.lat = 0 OR location.lon = 0, true) OR location.lat IS NULL OR location.lon IS NULL AS no_point FROM facility),
i AS (SELECT rec_id, facility_id, unnest(list_filter([
  CASE WHEN regexp_matches(trim(coalesce(name, '')), '^[0-9]+$') THEN 'numeric_name' END,
  CASE WHEN regexp_matches(lower(trim(coalesce(name, ''))), '{"|".join(g.replace(chr(92) + "d", "[0-9]") for g in fixed.GENERIC_NAMES)}') THEN 'generic_name' END,
  CASE WHEN no_point THEN 'no_coordinates' END,
  CASE WHEN NOT no_point AND location.precision = 'unknown' THEN 'imprecise_location' END,
  CASE WHEN len({LIST.format('commodities')}) = 0 THEN 'no_commodities' END,
  CASE WHEN len({LIST.format('commodities')}) > 0 AND len(list_filter(commodities, lambda c: coalesce(c.is_primary, false))) = 0 THEN 'no_primary_commodity' END,
  CASE WHEN len(list_filter({LIST.format('company_mentions')}, lambda m: coalesce(m.role IN ('operator', 'owner', 'majority_owner', 'minority_owner'), false))) = 0 THEN 'no_operator_owner' END,
  CASE WHEN coalesce(status, 'unknown') = 'unknown' THEN 'unknown_status' END,
  CASE WHEN coalesce(verification.confidence, 0) < 0.5 THEN 'low_confidence' END,
  CASE WHEN len({LIST.format('sources')}) = 0 THEN 'no_sources' END,
  CASE WHEN len({LIST.format('types')}) = 0 OR (len(types) = 1 AND coalesce(types[1] = 'mine', false)) THEN 'generic_type' END
], lambda x: x IS NOT NULL)) AS issue FROM f)
"""


@query(AUDIT + "SELECT issue, count(*) AS records, count(DISTINCT facility_id) AS sites FROM i GROUP BY issue")
def audit_issue_counts(spark, d):
    return quality.audited(_facility(spark, d)).groupBy("issue").agg(F.count("*").alias("records"), F.countDistinct("facility_id").alias("sites"))


@query(AUDIT + "SELECT count(DISTINCT facility_id) AS sites, count(*) AS issues FROM i")
def audit_distinct_sites(spark, d):
    return quality.audited(_facility(spark, d)).agg(F.countDistinct("facility_id").alias("sites"), F.count("*").alias("issues"))


@query(AUDIT + "SELECT issue, rec_id FROM i QUALIFY row_number() OVER (PARTITION BY issue ORDER BY rec_id) <= 5")
def audit_topk_per_issue(spark, d):
    return quality.least_per_issue(quality.audited(_facility(spark, d)), 5)


@query("""SELECT country_iso3, count(*) AS records, count(DISTINCT facility_id) AS sites, count(*) FILTER (WHERE coalesce(location.lat <> 0 AND location.lon <> 0, false)) AS with_point,
 count(*) FILTER (WHERE len(commodities) > 0) AS with_commodities FROM facility GROUP BY country_iso3""")
def stats_by_country(spark, d):
    point = F.coalesce((quality.lat() != 0) & (quality.lon() != 0), F.lit(False))
    return _facility(spark, d).groupBy("country_iso3").agg(F.count("*").alias("records"), F.countDistinct("facility_id").alias("sites"), F.count_if(point).alias("with_point"), F.count_if(F.size("commodities") > 0).alias("with_commodities"))


@query("SELECT coalesce(status, 'unknown') AS status, count(*) AS records FROM facility GROUP BY 1")
def stats_status(spark, d):
    return _facility(spark, d).groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("records"))


@query("SELECT country_iso3, count(*) AS records FROM facility WHERE country_iso3 IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top10_countries(spark, d):
    return _facility(spark, d).where("country_iso3 is not null").groupBy("country_iso3").agg(F.count("*").alias("records")).orderBy(F.desc("records"), "country_iso3").limit(10)


@query("""SELECT CASE WHEN grouping(country_iso3) = 1 THEN 'ALL' ELSE coalesce(country_iso3, 'none') END AS country, count(*) AS records, count(name) AS named, count(canonical_slug) AS slugged, count(location.town) AS with_town,
 count(*) FILTER (WHERE verification.confidence >= 0.8) AS high, count(*) FILTER (WHERE len(types) > 0) AS typed
 FROM facility GROUP BY ROLLUP (country_iso3)""")
def qc_by_country_rollup(spark, d):
    return _facility(spark, d).rollup("country_iso3").agg(
        F.grouping("country_iso3").alias("whole"),
        F.count("*").alias("records"), F.count("name").alias("named"), F.count("canonical_slug").alias("slugged"), F.count("location.town").alias("with_town"), F.count_if(F.col("verification.confidence") >= 0.8).alias("high"), F.count_if(F.size("types") > 0).alias("typed")
    ).select(F.when(F.col("whole") == 1, "ALL").otherwise(F.coalesce("country_iso3", F.lit("none"))).alias("country"), "records", "named", "slugged", "with_town", "high", "typed")


@query("""SELECT country_iso3, count(*) FILTER (WHERE c IS NULL) AS "none", count(*) FILTER (WHERE c < 0.5) AS low, count(*) FILTER (WHERE c >= 0.5 AND c < 0.8) AS medium, count(*) FILTER (WHERE c >= 0.8) AS high
 FROM (SELECT country_iso3, verification.confidence AS c FROM facility) GROUP BY country_iso3""")
def confidence_buckets_pivot(spark, d):
    rows = _facility(spark, d).select("country_iso3", quality.confidence_bucket(F.col("verification.confidence")).alias("b"))
    return rows.groupBy("country_iso3").pivot("b", ["none", "low", "medium", "high"]).agg(F.count(F.lit(1))).na.fill(0, ["none", "low", "medium", "high"])


SLUG = "regexp_replace(regexp_replace(regexp_replace(lower(trim({0})), '\\([^)]*\\)', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(f"SELECT country_iso3, {SLUG.format('name')} AS slug, count(DISTINCT facility_id) AS holders, min(facility_id) AS first_id FROM facility WHERE name IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT facility_id) > 1")
def slug_collisions(spark, d):
    rows = _facility(spark, d).where("name is not null").groupBy("country_iso3", text.slugify(F.col("name")).alias("slug"))
    return rows.agg(F.countDistinct("facility_id").alias("holders"), F.min("facility_id").alias("first_id")).where("holders > 1")


@query(f"SELECT rec_id, {SLUG.format('name')} AS slug, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS name_norm FROM facility")
def slugify_names(spark, d):
    return _facility(spark, d).select("rec_id", text.slugify(F.col("name")).alias("slug"), text.name_norm(F.col("name")).alias("name_norm"))


@query(f"SELECT {SLUG.format('publisher')} AS slug, count(*) AS documents FROM documents GROUP BY 1")
def slugify_publishers(spark, d):
    return table(spark, d, "documents").groupBy(text.slugify(F.col("publisher")).alias("slug")).agg(F.count("*").alias("documents"))


@query(f"""WITH t AS (SELECT DISTINCT t AS raw FROM (SELECT unnest(types) AS t FROM facility)), n AS (SELECT raw, lower(trim(raw)) AS r, replace(replace(lower(trim(raw)), '_', ' '), '-', ' ') AS fl FROM t),
 c AS (SELECT raw, CASE WHEN raw IS NULL OR raw = '' THEN ['facility', '0.2'] WHEN regexp_matches(replace(replace(r, '.', ''), '-', ''), '^[0-9]+$') THEN ['facility', '0.1']
  WHEN r IN {_in(fixed.TYPE_MAPPING)} THEN [{_case('r', fixed.TYPE_MAPPING, 'NULL')}, '0.95'] WHEN fl IN {_in(fixed.TYPE_MAPPING)} THEN [{_case('fl', fixed.TYPE_MAPPING, 'NULL')}, '0.9']
  {' '.join(f"WHEN contains(r, '{k}') THEN ['{v}', '0.85']" for k, v in fixed.TYPE_MAPPING.items())} ELSE ['facility', '0.3'] END AS p FROM n)
 SELECT raw, p[1] AS type, CAST(p[2] AS DOUBLE) AS confidence FROM c""")
def normalize_type(spark, d):
    raw = _facility(spark, d).select(F.explode("types").alias("raw")).distinct()
    return raw.select("raw", text.normalize_type(F.col("raw")).alias("p")).select("raw", "p.type", F.col("p.confidence").cast("double").alias("confidence"))


@query(f"""WITH s AS (SELECT rec_id, status AS c, regexp_extract(lower(status), '\\b({fixed.STATUS_WORDS})\\b', 1) AS w FROM facility)
 SELECT rec_id, CASE WHEN c IS NULL OR trim(c) IN ('', '-') THEN 'unknown' WHEN w <> '' THEN {_case('w', fixed.STATUSES, "'unknown'")} ELSE {_case('lower(trim(c))', fixed.STATUSES, "'unknown'")} END AS status FROM s""")
def parse_status(spark, d):
    return _facility(spark, d).select("rec_id", text.parse_status(F.col("status")).alias("status"))


@query(f"""WITH s AS (SELECT rec_id, array_to_string(list_filter(types, lambda t: t IS NOT NULL), ';') AS c FROM facility), p AS (SELECT rec_id, c, list_filter(list_transform(string_split_regex(lower(c), '[,;]'), lambda t: {_case('trim(t)', fixed.TYPES, 'trim(t)')}), lambda t: t <> '') AS l FROM s)
 SELECT rec_id, CASE WHEN c IS NULL OR trim(c) IN ('', '-') OR len(l) = 0 THEN 'mine' ELSE array_to_string(list_sort(list_distinct(l)), '|') END AS types FROM p""")
def parse_types(spark, d):
    joined = F.array_join(F.filter("types", lambda t: t.isNotNull()), ";")
    return _facility(spark, d).select("rec_id", F.array_join(F.array_sort(text.parse_types(joined)), "|").alias("types"))


@query("""SELECT rec_id, CASE WHEN c >= 0.85 THEN 'Very High' WHEN c >= 0.75 THEN 'High' WHEN c >= 0.60 THEN 'Moderate' WHEN c >= 0.40 THEN 'Low' ELSE 'Very Low' END AS label FROM (SELECT rec_id, verification.confidence AS c FROM facility)""")
def confidence_label(spark, d):
    return _facility(spark, d).select("rec_id", text.confidence_label(F.col("verification.confidence")).alias("label"))


@query(f"""SELECT rec_id, CASE WHEN types IS NULL OR len(types) = 0 THEN 'Mine' ELSE array_to_string(list_transform(list_filter(types, lambda t: t IS NOT NULL), lambda t: {_case('lower(t)', fixed.ASSET_TYPES, 't')}), ';') END AS asset_types FROM facility""")
def asset_types(spark, d):
    return _facility(spark, d).select("rec_id", text.asset_types(F.col("types")).alias("asset_types"))


@query(f"SELECT {_case('lower(trim(m))', fixed.METALS, 'lower(trim(m))')} AS metal, count(*) AS mentions FROM (SELECT unnest(commodities).metal AS m FROM facility) GROUP BY 1")
def metal_synonyms(spark, d):
    return _facility(spark, d).select(F.explode("commodities.metal").alias("m")).groupBy(text.normalize_metal(F.col("m")).alias("metal")).agg(F.count("*").alias("mentions"))


_METALS = "list_transform(list_filter(list_transform(string_split_regex(array_to_string({0}, ';'), '[,;]'), lambda m: trim(m)), lambda m: m NOT IN ('', '-')), lambda m: {{'m': " + _case("lower(trim(m))", fixed.METALS, "lower(trim(m))") + ", 'p': {1}}})"


@query(f"""WITH c AS (SELECT rec_id, list_concat({_METALS.format(PRIMARY, "true")}, {_METALS.format(SECOND, "false")}) AS l FROM facility), u AS (SELECT rec_id, l, list_transform(l, lambda x: x.m) AS ms FROM c)
 SELECT rec_id, coalesce(array_to_string(list_transform(list_filter(l, lambda x, i: list_position(ms, x.m) = i), lambda x: x.m || CASE WHEN x.p THEN '*' ELSE '' END), '|'), '') AS metals FROM u""")
def parse_commodities(spark, d):
    """Metals as typed, split, normalised and distinct, primary ones marked with a star."""
    parsed = text.parse_commodities(F.array_join(export.metals(True), ";"), F.array_join(export.metals(False), ";"))
    return _facility(spark, d).select("rec_id", F.array_join(F.transform(parsed, lambda x: F.concat(x["metal"], F.when(x["primary"], "*").otherwise(""))), "|").alias("metals"))


def _hash_sql(lat: str, lon: str, length: int) -> str:
    """Geohash of two numbers as SQL: cell numbers of both axes, their bits interleaved."""
    total = 5 * length
    east, north = total - total // 2, total // 2
    number = lambda c, half, bits: f"greatest(0, least({(1 << bits) - 1}, CAST(ceil(({c} + {half}) / {2 * half / (1 << bits)!r}) AS BIGINT) - 1))"
    chars = []
    for at in range(length):
        bit = [f"((({number(lon, 180.0, east)}) >> {east - 1 - p // 2}) & 1)" if p % 2 == 0 else f"((({number(lat, 90.0, north)}) >> {north - 1 - p // 2}) & 1)" for p in range(5 * at, 5 * at + 5)]
        chars.append("substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST(1 + " + " + ".join(f"{1 << (4 - i)} * {x}" for i, x in enumerate(bit)) + " AS INTEGER), 1)")
    return f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN {' || '.join(chars)} END"


@query(f"SELECT rec_id, {_hash_sql('location.lat', 'location.lon', 7)} AS geohash FROM facility")
def geohash7(spark, d):
    return _facility(spark, d).select("rec_id", text.geohash(F.col("location.lat"), F.col("location.lon")).alias("geohash"))


CODES = "codes AS (SELECT k, min(iso3) AS meant FROM (SELECT lower(trim(iso3)) AS k, iso3 FROM country_ref UNION ALL SELECT lower(trim(iso2)), iso3 FROM country_ref UNION ALL SELECT lower(trim(country_name)), iso3 FROM country_ref) WHERE k <> '' GROUP BY 1)"


def _located(spark: SparkSession, d: str) -> DataFrame:
    """Records with a usable position and the ``country`` that their notation means."""
    rows = _facility(spark, d).where(spatial.usable(quality.lat(), quality.lon())).select("rec_id", "country_iso3", quality.lat().alias("lat"), quality.lon().alias("lon"))
    return geocode.with_country(rows, spatial.country_codes(table(spark, d, "country_ref"))).where("country is not null")


@query(f"""WITH {CODES}, p AS (SELECT f.rec_id, q.place_id, 2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians(q.lat - f.location.lat) / 2), 2) + cos(radians(f.location.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - f.location.lon) / 2), 2)))) AS km
 FROM facility f JOIN codes ON lower(trim(f.country_iso3)) = k JOIN place q ON meant = q.country_iso3 WHERE abs(f.location.lat) <= 90 AND abs(f.location.lon) <= 180 AND NOT (f.location.lat = 0 AND f.location.lon = 0))
 SELECT rec_id, arg_min(place_id, (round(km, 4), place_id)) AS place_id, round(min(km), 3) AS km FROM p GROUP BY rec_id""")
def nearest_place(spark, d):
    """The nearest place of each record's country, whatever notation the record has for it."""
    p = table(spark, d, "place").select("place_id", F.col("country_iso3").alias("country"), F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    rows = _located(spark, d).join(bounded(p, 100_000), "country").withColumn("km", spatial.haversine_km(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")))
    return rows.groupBy("rec_id").agg(F.min_by("place_id", F.struct(F.round("km", 4), F.col("place_id"))).alias("place_id"), F.round(F.min("km"), 3).alias("km"))


@query("""WITH r AS (SELECT rec_id, location.lat AS lat, location.lon AS lon, radians(location.lat) AS p, radians(45.0) AS t, 50.0 / 6371.0 AS d FROM facility WHERE abs(location.lat) <= 85 AND abs(location.lon) <= 180),
 x AS (SELECT *, asin(sin(p) * cos(d) + cos(p) * sin(d) * cos(t)) AS q FROM r)
 SELECT rec_id, round(degrees(q), 5) AS lat, round(degrees(radians(lon) + atan2(sin(t) * sin(d) * cos(p), cos(d) - sin(p) * sin(q))), 5) AS lon FROM x""")
def bearing_destination(spark, d):
    rows = _facility(spark, d).where((F.abs(quality.lat()) <= 85) & (F.abs(quality.lon()) <= 180))
    return rows.select("rec_id", text.destination(quality.lat(), quality.lon(), F.lit(50.0), F.lit(45.0)).alias("to")).select("rec_id", F.round("to.lat", 5).alias("lat"), F.round("to.lon", 5).alias("lon"))


@query("""WITH r AS (SELECT relationship_id, company_name || ' (' || CAST(round(percentage) AS INTEGER) || '%), Rest ' || (100 - CAST(round(percentage) AS INTEGER)) || '%' AS t FROM facility_company_relationships WHERE company_name IS NOT NULL AND percentage IS NOT NULL),
 m AS (SELECT DISTINCT t, regexp_extract_all(t, '([^,;()%]+?)\\s*\\(?\\s*([0-9]+(?:\\.[0-9]+)?)\\s*%\\s*\\)?', 1) AS n, regexp_extract_all(t, '([^,;()%]+?)\\s*\\(?\\s*([0-9]+(?:\\.[0-9]+)?)\\s*%\\s*\\)?', 2) AS p FROM r),
 u AS (SELECT t, unnest(n) AS n, CAST(unnest(p) AS DOUBLE) AS p FROM m) SELECT t AS text, trim(n) AS name, p AS percentage, CASE WHEN p > 50 THEN 'owner' ELSE 'minority_owner' END AS role FROM u""")
def ownership_parse(spark, d):
    share = F.round("percentage").cast("int")
    rel = table(spark, d, "facility_company_relationships").where("company_name is not null and percentage is not null")
    rows = rel.select(F.concat("company_name", F.lit(" ("), share.cast("string"), F.lit("%), Rest "), (100 - share).cast("string"), F.lit("%")).alias("text")).distinct()
    return rows.select("text", F.explode(text.owners(F.col("text"))).alias("o")).select("text", "o.name", "o.percentage", "o.role")


JOINED = "coalesce(array_to_string(list_filter(coalesce({0}, []), lambda x: x IS NOT NULL), ','), '')"
NAMED = "list_filter(list_transform(coalesce(company_mentions, []), lambda m: m.name), lambda n: n IS NOT NULL AND n <> '')"


@query(f"""SELECT rec_id, coalesce(facility_id, '') AS facility_id, coalesce(name, '') AS name, coalesce(country_iso3, '') AS country_iso3, coalesce(status, '') AS status, location.lat AS latitude, location.lon AS longitude,
 coalesce(location.precision, '') AS location_precision, coalesce(location.region, '') AS location_region, {JOINED.format('types')} AS types, coalesce(({PRIMARY})[1], '') AS primary_commodity,
 array_to_string({SECOND}, ',') AS secondary_commodities, {JOINED.format('list_transform(commodities, lambda c: c.metal)')} AS all_commodities, array_to_string({NAMED}, ',') AS company_mentions, {JOINED.format('aliases')} AS aliases,
 verification.confidence AS confidence, CAST(len(coalesce(sources, [])) AS INTEGER) AS source_count, array_to_string(list_sort(list_distinct(list_filter(list_transform(coalesce(sources, []), lambda s: s.type), lambda t: t IS NOT NULL AND t <> ''))), ',') AS source_types,
 coalesce(left(verification.notes, 500), '') AS notes FROM facility""")
def flatten_records(spark, d):
    return export.flattened(_facility(spark, d))


@query("""WITH c AS (SELECT rec_id, unnest(commodities) AS c, generate_subscripts(commodities, 1) - 1 AS pos FROM facility) SELECT rec_id, CAST(pos AS INTEGER) AS pos, trim(c.metal) AS material_name, coalesce(c.is_primary, false) AS is_primary FROM c WHERE trim(c.metal) <> ''""")
def bridge_materials(spark, d):
    return export.bridge_materials(_facility(spark, d))


@query("""WITH m AS (SELECT rec_id, unnest(company_mentions) AS m FROM facility) SELECT DISTINCT rec_id, trim(m.name) AS company_name, CASE WHEN lower(m.role) = 'operator' THEN 'operator' WHEN lower(m.role) IN ('owner', 'majority_owner', 'minority_owner') THEN 'owner' ELSE 'mention' END AS relationship_type, coalesce(m.lei, '') AS lei FROM m WHERE trim(m.name) <> ''""")
def bridge_companies(spark, d):
    return export.bridge_companies(_facility(spark, d))


@query(f"""SELECT rec_id, CASE WHEN conf >= 0.85 THEN 'Very High' WHEN conf >= 0.75 THEN 'High' WHEN conf >= 0.60 THEN 'Moderate' WHEN conf >= 0.40 THEN 'Low' ELSE 'Very Low' END AS confidence_factor,
 array_to_string(list_concat([coalesce(name, '')], list_filter(coalesce(aliases, []), lambda a: a IS NOT NULL AND a <> '' AND a <> coalesce(name, ''))), ';') AS mine_name,
 array_to_string(list_filter({NAMED}, lambda x, i: list_position({NAMED}, x) = i), ';') AS company_names, CASE WHEN coalesce(location.lat, 0) = 0 THEN '' ELSE format('{{:.5f}}', location.lat) END AS latitude, CASE WHEN coalesce(location.lon, 0) = 0 THEN '' ELSE format('{{:.5f}}', location.lon) END AS longitude,
 CASE WHEN types IS NULL OR len(types) = 0 THEN 'Mine' ELSE array_to_string(list_transform(list_filter(types, lambda t: t IS NOT NULL), lambda t: {_case('lower(t)', fixed.ASSET_TYPES, 't')}), ';') END AS asset_type, coalesce(country_name, '') AS country_or_region,
 coalesce(({PRIMARY})[1], '') AS primary_commodity, coalesce(({SECOND})[1], '') AS secondary_commodity, array_to_string(({SECOND})[2:], ',') AS other_commodities
 FROM (SELECT facility.*, coalesce(verification.confidence, 0.5) AS conf, country_name FROM facility LEFT JOIN country_ref ON country_iso3 = iso3)""")
def mines_csv_rows(spark, d):
    return export.mines_rows(_facility(spark, d), table(spark, d, "country_ref"))


@query("SELECT rec_id FROM facility WHERE len(list_filter(commodities, lambda c: coalesce(split_part(c.category, '_', 1) = 'battery', false))) > 0")
def filter_metal_basket(spark, d):
    return _facility(spark, d).where(export.has_metal("battery metals")).select("rec_id")


@query("SELECT rec_id FROM facility WHERE len(list_filter(commodities, lambda c: coalesce(lower(trim(c.metal)) <> '' AND (contains(lower(trim(c.metal)), 'copper') OR contains('copper', lower(trim(c.metal)))), false))) > 0")
def filter_metal_substring(spark, d):
    return _facility(spark, d).where(export.has_metal("Copper")).select("rec_id")


@query("""SELECT rec_id FROM facility WHERE len(list_filter(company_mentions, lambda m: coalesce(trim(lower(m.name)) <> '' AND (contains(lower(m.name), 'mining tramu kochubahe') OR contains('mining tramu kochubahe', lower(m.name))
 OR list_has_all(string_split_regex(trim(lower(m.name)), '\\s+'), ['mining', 'tramu', 'kochubahe']) OR list_has_all(['mining', 'tramu', 'kochubahe'], string_split_regex(trim(lower(m.name)), '\\s+'))), false))) > 0""")
def filter_company_fuzzy(spark, d):
    return _facility(spark, d).where(export.has_company("Mining Tramu Kochubahe")).select("rec_id")


@query("SELECT rec_id FROM facility WHERE coalesce(contains(lower(name), 'hill'), false) OR len(list_filter(aliases, lambda a: coalesce(contains(lower(a), 'hill'), false))) > 0")
def browse_name_contains(spark, d):
    return _facility(spark, d).where(export.name_contains("Hill")).select("rec_id")


@query("SELECT rec_id, facility_id FROM facility f JOIN country_ref c ON c.country_name = 'Chile' AND f.country_iso3 IN (c.iso3, c.iso2)")
def filter_country(spark, d):
    ref = table(spark, d, "country_ref").where("country_name = 'Chile'").select(F.explode(F.array("iso3", "iso2")).alias("country_iso3"))
    return _facility(spark, d).join(bounded(ref, 10_000), "country_iso3", "left_semi").select("rec_id", "facility_id")


CLASSES = """WITH r AS (SELECT rec_id, lower(coalesce(name, '')) AS low, list_sort(list_distinct(list_transform(list_filter(coalesce(aliases, []), lambda a: a IS NOT NULL), lambda a: lower(a)))) AS al, location.lat AS lat, location.lon AS lon FROM facility
 WHERE abs(location.lat) <= 90 AND abs(location.lon) <= 180 AND NOT (location.lat = 0 AND location.lon = 0)),
 k AS (SELECT low, al, lat, lon, min(rec_id) AS id, count(*) AS n, CAST(round_even(lat * 10, 0) AS INTEGER) AS y, CAST(round_even(lon * 10, 0) AS INTEGER) AS x FROM r GROUP BY low, al, lat, lon),
 p AS (SELECT a.id AS id_a, b.id AS id_b, a.low AS la, b.low AS lb, a.al AS aa, b.al AS ab, abs(a.lat - b.lat) AS dy, abs(a.lon - b.lon) AS dx,
  list_distinct(list_filter(string_split_regex(a.low, '\\s+'), lambda w: w <> '')) AS wa, list_distinct(list_filter(string_split_regex(b.low, '\\s+'), lambda w: w <> '')) AS wb FROM k a JOIN k b ON a.y = b.y AND a.x = b.x AND a.id < b.id),
 q AS (SELECT id_a, id_b, CASE WHEN dy < 0.1 AND dx < 0.1 AND (contains(la, lb) OR contains(lb, la)) THEN 'near_contained' WHEN least(len(wa), len(wb)) > 0 AND len(list_intersect(wa, wb)) / least(len(wa), len(wb)) > 0.8 THEN 'words'
  WHEN list_contains(ab, la) OR list_contains(aa, lb) THEN 'alias' END AS reason FROM p)
"""


@query(CLASSES + "SELECT id AS class_id, n AS n_records, count(*) OVER (PARTITION BY y, x) - 1 AS n_candidates FROM k")
def dedupe_candidates(spark, d):
    return dedupe.candidate_counts(dedupe.classes(_facility(spark, d)))


@query(CLASSES + "SELECT id_a, id_b, reason FROM q WHERE reason IS NOT NULL")
def dedupe_native_predicate(spark, d):
    return dedupe.candidate_pairs(dedupe.classes(_facility(spark, d))).select("id_a", "id_b", dedupe.native_reason().alias("reason")).where("reason is not null")


@query()
def dedupe_seq_ratio(spark, d):
    return dedupe.fuzzy_pairs(dedupe.classes(_facility(spark, d)))


@query()
def dedupe_star_clusters(spark, d):
    return dedupe.star_clusters(dedupe.classes(_facility(spark, d)))


SCORE = """(CASE WHEN location.lat IS NOT NULL THEN 10.0 ELSE 0.0 END + 2 * len(coalesce(commodities, [])) + 3 * len(coalesce(company_mentions, [])) + len(coalesce(aliases, [])) + CASE WHEN status IS NULL OR status <> 'unknown' THEN 5 ELSE 0 END
 + 10 * coalesce(verification.confidence, 0.0) + CASE verification.status WHEN 'human_verified' THEN 20 WHEN 'csv_imported' THEN 10 WHEN 'llm_verified' THEN 5 ELSE 0 END)"""


@query(f"SELECT facility_id, arg_max(rec_id, (round({SCORE}, 6), -rec_id)) AS rec_id, round(max({SCORE}), 4) AS score, count(*) AS n_records FROM facility WHERE facility_id IS NOT NULL GROUP BY facility_id")
def dedupe_best_record(spark, d):
    return dedupe.best_records(_facility(spark, d), "facility_id")


@query(f"""WITH b AS (SELECT facility_id, arg_max(name, (round({SCORE}, 6), -rec_id)) AS best FROM facility WHERE facility_id IS NOT NULL GROUP BY facility_id), n AS (SELECT facility_id, unnest(list_concat(coalesce(aliases, []), [name])) AS a FROM facility)
 SELECT facility_id, array_to_string(list_sort(list(DISTINCT a)), '|') AS aliases FROM n JOIN b USING (facility_id) WHERE a IS NOT NULL AND trim(a) <> '' AND a <> best GROUP BY facility_id""")
def dedupe_merge_aliases(spark, d):
    return dedupe.merged_aliases(_facility(spark, d), "facility_id")


CUT = "TIMESTAMP '2025-10-01 00:00:00'"


WORDS = "list_distinct(list_filter(string_split_regex({0}, '\\s+'), lambda w: w <> ''))"
NEW_OLD = f"""WITH f AS (SELECT rec_id, facility_id, coalesce(country_iso3, '') AS c, lower(name) AS low, location.lat AS a, location.lon AS o, loaded_at, coalesce(location.lat = 0 OR location.lon = 0, true) OR location.lat IS NULL OR location.lon IS NULL AS bare,
  list_filter(list_transform(coalesce(aliases, []), lambda x: lower(x)), lambda x: x IS NOT NULL AND x <> '') AS al, {WORDS.format('lower(name)')} AS w FROM facility),
 n AS (SELECT * FROM f WHERE loaded_at >= {CUT}), o AS (SELECT * FROM f WHERE loaded_at < {CUT})"""


@query(f"""{NEW_OLD}, h AS (SELECT n.rec_id, o.rec_id AS oid, 0 AS priority FROM n JOIN o USING (facility_id)
 UNION ALL SELECT n.rec_id, o.rec_id, 1 FROM n JOIN o USING (c) WHERE abs(n.a - o.a) < 0.1 AND abs(n.o - o.o) < 0.1 AND (contains(n.low, o.low) OR contains(o.low, n.low))
 UNION ALL SELECT n.rec_id, o.rec_id, 2 FROM n JOIN o USING (c, low) WHERE n.bare OR o.bare OR (abs(n.a - o.a) < 0.01 AND abs(n.o - o.o) < 0.01)
 UNION ALL SELECT n.rec_id, o.rec_id, 3 FROM n JOIN o USING (c) WHERE least(len(n.w), len(o.w)) > 0 AND len(list_intersect(n.w, o.w)) / least(len(n.w), len(o.w)) > 0.8
 UNION ALL SELECT n.rec_id, o.rec_id, 4 FROM n JOIN o USING (c) WHERE (n.low <> '' AND list_contains(o.al, n.low)) OR (o.low <> '' AND list_contains(n.al, o.low)) OR list_has_any(n.al, o.al))
 SELECT rec_id, arg_min(oid, (priority, oid)) AS existing_rec_id, min(priority) AS priority FROM h GROUP BY rec_id""")
def import_check_duplicate(spark, d):
    """The duplicate check on import, native part: without similarity, which SQL cannot state."""
    rows = _facility(spark, d)
    at = F.lit("2025-10-01 00:00:00+00:00").cast("timestamp")
    return dedupe.import_matches(rows.where(F.col("loaded_at") >= at), rows.where(F.col("loaded_at") < at), similar=False)


@query()
def import_check_similar(spark, d):
    """The whole duplicate check on import."""
    rows = _facility(spark, d)
    at = F.lit("2025-10-01 00:00:00+00:00").cast("timestamp")
    return dedupe.import_matches(rows.where(F.col("loaded_at") >= at), rows.where(F.col("loaded_at") < at))


@query(f"""WITH f AS (SELECT rec_id, location.lat AS a, location.lon AS o, coalesce({_box(fixed.BBOX, 'location.lat', 'location.lon')}, true) AS ins, coalesce({_box(fixed.BBOX, 'location.lon', 'location.lat')}, true) AS swp FROM facility),
 g AS (SELECT *, a IS NULL OR o IS NULL AS missing, coalesce(abs(a) > 90 OR abs(o) > 180, false) AS bad FROM f)
 SELECT rec_id, 'missing_coordinates' AS issue FROM g WHERE missing UNION ALL SELECT rec_id, 'invalid_range' FROM g WHERE NOT missing AND bad UNION ALL SELECT rec_id, CASE WHEN swp THEN 'latlon_swap' ELSE 'out_of_bounds' END FROM g WHERE NOT missing AND NOT bad AND NOT ins
 UNION ALL SELECT rec_id, 'suspicious_precision' FROM g WHERE NOT missing AND NOT bad AND a = floor(a) AND o = floor(o)""")
def bbox_validation(spark, d):
    return _facility(spark, d).select("rec_id", F.explode(quality.bbox_checks(quality.lat(), quality.lon(), F.col("country_iso3"))).alias("issue"))


ISSUES = f"""WITH f AS (SELECT rec_id, facility_id, country_iso3, location.lat AS a, location.lon AS o, NOT {_box(fixed.FIX_BOUNDS, 'location.lat', 'location.lon')} AS outside, {_box(fixed.FIX_BOUNDS, 'location.lon', 'location.lat')} AS swp FROM facility),
 i AS (SELECT rec_id, unnest(list_filter(CASE WHEN a IS NULL OR o IS NULL THEN [] WHEN facility_id IN {_in(fixed.KNOWN_DELETES)} THEN ['duplicate_to_delete'] WHEN facility_id IN {_in(fixed.KNOWN_FIXES)} THEN ['known_fix'] WHEN a = 0 AND o = 0 THEN ['null_island'] ELSE [
  CASE WHEN country_iso3 IN {_in(fixed.NORTHERN)} AND a < 0 THEN 'wrong_hemisphere' END, CASE WHEN NOT coalesce(country_iso3 IN {_in(fixed.LON_NEAR_1)}, false) AND o BETWEEN 0.5 AND 1.5 THEN 'truncated_longitude' END,
  CASE WHEN outside AND swp THEN 'swapped' WHEN outside THEN 'out_of_bounds' END] END, lambda x: x IS NOT NULL)) AS issue FROM f)
"""


@query(ISSUES + "SELECT rec_id, issue FROM i")
def coord_issues(spark, d):
    found = quality.coordinate_issues(F.col("facility_id"), F.col("country_iso3"), quality.lat(), quality.lon())
    return _facility(spark, d).select("rec_id", F.explode(found).alias("i")).select("rec_id", "i.issue")


KNOWN = "CASE facility_id " + " ".join(f"WHEN '{k}' THEN {v[0]!r}" for k, v in fixed.KNOWN_FIXES.items()) + " END"
KNOWN_LON = "CASE facility_id " + " ".join(f"WHEN '{k}' THEN {v[1]!r}" for k, v in fixed.KNOWN_FIXES.items()) + " END"


@query(f"""WITH f AS (SELECT rec_id, facility_id, location.lat AS a, location.lon AS o, {KNOWN} AS ka, {KNOWN_LON} AS ko, location.lat IS NOT NULL AND location.lon IS NOT NULL AS has, country_iso3 IN {_in(fixed.NORTHERN)} AND location.lat < 0 AS south FROM facility),
 g AS (SELECT *, CASE WHEN NOT has THEN NULL WHEN ka IS NOT NULL THEN 'known_fix' WHEN south THEN 'wrong_hemisphere' END AS fixed_by FROM f WHERE NOT (has AND coalesce(facility_id IN {_in(fixed.KNOWN_DELETES)}, false)))
 SELECT rec_id, CASE fixed_by WHEN 'known_fix' THEN ka WHEN 'wrong_hemisphere' THEN abs(a) ELSE a END AS lat, CASE fixed_by WHEN 'known_fix' THEN ko ELSE o END AS lon, fixed_by FROM g""")
def coord_fix_apply(spark, d):
    return quality.fixed_coordinates(_facility(spark, d))


@query(f"""SELECT verdict, count(*) AS records FROM (SELECT CASE WHEN a IS NULL OR o IS NULL THEN 'missing' WHEN round(a, 7) = {fixed.SENTINEL[0]} AND round(o, 7) = {fixed.SENTINEL[1]} THEN 'sentinel' WHEN abs(a) > 90 OR abs(o) > 180 THEN 'invalid' WHEN NOT ins THEN 'out_of_bbox' ELSE 'accept' END AS verdict
 FROM (SELECT location.lat AS a, location.lon AS o, coalesce({_box(fixed.WRITE_BBOX, 'location.lat', 'location.lon')}, true) AS ins FROM facility)) GROUP BY 1""")
def geocode_write_gates(spark, d):
    return _facility(spark, d).groupBy(quality.write_gate(quality.lat(), quality.lon(), F.col("country_iso3")).alias("verdict")).agg(F.count("*").alias("records"))


@query("SELECT f.rec_id, c.iso3, c.country_name FROM facility f LEFT JOIN country_ref c ON f.country_iso3 = c.iso3")
def country_lookup_left(spark, d):
    ref = table(spark, d, "country_ref").select("iso3", "country_name")
    f = _facility(spark, d).select("rec_id", "country_iso3")
    return f.join(bounded(ref, 10_000), f.country_iso3 == ref.iso3, "left").select("rec_id", "iso3", "country_name")


@query("SELECT DISTINCT country_iso3 FROM facility WHERE country_iso3 NOT IN (SELECT iso3 FROM country_ref)")
def unmapped_countries_anti(spark, d):
    ref = table(spark, d, "country_ref").select(F.col("iso3").alias("country_iso3"))
    return _facility(spark, d).where("country_iso3 is not null").select("country_iso3").distinct().join(ref, "country_iso3", "left_anti")


NOISE = "trim(" + "regexp_replace(" * (len(fixed.NOISE_WORDS) + 2) + "name, '\\([^)]*\\)', ' ', 'g')" + "".join(f", '(?i)\\b{w}\\b', ' ', 'g')" for w in sorted(fixed.NOISE_WORDS, key=lambda w: (-len(w), w))) + ", '\\s+', ' ', 'g'))"


@query(f"SELECT rec_id, CASE WHEN {NOISE} <> '' THEN {NOISE} ELSE trim(name) END AS core FROM facility")
def canonical_core_names(spark, d):
    return _facility(spark, d).select("rec_id", text.core_name(F.col("name")).alias("core"))


@query(f"""WITH r AS (SELECT facility_id, min(name) AS name, min(location.region) AS region, min(location.lat) AS la, min(location.lon) AS lo FROM facility WHERE name IS NOT NULL AND facility_id IS NOT NULL GROUP BY 1),
 b AS (SELECT facility_id, {SLUG.format('name')} AS slug, nullif({SLUG.format('region')}, '') AS region, {_hash_sql('la', 'lo', 6)} AS gh FROM r),
 h1 AS (SELECT slug AS try, min(facility_id) AS facility_id FROM b GROUP BY 1), b2 AS (SELECT * FROM b WHERE facility_id NOT IN (SELECT facility_id FROM h1)),
 h2 AS (SELECT try, min(facility_id) AS facility_id FROM (SELECT slug || '-' || region AS try, facility_id FROM b2) WHERE try IS NOT NULL AND try NOT IN (SELECT try FROM h1) GROUP BY 1), b3 AS (SELECT * FROM b2 WHERE facility_id NOT IN (SELECT facility_id FROM h2)),
 h3 AS (SELECT try, min(facility_id) AS facility_id FROM (SELECT slug || '-' || gh AS try, facility_id FROM b3) WHERE try IS NOT NULL AND try NOT IN (SELECT try FROM h1 UNION ALL SELECT try FROM h2) GROUP BY 1)
 SELECT facility_id, try AS unique_slug FROM (SELECT * FROM h1 UNION ALL SELECT * FROM h2 UNION ALL SELECT * FROM h3) UNION ALL SELECT facility_id, slug || '-' || substr(sha256(facility_id), 1, 10) FROM b3 WHERE facility_id NOT IN (SELECT facility_id FROM h3)""")
def slug_disambiguation(spark, d):
    rows = _facility(spark, d).where("name is not null and facility_id is not null").groupBy("facility_id").agg(F.min("name").alias("name"), F.min("location.region").alias("region"), F.min("location.lat").alias("la"), F.min("location.lon").alias("lo"))
    return dedupe.disambiguated(rows, text.slugify(F.col("name")), [text.slugify(F.col("region")), text.geohash(F.col("la"), F.col("lo"), 6)], "facility_id")


@query("""SELECT country_iso3, count(*) AS n_mentions, count(DISTINCT trim(m.name)) AS companies, round(avg(m.confidence), 6) AS avg_confidence FROM (SELECT country_iso3, unnest(company_mentions) AS m FROM facility) WHERE trim(m.name) <> '' GROUP BY country_iso3""")
def mentions_by_country(spark, d):
    m = _facility(spark, d).select("country_iso3", F.explode("company_mentions").alias("m")).where("trim(m.name) <> ''")
    return m.groupBy("country_iso3").agg(F.count("*").alias("n_mentions"), F.countDistinct(F.trim("m.name")).alias("companies"), F.round(F.avg("m.confidence"), 6).alias("avg_confidence"))


@query(f"""WITH h AS (SELECT h, list_filter([{", ".join(f"CASE WHEN contains(lower(h), '{w}') THEN '{w}' END" for w in fixed.TABLE_WORDS)}], lambda x: x IS NOT NULL) AS w FROM (SELECT DISTINCT source AS h FROM documents)) SELECT h AS header, CAST(len(w) AS INTEGER) AS hits FROM h""")
def table_header_hits(spark, d):
    hits = sum((F.col("header").isNotNull() & F.coalesce(F.lower("header").contains(w), F.lit(False))).cast("int") for w in fixed.TABLE_WORDS)
    return table(spark, d, "documents").select(F.col("source").alias("header")).distinct().select("header", hits.alias("hits"))


@query("""SELECT facility_id, s.type AS type, s.id AS id, arg_min(coalesce(s.url, ''), (rec_id, pos)) AS url, count(*) AS n_seen FROM (SELECT facility_id, rec_id, unnest(sources) AS s, generate_subscripts(sources, 1) AS pos FROM facility WHERE facility_id IS NOT NULL) GROUP BY 1, 2, 3""")
def dedupe_merge_sources(spark, d):
    return dedupe.merged_sources(_facility(spark, d), "facility_id").select("facility_id", "type", "id", F.coalesce("url", F.lit("")).alias("url"), "n_seen")


@query("""SELECT facility_id, lower(trim(c.metal)) AS metal, arg_max(c.chemical_formula, (rec_id, pos)) FILTER (WHERE c.chemical_formula IS NOT NULL) AS chemical_formula, bool_or(coalesce(c.is_primary, false)) AS is_primary
 FROM (SELECT facility_id, rec_id, generate_subscripts(commodities, 1) AS pos, unnest(commodities) AS c FROM facility WHERE facility_id IS NOT NULL) WHERE trim(c.metal) <> '' GROUP BY 1, 2""")
def dedupe_merge_commodities(spark, d):
    return dedupe.merged_commodities(_facility(spark, d), "facility_id")


@query("""SELECT facility_id, trim(m.name) AS name, max(m.confidence) AS confidence, arg_max(coalesce(m.role, ''), (coalesce(m.confidence, -1), -rec_id, -pos)) AS role
 FROM (SELECT facility_id, rec_id, generate_subscripts(company_mentions, 1) AS pos, unnest(company_mentions) AS m FROM facility WHERE facility_id IS NOT NULL) WHERE trim(m.name) <> '' GROUP BY 1, 2""")
def dedupe_merge_mentions(spark, d):
    return dedupe.merged_mentions(_facility(spark, d), "facility_id").select("facility_id", "name", "confidence", F.coalesce("role", F.lit("")).alias("role"))


@query(f"SELECT rec_id, facility_id, name FROM facility WHERE facility_id IS NULL OR rec_id IN (SELECT arg_max(rec_id, (round({SCORE}, 6), -rec_id)) FROM facility WHERE facility_id IS NOT NULL GROUP BY facility_id)")
def dedupe_apply(spark, d):
    return dedupe.without_losers(_facility(spark, d), "facility_id").select("rec_id", "facility_id", "name")


@query("SELECT (SELECT count(*) FROM facility) AS records, count(*) FILTER (WHERE n > 1) AS groups, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS in_groups, CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS removed FROM (SELECT count(*) AS n FROM facility WHERE facility_id IS NOT NULL GROUP BY facility_id)")
def dedupe_summary(spark, d):
    return dedupe.dedupe_summary(_facility(spark, d), "facility_id")


@query(f"""WITH {CODES}, f AS (SELECT rec_id, meant AS k, location.lat AS a, location.lon AS o FROM facility JOIN codes ON lower(trim(country_iso3)) = codes.k WHERE abs(location.lat) <= 90 AND abs(location.lon) <= 180 AND NOT (location.lat = 0 AND location.lon = 0)),
 r AS (SELECT district_id, country_iso3 AS k, unnest(regexp_extract_all(wkt, '\\(([^()]+)\\)', 1)) AS ring FROM mining_district), p AS (SELECT district_id, k, list_transform(string_split(ring, ','), lambda s: [CAST(split_part(trim(s), ' ', 1) AS DOUBLE), CAST(split_part(trim(s), ' ', 2) AS DOUBLE)]) AS l FROM r),
 i AS (SELECT district_id, k, l, unnest(range(1, len(l))) AS i FROM p), e AS (SELECT district_id, k, l[i][1] AS x1, l[i][2] AS y1, l[i + 1][1] - l[i][1] AS vx, l[i + 1][2] - l[i][2] AS vy FROM i),
 t AS (SELECT rec_id, district_id, o, a, x1, y1, vx, vy, greatest(0, least(1, ((o - x1) * vx + (a - y1) * vy) / greatest(vx * vx + vy * vy, 1e-18))) AS t, (y1 > a) <> (y1 + vy > a) AND o < vx * (a - y1) / vy + x1 AS crossed FROM f JOIN e USING (k)),
 d AS (SELECT rec_id, district_id, CASE WHEN count(*) FILTER (WHERE crossed) % 2 = 1 THEN 0 ELSE min(sqrt(pow(x1 + t * vx - o, 2) + pow(y1 + t * vy - a, 2))) END AS deg FROM t GROUP BY 1, 2)
 SELECT rec_id, arg_min(district_id, (round(deg, 9), district_id)) AS region_id, round(min(deg) * 111.0, 6) AS km FROM d GROUP BY 1""")
def nearest_district(spark, d):
    """The nearest district of each record's country, 0 km inside."""
    f = _located(spark, d)
    return spatial.nearest_regions(f, "rec_id", "lat", "lon", "country", table(spark, d, "mining_district"), "district_id", "wkt", "country_iso3").withColumn("km", F.round("km", 6))
