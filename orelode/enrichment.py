"""Queries of the backfill and import operators, each with the same result in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from orelode.catalogue import NOISE, SLUG, _case, _in
from orelode.functions import fixed, text
from orelode.operators import dedupe, enrich, ingest, spatial
from orelode.plans.runtime import bounded, table
from orelode.sources import reports

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


METAL = _case("lower(trim(c.metal))", fixed.METALS, "lower(trim(c.metal))")


@query(f"""WITH c AS (SELECT rec_id, generate_subscripts(commodities, 1) - 1 AS pos, unnest(commodities) AS c FROM facility) SELECT rec_id, CAST(pos AS INTEGER) AS pos, coalesce(c.chemical_formula, t.symbol) AS formula, coalesce(c.category, t.category) AS category
 FROM c LEFT JOIN canonical_term t ON t.field_name = 'commodity' AND t.canonical = {METAL}""")
def metals_backfill(spark, d):
    filled = enrich.filled_metals(table(spark, d, "facility"), table(spark, d, "canonical_term"))
    return filled.select("rec_id", F.posexplode("commodities").alias("pos", "c")).select("rec_id", "pos", F.col("c.chemical_formula").alias("formula"), "c.category")


@query("""WITH w AS (SELECT unnest(list_filter([CASE WHEN location.lat IS NULL OR location.lon IS NULL THEN 'geocode' END, CASE WHEN len(list_filter(commodities, lambda c: c.chemical_formula IS NULL OR c.category IS NULL)) > 0 THEN 'metals' END,
 CASE WHEN coalesce(trim(location.town) IN ('', 'TODO'), true) THEN 'towns' END, CASE WHEN len(company_mentions) > 0 THEN 'companies' END], lambda x: x IS NOT NULL)) AS backfill, country_iso3 FROM facility) SELECT backfill, country_iso3, count(*) AS n FROM w GROUP BY 1, 2""")
def needs_work_by_country(spark, d):
    return table(spark, d, "facility").select("country_iso3", F.explode(enrich.needs_work()).alias("backfill")).groupBy("backfill", "country_iso3").agg(F.count("*").alias("n"))


TYPE_PAIR = f"""CASE WHEN raw IS NULL OR raw = '' THEN ['facility', '0.2'] WHEN regexp_matches(replace(replace(r, '.', ''), '-', ''), '^[0-9]+$') THEN ['facility', '0.1'] WHEN r IN {_in(fixed.TYPE_MAPPING)} THEN [{_case('r', fixed.TYPE_MAPPING, 'NULL')}, '0.95']
 WHEN fl IN {_in(fixed.TYPE_MAPPING)} THEN [{_case('fl', fixed.TYPE_MAPPING, 'NULL')}, '0.9'] {' '.join(f"WHEN contains(r, '{k}') THEN ['{v}', '0.85']" for k, v in fixed.TYPE_MAPPING.items())} ELSE ['facility', '0.3'] END"""
_BARE = "regexp_replace(name, '\\([^)]*\\)', ' ', 'g')"
#: The core of a name without its operator ``op0``.
CORE = NOISE.replace(_BARE, f"CASE WHEN op0 = '' THEN {_BARE} ELSE regexp_replace({_BARE}, '(?i)\\b' || regexp_escape(op0) || '\\b', ' ', 'g') END")
HUMAN = "CASE t[1] " + " ".join(f"WHEN '{v}' THEN '{v.replace('_', ' ').title()}'" for v in dict.fromkeys(fixed.TYPE_MAPPING.values())) + " ELSE '' END"
CANON = f"""WITH a0 AS (SELECT *, coalesce(trim((list_filter(company_mentions, lambda m: lower(m.role) = 'operator' AND trim(m.name) <> ''))[1].name), '') AS op0 FROM facility),
 a AS (SELECT rec_id, name AS full_name, trim(name) AS nm, coalesce(trim(location.town), '') AS town0, op0, CASE WHEN {CORE} <> '' THEN {CORE} ELSE trim(name) END AS core,
 types[1] AS raw, lower(trim(types[1])) AS r, replace(replace(lower(trim(types[1])), '_', ' '), '-', ' ') AS fl FROM a0),
 b AS (SELECT *, {TYPE_PAIR} AS t, CASE WHEN lower(town0) = lower(core) THEN '' ELSE town0 END AS town, CASE WHEN lower(op0) = lower(core) THEN '' ELSE op0 END AS op FROM a)
"""
NAMES = f"array_to_string(list_filter([town, op, core, {HUMAN}], lambda x: x IS NOT NULL AND x <> ''), ' ')"
BASE_SLUG = SLUG.format("array_to_string(list_filter([nullif(town, ''), core, t[1]], lambda x: x IS NOT NULL), ' ')")


@query(CANON + f"SELECT rec_id, {NAMES} AS canonical_name, core AS display_name, {BASE_SLUG} AS slug, t[1] AS primary_type, round(0.15 * CAST(town <> '' AS INTEGER) + 0.35 * CASE WHEN core <> nm THEN 0.9 ELSE 0.6 END + 0.30 * CAST(t[2] AS DOUBLE) + 0.20 * CAST(op <> '' AS INTEGER), 4) AS confidence FROM b")
def canonical_names(spark, d):
    return enrich.canonical(table(spark, d, "facility"))


@query(CANON + f""", s AS (SELECT facility_id, min(slug) AS slug, min(region) AS region FROM (SELECT f.facility_id, {BASE_SLUG} AS slug, nullif({SLUG.format('f.location.region')}, '') AS region FROM b JOIN facility f USING (rec_id)) WHERE facility_id IS NOT NULL AND slug <> '' GROUP BY 1),
 h1 AS (SELECT slug AS try, min(facility_id) AS facility_id FROM s GROUP BY 1), s2 AS (SELECT * FROM s WHERE facility_id NOT IN (SELECT facility_id FROM h1)),
 h2 AS (SELECT try, min(facility_id) AS facility_id FROM (SELECT slug || '-' || region AS try, facility_id FROM s2) WHERE try IS NOT NULL AND try NOT IN (SELECT try FROM h1) GROUP BY 1)
 SELECT facility_id, try AS unique_slug FROM (SELECT * FROM h1 UNION ALL SELECT * FROM h2) UNION ALL SELECT facility_id, slug || '-' || substr(sha256(facility_id), 1, 10) FROM s2 WHERE facility_id NOT IN (SELECT facility_id FROM h2)""")
def canonical_slugs(spark, d):
    """A slug of its own for each id, from the canonical names of its records."""
    f = table(spark, d, "facility")
    rows = enrich.canonical(f).join(f.select("rec_id", "facility_id", text.slugify(F.col("location.region")).alias("region")), "rec_id").where("facility_id is not null and slug <> ''")
    return dedupe.disambiguated(rows.groupBy("facility_id").agg(F.min("slug").alias("slug"), F.min(F.nullif("region", F.lit(""))).alias("region")), F.col("slug"), [F.col("region")], "facility_id")


@query(CANON + """SELECT b.rec_id, coalesce(trim(f.location.town) = '', true) AS town_missing, NOT coalesce(len(list_filter(f.company_mentions, lambda m: coalesce(m.role = 'operator', false))) > 0, false) AS operator_unresolved,
 round(0.15 * CAST(town <> '' AS INTEGER) + 0.35 * CASE WHEN core <> nm THEN 0.9 ELSE 0.6 END + 0.30 * CAST(t[2] AS DOUBLE) + 0.20 * CAST(op <> '' AS INTEGER), 4) < 0.5 AS canonical_name_incomplete FROM b JOIN facility f USING (rec_id)""")
def quality_flags(spark, d):
    f = table(spark, d, "facility")
    return enrich.flags(enrich.canonical(f), f)


@query("""WITH s AS (SELECT DISTINCT rec_id, s.row_no AS k FROM (SELECT rec_id, unnest(sources) AS s FROM facility) WHERE s.type = 'mines_csv' AND s.row_no IS NOT NULL) SELECT rec_id, CAST(k AS BIGINT) AS p_partkey, p_name FROM s JOIN part ON p_partkey = k""")
def mentions_by_row(spark, d):
    listing = table(spark, d, "part").select("p_partkey", "p_name")
    return enrich.mentions_by_row(table(spark, d, "facility"), listing, "p_partkey").select("rec_id", F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name")


@query("""WITH n AS (SELECT lower(trim(iso3)) AS k, iso3 FROM country_ref UNION SELECT lower(trim(iso2)), iso3 FROM country_ref UNION SELECT lower(trim(country_name)), iso3 FROM country_ref),
 m AS (SELECT facility_id, min(n.iso3) AS a, max(n.iso3) AS b FROM facility LEFT JOIN n ON lower(trim(country_iso3)) = n.k GROUP BY 1), o AS (SELECT facility_id, lower(a) || substr(facility_id, 4) AS new_id FROM m WHERE a = b AND lower(a) <> left(facility_id, 3))
 SELECT facility_id, new_id, new_id IN (SELECT facility_id FROM facility WHERE facility_id IS NOT NULL) AS conflict FROM o""")
def country_moves(spark, d):
    return enrich.moved(table(spark, d, "facility"), spatial.country_codes(table(spark, d, "country_ref")))


@query("""WITH n AS (SELECT lower(trim(iso3)) AS k, iso3 FROM country_ref UNION SELECT lower(trim(iso2)), iso3 FROM country_ref UNION SELECT lower(trim(country_name)), iso3 FROM country_ref) SELECT rec_id, n.iso3 FROM facility LEFT JOIN n ON lower(trim(country_iso3)) = n.k""")
def country_notations(spark, d):
    codes = spatial.country_codes(table(spark, d, "country_ref"))
    return table(spark, d, "facility").select("rec_id", F.lower(F.trim("country_iso3")).alias("notation")).join(bounded(codes, 10_000), "notation", "left").select("rec_id", F.col("meant").alias("iso3"))


@query("""SELECT rec_id, trim(regexp_replace(regexp_replace(alias, '\\([^)]*\\)', ' ', 'g'), '\\s+', ' ', 'g')) AS bare FROM (SELECT rec_id, unnest(aliases) AS alias FROM facility) WHERE alias IS NOT NULL""")
def bare_aliases(spark, d):
    return table(spark, d, "facility").select("rec_id", F.explode("aliases").alias("alias")).where("alias is not null").select("rec_id", ingest.bare_name(F.col("alias")).alias("bare"))


@query("""WITH n AS (SELECT company_name AS t, list_filter(regexp_extract_all(company_name, '\\(([^)]+)\\)', 1), lambda x: trim(x) <> '' AND NOT regexp_matches(trim(x), '(?i)^(?:ltd|limited|inc|pty|gov''?t|government|state|private|jv|[0-9]{4}|operational|operating|closed|suspended|planned|proposed|active|inactive|old|l/r)$')) AS l FROM facility_company_relationships WHERE company_name IS NOT NULL)
 SELECT DISTINCT t AS company_name, trim(unnest(l)) AS alias FROM n""")
def parenthetical_aliases(spark, d):
    rows = table(spark, d, "facility_company_relationships").where("company_name is not null")
    return rows.select("company_name", F.explode(ingest.parenthetical_aliases(F.col("company_name"))).alias("alias")).distinct()


@query("""WITH p AS (SELECT DISTINCT company_name AS t, list_filter(list_transform(string_split_regex(company_name, '[/;]'), lambda x: trim(regexp_replace(x, '\\([^)]*\\)', '', 'g'))), lambda x: x NOT IN ('', '-')) AS l FROM facility_company_relationships WHERE company_name IS NOT NULL) SELECT t AS company_name, unnest(l) AS operator FROM p""")
def operator_split(spark, d):
    rows = table(spark, d, "facility_company_relationships").where("company_name is not null").select("company_name").distinct()
    return rows.select("company_name", F.explode(ingest.operators(F.col("company_name"))).alias("o")).select("company_name", F.col("o.name").alias("operator"))


@query("""SELECT rec_id, location.lat AS lat, location.lon AS lon FROM facility WHERE location.lat IS NOT NULL AND location.lon IS NOT NULL""")
def combined_coordinates(spark, d):
    """Positions written into one text and parsed back."""
    f = table(spark, d, "facility").where("location.lat is not null and location.lon is not null")
    at = ingest.position(F.lit("-"), F.lit(""), F.concat_ws(", ", F.col("location.lat").cast("string"), F.col("location.lon").cast("string")))
    return f.select("rec_id", at.alias("p")).select("rec_id", "p.lat", "p.lon")


@query("SELECT count(*) AS rows_, count(facility_id) AS facility_id, count(name) AS name, count(location.lat) AS lat, count(status) AS status, count(canonical_slug) AS canonical_slug, count(verification.confidence) AS confidence FROM facility")
def load_counters(spark, d):
    return table(spark, d, "facility").agg(F.count("*").alias("rows_"), *(F.count(c).alias(c.split(".")[-1]) for c in ("facility_id", "name", "location.lat", "status", "canonical_slug", "verification.confidence")))


@query("""WITH f AS (SELECT count(*) AS records, count(DISTINCT country_iso3) AS countries, round(avg(CASE WHEN location.lat IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS located FROM facility), m AS (SELECT count(DISTINCT trim(c.metal)) AS metals FROM (SELECT unnest(commodities) AS c FROM facility) WHERE trim(c.metal) <> ''),
 c AS (SELECT count(DISTINCT trim(m.name)) AS companies FROM (SELECT unnest(company_mentions) AS m FROM facility) WHERE trim(m.name) <> '') SELECT * FROM f, m, c""")
def export_summary(spark, d):
    f = table(spark, d, "facility")
    flat = f.agg(F.count("*").alias("records"), F.countDistinct("country_iso3").alias("countries"), F.round(F.avg(F.when(F.col("location.lat").isNotNull(), 1.0).otherwise(0.0)), 6).alias("located"))
    metals = f.select(F.explode("commodities.metal").alias("m")).where("trim(m) <> ''").agg(F.countDistinct(F.trim("m")).alias("metals"))
    companies = f.select(F.explode("company_mentions.name").alias("m")).where("trim(m) <> ''").agg(F.countDistinct(F.trim("m")).alias("companies"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    return one(flat).join(one(metals), "_one").join(one(companies), "_one").drop("_one")


@query("""SELECT f.rec_id, coalesce(f.name, '') AS facility_name, regexp_replace(lower(coalesce(f.name, '')), '[^a-z0-9]', '', 'g') AS name_norm, c.iso2 AS country_id, list_filter(list_transform(list_filter(coalesce(f.commodities, []), lambda x: coalesce(x.is_primary, false)), lambda x: x.metal), lambda m: m IS NOT NULL)[1] AS primary_metal
 FROM facility f LEFT JOIN country_ref c ON f.country_iso3 = c.iso3""")
def warehouse_load(spark, d):
    ref = table(spark, d, "country_ref").select("iso3", F.col("iso2").alias("country_id"))
    primary = F.filter(F.transform(F.filter(F.coalesce("commodities", F.array().cast("array<struct<metal:string,is_primary:boolean,chemical_formula:string,category:string>>")), lambda c: F.coalesce(c["is_primary"], F.lit(False))), lambda c: c["metal"]), lambda m: m.isNotNull())
    name = F.coalesce("name", F.lit(""))
    return table(spark, d, "facility").join(bounded(ref, 10_000), F.col("country_iso3") == F.col("iso3"), "left").select("rec_id", name.alias("facility_name"), text.name_norm(name).alias("name_norm"), "country_id", F.try_element_at(primary, F.lit(1)).alias("primary_metal"))


@query("""SELECT name_norm AS slug_key, min(facility_id) AS first_id, count(DISTINCT facility_id) AS holders FROM (SELECT facility_id, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS name_norm FROM facility WHERE name IS NOT NULL) GROUP BY 1""")
def first_holder_map(spark, d):
    rows = table(spark, d, "facility").where("name is not null").select("facility_id", text.name_norm(F.col("name")).alias("slug_key"))
    return rows.groupBy("slug_key").agg(F.min("facility_id").alias("first_id"), F.countDistinct("facility_id").alias("holders"))


@query("SELECT relationship_id, facility_id, row_number() OVER () + 1 AS row_no FROM facility_company_relationships")
def numbered_rows(spark, d):
    """Physical row numbers of the relationship listing, from 2."""
    return ingest.numbered(table(spark, d, "facility_company_relationships").select("relationship_id", "facility_id"))


@query()
def import_typed_rows(spark, d):
    """Facility records written as report tables, read and typed again."""
    f = table(spark, d, "facility")
    cell = lambda c: F.translate(F.coalesce(c.cast("string"), F.lit("")), "|\n\t", "   ")
    row = F.concat_ws(" | ", cell(F.col("name")), cell(F.col("location.lat")), cell(F.col("location.lon")), cell(F.array_join("commodities.metal", ", ")), cell(F.col("status")), cell(F.array_join("types", "; ")))
    body = F.concat(F.lit("Site Name | Latitude | Longitude | Primary Commodity | Status | Asset Type\n--- | --- | --- | --- | --- | ---\n"), row)
    typed = ingest.typed_rows(reports.parse_reports(f.select(F.col("rec_id").alias("doc_id"), body.alias("text"))), "XXX")
    return typed.select("doc_id", "facility_id", "name", "location.lat", "location.lon", "status", F.array_join("types", ",").alias("types"), F.size("commodities").alias("n_commodities"), "error")


@query("""WITH s AS (SELECT rec_id, regexp_replace(regexp_replace(lower(strip_accents(concat_ws(' ', location.town, name))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM facility) SELECT rec_id, CASE WHEN s = '' THEN 'facility' ELSE s END AS slug FROM s""")
def folded_slugs(spark, d):
    return table(spark, d, "facility").select("rec_id", enrich.folded_slug(F.col("location.town"), F.col("name")).alias("slug"))
