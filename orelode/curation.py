"""Queries of the general curation operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orelode.operators import nested, spatial, units
from orelode.plans.runtime import table

P2_FIELDS = {
    "commodities": {"metal": "metal string", "is_primary": "primary boolean", "category": "category string"},
    "products": {"stream": "stream string", "capacity": "capacity double", "unit": "unit string", "year": "year int"},
    "sources": {"source_id": "id string", "source_type": "type string", "source_date": "date string", "row_no": "row int"},
    "evidence": {"title": "title string", "url": "url string", "evidence_date": "date string"},
    "verification": {"status": "status string", "confidence": "confidence double", "last_checked": "last_checked string"},
    "issues": {"issue_type": "type string", "auto_fixable": "auto_fixable boolean"},
    "fix": {"note": "note string", "lat": "lat double", "lon": "lon double"},
    "history": {"status": "status string", "at": "at string"},
}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten_documents(table(spark, d, "facility_raw").select("raw_id", "body"), "raw_id", "body")


def _p2_table(kind: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        nodes = nested.flatten_documents(table(spark, d, "facility_raw").select("raw_id", "body"), "raw_id", "body", payload=True, kind=kind)
        return nested.child_table(nodes, "raw_id", kind, P2_FIELDS[kind])

    return query


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return spatial.surroundings(*(table(spark, d, n) for n in ("facility", "place", "mining_district", "country_ref")))


def p6_places_per_country(spark: SparkSession, d: str) -> DataFrame:
    """How many facility records of each notated country have a place near, a district around."""
    found = p6_found(spark, d).groupBy("rec_id").agg(
        F.count_if(F.col("kind") == "place").alias("places"), F.max((F.col("kind") != "place").cast("int")).alias("in_district")
    )
    rows = table(spark, d, "facility").select("rec_id", "country_iso3")
    return (
        rows.join(found, "rec_id", "left").groupBy("country_iso3")
        .agg(F.count("*").alias("records"), F.coalesce(F.sum("places"), F.lit(0)).alias("places"), F.coalesce(F.sum("in_district"), F.lit(0)).cast("bigint").alias("in_district"))
    )


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return units.milli(units.canonical_values(*(table(spark, d, n) for n in ("measurable_result", "measurable", "unit_ref"))))


def p7_flagged(spark: SparkSession, d: str) -> DataFrame:
    """Per question: converted values, those whose reading is not unique, and those an identity contradicts."""
    rows = table(spark, d, "measurable_result").select("result_id", "json_id")
    got = units.canonical_values(*(table(spark, d, n) for n in ("measurable_result", "measurable", "unit_ref")))
    return rows.join(got, "result_id").groupBy("json_id").agg(F.count("*").alias("converted"), F.count_if(~F.col("unique")).alias("not_unique"), F.count_if("contradicted").alias("contradicted"))


QUERIES = {
    "p2_found": p2_found,
    **{f"p2_{k}": _p2_table(k) for k in P2_FIELDS},
    "p6_found": p6_found,
    "p6_places_per_country": p6_places_per_country,
    "p7_found": p7_found,
    "p7_flagged": p7_flagged,
}
# Point in polygon by crossings of the edges of all rings, which leaves out holes by itself.
SURROUNDINGS = """WITH n AS (SELECT k, min(iso3) AS meant FROM (SELECT lower(trim(iso3)) AS k, iso3 FROM country_ref UNION ALL SELECT lower(trim(iso2)), iso3 FROM country_ref UNION ALL SELECT lower(trim(country_name)), iso3 FROM country_ref) WHERE k <> '' GROUP BY 1),
 f AS (SELECT rec_id, country_iso3, location.lat AS a, location.lon AS o, meant FROM facility LEFT JOIN n ON lower(trim(country_iso3)) = k WHERE abs(location.lat) <= 90 AND abs(location.lon) <= 180 AND NOT (location.lat = 0 AND location.lon = 0)),
 r AS (SELECT district_id, country_iso3 AS home, unnest(regexp_extract_all(wkt, '\\(([^()]+)\\)', 1)) AS ring FROM mining_district),
 p AS (SELECT district_id, home, list_transform(string_split(ring, ','), lambda s: [CAST(split_part(trim(s), ' ', 1) AS DOUBLE), CAST(split_part(trim(s), ' ', 2) AS DOUBLE)]) AS l FROM r),
 i AS (SELECT district_id, home, l, unnest(range(1, len(l))) AS i FROM p), e AS (SELECT district_id, home, l[i][1] AS x1, l[i][2] AS y1, l[i + 1][1] AS x2, l[i + 1][2] AS y2 FROM i),
 c AS (SELECT rec_id, district_id, home, meant, count(*) AS k FROM f JOIN e ON (y1 > a) <> (y2 > a) AND o < (x2 - x1) * (a - y1) / (y2 - y1) + x1 GROUP BY ALL),
 s AS (SELECT rec_id, 'place' AS kind, place_id AS target_id FROM f JOIN place q ON 2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians(q.lat - a) / 2), 2) + cos(radians(a)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - o) / 2), 2)))) <= 25
  UNION ALL SELECT rec_id, CASE WHEN coalesce(home = meant, false) THEN 'district_home' ELSE 'district_abroad' END, district_id FROM c WHERE k % 2 = 1)
"""
ORACLES: dict[str, str] = {
    "p6_found": SURROUNDINGS + "SELECT * FROM s",
    "p6_places_per_country": SURROUNDINGS + """, g AS (SELECT rec_id, count(*) FILTER (WHERE kind = 'place') AS places, max(CAST(kind <> 'place' AS INTEGER)) AS inside FROM s GROUP BY 1)
 SELECT country_iso3, count(*) AS records, CAST(coalesce(sum(places), 0) AS BIGINT) AS places, CAST(coalesce(sum(inside), 0) AS BIGINT) AS in_district FROM facility LEFT JOIN g USING (rec_id) GROUP BY 1""",
}
