"""Backfills of facility records: metals, towns, companies, canonical names, countries and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orelode.functions.text import core_name, humanize_type, lookup, normalize_metal, normalize_type, slugify, to_ascii
from orelode.plans.runtime import bounded

# Territories by sovereign.
SOVEREIGN = {
    "GUF": "FRA", "GLP": "FRA", "MTQ": "FRA", "REU": "FRA", "MYT": "FRA", "NCL": "FRA", "PYF": "FRA", "ABW": "NLD", "CUW": "NLD", "SXM": "NLD", "GRL": "DNK", "FRO": "DNK", "PRI": "USA", "VIR": "USA", "GUM": "USA", "ASM": "USA",
    "FLK": "GBR", "GIB": "GBR", "SGS": "GBR", "BMU": "GBR", "CYM": "GBR", "VGB": "GBR",
}
SITE_WORDS = r"(?i)\b(mine|plant|pit|smelter|refinery|project)\b"


def commodities_filled(terms: DataFrame, most: int = 10_000) -> Column:
    """The commodities of a record with missing formula and category filled from at most ``most``
    canonical terms; what is there stays."""
    rows = terms.where("field_name = 'commodity'").select("canonical", "symbol", "category").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} terms")
    symbol, category = ({r["canonical"]: r[c] for r in rows if r[c]} for c in ("symbol", "category"))
    fill = lambda c, k, t: F.coalesce(c[k], lookup(normalize_metal(c["metal"]), t)) if t else c[k]
    return F.transform("commodities", lambda c: F.struct(c["metal"].alias("metal"), c["is_primary"].alias("is_primary"), fill(c, "chemical_formula", symbol).alias("chemical_formula"), fill(c, "category", category).alias("category")))


def filled_metals(facility: DataFrame, terms: DataFrame, most: int = 10_000) -> DataFrame:
    """``rec_id`` and its :func:`commodities_filled`."""
    return facility.select("rec_id", commodities_filled(terms, most).alias("commodities"))


def needs_work() -> Column:
    """array<string> of the backfills a record calls for."""
    lat, lon = F.col("location.lat"), F.col("location.lon")
    checks = {
        "geocode": lat.isNull() | lon.isNull(), "metals": F.exists("commodities", lambda c: c["chemical_formula"].isNull() | c["category"].isNull()), "towns": F.coalesce(F.trim("location.town").isin("", "TODO"), F.lit(True)), "companies": F.size("company_mentions") > 0,
    }
    return F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), k) for k, c in checks.items())), lambda x: x.isNotNull())


def town_from_names(name: Column, aliases: Column) -> Column:
    """The first parenthetical of the name, then of the aliases, that is no site word."""
    every = F.flatten(F.transform(F.concat(F.array(name), F.coalesce(aliases, F.array().cast("array<string>"))), lambda x: F.coalesce(F.regexp_extract_all(x, F.lit(r"\(([^)]+)\)"), F.lit(1)), F.array().cast("array<string>"))))
    fit = F.filter(every, lambda x: (F.trim(x) != "") & ~x.rlike(SITE_WORDS))
    return F.trim(F.try_element_at(fit, F.lit(1)))


def town_from_address(address: Column) -> Column:
    """Town, city, municipality, village or hamlet of an address map, the first that is not blank."""
    return F.coalesce(*(F.nullif(F.trim(F.try_element_at(address, F.lit(k))), F.lit("")) for k in ("town", "city", "municipality", "village", "hamlet")))


def canonical(facility: DataFrame, *keep: str) -> DataFrame:
    """``rec_id``, canonical and display name, base slug, primary type, confidence and the columns ``keep``.

    The name joins town, operator, core and type; the slug leaves the operator out, so it is
    stable.  A town or operator that equals the core is dropped.
    """
    first = F.filter("company_mentions", lambda m: (F.lower(m["role"]) == "operator") & (F.trim(m["name"]) != ""))
    base = facility.select(
        "rec_id", F.trim("name").alias("name"), F.coalesce(F.trim("location.town"), F.lit("")).alias("town"), F.coalesce(F.when(F.size(first) > 0, F.trim(F.try_element_at(first, F.lit(1))["name"])), F.lit("")).alias("operator"),
        normalize_type(F.try_element_at("types", F.lit(1))).alias("t"), *(F.col(c).alias(f"_keep_{c}") for c in keep),
    )
    base = base.withColumn("core", core_name(F.col("name"), F.col("operator")))
    base = base.withColumns({c: F.when(F.lower(c) == F.lower("core"), "").otherwise(F.col(c)) for c in ("town", "operator")})
    parts = F.filter(F.array("town", "operator", "core", humanize_type(F.col("t.type"))), lambda x: x.isNotNull() & (x != ""))
    score = 0.15 * (F.col("town") != "").cast("int") + 0.35 * F.when(F.col("core") != F.col("name"), 0.9).otherwise(0.6) + 0.30 * F.col("t.confidence").cast("double") + 0.20 * (F.col("operator") != "").cast("int")
    return base.select("rec_id", F.array_join(parts, " ").alias("canonical_name"), F.col("core").alias("display_name"), slugify(F.concat_ws(" ", F.nullif("town", F.lit("")), "core", "t.type")).alias("slug"), F.col("t.type").alias("primary_type"), F.round(score, 4).alias("confidence"), *(F.col(f"_keep_{c}").alias(c) for c in keep))


def flags(canonicals: DataFrame, facility: DataFrame) -> DataFrame:
    """``rec_id`` and its open flags, recomputed from the data."""
    rows = canonicals.join(facility.select("rec_id", F.col("location.town").alias("town"), F.exists("company_mentions", lambda m: m["role"] == "operator").alias("op")), "rec_id")
    return rows.select("rec_id", F.coalesce(F.trim("town") == "", F.lit(True)).alias("town_missing"), (~F.coalesce("op", F.lit(False))).alias("operator_unresolved"), (F.col("confidence") < 0.5).alias("canonical_name_incomplete"))


def mentions_by_row(facility: DataFrame, listing: DataFrame, row_no: str, source_type: str = "mines_csv") -> DataFrame:
    """Facility records joined to the listing rows their sources of ``source_type`` name."""
    named = facility.select("rec_id", F.explode("sources").alias("s")).where(F.col("s.type") == source_type).select("rec_id", F.col("s.row_no").alias(row_no)).where(f"{row_no} is not null").distinct()
    return named.join(listing, row_no)


def same_country(a: Column, b: Column) -> Column:
    """Equal, or territory and sovereign of each other."""
    return (a == b) | F.coalesce(lookup(a, SOVEREIGN) == b, F.lit(False)) | F.coalesce(lookup(b, SOVEREIGN) == a, F.lit(False))


def moved(facility: DataFrame, codes: DataFrame) -> DataFrame:
    """Ids whose prefix is not the country their records name: the new id, and whether it exists.

    ``codes`` (notation, meant) reads any notation of a country; ids whose records name several
    countries or none stay.
    """
    meant = facility.select("facility_id", F.lower(F.trim("country_iso3")).alias("notation")).join(bounded(codes, 10_000), "notation", "left").groupBy("facility_id").agg(F.min("meant").alias("a"), F.max("meant").alias("b"))
    off = meant.where((F.col("a") == F.col("b")) & (F.lower("a") != F.substring("facility_id", 1, 3)))
    new = off.select("facility_id", F.concat(F.lower("a"), F.expr("substring(facility_id, 4)")).alias("new_id"))
    ids = facility.select(F.col("facility_id").alias("new_id"), F.lit(True).alias("conflict")).distinct()
    return new.join(ids, "new_id", "left").select("facility_id", "new_id", F.coalesce("conflict", F.lit(False)).alias("conflict"))


def folded_slug(*parts: Column) -> Column:
    """A slug in which accented letters keep their base letter; ``facility`` if nothing is left."""
    base = F.trim(F.regexp_replace(F.regexp_replace(F.lower(to_ascii(F.concat_ws(" ", *parts))), "[^a-z0-9]+", "-"), "^-+|-+$", ""))
    return F.when(base == "", "facility").otherwise(base)


def extraction(raw: Column) -> Column:
    """struct<found, lat, lon, confidence> of a JSON answer; what is missing is not found, 0."""
    got = F.from_json(raw, "found boolean, lat double, lon double, confidence double")
    return F.struct(F.coalesce(got["found"], F.lit(False)).alias("found"), got["lat"].alias("lat"), got["lon"].alias("lon"), F.coalesce(got["confidence"], F.lit(0.0)).alias("confidence"))
