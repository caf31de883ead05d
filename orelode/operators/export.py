"""Facility records flattened to fact and bridge tables, and filters over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orelode.functions import fixed
from orelode.functions.text import asset_types, confidence_label
from orelode.plans.runtime import bounded



def _list(c: Column) -> Column:
    return F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull())


def _joined(c: Column, sep: str = ",") -> Column:
    return F.array_join(_list(c), sep)


def metals(primary: bool) -> Column:
    kept = F.filter("commodities", lambda c: F.coalesce(c["is_primary"], F.lit(False)) == primary)
    return _list(F.transform(kept, lambda c: c["metal"]))


def flattened(facility: DataFrame) -> DataFrame:
    """One row a record: scalars as they are, lists comma-joined, source types distinct and sorted."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    primary = metals(True)
    return facility.select(
        "rec_id", text("facility_id").alias("facility_id"), text("name").alias("name"), text("country_iso3").alias("country_iso3"), text("status").alias("status"),
        F.col("location.lat").alias("latitude"), F.col("location.lon").alias("longitude"), text("location.precision").alias("location_precision"), text("location.region").alias("location_region"),
        _joined(F.col("types")).alias("types"), F.when(F.size(primary) > 0, F.element_at(primary, 1)).otherwise("").alias("primary_commodity"),
        F.array_join(metals(False), ",").alias("secondary_commodities"), _joined(F.col("commodities.metal")).alias("all_commodities"),
        F.array_join(F.filter(_list(F.col("company_mentions.name")), lambda n: n != ""), ",").alias("company_mentions"), _joined(F.col("aliases")).alias("aliases"),
        F.col("verification.confidence").alias("confidence"), F.coalesce(F.when(F.size("sources") >= 0, F.size("sources")), F.lit(0)).alias("source_count"),
        F.array_join(F.array_sort(F.array_distinct(F.filter(_list(F.col("sources.type")), lambda t: t != ""))), ",").alias("source_types"),
        F.coalesce(F.substring("verification.notes", 1, 500), F.lit("")).alias("notes"),
    )


def bridge_materials(facility: DataFrame) -> DataFrame:
    return facility.select("rec_id", F.posexplode("commodities").alias("pos", "c")).select("rec_id", "pos", F.trim("c.metal").alias("material_name"), F.coalesce("c.is_primary", F.lit(False)).alias("is_primary")).where("material_name <> ''")


def bridge_companies(facility: DataFrame) -> DataFrame:
    rows = facility.select("rec_id", F.explode("company_mentions").alias("m")).select("rec_id", F.trim("m.name").alias("company_name"), F.lower("m.role").alias("role"), F.coalesce("m.lei", F.lit("")).alias("lei"))
    kind = F.when(F.col("role") == "operator", "operator").when(F.col("role").isin("owner", "majority_owner", "minority_owner"), "owner").otherwise("mention")
    return rows.where("company_name <> ''").select("rec_id", "company_name", kind.alias("relationship_type"), "lei").distinct()


def mines_rows(facility: DataFrame, country: DataFrame) -> DataFrame:
    """The ten-column listing; zero coordinates print empty."""
    number = lambda c: F.when(c.isNull() | (c == 0), "").otherwise(F.format_string("%.5f", c))
    names = F.concat(F.array(F.coalesce("name", F.lit(""))), F.filter(_list(F.col("aliases")), lambda a: (a != "") & (a != F.coalesce("name", F.lit("")))))
    prime, rest = metals(True), metals(False)
    rows = facility.join(bounded(country.select("iso3", "country_name"), 10_000), F.col("country_iso3") == F.col("iso3"), "left")
    return rows.select(
        "rec_id", confidence_label(F.coalesce("verification.confidence", F.lit(0.5))).alias("confidence_factor"), F.array_join(names, ";").alias("mine_name"),
        F.array_join(F.array_distinct(F.filter(_list(F.col("company_mentions.name")), lambda n: n != "")), ";").alias("company_names"), number(F.col("location.lat")).alias("latitude"), number(F.col("location.lon")).alias("longitude"),
        asset_types(F.col("types")).alias("asset_type"), F.coalesce("country_name", F.lit("")).alias("country_or_region"), F.when(F.size(prime) > 0, F.element_at(prime, 1)).otherwise("").alias("primary_commodity"),
        F.when(F.size(rest) > 0, F.element_at(rest, 1)).otherwise("").alias("secondary_commodity"), F.array_join(F.slice(rest, F.lit(2), F.greatest(F.size(rest), F.lit(1))), ",").alias("other_commodities"),
    )


def has_metal(target: str) -> Column:
    """A basket by the category of any commodity, a metal by containment either way."""
    key = target.strip().lower()
    if key in fixed.BASKETS:
        bucket = fixed.BASKETS[key]
        return F.coalesce(F.exists("commodities", lambda c: F.coalesce(F.split(c["category"], "_")[0] == bucket, F.lit(False))), F.lit(False))
    low = lambda c: F.lower(F.trim(c["metal"]))
    return F.coalesce(F.exists("commodities", lambda c: F.coalesce((low(c) != "") & (low(c).contains(key) | F.lit(key).contains(low(c))), F.lit(False))), F.lit(False))


def has_company(target: str) -> Column:
    """Equal, contained either way, or one's words a subset of the other's; case ignored."""
    key = target.strip().lower()
    words = F.array(*(F.lit(w) for w in dict.fromkeys(key.split())))

    def fits(m: Column) -> Column:
        low = F.lower(m["name"])
        own = F.array_distinct(F.split(F.trim(low), r"\s+"))
        subset = (F.size(F.array_except(words, own)) == 0) | (F.size(F.array_except(own, words)) == 0)
        return F.coalesce((F.trim(low) != "") & (low.contains(key) | F.lit(key).contains(low) | subset), F.lit(False))

    return F.coalesce(F.exists("company_mentions", fits), F.lit(False))


def name_contains(text: str) -> Column:
    key = text.lower()
    return F.coalesce(F.lower("name").contains(key), F.lit(False)) | F.coalesce(F.exists("aliases", lambda a: F.coalesce(F.lower(a).contains(key), F.lit(False))), F.lit(False))
