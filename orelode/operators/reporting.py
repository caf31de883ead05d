"""Coverage, collisions and issue summaries of facility records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orelode.operators.enrich import canonical, flags
from orelode.operators.quality import bbox_checks, coordinate_issues, lat, lon


def described(facility: DataFrame) -> DataFrame:
    """Records with what is derived for them: canonical and display name, type, operator and flags."""
    names = canonical(facility)
    own = facility.select("rec_id", "facility_id", "country_iso3", "canonical_slug", F.trim("location.town").alias("town"), F.exists("company_mentions", lambda m: F.coalesce((m["role"] == "operator") & (F.trim(m["name"]) != ""), F.lit(False))).alias("operated"))
    return own.join(names, "rec_id").join(flags(names, facility), "rec_id")


def bucket(c: Column) -> Column:
    return F.when(c.isNull(), "none").when(c < 0.5, "low").when(c < 0.8, "medium").otherwise("high")


def quality_report(rows: DataFrame, type_confidence: Column) -> DataFrame:
    """Field coverage, flags and type-confidence buckets of :func:`described` rows, by country and for
    ALL of them, in order of the country; records without a country are ``???``."""
    some = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "").alias(c)
    graded = rows.withColumn("_b", bucket(type_confidence))
    got = graded.withColumn("country", F.coalesce("country_iso3", F.lit("???"))).rollup("country").agg(
        F.count("*").alias("n"), some("canonical_name"), some("canonical_slug"), some("town"), some("primary_type"), some("display_name"), F.count_if(F.coalesce("operated", F.lit(False))).alias("operator_display"),
        *(F.count_if(f).alias(f) for f in ("town_missing", "operator_unresolved", "canonical_name_incomplete")), *(F.count_if(F.col("_b") == b).alias(f"type_{b}") for b in ("none", "low", "medium", "high")),
    )
    return got.withColumn("country", F.coalesce("country", F.lit("ALL"))).orderBy("country")


def collisions(facility: DataFrame, most: int = 10, examples: int = 3) -> DataFrame:
    """The ``most`` largest groups of records of one country and slug: ``holders`` and the least
    ``examples`` ids, found in rounds, so no group is collected."""
    rows = facility.where("canonical_slug <> '' and facility_id is not null").select(F.coalesce("country_iso3", F.lit("???")).alias("country"), F.col("canonical_slug").alias("slug"), "facility_id")
    keys = ["country", "slug"]
    top = rows.groupBy(*keys).agg(F.count("*").alias("holders")).where("holders > 1").orderBy(F.desc("holders"), *keys).limit(most)
    own = rows.join(F.broadcast(top), keys)
    ids, left = [], own
    for i in range(examples):
        first = left.groupBy(*keys).agg(F.min("facility_id").alias(f"id_{i}"))
        ids.append(first)
        left = left.join(F.broadcast(first), keys).where(F.col("facility_id") > F.col(f"id_{i}")).drop(f"id_{i}")
    for first in ids:
        top = top.join(F.broadcast(first), keys, "left")
    return top.select(*keys, "holders", F.concat_ws(",", *(f"id_{i}" for i in range(examples))).alias("examples"))


def validation_summary(facility: DataFrame) -> DataFrame:
    """Issues of positions by type, the commonest first."""
    found = facility.select(F.explode(bbox_checks(lat(), lon(), F.col("country_iso3"))).alias("issue"))
    return found.groupBy("issue").agg(F.count("*").alias("records")).orderBy(F.desc("records"), "issue")


def fix_summary(facility: DataFrame) -> DataFrame:
    """Coordinate issues by type: all, and those that are fixed without asking."""
    found = facility.select(F.explode(coordinate_issues(F.col("facility_id"), F.col("country_iso3"), lat(), lon())).alias("x")).select("x.*")
    return found.groupBy("issue").agg(F.count("*").alias("found"), F.count_if("fixable").alias("fixable"))
