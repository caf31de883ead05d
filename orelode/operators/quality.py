"""Audit predicates, coordinate checks and fixes, and coverage reports of facility records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orelode.functions import fixed
from orelode.functions.text import lookup



def lat() -> Column:
    return F.col("location.lat")


def lon() -> Column:
    return F.col("location.lon")



def _empty(c: str) -> Column:
    return F.coalesce(F.size(c) <= 0, F.lit(True))


def audit_issues() -> Column:
    """array<string> of the issues of a facility record; zero coordinates count as missing."""
    name = F.coalesce("name", F.lit(""))
    low = F.lower(F.trim(name))
    no_point = F.coalesce((lat() == 0) | (lon() == 0), F.lit(True)) | lat().isNull() | lon().isNull()
    checks = {
        "numeric_name": F.trim(name).rlike(r"^\d+$"),
        "generic_name": low.rlike("|".join(fixed.GENERIC_NAMES)),
        "no_coordinates": no_point,
        "imprecise_location": ~no_point & (F.col("location.precision") == "unknown"),
        "no_commodities": _empty("commodities"),
        "no_primary_commodity": ~_empty("commodities") & ~F.coalesce(F.exists("commodities", lambda c: F.coalesce(c["is_primary"], F.lit(False))), F.lit(False)),
        "no_operator_owner": ~F.coalesce(F.exists("company_mentions", lambda m: F.coalesce(m["role"].isin("operator", "owner", "majority_owner", "minority_owner"), F.lit(False))), F.lit(False)),
        "unknown_status": F.coalesce("status", F.lit("unknown")) == "unknown",
        "low_confidence": F.coalesce(F.col("verification.confidence"), F.lit(0.0)) < 0.5,
        "no_sources": _empty("sources"),
        "generic_type": _empty("types") | F.coalesce((F.size("types") == 1) & (F.col("types")[0] == "mine"), F.lit(False)),
    }
    return F.filter(F.array(*(F.when(F.coalesce(cond, F.lit(False)), issue) for issue, cond in checks.items())), lambda x: x.isNotNull())


def audited(facility: DataFrame) -> DataFrame:
    """``rec_id``, ``facility_id``, ``issue``: one row an issue."""
    return facility.select("rec_id", "facility_id", F.explode(audit_issues()).alias("issue"))


def least_per_issue(issues: DataFrame, k: int) -> DataFrame:
    """``issue`` and its ``k`` least rec_ids.  Every task keeps k ids an issue, so what is merged
    has at most k rows a task and issue."""

    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame({"issue": pd.Series(dtype=str), "rec_id": pd.Series(dtype="int64")})
        for b in batches:
            kept = pd.concat([kept, b]).sort_values("rec_id").groupby("issue").head(k)
        yield kept

    part = issues.select("issue", "rec_id").where("rec_id is not null").mapInPandas(least, "issue string, rec_id bigint")
    few = part.groupBy("issue").agg(F.slice(F.array_sort(F.collect_list("rec_id")), 1, k).alias("ids"))
    return few.select("issue", F.explode("ids").alias("rec_id"))


def _bounds(country: Column, table: dict) -> list[Column]:
    return [lookup(country, {k: str(v[i]) for k, v in table.items()}).cast("double") for i in range(4)]


def _within(lat: Column, lon: Column, b: list[Column]) -> Column:
    return lat.between(b[0], b[1]) & lon.between(b[2], b[3])


def in_bounds(lat: Column, lon: Column, country: Column, antimeridian: bool = False, boxes: dict = fixed.BBOX) -> Column:
    """Whether a point is in its country's box; without a box it is.  With ``antimeridian`` boxes
    whose east edge is below their west edge wrap around."""
    b = _bounds(country, boxes)
    plain = _within(lat, lon, b)
    if antimeridian:
        plain = F.when(b[2] > b[3], lat.between(b[0], b[1]) & ((lon >= b[2]) | (lon <= b[3]))).otherwise(plain)
    return b[0].isNull() | plain


def bbox_checks(lat: Column, lon: Column, country: Column) -> Column:
    """array<string> of the failing checks of a position: a missing or invalid one fails no other,
    one outside of its country's box may be too round as well."""
    inside = in_bounds(lat, lon, country)
    whole = (lat == F.floor(lat)) & (lon == F.floor(lon))
    foreign = F.when(~inside & in_bounds(lon, lat, country), "latlon_swap").when(~inside, "out_of_bounds")
    rest = F.filter(F.array(foreign, F.when(whole, "suspicious_precision")), lambda x: x.isNotNull())
    return F.when(lat.isNull() | lon.isNull(), F.array(F.lit("missing_coordinates"))).when((F.abs(lat) > 90) | (F.abs(lon) > 180), F.array(F.lit("invalid_range"))).otherwise(rest)


def swapped_back(facility: DataFrame) -> DataFrame:
    """``rec_id``, ``lat``, ``lon``, ``fixed``: latitude and longitude changed over where the check
    says so."""
    swap = F.array_contains(bbox_checks(lat(), lon(), F.col("country_iso3")), "latlon_swap")
    return facility.select("rec_id", F.when(swap, lon()).otherwise(lat()).alias("lat"), F.when(swap, lat()).otherwise(lon()).alias("lon"), swap.alias("fixed"))


def coordinate_issues(facility_id: Column, country: Column, lat: Column, lon: Column) -> Column:
    """array<struct<issue, lat, lon, fixable>>: known fixes and the null island end the search,
    the other issues add up."""
    row = lambda issue, a, o, fixable: F.array(F.struct(F.lit(issue).alias("issue"), a.cast("double").alias("lat"), o.cast("double").alias("lon"), F.lit(fixable).alias("fixable")))
    null = F.lit(None)
    none = F.slice(row("", null, null, False), 1, 0)
    known = [lookup(facility_id, {k: str(v[i]) for k, v in fixed.KNOWN_FIXES.items()}) for i in (0, 1)]
    b = _bounds(country, fixed.FIX_BOUNDS)
    out = b[0].isNotNull() & ~_within(lat, lon, b)
    added = F.concat(
        F.when(country.isin(*fixed.NORTHERN) & (lat < 0), row("wrong_hemisphere", F.abs(lat), lon, True)).otherwise(none),
        F.when(~F.coalesce(country.isin(*fixed.LON_NEAR_1), F.lit(False)) & lon.between(0.5, 1.5), row("truncated_longitude", null, null, False)).otherwise(none),
        F.when(out & _within(lon, lat, b), row("swapped", lon, lat, False)).when(out, row("out_of_bounds", null, null, False)).otherwise(none),
    )
    return (
        F.when(lat.isNull() | lon.isNull(), none).when(facility_id.isin(*fixed.KNOWN_DELETES), row("duplicate_to_delete", null, null, True))
        .when(known[0].isNotNull(), row("known_fix", known[0], known[1], True)).when((lat == 0) & (lon == 0), row("null_island", null, null, False)).otherwise(added)
    )


def fixed_coordinates(facility: DataFrame) -> DataFrame:
    """``rec_id``, ``lat``, ``lon`` after the first fixable issue; records to delete are left out."""
    found = F.filter(coordinate_issues(F.col("facility_id"), F.col("country_iso3"), lat(), lon()), lambda x: x["fixable"])
    first = F.when(F.size(found) > 0, F.element_at(found, 1))
    rows = facility.select("rec_id", lat().alias("lat"), lon().alias("lon"), first.alias("fix"))
    return rows.where("fix.issue is null or fix.issue <> 'duplicate_to_delete'").select("rec_id", F.coalesce("fix.lat", "lat").alias("lat"), F.coalesce("fix.lon", "lon").alias("lon"), F.col("fix.issue").alias("fixed_by"))


def write_gate(lat: Column, lon: Column, country: Column) -> Column:
    """Whether a new position may be written: sentinel, invalid and foreign ones may not; countries
    without a box of their own for writing pass."""
    sentinel = (F.round(lat, 7) == fixed.SENTINEL[0]) & (F.round(lon, 7) == fixed.SENTINEL[1])
    return F.when(lat.isNull() | lon.isNull(), "missing").when(sentinel, "sentinel").when((F.abs(lat) > 90) | (F.abs(lon) > 180), "invalid").when(~in_bounds(lat, lon, country, boxes=fixed.WRITE_BBOX), "out_of_bbox").otherwise("accept")


def confidence_bucket(c: Column) -> Column:
    return F.when(c.isNull(), "none").when(c < 0.5, "low").when(c < 0.8, "medium").otherwise("high")
