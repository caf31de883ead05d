"""Typed facility rows from listing cells: names, aliases, positions, companies and row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orelode.functions.text import parse_commodities, parse_status, parse_types, slugify
from orelode.sources.reports import valid_name

# Suffixes that make a name a company, and parentheticals that are no alias.
COMPANY = r"(?i)\b(ltd|limited|inc|corp|corporation|llc|plc|gmbh|s\.?a\.?|pty|company|co|group|holdings?|mining|resources)\b\.?$"
NO_ALIAS = r"(?i)^(?:ltd|limited|inc|pty|gov'?t|government|state|private|jv|\d{4}|operational|operating|closed|suspended|planned|proposed|active|inactive|old|l/r)$"
LABELS = {"Very High": 0.90, "High": 0.80, "Moderate": 0.65, "Low": 0.45, "Very Low": 0.30}


def parenthetical_aliases(name: Column) -> Column:
    """What stands in parentheses in a name and may be an alias."""
    found = F.transform(F.regexp_extract_all(name, F.lit(r"\(([^)]+)\)"), F.lit(1)), lambda x: F.trim(x))
    return F.filter(found, lambda x: (x != "") & ~x.rlike(NO_ALIAS))


def bare_name(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(name, r"\([^)]*\)", " "), r"\s+", " "))


def position(lat: Column, lon: Column, both: Column) -> Column:
    """struct<lat, lon> of separate texts, or of "lat, lon" in one where both are missing; what
    cannot be read is null."""
    clean = lambda c: F.when(F.trim(c).isin("", "-"), None).otherwise(F.trim(c)).try_cast("double")
    parts = F.split(both, r"\s*[,;]\s*")
    a, o = clean(lat), clean(lon)
    joint = a.isNull() & o.isNull() & (F.size(parts) == 2)
    return F.struct(F.when(joint, clean(F.get(parts, F.lit(0)))).otherwise(a).alias("lat"), F.when(joint, clean(F.get(parts, F.lit(1)))).otherwise(o).alias("lon"))


def operators(text: Column, confidence: float = 0.70) -> Column:
    """array<struct<name, role, confidence>> of operators separated by / or ;."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "[/;]"), lambda x: F.trim(F.regexp_replace(x, r"\([^)]*\)", ""))), lambda x: ~x.isin("", "-"))
    return F.transform(parts, lambda x: F.struct(x.alias("name"), F.lit("operator").alias("role"), F.lit(confidence).alias("confidence")))


def group_names(text: Column) -> Column:
    """struct<companies, aliases> of a ; separated list; what ends like a company is one."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    return F.struct(F.array_distinct(F.filter(parts, lambda x: x.rlike(COMPANY))).alias("companies"), F.array_distinct(F.filter(parts, lambda x: ~x.rlike(COMPANY))).alias("aliases"))


def label_confidence(label: Column) -> Column:
    out = F.lit(0.5)
    for name, value in LABELS.items():
        out = F.when(F.lower(F.trim(label)) == name.lower(), value).otherwise(out)
    return out


# Adjectives in file names, in the order they are tried.
DEMONYMS = {
    "finnish": "Finland", "french": "France", "german": "Germany", "spanish": "Spain", "italian": "Italy", "polish": "Poland", "swedish": "Sweden", "norwegian": "Norway", "danish": "Denmark", "dutch": "Netherlands", "belgian": "Belgium",
    "austrian": "Austria", "swiss": "Switzerland", "greek": "Greece", "turkish": "Turkey", "russian": "Russia", "chinese": "China", "japanese": "Japan", "korean": "Korea", "indian": "India", "brazilian": "Brazil", "mexican": "Mexico",
    "canadian": "Canada", "australian": "Australia", "egyptian": "Egypt", "nigerian": "Nigeria", "south african": "South Africa", "argentinian": "Argentina", "chilean": "Chile", "peruvian": "Peru", "colombian": "Colombia",
}


def country_from_file(path: Column) -> Column:
    """What a file's name says about its country: the country of an adjective in it, else its first
    word of two letters or more; null if there is none."""
    base = F.regexp_replace(F.lower(F.element_at(F.split(path, "/"), -1)), r"(?<=.)\.[^.]*$", "")
    first = F.trim(F.get(F.split(base, r"[_\-\s.]"), F.lit(0)))
    out = F.when(base.isNull() | base.isin("", "-"), None)
    for word, country in DEMONYMS.items():
        out = out.when(base.contains(word), country)
    return out.otherwise(F.when(F.length(first) >= 2, first))


def joined_cells(*cells: Column) -> Column:
    """Cells of several columns with one meaning, joined by commas; null, "" and "-" do not count."""
    parts = F.filter(F.array(*(F.trim(c) for c in cells)), lambda x: x.isNotNull() & ~x.isin("", "-"))
    return F.array_join(parts, ", ")


def import_stats(rows: DataFrame) -> DataFrame:
    """One row: rows read, imported ones, those refused by reason, and with a position."""
    bad = F.col("error")
    return rows.agg(
        F.count("*").alias("read"), F.count_if(bad.isNull()).alias("imported"), F.count_if(bad == "repeated").alias("duplicates"), F.count_if(bad.isNotNull() & (bad != "repeated")).alias("errors"),
        F.count_if(bad.isNull() & F.col("location.lat").isNotNull() & F.col("location.lon").isNotNull()).alias("with_position"),
    )


def typed_rows(cells: DataFrame, country: str) -> DataFrame:
    """Facility rows of report cells (doc_id, format, table_no, row_no, header, value); rows whose
    name is none carry an ``error`` instead of being dropped, the first of equal ids counts."""
    wide = cells.groupBy("doc_id", "table_no", "row_no").pivot("header", ["name", "lat", "lon", "coordinates", "primary", "other", "types", "status", "operator", "synonyms", "confidence_factor"]).agg(F.first("value", ignorenulls=True))
    name = bare_name(F.col("name"))
    rows = wide.select(
        "doc_id", "table_no", "row_no", name.alias("name"), F.concat_ws("-", F.lit(country.lower()), slugify(F.col("name")), F.lit("fac")).alias("facility_id"), position(F.col("lat"), F.col("lon"), F.col("coordinates")).alias("location"),
        F.array_distinct(F.concat(parenthetical_aliases(F.coalesce("name", F.lit(""))), F.filter(F.transform(F.split(F.coalesce("synonyms", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))).alias("aliases"), parse_types(F.col("types")).alias("types"),
        parse_commodities(F.col("primary"), F.col("other")).alias("commodities"), parse_status(F.col("status")).alias("status"), operators(F.col("operator")).alias("company_mentions"), label_confidence(F.col("confidence_factor")).alias("confidence"),
    )
    first = rows.groupBy("facility_id").agg(F.min(F.struct("doc_id", "table_no", "row_no")).alias("first"))
    at = F.struct("doc_id", "table_no", "row_no")
    return rows.join(first, "facility_id").withColumn("error", F.when(~valid_name(F.col("name")), "not a name").when(at != F.col("first"), "repeated")).drop("first")


def numbered(df: DataFrame, start: int = 2, column: str = "row_no") -> DataFrame:
    """Physical row numbers from ``start``: the place in the partition plus the rows of the
    partitions before (one number a partition)."""
    ids = df.withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33).cast("int")
    counts = sorted((r["p"], r["n"]) for r in ids.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    offsets, at = [], start
    for p, n in counts:
        offsets.append((p, at))
        at += n
    before = df.sparkSession.createDataFrame(offsets, "_p int, _at long")
    return ids.withColumn("_p", part).join(F.broadcast(before), "_p", "left").withColumn(column, F.col("_id").bitwiseAND((1 << 33) - 1) + F.col("_at")).drop("_id", "_p", "_at")
