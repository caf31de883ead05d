"""Records exchanged with other systems: the flat row of a record, the way back, and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orelode.plans.runtime import bounded


def _texts(c: Column) -> Column:
    return F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))


def _joined(c: Column) -> Column:
    """Joined by semicolons; null if there is nothing to join."""
    return F.when(F.size(c) > 0, F.array_join(c, ";"))


def exchange_rows(facility: DataFrame, country_ref: DataFrame) -> DataFrame:
    """One flat row a record.  The primary metal is the last one marked primary; the secondary is
    the first of the rest.  Countries without a name keep their code; a record without sources has
    no source.  What the records do not hold (admin1, city, address, capacity) is null."""
    metals = _texts(F.col("commodities.metal"))
    marked = F.filter("commodities", lambda c: F.coalesce(c["is_primary"], F.lit(False)) & (F.coalesce(c["metal"], F.lit("")) != ""))
    primary = F.when(F.size(marked) > 0, F.element_at(marked, -1)["metal"])
    names = F.array_distinct(_texts(F.col("company_mentions.name")))
    facility = facility.withColumns({"_metals": metals, "_primary": primary}).withColumn("_rest", F.filter("_metals", lambda m: F.col("_primary").isNull() | (m != F.col("_primary"))))
    metals, primary, rest = F.col("_metals"), F.col("_primary"), F.col("_rest")
    nothing = lambda kind: F.lit(None).cast(kind)
    rows = facility.join(bounded(country_ref.select("iso3", "country_name"), 10_000), F.col("country_iso3") == F.col("iso3"), "left")
    return rows.select(
        "rec_id", "facility_id", nothing("string").alias("company_id"), _joined(names).alias("company_names"), F.col("name").alias("facility_name"),
        F.coalesce("aliases", F.array().cast("array<string>")).alias("alt_names"), F.get("types", F.lit(0)).alias("facility_type"), F.coalesce("country_name", "country_iso3").alias("country"), "country_iso3",
        *(nothing("string").alias(c) for c in ("admin1", "city", "address")), F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"), F.coalesce("location.precision", F.lit("unknown")).alias("geo_precision"),
        _joined(metals).alias("commodities"), primary.alias("primary_metal"), F.get(rest, F.lit(0)).alias("secondary_metal"), _joined(F.slice(rest, F.lit(2), F.greatest(F.size(rest), F.lit(1)))).alias("other_metals"),
        _joined(_texts(F.col("types"))).alias("process_stages"), nothing("double").alias("capacity_value"), nothing("string").alias("capacity_unit"), nothing("int").alias("capacity_asof"),
        F.coalesce("status", F.lit("unknown")).alias("operating_status"), F.array_join(_texts(F.col("sources.url")), ";").alias("evidence_urls"), _joined(_texts(F.col("sources.id"))).alias("evidence_titles"),
        F.coalesce("verification.confidence", F.lit(0.5)).alias("confidence"), F.coalesce(F.col("verification.status").isin("human_verified", "llm_verified"), F.lit(False)).alias("is_verified"),
        F.col("verification.notes").alias("verification_notes"), F.col("verification.last_checked").alias("first_seen_utc"), F.col("verification.last_checked").alias("last_seen_utc"),
        F.when(F.size("sources") > 0, F.coalesce(F.get("sources", F.lit(0))["type"], F.lit("unknown"))).alias("source"),
    )


def from_exchange(rows: DataFrame, country_ref: DataFrame) -> DataFrame:
    """Records of flat rows.  The way back loses: only the first metal is primary, owners are gone,
    titles go with urls by position, and verification is human or suggested.  A row without types
    is a mine; without a country code its name decides, else ``UNK``; without sources it is manual."""
    split = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    codes = bounded(country_ref.groupBy(F.lower(F.trim("country_name")).alias("_name")).agg(F.min("iso3").alias("_iso3")), 10_000)
    rows = rows.join(codes, F.lower(F.trim("country")) == F.col("_name"), "left")
    types = split("process_stages")
    types = F.when(F.size(types) > 0, types).when(F.col("facility_type").isNotNull(), F.array("facility_type")).otherwise(F.array(F.lit("mine")))
    # a title belongs to the url at its place, blank urls counted
    titles = F.transform(F.split(F.coalesce("evidence_titles", F.lit("")), ";"), lambda x: F.nullif(F.trim(x), F.lit("")))
    urls = F.transform(F.split("evidence_urls", ";"), lambda u, i: F.struct(F.lit("web").alias("type"), F.get(titles, i).alias("id"), F.trim(u).alias("url")))
    urls = F.filter(F.coalesce(urls, F.array().cast("array<struct<type:string,id:string,url:string>>")), lambda s: s["url"] != "")
    one = lambda kind, said: F.array(F.struct(kind.alias("type"), F.lit(said).alias("id"), F.lit(None).cast("string").alias("url")))
    sources = F.when(F.col("source").isNotNull(), F.concat(urls, one(F.col("source"), "Imported row"))).otherwise(urls)
    return rows.select(
        "rec_id", "facility_id", F.col("facility_name").alias("name"), F.coalesce("alt_names", F.array().cast("array<string>")).alias("aliases"), F.coalesce("country_iso3", "_iso3", F.lit("UNK")).alias("country_iso3"),
        F.struct("lat", "lon", F.coalesce("geo_precision", F.lit("unknown")).alias("precision")).alias("location"), types.alias("types"),
        F.transform(split("commodities"), lambda m, i: F.struct(m.alias("metal"), (i == 0).alias("is_primary"))).alias("commodities"), F.coalesce("operating_status", F.lit("unknown")).alias("status"),
        F.when(F.size(sources) > 0, sources).otherwise(one(F.lit("manual"), "Imported row")).alias("sources"),
        F.struct(F.when(F.coalesce("is_verified", F.lit(False)), "human_verified").otherwise("llm_suggested").alias("status"), F.coalesce("confidence", F.lit(0.75)).alias("confidence"), F.col("last_seen_utc").alias("last_checked"), F.col("verification_notes").alias("notes")).alias("verification"),
    )


def imported(target: DataFrame, source: DataFrame, key: str, overwrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, counts): the target after an import of ``source`` with the same columns, and how many
    source rows were ``imported``, ``skipped`` (their key exists, without ``overwrite``) or ``failed``
    (no key).  Keys repeated in the source are rows of their own, as they come."""
    columns = target.columns
    ok = source.where(F.col(key).isNotNull()).select(*columns)
    keys = target.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    known = ok.join(keys.withColumn("_known", F.lit(True)), ok[key] == F.col("_key"), "left").withColumn("_known", F.coalesce("_known", F.lit(False))).drop("_key")
    taken = known if overwrite else known.where("not _known")
    if overwrite:
        target = target.join(ok.select(F.col(key).alias("_key")).distinct(), target[key] == F.col("_key"), "left_anti")
    counts = known.agg(F.count_if(F.lit(overwrite) | ~F.col("_known")).alias("imported"), F.count_if(~F.lit(overwrite) & F.col("_known")).alias("skipped"))
    failed = source.agg(F.count_if(F.col(key).isNull()).alias("failed"))
    return target.unionByName(taken.select(*columns)), counts.crossJoin(failed)
