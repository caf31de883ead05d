"""Readers and writers of facility documents, listings and relationship tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Mentions and commodities may be texts or objects, so they are read as VARIANT.
DOCUMENT = (
    "facility_id string, name string, aliases array<string>, country_iso3 string, location struct<lat:double,lon:double,precision:string,town:string,region:string>, types array<string>, commodities variant, status string, "
    "company_mentions variant, sources variant, verification struct<status:string,confidence:double,last_checked:string,checked_by:string,notes:string>, canonical_slug string, _damaged string"
)


def read_documents(spark: SparkSession, path: str, countries: list[str] | None = None) -> DataFrame:
    """All documents under ``path``/<ISO3>/*.json with their directory as ``country_dir``; damaged
    files are rows with ``_damaged`` set.  ``countries`` prunes directories, not rows."""
    paths = [f"{path}/{c}/*.json" for c in countries] if countries else [f"{path}/*/*.json"]
    raw = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_damaged").schema(DOCUMENT).json(paths)
    parts = F.split(F.col("_metadata.file_path"), "/")
    return raw.withColumn("country_dir", F.element_at(parts, -2)).withColumn("file_name", F.col("_metadata.file_name"))


def mentions(v: Column) -> Column:
    """array<struct<name, role, percentage, confidence>> of mentions written as texts or objects;
    a text is a name with the role unknown."""
    items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))
    of = lambda x, k, t: F.try_variant_get(x, f"$.{k}", t)
    made = F.transform(
        items,
        lambda x: F.struct(
            F.coalesce(of(x, "name", "string"), F.when(F.try_variant_get(x, "$", "map<string,variant>").isNull(), F.try_variant_get(x, "$", "string"))).alias("name"), F.coalesce(of(x, "role", "string"), F.lit("unknown")).alias("role"),
            of(x, "percentage", "double").alias("percentage"), of(x, "confidence", "double").alias("confidence"),
        ),
    )
    return F.filter(made, lambda x: F.length(F.trim(x["name"])) > 0)


def write_documents(df: DataFrame, path: str) -> None:
    """JSON documents by country; columns whose names start with an underscore are not written."""
    kept = df.select(*(c for c in df.columns if not c.startswith("_")))
    kept.write.mode("overwrite").partitionBy("country_iso3").json(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Fact and bridge tables as snappy parquet, one folder each."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/{name}")


def write_listing(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def newest(spark: SparkSession, pattern: str) -> str | None:
    """The most recently modified file that fits the pattern, null if there is none."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    return files.agg(F.max_by("path", "modificationTime").alias("p")).first()["p"]


def overpass_features(raw: Column) -> Column:
    """array<struct<id, name, lat, lon, resource>> of an Overpass answer; features without a
    position of their own take their centre, and are left out without either."""
    schema = "elements array<struct<id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"
    made = F.transform(
        F.coalesce(F.from_json(raw, schema)["elements"], F.array().cast("array<struct<id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>")),
        lambda e: F.struct(e["id"].alias("id"), F.try_element_at(e["tags"], F.lit("name")).alias("name"), F.coalesce(e["lat"], e["center"]["lat"]).alias("lat"), F.coalesce(e["lon"], e["center"]["lon"]).alias("lon"), F.try_element_at(e["tags"], F.lit("resource")).alias("resource")),
    )
    return F.filter(made, lambda x: x["lat"].isNotNull() & x["lon"].isNotNull())


def wkt_point(c: Column) -> Column:
    """struct<lat, lon> of "Point(lon lat)", null if it is none."""
    pattern = r"(?i)point\s*\(\s*(-?[\d.]+)\s+(-?[\d.]+)\s*\)"
    lon, lat = (F.regexp_extract(c, pattern, i).try_cast("double") for i in (1, 2))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def knowledge_items(bindings: DataFrame) -> DataFrame:
    """Query bindings (qid, label, coord, alias, commodity) grouped to items: the first label and
    position, the distinct aliases and commodities."""
    rows = bindings.withColumn("p", wkt_point(F.col("coord")))
    return rows.groupBy("qid").agg(F.min("label").alias("label"), F.min("p").alias("p"), F.array_sort(F.collect_set("alias")).alias("aliases"), F.array_sort(F.collect_set("commodity")).alias("commodities")).select("qid", "label", "p.lat", "p.lon", "aliases", "commodities")


def cached(keys: DataFrame, cache: DataFrame, now: Column, ttl_days: int = 365) -> DataFrame:
    """Left lookup of positions rounded to four digits in a cache (lat_r, lon_r, town, ts); expired
    and unreadable entries miss; of several entries the latest counts."""
    live = cache.where(F.col("ts").isNotNull() & (F.col("ts") > now - F.expr(f"INTERVAL {ttl_days} DAYS"))).groupBy("lat_r", "lon_r").agg(F.max_by("town", "ts").alias("town"))
    rounded = keys.withColumns({"lat_r": F.round("lat", 4), "lon_r": F.round("lon", 4)})
    return rounded.join(live, ["lat_r", "lon_r"], "left").withColumn("hit", F.col("town").isNotNull())
