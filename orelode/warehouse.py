"""Queries over results, relationships and events, each with the same result in SQL."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from orelode.functions import fixed, text
from orelode.operators import timeline
from orelode.plans.runtime import bounded, shared_folder, table
from orelode.sources import files, reports
from orelode.streaming import results

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


LATEST = "row_number() OVER (PARTITION BY facility_key, json_id, coalesce(accepted, false) ORDER BY as_of_date DESC NULLS FIRST, query_timestamp DESC NULLS FIRST, confidence DESC NULLS FIRST, result_id DESC) = 1 AND coalesce(accepted, false)"


@query(f"SELECT result_id, {LATEST} AS is_latest FROM measurable_result")
def latest_result(spark, d):
    return timeline.latest_results(table(spark, d, "measurable_result")).select("result_id", "is_latest")


@query(f"SELECT facility_key, json_id, result_id FROM measurable_result QUALIFY {LATEST}")
def latest_view(spark, d):
    return timeline.latest_keys(table(spark, d, "measurable_result"))


@query("""SELECT r.json_id, count(*) AS results, count(*) FILTER (WHERE freshness_days <= requery_min_days) AS fresh, count(*) FILTER (WHERE confidence >= 70) AS confident
 FROM measurable_result r JOIN measurable m ON r.json_id = m.json_id WHERE m.is_active GROUP BY r.json_id""")
def freshness_filter(spark, d):
    m = table(spark, d, "measurable").where("is_active").select("json_id", "requery_min_days")
    r = table(spark, d, "measurable_result").select("json_id", "freshness_days", "confidence").join(bounded(m, 10_000), "json_id")
    return r.groupBy("json_id").agg(F.count("*").alias("results"), F.count_if(F.col("freshness_days") <= F.col("requery_min_days")).alias("fresh"), F.count_if(F.col("confidence") >= 70).alias("confident"))


@query("""SELECT run_id, count(*) AS attempted, count(*) FILTER (WHERE accepted) AS accepted, count(*) FILTER (WHERE provisional) AS provisional, round(avg(freshness_days), 4) AS avg_freshness, count(DISTINCT facility_key) AS sites FROM measurable_result GROUP BY run_id""")
def run_summary(spark, d):
    return timeline.run_summary(table(spark, d, "measurable_result"))


@query("SELECT DISTINCT facility_key FROM measurable_result WHERE facility_key IS NOT NULL AND facility_key NOT IN (SELECT facility_id FROM facility WHERE facility_id IS NOT NULL)")
def orphans_anti(spark, d):
    return timeline.orphans(table(spark, d, "measurable_result"), "facility_key", table(spark, d, "facility"), "facility_id")


@query("SELECT count(*) AS relationships, count(DISTINCT facility_id) AS sites FROM facility_company_relationships WHERE facility_id IN (SELECT facility_id FROM facility)")
def exists_semi(spark, d):
    rel = table(spark, d, "facility_company_relationships").join(table(spark, d, "facility").select("facility_id").distinct(), "facility_id", "left_semi")
    return rel.agg(F.count("*").alias("relationships"), F.countDistinct("facility_id").alias("sites"))


@query("SELECT r.relationship_id, f.n AS facility_rows FROM (SELECT DISTINCT relationship_id, facility_id FROM facility_company_relationships) r JOIN (SELECT facility_id, count(*) AS n FROM facility GROUP BY 1) f ON r.facility_id = f.facility_id")
def relationship_facility_join(spark, d):
    rel = table(spark, d, "facility_company_relationships").select("relationship_id", "facility_id").distinct()
    return rel.join(table(spark, d, "facility").groupBy("facility_id").agg(F.count("*").alias("facility_rows")), "facility_id").select("relationship_id", "facility_rows")


def _gates(profile: str) -> str:
    accept, review = fixed.GATES[profile]
    return f"SELECT '{profile}' AS profile, CASE WHEN confidence >= {accept} THEN 'auto_accept' WHEN confidence >= {review} THEN 'review' ELSE 'pending' END AS verdict, count(*) AS n FROM facility_company_relationships GROUP BY 2"


@query(" UNION ALL ".join(map(_gates, fixed.GATES)))
def resolve_gates(spark, d):
    rel = table(spark, d, "facility_company_relationships")
    verdicts = F.array(*(F.struct(F.lit(p).alias("profile"), timeline.gate(F.col("confidence"), a, r).alias("verdict")) for p, (a, r) in fixed.GATES.items()))
    return rel.select(F.explode(verdicts).alias("g")).groupBy("g.profile", "g.verdict").agg(F.count("*").alias("n"))


@query("""SELECT role, count(*) AS rows_, count(DISTINCT relationship_id) AS relationships, round(avg(confidence - base_confidence), 6) AS avg_boost, round(max(percentage), 3) AS most FROM (SELECT lower(trim(role)) AS role, * EXCLUDE (role) FROM facility_company_relationships) GROUP BY role""")
def enrichment_stats(spark, d):
    rel = table(spark, d, "facility_company_relationships").withColumn("role", F.lower(F.trim("role")))
    return rel.groupBy("role").agg(F.count("*").alias("rows_"), F.countDistinct("relationship_id").alias("relationships"), F.round(F.avg(F.col("confidence") - F.col("base_confidence")), 6).alias("avg_boost"), F.round(F.max("percentage"), 3).alias("most"))


@query("SELECT p AS penalty, count(*) AS n FROM (SELECT unnest(gates_applied.penalties) AS p FROM facility_company_relationships) GROUP BY 1")
def penalties_exploded(spark, d):
    return table(spark, d, "facility_company_relationships").select(F.explode("gates_applied.penalties").alias("penalty")).groupBy("penalty").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT n_nationkey AS k, 'new ' || n_name AS v FROM nation WHERE n_nationkey >= 20 UNION ALL SELECT n_nationkey + 100, n_name FROM nation WHERE n_nationkey < 3)
 SELECT coalesce(s.k, t.n_nationkey) AS n_nationkey, CASE WHEN s.k IS NOT NULL THEN s.v ELSE t.n_name END AS n_name FROM nation t FULL JOIN s ON t.n_nationkey = s.k""")
def merge_upsert(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    source = n.where("n_nationkey >= 20").withColumn("n_name", F.concat(F.lit("new "), "n_name")).unionByName(n.where("n_nationkey < 3").withColumn("n_nationkey", F.col("n_nationkey") + 100))
    return timeline.upsert(n, source, "n_nationkey", ["n_name"])


@query("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region WHERE r_regionkey NOT IN (SELECT n_nationkey FROM nation) ")
def skip_existing(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return timeline.skip_existing(n, table(spark, d, "region").select(F.col("r_regionkey").alias("n_nationkey"), F.col("r_name").alias("n_name")), "n_nationkey")


@query("SELECT company_name, count(*) AS n FROM (SELECT company_name FROM facility_company_relationships UNION ALL SELECT unnest(company_mentions).name FROM facility) GROUP BY 1")
def append_union(spark, d):
    a = table(spark, d, "facility_company_relationships").select("company_name")
    return a.unionByName(table(spark, d, "facility").select(F.explode("company_mentions.name").alias("company_name"))).groupBy("company_name").agg(F.count("*").alias("n"))


@query("""WITH t AS (SELECT json_id, split_part(tag, ':', 1) AS ns, split_part(tag, ':', 2) AS v FROM (SELECT json_id, unnest(applicability_tags) AS tag FROM measurable)),
 q AS (SELECT m.json_id, list(t.v) FILTER (WHERE ns = 'facility') AS need FROM measurable m LEFT JOIN t USING (json_id) GROUP BY 1)
 SELECT f.rec_id, q.json_id FROM facility f, q WHERE need IS NULL OR list_contains(need, 'all') OR list_has_any(need, list_transform(coalesce(f.types, []), lambda x: lower(x)))""")
def tag_router(spark, d):
    return timeline.routed(table(spark, d, "facility"), table(spark, d, "measurable"))


@query("""WITH e AS (SELECT result_id, generate_subscripts(evidence, 1) - 1 AS pos, unnest(evidence) AS e FROM measurable_result) SELECT result_id, CAST(pos AS INTEGER) AS pos, sha256(concat_ws('|', e.title, e.url, CAST(e.evidence_date AS VARCHAR))) AS hash FROM e""")
def evidence_hash(spark, d):
    rows = table(spark, d, "measurable_result").select("result_id", F.posexplode("evidence").alias("pos", "e"))
    return rows.select("result_id", "pos", text.evidence_hash(F.col("e.title"), F.col("e.url"), F.col("e.evidence_date").cast("string")).alias("hash"))


@query("""SELECT facility_id, rec_id, name, previous FROM (SELECT facility_id, rec_id, name, lag(name) OVER (PARTITION BY facility_id ORDER BY loaded_at, rec_id) AS previous FROM facility WHERE facility_id IS NOT NULL AND name IS NOT NULL) WHERE previous IS NULL OR previous <> name""")
def name_history(spark, d):
    return timeline.changes(table(spark, d, "facility"), "facility_id", "name", ["loaded_at", "rec_id"]).select("facility_id", "rec_id", F.col("value").alias("name"), "previous")


@query("""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 2) AS total FROM events GROUP BY event_type""")
def events_by_type(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.round(F.sum("value"), 2).alias("total"))


@query("""SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_event(spark, d):
    rows = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    return rows.select("user_id", "event_id", "event_type")


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1")
def nested_json_props(spark, d):
    return table(spark, d, "events").groupBy(F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k")).agg(F.count("*").alias("n"))


HEAD = ("Site Name", "Latitude", "Longitude", "Operational Status")


@query("""WITH f AS (SELECT rec_id, trim(replace(replace(coalesce(name, ''), '|', ' '), chr(9), ' ')) AS name, coalesce(CAST(CAST(location.lat * 100000 AS BIGINT) AS VARCHAR), '') AS lat, coalesce(CAST(CAST(location.lon * 100000 AS BIGINT) AS VARCHAR), '') AS lon, trim(replace(coalesce(status, ''), '|', ' ')) AS status FROM facility)
 SELECT rec_id AS doc_id, h AS header, v AS value FROM f, (SELECT unnest(['name', 'lat', 'lon', 'status']) AS h) x, LATERAL (SELECT CASE h WHEN 'name' THEN name WHEN 'lat' THEN lat WHEN 'lon' THEN lon ELSE status END AS v)""")
def parse_report_tables(spark, d):
    """Facility records written as pipe tables within a report and read back, cell by cell."""
    cells = [
        F.translate(F.coalesce("name", F.lit("")), "|\t", "  "), *(F.coalesce(F.round(F.col(f"location.{c}") * 100000).cast("bigint").cast("string"), F.lit("")) for c in ("lat", "lon")), F.translate(F.coalesce("status", F.lit("")), "|", " "),
    ]
    line = lambda cs: F.concat(F.lit("| "), F.concat_ws(" | ", *cs), F.lit(" |"))
    body = F.concat_ws("\n", F.lit("Sites of the month"), line([F.lit(h) for h in HEAD]), F.lit("| --- | --- | --- | --- |"), line(cells), F.lit(""), F.lit("End of report"))
    docs = table(spark, d, "facility").select(F.col("rec_id").alias("doc_id"), body.alias("text"))
    return reports.parse_reports(docs).select("doc_id", "header", "value")


@query()
def parse_report_narrative(spark, d):
    """What documents' own lines introduce as sites, and tables in them."""
    return reports.parse_reports(table(spark, d, "documents"))


@query("SELECT rec_id, strip_accents(name) AS ascii_name FROM facility")
def ascii_fold_names(spark, d):
    return table(spark, d, "facility").select("rec_id", text.to_ascii("name").alias("ascii_name"))


@query("""SELECT c_nationkey, c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY GROUPING SETS ((c_nationkey, c_mktsegment), (c_nationkey), ())""")
def customer_grouping_sets(spark, d):
    table(spark, d, "customer").createOrReplaceTempView("orelode_customer")
    return spark.sql("SELECT c_nationkey, c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM orelode_customer GROUP BY GROUPING SETS ((c_nationkey, c_mktsegment), (c_nationkey), ())")


@query("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_shipdate >= DATE '1995-01-01' GROUP BY n_name""")
def revenue_by_nation(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    rows = table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(bounded(n, 10_000), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("""WITH p AS (SELECT round(lat, 4) AS lat_r, round(lon, 4) AS lon_r, arg_max(place_name, place_id) AS town FROM place GROUP BY 1, 2) SELECT place_id, p.town, p.town IS NOT NULL AS hit FROM place q LEFT JOIN p ON round(q.lat, 4) = p.lat_r AND round(q.lon, 4) = p.lon_r""")
def geocode_cache_lookup(spark, d):
    place = table(spark, d, "place")
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    cache = place.select(F.round("lat", 4).alias("lat_r"), F.round("lon", 4).alias("lon_r"), F.col("place_name").alias("town"), (now - F.expr("INTERVAL 10 DAYS") + F.make_dt_interval(secs=F.col("place_id").cast("int") + F.lit(0.0))).alias("ts"))
    old = cache.withColumns({"town": F.lit("expired"), "ts": now - F.expr("INTERVAL 400 DAYS")})
    return files.cached(place.select("place_id", "lat", "lon"), cache.unionByName(old), now).select("place_id", "town", "hit")


@query("SELECT place_id AS id, place_name AS name, round(lat, 5) AS lat, round(lon, 5) AS lon FROM place")
def overpass_answers(spark, d):
    """Places written as one map-service answer a country, every other with its centre only."""
    p = table(spark, d, "place")
    at = F.struct("lat", "lon")
    element = F.struct(F.col("place_id").alias("id"), F.when(F.col("kind") == "town", F.col("lat")).alias("lat"), F.when(F.col("kind") == "town", F.col("lon")).alias("lon"), F.when(F.col("kind") != "town", at).alias("center"), F.create_map(F.lit("name"), F.col("place_name")).alias("tags"))
    answers = p.groupBy("country_iso3").agg(F.to_json(F.struct(F.collect_list(element).alias("elements"))).alias("raw"))
    return answers.select(F.explode(files.overpass_features(F.col("raw"))).alias("x")).select("x.id", "x.name", F.round("x.lat", 5).alias("lat"), F.round("x.lon", 5).alias("lon"))


@query("SELECT country_iso3 AS qid, min(place_name) AS label, CAST(count(DISTINCT place_name) AS INTEGER) AS aliases, CAST(count(DISTINCT kind) AS INTEGER) AS commodities FROM place GROUP BY 1")
def knowledge_items(spark, d):
    p = table(spark, d, "place")
    bindings = p.select(F.col("country_iso3").alias("qid"), F.col("place_name").alias("label"), F.concat(F.lit("Point("), F.col("lon").cast("string"), F.lit(" "), F.col("lat").cast("string"), F.lit(")")).alias("coord"), F.col("place_name").alias("alias"), F.col("kind").alias("commodity"))
    return files.knowledge_items(bindings).select("qid", "label", F.size("aliases").alias("aliases"), F.size("commodities").alias("commodities"))


@query(f"SELECT facility_key, json_id, result_id FROM measurable_result QUALIFY {LATEST}")
def stream_latest(spark, d):
    """The latest accepted results, kept by a stream over the result files as they arrive."""
    name = "measurable_result.parquet"
    schema = spark.read.parquet(f"{d}/{name}").schema
    source = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    stream = source.parquet(f"{d}/{name}") if os.path.isdir(f"{d}/{name}") else source.option("pathGlobFilter", name).parquet(d)
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    columns = ["facility_key", "json_id", "as_of_date", "query_timestamp", "confidence", "result_id", "accepted"]
    run = results.latest_stream(stream.select(*columns), f"{at}/state", f"{at}/log")
    run.awaitTermination()
    last = run.lastProgress["batchId"]
    return results.latest_state(spark, f"{at}/state", last + 1).select("facility_key", "json_id", "result_id")


def _event_stream(spark, d):
    name = "events.parquet"
    schema = spark.read.parquet(f"{d}/{name}").schema
    source = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    rows = source.parquet(f"{d}/{name}") if os.path.isdir(f"{d}/{name}") else source.option("pathGlobFilter", name).parquet(d)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT event_type, count(DISTINCT event_id) AS events FROM events GROUP BY 1")
def stream_deduplicated(spark, d):
    """Events without repeats, read as a stream."""
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    once = results.deduplicated(_event_stream(spark, d).select("event_id", "event_type", "ts"), ["event_id"], "ts", "60 days")
    return results.written(once, f"{at}/rows", f"{at}/log").groupBy("event_type").agg(F.count("*").alias("events"))


@query("""WITH w AS (SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '2024-01-01 00:00:00') AS s, event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2)
 SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, event_type, n FROM w WHERE s + INTERVAL 6 HOURS <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def stream_windows(spark, d):
    """Events of closed windows of six hours, counted by a stream with a watermark of a day."""
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    counts = results.windowed_counts(_event_stream(spark, d).select("event_type", "ts"), "ts", "event_type", "6 hours")
    return results.written(counts, f"{at}/rows", f"{at}/log").select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")
