"""Positions from several sources: name scores, precision, gates, cached answers and statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orelode.functions.text import bearing, destination, lookup, matchable, token_sort_ratio, word_overlap
from orelode.operators.dedupe import SUBSETS, subsets
from orelode.operators.quality import write_gate
from orelode.plans.runtime import bounded, cut

# How far a source is trusted.
SOURCE_SCORES = {"cadastre": 0.95, "ni43101": 0.95, "mindat": 0.85, "wikidata": 0.85, "overpass": 0.75, "nominatim": 0.60}
# Industrial zones of one country as (lat, lon, town), in the order they are tried; a
# zone without a town lets the search go on.
ZONE_COUNTRY = "ARE"
ZONES = ((24.086, 52.541, "Abu Dhabi"), (25.012, 55.106, "Dubai"), (24.994, 55.149, "Dubai"), (24.228, 55.732, "Al Ain"), (24.354, 54.512, None))


def match_score(name: Column, target: Column, aliases: Column, similar: bool = True) -> Column:
    """1 for names equal once made matchable, also by an alias of the target; else the greatest
    share of common words or, with ``similar``, the similarity of the sorted words with the target."""
    others = F.concat(F.array(target), F.coalesce(aliases, F.array().cast("array<string>")))
    others = F.filter(F.transform(others, matchable), lambda x: F.coalesce(x, F.lit("")) != "")
    own = matchable(name)
    overlap = F.coalesce(F.array_max(F.transform(others, lambda o: word_overlap(own, o))), F.lit(0.0))
    best = F.greatest(overlap, token_sort_ratio(own, matchable(target))) if similar else overlap
    return F.when(F.coalesce(own, F.lit("")) == "", 0.0).when(F.array_contains(others, own), 1.0).otherwise(best)


def precision(source: Column, kind: Column) -> Column:
    """site, city, region or country, by the source and the kind of what it found."""
    low = F.lower(F.coalesce(kind, F.lit("")))
    return (
        F.when(source.isin("cadastre", "ni43101", "mindat"), "site")
        .when(source == "overpass", F.when(low.isin("mineshaft", "adit", "quarry"), "site").otherwise("region"))
        .when(source == "wikidata", F.when(low.contains("mine"), "site").otherwise("region"))
        .when(source == "nominatim", F.when(low.isin("industrial", "factory", "commercial"), "site").when(low.isin("city", "town", "village"), "city").when(low.isin("state", "region"), "region").otherwise("country"))
        .otherwise("region")
    )


def candidates(records: DataFrame, sources: list[DataFrame], least: float = 0.6, similar: bool = False) -> DataFrame:
    """For each record (rec_id, name, country) the best of all sources' entries of its country:
    ``source``, ``source_id``, ``lat``, ``lon``, ``precision``, ``confidence`` (0.6 the source, 0.4 the
    name) of at least ``least``; ties to the least source and id.

    Sources have source, source_id, name, aliases, country, kind, lat, lon and are united.  Without
    common words no source reaches 0.6.  Only words that a country has on both sides count, and
    without ``similar`` no pairs are made: names with the same of these words are one, entries are
    listed by the sets of them, of each set the least entry, and names look their sets up.  A set
    smaller than what two names share scores less than the whole of it, so it changes no maximum.
    Names of more than ``SUBSETS`` such words, and with ``similar`` all, are paired by their words.
    """
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    every = every.where("lat is not null and lon is not null")
    none = F.array().cast("array<string>")
    words = lambda c: F.array_sort(F.array_distinct(F.filter(F.split(matchable(c), " "), lambda w: w != "")))
    trust = F.coalesce(lookup(F.col("source"), {k: str(v) for k, v in SOURCE_SCORES.items()}).cast("double"), F.lit(0.5))
    sure = lambda score: F.round(0.6 * trust + 0.4 * score, 4)
    entry = ["source", "source_id", "lat", "lon", "kind"]
    own = records.where("country is not null").select("country", "rec_id", F.col("name").alias("own"), words(F.col("name")).alias("a"))
    if similar:
        entry_words = F.array_distinct(F.flatten(F.transform(F.concat(F.array("name"), F.coalesce("aliases", none)), lambda x: F.coalesce(words(x), none))))
        entries = every.select("country", F.explode(entry_words).alias("w"), F.struct("source", "source_id", "name", "aliases", "kind", "lat", "lon").alias("e"))
        met = own.select("country", "rec_id", "own", F.explode("a").alias("w")).join(entries, ["country", "w"]).select("rec_id", "own", "e").dropDuplicates(["rec_id", "e"]).select("rec_id", "own", "e.*")
        met = met.withColumn("confidence", sure(match_score(F.col("own"), F.col("name"), F.col("aliases"), True))).where(F.col("confidence") >= least)
        best = met.groupBy("rec_id").agg(F.min(F.struct((-F.col("confidence")).alias("c"), *entry)).alias("b"))
    else:
        names = every.where("country is not null").select("country", *entry, F.explode(F.concat(F.array("name"), F.coalesce("aliases", none))).alias("x")).select("country", *entry, words(F.col("x")).alias("a"))
        least_entry = F.min(F.struct(*entry)).alias("e")
        # words are made once: the entries of a country with the same words are one of each source
        theirs, mine = cut(names.groupBy("country", "a", "source").agg(least_entry)), cut(own.select("country", "a").distinct())
        words_of = lambda d: d.select("country", F.explode("a").alias("w")).distinct()
        both = cut(words_of(mine).join(words_of(theirs), ["country", "w"]))

        def held(d: DataFrame) -> DataFrame:
            """Distinct ``a`` with ``n``, the number of words, and ``h``, those of both sides."""
            rows = d.select("country", "a").distinct().select("country", "a", F.explode("a").alias("w")).join(both, ["country", "w"])
            return rows.groupBy("country", "a").agg(F.array_sort(F.collect_list("w")).alias("h")).withColumn("n", F.size("a"))

        left = held(mine)
        right = theirs.join(held(theirs), ["country", "a"]).groupBy("country", "h", F.col("n").alias("m"), "source").agg(F.min("e").alias("e"))
        tops = left.select("country", "h", "n").distinct()
        any_ = lambda o, n: o > 0
        sets = lambda d: d.where(F.size("h") <= SUBSETS).withColumn("s", F.explode(subsets(F.col("h"), any_)))
        looked = sets(tops).join(sets(right).groupBy("country", "s", "m", "source").agg(F.min("e").alias("e")), ["country", "s"]).select("country", "h", "n", "m", "e", F.size("s").alias("o"))
        for x, y in ((F.size("h") > SUBSETS, F.lit(True)), (F.size("h") <= SUBSETS, F.size("h") > SUBSETS)):
            one, two = tops.where(x), right.where(y).withColumnRenamed("h", "g")
            met = one.withColumn("w", F.explode("h")).join(two.withColumn("w", F.explode("g")), ["country", "w"])
            looked = looked.unionByName(met.select("country", "h", "n", "m", "e", F.size(F.array_intersect("h", "g")).alias("o")))
        met = looked.select("country", "h", "n", "e.*", (F.col("o") / F.least("n", "m")).alias("score"))
        met = met.withColumn("confidence", sure(F.col("score"))).where(F.col("confidence") >= least)
        top = met.groupBy("country", "h", "n").agg(F.min(F.struct((-F.col("confidence")).alias("c"), *entry)).alias("b"))
        best = own.join(left.select("country", "a", "h", "n"), ["country", "a"]).join(top, ["country", "h", "n"]).groupBy("rec_id").agg(F.min("b").alias("b"))
    return best.select("rec_id", "b.source", "b.source_id", "b.lat", "b.lon", precision(F.col("b.source"), F.col("b.kind")).alias("precision"), (-F.col("b.c")).alias("confidence"))


def geocoded(facility: DataFrame, found: DataFrame) -> DataFrame:
    """``rec_id``, ``country_iso3``, ``status`` and the new ``lat``, ``lon``: records without a position
    take the candidate's if the gate for writing accepts it (``updated``); one it refuses is
    ``failed``, one without a candidate ``skipped``.  Records with a position do not occur."""
    todo = facility.where("location.lat is null or location.lon is null").select("rec_id", "country_iso3").join(found, "rec_id", "left")
    gate = write_gate(F.col("lat"), F.col("lon"), F.col("country_iso3"))
    status = F.when(F.col("lat").isNull(), "skipped").when(gate == "accept", "updated").otherwise("failed")
    rows = todo.withColumn("status", status)
    kept = lambda c: F.when(F.col("status") == "updated", F.col(c)).alias(c)
    return rows.select("rec_id", "country_iso3", "status", kept("lat"), kept("lon"))


def backfill_stats(rows: DataFrame, by: str) -> DataFrame:
    """Processed, updated, skipped and failed rows and the success rate, by ``by``."""
    count = lambda s: F.count_if(F.col("status") == s)
    return rows.groupBy(by).agg(F.count("*").alias("processed"), *(count(s).alias(s) for s in ("updated", "skipped", "failed")), F.round(100.0 * count("updated") / F.count("*"), 1).alias("success_rate"))


def query_key(name: Column, country: Column, commodities: Column) -> Column:
    """The cache key of a query: name, country and sorted commodities, lower case, _ for blanks."""
    parts = F.array_join(F.array_sort(F.filter(F.coalesce(commodities, F.array().cast("array<string>")), lambda x: x.isNotNull())), "_")
    return F.regexp_replace(F.lower(F.concat_ws("_", F.coalesce(name, F.lit("")), F.coalesce(country, F.lit("")), parts)), " ", "_")


def answered(queries: DataFrame, cache: DataFrame, now: Column, ttl_days: int = 365) -> DataFrame:
    """Queries (key) with ``outcome``: ``hit`` with the cached position, ``negative`` where it is
    cached that nothing was found, ``miss`` where nothing or only something expired is cached.  Of
    several entries of a key the latest counts."""
    live = cache.where(F.col("ts") > now - F.expr(f"INTERVAL {ttl_days} DAYS")).groupBy("key").agg(F.max_by(F.struct("lat", "lon"), "ts").alias("p"))
    outcome = F.when(F.col("p").isNull(), "miss").when(F.col("p.lat").isNull(), "negative").otherwise("hit")
    return queries.join(live, "key", "left").select(*queries.columns, F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"), outcome.alias("outcome"))


def pruned(cache: DataFrame, now: Column, ttl_days: int = 365) -> DataFrame:
    """The entries of a cache that are not expired; those without a readable time are."""
    return cache.where(F.col("ts") > now - F.expr(f"INTERVAL {ttl_days} DAYS"))


def answer_position(raw: Column) -> Column:
    """struct<lat, lon> of a JSON answer: the coordinates it states, else what lies ``distance_km``
    toward ``direction`` (one of sixteen winds) of its reference point; null if it found nothing."""
    got = F.from_json(raw, "found boolean, lat double, lon double, ref_lat double, ref_lon double, distance_km double, direction string")
    direct = F.when(got["lat"].isNotNull() & got["lon"].isNotNull(), F.struct(got["lat"].alias("lat"), got["lon"].alias("lon")))
    moved = destination(got["ref_lat"], got["ref_lon"], got["distance_km"], bearing(got["direction"]))
    whole = got["ref_lat"].isNotNull() & got["ref_lon"].isNotNull() & got["distance_km"].isNotNull() & got["direction"].isNotNull()
    return F.when(F.coalesce(got["found"], F.lit(False)), F.coalesce(direct, F.when(whole, moved)))


def zone_town(lat: Column, lon: Column, country: Column, within: float = 0.05) -> Column:
    """The town of the first industrial zone nearer than ``within`` degrees, null if none is."""
    near = [F.when(F.sqrt((lat - a) * (lat - a) + (lon - o) * (lon - o)) < within, town) for a, o, town in ZONES if town]
    return F.when(country == ZONE_COUNTRY, F.coalesce(*near))


def town_of(name_town: Column, zone_town: Column, cached_town: Column) -> Column:
    """The town from the name, else of the zone, else cached; blank ones do not count."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(some(name_town), some(zone_town), some(cached_town))


# Resource tags of maps for symbols and compound names.
OSM_TAGS = {"cu": "copper", "au": "gold", "u": "uranium", "iron ore": "iron_ore", "fe": "iron", "pt": "platinum", "li": "lithium", "ni": "nickel", "zn": "zinc", "pb": "lead", "ag": "silver"}


def resource_tag(resource: Column) -> Column:
    """The tag of a resource: symbols spelled out, other names lower case with _ for blanks."""
    low = F.lower(F.trim(resource))
    return F.coalesce(lookup(low, OSM_TAGS), F.replace(low, F.lit(" "), F.lit("_")))


def name_pattern(name: Column) -> Column:
    """A pattern for the words of a name in order, whatever stands between them."""
    words = F.filter(F.split(F.lower(name), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.regexp_replace(w, r"([^a-z0-9_])", r"\\$1")), ".*")


def feature_query(iso2: Column, resource: Column, name: Column) -> Column:
    """Text of a map query for mining features of a country, by resource tag and name pattern; blank
    parts are left out."""
    clause = lambda key, value, end: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f'["{key}"~"'), value, F.lit(end))).otherwise("")
    return F.concat(
        F.lit('[out:json];area["ISO3166-1"="'), F.upper(iso2), F.lit('"]->.searchArea;nwr'), clause("resource", resource_tag(resource), '"]'), clause("name", name_pattern(name), '",i]'), F.lit("(area.searchArea);out center tags;")
    )


def source_table(df: DataFrame, source: str, id_: Column, name: Column, country: Column, kind: Column, lat: Column, lon: Column, aliases: Column | None = None) -> DataFrame:
    """A table in the shape :func:`candidates` takes."""
    none = F.lit(None).cast("array<string>")
    return df.select(F.lit(source).alias("source"), id_.cast("string").alias("source_id"), name.alias("name"), (none if aliases is None else aliases).alias("aliases"), country.alias("country"), kind.alias("kind"), lat.alias("lat"), lon.alias("lon"))


def with_country(df: DataFrame, codes: DataFrame, column: str = "country_iso3") -> DataFrame:
    """``df`` with ``country``, the code any notation in ``column`` means (notation, meant)."""
    return df.withColumn("_n", F.lower(F.trim(column))).join(bounded(codes, 10_000).withColumnRenamed("notation", "_n"), "_n", "left").withColumn("country", F.col("meant")).drop("_n", "meant")
