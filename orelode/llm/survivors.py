"""Best value of each field within groups of duplicate records, by currency reasoning.

What came later is learnt from rows with timestamps: for every pair of trust levels, in how many
groups the one was seen before the other.  Within a group, the rows with an item of a field are
partially ordered: by time where both have one, else by the learnt precedence of their levels.
Time is certain and precedence is not, so a row that time shows to be outdated is out first; what
is left has no cycles, and the rows that no other precedes are topologically the latest.  Among
several of these trust, confidence and usable content decide.

All of it is aggregation: whether a row is preceded depends only on the group's latest time and
greatest ranks, so a group of any size needs no window, and no list beyond one entry for each rank.

Defined results: groups of one row, rows without a key or an id and fields no row has a usable item of
give no row.  Items that are null, blank or placeholders do not count, repeated items (ignoring
case and blanks) count once.  Among equal rows the least id survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Trust of verification levels, from the highest; fixed by the data's documentation.
TRUST = ("human_verified", "csv_imported", "web_search_geocoded", "llm_verified")
PLACEHOLDERS = ("", "-", "--", "n/a", "na", "none", "null", "tbd", "tba", "unknown", "nan", "?", "not available", "see remarks", "various")
#: The text that identifies an item, by list field.
ITEM = {"aliases": None, "commodities": "metal", "company_mentions": "name", "sources": "id"}


def parse_time(text: Column) -> Column:
    """A time in ISO notation with or without a zone (then UTC) or as "30 Aug 2025"; else null."""
    t = F.trim(text)
    iso = F.when(t.rlike(r"^\d{4}-\d\d-\d\d"), F.try_to_timestamp(t))
    zoned = F.when(t.rlike(r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d(?:\.\d+)?$"), F.try_to_timestamp(F.concat(t, F.lit("Z"))))
    return F.coalesce(zoned, iso, F.when(t.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4}$"), F.try_to_timestamp(t, F.lit("d MMM yyyy"))))


def parse_until(text: Column) -> Column:
    """The last moment that :func:`parse_time` may stand for: the end of the day of a bare date."""
    t = F.trim(text)
    start = parse_time(text)
    return F.when(t.rlike(r"^(?:\d{4}-\d\d-\d\d|\d{1,2} [A-Za-z]{3} \d{4})$"), start + F.expr("interval 1 day") - F.expr("interval 1 microsecond")).otherwise(start)


def usable_items(items: Column, part: str | None) -> Column:
    """The distinct usable items of a list, as folded text."""
    texts = items if part is None else F.transform(items, lambda x: x[part])
    folded = F.transform(texts, lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " "))))
    return F.array_distinct(F.filter(folded, lambda x: x.isNotNull() & ~x.isin(*PLACEHOLDERS)))


def learnt_precedence(rows: DataFrame, key: str, level: str, time: str, levels: tuple[str, ...] = TRUST, until: str | None = None) -> DataFrame:
    """``level`` and ``rank`` (higher is later) of every level, from rows with times.

    A level precedes another in a group if its last time there is before the other's first.  The
    rank is the number of levels that precede it more often than they follow.  Only ``levels``
    count, so a group has at most one entry for each and the result one row for each.
    """
    seen = rows.where(F.col(time).isNotNull() & F.col(level).isin(*levels) & F.col(key).isNotNull()).groupBy(key, level).agg(F.min(time).alias("first"), F.max(until or time).alias("last"))
    by_level = seen.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(level, F.struct("first", "last")))).alias("m")).where(F.size("m") > 1)
    ends = by_level.select(F.explode(F.map_entries("m")).alias("a"), "m").select("a", F.explode(F.map_entries("m")).alias("b")).where("a.key <> b.key")
    votes = ends.groupBy(F.col("a.key").alias("x"), F.col("b.key").alias("y")).agg((F.count_if(F.col("a.value.last") < F.col("b.value.first")) - F.count_if(F.col("b.value.last") < F.col("a.value.first"))).alias("v"))
    return votes.groupBy(F.col("y").alias(level)).agg(F.count_if(F.col("v") > 0).alias("rank"))


def survivors(df: DataFrame, key: str, row_id: str, time: Column, level: Column, confidence: Column, fields: dict[str, str | None] = ITEM, trust: tuple[str, ...] = TRUST, until: Column | None = None) -> DataFrame:
    """``key``, ``field_name`` and ``row_id`` of the row whose value survives, for each group of two
    or more rows and each field with a usable item.  ``until`` is the end of times that are spans."""
    grade = F.when(level == trust[0], len(trust))
    for i, name in enumerate(trust[1:], 1):
        grade = grade.when(level == name, len(trust) - i)
    sizes = [F.struct(F.lit(f).alias("field_name"), F.size(usable_items(F.col(f), part)).alias("n")) for f, part in fields.items()]
    base = df.where(F.col(key).isNotNull() & F.col(row_id).isNotNull()).select(
        F.col(key).alias("_key"), F.col(row_id).alias("_id"), time.alias("_time"), (time if until is None else until).alias("_until"), level.alias("_level"), grade.cast("int").alias("_trust"), confidence.alias("_conf"),
        F.filter(F.array(*sizes), lambda s: s["n"] > 0).alias("_sizes"),
    )
    order = learnt_precedence(base, "_key", "_level", "_time", trust, "_until").withColumnRenamed("rank", "_rank")
    many = base.groupBy("_key").agg(F.count("*").alias("_rows")).where("_rows > 1").select("_key")
    items = base.join(many, "_key").join(F.broadcast(order), "_level", "left").select("_key", "_id", "_time", "_until", "_trust", "_rank", "_conf", F.explode("_sizes").alias("s"))
    items = items.select("_key", "s.field_name", "_id", "_time", "_until", "_rank", F.struct(F.col("_trust").alias("trust"), F.col("_conf").alias("conf"), F.col("s.n").alias("fill"), (-F.col("_id")).alias("least"), F.col("_id").alias("id")).alias("_best"))
    group = ["_key", "field_name"]
    latest = items.groupBy(*group).agg(F.max("_time").alias("_latest"))
    current = items.join(latest, group).where("_time is null or _until >= _latest").withColumn("_timed", F.col("_time").isNotNull())
    # the best of each rank, with and without a time; ranks are as few as levels
    kinds = current.groupBy(*group, "_rank", "_timed").agg(F.max("_best").alias("_best"))
    whole = kinds.groupBy(*group).agg(F.max("_rank").alias("_top"), F.max(F.when(~F.col("_timed"), F.col("_rank"))).alias("_top_untimed"), F.collect_list(F.struct("_rank", "_timed", "_best")).alias("_kinds"))
    # rows with a time are not ranked among each other; a level of which nothing is learnt neither
    last = F.filter("_kinds", lambda k: F.coalesce(k["_rank"] >= F.when(k["_timed"], F.col("_top_untimed")).otherwise(F.col("_top")), F.lit(True)))
    return whole.select(F.col("_key").alias(key), "field_name", F.array_max(F.transform(last, lambda k: k["_best"]))["id"].alias(row_id))


def facility_survivors(facility: DataFrame) -> DataFrame:
    """:func:`survivors` of the facility table."""
    v = F.col("verification")
    return survivors(facility, "facility_id", "rec_id", parse_time(v["last_checked"]), v["status"], v["confidence"], until=parse_until(v["last_checked"]))


def merged(facility: DataFrame) -> DataFrame:
    """One record per facility_id: of groups, the surviving aliases, commodities, mentions and
    sources; of single rows their own.  Keys that are null are left out."""
    won = facility_survivors(facility)
    lists = list(ITEM)
    values = won.join(facility.select("rec_id", *lists), "rec_id")
    picked = values.groupBy("facility_id").agg(*(F.max(F.when(F.col("field_name") == f, F.struct(F.lit(1).alias("one"), F.to_json(f).alias("v")))).alias(f"_{f}") for f in lists))
    base = facility.where("facility_id is not null").groupBy("facility_id").agg(F.min("rec_id").alias("rec_id"), F.count("*").alias("n_rows"), *(F.min(F.to_json(f)).alias(f) for f in lists))
    return base.join(picked, "facility_id", "left").select("facility_id", "n_rows", *(F.when(F.col("n_rows") == 1, F.col(f)).otherwise(F.col(f"_{f}.v")).alias(f) for f in lists))
