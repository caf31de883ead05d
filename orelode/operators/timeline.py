"""Results over time: upserts, reference audits, tag routing, runs and name history."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orelode.plans.runtime import cut


def latest_results(results: DataFrame) -> DataFrame:
    """Adds ``is_latest``: per facility and question the accepted result with the greatest day,
    query time, confidence (nulls first) and id; results not accepted are never the latest."""
    marked = latest_keys(results).select("result_id", F.lit(True).alias("is_latest"))
    return results.join(marked, "result_id", "left").withColumn("is_latest", F.coalesce("is_latest", F.lit(False)))


def latest_keys(results: DataFrame) -> DataFrame:
    """The ids :func:`latest_results` would mark, as an aggregate: a hot facility needs no sort."""
    first = lambda c: F.struct(F.col(c).isNull(), F.col(c))
    order = F.struct(*(first(c) for c in ("as_of_date", "query_timestamp", "confidence", "result_id")))
    return results.where("accepted").groupBy("facility_key", "json_id").agg(F.max_by("result_id", order).alias("result_id"))


def upsert(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """MERGE: source rows replace or join target rows by key; keys are unique on both sides."""
    t, s = target.select(key, *columns).alias("t"), source.select(key, *columns).alias("s")
    hit = F.col(f"s.{key}").isNotNull()
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full").select(F.coalesce(f"s.{key}", f"t.{key}").alias(key), *(F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns))


def skip_existing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The target and those source rows whose key it lacks."""
    return target.unionByName(source.join(target.select(key), key, "left_anti"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null child keys without a parent."""
    return child.where(F.col(key).isNotNull()).select(F.col(key)).distinct().join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def routed(facility: DataFrame, measurable: DataFrame, id_: str = "rec_id") -> DataFrame:
    """``id_``, ``json_id``: questions whose tags fit a facility.  Tags of one namespace are
    alternatives, namespaces must all fit, ``facility:all`` fits any, unknown namespaces do not bind.

    Records with equal features are matched once.  Features and tags meet as tokens by
    equality, and a question fits if a token of each of its namespaces was met.
    """
    tags = measurable.select("json_id", F.explode("applicability_tags").alias("tag")).select("json_id", F.substring_index("tag", ":", 1).alias("ns"), F.substring_index("tag", ":", -1).alias("value"))
    bound = tags.where("ns in ('facility', 'country', 'status')").distinct()
    need = bound.groupBy("json_id").agg(F.countDistinct("ns").alias("n"))
    free = measurable.select("json_id").join(need, "json_id", "left_anti").select("json_id", F.lit("any").alias("ns"), F.lit("any").alias("value"), F.lit(1).cast("long").alias("n"))
    asked = bound.join(need, "json_id").select("json_id", "ns", "value", "n").unionByName(free)
    kind = F.xxhash64("types", "country", "state")
    feats = facility.select(F.transform("types", lambda t: F.lower(t)).alias("types"), F.upper(F.trim("country_iso3")).alias("country"), F.lower("status").alias("state"), F.col(id_)).withColumn("kind", kind)
    token = lambda ns, v: F.struct(F.lit(ns).alias("ns"), v.alias("value"))
    own = F.transform(F.coalesce("types", F.array().cast("array<string>")), lambda t: token("facility", t))
    every = F.array(token("any", F.lit("any")), token("facility", F.lit("all")), token("country", F.col("country")), token("status", F.col("state")))
    tokens = feats.select("kind", "types", "country", "state").dropDuplicates(["kind"]).select("kind", F.explode(F.concat(every, own)).alias("t")).select("kind", "t.ns", "t.value").distinct()
    fits = tokens.join(asked, ["ns", "value"]).groupBy("kind", "json_id").agg(F.countDistinct("ns").alias("met"), F.first("n").alias("n")).where("met = n").select("kind", "json_id")
    return feats.select("kind", id_).join(fits, "kind").select(id_, "json_id")


def run_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("run_id").agg(
        F.count("*").alias("attempted"), F.count_if(F.coalesce("accepted", F.lit(False))).alias("accepted"), F.count_if(F.coalesce("provisional", F.lit(False))).alias("provisional"), F.round(F.avg("freshness_days"), 4).alias("avg_freshness"), F.countDistinct("facility_key").alias("sites")
    )


def changes(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """One row a change of ``value`` along ``order`` within ``key``, with the ``previous`` value.

    Rows are range-partitioned by key and order together, so a hot key spreads over tasks; what
    precedes each partition's first row comes from a table of one row a partition.
    """
    cols = list(dict.fromkeys([key, *order]))
    rows = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(*cols, F.col(value).alias("value"))
    rows = cut(rows.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_part", F.spark_partition_id()))
    ends = rows.groupBy("_part").agg(F.max(F.struct(*cols, "value")).alias("e")).select("_part", F.col(f"e.{key}").alias("k"), "e.value").collect()
    ends = sorted((r["_part"], r["k"], r["value"]) for r in ends)
    before = {p: (k, v) for (_, k, v), (p, _, _) in zip(ends, ends[1:])}
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in cols) + f", value {kinds[value]}, previous {kinds[value]}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for b in batches:
            if not len(b):
                continue
            if last is None:
                last = before.get(int(b["_part"].iloc[0]), (None, None))
            keys = [last[0], *b[key]]
            values = [last[1], *b["value"]]
            last = (keys[-1], values[-1])
            b = b.assign(previous=[v if k == now else None for k, v, now in zip(keys, values, b[key])])
            yield b.loc[[p is None or p != v for p, v in zip(b["previous"], b["value"])], [*cols, "value", "previous"]]

    return rows.mapInPandas(run, schema)


def gate(confidence: Column, accept: float, review: float) -> Column:
    return F.when(confidence >= accept, "auto_accept").when(confidence >= review, "review").otherwise("pending")
