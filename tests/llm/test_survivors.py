import datetime as dt

from pyspark.sql import functions as F

from orelode.llm.survivors import facility_survivors, learnt_precedence, merged, parse_time

SCHEMA = "rec_id long, facility_id string, aliases array<string>, commodities array<struct<metal:string>>, company_mentions array<struct<name:string>>, sources array<struct<id:string>>, verification struct<status:string,confidence:double,last_checked:string>"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA).selectExpr("*", "'x' AS _key", "'y' AS field_name", "1 AS n")


def test_winners(spark):
    none = ([], [], [])
    data = [
        (1, "a", ["x", "y"], *none, ("csv_imported", 0.5, "2025-01-01T00:00:00Z")), (2, "a", ["z", "w", "v"], *none, ("human_verified", 0.9, "05 Feb 2025")), (3, "a", ["z", "w", "v"], *none, ("human_verified", 0.9, "05 Feb 2025")),
        (4, "b", ["TBD", " ", None], [("gold",)], [], None, ("llm_verified", None, None)), (5, "b", ["ok", "OK "], None, None, None, ("csv_imported", 0.1, None)), (6, "c", ["only"], *none, ("csv_imported", 0.1, None)),
        (7, None, ["q"], *none, None), (8, None, ["q"], *none, None), (9, "d", None, None, None, None, None), (10, "d", ["-"], [(None,)], [("n/a",)], [("",)], None), (11, "e", ["p", "q", "r"], *none, ("human_verified", 0.8, None)), (12, "e", ["p"], *none, ("csv_imported", 0.8, "2025-01-01")),
    ]
    got = {(r["facility_id"], r["field_name"]): r["rec_id"] for r in facility_survivors(rows(spark, data)).collect()}
    assert got == {("a", "aliases"): 2, ("b", "aliases"): 5, ("b", "commodities"): 4, ("e", "aliases"): 11}
    out = {r["facility_id"]: r["aliases"] for r in merged(rows(spark, data)).collect()}
    assert out["a"] == '["z","w","v"]' and out["c"] == '["only"]' and None not in out
    assert facility_survivors(rows(spark, [])).count() == 0


def test_times(spark):
    texts = ["30 Aug 2025", "2025-08-30T21:53:58.080228Z", "2025-10-03T22:37:22+03:00", "2025-02-18 09:09:28", "2025-11-19T20:50:51", "soon", "", None, "99 Foo 2025"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_time(F.col("t")).cast("string")).collect()]
    assert got == ["2025-08-30 00:00:00", "2025-08-30 21:53:58.080228", "2025-10-03 19:37:22", "2025-02-18 09:09:28", "2025-11-19 20:50:51", None, None, None, None]


def test_precedence_is_learnt(spark):
    t = lambda d: dt.datetime(2025, 1, d)
    data = [("a", "low", t(1)), ("a", "mid", t(2)), ("a", "high", t(3)), ("b", "low", t(5)), ("b", "high", t(9)), ("c", "mid", t(1)), ("c", "low", t(2)), ("d", "low", t(1)), ("d", "mid", t(4)), ("d", None, t(9)), (None, "low", t(1)), ("e", "high", None)]
    got = {r["level"]: r["rank"] for r in learnt_precedence(spark.createDataFrame(data, "k string, level string, t timestamp"), "k", "level", "t", ("low", "mid", "high")).collect()}
    assert got == {"low": 0, "mid": 1, "high": 2}


def test_learnt_precedence_decides_where_time_is_missing(spark):
    def won(first, then):
        """Whose aliases survive in groups with a missing time, where levels are seen in this order."""
        at = {first: "2025-01-01T00:00:00Z", then: "2025-03-01T00:00:00Z"}
        item = (["x"], [], [], [])
        data = [(1, "t", *item, ("csv_imported", 0.5, at["csv_imported"])), (2, "t", *item, ("human_verified", 0.5, at["human_verified"])), (3, "one", *item, ("csv_imported", 0.5, None)), (4, "one", *item, ("human_verified", 0.5, "2025-02-01T00:00:00Z")), (5, "none", *item, ("csv_imported", 0.5, None)), (6, "none", *item, ("human_verified", 0.5, None)), (7, "old", *item, ("csv_imported", 0.5, "2025-05-01T00:00:00Z")), (8, "old", *item, ("human_verified", 0.5, "2025-04-01T00:00:00Z")), (9, "old", *item, ("llm_verified", 0.1, None))]
        return {r["facility_id"]: r["rec_id"] for r in facility_survivors(rows(spark, data + [(n + 100, f"t{n // 2}", *item, ((first, then)[n % 2], 0.5, at[(first, then)[n % 2]])) for n in range(8)])).collect()}

    up, down = won("csv_imported", "human_verified"), won("human_verified", "csv_imported")
    assert (up["one"], up["none"]) == (4, 6) and (down["one"], down["none"]) == (3, 5)
    # time outranks precedence and trust; a level of which nothing is learnt precedes nothing
    assert up["old"] == down["old"] == 7 and (up["t"], down["t"]) == (2, 1)


def test_a_bare_date_is_a_whole_day(spark):
    item = (["x"], [], [], [])
    data = [(1, "a", *item, ("human_verified", 0.9, "05 Feb 2025")), (2, "a", *item, ("csv_imported", 0.5, "2025-02-05T09:00:00Z")), (3, "b", *item, ("human_verified", 0.9, "05 Feb 2025")), (4, "b", *item, ("csv_imported", 0.5, "2025-02-06T00:00:00Z"))]
    assert {r["facility_id"]: r["rec_id"] for r in facility_survivors(rows(spark, data)).collect()} == {"a": 1, "b": 4}


def test_one_group_of_many_rows(spark):
    df = spark.range(20_000).select(F.col("id").alias("rec_id"), F.lit("hot").alias("facility_id"), F.array(F.lit("a")).alias("aliases"), F.lit(None).cast("array<struct<metal:string>>").alias("commodities"), F.lit(None).cast("array<struct<name:string>>").alias("company_mentions"), F.lit(None).cast("array<struct<id:string>>").alias("sources"), F.struct(F.lit("csv_imported").alias("status"), (F.col("id") % 7 / 10).alias("confidence"), F.lit("2025-01-01").alias("last_checked")).alias("verification"))
    assert [r["rec_id"] for r in facility_survivors(df).collect()] == [6]
