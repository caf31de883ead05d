"""Results as a stream: the latest accepted row per key, and events without repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orelode.operators.timeline import latest_keys


def latest_stream(stream: DataFrame, target: str, checkpoint: str, buckets: int = 64):
    """Starts a query that keeps ``target`` at the latest accepted results seen so far.

    The state is split into ``buckets`` by key; a batch reads and writes only the buckets it
    touches, as a version of its own number, so a batch that is replayed writes the same again.
    """
    bucket = F.pmod(F.xxhash64("facility_key", "json_id"), F.lit(buckets)).cast("int")

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("bucket", bucket)
        # at most ``buckets`` numbers
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
        if batch_id:
            new = new.unionByName(latest_state(spark, target, batch_id).where(F.col("bucket").isin(touched)))
        kept = new.join(latest_keys(new).select("result_id"), "result_id", "left_semi").dropDuplicates(["result_id"])
        kept.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v={batch_id}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_state(spark: SparkSession, target: str, before: int) -> DataFrame:
    """The state before batch ``before``: the newest version of each bucket."""
    rows = spark.read.option("basePath", target).parquet(target).where(F.col("v") < before)
    newest = rows.groupBy("bucket").agg(F.max("v").alias("v"))
    return rows.join(F.broadcast(newest), ["bucket", "v"], "left_semi").drop("v")


def written(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """What a stream appends to ``target`` (parquet) until its source is read, as a table."""
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(target)


def deduplicated(stream: DataFrame, keys: list[str], time: str, late: str = "1 day") -> DataFrame:
    """Events without repeats of ``keys`` within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, key: str, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events by window of ``size`` and ``key``; a window comes out once the watermark has passed it."""
    counted = stream.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")
