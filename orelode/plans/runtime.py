"""Session helpers shared by all operators: tables, lineage cuts and bounded broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``root`` (a file or a folder of parts)."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.  Where that is unset
    a temporary folder serves sessions on one machine; on a cluster it is an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not conf and sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        sc.setCheckpointDir(conf or tempfile.mkdtemp(prefix="orelode-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and drop its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def slots(spark: SparkSession) -> int:
    """How many tasks keep the session busy: its cores, or its shuffle partitions if those are more."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """``df`` in enough partitions for work that is heavy for its bytes.  A scan that has a
    partition for every core stays as it is, so large texts are never shuffled to balance tasks;
    only a scan of fewer partitions, which is small, is dealt out."""
    spark = df.sparkSession
    if df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(2 * slots(spark))


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; otherwise as it is, so that
    Spark plans a shuffled join."""
    if df.limit(rows + 1).count() <= rows:
        return F.broadcast(df)
    return df
