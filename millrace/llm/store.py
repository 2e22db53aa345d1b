"""Where operators cut their lineage, and how they size their work."""

from __future__ import annotations

import math
import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


#: Keys that hold at least one of so many rows are hot: there are at most so many of them.
HOT = 1000


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where it is unset, one is made for a local master, as in tests; on a cluster
    that is an error, since executors would write where nobody else reads.
    """
    context = spark.sparkContext
    given = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if given:
        return given
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df once to the shared checkpoint folder, and read it from there."""
    folder(df.sparkSession)
    return df.checkpoint()


def attach(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int, own: Column) -> DataFrame:
    """rows left-joined with table, which has one row for each key and how many of the `total` rows hold it (weight).

    At most HOT keys hold a HOT-th of all rows each; these are broadcast, so no
    task gets all rows of a hot key. The others are joined by a shuffle, in which
    rows without a key, or with a hot one, go by a key of their own (`own`: of the
    key's type, equal to no key).
    """
    names = [c for c in table.columns if c != key]
    hot = table.where(F.col(weight) * HOT >= max(1, total)).select(key, *(F.col(c).alias(f"_hot_{c}") for c in names), F.lit(True).alias("_is_hot"))
    cold = table.where(F.col(weight) * HOT < max(1, total)).withColumnRenamed(key, "_key_of")
    found = rows.join(F.broadcast(hot), key, "left")
    found = found.withColumn("_key_of", F.when(F.col("_is_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(own))
    found = found.join(cold, "_key_of", "left")
    return found.select(*rows.columns, *(F.when(F.col("_is_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in names))


def discard(df: DataFrame) -> None:
    """Delete what cut() wrote for df, when all that was made of it has been cut itself.

    Nothing may read df afterwards. A frame that no cut() made is left alone.
    """
    plan = df._jdf.queryExecution().logical()
    if plan.getClass().getSimpleName() != "LogicalRDD":
        return
    file = plan.rdd().getCheckpointFile()
    if file.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that was written by name."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def parts_for(df: DataFrame, each: int = 8 << 20, least: int = 8, most: int = 1 << 20) -> int:
    """How many groups to deal keys of df (with text) into, in proportion to its bytes: as Spark estimates them, else counted."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 60:
        size = df.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return min(most, max(least, math.ceil(size / each)))
