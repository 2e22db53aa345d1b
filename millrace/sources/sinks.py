"""Where results go: JSON lines, splits, metrics, result tables and reports."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def as_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object for each row. mode append continues what is there."""
    df.select(as_json(df).alias("value")).write.mode(mode).text(path)


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder for each value of the split, in one job."""
    df.write.mode("overwrite").partitionBy(split).json(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """A small frame as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_results(df: DataFrame, path: str, kind: str = "results") -> str:
    """Add rows to a table of results below path; kinds of tables are kept apart. Returns the run's folder.

    A run is written aside and renamed into its place, so a reader sees all of it or
    nothing, and of two that end at once the second takes the next number.
    """
    spark = df.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    staged = jvm.Path(f"{path}/_staged/{uuid.uuid4().hex}")
    df.write.parquet(staged.toString())
    files.mkdirs(jvm.Path(path, kind))
    number = 1 + max((int(name.removeprefix("run-")) for name in _runs(spark, path, kind)), default=0)
    while True:
        at = jvm.Path(f"{path}/{kind}/run-{number:06d}")
        # a rename onto a folder that is there would move into it, so the name is claimed by creating a file, which fails for the second
        try:
            files.create(jvm.Path(f"{path}/_claimed/{kind}-{number:06d}"), False).close()
        except Py4JJavaError:
            number += 1
            continue
        if not files.rename(staged, at):
            raise OSError(f"can't move a run to {at.toString()}")
        return at.toString()


def _runs(spark: SparkSession, path: str, kind: str) -> list[str]:
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.globStatus(jvm.Path(f"{path}/{kind}/run-*")) or [])


def results(spark: SparkSession, path: str, kind: str = "results") -> DataFrame:
    """All rows of a table of results with the number of their run. Columns keep the order in which runs brought them; where a run lacks one, it is null."""
    runs = _runs(spark, path, kind)
    if not runs:
        return spark.createDataFrame([], "run int")
    columns = list(dict.fromkeys(c for r in runs for c in spark.read.parquet(f"{path}/{kind}/{r}").columns))
    rows = spark.read.option("mergeSchema", "true").parquet(*(f"{path}/{kind}/{r}" for r in runs))
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/run-(\d+)/[^/]*$", 1).cast("int")
    return rows.select(number.alias("run"), *columns)


def markdown(df: DataFrame) -> DataFrame:
    """Rows of a Markdown table, with a column `line` (the header has line_no 0)."""
    head = "| " + " | ".join(df.columns) + " |"
    rule = "|" + "---|" * len(df.columns)
    body = df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns)), F.lit(" |")).alias("line"))
    return df.sparkSession.createDataFrame([(0, head), (1, rule)], "line_no int, line string").unionByName(body.select(F.lit(2).alias("line_no"), "line"))


def write_report(df: DataFrame, line: Column, path: str) -> None:
    """One line of text for each row."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def concatenate(frames: list[DataFrame], path: str) -> None:
    """Raw lines of several text frames, unparsed."""
    out = frames[0].select("value")
    for f in frames[1:]:
        out = out.unionByName(f.select("value"))
    out.write.mode("overwrite").text(path)


def mark_done(spark: SparkSession, path: str, status: str = "done") -> None:
    """A sentinel: one small file below path that says what state a step ended in. Written by the driver, once the step's job has ended."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path, f"STATUS.{status}")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True).close()


def is_done(spark: SparkSession, path: str, status: str = "done") -> bool:
    """Whether the sentinel is there; a folder that a Spark job has written whole (`_SUCCESS`) is done, too."""
    jvm = spark._jvm.org.apache.hadoop.fs
    names = [f"STATUS.{status}", *(["_SUCCESS"] if status == "done" else [])]
    files = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return any(files.exists(jvm.Path(path, n)) for n in names)


def wait_done(spark: SparkSession, path: str, seconds: float, every: float = 1.0) -> bool:
    """Poll for the sentinel until it is there or the time is up."""
    end = time.monotonic() + seconds
    while not (found := is_done(spark, path)) and time.monotonic() < end:
        time.sleep(min(every, max(0.0, end - time.monotonic())))
    return found


def stamped(df: DataFrame, stamp: str) -> DataFrame:
    """df with the date that the caller gives for a run: nothing here reads a clock."""
    return df.withColumn("stamp", F.to_date(F.lit(stamp)))
