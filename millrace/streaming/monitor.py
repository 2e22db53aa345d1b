"""Progress of growing sets: a stall monitor as batch windows and as a stateful stream, and gated appends."""

from __future__ import annotations

import functools
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

_STORE = "spark.sql.streaming.stateStore.providerClass"
STATUS = "key string, sample timestamp, total long, flat long, status string"


def samples(events: DataFrame, time: str = "ts", every: str = "15 minutes") -> DataFrame:
    """(sample, total): a running total at the end of each window from first to last event, windows without events included."""
    counts = events.groupBy(F.window(time, every).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("sample"), "n")
    ends = counts.agg(F.min("sample").alias("a"), F.max("sample").alias("b"))
    all_ = ends.where("a IS NOT NULL").select(F.explode(F.sequence("a", "b", F.expr(f"interval {every}"))).alias("sample"))
    full = all_.join(counts, "sample", "left")
    # one row for each window of the period: bounded by time, not by the number of events
    return full.select("sample", F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("sample")).alias("total"))


def stalls(totals: DataFrame, target: int, limit: int = 2) -> DataFrame:
    """totals (sample, total) with flat (samples in a row without growth) and status: done, stalled or ok. A decrease counts as flat."""
    order = Window.orderBy("sample")
    grew = F.coalesce(F.col("total") > F.lag("total").over(order), F.lit(True))
    runs = totals.withColumn("_grew", grew).withColumn("_run", F.sum(F.col("_grew").cast("long")).over(order))
    flat = F.row_number().over(Window.partitionBy("_run").orderBy("sample")) - 1
    return runs.withColumn("flat", flat.cast("long")).select("sample", "total", "flat", F.when(F.col("total") >= target, "done").when(F.col("flat") >= limit, "stalled").otherwise("ok").alias("status"))


def watch(totals: DataFrame, target: int, limit: int = 2) -> DataFrame:
    """A stream (key, sample, total) as a stream of STATUS rows; state is the last total and the flat count of each key."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, flat = state.get if state.exists else (-1, 0)
        rows = pd.concat(list(frames)).sort_values("sample")
        out = []
        for sample, total in zip(rows["sample"], rows["total"], strict=True):
            flat = flat + 1 if total <= last else 0
            last = int(total)
            out.append((key[0], sample, last, flat, "done" if last >= target else "stalled" if flat >= limit else "ok"))
        state.update((last, flat))
        yield pd.DataFrame(out, columns=["key", "sample", "total", "flat", "status"])

    return totals.groupBy("key").applyInPandasWithState(step, STATUS, "last long, flat long", "append", GroupStateTimeout.NoTimeout)


def gated_append(lines: DataFrame, gate, path: str, checkpoint: str, target: int | None = None, seconds: float | None = None):
    """A stream of rows whose gate holds, appended as JSON and resumed from the checkpoint; ends with what is there.

    target: no row is added beyond so many. A batch is a folder of its own below path
    (a retried batch replaces it), with the rows so far in its name, so nothing is counted twice.
    seconds: a cap on the time; what was appended until then stays, and a later run goes on from there.
    """
    spark = lines.sparkSession

    def folders() -> dict[int, int]:
        jvm = spark._jvm.org.apache.hadoop.fs
        files = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        found = files.globStatus(jvm.Path(path, "batch=*"))
        names = [s.getPath().getName().removeprefix("batch=").split("-") for s in found or [] if files.exists(jvm.Path(s.getPath(), "_SUCCESS"))]
        return {int(number): int(rows) for number, rows in names}

    def add(batch: DataFrame, number: int) -> None:
        before = {n: rows for n, rows in folders().items() if n != number}
        good = batch.where(gate).persist()
        try:
            rows = good.count()
            if target is not None:
                rows = min(rows, target - sum(before.values()))
                good = good.limit(max(0, rows))
            if rows > 0:
                good.write.mode("overwrite").json(f"{path}/batch={number}-{rows}")
        finally:
            good.unpersist()

    query = lines.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if seconds is not None and not query.awaitTermination(seconds):
        query.stop()
    return query


def producers(streams: list[DataFrame]) -> DataFrame:
    """Several streams of rows as one, with the number of its producer: they are read side by side and written by one query."""
    return functools.reduce(DataFrame.unionByName, [s.withColumn("producer", F.lit(i)) for i, s in enumerate(streams)])


def first_seen(lines: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """A stream without repeats of a key within the watermark, so that state is bounded."""
    return lines.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


class _Once(StatefulProcessor):
    """Lets the first row of a key through; keys of the initial state are known already."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "yes boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.known.update((True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            if not self.known.exists() and len(frame):
                self.known.update((True,))
                yield frame[self.columns].head(1)

    def close(self) -> None:
        pass


def unseen(lines: DataFrame, key: str, earlier: DataFrame | None = None) -> DataFrame:
    """A stream of rows whose key came neither earlier in this stream nor in what was written before (earlier: a frame with the key).

    A key is remembered for good, in the state store on disk (RocksDB; the session is set
    to it where it has another). State begins with the earlier keys, which are
    read at the first start of a checkpoint only.
    """
    spark = lines.sparkSession
    if "RocksDB" not in spark.conf.get(_STORE, ""):
        spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    known = earlier.select(key).where(F.col(key).isNotNull()).distinct().groupBy(key) if earlier is not None else None
    return lines.groupBy(key).transformWithStateInPandas(_Once(lines.columns), lines.schema, "append", "None", initialState=known)


class _Counts(StreamingQueryListener):
    """Sums what a query's observation counts, and stops the query once enough rows are kept."""

    def __init__(self, name: str, target: int | None):
        self.name, self.target = name, target
        self.total: dict[str, int] = {}
        self.batches: set[int] = set()
        self.ids: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None or event.progress.batchId in self.batches:
            return
        self.batches.add(event.progress.batchId)
        for field, n in row.asDict().items():
            self.total[field] = self.total.get(field, 0) + (n or 0)
        if self.target is not None and self.total.get("kept", 0) >= self.target:
            self.ids.add(str(event.progress.id))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def counted_stream(lines: DataFrame, gate: Column, name: str = "gate", target: int | None = None) -> tuple[DataFrame, _Counts]:
    """The rows of a stream that a gate keeps, and a listener whose `total` sums seen, kept and rejected over the batches of this run.

    With a target the listener's `ids` names the query once so many rows are kept:
    `run_counted` stops it then.
    """
    ok = F.coalesce(gate, F.lit(False))
    listener = _Counts(name, target)
    lines.sparkSession.streams.addListener(listener)
    return lines.observe(name, F.count(F.lit(1)).alias("seen"), F.count_if(ok).alias("kept"), F.count_if(~ok).alias("rejected")).where(ok), listener


def run_counted(query, listener: _Counts, seconds: float = 60.0) -> dict[str, int]:
    """Wait until a query of `counted_stream` ends, reaches its target or the time is up; its counters."""
    end = time.monotonic() + seconds
    while query.isActive and str(query.id) not in listener.ids and time.monotonic() < end:
        query.awaitTermination(0.2)
    query.stop()
    return dict(listener.total)
