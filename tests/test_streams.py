"""Streams: dedup against earlier output, counters and stop at a target."""

import json

from pyspark.sql import functions as F

from millrace.streaming import monitor


def _run(spark, tmp_path, run, earlier=None):
    lines = spark.readStream.schema("key string, text string").json(str(tmp_path / "in"))
    out = monitor.unseen(lines, "key", earlier)
    query = out.writeStream.format("json").option("path", str(tmp_path / f"out{run}")).option("checkpointLocation", str(tmp_path / f"cp{run}")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return sorted(r.key for r in spark.read.schema("key string, text string").json(str(tmp_path / f"out{run}")).collect())


def _put(tmp_path, name, keys):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text("".join(json.dumps({"key": k, "text": f"{name} {i}"}) + "\n" for i, k in enumerate(keys)))


def test_no_key_of_earlier_output_or_of_this_stream_comes_again(spark, tmp_path):
    _put(tmp_path, "a.json", ["x", "y", "x"])
    first = _run(spark, tmp_path, 1)
    assert first == ["x", "y"]
    _put(tmp_path, "b.json", ["y", "z", "z"])
    assert _run(spark, tmp_path, 1) == ["x", "y", "z"]  # goes on from its checkpoint
    # another stream over the same files, which knows what the first one wrote
    _put(tmp_path, "c.json", ["w", "x", "w"])
    assert _run(spark, tmp_path, 2, spark.read.json(str(tmp_path / "out1"))) == ["w"]


def test_counters_of_a_stream_stop_it_at_the_target(spark, tmp_path):
    rows = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).option("numPartitions", 1).load()
    kept, listener = monitor.counted_stream(rows, F.col("value") % 2 == 0, "even", target=12)
    query = kept.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).start()
    total = monitor.run_counted(query, listener, 60)
    spark.streams.removeListener(listener)
    assert not query.isActive and total["kept"] >= 12 and total["seen"] == total["kept"] + total["rejected"] == 2 * total["kept"] and total["seen"] < 2000
