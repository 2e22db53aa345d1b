"""Penalised change points of daily series by segment-neighbourhood dynamic programming.

A key's values are added up by day (Spark, with partial sums before the shuffle, so
a key with a third of all rows costs as many rows a task as it has days). A series
goes from a key's first to its last day; days between without values count 0. It is
cut into segments of at least `least` days. With n days, sum S and sum of squares Q
a segment has spread V = 1 + floor((n*Q - S*S) / (n*n)) in exact integers and costs
n * floor(1000 * ln V).

For every number of segments and every end day the exact best cost is found, from
that of one segment less at each place where the last one can start. Then the
penalties are added; the least total wins, of equal ones that with the fewest
segments, and its starts are traced back, each the earliest that gives the best
cost. Numbers of segments whose penalties alone reach the cost of one segment can't
win and are left out.

Series are dealt to `spark.sql.shuffle.partitions` tasks. A task holds one series at
a time: a best cost and a start for each number of segments and end day, and costs
of segments for as many end days as BLOCK allows. Work grows with the number of
segments and the square of the days.

Defined results: rows without a day or a value are left out, repeated rows all
count; null is a key of its own; a series shorter than `least` days is one segment;
other columns aren't read; an empty table gives no rows. Sums beyond 64 bits in
n * Q are taken in Python's integers; totals and values are longs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LEAST_DAYS = 7
PENALTY = 20_000
#: Costs of so many segments are held at once.
BLOCK = 1 << 18
_NEVER = np.int64(1 << 60)


class Series:
    """Prefix sums of a series, for the spread and cost of any of its segments."""

    def __init__(self, values: np.ndarray):
        """values: integers by day."""
        whole = [int(x) for x in values]
        middle = sum(whole) // len(whole)  # the spread is that of values less any constant
        near = [x - middle for x in whole]
        wide = len(near) * sum(x * x for x in near) >= 1 << 62
        self.days = len(near)
        self.sums = np.cumsum([0, *near], dtype=object if wide else np.int64)
        self.squares = np.cumsum([0, *(x * x for x in near)], dtype=object if wide else np.int64)

    def spreads(self, start, end):
        n, s, q = end - start, self.sums[end] - self.sums[start], self.squares[end] - self.squares[start]
        if self.sums.dtype == object:
            n = n.astype(object)
        return 1 + (n * q - s * s) // (n * n)

    def costs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Costs of the segments from start to before end."""
        return (end - start) * np.floor(1000 * np.log(self.spreads(start, end).astype(np.float64))).astype(np.int64)


def cut_points(series: Series, least: int = LEAST_DAYS, penalty: int = PENALTY) -> tuple[list[int], int]:
    """The starts of the best segments, with the end at last, and the cost of all with their penalties."""
    n = series.days
    one = int(series.costs(np.array([0]), np.array([n]))[0])
    most = max(1, n // least)
    if penalty > 0:
        most = min(most, 1 + max(0, one - 1) // penalty)
    best = np.full((most + 1, n + 1), _NEVER)
    came = np.zeros((most + 1, n + 1), dtype=np.int32)
    rows = max(1, BLOCK // (n + 1))
    for low in range(min(least, n), n + 1, rows) if most > 1 else ():
        ends = np.arange(low, min(low + rows, n + 1))
        starts = np.arange(0, ends[-1] - least + 1)
        allowed = ends[:, None] - starts >= least
        costs = np.where(allowed, series.costs(np.minimum(starts, ends[:, None] - 1), ends[:, None]), _NEVER)
        best[1, ends] = costs[:, 0]
        for k in range(2, most + 1):
            first, from_ = max(0, k * least - low), (k - 1) * least
            if first >= len(ends):
                break
            total = best[k - 1, from_ : len(starts)] + costs[first:, from_:]
            at = total.argmin(axis=1)
            best[k, ends[first:]] = total[np.arange(len(at)), at]
            came[k, ends[first:]] = at + from_
    best[1, n] = one
    totals = best[1:, n] + penalty * np.arange(most)
    k = int(totals.argmin()) + 1
    points, total = [n], int(totals[k - 1])
    for j in range(k, 1, -1):
        points.append(int(came[j, points[-1]]))
    return [*([0] if k else []), *reversed(points)], total


_MADE = (
    ("segment_no", pa.int32()), ("first_day", pa.int64()), ("n_days", pa.int64()), ("total", pa.int64()),
    ("spread", pa.int64()), ("cost", pa.int64()), ("n_segments", pa.int64()), ("best_cost", pa.int64()),
)


def change_points(rows: DataFrame, key: str, day: str, value: str, least: int = LEAST_DAYS, penalty: int = PENALTY) -> DataFrame:
    """Segments of the series of each key: (key, segment_no, first_day, n_days, total, spread, cost, n_segments, best_cost).

    day: a date or timestamp. value: a whole number. first_day counts days since 1970.
    """
    if least < 1 or penalty < 0:
        raise ValueError("segments have at least a day, and no penalty is below 0")
    taken = rows.where(F.col(day).isNotNull() & F.col(value).isNotNull()).select(F.col(key).alias("key"), F.unix_date(F.to_date(day)).alias("day"), F.col(value).cast("long").alias("value"))
    daily = taken.groupBy("key", "day").agg(F.sum("value").alias("value"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = daily.repartition(parts, "key").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("day", "value"))).alias("days"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, made, which = batch.column("days"), [[] for _ in _MADE], []
            offsets = lists.offsets.to_numpy()
            days, values = (lists.values.field(i).to_numpy() for i in (0, 1))
            for i in range(len(batch)):
                own = slice(offsets[i], offsets[i + 1])
                first = int(days[own][0])
                daily = np.zeros(int(days[own][-1]) - first + 1, dtype=np.int64)
                daily[days[own] - first] = values[own]
                series = Series(daily)
                points, best = cut_points(series, least, penalty)
                start, end = np.array(points[:-1]), np.array(points[1:])
                k = len(start)
                which.extend([i] * k)
                found = (range(1, k + 1), start + first, end - start, np.add.reduceat(daily, start), series.spreads(start, end), series.costs(start, end), [k] * k, [best] * k)
                for column, x in zip(made, found, strict=True):
                    column.extend(x)
            arrays = [batch.column("key").take(pa.array(which, pa.int64())), *(pa.array(x, kind) for x, (_, kind) in zip(made, _MADE, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, *(name for name, _ in _MADE)])

    made = [T.StructField(name, T.IntegerType() if kind == pa.int32() else T.LongType()) for name, kind in _MADE]
    return lists.mapInArrow(solve, T.StructType([T.StructField(key, lists.schema["key"].dataType), *made]))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of the daily quantities of each vendor."""
    lines = spark.read.parquet(f"{sf_dir}/sale_lines.parquet")
    return change_points(lines.where("flag = 'kept'"), "vendor_id", "shipped_at", "quantity")


SQL = """
WITH RECURSIVE taken AS (
  SELECT vendor_id, date_diff('day', DATE '1970-01-01', shipped_at::DATE) AS day, sum(quantity)::BIGINT AS value
  FROM sale_lines WHERE flag = 'kept' AND quantity IS NOT NULL AND shipped_at IS NOT NULL GROUP BY ALL
), span AS (
  SELECT row_number() OVER () AS v, vendor_id, min(day) AS lo, max(day) - min(day) + 1 AS n FROM taken GROUP BY vendor_id
), days AS (
  SELECT v, vendor_id, lo, n, unnest(range(1, n + 1)) AS i FROM span
), filled AS (
  SELECT d.v, d.i, coalesce(t.value, 0)::HUGEINT AS value FROM days d LEFT JOIN taken t ON t.vendor_id IS NOT DISTINCT FROM d.vendor_id AND t.day = d.lo + d.i - 1
), sums AS (
  SELECT v, i, sum(value) OVER w AS s, sum(value * value) OVER w AS q FROM filled WINDOW w AS (PARTITION BY v ORDER BY i)
  UNION ALL SELECT v, 0, 0, 0 FROM span
), spreads AS (
  SELECT a.v, a.i AS first, b.i AS last, b.i - a.i AS n, b.s - a.s AS total, 1 + ((b.i - a.i) * (b.q - a.q) - (b.s - a.s) * (b.s - a.s)) // ((b.i - a.i) * (b.i - a.i)) AS spread
  FROM sums a JOIN sums b ON a.v = b.v JOIN span ON span.v = a.v
  WHERE b.i - a.i >= 7 OR (a.i = 0 AND b.i = span.n)
), segments AS (
  SELECT *, n * floor(1000 * ln(spread::DOUBLE))::BIGINT AS cost FROM spreads
), best AS (
  SELECT v, 1 AS k, last, cost, [0::BIGINT] AS starts FROM segments WHERE first = 0
  UNION ALL
  SELECT b.v, b.k + 1, g.last, min(b.cost + g.cost), arg_min(list_append(b.starts, g.first), (b.cost + g.cost) * 1000000 + g.first)
  FROM best b JOIN segments g ON g.v = b.v AND g.first = b.last GROUP BY b.v, b.k, g.last
), chosen AS (
  SELECT b.v, k, starts, b.cost + 20000 * (k - 1) AS best_cost, span.lo, span.n AS days, vendor_id
  FROM best b JOIN span ON span.v = b.v AND b.last = span.n
  QUALIFY row_number() OVER (PARTITION BY b.v ORDER BY b.cost + 20000 * (k - 1), k) = 1
), cuts AS (
  SELECT v, vendor_id, lo, k, best_cost, unnest(range(1, k + 1)) AS j, starts, days FROM chosen
)
SELECT vendor_id, j::INT AS segment_no, (lo + g.first)::BIGINT AS first_day, g.n::BIGINT AS n_days, g.total::BIGINT AS total, g.spread::BIGINT AS spread, g.cost::BIGINT AS cost, k::BIGINT AS n_segments, best_cost::BIGINT AS best_cost
FROM cuts c JOIN segments g ON g.v = c.v AND g.first = c.starts[j] AND g.last = CASE WHEN j < k THEN c.starts[j + 1] ELSE c.days END
"""
