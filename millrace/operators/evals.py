"""Evaluation analytics: pass rates, buckets, percentiles, axes of a frozen suite, result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..functions.gates import all_match, has_tool_turn, hits, is_plain_prose, is_prose
from ..functions.text import extract_code, has_fence
from .ordering import numbered, running


def pass_rates(df: DataFrame, by: str, passed: str = "pass") -> DataFrame:
    """Passed, total and rate by group, and in all ('ALL')."""
    out = df.rollup(by).agg(F.count_if(F.col(passed)).alias("passed"), F.count("*").alias("total"), F.grouping(by).alias("_all"))
    return out.select(F.when(F.col("_all") == 1, "ALL").otherwise(F.coalesce(by, F.lit("?"))).alias(by), "passed", "total", F.round(F.col("passed") / F.col("total"), 6).alias("rate"))


def running_rate(df: DataFrame, order: str, passed: str = "pass", parts: int | None = None) -> DataFrame:
    """(order, n, rate): the pass rate of all rows up to each, by an order of any type."""
    rows = running(df.select(order, F.coalesce(F.col(passed).cast("long"), F.lit(0)).alias("_p")), order, sums=["_p"], parts=parts)
    n = F.col("position") + 1
    return rows.select(order, n.alias("n"), F.round(F.col("_p_upto") / n, 6).alias("rate"))


def ticks(df: DataFrame, order: str, every: int, parts: int | None = None) -> DataFrame:
    """(order, n): each row whose number in an order of any type is a multiple of `every`."""
    return numbered(df.select(order), order, parts=parts).select(order, (F.col("position") + 1).alias("n")).where(F.col("n") % every == 0)


def gate_counters(df: DataFrame, gate: Column) -> DataFrame:
    """One row: how many rows a gate saw, kept and rejected; null is a rejection. `counted` gives the same beside the kept rows."""
    ok = F.coalesce(gate, F.lit(False))
    return df.agg(F.count("*").alias("seen"), F.count_if(ok).alias("kept"), F.count_if(~ok).alias("rejected"))


def counted(df: DataFrame, gate: Column, name: str = "gate") -> tuple[DataFrame, Observation]:
    """The rows that a gate keeps, and its counters, which are there once the rows have been written: no second pass."""
    ok = F.coalesce(gate, F.lit(False))
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("seen"), F.count_if(ok).alias("kept"), F.count_if(~ok).alias("rejected")).where(ok), watch


def joined_line(df: DataFrame, name: str, pattern: str, text: Column, separator: str = " ") -> DataFrame:
    """One row: the texts of result rows whose name matches, in order of name. For tables of results, which are small."""
    rows = df.where(F.col(name).rlike(pattern)).select(F.struct(F.col(name).alias("n"), text.alias("t")).alias("x"))
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), separator).alias("line"))


def preflight(assembled: DataFrame) -> DataFrame:
    """assembled (mtype, messages: null where a scenario was unusable) by type: how many were assembled, hold a call, and end with a fence."""
    m = F.col("messages")
    ends = has_fence(F.try_element_at(m, F.lit(-1))["content"])
    return assembled.groupBy("mtype").agg(F.count_if(m.isNotNull()).alias("assembled"), F.count("*").alias("total"), F.count_if(m.isNotNull() & has_tool_turn(m)).alias("with_call"), F.count_if(m.isNotNull() & ends).alias("final_fenced"))


def buckets(df: DataFrame, bucket: str, order: str) -> DataFrame:
    """Rows by bucket and the first row of each; largest first, ties by first row."""
    return df.groupBy(bucket).agg(F.count("*").alias("n"), F.min(order).alias("first_row")).orderBy(F.desc("n"), "first_row")


def exemplars(df: DataFrame, bucket: str, order: str, what: str) -> DataFrame:
    """The first row's value by bucket."""
    return df.groupBy(bucket).agg(F.min_by(what, order).alias(what))


def rescued(df: DataFrame, raw: str, fixed: str) -> DataFrame:
    """How many pass raw, fixed, only when fixed; and the reported difference, which is less where a fix breaks a pass."""
    return df.agg(F.count_if(raw).alias("n_raw"), F.count_if(fixed).alias("n_fixed"), F.count_if(F.col(fixed) & ~F.col(raw)).alias("n_rescued"), (F.count_if(fixed) - F.count_if(raw)).alias("n_gain"))


def exact_percentiles(df: DataFrame, value: str, fractions: dict[str, float], accuracy: int = 1000) -> DataFrame:
    """One row: the values at index floor(n * q) of the ascending list, and the maximum (`max`). Nulls are left out, NaN comes last.

    Nothing is sorted. Approximate quantiles name values near each wanted place, and counts below and up to
    these say whether one is it, or between which two it lies; the next round looks between these alone, for
    all quantiles at once. An open interval leaves out the values at its ends, however
    many rows share them, so it shrinks to the place of the answer, as a rule within two rounds.
    """
    kind = df.schema[value].dataType
    v = F.col("v")
    rows = df.where(F.col(value).isNotNull()).select(F.col(value).alias("v"))
    real = rows.where(~F.isnan("v")) if kind.typeName() in ("double", "float") else rows
    ends = rows.agg(F.count("*").alias("n"), F.max("v").alias("max")).first()
    n, last = ends["n"], real.count() if real is not rows else ends["n"]
    places = {name: int(n * q) for name, q in fractions.items()}
    answer = {name: (float("nan") if last <= k < n else None) for name, k in places.items()}
    open_ = {name: (None, None, 0, last) for name, k in places.items() if k < last}  # value below, value above, rows up to the first, rows below the second
    while open_:
        inside = {name: (F.lit(True) if low is None else v > F.lit(low)) & (F.lit(True) if high is None else v < F.lit(high)) for name, (low, high, _, _) in open_.items()}
        asks = []
        for name, (_, _, before, upto) in open_.items():
            at = (places[name] - before + 0.5) / (upto - before)
            near = sorted({min(1.0, max(0.0, x)) for x in (0.0, at - 3 / accuracy, at, at + 3 / accuracy, 1.0)})
            asks.append(F.percentile_approx(F.when(inside[name], v), near, accuracy).alias(name))
        found = real.agg(*asks).first()
        tried = {name: sorted(set(found[name])) for name in open_}
        counts = real.agg(*(c for name in open_ for i, x in enumerate(tried[name]) for c in (F.count_if(v < F.lit(x)).alias(f"{name} {i} below"), F.count_if(v <= F.lit(x)).alias(f"{name} {i} upto")))).first()
        for name in list(open_):
            low, high, before, upto = open_.pop(name)
            for i, x in enumerate(tried[name]):
                below, to = counts[f"{name} {i} below"], counts[f"{name} {i} upto"]
                if below <= places[name] < to:
                    answer[name] = x
                elif to <= places[name] and to >= before:
                    low, before = x, to
                elif below > places[name] and below <= upto:
                    high, upto = x, below
            if answer[name] is None:
                open_[name] = (low, high, before, upto)
    schema = T.StructType([*(T.StructField(name, kind) for name in fractions), T.StructField("max", kind)])
    return df.sparkSession.createDataFrame([(*answer.values(), ends["max"])], schema)


def message_chars(messages: Column) -> Column:
    """Characters of all contents of a row."""
    return F.aggregate(messages, F.lit(0).cast("long"), lambda a, m: a + F.coalesce(F.length(m["content"]), F.lit(0)))


def keyword_rate(df: DataFrame, n_hit: str, n_needed: str) -> DataFrame:
    """Hits over needs, micro-averaged; 1 where nothing is needed."""
    return df.agg(F.sum(n_hit).alias("n_hit"), F.sum(n_needed).alias("n_needed"), F.round(F.coalesce(F.sum(n_hit) / F.nullif(F.sum(n_needed), F.lit(0)), F.lit(1.0)), 6).alias("rate"))


def sample_rates(df: DataFrame, item: str, passed: str) -> DataFrame:
    """The rate of each item's samples, and of all (item null)."""
    return df.rollup(item).agg(F.count_if(passed).alias("passed"), F.count("*").alias("total")).withColumn("rate", F.round(F.col("passed") / F.col("total"), 6))


def pivot_versions(df: DataFrame, version: str, axis: str, passed: str, axes: list) -> DataFrame:
    """One row for each version, a column of passes for each axis; names are given, so no job looks for them."""
    return df.groupBy(version).agg(*(F.count_if((F.col(axis) == a) & F.col(passed)).alias(f"axis_{a}") for a in axes))


def delta(base: DataFrame, other: DataFrame, key: str, rate: str = "rate") -> DataFrame:
    """Rates of two tables by key, and the difference in points."""
    a = base.select(key, F.col(rate).alias("base_rate"))
    return a.join(other.select(key, F.col(rate).alias("other_rate")), key).withColumn("delta_pp", F.round(100 * (F.col("other_rate") - F.col("base_rate")), 4))


def share_above(df: DataFrame, flag: Column, ceiling: float = 0.05) -> DataFrame:
    """The share of flagged rows, and whether it is below the ceiling."""
    share = F.coalesce(F.avg(flag.cast("double")), F.lit(0.0))
    return df.agg(F.count("*").alias("n"), F.count_if(flag).alias("n_flagged"), F.round(share, 6).alias("share"), (share < ceiling).alias("ok"))


# Axes of the frozen suite: each takes replies joined with what is expected and
# returns them with pass; `tally` counts.


def score_web(df: DataFrame, errors: str = "errors") -> DataFrame:
    """df (content, full, must_contain, errors of the code) with pass, fenced and the patterns that are missing."""
    code = extract_code(F.col("content"), stripped=True)
    low = F.lower(code)
    whole = ~F.coalesce(F.col("full"), F.lit(False)) | (low.contains("<!doctype") & low.contains("<html"))
    missing = F.filter(F.coalesce("must_contain", F.array().cast("array<string>")), lambda p: ~F.regexp_like(code, F.concat(F.lit("(?is)"), p)))
    return df.withColumns({"fenced": has_fence(F.col("content")), "missing": missing}).withColumn("pass", (F.size(errors) == 0) & whole & (F.size("missing") == 0))


def score_keywords(df: DataFrame) -> DataFrame:
    """df (content, must_include) with n_hit, n_needed and pass."""
    need = F.coalesce("must_include", F.array().cast("array<string>"))
    out = df.withColumns({"n_hit": hits(F.coalesce("content", F.lit("")), need), "n_needed": F.size(need)})
    return out.withColumn("pass", F.col("n_hit") == F.col("n_needed"))


def score_modeswitch(df: DataFrame) -> DataFrame:
    """Prose with all keywords."""
    return score_keywords(df).withColumn("pass", F.col("pass") & is_prose(F.col("content")))


def score_prose(df: DataFrame) -> DataFrame:
    return df.withColumn("pass", is_plain_prose(F.col("content")))


def score_calls(df: DataFrame) -> DataFrame:
    """df (calls, expect_tool) with pass: some call names the tool, whatever its arguments."""
    return df.withColumn("pass", F.coalesce(F.exists("calls", lambda c: c["name"] == F.col("expect_tool")), F.lit(False)))


def score_tools(df: DataFrame) -> DataFrame:
    """df (calls, valid: whether each call is, expect_tool; null for none) with pass."""
    n = F.coalesce(F.size("calls"), F.lit(0))
    some = F.exists(F.zip_with("calls", "valid", lambda c, v: (c["name"] == F.col("expect_tool")) & v), lambda x: x)
    return df.withColumn("pass", F.when(F.col("expect_tool").isNull(), n == 0).otherwise(F.coalesce(some, F.lit(False))))


def tally(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if("pass").alias("passed"), F.count("*").alias("total"))


def must_match(df: DataFrame, text: str, patterns: str) -> DataFrame:
    return df.withColumn("pass", all_match(F.col(text), F.col(patterns)))
