"""Mixing sources to target weights by iterative proportional fitting.

Tokens are added up in cells of source x language x topic. Raking multiplies the
cells of each value of a dimension by target / current share, one dimension after
the other, until all three marginals hold. A cell's weight over its tokens, scaled
to the budget, is the probability at which its documents are sampled; where that
would exceed 1, the cell is taken whole and the rest of the budget is spread over
the others. A document is sampled if a hash of its id is below its probability: the
same documents at every run, on any cluster.

A table of cells whose count is small is raked at the driver; a larger one as a
DataFrame, with one sum per value of a dimension in each step.

Defined results: null source, lang or text are values "null", "null" and an empty
text; a document without words counts one token; a row without doc_id is sampled by
a hash of its text, source and language; rows that are equal in what is hashed are
taken or left together; target values without documents have no cells, and their
share goes to the others in proportion; where no weights meet all targets at once (a
value whose cells another dimension leaves out), sweeps go on until the weights are
at rest, and the column `deviation` and a warning say by how much a marginal is off;
columns of docs that are named
like those that `mix` adds give way (`sampled` keeps all); an empty table gives no rows.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .store import cut

DIMS = ("source", "lang", "topic")
TOLERANCE = 1e-4
#: Weights are at rest once a sweep moves less than this of their sum, which is 1.
REST = 1e-10
#: A table of at most so many cells is raked at the driver; a larger one by sums and joins, with the same rules.
FEW_CELLS = 50_000
BROADCAST_CELLS = 100_000
#: The part of all tokens that the sample is to hold.
BUDGET = 0.8
#: Target shares are the corpus' own to this power: below 1, large values give way to small ones.
TEMPER = {"source": 0.7, "lang": 0.85, "topic": 1.0}


def topic(text: Column) -> Column:
    """A coarse kind of text by its form: the topic where the data have none."""
    n = F.length(text)
    return F.when(n < 300, "note").when(F.regexp_count(text, F.lit("[|]")) * 100 > n, "table").when(n < 3000, "article").otherwise("book")


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(value, target): the corpus' shares of a dimension, tempered."""
    sums = cells.groupBy(F.col(dim).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("w"))
    return _shares(sums)


def _shares(sums: DataFrame) -> DataFrame:
    total = sums.agg(F.sum("w")).first()[0]
    return sums.select("value", (F.col("w") / F.lit(total)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, few: int = FEW_CELLS) -> DataFrame:
    """cells (DIMS, tokens) with weights whose marginals are the targets (value, target), and the largest relative deviation from these; weights add up to 1.

    Sweeps go on until the deviation is within the tolerance, or the weights are at
    rest, which means that no weights meet all targets.
    """
    at = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dim, target in targets.items():
        known = target.join(cells.select(F.col(dim).alias("value")).distinct(), "value")
        scaled = _shares(known.select("value", F.col("target").alias("w"))).withColumnRenamed("target", f"_{dim}")
        at = at.join(scaled.withColumnRenamed("value", dim), dim)
    at = cut(at)
    at, off = (_swept_here if at.count() <= few else _swept)(at, list(targets), tolerance)
    if off > tolerance:
        warnings.warn(f"no weights meet the targets: the largest deviation of a marginal is {off:.3g}", stacklevel=2)
    return at.drop(*(f"_{d}" for d in targets)).withColumn("deviation", F.lit(float(off)))


def _swept_here(at: DataFrame, dims: list[str], tolerance: float) -> tuple[DataFrame, float]:
    """Sweeps over a table of few cells at the driver."""
    rows = at.toPandas()
    codes = [pd.factorize(rows[d], use_na_sentinel=False)[0] for d in dims]
    goals = [rows.groupby(code)[f"_{d}"].first().to_numpy() for code, d in zip(codes, dims, strict=True)]
    weight = rows["weight"].to_numpy() / max(1.0, rows["weight"].sum())
    off, moved = 0.0, math.inf if len(rows) else 0.0
    while moved > REST:
        before = weight
        for code, goal in zip(codes, goals, strict=True):
            sums = np.bincount(code, weight, len(goal))
            weight = weight * np.divide(goal, sums, out=np.zeros_like(goal), where=sums > 0)[code]
        off = max((float(np.abs(np.bincount(code, weight, len(goal)) / goal - 1).max()) for code, goal in zip(codes[:-1], goals[:-1], strict=True)), default=0.0)
        if off <= tolerance:
            break
        moved = float(np.abs(weight - before).sum())
    spark = at.sparkSession
    return spark.createDataFrame(rows.assign(weight=weight), at.schema) if len(rows) else at, off


def _swept(at: DataFrame, dims: list[str], tolerance: float) -> tuple[DataFrame, float]:
    """Sweeps over a table of any size by sums and joins."""
    columns = at.columns
    total = at.agg(F.sum("weight")).first()[0]
    at = at.withColumn("weight", F.col("weight") / F.lit(total))
    while True:
        at = at.withColumn("_old", F.col("weight"))
        for dim in dims:
            sums = at.groupBy(dim).agg(F.sum("weight").alias("_sum"))
            at = at.join(sums, dim).withColumn("weight", F.when(F.col("_sum") > 0, F.col("weight") * F.col(f"_{dim}") / F.col("_sum")).otherwise(0.0)).select(*columns, "_old")
        at = cut(at)
        off = _deviation(at, dims) if len(dims) > 1 else 0.0
        if off <= tolerance or at.agg(F.sum(F.abs(F.col("weight") - F.col("_old")))).first()[0] <= REST:
            return at.select(columns), off


def _deviation(at: DataFrame, dims: list[str]) -> float:
    """The largest relative deviation of a marginal from its target."""
    frames = [at.groupBy(d).agg((F.abs(F.sum("weight") / F.max(f"_{d}") - 1)).alias("x")).agg(F.max("x").alias("x")) for d in dims[:-1]]
    worst = frames[0]
    for f in frames[1:]:
        worst = worst.union(f)
    return worst.agg(F.max("x")).first()[0] or 0.0


def probabilities(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """raked cells with the sampling probability of their documents: weight / tokens, scaled to a budget of all tokens, 1 at most."""
    at, scale, taken, free = raked, None, 0.0, 1.0
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    while True:  # cells that are taken whole only grow in number
        scale = (budget * total - taken) / free if free > 0 else 0.0
        row = at.agg(F.sum(F.when(F.col("weight") * scale >= F.col("tokens"), F.col("tokens"))), F.sum(F.when(F.col("weight") * scale < F.col("tokens"), F.col("weight")))).first()
        new_taken, new_free = float(row[0] or 0), float(row[1] or 0)
        if abs(new_taken - taken) < 0.5:
            break
        taken, free = new_taken, new_free
    return at.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(float(scale or 0.0)) / F.col("tokens")))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """docs (doc_id, text, source, lang) with topic, tokens, weight, probability, deviation and selected. targets: (value, target) by dimension; where none is given, the corpus' own, tempered."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = ["topic", "tokens", "weight", "probability", "deviation", "selected"]
    docs = docs.drop(*(c for c in docs.columns if c.lower() in own))
    rows = docs.withColumns({"_source": F.coalesce("source", F.lit("null")), "_lang": F.coalesce("lang", F.lit("null")), "topic": topic(text), "tokens": F.greatest(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(1)).cast("long")})
    cells = cut(rows.groupBy(F.col("_source").alias("source"), F.col("_lang").alias("lang"), "topic").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    if cells.count() <= FEW_CELLS:  # few enough for one task: what is made of them needs no shuffle
        cells = cells.coalesce(1)
    targets = targets or {d: tempered(cells, d, TEMPER[d]) for d in DIMS}
    chances = probabilities(rake(cells, targets), budget).select(F.col("source").alias("_source"), F.col("lang").alias("_lang"), F.col("topic").alias("_topic"), F.col("weight"), "probability", "deviation")
    chances = cut(chances)
    if chances.count() <= BROADCAST_CELLS:  # beyond it, Spark shuffles both sides and splits hot cells
        chances = F.broadcast(chances)
    rows = rows.join(chances, (rows["_source"] == chances["_source"]) & (rows["_lang"] == chances["_lang"]) & (rows["topic"] == chances["_topic"]), "left").drop("_source", "_lang", "_topic")
    draw = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.lit("sample"))).otherwise(F.xxhash64("text", "source", "lang", F.lit("sample")))
    luck = F.pmod(draw, F.lit(1 << 53)) / float(1 << 53)
    return rows.withColumns({"weight": F.coalesce("weight", F.lit(0.0)), "probability": F.coalesce("probability", F.lit(0.0))}).withColumn("selected", luck < F.col("probability"))


def sampled(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """The sampled rows of docs, with their own columns, whatever these are called."""
    own, columns = ("doc_id", "text", "source", "lang"), docs.columns
    needed = docs.withColumnsRenamed({c: f"_in_{c}" for c in columns if c not in own})
    return mix(needed, targets, budget).where("selected").select(*(F.col(c if c in own else f"_in_{c}").alias(c) for c in columns))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights, probabilities and the sample of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "source", "lang", "topic", "tokens", F.round("weight", 9).alias("weight"), F.round("probability", 9).alias("probability"), F.round("deviation", 9).alias("deviation"), "selected")
