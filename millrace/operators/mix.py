"""Mixing record sets: replay by stratum, signatures, hold-out, up-weights, composition."""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.gates import has_tool_turn
from ..functions.text import as_fenced_reply, has_fence, strip
from ..sources.sinks import write_jsonl
from .ordering import in_order, numbered

#: The tag of a fence by language.
FENCES = {"Python": "python", "C": "c", "Java": "java", "HTML": "html", "html": "html", "python": "python", "c": "c", "java": "java"}


@dataclass(frozen=True)
class MixConfig:
    """Knobs of a mix; nothing is read from the environment."""

    seed: int = 3407
    holdout: float = 0.03
    replay: dict[str, float] = field(default_factory=lambda: {"C": 1.0, "HTML": 1.0, "Java": 1.0, "Python": 0.25})
    weights: dict[str, int] = field(default_factory=lambda: {"tools": 1, "code": 1, "img": 8, "toollock": 3, "research": 5})


def shuffle_key(seed: int, key: Column) -> Column:
    """A seeded order of rows that depends on nothing but the key."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def shuffled(df: DataFrame, key: str, seed: int = 3407, parts: int | None = None) -> DataFrame:
    """df with its `position` in the seeded order: a permutation of all rows that depends on their keys alone."""
    return numbered(df, shuffle_key(seed, F.col(key)), parts=parts)


def write_shuffled(df: DataFrame, key: str, path: str, seed: int = 3407, parts: int | None = None) -> None:
    """Write df as JSON lines in the seeded order: files by name, and lines within them, follow it."""
    write_jsonl(in_order(shuffled(df, key, seed, parts), "position", parts).drop("position"), path)


def smallest(df: DataFrame, by: list[str], key: Column, order: str, wanted: DataFrame, digits: int) -> DataFrame:
    """Of each group of `by`, the first `_k` rows (of wanted: by, _k) in the order of a hexadecimal key, then of `order`.

    Keys are evenly spread, so a histogram of their first digits tells in which bin
    the last row lies: bins before it are whole, and rows are ranked in that bin alone.
    wanted: a row for each named group.
    """
    rows = df.withColumn("_key", key).withColumn("_bin", F.substring("_key", 1, digits))
    bins = rows.groupBy(*by, "_bin").agg(F.count("*").alias("_n")).join(F.broadcast(wanted), by)
    upto = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # 16 ** digits bins at most
    bins = bins.withColumn("_had", F.coalesce(F.sum("_n").over(upto), F.lit(0))).where("_had < _k").select(*by, "_bin", "_had", "_k", (F.col("_had") + F.col("_n") <= F.col("_k")).alias("_whole"))
    found = rows.join(bins, [*by, "_bin"])
    edge = found.where("NOT _whole").withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy("_key", order))).where("_had + _rank <= _k").drop("_rank")
    return found.where("_whole").unionByName(edge).drop("_key", "_bin", "_had", "_k", "_whole")


def digits_for(rows: int, each: int = 5000) -> int:
    """How many hexadecimal digits make bins of some `each` rows."""
    digits = 1
    while 16**digits * each < rows and digits < 8:
        digits += 1
    return digits


def replay(df: DataFrame, fractions: dict[str, float], stratum: str, order: str, seed: int = 3407) -> DataFrame:
    """A fraction of each stratum: all, none, or max(1, round half to even) rows by the seeded order. Other strata go.

    Rows are counted by the first digits of their place in the order, and ranked only at the cut.
    """
    part = F.lit(0.0)
    for name, fraction in fractions.items():
        part = F.when(F.col(stratum) == name, F.lit(float(fraction))).otherwise(part)
    rows = df.withColumn("_part", part)
    cut = rows.where("_part > 0 AND _part < 1")
    sizes = cut.groupBy(stratum).agg(F.count("*").alias("_all"), F.greatest(F.lit(1), F.bround(F.count("*") * F.first("_part"), 0)).cast("long").alias("_k"))
    named = sizes.collect()  # a row for each named stratum
    wanted = df.sparkSession.createDataFrame([(r[stratum], r["_k"]) for r in named], f"{stratum} string, _k long")
    some = smallest(cut, [stratum], shuffle_key(seed, F.col(order)), order, wanted, digits_for(max((r["_all"] for r in named), default=0)))
    return rows.where("_part >= 1").select(df.columns).unionByName(some.select(df.columns))


def replay_report(df: DataFrame, kept: DataFrame, stratum: str) -> DataFrame:
    """Rows before and after by stratum."""
    before = df.groupBy(stratum).agg(F.count("*").alias("n_before"))
    after = kept.groupBy(stratum).agg(F.count("*").alias("n_after"))
    return before.join(after, stratum, "left").select(stratum, "n_before", F.coalesce("n_after", F.lit(0)).cast("long").alias("n_after"))


def intro_for(lang: Column, tag: Column, code: Column) -> Column:
    """The sentence before a block of code."""
    page = F.when(F.lower(code).contains("<!doctype"), "Here's a complete, self-contained HTML page:").otherwise("Here's the HTML:")
    named = F.coalesce(lang, F.lit("")) != ""
    return F.when(named & (tag == "html"), page).when(named, F.concat(F.lit("Here's the "), lang, F.lit(" solution:"))).otherwise("Here's the code:")


def normalized_messages(messages: Column, kind: Column, lang: Column) -> Column:
    """Bare code in assistant turns gets an intro and a fence; rows of chat, tools or several turns, and unknown languages, stay."""
    table = F.create_map(*(F.lit(x) for kv in FENCES.items() for x in kv))
    own = F.try_element_at(table, F.coalesce(lang, F.lit("")))
    tag = F.coalesce(own, F.when(kind == "web", F.lit("html")))
    skip = F.coalesce(kind.isin("multi", "chat", "tools"), F.lit(False)) | has_tool_turn(messages) | tag.isNull()
    bare = lambda m: (m["role"] == "assistant") & (m["content_type"] == "string") & ~has_fence(m["content"])
    fenced = F.transform(messages, lambda m: F.when(bare(m), m.withField("content", as_fenced_reply(intro_for(lang, F.coalesce(own, F.lit("")), m["content"]), m["content"], tag))).otherwise(m))
    return F.when(skip, messages).otherwise(fenced)


def first_user(messages: Column) -> Column:
    """The first user turn, stripped; null is ''."""
    turn = F.try_element_at(F.filter(messages, lambda m: m["role"] == "user"), F.lit(1))
    return F.coalesce(strip(turn["content"]), F.lit(""))


def signature(messages: Column, kind: Column, mtype: Column, tools_spec: Column) -> Column:
    """What makes a row a duplicate: a tagged struct of query, scenario type, offered tools and the tool first called."""
    tools = F.expr("transform(try_variant_get(try_parse_json(tools_spec), '$', 'array<variant>'), t -> coalesce(try_variant_get(t, '$.function.name', 'string'), ''))") if tools_spec is None else tools_spec
    called = F.try_element_at(F.filter(messages, lambda m: F.coalesce(F.size(m["tool_calls"]), F.lit(0)) > 0), F.lit(1))["tool_calls"][0]["name"]
    is_multi, is_tools = F.coalesce(kind == "multi", F.lit(False)), F.coalesce(kind == "tools", F.lit(False))
    return F.struct(
        F.when(is_multi, "multi").when(is_tools, "tools").otherwise("query").alias("tag"), first_user(messages).alias("q"),
        F.when(is_multi, F.coalesce(mtype, F.lit(""))).otherwise("").alias("mtype"), F.when(is_tools, F.array_sort(F.coalesce(tools, F.array().cast("array<string>")))).otherwise(F.array().cast("array<string>")).alias("names"),
        F.when(is_tools, F.coalesce(called, F.lit(""))).otherwise("").alias("called"),
    )


def distinct_by(df: DataFrame, sig: str, order: str) -> DataFrame:
    """The first row of each signature; a blank query alone is never a duplicate."""
    blank = (F.col(f"{sig}.tag") == "query") & (F.col(f"{sig}.q") == "")
    key = F.sha2(F.to_json(F.struct(sig)), 256)
    rows = df.withColumn("_h", F.when(~blank, key))
    first = rows.where("_h IS NOT NULL").groupBy("_h").agg(F.min(order).alias("_first"))
    return rows.join(first, "_h", "left").where(F.col("_h").isNull() | (F.col(order) == F.col("_first"))).drop("_h", "_first")


def holdout_head(df: DataFrame, order: str, fraction: float = 0.03, seed: int = 3407) -> DataFrame:
    """df with split: the first max(1, round half to even) rows of the seeded order are held out.

    A histogram of the order's first digits finds the bin of the cut, and only that bin's rows are ranked.
    """
    n = df.count()
    k = max(1, round(n * fraction)) if n else 0
    rows = df.withColumn("_all", F.lit(0))
    wanted = df.sparkSession.createDataFrame([(0, k)], "_all int, _k long")
    head = smallest(rows.select("_all", order), ["_all"], shuffle_key(seed, F.col(order)), order, wanted, digits_for(n)).select(order, F.lit(True).alias("_head"))
    return df.join(head, order, "left").withColumn("split", F.when(F.col("_head"), "heldout").otherwise("train")).drop("_head")


def upweight(df: DataFrame, rules: list[tuple[Column, int]]) -> DataFrame:
    """Each row as often as the product of the weights of the rules that it meets."""
    weight = F.lit(1)
    for rule, w in rules:
        weight = weight * F.when(F.coalesce(rule, F.lit(False)), w).otherwise(1)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), weight))).drop("_copy")


def standard_rules(config: MixConfig = MixConfig()) -> list[tuple[Column, int]]:
    """The up-weights of a mix, over kind, mtype and img."""
    w = config.weights
    return [
        (F.col("kind") == "tools", w["tools"]), (F.col("kind") == "code", w["code"]), (F.col("img"), w["img"]),
        (F.col("mtype") == "enrich", w["toollock"]), (F.col("mtype").isin("research", "freshresearch"), w["research"]),
    ]


def total_rows(frames: list[DataFrame]) -> DataFrame:
    """One row: how many rows several sources have together (`total`), and each source by its place (`by_source`)."""
    counts = [f.agg(F.count("*").alias("n")).withColumn("source", F.lit(i)) for i, f in enumerate(frames)]
    all_ = functools.reduce(DataFrame.unionByName, counts)
    return all_.agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("source", "n")))["n"].alias("by_source"))


def of_types(df: DataFrame, column: str, names: str | None) -> DataFrame:
    """Rows whose value is in a comma-separated list; all rows without a list."""
    return df.where(F.col(column).isin(*[x.strip() for x in names.split(",")])) if names else df


def last_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The last n rows in an order: each task keeps n."""
    return df.orderBy(*(F.desc(c) for c in order)).limit(n)


def latest_row(df: DataFrame, by: list[str], order: list[str], *what: str) -> DataFrame:
    """Columns of the latest row of each group, by an aggregate."""
    last = F.max(F.struct(*order, *(c for c in what if c not in order))).alias("_last")
    return df.groupBy(*by).agg(last).select(*by, *(F.col(f"_last.{c}").alias(c) for c in what))


def first_of_each(df: DataFrame, by: list[str], order: str, n: int) -> DataFrame:
    """(by, order) of the first n rows of each group: ranked within tasks first, so that a hot group costs n rows a task."""
    own = Window.partitionBy(*by, "_task").orderBy(order)
    few = df.select(*by, order).withColumn("_task", F.spark_partition_id()).withColumn("_k", F.row_number().over(own)).where(F.col("_k") <= n)
    top = Window.partitionBy(*by).orderBy(order)
    return few.withColumn("_k", F.row_number().over(top)).where(F.col("_k") <= n).select(*by, order)


def composition(df: DataFrame, by: str = "kind") -> DataFrame:
    """Rows by kind, '?' where it is missing."""
    return df.groupBy(F.coalesce(by, F.lit("?")).alias(by)).agg(F.count("*").alias("n"))
