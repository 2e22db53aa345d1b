"""Reading and writing chat-shaped records as JSON lines, with a typed frame in between.

Lines are parsed to VARIANT, whose own types decide what is text: `from_json` would
turn an object under `content` into a string, and a gate could not tell.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.gates import row_ok
from ..operators.ordering import running
from ..functions.text import strict_json

CALLS = "array<struct<name:string,arguments:string>>"
MESSAGES = f"array<struct<role:string,content:string,content_type:string,tool_calls:{CALLS}>>"
RECORD = f"row_id bigint, src string, raw string, messages {MESSAGES}, kind string, lang string, task string, difficulty string, tests string, domain string, topic string, style string, mtype string, needs_tool boolean, img boolean, issues array<string>, tools_spec string"
#: A table of at most so many pieces of files (of 128 MB, as a rule) is broadcast; a larger one is joined by a shuffle.
BROADCAST_PIECES = 100_000
TEXTS = ["kind", "lang", "task", "difficulty", "domain", "topic", "style", "mtype"]


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines that are not blank (value), with their file (src) and their number in a sequential read (row_id), blank lines counted.

    Paths are read in the order given, files of a folder by name. Spark cuts files and
    packs the pieces by size, so a line's number comes from its piece: lines of a piece
    are in order, a first pass counts them, and the counts of all pieces before are
    added up. Both passes have to cut files alike; a piece that the first pass did not
    see is an error.
    """
    paths = [path] if isinstance(path, str) else path
    read = lambda at, p: spark.read.text(p).select("value", F.lit(at).alias("_at"), F.col("_metadata.file_path").alias("src"), F.col("_metadata.file_block_start").alias("_start"))
    raw = functools.reduce(DataFrame.unionAll, [read(at, p) for at, p in enumerate(paths)]).withColumn("_id", F.monotonically_increasing_id())
    raw = raw.withColumn("_task", F.shiftright("_id", 33))
    piece = ["_at", "src", "_start", "_task"]
    pieces = raw.groupBy(*piece).agg(F.min("_id").alias("_first"), F.count("*").alias("_lines"))
    placed = running(pieces, "_at", "src", "_start", sums=["_lines"]).select(*piece, "_first", (F.col("_lines_upto") - F.col("_lines")).alias("_before"))
    if placed.count() <= BROADCAST_PIECES:
        placed = F.broadcast(placed)
    number = F.col("_before") + F.col("_id") - F.col("_first")
    found = raw.join(placed, piece, "left").withColumn("row_id", F.coalesce(number, F.raise_error(F.lit("files were cut differently in the second pass")).cast("long")))
    return found.where("trim(value) <> ''").select("value", "src", "row_id")


def optional_lines(spark: SparkSession, path: str) -> DataFrame:
    """As `lines`; a path that does not exist has none."""
    try:
        return lines(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string, src string, row_id bigint")


def first_existing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of the first path of several that is there, even if it is empty; none if none is."""
    for path in paths:
        try:
            return lines(spark, path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return optional_lines(spark, paths[-1])


def count_lines(spark: SparkSession, path: str) -> int:
    """How many lines a file has; none if it is missing."""
    return optional_lines(spark, path).count()


def _get(v: Column | str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def parse(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines (value, src, row_id) as RECORD rows, and the lines that are no JSON objects."""
    v = frame.withColumn("v", strict_json(F.trim("value")))
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    good, bad = v.where(is_object), v.where(~is_object).select("row_id", "src", F.col("value").alias("raw"))
    kind = "CASE WHEN variant_get(m, '$.content', 'variant') IS NULL THEN 'missing' WHEN is_variant_null(variant_get(m, '$.content', 'variant')) THEN 'null' WHEN schema_of_variant(variant_get(m, '$.content', 'variant')) = 'STRING' THEN 'string' ELSE 'other' END"
    name = "coalesce(try_variant_get(c, '$.function.name', 'string'), try_variant_get(c, '$.name', 'string'))"
    args = "coalesce(to_json(variant_get(c, '$.function.arguments', 'variant')), to_json(variant_get(c, '$.arguments', 'variant')))"
    calls = f"transform(try_variant_get(m, '$.tool_calls', 'array<variant>'), c -> named_struct('name', {name}, 'arguments', {args}))"
    messages = F.expr(f"transform(try_variant_get(v, '$.messages', 'array<variant>'), m -> named_struct('role', try_variant_get(m, '$.role', 'string'), 'content', try_variant_get(m, '$.content', 'string'), 'content_type', {kind}, 'tool_calls', {calls}))")
    out = good.select(
        "row_id", "src", F.col("value").alias("raw"), messages.alias("messages"), *(_get("v", f"$.{c}").alias(c) for c in TEXTS),
        F.coalesce(_get("v", "$.tests"), F.expr("to_json(variant_get(v, '$.tests', 'variant'))")).alias("tests"), _get("v", "$.needs_tool", "boolean").alias("needs_tool"), _get("v", "$.img", "boolean").alias("img"),
        _get("v", "$.issues", "array<string>").alias("issues"), F.expr("to_json(variant_get(v, '$.tools_spec', 'variant'))").alias("tools_spec"),
    )
    return out.select([c.split()[0] for c in ("row_id src raw messages kind lang task difficulty tests domain topic style mtype needs_tool img issues tools_spec").split()]), bad


def read(spark: SparkSession, path: str | list[str], strict: bool = False) -> DataFrame:
    """Typed records. strict: a malformed line is an error."""
    good, bad = parse(lines(spark, path))
    if strict and not bad.isEmpty():
        raise ValueError("malformed line: " + bad.first()["raw"][:200])
    return good


def rendered(records: DataFrame, render: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(row_id, text) of valid records, and how many were skipped. render: a column; by default turns are joined with their roles."""
    if render is None:
        render = F.array_join(F.transform("messages", lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), F.coalesce(m["content"], F.lit("")))), "\n")
    ok = row_ok(F.col("messages"), F.col("kind"))
    return records.where(ok).select("row_id", render.alias("text")), records.agg(F.count_if(~ok).alias("skipped"))


def rendered_by(records: DataFrame, make: Callable[[], Callable[[list[dict], list | None], tuple[str, int]]]) -> DataFrame:
    """(row_id, text, length) of valid records by a renderer that takes messages and the offered tools, and gives a text and its length in tokens.

    make() builds the renderer, once in each task's worker: a template or a tokenizer is loaded there.
    """

    @F.pandas_udf("text string, length long")
    def render(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        one = make()
        for messages, tools in batches:
            made = [one([dict(m) for m in turns], json.loads(spec) if spec else None) for turns, spec in zip(messages, tools, strict=True)]
            yield pd.DataFrame(made, columns=["text", "length"])

    ok = row_ok(F.col("messages"), F.col("kind"))
    # not deterministic for Spark: it is not put into filters on its result, and runs once a row
    out = records.where(ok).select("row_id", render.asNondeterministic()("messages", "tools_spec").alias("r"))
    return out.select("row_id", "r.text", "r.length")


def fitting(texts: DataFrame, most: int = 2048) -> DataFrame:
    """texts (row_id, text, length) with `fits`: whether a trainer that cuts at `most` tokens sees all of it."""
    return texts.withColumn("fits", F.col("length") <= most)


def head(frame: DataFrame, n: int) -> DataFrame:
    """The first n lines, by their number: a top-k."""
    return frame.orderBy("row_id").limit(n)


def suite(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of arrays as rows (axis, item_id, item as JSON)."""
    whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    keys = whole.select(F.explode(F.expr("map_entries(variant_get(v, '$', 'map<string,variant>'))")).alias("e"))
    return keys.select(F.col("e.key").alias("axis"), F.posexplode(F.expr("variant_get(e.value, '$', 'array<variant>')")).alias("item_id", "x")).select("axis", "item_id", F.to_json("x").alias("item"))


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A relation of constants."""
    return spark.createDataFrame(rows, schema)


def union(frames: list[DataFrame]) -> DataFrame:
    """All rows of several sources, missing columns null, with the source's place as `ordinal`."""
    numbered = [f.withColumn("ordinal", F.lit(i)) for i, f in enumerate(frames)]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def fenced_of_transcript(spark: SparkSession, path: str, tag: str = "html") -> DataFrame:
    """The first fenced block of each whole Markdown file, entities unescaped."""
    from ..functions.text import unescape_html

    return spark.read.text(path, wholetext=True).select(F.regexp_extract(unescape_html(F.col("value")), rf"(?s)```{tag}\n(.*?)```", 1).alias("block"))

