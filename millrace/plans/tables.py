"""Queries whose inputs are made from the driver's tables: sources, calls, scenarios and replies that hold whole texts of these."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calls, gates, text as tx, udfs
from ..operators import assemble as asm, evals, execgate, mix, ordering
from ..sources import records, sinks
from ..sources.records import CALLS, MESSAGES
from ..sources.shared import shared_folder
from .queries import TOOLS, conversations, query, table

#: SQL of what `strip` and `is_prose` do, and of the opening of a fence.
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_PROSE = r"(length(trim({0})) >= 25 AND NOT regexp_matches({0}, '(?s)```[a-zA-Z0-9+#.\-]*\n(.*?)```') AND NOT contains({0}, '<tool_call>'))"


def _docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _one_of(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(at, F.lit(len(values))) + 1).cast("int"))


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _user_turns(spark, sf_dir) -> DataFrame:
    """(row_id, text, turn) of user turns."""
    rows = table(spark, sf_dir, "conversations").where("role = 'user'")
    return rows.select((F.col("conv_id") * 100 + F.col("turn")).alias("row_id"), F.coalesce("text", F.lit("")).alias("text"), "turn")


_USERS = "u AS (SELECT conv_id * 100 + turn AS row_id, coalesce(text, '') AS text, turn FROM conversations WHERE role = 'user')"


# C sources and compilers

_SYMBOLS = ["INT_MAX", "isdigit(c)", "sqrt(x)", "malloc(1)", "strlen(s)", "bool b", "uint8_t u", "f(1)"]
_INCLUDED = ["limits.h", "string.h", "math.h"]


@query(rf"""
WITH c AS (SELECT doc_id AS row_id, '#include <' || {_sql_list(_INCLUDED)}[doc_id % 3 + 1] || '>' || chr(10) || '/* ' || coalesce(text, '') || ' */' || chr(10) || 'int g(void) {{ return ' || {_sql_list(_SYMBOLS)}[doc_id % 8 + 1] || '; }} // pow(x)' AS code FROM documents),
h(header, pattern) AS (VALUES ('limits.h', '\b(INT_MAX|INT_MIN|UINT_MAX|LONG_MAX|LONG_MIN|CHAR_BIT)\b'), ('ctype.h', '\b(isalpha|isdigit|isalnum|isspace|isupper|islower|toupper|tolower|ispunct)\b'), ('math.h', '\b(sqrt|pow|fabs|floor|ceil|round|log|sin|cos|tan|exp)\b'),
  ('stdbool.h', '\b(bool|true|false)\b'), ('stdint.h', '\b(uint8_t|uint16_t|uint32_t|uint64_t|int8_t|int16_t|int32_t|int64_t)\b'), ('stdlib.h', '\b(malloc|calloc|realloc|free|strtol|strtod|qsort)\b'), ('string.h', '\b(strlen|strcpy|strncpy|strcmp|strncmp|strcat|memcpy|memset|memmove|strchr|strstr)\b')),
s AS (SELECT row_id, code, regexp_replace(regexp_replace(code, '(?s)/\*.*?\*/', ' ', 'g'), '//[^\n]*', ' ', 'g') AS bare FROM c),
m AS (SELECT row_id, header FROM s, h WHERE regexp_matches(bare, pattern) AND NOT contains(code, '#include <' || header || '>'))
SELECT s.row_id::BIGINT AS row_id, coalesce(string_agg(header, ',' ORDER BY header), '') AS missing FROM s LEFT JOIN m ON s.row_id = m.row_id GROUP BY s.row_id
""")
def header_lint(spark, sf_dir):
    """C sources with a document as comment, an include and a symbol: headers that are missing."""
    code = F.concat(F.lit("#include <"), _one_of(_INCLUDED, F.col("doc_id")), F.lit(">\n/* "), F.col("text"), F.lit(" */\nint g(void) { return "), _one_of(_SYMBOLS, F.col("doc_id")), F.lit("; } // pow(x)"))
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.array_join(gates.missing_headers(code), ",").alias("missing"))


_UNKNOWN = ["NULL", "true", "bool", "size_t", "zig"]


@query(f"""
WITH d AS (SELECT doc_id, {_sql_list(_UNKNOWN)}[doc_id % 5 + 1] AS s FROM documents),
h AS (SELECT doc_id, list_filter([CASE s WHEN 'NULL' THEN 'stddef.h' WHEN 'size_t' THEN 'stddef.h' WHEN 'true' THEN 'stdbool.h' WHEN 'bool' THEN 'stdbool.h' END, CASE WHEN doc_id % 2 = 0 THEN 'stdio.h' END], lambda x: x IS NOT NULL) AS hs FROM d)
SELECT doc_id AS row_id, array_to_string(list_sort(list_distinct(hs)), ',') AS headers FROM h
""")
def compiler_hints(spark, sf_dir):
    """Messages about a document's symbol, with a hint for every other one."""
    name = _one_of(_UNKNOWN, F.col("doc_id"))
    said = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("unknown type name '"), name, F.lit("'"))).otherwise(F.concat(F.lit("'"), name, F.lit("' undeclared")))
    hint = F.when(F.col("doc_id") % 2 == 0, F.lit("; 'puts' is defined in header '<stdio.h>'")).otherwise("")
    m = F.concat(F.col("text"), F.lit("\nmain.c:1: error: "), said, hint)
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.array_join(gates.hinted_headers(m), ",").alias("headers"))


_MAIN = ["int main(void) {}\n", "int remain(void)\n", "main(x)\n", "void  main (x)\n", "main() {\n"]


@query(rf"""
WITH f AS (SELECT regexp_matches({_sql_list(_MAIN)}[doc_id % 5 + 1] || coalesce(text, ''), '(?i)\b(?:int|void)\s+main\s*\(|\bmain\s*\(\s*(?:void|int|\))') AS own FROM documents)
SELECT count(*)::BIGINT AS n, count(*) FILTER (own)::BIGINT AS n_flagged, round(count(*) FILTER (own) / count(*), 6)::DOUBLE AS share, count(*) FILTER (own) / count(*) < 0.05 AS ok FROM f
""")
def own_main_share(spark, sf_dir):
    """The share of sources that define their own main function."""
    rows = _docs(spark, sf_dir).select(F.concat(_one_of(_MAIN, F.col("doc_id")), F.col("text")).alias("code"))
    return evals.share_above(rows, gates.has_main(F.col("code")))


@query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, CASE doc_id % 2 WHEN 0 THEN '  return ' || doc_id ELSE 'def f(x):' || chr(10) || '  return ' || doc_id END AS code FROM documents)
SELECT doc_id AS row_id, 'import re' || chr(10) || chr(10) || CASE doc_id % 2 WHEN 0 THEN 'def f(x):' || chr(10) || '  # ' || text || chr(10) || code ELSE code END || chr(10) || chr(10) || 'check = print' || chr(10) || chr(10) || 'check(f)' || chr(10) AS whole,
  code || chr(10) || chr(10) || 'check = print' || chr(10) AS paired FROM d
""")
def program_assembly(spark, sf_dir):
    """Programs from code or from a prompt and its completion, and solution with tests."""
    n = F.col("doc_id").cast("string")
    code = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("  return "), n)).otherwise(F.concat(F.lit("def f(x):\n  return "), n))
    whole = execgate.completed_program(code, F.concat(F.lit("def f(x):\n  # "), F.col("text")), F.lit("check = print"), F.lit("f"), "import re\n")
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), whole.alias("whole"), execgate.program(code, F.lit("check = print")).alias("paired"))


# tool calls


@query(f"""
WITH {_USERS}
SELECT row_id, row_id % 5 = 0 AS ok, CASE WHEN row_id % 5 = 4 THEN 0 ELSE 1 END::INT AS n_calls, CASE row_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'search: missing q' WHEN 2 THEN 'unknown tool other' WHEN 3 THEN 'search.n: not integer' ELSE 'no call' END AS errors FROM u
""")
def tool_call_validate(spark, sf_dir):
    """User turns as arguments of calls: right, without a needed one, of an unknown tool, of a wrong type, and no call at all."""
    call = lambda name, *args: F.concat(F.lit(f'<tool_call>{{"name":"{name}","arguments":'), F.to_json(F.struct(*args)), F.lit("}</tool_call>"))
    q, n, k = F.col("text").alias("q"), F.col("turn").alias("n"), F.col("row_id") % 5
    said = F.when(k == 0, call("search", q, n)).when(k == 1, call("search", n)).when(k == 2, call("other", q)).when(k == 3, call("search", q, F.lit(True).alias("n"))).otherwise(F.col("text"))
    checked = _user_turns(spark, sf_dir).select("row_id", calls.checked(said, F.lit(TOOLS)).alias("c"))
    return checked.select("row_id", "c.ok", F.size("c.calls").alias("n_calls"), F.array_join("c.errors", "; ").alias("errors"))


def _replies(spark, sf_dir) -> DataFrame:
    """User turns as structured calls, as calls in a text, as broken ones, and as plain text."""
    args, k = F.to_json(F.struct(F.col("text").alias("q"))), F.col("row_id") % 4
    made = F.when(k == 0, F.array(F.struct(F.lit("search").alias("name"), args.alias("arguments")))).when(k == 2, F.array(F.struct(F.lit("search").alias("name"), F.lit("{bad").alias("arguments")))).cast(CALLS)
    said = F.when(k == 1, F.concat(F.lit('<tool_call>{"name":"search","arguments":'), args, F.lit("}</tool_call>"))).when(k == 3, F.col("text"))
    rows = _user_turns(spark, sf_dir).select("row_id", made.alias("structured"), said.alias("content"), F.when(F.col("row_id") % 3 != 0, "search").alias("expect_tool"))
    return rows.withColumn("calls", calls.normalized(F.col("structured"), F.col("content")))


@query(f"WITH {_USERS} SELECT row_id, 'search' AS name, CASE WHEN row_id % 4 < 2 THEN text END AS q FROM u WHERE row_id % 4 < 3")
def calls_normalized(spark, sf_dir):
    """Structured calls, else those in the text; bad arguments are {}."""
    return _replies(spark, sf_dir).select("row_id", F.explode("calls").alias("c")).select("row_id", "c.name", F.try_variant_get(F.try_parse_json("c.arguments"), "$.q", "string").alias("q"))


@query(f"""
WITH {_USERS}
SELECT 'named' AS axis, count(*) FILTER (row_id % 4 < 3 AND row_id % 3 <> 0)::BIGINT AS passed, count(*)::BIGINT AS total FROM u
UNION ALL SELECT 'tools', count(*) FILTER (CASE WHEN row_id % 3 = 0 THEN row_id % 4 = 3 ELSE row_id % 4 < 2 END)::BIGINT, count(*)::BIGINT FROM u
""")
def calls_scored(spark, sf_dir):
    """The axes that ask for a tool by name, and for a valid call (or none)."""
    rows = _replies(spark, sf_dir)
    named = evals.tally(evals.score_calls(rows)).withColumn("axis", F.lit("named"))
    valid = F.transform("calls", lambda c: F.size(calls.faults(c["name"], c["arguments"], calls.declared(F.lit(TOOLS)))) == 0)
    return named.unionByName(evals.tally(evals.score_tools(rows.withColumn("valid", valid))).withColumn("axis", F.lit("tools"))).select("axis", "passed", "total")


@query("""
WITH t AS (SELECT *, turn = max(turn) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AND role = 'assistant' AND conv_id % 3 = 0 AS calls, turn = max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations),
c AS (SELECT conv_id, bool_or(calls) AS tool_turn, count(*) >= 2 AND bool_and(NOT calls AND coalesce(trim(text), '') <> '') AS valid, count(*) >= 2 AND bool_or(last AND NOT calls AND coalesce(trim(text), '') <> '') AS closed FROM t GROUP BY conv_id)
SELECT conv_id AS row_id, coalesce(tool_turn, false) AS tool_turn, valid, CASE WHEN conv_id % 2 = 0 OR coalesce(tool_turn, false) THEN closed ELSE valid END AS ok FROM c
""")
def tool_turns(spark, sf_dir):
    """Conversations, of which every third has a call for its last assistant turn, and every second is of tools."""
    rows = conversations(spark, sf_dir)
    last = F.array_max(F.filter(F.transform("messages", lambda m, i: F.when(m["role"] == "assistant", i)), lambda i: i.isNotNull()))
    call = F.array(F.struct(F.lit("f").alias("name"), F.lit("{}").alias("arguments"))).cast(CALLS)
    turned = F.transform("messages", lambda m, i: F.when((F.col("row_id") % 3 == 0) & (i == F.col("_last")), m.withField("tool_calls", call).withField("content", F.lit(""))).otherwise(m))
    rows = rows.withColumn("_last", last).select("row_id", F.when(F.col("row_id") % 2 == 0, "tools").otherwise("chat").alias("kind"), turned.cast(MESSAGES).alias("messages"))
    m = F.col("messages")
    return rows.select("row_id", gates.has_tool_turn(m).alias("tool_turn"), gates.valid_messages(m).alias("valid"), gates.row_ok(m, F.col("kind")).alias("ok"))


@query(rf"""
WITH q AS (SELECT conv_id, {_STRIP.format("coalesce(arg_min(text, turn) FILTER (role = 'user'), '')")} AS q FROM conversations GROUP BY conv_id),
s AS (SELECT conv_id, q, ['tools', 'multi', 'query'][conv_id % 3 + 1] AS tag, CASE conv_id % 3 WHEN 2 THEN '' ELSE 't' || conv_id % 2 END AS x FROM q)
SELECT min(conv_id)::BIGINT AS row_id, tag FROM s WHERE tag <> 'query' OR q <> '' GROUP BY tag, x, q UNION ALL SELECT conv_id, tag FROM s WHERE tag = 'query' AND q = ''
""")
def distinct_by_kind(spark, sf_dir):
    """The first conversation of each signature: tools by what is offered, scenarios by type, others by their query alone."""
    k, name = F.col("row_id") % 3, F.concat(F.lit("t"), (F.col("row_id") % 2).cast("string"))
    kind = F.when(k == 0, "tools").when(k == 1, "multi").otherwise("chat")
    rows = conversations(spark, sf_dir).select("row_id", mix.signature(F.col("messages"), kind, F.when(k == 1, name), F.when(k == 0, F.array(name))).alias("sig"))
    return mix.distinct_by(rows, "sig", "row_id").select("row_id", F.col("sig.tag").alias("tag"))


# texts, fences, markup


_JSON = r"CASE WHEN regexp_matches(t, '(?s)```(?:json)?[\t-\r ]*(\{{.*{0}\}})[\t-\r ]*```') THEN regexp_extract(t, '(?s)```(?:json)?[\t-\r ]*(\{{.*{0}\}})[\t-\r ]*```', 1) ELSE regexp_extract(t, '(?s)(\{{.*\}})', 1) END"
_CODE = r"(?s)```[a-zA-Z0-9+#.\-]*\n(.*?)```"


@query(rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS s, '{{"a":' || doc_id || '}}' AS j, chr(10) AS n FROM documents),
t AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN s || n || '```json' || n || j || n || '```' WHEN 1 THEN s || ' {{"b":' || j || '}} end' WHEN 2 THEN s WHEN 3 THEN s || n || '```c' || n || 'int x;' || n || '```'
  WHEN 4 THEN s || n || '```json' || n || j || n || '``` and ```json' || n || '{{"b":2}}' || n || '```' ELSE s || n || '```c' || n || '```' END AS t FROM d),
x AS (SELECT doc_id, t, {_JSON.format('?')} AS l, {_JSON.format('')} AS g FROM t)
SELECT doc_id AS row_id, CASE WHEN json_valid(l) THEN json(l)::VARCHAR END AS lazy, CASE WHEN json_valid(g) THEN json(g)::VARCHAR END AS greedy, CASE WHEN regexp_matches(t, '{_CODE}') THEN regexp_extract(t, '{_CODE}', 1) ELSE t END AS code FROM x
""")
def text_extracts(spark, sf_dir):
    """JSON and code from whole documents as replies: in a fence, among words, none, in a fence of code, in the first of two fences, and in an empty fence."""
    s, k = F.coalesce("text", F.lit("")), F.col("doc_id") % 6
    j = F.concat(F.lit('{"a":'), F.col("doc_id").cast("string"), F.lit("}"))
    ends = [(F.lit("\n```json\n"), j, F.lit("\n```")), (F.lit(' {"b":'), j, F.lit("} end")), (), (F.lit("\n```c\nint x;\n```"),), (F.lit("\n```json\n"), j, F.lit('\n``` and ```json\n{"b":2}\n```')), (F.lit("\n```c\n```"),)]
    t = F.concat(s, *ends[5])
    for i, end in enumerate(ends[:5]):
        t = F.when(k == i, F.concat(s, *end)).otherwise(t)
    t, rows = F.col("t"), _docs(spark, sf_dir).select("doc_id", t.alias("t"))
    return rows.select(F.col("doc_id").alias("row_id"), F.to_json(tx.extract_json(t, greedy=False)).alias("lazy"), F.to_json(tx.extract_json(t)).alias("greedy"), tx.extract_code(t).alias("code"))


@query(rf"""
WITH d AS (SELECT doc_id, replace(coalesce(text, ''), '`', '') AS s FROM documents),
t AS (SELECT doc_id, s, CASE doc_id % 3 WHEN 0 THEN '```c' || chr(10) || s || chr(10) || '```' WHEN 1 THEN 'say ```c' || chr(10) || s || chr(10) || '```' ELSE s END AS t FROM d)
SELECT doc_id AS row_id, CASE doc_id % 3 WHEN 0 THEN s ELSE {_STRIP.format('t')} END AS bare, CASE WHEN doc_id % 3 < 2 THEN s || chr(10) END AS fenced FROM t
""")
def fence_strip(spark, sf_dir):
    """Documents as fenced blocks, whole and after words, and without a fence."""
    s, k = F.replace("text", F.lit("`")), F.col("doc_id") % 3
    t = F.when(k == 0, F.concat(F.lit("```c\n"), s, F.lit("\n```"))).when(k == 1, F.concat(F.lit("say ```c\n"), s, F.lit("\n```"))).otherwise(s)
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), tx.strip_fence(t).alias("bare"), tx.extract_fenced(t).alias("fenced"))


@query(rf"""
SELECT doc_id AS row_id, CASE WHEN {_STRIP.format("coalesce(text, '')")} <> '' THEN {_STRIP.format("coalesce(text, '')")} || chr(10) || chr(10) ELSE '' END || '```python' || chr(10) || 'x = ' || doc_id || chr(10) || '```' AS reply FROM documents
""")
def prefenced_reply(spark, sf_dir):
    """A document as intro of a block of code."""
    block = F.concat(F.lit("x = "), F.col("doc_id").cast("string"), F.lit("\n"))
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), asm.prefenced_reply(F.col("text"), block, F.lit("python")).alias("reply"))


@query("""
SELECT page_id, 'data:image/svg+xml,%3Csvg xmlns=''http://www.w3.org/2000/svg'' width=''' || page_id % 500 || ''' height=''' || length(html) || '''%3E%3Crect width=''100%25'' height=''100%25'' fill=''red''/%3E%3Ctext x=''50%25'' y=''50%25''%3Ep' || page_id || '%3C/text%3E%3C/svg%3E' AS uri,
  replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS plain FROM pages
""")
def svg_and_entities(spark, sf_dir):
    """Pages with their basic entities decoded, and a picture of each as a URI."""
    uri = tx.svg_uri(F.col("page_id") % 500, F.length("html"), F.lit("red"), F.concat(F.lit("p"), F.col("page_id").cast("string")))
    return table(spark, sf_dir, "pages").select("page_id", uri.alias("uri"), tx.unescape_html(F.col("html")).alias("plain"))


# grids


def _names(spark, sf_dir, name: str, column: str) -> list[str]:
    """The values of a small table of names: regions and nations don't grow."""
    return sorted(r[0] for r in table(spark, sf_dir, name).select(column).distinct().limit(1000).collect())


@query("SELECT r_name AS region, n_name AS nation, t::BIGINT AS task FROM region, nation, range(6) c(t)")
def param_grid(spark, sf_dir):
    """The product of regions, nations and task numbers."""
    cells = asm.grid(spark, region=_names(spark, sf_dir, "region", "r_name"), nation=_names(spark, sf_dir, "nation", "n_name"), task=list(range(6)))
    return cells.select("region", "nation", F.col("task").cast("long").alias("task"))


@query("SELECT n_name AS nation, d AS difficulty, 'Write of ' || n_name || ', ' || d || '.' || CASE n_name WHEN 'NATION_0' THEN ' Name no main city.' ELSE '' END AS prompt FROM nation, (VALUES ('easy'), ('hard')) b(d)")
def prompt_grid(spark, sf_dir):
    """Prompts of all cells of a grid, with a suffix by nation."""
    cells = asm.grid(spark, nation=_names(spark, sf_dir, "nation", "n_name"), difficulty=["easy", "hard"])
    return asm.templated(cells, "Write of {nation}, {difficulty}.", suffixes={"nation": {"NATION_0": " Name no main city."}}).select("nation", "difficulty", "prompt")


# scenarios

_TYPES = ["subtask", "recall", "modeswitch", "revise", "enrich", "research", "other"]


def _scenarios(spark, sf_dir) -> DataFrame:
    """Documents as answers and tool results of scenarios; some offer no such tool, change nothing, or have broken markup."""
    n, text = F.col("doc_id"), F.col("text")
    page = F.concat(F.lit("<p>"), n.cast("string"), F.lit("</p>"))
    given = {
        "query": F.lit("Do it"), "deliverable_html": F.when(n % 11 == 0, "<div>").otherwise(page), "tool_name": F.when(n % 5 == 0, "other").otherwise("search"), "arguments": F.lit('{"q":"x"}'), "tool_result": text,
        "q1": F.lit("a"), "a1": text, "q2": F.lit("b"), "a2": text, "tool1": F.lit("search"), "args1": F.lit('{"q":"1"}'), "tool2": F.lit("search"), "args2": F.lit('{"q":"2"}'), "artifact_request": F.lit("Make it"), "artifact_html": page,
        "followup_question": F.lit("Why"), "followup_answer": text, "change_request": F.lit("Change"), "revised_html": F.when(n % 3 == 0, page).otherwise("<p>new</p>"), "enrich_request": F.lit("Add"), "research_request": F.lit("Find"), "answer": text,
    }
    fields = [given.get(f, F.lit(None).cast("string")).alias(f) for f in asm.FIELDS]
    return _docs(spark, sf_dir).select(n.alias("row_id"), _one_of(_TYPES, n).alias("mtype"), F.lit(TOOLS).alias("tools"), *fields)


_SCENARIOS = rf"""
s AS (SELECT doc_id AS row_id, {_sql_list(_TYPES)}[doc_id % 7 + 1] AS mtype, {_PROSE.format("coalesce(text, '')")} AS prose, doc_id % 5 <> 0 AS known, doc_id % 3 <> 0 AS changed, doc_id % 11 <> 0 AS sound FROM documents),
a AS (SELECT *, CASE mtype WHEN 'subtask' THEN known AND sound WHEN 'recall' THEN prose WHEN 'modeswitch' THEN prose WHEN 'revise' THEN changed WHEN 'enrich' THEN changed AND known WHEN 'research' THEN prose AND known ELSE false END AS usable FROM s)
"""


@query(f"""
WITH {_SCENARIOS}
SELECT row_id, mtype, CASE WHEN NOT usable THEN 0 ELSE CASE mtype WHEN 'recall' THEN 8 WHEN 'enrich' THEN 6 WHEN 'research' THEN 6 ELSE 4 END END::INT AS n_turns,
  CASE WHEN usable THEN CASE mtype WHEN 'subtask' THEN 'user,assistant,tool,assistant' WHEN 'recall' THEN 'user,assistant,tool,assistant,user,assistant,tool,assistant' WHEN 'enrich' THEN 'user,assistant,user,assistant,tool,assistant' WHEN 'research' THEN 'user,assistant,user,assistant,tool,assistant' ELSE 'user,assistant,user,assistant' END END AS roles,
  usable AND mtype IN ('subtask', 'recall', 'enrich', 'research') AS has_tools FROM a
""")
def assemble_multi(spark, sf_dir):
    """Scenario objects as conversations."""
    out = asm.assemble(_scenarios(spark, sf_dir))
    return out.select("row_id", "mtype", F.coalesce(F.size("messages"), F.lit(0)).alias("n_turns"), F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), F.col("tools_spec").isNotNull().alias("has_tools"))


@query(f"""
WITH {_SCENARIOS}
SELECT mtype, count(*) FILTER (usable)::BIGINT AS assembled, count(*)::BIGINT AS total, count(*) FILTER (usable AND mtype IN ('subtask', 'recall', 'enrich', 'research'))::BIGINT AS with_call, count(*) FILTER (usable AND mtype IN ('subtask', 'revise', 'enrich'))::BIGINT AS final_fenced FROM a GROUP BY mtype
""")
def preflight(spark, sf_dir):
    """Of the scenarios of each type: how many could be assembled, hold a call, and end with a fence."""
    return evals.preflight(asm.assemble(_scenarios(spark, sf_dir)))


@query(rf"""
WITH t AS (SELECT conv_id, turn, text, CASE WHEN conv_id % 2 = 0 AND role = 'assistant' AND turn = max(turn) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) THEN 'tool' ELSE role END AS role FROM conversations),
u AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM t WHERE role = 'user'),
second AS (SELECT t.conv_id, t.turn, text, {_STRIP.format(r"regexp_replace(coalesce(text, ''), '(?i)^\s*(no[,.]?\s+|actually[,.]?\s+|stop (making|creating) (documents?|docs?)[;,.]?\s*|instead[,.]?\s*|skip (the )?(doc|document|html|page)[,.:—-]*\s*|forget (the )?(doc|html|page)[,.:—-]*\s*)+', '')")} AS cut FROM t JOIN u ON u.conv_id = t.conv_id AND u.turn = t.turn AND k = 2 WHERE t.conv_id % 3 <> 0),
o AS (SELECT conv_id, turn, text, CASE WHEN length(cut) < 12 THEN {_STRIP.format('text')} ELSE cut END AS s FROM second)
SELECT conv_id AS row_id, CASE conv_id % 3 WHEN 0 THEN 'enrich' ELSE 'research' END AS mtype, count(*)::INT AS n_turns, count(*) FILTER (role = 'tool')::INT AS n_tool_turns, arg_min(text, turn) AS opening FROM t GROUP BY conv_id
UNION ALL SELECT o.conv_id, 'freshresearch', count(*)::INT, count(*) FILTER (role = 'tool')::INT, any_value(CASE WHEN s = '' THEN o.text ELSE upper(left(s, 1)) || substr(s, 2) END) FROM o JOIN t ON t.conv_id = o.conv_id AND t.turn >= o.turn GROUP BY o.conv_id
""")
def freshresearch(spark, sf_dir):
    """Conversations whose last reply is a tool's in every second one: tool results inflated, research rows doubled with a fresh opening."""
    rows = conversations(spark, sf_dir)
    last = F.array_max(F.filter(F.transform("messages", lambda m, i: F.when(m["role"] == "assistant", i)), lambda i: i.isNotNull()))
    turned = F.transform("messages", lambda m, i: F.when((F.col("row_id") % 2 == 0) & (i == F.col("_last")), m.withField("role", F.lit("tool"))).otherwise(m))
    rows = rows.withColumn("_last", last).select("row_id", turned.cast(MESSAGES).alias("messages"), F.when(F.col("row_id") % 3 == 0, "enrich").otherwise("research").alias("mtype"))
    rows = asm.with_fresh_research(asm.inflate_tool_turns(rows))
    noisy = F.size(F.filter("messages", lambda m: (m["role"] == "tool") & m["content"].startswith('[{"type":"text","text":"#1 (primary source')))
    return rows.select("row_id", "mtype", F.size("messages").alias("n_turns"), noisy.alias("n_tool_turns"), F.col("messages")[0]["content"].alias("opening"))


# scorers of replies


@query("""
WITH p AS (SELECT regexp_extract(url, '/([a-z]{2})/', 1) AS variant, NOT contains(html, '<b>') AND contains(lower(html), '<!doctype') AND contains(lower(html), '</html>') AS ok FROM pages)
SELECT variant, count(*) FILTER (ok)::BIGINT AS passed, count(*)::BIGINT AS total FROM p GROUP BY variant
""")
def web_scored(spark, sf_dir):
    """Pages as fenced replies by the language in their address: sound markup (theirs leaves <b> open, if anything), a whole document, and what it has to hold."""
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "/([a-z]{2})/", 1).alias("variant"), F.concat(F.lit("```html\n"), F.col("html"), F.lit("\n```")).alias("content"), F.lit(True).alias("full"), F.array(F.lit("<article"), F.lit("</html>\\s*$")).alias("must_contain"), udfs.html_lint("html").alias("errors"))
    return evals.tally(evals.score_web(pages), "variant")


@query(rf"""
WITH a AS (SELECT {_PROSE.format('text')} AS prose, text, conv_id FROM conversations WHERE role = 'assistant')
SELECT 'modeswitch' AS axis, count(*) FILTER (prose AND (conv_id % 4 > 0 OR contains(lower(text), 'zz')))::BIGINT AS passed, count(*)::BIGINT AS total FROM a
UNION ALL SELECT 'prose', count(*) FILTER (prose AND NOT regexp_matches(text, '(?i)<(?:!doctype|html|body|div|p|h[1-6]|ul|table|span|section|head)\b'))::BIGINT, count(*)::BIGINT FROM a
""")
def prose_scored(spark, sf_dir):
    """Assistant turns on the axes that want prose: with keywords, and plain."""
    need = F.when(F.col("conv_id") % 4 == 0, F.array(F.left("text", F.lit(3)), F.lit("zz"))).otherwise(F.array(F.left("text", F.lit(3))))
    rows = table(spark, sf_dir, "conversations").where("role = 'assistant'").select(F.col("text").alias("content"), need.alias("must_include"))
    axes = [evals.tally(score(rows)).withColumn("axis", F.lit(name)) for name, score in (("modeswitch", evals.score_modeswitch), ("prose", evals.score_prose))]
    return axes[0].unionByName(axes[1]).select("axis", "passed", "total")


# files and orders

_FILE = "CASE WHEN doc_id % 13 = 0 THEN 0 WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END"


def _files(spark, sf_dir) -> list[str]:
    """documents as chat rows in JSON lines, in three folders of unlike sizes with rows by doc_id; their paths, the last one first."""
    turns = F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content")))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.expr(_FILE).alias("file"), F.lit("chat").alias("kind"), "lang", turns.alias("messages"))
    base = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sinks.write_split(rows.repartitionByRange(parts, "file", "doc_id").sortWithinPartitions("file", "doc_id"), base, "file")
    return [f"{base}/file={i}" for i in (2, 0, 1)]


_ORDERED = f"r AS (SELECT doc_id, lang, text, (row_number() OVER (ORDER BY ({_FILE} + 1) % 3, doc_id) - 1)::BIGINT AS row_id FROM documents)"


@query(f"WITH {_ORDERED} SELECT row_id, lang, length(text)::BIGINT AS n_chars FROM r")
def lines_in_order(spark, sf_dir):
    """Files of JSON lines read back as records, each with the number of its line in a sequential read."""
    found = records.read(spark, _files(spark, sf_dir))
    return found.select("row_id", "lang", F.length(F.element_at("messages", 2)["content"]).cast("long").alias("n_chars"))


@query(f"WITH {_ORDERED} SELECT row_id, lang FROM r WHERE row_id < 25")
def first_lines(spark, sf_dir):
    """The first lines of several files: a top-k."""
    return records.parse(records.head(records.lines(spark, _files(spark, sf_dir)), 25))[0].select("row_id", "lang")


@query("SELECT doc_id, (row_number() OVER (ORDER BY sha256('3407:' || doc_id::VARCHAR), doc_id) - 1)::BIGINT AS position FROM documents")
def shuffled_positions(spark, sf_dir):
    """Documents in the seeded order."""
    return mix.shuffled(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "position")


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS position, (sum(event_id % 7) OVER (ORDER BY ts, event_id))::BIGINT AS score_upto FROM events")
def running_totals(spark, sf_dir):
    """Events in the order of time, with a running sum."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("event_id") % 7).alias("score"))
    return ordering.running(rows, "ts", "event_id", sums=["score"]).select("event_id", "position", "score_upto")
