"""Cases of the library's expressions: constant rows, and what is expected of them as SQL."""

import duckdb
import pytest
from pyspark.sql import DataFrame, functions as F

from millrace.functions import calls, gates, text as tx
from millrace.operators import assemble as asm, evals, execgate, mix
from millrace.plans.queries import TOOLS
from millrace.sources.records import CALLS, MESSAGES

CASES = {}


def expected(columns: str, rows: list[tuple]) -> str:
    """SQL of constant rows: what a query over constants has to give. columns: names and DuckDB types."""

    def literal(x) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return str(x).lower()
        return str(x) if isinstance(x, int | float) else "'" + str(x).replace("'", "''") + "'"

    names, kinds = zip(*(c.split() for c in columns.split(", ")), strict=True)
    picked = ", ".join(f"{n}::{k} AS {n}" for n, k in zip(names, kinds, strict=True))
    return f"SELECT {picked} FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) v({', '.join(names)})"


def query(sql: str):
    """Keep a function under its name with the SQL of its rows."""

    def add(f):
        CASES[f.__name__] = (f, sql)
        return f

    return add


#: C sources, one per family of symbols, with and without the include.
C_ROWS = [
    (0, "#include <limits.h>\nint f(void) { return INT_MAX; }"), (1, "int f(void) { return INT_MAX; }"), (2, "int f(int c) { return isdigit(c); }"), (3, "double f(double x) { return sqrt(x); }"),
    (4, "// sqrt\nint f(void) { return 0; }"), (5, "/* malloc */ int f(void) { return 1; }"), (6, "#include <string.h>\nint f(char *s) { return strlen(s) + isalpha(*s); }"), (7, "bool f(uint8_t x) { return x; }"), (8, "// #include <math.h>\ndouble f(double x) { return pow(x, 2); }"),
]
@query(r"""
WITH c(row_id, code) AS (VALUES (0, '#include <limits.h>' || chr(10) || 'int f(void) { return INT_MAX; }'), (1, 'int f(void) { return INT_MAX; }'), (2, 'int f(int c) { return isdigit(c); }'), (3, 'double f(double x) { return sqrt(x); }'),
  (4, '// sqrt' || chr(10) || 'int f(void) { return 0; }'), (5, '/* malloc */ int f(void) { return 1; }'), (6, '#include <string.h>' || chr(10) || 'int f(char *s) { return strlen(s) + isalpha(*s); }'), (7, 'bool f(uint8_t x) { return x; }'), (8, '// #include <math.h>' || chr(10) || 'double f(double x) { return pow(x, 2); }')),
h(header, pattern) AS (VALUES ('limits.h', '\b(INT_MAX|INT_MIN|UINT_MAX|LONG_MAX|LONG_MIN|CHAR_BIT)\b'), ('ctype.h', '\b(isalpha|isdigit|isalnum|isspace|isupper|islower|toupper|tolower|ispunct)\b'), ('math.h', '\b(sqrt|pow|fabs|floor|ceil|round|log|sin|cos|tan|exp)\b'),
  ('stdbool.h', '\b(bool|true|false)\b'), ('stdint.h', '\b(uint8_t|uint16_t|uint32_t|uint64_t|int8_t|int16_t|int32_t|int64_t)\b'), ('stdlib.h', '\b(malloc|calloc|realloc|free|strtol|strtod|qsort)\b'), ('string.h', '\b(strlen|strcpy|strncpy|strcmp|strncmp|strcat|memcpy|memset|memmove|strchr|strstr)\b')),
s AS (SELECT row_id, code, regexp_replace(regexp_replace(code, '(?s)/\*.*?\*/', ' ', 'g'), '//[^\n]*', ' ', 'g') AS bare FROM c),
m AS (SELECT row_id, header FROM s, h WHERE regexp_matches(bare, pattern) AND NOT contains(code, '#include <' || header || '>'))
SELECT s.row_id::BIGINT AS row_id, coalesce(string_agg(header, ',' ORDER BY header), '') AS missing FROM s LEFT JOIN m ON s.row_id = m.row_id GROUP BY s.row_id
""")
def header_lint(spark, sf_dir):
    rows = spark.createDataFrame(C_ROWS, "row_id long, code string")
    return rows.select("row_id", F.array_join(gates.missing_headers(F.col("code")), ",").alias("missing"))


CALL_ROWS = [
    (0, '<tool_call>{"name":"search","arguments":{"q":"a","n":3}}</tool_call>'), (1, '<tool_call>{"name":"search","arguments":{"n":3}}</tool_call>'), (2, '<tool_call>{"name":"other","arguments":{}}</tool_call>'), (3, '<tool_call>{"name":"search","arguments":{"q":"a","n":true}}</tool_call>'),
    (4, "<tool_call>{bad}</tool_call>"), (5, "plain"), (6, '<tool_call>{"name":"flat"}</tool_call><tool_call>{"name":"flat","arguments":{"x":"y","z":1}}</tool_call>'), (7, '<tool_call>{"name":"search","arguments":[1]}</tool_call>'), (8, None),
]
@query(expected("row_id BIGINT, ok BOOLEAN, n_calls INT, errors VARCHAR", [
    (0, True, 1, ""), (1, False, 1, "search: missing q"), (2, False, 1, "unknown tool other"), (3, False, 1, "search.n: not integer"), (4, False, 0, "bad json; no call"),
    (5, False, 0, "no call"), (6, True, 2, ""), (7, False, 0, "arguments not an object; no call"), (8, False, 0, "no text; no call"),
]))
def tool_call_validate(spark, sf_dir):
    rows = spark.createDataFrame([(i, t, TOOLS) for i, t in CALL_ROWS], "row_id long, text string, spec string")
    checked = rows.select("row_id", calls.checked(F.col("text"), F.col("spec")).alias("c"))
    return checked.select("row_id", "c.ok", F.size("c.calls").alias("n_calls"), F.array_join("c.errors", "; ").alias("errors"))


@query("SELECT l AS lang, d AS difficulty, t::BIGINT AS task FROM (VALUES ('Python'), ('C')) a(l), (VALUES ('easy'), ('medium'), ('hard')) b(d), range(6) c(t)")
def param_grid(spark, sf_dir):
    return asm.grid(spark, lang=["Python", "C"], difficulty=["easy", "medium", "hard"], task=list(range(6))).select("lang", "difficulty", F.col("task").cast("long").alias("task"))


def _research(spark) -> DataFrame:
    turn = lambda role, content, calls=None: (role, content, "string", calls)
    long = [turn("user", "Make a page"), turn("assistant", "```html\n<p>x</p>\n```"), turn("user", "Actually, stop making documents; search for tides"), turn("assistant", "", [("search", '{"query":"tides"}')]), turn("tool", '[{"type":"text","text":"High at noon"}]'), turn("assistant", "High tide is at noon today, says the table.")]
    short = [turn("user", "Only one"), turn("assistant", "Reply")]
    return spark.createDataFrame([(0, long, "research"), (1, short, "research"), (2, long, "enrich")], f"row_id long, messages {MESSAGES}, mtype string")


@query(expected("row_id BIGINT, mtype VARCHAR, n_turns INT, n_tool_turns INT, opening VARCHAR", [
    (0, "research", 6, 1, "Make a page"), (1, "research", 2, 0, "Only one"), (2, "enrich", 6, 1, "Make a page"), (0, "freshresearch", 4, 1, "Search for tides"),
]))
def freshresearch(spark, sf_dir):
    """Tool results inflated, research rows doubled with a fresh opening."""
    rows = asm.with_fresh_research(asm.inflate_tool_turns(_research(spark)))
    noisy = F.size(F.filter("messages", lambda m: (m["role"] == "tool") & m["content"].startswith('[{"type":"text","text":"#1 (primary source')))
    return rows.select("row_id", "mtype", F.size("messages").alias("n_turns"), noisy.alias("n_tool_turns"), F.col("messages")[0]["content"].alias("opening"))


#: One usable scenario of each type, and unusable ones.
_P1, _P2 = "<div><p>One</p></div>", "<div><p>Two</p></div>"
_SAY = "This is a plain answer of some length."
_BASE = {"tools": TOOLS, "tool_name": "search", "arguments": '{"q":"x"}', "tool_result": "r", "artifact_request": "Make it", "artifact_html": _P1}
SCENARIOS = [
    _BASE | {"mtype": "subtask", "query": "Do it", "deliverable_html": _P1}, _BASE | {"mtype": "recall", "q1": "a", "a1": _SAY, "q2": "b", "a2": _SAY, "tool1": "search", "args1": '{"q":"1"}', "tool2": "search", "args2": '{"q":"2"}'},
    _BASE | {"mtype": "modeswitch", "followup_question": "Why", "followup_answer": _SAY}, _BASE | {"mtype": "revise", "change_request": "Change", "revised_html": _P2}, _BASE | {"mtype": "enrich", "enrich_request": "Add", "revised_html": _P2}, _BASE | {"mtype": "research", "research_request": "Find", "answer": _SAY},
    _BASE | {"mtype": "modeswitch", "followup_question": "Why", "followup_answer": "```\nx\n```" + _SAY}, _BASE | {"mtype": "subtask", "query": "Do it", "deliverable_html": _P1, "tool_name": "other"}, _BASE | {"mtype": "revise", "change_request": "Change", "revised_html": _P1}, _BASE | {"mtype": "other"}, _BASE | {"mtype": "enrich", "enrich_request": "Add", "revised_html": _P2, "tools": '[{"description":"nameless"}]'},
]
def scenarios(spark) -> DataFrame:
    names = ["mtype", "tools", *asm.FIELDS]
    return spark.createDataFrame([(i, *(s.get(n) for n in names)) for i, s in enumerate(SCENARIOS)], "row_id long, " + ", ".join(f"{n} string" for n in names))


_CALLED = "user,assistant,tool,assistant"
@query(expected("row_id BIGINT, mtype VARCHAR, n_turns INT, roles VARCHAR, has_tools BOOLEAN", [
    (0, "subtask", 4, _CALLED, True), (1, "recall", 8, f"{_CALLED},{_CALLED}", True), (2, "modeswitch", 4, "user,assistant,user,assistant", False), (3, "revise", 4, "user,assistant,user,assistant", False),
    (4, "enrich", 6, f"user,assistant,{_CALLED}", True), (5, "research", 6, f"user,assistant,{_CALLED}", True), (6, "modeswitch", 0, None, False), (7, "subtask", 0, None, False), (8, "revise", 0, None, False), (9, "other", 0, None, False), (10, "enrich", 0, None, False),
]))
def assemble_multi(spark, sf_dir):
    """Scenario objects as conversations."""
    out = asm.assemble(scenarios(spark))
    return out.select("row_id", "mtype", F.coalesce(F.size("messages"), F.lit(0)).alias("n_turns"), F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), F.col("tools_spec").isNotNull().alias("has_tools"))


def turn(role: str, content: str | None, made: list[tuple] | None = None, kind: str = "string") -> tuple:
    return (role, content, kind, made)


_CALL = '<tool_call>{"name":"search","arguments":{"q":"%s"}}</tool_call>'
#: Structured calls, reply, offered tools and the tool that is wanted.
_REPLIES = [
    (0, [("search", '{"q":"a"}')], None, "search"), (1, None, _CALL % "b", "search"), (2, [("search", "{bad")], None, "search"), (3, [("search", '"{\\"q\\":\\"c\\"}"')], _CALL % "d", "search"),
    (4, None, "no call at all", "search"), (5, None, "no call is right", None), (6, None, _CALL % "e", None), (7, [("other", "[1]")], None, "search"),
]
def _replies(spark) -> DataFrame:
    rows = spark.createDataFrame(_REPLIES, f"row_id long, structured {CALLS}, content string, expect_tool string")
    return rows.withColumn("calls", calls.normalized(F.col("structured"), F.col("content")))


@query(expected("row_id BIGINT, name VARCHAR, arguments VARCHAR", [(0, "search", '{"q":"a"}'), (1, "search", '{"q":"b"}'), (2, "search", "{}"), (3, "search", '{"q":"c"}'), (6, "search", '{"q":"e"}'), (7, "other", "{}")]))
def calls_normalized(spark, sf_dir):
    """Structured calls, else those in the text; bad arguments are {}."""
    return _replies(spark).select("row_id", F.explode("calls").alias("c")).select("row_id", "c.name", "c.arguments")


@query(expected("axis VARCHAR, passed BIGINT, total BIGINT", [("named", 4, 8), ("tools", 4, 8)]))
def calls_scored(spark, sf_dir):
    """The axes that ask for a tool by name, and for a valid call (or none)."""
    rows = _replies(spark)
    named = evals.tally(evals.score_calls(rows)).withColumn("axis", F.lit("named"))
    valid = F.transform("calls", lambda c: F.size(calls.faults(c["name"], c["arguments"], calls.declared(F.lit(TOOLS)))) == 0)
    return named.unionByName(evals.tally(evals.score_tools(rows.withColumn("valid", valid))).withColumn("axis", F.lit("tools"))).select("axis", "passed", "total")


#: Rows of kinds with and without calls.
_TURNS = [
    (0, "tools", [turn("user", "q"), turn("assistant", "", [("f", "{}")]), turn("tool", "r"), turn("assistant", "done")]), (1, "tools", [turn("user", "q"), turn("assistant", " ")]),
    (2, "chat", [turn("user", "q"), turn("assistant", None, None, "null")]), (3, "chat", [turn("user", "q"), turn("assistant", "a")]), (4, "multi", [turn("user", "q"), turn("assistant", "", [("f", "{}")])]), (5, "chat", []),
]
@query(expected("row_id BIGINT, tool_turn BOOLEAN, valid BOOLEAN, ok BOOLEAN", [(0, True, False, True), (1, False, False, False), (2, False, False, False), (3, False, True, True), (4, True, False, False), (5, False, False, False)]))
def tool_turns(spark, sf_dir):
    rows = spark.createDataFrame(_TURNS, f"row_id long, kind string, messages {MESSAGES}")
    m = F.col("messages")
    return rows.select("row_id", gates.has_tool_turn(m).alias("tool_turn"), gates.valid_messages(m).alias("valid"), gates.row_ok(m, F.col("kind")).alias("ok"))


_ASK = [turn("user", " q "), turn("assistant", "", [("f", "{}")])]
_KINDS = [(1, _ASK, "tools", None, ["a", "b"]), (2, _ASK, "tools", None, ["b", "a"]), (3, _ASK, "tools", None, ["a"]), (4, _ASK, "multi", "revise", None), (5, _ASK, "multi", "enrich", None), (6, _ASK, "multi", "enrich", None), (7, _ASK[:1], "chat", None, None), (8, _ASK[:1], "code", None, None), (9, [turn("user", "")], "code", None, None), (10, [], "code", None, None)]
@query(expected("row_id BIGINT, tag VARCHAR", [(1, "tools"), (3, "tools"), (4, "multi"), (5, "multi"), (7, "query"), (9, "query"), (10, "query")]))
def distinct_by_kind(spark, sf_dir):
    """The first row of each signature, by kind: tools by name and first call, scenarios by type."""
    rows = spark.createDataFrame(_KINDS, f"row_id long, messages {MESSAGES}, kind string, mtype string, tools array<string>")
    rows = rows.withColumn("sig", mix.signature(F.col("messages"), F.col("kind"), F.col("mtype"), F.col("tools")))
    return mix.distinct_by(rows, "sig", "row_id").select("row_id", F.col("sig.tag").alias("tag"))


_TEXTS = [
    (0, 'Sure:\n```json\n{"a":1}\n```', '{"a":1}', '{"a":1}', '{"a":1}\n'), (1, 'x {"a":{"b":2}} y', '{"a":{"b":2}}', '{"a":{"b":2}}', 'x {"a":{"b":2}} y'), (2, "nothing", None, None, "nothing"),
    (3, "```c\nint x;\n```", None, None, "int x;\n"), (4, '```json\n{"a":1}\n``` and ```json\n{"b":2}\n```', '{"a":1}', None, '{"a":1}\n'), (5, "```c\n```", None, None, ""), (6, None, None, None, ""),
]
@query(expected("row_id BIGINT, lazy VARCHAR, greedy VARCHAR, code VARCHAR", [(i, a, b, c) for i, _, a, b, c in _TEXTS]))
def text_extracts(spark, sf_dir):
    """JSON by a lazy and a greedy fence, and code, from replies."""
    t = F.col("t")
    rows = spark.createDataFrame([(i, x) for i, x, *_ in _TEXTS], "row_id long, t string")
    return rows.select("row_id", F.to_json(tx.extract_json(t, greedy=False)).alias("lazy"), F.to_json(tx.extract_json(t)).alias("greedy"), tx.extract_code(t).alias("code"))


_FENCES = [(0, "```c\nx\n```", "x", "x\n"), (1, " ```c++\nx\n``` ", "x", "x\n"), (2, "say ```c\nx\n```", "say ```c\nx\n```", "x\n"), (3, " y ", "y", None), (4, "```c\n```", "", "")]
@query(expected("row_id BIGINT, bare VARCHAR, fenced VARCHAR", [(i, a, b) for i, _, a, b in _FENCES]))
def fence_strip(spark, sf_dir):
    rows = spark.createDataFrame([(i, x) for i, x, *_ in _FENCES], "row_id long, t string")
    return rows.select("row_id", tx.strip_fence(F.col("t")).alias("bare"), tx.extract_fenced(F.col("t")).alias("fenced"))


_MESSAGES = [(0, "'NULL' undeclared; is defined in header '<stdio.h>'; unknown type name 'bool'", "stdbool.h,stddef.h,stdio.h"), (1, "unknown type name 'size_t'", "stddef.h"), (2, "'zig' undeclared", ""), (3, "is defined in header '<math.h>' is defined in header '<math.h>'", "math.h")]
@query(expected("row_id BIGINT, headers VARCHAR", [(i, h) for i, _, h in _MESSAGES]))
def compiler_hints(spark, sf_dir):
    rows = spark.createDataFrame([(i, m) for i, m, _ in _MESSAGES], "row_id long, m string")
    return rows.select("row_id", F.array_join(gates.hinted_headers(F.col("m")), ",").alias("headers"))


_MAINS = [(0, "int main(void) {}", True), (1, "main() {", True), (2, "MAIN( int argc", True), (3, "main(void)", True), (4, "void  main (x)", True), (5, "int remain(void)", False), (6, "domain(x)", False), (7, "main(x)", False), (8, None, False)]
@query(expected("n BIGINT, n_flagged BIGINT, share DOUBLE, ok BOOLEAN", [(9, sum(x for *_, x in _MAINS), 0.555556, False)]))
def own_main_share(spark, sf_dir):
    """The share of sources that define their own main function."""
    rows = spark.createDataFrame([(i, c) for i, c, _ in _MAINS], "row_id long, code string")
    return evals.share_above(rows, gates.has_main(F.col("code")))


@query(expected("uri VARCHAR, plain VARCHAR", [("data:image/svg+xml,%3Csvg xmlns='http://www.w3.org/2000/svg' width='2' height='3'%3E%3Crect width='100%25' height='100%25' fill='red'/%3E%3Ctext x='50%25' y='50%25'%3Ea%3C/text%3E%3C/svg%3E", "<p>&</p>")]))
def svg_and_entities(spark, sf_dir):
    one = spark.range(1)
    return one.select(tx.svg_uri(F.lit(2), F.lit(3), F.lit("red"), F.lit("a")).alias("uri"), tx.unescape_html(F.lit("&lt;p&gt;&amp;&lt;/p&gt;")).alias("plain"))


@query("""
SELECT lang, task::BIGINT AS task, 'Write a ' || d || ' task no. ' || task || ' in ' || lang || '.' || CASE lang WHEN 'C' THEN ' No main function.' ELSE '' END AS prompt
FROM (VALUES ('Python'), ('C')) a(lang), (VALUES ('easy'), ('hard')) b(d), range(3) c(task)
""")
def prompt_grid(spark, sf_dir):
    """Prompts of all cells of a grid, with a suffix by language."""
    cells = asm.grid(spark, lang=["Python", "C"], difficulty=["easy", "hard"], task=list(range(3)))
    made = asm.templated(cells, "Write a {difficulty} task no. {task} in {lang}.", suffixes={"lang": {"C": " No main function."}})
    return made.select("lang", F.col("task").cast("long").alias("task"), "prompt")


_PROGRAMS = [(0, "def f(x):\n  return x", "def f(x):", "check = print", "f"), (1, "  return x", "def f(x):", "check = print", "f"), (2, "def ff(x): pass", "def f(x):", "t", "f"), (3, "def a.b(): pass", "p", "t", "a.b")]
@query(expected("row_id BIGINT, whole VARCHAR, paired VARCHAR", [
    (0, "import re\n\ndef f(x):\n  return x\n\ncheck = print\n\ncheck(f)\n", "def f(x):\n  return x\n\ncheck = print\n"), (1, "import re\n\ndef f(x):\n  return x\n\ncheck = print\n\ncheck(f)\n", "  return x\n\ncheck = print\n"),
    (2, "import re\n\ndef f(x):\ndef ff(x): pass\n\nt\n\ncheck(f)\n", "def ff(x): pass\n\nt\n"), (3, "import re\n\ndef a.b(): pass\n\nt\n\ncheck(a.b)\n", "def a.b(): pass\n\nt\n"),
]))
def program_assembly(spark, sf_dir):
    """Programs from code or from a prompt and its completion, and solution with tests."""
    rows = spark.createDataFrame(_PROGRAMS, "row_id long, code string, prompt string, tests string, entry string")
    whole = execgate.completed_program(F.col("code"), F.col("prompt"), F.col("tests"), F.col("entry"), "import re\n")
    return rows.select("row_id", whole.alias("whole"), execgate.program(F.col("code"), F.col("tests")).alias("paired"))


@query(expected("row_id BIGINT, reply VARCHAR", [(0, "Hi\n\n```python\nx = 1\n```"), (1, "```python\nx\n```")]))
def prefenced_reply(spark, sf_dir):
    rows = spark.createDataFrame([(0, " Hi ", "x = 1\n"), (1, "", "x")], "row_id long, intro string, block string")
    return rows.select("row_id", asm.prefenced_reply(F.col("intro"), F.col("block"), F.lit("python")).alias("reply"))


@query(expected("mtype VARCHAR, assembled BIGINT, total BIGINT, with_call BIGINT, final_fenced BIGINT", [("enrich", 1, 2, 1, 1), ("modeswitch", 1, 2, 0, 0), ("other", 0, 1, 0, 0), ("recall", 1, 1, 1, 0), ("research", 1, 1, 1, 0), ("revise", 1, 2, 0, 1), ("subtask", 1, 2, 1, 1)]))
def preflight(spark, sf_dir):
    """Of the scenarios of each type: how many could be assembled, hold a call, and end with a fence."""
    return evals.preflight(asm.assemble(scenarios(spark)))



@pytest.mark.parametrize("name", list(CASES))
def test_rows_are_as_expected(spark, name):
    run, sql = CASES[name]
    df = run(spark, None)
    found = duckdb.sql(sql)
    assert sorted(found.columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(found.columns).collect()))) == sorted(map(repr, found.fetchall()))


def test_text_extracts_keeps_the_braces_and_fences_of_documents(spark, tmp_path):
    from millrace.plans import tables  # noqa: F401  (registers its queries)
    from millrace.plans.queries import QUERIES, SQL

    texts = ['see {"k":1} x', 'a `b` {c', 'x {"k": 2} y', '```json\n{"k":3}\n``` z', '```json\n{"k":4}\n```', None, 'no {"k":', None, '```py\nq\n```', "", "{}", "`"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.row_id: (r.lazy, r.greedy, r.code) for r in QUERIES["text_extracts"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == {i: tuple(x) for i, *x in con.execute(SQL["text_extracts"]).fetchall()}
    assert got[2] == ('{"k":2}', '{"k":2}', 'x {"k": 2} y') and got[4][0] == '{"k":4}' and got[4][1] is None and got[8][2] == "q\n"
