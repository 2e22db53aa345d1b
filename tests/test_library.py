"""Case tables of the library's operators: inputs and what is expected."""

import json
import random
import time
from datetime import datetime
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row, functions as F

from millrace.functions import calls, fuzzy, gates, markup, text as tx, udfs
from millrace.operators import assemble as asm, dedup, evals, execgate, mix
from millrace.plans import inline, queries as plans, tables  # noqa: F401  (these register queries)
from millrace.sources import records, sinks
from millrace.streaming import monitor

from . import test_cases

SF = "/root/testdata/sf0.001"
MESSAGES = records.MESSAGES


def turn(role, content, kind="string", calls=None):
    return (role, content, kind, calls)


def one(spark, column, *values):
    """The value of an expression over columns a, b, ..."""
    names = "abcdefgh"[: len(values)]
    return spark.createDataFrame([values], ", ".join(f"{n} {'boolean' if isinstance(v, bool) else 'string'}" for n, v in zip(names, values, strict=True))).select(column.alias("x")).first()["x"]


def over(spark, column, messages, kind=None, lang=None):
    return spark.createDataFrame([(messages, kind, lang)], f"messages {MESSAGES}, kind string, lang string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations", "pages", "events", "region", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = plans.QUERIES[name](spark, SF).toPandas(), con.sql(plans.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda p: sorted(tuple(str(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in p[sorted(p.columns)].itertuples(index=False))
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_other_queries_run(spark, name):
    assert plans.QUERIES[name](spark, SF).columns


@pytest.mark.parametrize(("value", "want"), [("  A\t\nB ", "a b"), ("x y", "x y"), ("x\x1cy", "x y"), ("ÉÀ", "éà"), ("", "")])
def test_norm(spark, value, want):
    assert one(spark, tx.norm(F.col("a")), value) == want


def test_heldout_is_bytes_up_to_seven(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k")).select(tx.hash_byte(F.col("k")).alias("b"), tx.is_heldout(F.col("k")).alias("h")).collect()
    assert all(r.h == (r.b <= 7) for r in rows) and {r.b for r in rows} > {7, 8}


@pytest.mark.parametrize(
    ("messages", "want"),
    [
        ([turn("user", "a"), turn("assistant", "b")], True), ([turn("user", "a")], False), (None, False), ([turn("user", "a"), turn("assistant", None, "null")], False), ([turn("user", "a"), turn("assistant", "  ")], False),
        ([turn("user", "a"), turn("assistant", '{"x":1}', "other")], False), ([turn("user", "a"), turn("assistant", "5", "other")], False), ([turn("user", "a"), turn("assistant", None, "missing")], False),
    ],
)
def test_valid_messages(spark, messages, want):
    assert over(spark, gates.valid_messages(F.col("messages")), messages) is want


@pytest.mark.parametrize(
    ("kind", "messages", "want"),
    [
        ("tools", [turn("user", "q"), turn("assistant", "", calls=[("f", "{}")]), turn("assistant", "done")], True), ("tools", [turn("user", "q"), turn("assistant", " ")], False),
        ("chat", [turn("user", "q"), turn("assistant", None, "null")], False), ("tools", [turn("user", "q"), turn("assistant", None, "missing")], False),
    ],
)
def test_row_ok(spark, kind, messages, want):
    assert over(spark, gates.row_ok(F.col("messages"), F.col("kind")), messages, kind) is want


LONG = "A helpful answer that is long enough to count here."


@pytest.mark.parametrize(
    ("messages", "want"),
    [
        ([turn("user", "q"), turn("assistant", LONG)], True), ([turn("system", "q"), turn("assistant", LONG)], False), ([turn("user", "q"), turn("assistant", "short")], False), ([turn("user", "q"), turn("user", "q"), turn("assistant", LONG)], False),
        ([turn("user", "q"), turn("assistant", " I cannot help with this, and it is a long refusal.")], False), ([turn("user", "q"), turn("assistant", LONG), turn("user", "r"), turn("assistant", LONG)], True), ([turn("user", "q"), turn("tool", "r")], False),
    ],
)
def test_good_chat(spark, messages, want):
    assert over(spark, gates.good_chat(F.col("messages")), messages) is want


@pytest.mark.parametrize(
    ("code", "want"),
    [("int f(){return INT_MAX;}", ["limits.h"]), ("#include <limits.h>\nint f(){return INT_MAX;}", []), ("// sqrt\n/* pow */", []), ("// #include <math.h>\nsqrt(2)", []), ("bool b; int8_t x; malloc(1); strlen(s); isdigit(c);", ["ctype.h", "stdbool.h", "stdint.h", "stdlib.h", "string.h"]), (None, [])],
)
def test_missing_headers(spark, code, want):
    assert one(spark, gates.missing_headers(F.col("a")), code) == want


@pytest.mark.parametrize(
    ("html", "hard"),
    [("<!doctype html><html><body><p>x</p></body></html>", 0), ("<div></span></div>", 1), ("<div><b>x", 1), ("<div><b>x</div>", 1), ("<ul><li>a<li>b</ul><br>", 0), ("</p>", 1), ("", 1), (None, 1), ("<svg/>", 0)],
)
def test_html_errors(html, hard):
    assert len(udfs.html_errors(html)) == hard


@pytest.mark.parametrize("name", ["script", "style"])
def test_html_that_ends_in_a_raw_element_has_an_error(name):
    assert udfs.html_errors(f"<p>hi</p><{name}>var x = 1;") == [f"unclosed at end: {name}"]
    assert udfs.html_errors(f"<{name}>if (a<b) '</p>'</{name.upper()} ><p>x") == []


@pytest.mark.parametrize("piece", ["<script ", "<script>", "<a ", "<p>", "<div><p>", "<a b='", '<a b="', "<a b=", "<!--", "<!", "</", "<", "<b></i>", "</p>", "<br/ "])
def test_html_errors_take_linear_time(piece):
    def seconds(size):
        text, began = piece * (size // len(piece)), time.process_time()
        udfs.html_errors(text)
        return time.process_time() - began

    assert seconds(1_000_000) < 5 and seconds(1_000_000) < 40 * seconds(100_000) + 0.1


class _Events(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        self.found.append(("open", tag))

    def handle_startendtag(self, tag, attrs):
        self.found.append(("empty", tag))

    def handle_endtag(self, tag):
        self.found.append(("close", tag))


def test_scan_gives_what_the_standard_parser_gives_on_random_markup():
    pieces = ["<p>", "</p>", "<div class='a>b'>", "</div>", "<b>", "</b>", "<br/>", "<br>", "<script>", "</script>", "<style>", "</style>", "text", "<!-- <p> -->", "<a href=x/>", "</a>", "< 3", "&amp;", '<img alt="<p>">', "<svg/>", "</SCRIPT >", "<!doctype html>", "<?x?>", "<x-y z>", "</x-y>", "</>", "\n", "<A HREF='q'>"]
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choices(pieces, k=draw.randint(1, 14)))
        parser = _Events()
        parser.feed(text)
        parser.close()
        assert [(kind, name) for kind, name, _ in markup.scan(text) if kind != "text"] == parser.found, text



def test_whole_documents_need_a_doctype(spark):
    assert one(spark, udfs.is_valid_html(F.col("a"), allow_fragment=False), "<p>x</p>") is False
    assert one(spark, udfs.is_valid_html(F.col("a"), allow_fragment=False), "<!doctype html><html></html>") is True


def test_soft_issues(spark):
    assert one(spark, gates.html_soft_issues(F.col("a")), "<form><img src=x></form>") == ["form without label", "img without alt"]
    assert one(spark, gates.html_soft_issues(F.col("a")), "<form><label>x</label></form><img alt=y>") == []


@pytest.mark.parametrize(
    ("text", "required", "ok"),
    [
        ('<tool_call>{"name":"search","arguments":{"q":"a","n":1}}</tool_call>', True, True), ('<tool_call>{"name":"search","arguments":{"q":"a","extra":1}}</tool_call>', True, True), ('<tool_call>{"name":"search","arguments":{"q":1}}</tool_call>', True, False), ('<tool_call>{"name":"search","arguments":{"q":"a","n":true}}</tool_call>', True, False),
        ("none", True, False), ("none", False, True), ("<tool_call>{x}</tool_call>", False, False), ('<tool_call>{"name":"nope"}</tool_call>', True, False), ('<tool_call>{"arguments":{}}</tool_call>', True, False),
    ],
)
def test_tool_calls(spark, text, required, ok):
    assert one(spark, calls.checked(F.col("a"), F.col("b"), required)["ok"], text, plans.TOOLS) is ok


def test_last_declaration_of_a_name_counts(spark):
    got = one(spark, calls.declared(F.col("a")), '[{"name":"a","parameters":{"required":["x"]}},{"function":{"name":"a"}}]')
    assert got == {"a": "{}"}


@pytest.mark.parametrize("spec", ["no json", "5", '"x"', "{}", "[]", "[1, null, []]", '[{"name":5}]', '[{"name":"search","parameters":"x"}]', '[{"name":"search","parameters":{"properties":"x"}}]', '[{"name":"search","parameters":{"properties":[1],"required":"q"}}]', '[{"name":"search","parameters":{"properties":{"q":3},"required":[5,null]}}]', '[{"function":7,"name":"search"}]'])
def test_odd_tool_lists_are_errors_of_a_row(spark, spec):
    known = "search" in spec
    r = one(spark, calls.checked(F.col("a"), F.col("b")), '<tool_call>{"name":"search","arguments":{"q":"a","n.o":[1]}}</tool_call>', spec)
    assert r.ok is known and r.errors == ([] if known else ["unknown tool search"])


def test_types_of_arguments(spark):
    spec = json.dumps([{"name": "f", "parameters": {"properties": {k: {"type": k} for k in calls.TYPES} | {"odd": {"type": "thing"}, "two": {"type": ["string"]}}}}])
    good = {"string": "x", "number": 1.5, "integer": 3, "boolean": True, "array": [1], "object": {"a": 1}, "null": None, "odd": 1, "two": 2, "more": 3}
    bad = {"string": 1, "number": "1", "integer": 1.5, "boolean": 0, "array": {}, "object": [], "null": 0}
    said = lambda args: one(spark, calls.checked(F.col("a"), F.col("b")), f'<tool_call>{json.dumps({"name": "f", "arguments": args})}</tool_call>', spec)
    assert said(good).errors == [] and sorted(said(bad).errors) == sorted(f"f.{k}: not {k}" for k in bad)
    assert said({"number": 7, "integer": 10**25}).errors == [] and said({"integer": True, "number": False}).ok is False


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("a b c", "c b a", 100), ("a a b", "a b", 100), ("a b", "a b c d", 100), ("", "a", 0), (None, "a", 0), ("abc", "xyz", 0)],
)
def test_token_set_ratio_identities(a, b, want):
    assert udfs.token_set_ratio(a, b) == want == udfs.token_set_ratio(b, a)


def test_token_set_ratio_against_the_definition():
    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            last = 0
            for j, d in enumerate(y):
                last, row[j + 1] = row[j + 1], (last + 1 if c == d else max(row[j + 1], row[j]))
        return row[-1]

    def plain(a, b):
        x, y = set(a.split()), set(b.split())
        i, l, r = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
        p, q = (i + " " + l).strip(), (i + " " + r).strip()
        ratio = lambda s, t: 200 * lcs(s, t) / (len(s) + len(t))
        return max([ratio(p, q), *([ratio(i, p), ratio(i, q)] if i else [])])

    for a, b in [("red fox runs", "red box ran"), ("one two three", "four two five"), ("alpha beta", "alpha betas"), ("xx yy", "zz ww yx")]:
        assert udfs.token_set_ratio(a, b) == pytest.approx(plain(a, b))
        assert udfs.token_set_ratio(a, b, 92) in (0.0, pytest.approx(plain(a, b)))


@pytest.mark.parametrize(("text", "whole"), [('{"a":1}', True), (' {"a":[1]} ', True), ("5", True), ('{"a":1} x', False), ('{"a":1}{"b":2}', False), ('{"a":1},{"b":2}', False), ('{"a":1}] x', False), ('{"a":1}} x', False), ('{"a":1}, "k": 2', False), ("", False), ("{", False), (None, False)])
def test_strict_json(spark, text, whole):
    assert (one(spark, F.to_json(tx.strict_json(F.col("a"))), text) is not None) is whole


@pytest.mark.parametrize(("text", "want"), [("```html\nx```", True), ("<p>x</p>", False), ("`a` and ```b``` inline", False), (None, False)])
def test_fences(spark, text, want):
    assert one(spark, tx.has_fence(F.col("a")), text) is want


def test_fenced_text(spark):
    assert one(spark, tx.extract_fenced(F.col("a")), "```c\n```") == ""
    assert one(spark, tx.extract_fenced(F.col("a")), "none") is None
    assert one(spark, tx.extract_code(F.col("a")), "```c\nx\n``` ```c\ny\n```") == "x\n"
    assert one(spark, tx.strip_fence(F.col("a")), "```html\n<p>\n```") == "<p>"
    assert one(spark, tx.as_fenced_reply(F.col("a"), F.col("b"), F.lit("c")), " hi ", "x ") == "hi\n\n```c\nx\n```"
    assert one(spark, tx.as_fenced_reply(F.col("a"), F.col("b"), F.lit("c")), "hi", "```c\nx\n```") == "```c\nx\n```"
    assert one(spark, F.to_json(tx.extract_json(F.col("a"))), 'Sure: ```json\n{"a":{"b":1}}\n```') == '{"a":{"b":1}}'
    assert one(spark, F.to_json(tx.extract_json(F.col("a"))), 'text {"a":1} more') == '{"a":1}'
    assert one(spark, F.to_json(tx.extract_json(F.col("a"))), "no") is None
    assert one(spark, tx.unescape_html(F.col("a")), "&lt;p&gt;&amp;") == "<p>&"


@pytest.mark.parametrize(("code", "want"), [("<a><b><c><d></a>", False), ("<a>\n  <b>\n<c>\n<d>\n", True), ("<a>", True), ("", False), (None, False), ("<a>\n<b>\n<c>\n<d>\n", False)])
def test_multiline(spark, code, want):
    assert one(spark, gates.is_multiline(F.col("a")), code) is want


@pytest.mark.parametrize(("text", "prose", "plain"), [("This is a sentence of enough length.", True, True), ("short", False, False), ("Long enough text with a <p>tag</p> inside", True, False), ("x" * 30 + "<tool_call>", False, False)])
def test_prose(spark, text, prose, plain):
    assert one(spark, gates.is_prose(F.col("a")), text) is prose and one(spark, gates.is_plain_prose(F.col("a")), text) is plain


def test_detectors(spark):
    assert one(spark, gates.is_document(F.col("a")), "<li>x") is True and one(spark, gates.is_plain_prose(F.col("a")), "a text with <li>item and more words") is True
    assert one(spark, gates.is_placeholder(F.col("a")), "x\n# TODO later") is True and one(spark, gates.is_placeholder(F.col("a")), "x = [...]") is False
    assert one(spark, gates.has_main(F.col("a")), "int main(void){}") is True
    assert one(spark, gates.no_call(F.col("a")), "<tool_call>") is False
    assert one(spark, gates.hinted_headers(F.col("a")), "'NULL' undeclared; is defined in header '<stdio.h>'; unknown type name 'bool'") == ["stdbool.h", "stddef.h", "stdio.h"]
    assert one(spark, gates.all_match(F.col("a"), F.array(F.lit("H.llo"), F.lit("w"))), "hello W") is True


@pytest.mark.parametrize(
    ("stderr", "main", "want"),
    [("redefinition of 'main'", False, "dup_main"), ("multiple definition of `main'", False, "dup_main"), ("multiple definition of `f'", False, "other"), ("in main: expected ;", True, "dup_main"), ("in main: expected ;", False, "syntax"), ("implicit declaration", False, "missing_include"), ("incomplete type", False, "unknown_type"), ("conflicting types", False, "signature"), ("undefined reference", False, "link"), ("?", False, "other")],
)
def test_compile_buckets(spark, stderr, main, want):
    assert one(spark, gates.compile_bucket(F.col("a"), F.col("b")), stderr, main).startswith(want)


def test_jsonl_keeps_the_kind_of_content(spark, tmp_path):
    rows = [{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": {"a": 1}}], "kind": "chat"}, {"messages": [{"role": "user", "content": None}, {"role": "assistant"}], "tests": ["a"]},
            {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "", "tool_calls": [{"function": {"name": "f", "arguments": {"x": 1}}}]}, {"role": "assistant", "content": "ok"}], "kind": "tools", "tests": "t", "needs_tool": True}]
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join(map(json.dumps, rows)) + "\n\n{bad\n[1]\n")
    good, bad = records.parse(records.lines(spark, str(path)))
    got = good.orderBy("row_id").collect()
    assert [[m.content_type for m in r.messages] for r in got] == [["string", "other"], ["null", "missing"], ["string", "string", "string"]]
    assert got[2].messages[1].tool_calls == [Row(name="f", arguments='{"x":1}')] and got[2].needs_tool is True
    assert got[1].tests == '["a"]' and got[2].tests == "t" and bad.count() == 2
    assert records.count_lines(spark, str(path)) == 5 and records.count_lines(spark, str(tmp_path / "none")) == 0
    text, skipped = records.rendered(good)
    assert text.count() == 1 and skipped.first()["skipped"] == 2
    assert records.first_existing(spark, [str(tmp_path / "none"), str(path)]).count() == 5
    with pytest.raises(ValueError):
        records.read(spark, str(path), strict=True)


def test_suite_and_sinks(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"web": [{"prompt": "a"}, {"prompt": "b"}], "chat": [{"prompt": "c"}]}))
    assert sorted((r.axis, r.item_id) for r in records.suite(spark, str(tmp_path / "s.json")).collect()) == [("chat", 0), ("web", 0), ("web", 1)]
    df = spark.createDataFrame([(1, "a", "train"), (2, None, "heldout")], "id int, t string, split string")
    sinks.write_jsonl(df, str(tmp_path / "o"))
    sinks.write_jsonl(df, str(tmp_path / "o"), "append")
    assert records.lines(spark, str(tmp_path / "o")).count() == 4
    sinks.write_split(df, str(tmp_path / "p"))
    assert {p.name for p in (tmp_path / "p").glob("split=*")} == {"split=train", "split=heldout"}
    sinks.append_results(df, str(tmp_path / "r"))
    assert [r.line for r in sinks.markdown(df).orderBy("line_no", "line").collect()][:2] == ["| id | t | split |", "|---|---|---|"]
    sinks.concatenate([spark.read.text(str(tmp_path / "o"))] * 2, str(tmp_path / "c"))
    assert spark.read.text(str(tmp_path / "c")).count() == 8
    (tmp_path / "m.md").write_text("x ```html\n&lt;p&gt;\n``` y")
    assert records.fenced_of_transcript(spark, str(tmp_path / "m.md")).first()["block"] == "<p>\n"


def test_recent_texts_score_as_pairs_do():
    rng = random.Random(2)
    vocab = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"] + [f"w{i}" for i in range(60)]
    texts = []
    for i in range(300):
        words = rng.sample(vocab, rng.randrange(1, 25)) if i % 3 or not texts else [w if rng.random() > 0.08 else w + "s" for w in rng.choice(texts)]
        texts.append(words)
    sets = [frozenset(t) for t in texts]
    recent, n = fuzzy.Recent(40, 92.0), 0
    for i, s in enumerate(sets):
        want = [j for j in range(max(0, i - 40), i) if udfs.token_sets_ratio(s, sets[j], 92.0) >= 92]
        assert recent.matches(s) == want and bool(recent.matches(s, first=True)) == bool(want)
        recent.push(i, s)
        n += len(want)
    assert n > 50


def test_common_subsequences_end_early():
    assert udfs.lcs_length("abcbdab" * 20, "bdcaba" * 20) == udfs.lcs_length("bdcaba" * 20, "abcbdab" * 20)
    assert udfs.lcs_length("abcbdab", "bdcaba") == 4 and udfs.lcs_length("", "a") == 0
    assert udfs.lcs_length("a" * 500, "b" * 400, 100) < 100 and udfs.lcs_length("ab" * 300, "ab" * 300, 600) == 600


def test_window_dedup_looks_beyond_what_was_scored(spark):
    # near copies of one text fill the scored stretch, so the kept ones reach farther back
    base = ["m" * 9, "n" * 9, "o" * 9, "p" * 9]
    texts = ["first text of all", "second other thing here"] + [" ".join([*base, f"x{i}"]) for i in range(30)] + ["first text of all too", "first text of all"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    kept, last, want = set(), [], []
    for t in texts:
        v = "exact" if t in kept else "near" if any(udfs.token_set_ratio(t, k) >= 92 for k in last[-4:]) else "kept"
        want.append(v)
        if v == "kept":
            kept.add(t)
            last.append(t)
    assert [r.verdict for r in dedup.window_dedup(rows, "id", window=4).orderBy("id").collect()] == want and want.count("near") > 20


def test_window_dedup_replays_the_sequential_rule(spark):
    texts = ["a b c", "A  b c", "", "c b a x", "z", "a b c"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert [r.verdict for r in dedup.window_dedup(rows, "id").orderBy("id").collect()] == ["kept", "exact", "empty", "near", "kept", "exact"]
    # a key dropped as near is kept once the window has moved on
    rows = spark.createDataFrame(list(enumerate(["a b c", "a b c d", "q", "a b c d"])), "id long, text string")
    assert [r.verdict for r in dedup.window_dedup(rows, "id", window=1).orderBy("id").collect()] == ["kept", "near", "kept", "kept"]


def sequential(texts, window):
    """(verdicts) of the rule, one row after the other."""
    kept, last, out = set(), [], []
    for t in texts:
        key = " ".join((t or "").split())
        v = "empty" if not key else "exact" if key in kept else "near" if any(udfs.token_set_ratio(key, k) >= 92 for k in last[-window:]) else "kept"
        out.append(v)
        if v == "kept":
            kept.add(key)
            last.append(key)
    return out


@pytest.mark.parametrize(("seed", "window", "few", "chunk"), [(1, 1, 10**6, 1), (2, 5, 10**6, 1), (3, 40, 10**6, 1), (4, 20, 0, 12)])
def test_window_dedup_equals_the_replay_on_random_texts(spark, seed, window, few, chunk, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 7)
    draw = random.Random(seed)
    words = [draw.choice("abcdefgh") * draw.randint(2, 9) for _ in range(9)]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 4))) for _ in range(60)] + [None, ""]
    texts += [f"{words[0]} {words[1]} {draw.choice(['x', 'y', 'z'])}" for _ in range(20)] + texts[:20]
    rows = spark.createDataFrame([(f"{i:05d}", t) for i, t in enumerate(texts)], "id string, text string")
    got = [r.verdict for r in dedup.window_dedup(rows, "id", window=window, few=few, chunk=chunk).orderBy("id").collect()]
    assert got == sequential(texts, window) and {"kept", "near", "exact", "empty"} == set(got)


def test_window_dedup_is_dealt_by_blocks_and_settles_without_texts(spark):
    rows = spark.createDataFrame([(i, f"word{i} other{i}") for i in range(50)], "id long, text string")
    plan = dedup.window_dedup(rows, "id", few=0)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "FlatMapGroupsInPandas" not in plan
    assert dedup.window_dedup(rows.where("false"), "id").collect() == []


def test_near_pairs_equal_all_pairs_on_random_texts(monkeypatch):
    monkeypatch.setattr(fuzzy, "COLUMNS", 5)
    draw = random.Random(8)
    words = ["".join(draw.choices("abcd", k=draw.randint(1, 12))) for _ in range(30)]
    near = []
    for _ in range(60):
        base = draw.choices(words, k=draw.randint(1, 9))
        near.append(" ".join(base))
        near.append(" ".join(w if draw.random() < 0.8 else w[:-1] + draw.choice("abcd") for w in base))
    sets = [udfs.token_set(t) for t in [*near, ""]]
    allowed = np.array([[(i + j) % 5 > 0 for j in range(len(sets))] for i in range(len(sets))])
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if allowed[i, j] and udfs.token_sets_ratio(a, b) >= 92}
    assert set(zip(*(x.tolist() for x in fuzzy.near_pairs(sets, sets, 92.0, allowed)), strict=True)) == want and len(want) > 150


def _syllables(seed: int, n: int, words: int) -> list[str]:
    draw = random.Random(seed)
    parts = "th an er on re he in ed nd ha at en ou ea nt ti or st es ing tion ble".split()
    return [" ".join("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(words)) for _ in range(n)]


def test_pairs_of_long_texts_are_read_side_by_side_and_few_scored_one_by_one(monkeypatch):
    texts = _syllables(2, 24, 160)
    texts += [t[: len(t) // 2] + "zq " + t[len(t) // 2 :] for t in texts[:5]]
    sets = [udfs.token_set(t) for t in texts]
    allowed = np.arange(len(sets))[:, None] > np.arange(len(sets))
    want = {(i, j) for i, j in zip(*np.nonzero(allowed), strict=True) if udfs.token_sets_ratio(sets[i], sets[j]) >= 92}
    scored = []
    monkeypatch.setattr(fuzzy, "token_sets_ratio", lambda *a: scored.append(a) or udfs.token_sets_ratio(*a))
    assert set(zip(*(x.tolist() for x in fuzzy.near_pairs(sets, sets, 92.0, allowed)), strict=True)) == want and len(want) >= 5
    assert len(scored) <= len(want) + 2  # the profiles alone leave most of the 400 pairs


def test_reachable_loses_no_subsequence():
    draw = random.Random(3)
    pairs, least, right = [], [], []
    for _ in range(400):
        a = "".join(draw.choices("abcd efghé中", k=draw.choice([0, 1, 5, 63, 64, 65, 128, 129, 400])))
        b = list(a)
        for _ in range(draw.choice([0, 1, 3, 20, 100])):
            if b and draw.random() < 0.5:
                b.pop(draw.randrange(len(b)))
            else:
                b.insert(draw.randrange(len(b) + 1), draw.choice("abcd efghé中"))
        pairs.append((a, "".join(b)))
        have = udfs.lcs_length(*pairs[-1])
        least.append(max(0, have + draw.choice([-2, -1, 0, 0, 1, 2, 5, 40])))
        right.append(have >= least[-1])
    got = fuzzy.reachable([a for a, _ in pairs], [b for _, b in pairs], np.array(least))
    assert all(g for g, r in zip(got, right, strict=True) if r) and sum(g and not r for g, r in zip(got, right, strict=True)) < 40


def test_new_entries_are_held_against_their_blocks_alone(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 10)
    keys = _syllables(4, 10, 3) * 10
    entries = spark.createDataFrame([(i, i, k, i == 55) for i, k in enumerate(keys)], "at long, rank long, key string, fresh boolean")

    def some(left, right, near, allowed):
        assert allowed.any(), "a block without fresh entries"
        return fuzzy.near_pairs(left, right, near, allowed)

    monkeypatch.setattr(dedup, "near_pairs", some)
    got = dedup._near_pairs(entries, 92.0, 20, 20)
    assert sorted(tuple(r) for r in got.collect()) == [(55, 35), (55, 45), (65, 55), (75, 55)]


def test_near_links_count_the_rows_before(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "epsilon"]) for _ in range(rng.randint(0, 4))) for _ in range(120)]
    texts[7], texts[50] = None, texts[3]
    ids = sorted(rng.sample(range(1000), 120))
    rows = spark.createDataFrame(list(zip(ids, texts, strict=True)), "id long, text string")
    first = {}
    for i, text in zip(ids, texts, strict=True):
        if text:
            first.setdefault(" ".join(text.split()), i)
    kept = [(i, k) for k, i in first.items()]
    want = {}
    for n, (i, key) in enumerate(kept):
        found = [j for j, other in kept[max(0, n - 9) : n] if udfs.token_set_ratio(key, other) >= 92]
        want[i] = (len(found), found[0] if found else None)
    got = {r.id: (r.n_near, r.first_near) for r in dedup.near_links(rows, "id", window=9).collect()}
    assert got == want and any(n > 1 for n, _ in want.values())
    assert dedup.near_links(rows.limit(0), "id").count() == 0


def test_near_duplicate_queries_compare_whole_documents(spark):
    first, verdicts, kept, links = {}, {}, [], {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", tx.norm(F.col("text")).alias("key")).orderBy("doc_id").collect():
        if not r.key or r.key in first:
            # a key dropped as near is not remembered: its copies are near again
            verdicts[r.doc_id] = "empty" if not r.key else "exact" if first[r.key] in kept else "near"
            continue
        # fewer than 400 documents: the window holds all of them
        near = [i for k, i in first.items() if udfs.token_set_ratio(r.key, k) >= 92]
        links[r.doc_id] = (len(near), near[0] if near else None)
        verdicts[r.doc_id] = "near" if set(near) & set(kept) else "kept"
        first[r.key] = r.doc_id
        if verdicts[r.doc_id] == "kept":
            kept.append(r.doc_id)
    assert len(verdicts) <= 400 and any(n for n, _ in links.values())
    assert {r.row_id: r.verdict for r in plans.QUERIES["near_dup_window"](spark, SF).collect()} == verdicts
    assert {r.id: (r.n_near, r.first_near) for r in plans.QUERIES["near_dup_links"](spark, SF).collect()} == links


def test_decontamination(spark):
    rows = spark.createDataFrame([(1, "A b"), (2, "c d e"), (3, ""), (4, "other words")], "id long, text string")
    train = spark.createDataFrame([("a  B",), ("c d e f",)], "text string")
    assert sorted(r.id for r in dedup.decontaminate_exact(rows, train).collect()) == [2, 4]
    assert [r.id for r in dedup.decontaminate_fuzzy(rows, train, block=1, batch=2).collect()] == [4]
    assert [r.id for r in dedup.shared_keys(rows, train).collect()] == [1]


@pytest.mark.parametrize(("n", "fraction", "want"), [(1, 0.25, 1), (2, 0.25, 1), (6, 0.25, 2), (10, 0.25, 2), (4, 1.0, 4), (4, 0.0, 0)])
def test_replay_sizes(spark, n, fraction, want):
    df = spark.range(n).withColumn("lang", F.lit("x"))
    assert mix.replay(df, {"x": fraction}, "lang", "id").count() == want
    assert mix.replay(df, {"y": 1.0}, "lang", "id").count() == 0


def test_signatures(spark):
    user = [turn("user", " q "), turn("assistant", "", calls=[("f", "{}")])]
    rows = [(1, user, "tools", None, ["a", "b"]), (2, user, "tools", None, ["b", "a"]), (3, user, "tools", None, ["a"]), (4, user, "multi", "revise", None), (5, user, "multi", "enrich", None), (6, [turn("user", "q")], "chat", None, None), (7, [turn("user", "q")], "code", None, None), (8, [turn("user", "")], "code", None, None), (9, [], "code", None, None)]
    df = spark.createDataFrame(rows, f"id long, messages {MESSAGES}, kind string, mtype string, tools array<string>")
    df = df.withColumn("sig", mix.signature(F.col("messages"), F.col("kind"), F.col("mtype"), F.col("tools")))
    assert sorted(r.id for r in mix.distinct_by(df, "sig", "id").collect()) == [1, 3, 4, 5, 6, 8, 9]


def test_holdout_and_weights(spark):
    rows = mix.holdout_head(spark.range(10), "id")
    assert rows.where("split = 'heldout'").count() == 1 and rows.count() == 10
    assert mix.holdout_head(spark.range(0), "id").count() == 0
    df = spark.createDataFrame([("tools", None, None), ("multi", "research", True), (None, None, None)], "kind string, mtype string, img boolean")
    assert mix.upweight(df, mix.standard_rules()).count() == 1 + 5 * 8 + 1
    assert {r.kind: r.n for r in mix.composition(df).collect()} == {"tools": 1, "multi": 1, "?": 1}


@pytest.mark.parametrize(
    ("kind", "lang", "code", "want"),
    [("web", "HTML", "<!DOCTYPE html>", "Here's a complete, self-contained HTML page:\n\n```html\n<!DOCTYPE html>\n```"), ("code", "C", "x", "Here's the C solution:\n\n```c\nx\n```"), ("web", None, "<p>", "Here's the code:\n\n```html\n<p>\n```"), ("chat", "C", "x", "x"), ("code", "Rust", "x", "x"), ("code", "C", "```c\nx\n```", "```c\nx\n```")],
)
def test_normalized_rows(spark, kind, lang, code, want):
    assert over(spark, mix.normalized_messages(F.col("messages"), F.col("kind"), F.col("lang")), [turn("user", "q"), turn("assistant", code)], kind, lang)[1]["content"] == want


def test_scenarios(spark):
    got = {r.row_id: r for r in test_cases.assemble_multi(spark, None).collect()}
    assert [got[i].n_turns for i in range(11)] == [4, 8, 4, 4, 6, 6, 0, 0, 0, 0, 0]


def test_augmentation(spark):
    got = {(r.row_id, r.mtype): r for r in test_cases.freshresearch(spark, None).collect()}
    assert len(got) == 4 and got[0, "freshresearch"].opening == "Search for tides" and got[0, "freshresearch"].n_turns == 4
    rows = asm.inflate_tool_turns(test_cases._research(spark)).where("row_id = 0").first().messages
    blob = json.loads(rows[4].content)
    entries = blob[0]["text"].split("\n\n")
    assert "High at noon" in entries[0] and 15 <= len(entries) <= 23 and entries[0].startswith("#1 (primary source, rank score 1.000)")
    assert all(e.startswith(f"#{i + 1} (") and "{}" not in e for i, e in enumerate(entries))
    assert over(spark, asm.topic_hint(F.col("messages"), True), [turn("user", "u"), turn("assistant", "", calls=[("s", '{"query":"tides"}')])]) == "tides"
    assert over(spark, asm.topic_hint(F.col("messages")), []) == "the topic"
    for text, want in (("no, x", "No, x"), ("instead, look for the tide tables", "Look for the tide tables"), ("forget the doc: find the new dates", "Find the new dates")):
        assert one(spark, asm.fresh_opening(F.col("a")), text) == want


def test_evaluation(spark):
    df = spark.createDataFrame([(0, "C", True), (1, "C", False), (2, "Py", True)], "id long, lang string, pass boolean")
    assert {r.lang: (r.passed, r.total) for r in evals.pass_rates(df, "lang").collect()} == {"C": (1, 2), "Py": (1, 1), "ALL": (2, 3)}
    assert [r.rate for r in evals.running_rate(df, "id", "pass", parts=2).orderBy("id").collect()] == [1.0, 0.5, 0.666667]
    for n, want in ((1, (0, 0, 0)), (2, (1, 1, 1)), (20, (10, 19, 19)), (21, (10, 19, 20))):
        r = evals.exact_percentiles(spark.range(n), "id", {"p50": 0.5, "p95": 0.95}).first()
        assert (r.p50, r.p95, r.max) == want
    assert evals.keyword_rate(spark.createDataFrame([(0, 0)], "h int, n int"), "h", "n").first().rate == 1.0
    r = evals.rescued(spark.createDataFrame([(True, False), (False, True), (False, True)], "raw boolean, fixed boolean"), "raw", "fixed").first()
    assert (r.n_raw, r.n_fixed, r.n_rescued, r.n_gain) == (1, 2, 2, 1)
    assert evals.share_above(df, F.col("lang") == "Py").first().ok is False
    assert one(spark, tx.rate_text(F.lit(1), F.lit(2)), "x") == "1/2 (50%)" and one(spark, tx.rate_text(F.lit(1), F.lit(0)), "x") == "n/a"


def test_axes(spark):
    web = spark.createDataFrame([("```html\n<b>Hi</b>\n```", False, ["hi", "no"], [])], "content string, full boolean, must_contain array<string>, errors array<string>")
    r = evals.score_web(web).first()
    assert (r["pass"], r.fenced, r.missing) == (False, True, ["no"])
    calls = spark.createDataFrame([([("a",)], [True], "a"), ([], [], None), ([("a",)], [True], None), ([("a",)], [False], "a"), (None, None, None)], "calls array<struct<name:string>>, valid array<boolean>, expect_tool string")
    assert [x["pass"] for x in evals.score_tools(calls).collect()] == [True, True, False, False, True]
    assert [x["pass"] for x in evals.score_calls(calls).collect()] == [True, False, False, True, False]
    chat = spark.createDataFrame([("Say yes", ["YES"]), ("x", ["yes"]), ("x", None)], "content string, must_include array<string>")
    assert [x["pass"] for x in evals.score_keywords(chat).collect()] == [True, False, True]
    assert evals.tally(evals.score_modeswitch(chat)).first().passed == 0


def test_stalls_in_batch_and_stream(spark, tmp_path):
    rows = [(1, 10), (2, 10), (3, 10), (4, 9), (5, 20), (6, 20)]
    df = spark.createDataFrame([(datetime(2024, 1, d), t) for d, t in rows], "sample timestamp, total long")
    want = ["ok", "ok", "stalled", "stalled", "done", "done"]
    assert [r.status for r in monitor.stalls(df, 20).orderBy("sample").collect()] == want
    df.withColumn("key", F.lit("k")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("sample timestamp, total long, key string").parquet(str(tmp_path / "in"))
    q = monitor.watch(stream, 20).writeStream.format("memory").queryName("watched").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r.status for r in spark.table("watched").orderBy("sample").collect()] == want


def test_gated_append_stops_at_its_target(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("good 1\nbad\ngood 2\ngood 3\n")
    lines = spark.readStream.text(str(tmp_path / "in"))
    monitor.gated_append(lines, F.col("value").startswith("good"), str(tmp_path / "out"), str(tmp_path / "cp"), target=2).awaitTermination(120)
    assert spark.read.json(f"{tmp_path}/out/*").count() == 2
    # a later run goes on from the checkpoint and stays within the target
    (tmp_path / "in" / "b.txt").write_text("good 4\n")
    monitor.gated_append(lines, F.col("value").startswith("good"), str(tmp_path / "out"), str(tmp_path / "cp"), target=3).awaitTermination(120)
    assert spark.read.json(f"{tmp_path}/out/*").count() == 3


def test_execution_is_opt_in(spark):
    rows = [(1, "Python", "def f(): return 1", "assert f() == 1"), (2, "Python", "def f(): return 2", "assert f() == 1"), (3, "Python", "def f(:", ""), (4, "Java", "x", "")]
    df = spark.createDataFrame(rows, "row_id long, lang string, solution string, tests string")
    with pytest.raises(execgate.NotAllowed):
        execgate.verify(df)
    got = {r.row_id: r.status for r in execgate.verify(df, enabled=True).collect()}
    assert got == {1: "PASS", 2: "FAIL", 3: "FAIL", 4: "PASS"}
    assert execgate.run_python("while True: pass", timeout=0.5)[0] == "TIMEOUT"
    with pytest.raises(execgate.NotAllowed):
        execgate.smoke(df.withColumnRenamed("solution", "code"))
    replies = spark.createDataFrame([(1, "Python", "```python\ndef f(): return 1\n```", "assert f() == 1"), (2, "Python", "x = 1", "assert x == 2")], "row_id long, lang string, content string, tests string")
    assert {r.row_id: r["pass"] for r in execgate.score_programs(replies, enabled=True).collect()} == {1: True, 2: False}


@pytest.mark.parametrize(
    ("code", "any_traceback", "want"),
    [
        ("print(1)", False, (True, "ok")), ("import sys; sys.exit(1)", False, (True, "exit1")), ("while True: input()", False, (False, "EOFError: EOF when reading a line")), ("while True: pass", False, (True, "timeout(ran)")), ("def f(:", False, (False, "syntax-error")),
        ("raise ValueError('no')", False, (False, "ValueError: no")), ("import sys; print('Traceback', file=sys.stderr)", False, (True, "ok")), ("import sys; print('Traceback', file=sys.stderr)", True, (False, "Traceback")), ("print(open('numbers.txt').read(), input())", False, (True, "ok")), ("\0", False, (False, "syntax-error")),
    ],
)
def test_interactive_programs(code, any_traceback, want):
    assert execgate.runs_ok(code, "7\nadd\n", 1.5, any_traceback, {"numbers.txt": "4\n8\n"}) == want


def test_smoke_of_a_frame(spark):
    got = execgate.smoke(spark.createDataFrame([(1, "print(2)"), (2, None), (3, "1/0")], "row_id long, code string"), enabled=True).collect()
    assert {r.row_id: r.ok for r in got} == {1: True, 2: True, 3: False}


def test_includes_are_fixed_round_by_round_over_a_frame(spark):
    """A compiler that asks for one header at a time, and never for more than it knows."""
    needs = [("strlen", "string.h"), ("bool", "stdbool.h"), ("zig", None)]

    def build(text, run):
        for symbol, header in needs:
            if symbol in text and f"<{header}>" not in text and not (symbol == "zig" and not run):
                return "COMPILE_FAIL", f"unknown type name '{symbol}'" if symbol == "bool" else f"'{symbol}' undeclared" + (f"; is defined in header '<{header}>'" if header else "")
        return "PASS", ""

    rows = [(1, "bool f = strlen(x);", None), (2, "zig; strlen(x)", ""), (3, "strlen(x)", "zig()"), (4, "int x;", None), (5, None, None)]
    df = spark.createDataFrame(rows, "row_id long, solution string, tests string")
    with pytest.raises(execgate.NotAllowed):
        execgate.fix_includes(df)
    found = execgate.fix_includes(df, execgate.include_rounds(build), enabled=True)
    assert {r.row_id: (r.raw, r.fixed, r.rounds, r.headers, r.source) for r in found.collect()} == {
        1: (False, True, 2, ["stdbool.h", "string.h"], "#include <stdbool.h>\n#include <string.h>\nbool f = strlen(x);"),
        2: (False, True, 1, ["string.h"], "#include <string.h>\nzig; strlen(x)"),  # alone, without linking
        3: (False, False, 1, ["string.h"], "#include <string.h>\nstrlen(x)"),  # nothing new is asked for
        4: (True, True, 0, [], "int x;"), 5: (True, True, 0, [], ""),
    }
    assert evals.rescued(found, "raw", "fixed").first().asDict() == {"n_raw": 2, "n_fixed": 4, "n_rescued": 2, "n_gain": 2}
    assert execgate.fix_includes(df, execgate.include_rounds(build, rounds=1), enabled=True).where("fixed").count() == 3


def test_programs_end_with_all_that_they_started(tmp_path):
    mark = tmp_path / "mark"
    child = f"import time, pathlib; time.sleep(1.5); pathlib.Path({str(mark)!r}).write_text('late')"
    began = time.monotonic()
    assert execgate.run_python(f"import subprocess, sys, time\nsubprocess.Popen([sys.executable, '-c', {child!r}])\ntime.sleep(30)", timeout=0.7)[0] == "TIMEOUT"
    assert execgate.run_python(f"import subprocess, sys\nsubprocess.Popen([sys.executable, '-c', {child!r}])", timeout=5)[0] == "PASS"
    assert time.monotonic() - began < 5
    time.sleep(2)
    assert not mark.exists()
    assert execgate.run_python("x = bytearray(8 << 30)", timeout=5)[0] == "FAIL"
    assert execgate.run_python("open('f', 'wb').write(b'0' * (80 << 20))", timeout=5)[0] == "FAIL"
    assert execgate.run_python("print('x' * (1 << 22))", timeout=5)[0] == "PASS"


def test_programs_of_a_frame_run_once_and_in_many_tasks(spark, tmp_path):
    code = f"import os\nopen({str(tmp_path)!r} + f'/{{os.getpid()}}', 'w')"
    df = spark.createDataFrame([(i, "Python", code, "") for i in range(8)], "row_id long, lang string, solution string, tests string").coalesce(1)
    found = execgate.verify(df, enabled=True)
    assert found.rdd.getNumPartitions() >= 4
    assert found.where("status = 'PASS'").count() == found.join(df, "row_id").count() == 8 == len(list(tmp_path.iterdir()))


@pytest.mark.skipif(execgate.compile_c("int main(void){return 0;}")[0] != "PASS", reason="no working C compiler")
def test_execution_of_c():
    assert execgate.compile_c("int f(void){return 1;} int main(void){return f()-1;}")[0] == "PASS"
    assert execgate.compile_c("int f(void){return 1;}", run=False)[0] == "PASS"
    assert execgate.compile_c("int main(void){return x;}")[0] == "COMPILE_FAIL" and execgate.compile_c("int main(void){return 3;}")[0] == "RUNTIME_FAIL"
    (*_, last) = execgate.include_rounds().func().eval("int main(void){ size_t n = 0; bool b = true; return (int)n + !b + (NULL != 0); }", "")
    assert last[1] == "PASS"


def test_gates_counted_beside_their_rows(spark):
    kept, counters = evals.counted(spark.range(10), F.col("id") % 3 == 0)
    assert kept.count() == 4 and counters.get == {"seen": 10, "kept": 4, "rejected": 6}


def test_sentinels_and_stamps(spark, tmp_path):
    path = str(tmp_path / "step")
    assert not sinks.wait_done(spark, path, 0.2, 0.1)
    sinks.mark_done(spark, path)
    assert sinks.wait_done(spark, path, 5) and not sinks.is_done(spark, path, "failed")
    spark.range(2).write.json(str(tmp_path / "job"))
    assert sinks.is_done(spark, str(tmp_path / "job"))
    assert str(sinks.stamped(spark.range(1), "2024-02-03").first().stamp) == "2024-02-03"


def test_first_lines_and_strict_turns(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(f'{{"messages":[{{"role":"user","content":"{i}"}}]}}' for i in range(9)))
    assert records.parse(records.head(records.lines(spark, str(tmp_path / "a.jsonl")), 3))[0].count() == 3
    assert over(spark, asm.strict_first_user(F.col("messages")), [turn("user", " q ")]) == " q "
    with pytest.raises(Exception, match="without a user turn"):
        over(spark, asm.strict_first_user(F.col("messages")), [turn("assistant", "q")])
    assert one(spark, execgate.with_preamble(F.col("a")), "int x;").count("#include") == 10
    assert one(spark, gates.is_verifiable(F.col("a"), F.col("b")), "C", " ") is False and one(spark, gates.is_verifiable(F.col("a"), F.col("b")), "C", "t") is True


def test_producers_side_by_side(spark, tmp_path):
    for n in ("a", "b"):
        (tmp_path / n).mkdir()
        (tmp_path / n / "x.txt").write_text(f"{n}1\n{n}2\n")
    both = monitor.producers([spark.readStream.text(str(tmp_path / n)) for n in ("a", "b")])
    monitor.gated_append(both, F.col("value").endswith("1"), str(tmp_path / "out"), str(tmp_path / "cp"), seconds=60).awaitTermination(60)
    assert sorted((r.value, r.producer) for r in spark.read.json(f"{tmp_path}/out/*").collect()) == [("a1", 0), ("b1", 1)]


def test_cuts_by_histogram_equal_a_sort(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("lang"))
    wanted = spark.createDataFrame([("a", 70), ("b", 1999)], "lang string, _k long")
    key = mix.shuffle_key(1, F.col("id"))
    for digits in (1, 2):
        got = {(r.lang, r.id) for r in mix.smallest(rows, ["lang"], key, "id", wanted, digits).collect()}
        every = sorted((r.lang, r.k, r.id) for r in rows.withColumn("k", key).collect())
        want = {(l, i) for name, n in (("a", 70), ("b", 1999)) for l, _, i in [x for x in every if x[0] == name][:n]}
        assert got == want


def test_dedup_is_idempotent_and_splits_add_up(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    once = dedup.exact_dedup(docs.select("doc_id", "text"), "doc_id")
    assert dedup.exact_dedup(once.drop("key"), "doc_id").count() == once.count()
    split = dedup.split(once)
    assert split.where("split = 'train'").count() + split.where("split = 'heldout'").count() == once.count()
