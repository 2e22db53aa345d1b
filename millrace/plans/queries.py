"""Queries of the driver's contract for the library's own operators, each with the SQL it is held against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import gates, text as tx, udfs
from ..operators import assemble as asm, dedup, evals, mix, passages
from ..sources.records import MESSAGES
from ..streaming import monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: SQL of the dedup key of a documents row, and of the byte it is split by.
KEY = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"
BYTE = "('0x' || substr(sha1({}), 39, 2))::INT"


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as rows of messages (row_id, messages)."""
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    rows = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("row_id")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    kind = lambda m: F.when(m["content"].isNull(), "null").otherwise("string")
    messages = F.transform("t", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), kind(m).alias("content_type"), F.lit(None).cast("array<struct<name:string,arguments:string>>").alias("tool_calls")))
    return rows.select("row_id", messages.cast(MESSAGES).alias("messages"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels with documents' columns; pass is quality 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").withColumn("pass", F.col("quality") == 1)


@query(f"""
WITH k AS (SELECT doc_id, lang, {KEY} AS key FROM documents),
f AS (SELECT lang, key FROM k WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1)
SELECT lang, CASE WHEN {BYTE.format('key')} <= 7 THEN 'heldout' ELSE 'train' END AS split, count(*)::BIGINT AS n FROM f GROUP BY ALL
""")
def clean_split_counts(spark, sf_dir):
    """How many documents survive cleaning, per language, in train and held-out."""
    kept = dedup.exact_dedup(table(spark, sf_dir, "documents"), "doc_id")
    return dedup.split(kept).groupBy("lang", "split").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id FROM (SELECT doc_id, {KEY} AS key FROM documents) WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1")
def exact_dedup(spark, sf_dir):
    return dedup.exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select("doc_id")


@query(f"""
SELECT verdict, count(*)::BIGINT AS n FROM (
  SELECT CASE WHEN key = '' THEN 'empty' WHEN row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1 THEN 'kept' ELSE 'exact' END AS verdict
  FROM (SELECT doc_id, {KEY} AS key FROM documents)) GROUP BY verdict
""")
def dedup_accounting(spark, sf_dir):
    return dedup.accounting(dedup.exact_verdicts(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"))


@query(f"SELECT doc_id, {BYTE.format(KEY)} AS byte, {BYTE.format(KEY)} <= 7 AS heldout FROM documents")
def heldout_split(spark, sf_dir):
    key = tx.norm(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", tx.hash_byte(key).alias("byte"), tx.is_heldout(key).alias("heldout"))


@query()
def near_dup_window(spark, sf_dir):
    """The sequential rule over whole documents, in order."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return dedup.window_dedup(docs, "row_id")


@query()
def near_dup_links(spark, sf_dir):
    """Whole documents with how many of the 400 before them score 92 or more."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return dedup.near_links(docs, "row_id")


@query(f"""
SELECT doc_id FROM (SELECT doc_id, {KEY} AS key FROM documents) d
WHERE key <> '' AND NOT EXISTS (SELECT 1 FROM (SELECT {KEY} AS key FROM benchmark) b WHERE b.key = d.key)
""")
def decontam_exact(spark, sf_dir):
    return dedup.decontaminate_exact(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")).select("doc_id")


@query(f"""
WITH k AS (SELECT doc_id, {KEY} AS key FROM documents), s AS (SELECT doc_id, key, {BYTE.format('key')} <= 7 AS held FROM k)
SELECT doc_id FROM s WHERE NOT held AND key <> '' AND key NOT IN (SELECT key FROM s WHERE held)
""")
def decontam_heldout(spark, sf_dir):
    """Train rows that equal no held-out row."""
    rows = dedup.split(dedup.keyed(table(spark, sf_dir, "documents").select("doc_id", "text")))
    train, held = rows.where("split = 'train'").select("doc_id", "text"), rows.where("split = 'heldout'").select("text")
    return dedup.decontaminate_exact(train, held).select("doc_id")


@query("SELECT doc_id, count(item_id)::BIGINT AS n_passages FROM documents d LEFT JOIN benchmark b ON contains(d.text, b.text) GROUP BY doc_id")
def decontam_passage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.contains_passage(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "n_passages")


@query()
def decontam_fuzzy(spark, sf_dir):
    """User turns that score below 92 against all benchmark items."""
    users = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    return dedup.decontaminate_fuzzy(users, table(spark, sf_dir, "benchmark")).select("conv_id", "turn")


@query(f"SELECT count(*)::BIGINT AS n_shared FROM (SELECT {KEY} AS key FROM documents) WHERE key <> '' AND key IN (SELECT {KEY} FROM benchmark)")
def disjoint_check(spark, sf_dir):
    return dedup.shared_keys(table(spark, sf_dir, "documents").select("text"), table(spark, sf_dir, "benchmark")).agg(F.count("*").alias("n_shared"))


@query("SELECT conv_id AS row_id, count(*)::BIGINT AS n_turns, sum(length(text))::BIGINT AS n_chars, count(*) FILTER (role = 'assistant')::BIGINT AS n_assistant, coalesce(arg_min(text, turn) FILTER (role = 'user'), '') AS first_user FROM conversations GROUP BY conv_id")
def conv_assemble(spark, sf_dir):
    """Conversations put together from turns, with their sizes and openings."""
    m = F.col("messages")
    assistants = F.size(F.filter(m, lambda x: x["role"] == "assistant")).cast("long")
    opening = F.coalesce(F.try_element_at(F.filter(m, lambda x: x["role"] == "user"), F.lit(1))["content"], F.lit(""))
    return conversations(spark, sf_dir).select("row_id", F.size(m).cast("long").alias("n_turns"), evals.message_chars(m).alias("n_chars"), assistants.alias("n_assistant"), opening.alias("first_user"))


@query("SELECT conv_id AS row_id, count(*) >= 2 AND bool_and(coalesce(trim(text), '') <> '') AS valid, bool_or(role = 'tool') AS tool_turn FROM conversations GROUP BY conv_id")
def conv_valid(spark, sf_dir):
    return conversations(spark, sf_dir).select("row_id", gates.valid_messages(F.col("messages")).alias("valid"), gates.has_tool_turn(F.col("messages")).alias("tool_turn"))


@query("""
WITH t AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
SELECT conv_id AS row_id, count(*) >= 2 AND bool_and(coalesce(trim(text), '') <> '') AND bool_and(k > 1 OR role = 'user') AND bool_and(before IS NULL OR before <> role)
  AND count(*) FILTER (role = 'assistant') >= 1 AND bool_and(role <> 'assistant' OR length(text) >= 40)
  AND bool_and(role <> 'assistant' OR NOT regexp_matches(lower(trim(text)), '^(i cannot|i can''t|i''m unable|as an ai language model|i am unable|i''m sorry, but i can|i am not able)')) AS good
FROM t GROUP BY conv_id
""")
def chat_gate(spark, sf_dir):
    return conversations(spark, sf_dir).select("row_id", gates.good_chat(F.col("messages")).alias("good"))


@query("SELECT conv_id AS row_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS position, role, text AS content FROM conversations QUALIFY role = 'user'")
def user_turn_explode(spark, sf_dir):
    return asm.user_turns(conversations(spark, sf_dir)).select("row_id", "position", F.lit("user").alias("role"), "content")


@query(r"""
SELECT conv_id, turn, p AS prose, p AND NOT regexp_matches(text, '(?i)<(?:!doctype|html|body|div|p|h[1-6]|ul|table|span|section|head)\b') AS plain,
  contains(text, '```') OR regexp_matches(text, '(?i)<(?:details|summary|p|div|ul|li|h[1-6]|table|section|strong|em|!doctype|html|body|blockquote)\b') AS document
FROM (SELECT *, length(trim(text)) >= 25 AND NOT regexp_matches(text, '(?s)```[a-zA-Z0-9+#.\-]*\n(.*?)```') AND NOT contains(text, '<tool_call>') AS p FROM conversations)
""")
def prose_gate(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", gates.is_prose(t).alias("prose"), gates.is_plain_prose(t).alias("plain"), gates.is_document(t).alias("document"))


@query(r"""
SELECT page_id, CASE WHEN trim(html) = '' THEN false WHEN length(html) - length(replace(html, '<', '')) < 4 THEN true WHEN length(html) - length(replace(html, chr(10), '')) < 3 THEN false ELSE regexp_matches(html, '(^|[\n\r])[ \t]') END AS multiline FROM pages
""")
def multiline_gate(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", gates.is_multiline(F.col("html")).alias("multiline"))


#: Documents stand in for code of a language; one of them has no tag of its own.
_CODE = {"en": "Python", "fr": "C", "de": "Java", "es": "Rust"}


@query(r"""
WITH r AS (
  SELECT doc_id * 2 AS row_id, text AS body, CASE lang WHEN 'en' THEN 'Here''s the Python solution:' WHEN 'fr' THEN 'Here''s the C solution:' WHEN 'de' THEN 'Here''s the Java solution:' END AS intro, CASE lang WHEN 'en' THEN 'python' WHEN 'fr' THEN 'c' WHEN 'de' THEN 'java' END AS tag FROM documents
  UNION ALL SELECT page_id * 2 + 1, html, CASE WHEN contains(lower(html), '<!doctype') THEN 'Here''s a complete, self-contained HTML page:' ELSE 'Here''s the HTML:' END, 'html' FROM pages
)
SELECT row_id::BIGINT AS row_id, CASE WHEN tag IS NULL OR regexp_matches(body, '(?s)```[a-zA-Z0-9+#.\-]*\n(.*?)```') THEN body ELSE
  intro || chr(10) || chr(10) || '```' || tag || chr(10) || regexp_replace(body, '^\s+|\s+$', '', 'g') || chr(10) || '```' END AS reply FROM r
""")
def fence_normalize(spark, sf_dir):
    """Documents as assistant turns of code rows, pages as those of web rows."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"), F.lit("string").alias("content_type"), F.lit(None).cast("array<struct<name:string,arguments:string>>").alias("tool_calls"))
    lang = F.lit(None).cast("string")
    for name, code in _CODE.items():
        lang = F.when(F.col("lang") == name, code).otherwise(lang)
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") * 2).alias("row_id"), F.lit("code").alias("kind"), lang.alias("lang"), F.lit("q").alias("ask"), F.col("text").alias("body"))
    pages = table(spark, sf_dir, "pages").select((F.col("page_id") * 2 + 1).alias("row_id"), F.lit("web").alias("kind"), F.lit("HTML").alias("lang"), F.col("url").alias("ask"), F.col("html").alias("body"))
    rows = docs.unionByName(pages).select("row_id", "kind", "lang", F.array(turn("user", F.col("ask")), turn("assistant", F.col("body"))).cast(MESSAGES).alias("messages"))
    out = mix.normalized_messages(F.col("messages"), F.col("kind"), F.col("lang"))
    return rows.select("row_id", out[1]["content"].alias("reply"))


@query()
def html_lint(spark, sf_dir):
    """Structural errors of pages by Python's own parser."""
    return table(spark, sf_dir, "pages").select("page_id", udfs.html_lint("html").alias("errors")).select("page_id", F.size("errors").alias("n_errors"), F.array_join("errors", "; ").alias("errors"))


@query(r"""
SELECT page_id, contains(lower(html), '<!doctype') AS doctype, contains(lower(html), '<form') AND NOT contains(lower(html), '<label') AS bad_form,
  contains(lower(html), '<img') AND NOT regexp_matches(html, '(?i)<img[^>]*\balt\s*=') AS bad_img FROM pages
""")
def html_soft_checks(spark, sf_dir):
    issues = gates.html_soft_issues(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.lower("html").contains("<!doctype").alias("doctype"), F.array_contains(issues, "form without label").alias("bad_form"), F.array_contains(issues, "img without alt").alias("bad_img"))


#: A list of tools, wrapped and flat.
TOOLS = '[{"type":"function","function":{"name":"search","parameters":{"type":"object","properties":{"q":{"type":"string"},"n":{"type":"integer"}},"required":["q"]}}},{"name":"flat","parameters":{"properties":{"x":{"type":["number"]}}}}]'


#: Compiler messages by kind of event.
_STDERR = {"click": "error: implicit declaration of function", "view": "error: unknown type name 'x'", "error": "undefined reference to `f'", "purchase": "in main: error: expected ';'"}


@query("""
SELECT bucket, count(*)::BIGINT AS n, min(event_id)::BIGINT AS first_row FROM (
  SELECT event_id, CASE event_type WHEN 'click' THEN 'missing_include/decl' WHEN 'view' THEN 'unknown_type (missing struct/typedef)' WHEN 'error' THEN 'link_undefined (fn not defined)' WHEN 'purchase' THEN (CASE WHEN event_id % 2 = 0 THEN 'dup_main (student wrote main())' ELSE 'syntax_error' END) ELSE 'other_compile' END AS bucket FROM events) GROUP BY bucket
""")
def failure_buckets(spark, sf_dir):
    message = F.lit("warning")
    for kind, text in _STDERR.items():
        message = F.when(F.col("event_type") == kind, text).otherwise(message)
    source = F.when(F.col("event_id") % 2 == 0, "main() {}").otherwise("int remain(void) { return 0; }")
    rows = table(spark, sf_dir, "events").select("event_id", gates.compile_bucket(message, gates.has_main(source)).alias("bucket"))
    return evals.buckets(rows, "bucket", "event_id")


@query("""
SELECT bucket, min_by(event_id, event_id)::BIGINT AS event_id FROM (SELECT event_id, event_type AS bucket FROM events) GROUP BY bucket
""")
def bucket_exemplars(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("bucket"), F.col("event_id").alias("at"))
    return evals.exemplars(rows, "bucket", "at", "event_id")


_REPLAY = {"en": 0.25, "fr": 1.0, "de": 0.1}


@query("""
SELECT doc_id, lang FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('3407:' || doc_id::VARCHAR), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents)
WHERE lang = 'fr' OR (lang = 'en' AND k <= greatest(1, round_even(n * 0.25, 0))) OR (lang = 'de' AND k <= greatest(1, round_even(n * 0.1, 0)))
""")
def replay_stratified(spark, sf_dir):
    return mix.replay(table(spark, sf_dir, "documents").select("doc_id", "lang"), _REPLAY, "lang", "doc_id")


@query("""
SELECT lang, n::BIGINT AS n_before, (CASE lang WHEN 'fr' THEN n WHEN 'en' THEN greatest(1, round_even(n * 0.25, 0)) WHEN 'de' THEN greatest(1, round_even(n * 0.1, 0)) ELSE 0 END)::BIGINT AS n_after
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
""")
def replay_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return mix.replay_report(docs, mix.replay(docs, _REPLAY, "lang", "doc_id"), "lang")


def _mixture(spark, sf_dir) -> DataFrame:
    """documents as code rows, conversations as chat rows, pages as web rows: (row_id, kind, q)."""
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") * 3).alias("row_id"), F.lit("code").alias("kind"), F.trim("text").alias("q"))
    users = table(spark, sf_dir, "conversations").where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("q"))
    chats = users.select((F.col("conv_id") * 3 + 1).alias("row_id"), F.lit("chat").alias("kind"), F.trim("q").alias("q"))
    pages = table(spark, sf_dir, "pages").select((F.col("page_id") * 3 + 2).alias("row_id"), F.lit("web").alias("kind"), F.trim("url").alias("q"))
    rows = docs.unionByName(chats).unionByName(pages)
    none = F.lit("")
    sig = F.struct(F.lit("query").alias("tag"), F.col("q").alias("q"), none.alias("mtype"), F.array().cast("array<string>").alias("names"), none.alias("called"))
    return rows.withColumn("sig", sig)


_MIXTURE = """
m AS (
  SELECT doc_id * 3 AS row_id, 'code' AS kind, trim(text) AS q FROM documents UNION ALL
  SELECT conv_id * 3 + 1, 'chat', trim(arg_min(text, turn)) FROM conversations WHERE role = 'user' GROUP BY conv_id UNION ALL
  SELECT page_id * 3 + 2, 'web', trim(url) FROM pages
), d AS (SELECT row_id, kind, q FROM m QUALIFY q = '' OR row_number() OVER (PARTITION BY q ORDER BY row_id) = 1)
"""


@query(f"WITH {_MIXTURE} SELECT row_id::BIGINT AS row_id, kind FROM d")
def mix_union_dedup(spark, sf_dir):
    return mix.distinct_by(_mixture(spark, sf_dir), "sig", "row_id").select("row_id", "kind")


@query(f"WITH {_MIXTURE} SELECT kind, count(*)::BIGINT AS n FROM d GROUP BY kind")
def mix_composition(spark, sf_dir):
    return mix.composition(mix.distinct_by(_mixture(spark, sf_dir), "sig", "row_id"))


@query("""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY sha256('3407:' || doc_id::VARCHAR), doc_id) <= greatest(1, round_even((SELECT count(*) FROM documents) * 0.03, 0)) THEN 'heldout' ELSE 'train' END AS split FROM documents
""")
def holdout_head(spark, sf_dir):
    return mix.holdout_head(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "split")


@query("SELECT lang, sum((CASE WHEN toxic = 1 THEN 3 ELSE 1 END) * (CASE WHEN quality = 1 THEN 2 ELSE 1 END))::BIGINT AS n FROM labels JOIN documents USING (doc_id) GROUP BY lang")
def upweight_counts(spark, sf_dir):
    rows = mix.upweight(labelled(spark, sf_dir), [(F.col("toxic") == 1, 3), (F.col("quality") == 1, 2)])
    return mix.composition(rows, "lang")


@query("""
SELECT CASE WHEN grouping(lang) = 1 THEN 'ALL' ELSE coalesce(lang, '?') END AS lang, count(*) FILTER (quality = 1)::BIGINT AS passed, count(*)::BIGINT AS total, round(count(*) FILTER (quality = 1) / count(*), 6)::DOUBLE AS rate
FROM labels JOIN documents USING (doc_id) GROUP BY ROLLUP (lang)
""")
def pass_at_1_by_lang(spark, sf_dir):
    return evals.pass_rates(labelled(spark, sf_dir), "lang")


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id)::BIGINT AS n, round(avg(quality) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING), 6)::DOUBLE AS rate FROM labels")
def running_pass(spark, sf_dir):
    return evals.running_rate(table(spark, sf_dir, "labels"), "doc_id", "quality")


@query("""
SELECT count(*) FILTER (quality = 1)::BIGINT AS n_raw, count(*) FILTER (toxic = 0)::BIGINT AS n_fixed, count(*) FILTER (toxic = 0 AND quality = 0)::BIGINT AS n_rescued,
  (count(*) FILTER (toxic = 0) - count(*) FILTER (quality = 1))::BIGINT AS n_gain FROM labels
""")
def rescued(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("raw"), (F.col("toxic") == 0).alias("fixed"))
    return evals.rescued(rows, "raw", "fixed")


@query(r"""
WITH k AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS item, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]{4,}')))[1:5] AS ws FROM benchmark),
h AS (SELECT len(list_filter(ws, lambda w: contains(lower(coalesce(text, '')), w))) AS n, len(ws) AS m FROM documents JOIN k ON item = doc_id % (SELECT count(*) FROM benchmark))
SELECT sum(n)::BIGINT AS n_hit, sum(m)::BIGINT AS n_needed, round(coalesce(sum(n) / nullif(sum(m), 0), 1.0), 6)::DOUBLE AS rate FROM h
""")
def keyword_hits(spark, sf_dir):
    """Documents as replies to benchmark items, with words of the item as what they have to hold."""
    bench = table(spark, sf_dir, "benchmark")
    words = F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0)))), 1, 5)
    items = evals.ticks(bench, "item_id", 1).join(bench.select("item_id", words.alias("must_include")), "item_id").select((F.col("n") - 1).alias("item"), "must_include")
    docs = table(spark, sf_dir, "documents").select(F.pmod("doc_id", F.lit(bench.count())).alias("item"), F.col("text").alias("content"))
    return evals.keyword_rate(evals.score_keywords(docs.join(items, "item")), "n_hit", "n_needed")


@query("""
SELECT coalesce(conv_id, -1)::BIGINT AS conv_id, count(*) FILTER (length(text) >= 200)::BIGINT AS passed, count(*)::BIGINT AS total, round(count(*) FILTER (length(text) >= 200) / count(*), 6)::DOUBLE AS rate FROM conversations GROUP BY ROLLUP (conv_id)
""")
def sample_rates(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("pass", F.length("text") >= 200)
    return evals.sample_rates(rows, "conv_id", "pass").withColumn("conv_id", F.coalesce("conv_id", F.lit(-1).cast("long")))


@query("""
SELECT source, count(*) FILTER (lang = 'de' AND quality = 1)::BIGINT AS axis_de, count(*) FILTER (lang = 'en' AND quality = 1)::BIGINT AS axis_en, count(*) FILTER (lang = 'es' AND quality = 1)::BIGINT AS axis_es, count(*) FILTER (lang = 'fr' AND quality = 1)::BIGINT AS axis_fr
FROM labels JOIN documents USING (doc_id) GROUP BY source
""")
def version_pivot(spark, sf_dir):
    return evals.pivot_versions(labelled(spark, sf_dir), "source", "lang", "pass", ["de", "en", "es", "fr"])


@query("""
WITH b AS (SELECT lang, round(count(*) FILTER (quality = 1) / count(*), 6) AS r FROM labels JOIN documents USING (doc_id) GROUP BY lang), o AS (SELECT lang, round(count(*) FILTER (toxic = 0) / count(*), 6) AS r FROM labels JOIN documents USING (doc_id) GROUP BY lang)
SELECT b.lang, b.r::DOUBLE AS base_rate, o.r::DOUBLE AS other_rate, round(100 * (o.r - b.r), 4)::DOUBLE AS delta_pp FROM b JOIN o ON b.lang = o.lang
""")
def delta_vs_base(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    base, other = evals.pass_rates(rows, "lang"), evals.pass_rates(rows.withColumn("pass", F.col("toxic") == 0), "lang")
    return evals.delta(base.where("lang <> 'ALL'"), other, "lang")


@query("""
WITH c AS (SELECT sum(length(text)) AS v FROM conversations GROUP BY conv_id), r AS (SELECT v, row_number() OVER (ORDER BY v) AS k, count(*) OVER () AS n FROM c)
SELECT max(v) FILTER (k = n // 2 + 1)::BIGINT AS p50, max(v) FILTER (k = floor(n * 0.95) + 1)::BIGINT AS p95, max(v)::BIGINT AS max FROM r
""")
def char_percentiles(spark, sf_dir):
    rows = conversations(spark, sf_dir).select(evals.message_chars(F.col("messages")).alias("v"))
    return evals.exact_percentiles(rows, "v", {"p50": 0.5, "p95": 0.95})


@query("""
WITH c AS (SELECT time_bucket(INTERVAL '15 minutes', ts) AS s, count(*) AS n FROM events GROUP BY 1), a AS (SELECT unnest(generate_series((SELECT min(s) FROM c), (SELECT max(s) FROM c), INTERVAL '15 minutes')) AS s),
t AS (SELECT a.s, sum(coalesce(n, 0)) OVER (ORDER BY a.s) AS total FROM a LEFT JOIN c ON a.s = c.s), g AS (SELECT s, total, coalesce(total > lag(total) OVER (ORDER BY s), true) AS grew FROM t),
r AS (SELECT *, sum(grew::INT) OVER (ORDER BY s) AS run FROM g), f AS (SELECT s, total, row_number() OVER (PARTITION BY run ORDER BY s) - 1 AS flat FROM r)
SELECT s AS sample, total::BIGINT AS total, flat::BIGINT AS flat, CASE WHEN total >= 1550 THEN 'done' WHEN flat >= 2 THEN 'stalled' ELSE 'ok' END AS status FROM f
""")
def stall_monitor(spark, sf_dir):
    return monitor.stalls(monitor.samples(table(spark, sf_dir, "events")), 1550)


@query(f"SELECT doc_id, {KEY} AS key FROM documents")
def norm_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.norm(F.col("text")).alias("key"))
