"""Queries of the smaller operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import gates, text as tx
from ..operators import dedup, evals, execgate, mix
from .queries import conversations, query, table


@query("SELECT conv_id AS row_id, trim(coalesce(arg_min(text, turn) FILTER (role = 'user'), '')) AS opening FROM conversations GROUP BY conv_id")
def first_user_turn(spark, sf_dir):
    return conversations(spark, sf_dir).select("row_id", mix.first_user(F.col("messages")).alias("opening"))


@query("SELECT doc_id, left(text, 120) AS head, length(left(text, 1500))::BIGINT AS n FROM documents")
def report_prefix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.left("text", F.lit(120)).alias("head"), F.length(F.left("text", F.lit(1500))).cast("long").alias("n"))


@query("""
WITH t AS (SELECT *, length(trim(text)) >= 25 AND NOT regexp_matches(text, '(?s)```[a-zA-Z0-9+#.\\-]*\\n(.*?)```') AND NOT contains(text, '<tool_call>') AS ok FROM conversations WHERE role = 'assistant')
SELECT count(*)::BIGINT AS seen, count(*) FILTER (ok)::BIGINT AS kept, count(*) FILTER (NOT ok)::BIGINT AS rejected FROM t
""".replace("\\\\", "\\"))
def gate_counters(spark, sf_dir):
    """Seen, kept and rejected of a gate."""
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return evals.gate_counters(turns, gates.is_prose(F.col("text")))


@query("SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages) + (SELECT count(*) FROM conversations) AS total, [(SELECT count(*) FROM documents), (SELECT count(*) FROM pages), (SELECT count(*) FROM conversations)]::VARCHAR AS by_source")
def rows_of_sources(spark, sf_dir):
    """Rows of several sources, together and by source."""
    found = mix.total_rows([table(spark, sf_dir, n) for n in ("documents", "pages", "conversations")])
    return found.select("total", F.col("by_source").cast("string").alias("by_source"))


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def last_rows(spark, sf_dir):
    """The last ten rows in an order: a top-k."""
    return mix.last_rows(table(spark, sf_dir, "events"), ["ts", "event_id"], 10).select("event_id", "ts")


@query("SELECT event_type, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY event_type")
def latest_row(spark, sf_dir):
    """The latest row of each group."""
    return mix.latest_row(table(spark, sf_dir, "events"), ["event_type"], ["ts", "event_id"], "event_id")


@query("SELECT doc_id, n::BIGINT AS n FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n FROM documents WHERE length(text) >= 300) WHERE n % 25 = 0")
def progress_ticks(spark, sf_dir):
    """Every 25th row that is kept."""
    kept = table(spark, sf_dir, "documents").where("length(text) >= 300").select("doc_id")
    return evals.ticks(kept, "doc_id", 25)


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr')")
def subset_by_list(spark, sf_dir):
    return mix.of_types(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "en, fr")


@query("SELECT lang, count(*)::BIGINT AS n, coalesce(lang IN ('en', 'de', 'fr'), false) AS known FROM documents GROUP BY lang")
def vocabulary_check(spark, sf_dir):
    """Rows by language, and whether it is in a closed vocabulary."""
    known = gates.in_vocabulary(F.col("lang"), ["en", "de", "fr"])
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n")).withColumn("known", known)


@query("SELECT string_agg(source || '=' || n, ' ' ORDER BY source) AS line FROM (SELECT source, count(*) AS n FROM documents GROUP BY source) WHERE regexp_matches(source, '^src1')")
def report_line(spark, sf_dir):
    """Result rows by a pattern of their name, joined into one line."""
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return evals.joined_line(counts, "source", "^src1", F.concat_ws("=", "source", "n"))


@query("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE lang = 'de' AND quality = 1 ORDER BY doc_id LIMIT 12")
def first_items(spark, sf_dir):
    """The first twelve items that can be scored, in order."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.when(F.col("lang") == "de", "C").otherwise("x").alias("lang"), F.when(F.col("quality") == 1, "t").alias("tests"))
    return execgate.scorable(rows, "doc_id").select("doc_id")


@query("SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events) WHERE k <= 4")
def first_samples(spark, sf_dir):
    """The first four rows of each group, by an aggregate that holds four rows a group."""
    return mix.first_of_each(table(spark, sf_dir, "events"), ["event_type"], "event_id", 4)


@query("SELECT page_id, left(list_extract(string_split(trim(html), chr(10)), -1), 80) AS last_line, len(list_slice(string_split(trim(html), chr(10)), 1, 5))::INT AS n_first FROM pages")
def list_slices(spark, sf_dir):
    """The last line, and up to five first ones."""
    lines = F.split(F.trim("html"), "\n")
    return table(spark, sf_dir, "pages").select("page_id", F.left(F.element_at(lines, -1), F.lit(80)).alias("last_line"), F.size(F.slice(lines, 1, 5)).alias("n_first"))


@query("""
WITH p AS (SELECT contains(lower(html), '<!doctype') AND contains(lower(html), '<html') AS whole, regexp_matches(html, '(?s)```[a-zA-Z0-9+#.\\-]*\\n(.*?)```') AS fenced, length(html) AS n FROM pages)
SELECT count(*)::BIGINT AS n, count(*) FILTER (whole)::BIGINT AS n_whole, count(*) FILTER (fenced)::BIGINT AS n_fenced, sum(n)::BIGINT AS n_chars FROM p
""".replace("\\\\", "\\"))
def web_counts(spark, sf_dir):
    """How many pages are whole documents, and how many have a fence."""
    low = F.lower("html")
    pages = table(spark, sf_dir, "pages")
    return pages.agg(F.count("*").alias("n"), F.count_if(low.contains("<!doctype") & low.contains("<html")).alias("n_whole"), F.count_if(tx.has_fence(F.col("html"))).alias("n_fenced"), F.sum(F.length("html")).alias("n_chars"))


@query("""
WITH k AS (SELECT trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS key FROM documents)
SELECT count(*) FILTER (key = '')::BIGINT AS n_blank, count(DISTINCT key) FILTER (key <> '')::BIGINT AS n_keys FROM k
""".replace("\\\\", "\\"))
def key_counts(spark, sf_dir):
    """Blank rows and distinct keys."""
    keys = dedup.keyed(table(spark, sf_dir, "documents").select("text"))
    return keys.agg(F.count_if(~gates.none_blank(F.col("key"))).alias("n_blank"), F.count_distinct(F.when(F.col("key") != "", F.sha2("key", 256))).alias("n_keys"))
