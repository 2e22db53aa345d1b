"""Benchmark decontamination by winnowing.

A text's fingerprints are the minima of the hashes of k-grams of words in each
sliding window of w of them. Two texts that share n = w + k - 1 consecutive words
share the window over them, so they share its minimum: every shared span of n
words is found. An item of fewer than n words is one window of its own length; as
winnowing gives no guarantee for those, its fingerprint is the window itself.

Fingerprints of documents are joined with those of the benchmark, and the windows
of those that meet are joined with its windows (by 128 bits of two hashes), which
extends hits to whole windows; every word inside one is hit. Both are shuffles;
neither the benchmark nor texts go through the driver, and each document is read
and cut into words once, however large the benchmark is. Ahead of the shuffle,
2^FILTER_BITS bits of the benchmark's fingerprints (8 MB, whatever its size) drop
nearly all fingerprints of clean documents; what passes by chance is dropped by the
join. Windows go by the set of items that hold them, and documents by the
combination of these sets, so that each list of items is made once, not once a
document: a passage that many items and many documents share costs their sum.

Defined results: null texts have no words and no hits; items of null or empty
text hit nothing; item rows with one item_id count once, a null item_id is
written as "null"; repeated documents give repeated rows; other columns are not
read, whatever their names (`drop_contaminated` keeps them); an empty table gives
no rows, an empty benchmark no hits. One text has to fit in a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .store import attach, cut, discard
from .words import ALNUM, U64, Words, chunks, window_starts, windows, words

FILTER_BITS = 26
SECOND = 0xC2B2AE3D27D4EB4F
LISTS = "print array<long>, at array<int>, n array<int>, win array<binary>"
PAGE = 32768  # bits that one row of the filter holds, as Spark's bitmap functions cut them


def minima(hashed: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive values."""
    out, have = hashed, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def fingerprints(w: Words, length: int, n: int, k: int) -> np.ndarray:
    """The fingerprint of each window of `length` words: of all places but the last length - 1."""
    return windows(w.hash, length) if length < n else minima(windows(w.hash, k), n - k + 1)


def _lists(w: Words, found: list[tuple[int, np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """The columns of LISTS, one row a text. found: length, places and fingerprints of windows."""
    at = np.concatenate([a for _, a, _ in found] or [np.zeros(0, np.int64)])
    of = np.searchsorted(w.first, at, "right") - 1
    order = np.argsort(of, kind="stable")
    prints = np.concatenate([p for _, _, p in found] or [np.zeros(0, U64)])[order]
    lengths = np.concatenate([np.full(len(a), n, np.int32) for n, a, _ in found] or [np.zeros(0, np.int32)])[order]
    keys = np.concatenate([np.stack([windows(w.hash, n)[a], windows(w.hash, n, SECOND)[a]], 1) for n, a, _ in found] or [np.zeros((0, 2), U64)])[order]
    binary = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(np.arange(len(keys) + 1, dtype=np.int32) * np.int32(16)), pa.py_buffer(np.ascontiguousarray(keys))])
    edges = pa.array(np.searchsorted(of[order], np.arange(len(w.first))), pa.int32())
    values = [pa.array(prints.view(np.int64)), pa.array((at - w.first[of])[order], pa.int32()), pa.array(lengths), binary]
    return [pa.ListArray.from_arrays(edges, v) for v in values]


def _of_items(n: int, k: int):
    """All windows of items."""

    def work(batches):
        for chunk in chunks(batches):
            w = words(chunk["text"], ALNUM, fold=True)
            found = []
            for length in sorted({min(int(c), n) for c in w.count if c}):
                fits = w.count == length if length < n else w.count >= n
                at = np.flatnonzero(window_starts(w.first, length))
                at = at[fits[np.searchsorted(w.first, at, "right") - 1]]
                found.append((length, at, fingerprints(w, length, n, k)[at]))
            yield pa.RecordBatch.from_arrays([chunk["item_id"], *_lists(w, found)], names=["item_id", "print", "at", "n", "win"])

    return work


def _of_documents(shared, lengths: list[int], n: int, k: int, bits: int, own: str, counts: bool):
    """Windows whose fingerprints pass the filter, with the column `own`; counts: for all texts, with their numbers of words, else only for those with such windows."""

    def work(batches):
        held = np.frombuffer(shared.value, np.uint8)
        mask = U64((1 << bits) - 1)

        def set_at(i: np.ndarray) -> np.ndarray:
            return (held[i >> U64(3)] >> (i & U64(7)).astype(np.uint8)) & 1 == 1

        for chunk in chunks(batches):
            w = words(chunk["text"], ALNUM, fold=True)
            found = []
            for length in lengths:
                prints = fingerprints(w, length, n, k)
                at = np.flatnonzero(set_at(prints & mask))
                at = at[set_at((prints[at] >> U64(32)) & mask)]
                at = at[window_starts(w.first, length)[at]]
                found.append((length, at, prints[at]))
            out = pa.RecordBatch.from_arrays([chunk[own], pa.array(w.count, pa.int64()), *_lists(w, found)], names=[own, "n_words", "print", "at", "n", "win"])
            if counts:
                yield out
            else:
                yield out.filter(pc.greater(pc.list_value_length(out["print"]), 0)).drop_columns(["n_words"])

    return work


def filter_bits(prints: DataFrame, bits: int) -> bytes:
    """The bits that the fingerprints (print) set, two each: 2^bits of them, so that is what the driver gets, however many rows there are."""
    low, high = F.col("print").bitwiseAND(F.lit((1 << bits) - 1)), F.shiftrightunsigned("print", 32).bitwiseAND(F.lit((1 << bits) - 1))
    pages = prints.select(F.explode(F.array(low, high)).alias("bit")).groupBy(F.floor(F.col("bit") / PAGE).alias("page")).agg(F.bitmap_construct_agg(F.col("bit") % PAGE).alias("held"))
    out = bytearray(max(PAGE, 1 << bits) // 8)
    for r in pages.collect():
        out[r["page"] * PAGE // 8 : (r["page"] + 1) * PAGE // 8] = r["held"]
    return bytes(out)


def _flat(df: DataFrame, own: str) -> DataFrame:
    return df.select(own, F.inline(F.arrays_zip("print", "at", "n", "win")))


class Benchmark:
    """The windows of benchmark (item_id, text): their fingerprints, and the set of items that holds each."""

    def __init__(self, benchmark: DataFrame, n: int, k: int, bits: int):
        items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text").where("text IS NOT NULL")
        rows = _flat(items.mapInArrow(_of_items(n, k), "item_id string, " + LISTS), "item_id")
        self.n, self.k, self.bits = n, k, bits
        self.windows = cut(rows.groupBy("win").agg(F.min("print").alias("print"), F.min("n").alias("n"), F.sort_array(F.collect_set("item_id")).alias("items")).withColumn("set", F.sha2(F.to_json("items"), 256)))
        self.lengths = sorted(r[0] for r in self.windows.select("n").distinct().collect())
        self.shared = benchmark.sparkSession.sparkContext.broadcast(filter_bits(self.windows, bits))

    def candidates(self, docs: DataFrame, own: str, kind: str, counts: bool) -> DataFrame:
        """Windows of docs (own, text) that pass the filter, as lists: not computed yet."""
        work = _of_documents(self.shared, self.lengths, self.n, self.k, self.bits, own, counts)
        return docs.select(own, "text").mapInArrow(work, f"{own} {kind}, " + ("n_words long, " if counts else "") + LISTS)

    def hits(self, found: DataFrame) -> DataFrame:
        """Of windows found (_row, print, at, n, win) those of the benchmark: _row, at, n, set."""
        found = found.withColumn("print", F.col("print").cast("string"))
        known = self.windows.select(F.col("print").cast("string").alias("print")).distinct()
        met = cut(self._weighed(known, found, "print"))
        both = cut(attach(found, met, "print", "_w", found.count(), F.concat(F.lit("row"), _spread())).where("_w IS NOT NULL").drop("_w", "print"))
        sets = cut(self._weighed(self.windows.select("win", "set"), both, "win"))
        out = cut(attach(both, sets, "win", "_w", both.count(), F.concat("win", F.encode(_spread(), "utf-8"))).where("set IS NOT NULL").select("_row", "at", "n", "set"))
        for frame in (met, both, sets):
            discard(frame)
        return out

    @staticmethod
    def _weighed(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
        """table's entries that rows hold, and in how many of them (_w)."""
        return table.join(rows.groupBy(key).agg(F.count("*").alias("_w")), key)

    def lists(self, sets: DataFrame) -> DataFrame:
        """For each combination (combo, sets) how many items hold one of its windows, and the digest of their names."""
        of = self.windows.select("set", "items").dropDuplicates(["set"])
        each = sets.select("combo", F.explode("sets").alias("set")).join(of, "set").select("combo", F.explode("items").alias("item")).distinct()
        named = each.groupBy("combo").agg(F.sort_array(F.collect_list("item")).alias("items"))
        return named.select("combo", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))

    def discard(self) -> None:
        """Let go of the filter and the table, when all that was made of them has been cut."""
        self.shared.destroy()
        discard(self.windows)


def _spread() -> Column:
    return F.xxhash64("_row", "at").cast("string")


def words_hit(hits: DataFrame) -> DataFrame:
    """Per _row: how many words its windows (at, n) cover."""
    ahead = Window.partitionBy("_row").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("n")
    covered = F.greatest(F.lit(0), end - F.greatest(F.col("at"), F.coalesce(F.max(end).over(ahead), F.lit(0))))
    return hits.select("_row", covered.alias("_new")).groupBy("_row").agg(F.sum("_new").cast("long").alias("n_hit"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, k: int = 4, bits: int = FILTER_BITS) -> DataFrame:
    """Per row of docs (doc_id, text): how many words lie in n-word windows of benchmark (item_id, text), and of which items."""
    given = Benchmark(benchmark, n, k, bits)
    rows = cut(given.candidates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", "long", True).withColumn("_row", F.monotonically_increasing_id()))
    hits = given.hits(_flat(rows.where(F.size("print") > 0), "_row"))
    of = hits.groupBy("_row").agg(F.sort_array(F.collect_set("set")).alias("sets")).withColumn("combo", F.sha2(F.array_join("sets", ","), 256))
    of = cut(of.join(words_hit(hits), "_row"))
    weights = of.groupBy("combo").agg(F.first("sets").alias("sets"), F.count("*").alias("_w"))
    lists = cut(given.lists(weights.select("combo", "sets")).join(weights.select("combo", "_w"), "combo"))
    named = attach(of.select("_row", "n_hit", "combo"), lists, "combo", "_w", of.count(), F.concat(F.lit("row"), F.col("_row").cast("string")))
    given.discard()
    discard(hits)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select("_row", "doc_id", "n_words").join(named, "_row", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, k: int = 4, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of docs without any hit, with all of their columns. Rows go by the digest of their texts, so equal texts go or stay together."""
    given = Benchmark(benchmark, n, k, bits)
    texts = docs.select(F.sha2("text", 256).alias("_row"), "text").where("text IS NOT NULL")
    found = cut(given.candidates(texts, "_row", "string", False))
    dirty = cut(given.hits(_flat(found, "_row")).select("_row").distinct())
    given.discard()
    discard(found)
    return docs.join(dirty, F.sha2(docs["text"], 256) == dirty["_row"], "left_anti")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 10 words of the benchmark in all documents."""
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS k
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)
), m AS (
  SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k
), h AS (
  SELECT r, count(DISTINCT j)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM m) GROUP BY r
), t AS (
  SELECT r, count(*)::BIGINT AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN t ON d.r = t.r
"""
