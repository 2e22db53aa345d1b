"""Which texts hold passages of another set, verbatim, found by joins of anchors.

Of each run of REACH grams of GRAM bytes the one with the least hash is a print. A text
that holds a passage holds all of its runs, and so all of its prints. A passage is
asked for by FEW of its prints; the one that fewest texts have is its anchor, and a
passage with a print that no text has is in none. Texts and passages that share an
anchor are compared by Spark's own `contains`, so prints decide what is compared and
never the result. Passages that are shorter than a run go by single grams, and those
shorter than a gram by all of their bytes.

Texts are cut once, however many passages there are, and neither set goes through the
driver: ahead of the joins 2^FILTER_BITS bits of the prints asked for (8 MB at any
size) drop nearly all prints of texts that hold none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..sources.shared import written_once

GRAM, REACH, FEW, FILTER_BITS = 8, 25, 4, 26
RUN = GRAM + REACH - 1
PIECE = 2 << 20
#: Bits in one row of Spark's bitmap functions.
PAGE = 32768
U64 = np.uint64


def _hashed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins and the last ends. Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    edges = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int64)
    start = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset] if len(texts) else 0
    held = texts.buffers()[2]
    return (np.frombuffer(held, np.uint8)[start : start + edges[-1]] if held is not None else np.zeros(0, np.uint8)), edges


def _prints(data: np.ndarray, kind: int) -> tuple[np.ndarray, int]:
    """A print for each place of data, and how many bytes it speaks for. kind: 0 for the least of a run, else a gram's bytes."""
    size = kind or GRAM
    grams = np.full(max(0, len(data) - size + 1), kind << 56 if size < GRAM else 0, U64)
    for i in range(size):
        grams |= data[i : i + len(grams)].astype(U64) << U64(8 * i)
    grams = _hashed(grams)
    if kind:
        return grams, size
    if len(grams) < REACH:
        return grams[:0], RUN
    least, have = grams, 1
    while have < REACH:
        step = min(have, REACH - have)
        least, have = np.minimum(least[:-step], least[step:]), have + step
    return least, RUN


def _of_texts(place: np.ndarray, span: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of some places whose span stays within its text, and the texts."""
    text = np.searchsorted(edges, place, "right") - 1
    fits = place + span <= edges[text + 1]
    return place[fits], text[fits]


def kind_of(size):
    """By which prints a passage of so many bytes is found."""
    return np.where(size >= RUN, 0, np.minimum(size, GRAM))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, kind, print): FEW prints of each passage, or all if it has fewer."""
    for batch in batches:
        data, edges = _bytes(batch["passage"])
        kinds = kind_of(np.diff(edges))
        for kind in np.unique(kinds[np.diff(edges) > 0]).tolist():
            prints, span = _prints(data, kind)
            place, text = _of_texts(np.arange(len(prints)), span, edges)
            mine = kinds[text] == kind
            both = np.unique(np.stack([text[mine].astype(U64), prints[place[mine]]], 1), axis=0)
            first = np.searchsorted(both[:, 0], both[:, 0])
            both = both[np.arange(len(both)) - first < FEW]
            yield pa.RecordBatch.from_arrays([batch["_id"].take(pa.array(both[:, 0].astype(np.int64))), pa.array(np.full(len(both), kind, np.int32)), pa.array(both[:, 1].copy().view(np.int64))], names=["_id", "kind", "print"])


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut to PIECE bytes of text each, or one text: arrays of prints take some fifty times that."""
    size = pc.fill_null(pc.binary_length(batch["text"].cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.diff(np.cumsum(size) // PIECE, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], len(size)], strict=True):
        yield batch.slice(a, b - a)


def _held(shared, kinds: list[int], bits: int):
    """(_digest, prints): prints of texts that the filter lets through."""
    low = U64((1 << bits) - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.frombuffer(shared.value, np.uint8)

        def has(bit: np.ndarray) -> np.ndarray:
            return (filled[bit >> U64(3)] >> (bit & U64(7)).astype(np.uint8)) & 1 == 1

        for part in (p for batch in batches for p in _pieces(batch)):
            data, edges = _bytes(part["text"])
            some = [np.zeros((0, 2), U64)]
            for kind in kinds:
                prints, span = _prints(data, kind)
                place = np.flatnonzero(has(prints & low))
                place, text = _of_texts(place[has((prints[place] >> U64(32)) & low)], span, edges)
                some.append(np.unique(np.stack([text.astype(U64), prints[place]], 1), axis=0))
            found = np.unique(np.concatenate(some), axis=0)
            texts, first = np.unique(found[:, 0], return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(found)).astype(np.int32)), pa.array(found[:, 1].copy().view(np.int64)))
            yield pa.RecordBatch.from_arrays([part["_digest"].take(pa.array(texts.astype(np.int64))), lists], names=["_digest", "prints"])

    return work


def filter_bits(prints: DataFrame, bits: int) -> bytes:
    """Two bits of 2^bits for each print. The driver gets these bits, however many prints there are."""
    low, high = F.col("print").bitwiseAND(F.lit((1 << bits) - 1)), F.shiftrightunsigned("print", 32).bitwiseAND(F.lit((1 << bits) - 1))
    pages = prints.select(F.explode(F.array(low, high)).alias("bit")).groupBy(F.floor(F.col("bit") / PAGE).alias("page")).agg(F.bitmap_construct_agg(F.col("bit") % PAGE).alias("set"))
    out = bytearray(max(PAGE, 1 << bits) // 8)
    for r in pages.collect():
        out[r["page"] * PAGE // 8 : (r["page"] + 1) * PAGE // 8] = r["set"]
    return bytes(out)


def anchored(df: DataFrame, passages: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """(_digest, _id) of texts (_digest, text) and passages (_id, passage) that share the passage's anchor: a superset of those that hold it."""
    asked = written_once(passages.select("_id", "passage").mapInArrow(_asked, "_id long, kind int, print long"))
    kinds = sorted(r[0] for r in asked.select("kind").distinct().collect())  # nine at most
    shared = df.sparkSession.sparkContext.broadcast(filter_bits(asked, bits))
    texts = df.select("_digest", "text").where(F.length("text") > 0).mapInArrow(_held(shared, kinds, bits), "_digest string, prints array<long>")
    held = written_once(texts.groupBy("_digest").agg(F.first("prints").alias("prints")).select("_digest", F.explode("prints").alias("print")))
    shared.destroy()
    counts = held.join(asked.select("print").distinct(), "print", "left_semi").groupBy("print").agg(F.count("*").alias("n"))
    anchors = asked.join(counts, "print", "left").groupBy("_id").agg(F.min_by("print", F.coalesce("n", F.lit(0))).alias("print"), F.min(F.coalesce("n", F.lit(0))).alias("n"))
    return held.join(anchors.where("n > 0").select("_id", "print"), "print").select("_digest", "_id")


def contains_passage(df: DataFrame, passages: DataFrame, text: str = "text", passage: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """df with n_passages: how many passages each text holds verbatim (a passage given twice counts twice). Null texts hold none; empty and null passages count for nothing.

    Rows go by the digest of their text; where n_passages is asked for beside narrow columns, texts are not shuffled but for those compared.
    """
    given = passages.where(F.length(passage) > 0).groupBy(F.col(passage).alias("passage")).agg(F.count("*").alias("n"))
    given = written_once(given.withColumn("_id", F.monotonically_increasing_id()))
    texts = df.select(F.sha2(text, 256).alias("_digest"), F.col(text).alias("text"))
    pairs = anchored(texts, given, bits)
    asked = pairs.join(given, "_id").groupBy("_digest").agg(F.collect_list(F.struct("passage", "n")).alias("asked"))
    held = F.filter("asked", lambda p: F.contains(F.col("text"), p["passage"]))
    found = written_once(texts.join(asked, "_digest").select("_digest", F.aggregate(held, F.lit(0).cast("long"), lambda s, p: s + p["n"]).alias("n_passages")).distinct())
    return df.withColumn("_digest", F.sha2(text, 256)).join(found, "_digest", "left").drop("_digest").withColumn("n_passages", F.coalesce("n_passages", F.lit(0).cast("long")))
