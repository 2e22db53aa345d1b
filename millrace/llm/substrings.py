"""Substring dedup by difference-cover anchors.

A set D is a difference cover modulo v if every difference modulo v is one of two
members of D. Short windows (anchors) are hashed only where a word's place in its
text is in D modulo v. If two passages of n words are equal, then for some shift
below v both places are in D at once, so the two share an anchor of n - v + 1
words. Only passages of n words that hold an anchor seen twice are then compared
by their own hashes, all over the corpus.

Steps: (1) every batch of texts sends its distinct anchors, (2) passages around
anchors that were seen twice send their hashes, (3) what lies in a passage that
was seen twice goes. Steps are summed in `scatter`, so that neither a very common
passage nor a long text meets in one task.

Hashes of passages have 64 bits and are compared within groups that another hash
deals out; with a number of groups in proportion to the input, the expected number
of chance collisions stays below one at 100 TB.

Defined results: null text has no words; a text shorter than the window keeps all
of its words; repeated rows repeat each other, whatever their doc_id; other columns
are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import scatter
from .store import cut, discard, parts_for
from .words import Words, chunks, cover, window_starts, windows, words

#: Difference covers by period: fixed values, perfect difference sets.
COVERS = {1: [0], 3: [0, 1], 7: [0, 1, 3], 13: [0, 1, 3, 9], 21: [0, 1, 4, 14, 16], 31: [0, 1, 3, 8, 12, 18]}
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
ANCHOR_BYTES = 4  # anchors only choose what is compared; a chance match costs time, not a result


def period_for(window: int) -> int:
    """The largest period that leaves two fifths of the window to the anchor."""
    return max(v for v in COVERS if v <= max(1, 0.6 * window))


def _anchors(w: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of anchors among all words, and their hashes."""
    v = period_for(window)
    length = window - v + 1
    hashed = windows(w.hash, length)
    place = np.arange(len(hashed)) - np.repeat(w.first[:-1], w.count)[: len(hashed)]
    inside = np.isin(np.arange(v), COVERS[v])[place % v]
    at = np.flatnonzero(inside & window_starts(w.first, length) & np.repeat(w.count >= window, w.count)[: len(hashed)])
    return at, hashed[at]


def _candidates(w: Words, at: np.ndarray, seen: np.ndarray, window: int) -> np.ndarray:
    """Starts of whole windows around an anchor that was seen twice."""
    v = period_for(window)
    flag = np.zeros(len(w.hash) + 1, np.int64)
    flag[at[seen] + 1] = 1
    upto = np.cumsum(flag)
    ok = window_starts(w.first, window)
    s = np.arange(len(ok))
    return np.flatnonzero(ok & (upto[np.minimum(s + v, len(upto) - 1)] > upto[s]))


def _passages(w: Words, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows at starts."""
    return windows(w.hash, window)[starts], windows(w.hash, window, 0xC2B2AE3D27D4EB4F)[starts]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    unique, index, inverse, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return unique, index, inverse, count >= 2


def _kept(w: Words, gone: np.ndarray, ids: pa.Array) -> pa.Table:
    """One row per text: what is left when the words of `gone` are."""
    removed, digests = [], []
    stay = ~gone
    data = w.data.tobytes()
    for a, b in zip(w.first, w.first[1:], strict=False):
        k = np.flatnonzero(stay[a:b]) + a
        digests.append(hashlib.sha256(b" ".join([data[s:e] for s, e in zip(w.start[k].tolist(), w.end[k].tolist(), strict=True)])).hexdigest())
        removed.append(int(b - a) - len(k))
    return pa.table({"doc_id": ids.cast(pa.int64()), "n_words": pa.array(w.count, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})


def remove_repeats(docs: DataFrame, window: int = 35, batch_bytes: int = 4 << 20, fan: int | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): how many words repeated windows cover, and the digest of the rest. fan: the most groups that a batch sends to (see `scatter`)."""
    dealt = scatter.Fan.of(parts_for(docs), batch_bytes // 30, fan)
    parts = dealt.lanes
    docs = docs.select("doc_id", "text")

    def first(batches):
        bids = scatter.named()
        for chunk in chunks(batches, most=batch_bytes):
            bid = next(bids)
            _, hashed = _anchors(words(chunk["text"]), window)
            keys, _, _, count = _distinct(hashed)
            yield scatter.rows((bid, scatter.TEXTS, chunk.num_rows, None, None, scatter.pack(chunk)), *scatter.send(bid, keys, count, keys, parts, ANCHOR_BYTES))

    def second(bid: str, table: pa.Table, answer: pa.Table) -> pa.Table:
        w = words(table["text"])
        at, hashed = _anchors(w, window)
        keys, _, inverse, _ = _distinct(hashed)
        seen = scatter.gathered(answer, *scatter.deal(keys, parts), scatter.bits, bool)
        starts = _candidates(w, at, seen[inverse] if len(keys) else np.zeros(0, bool), window)
        touched = np.zeros(len(table), bool)
        touched[np.searchsorted(w.first, starts, "right") - 1] = True
        out = []
        if not touched.all():
            rest = table.filter(pa.array(~touched))
            v = words(rest["text"])
            out.append((bid, scatter.DONE, len(rest), None, None, scatter.pack(_kept(v, np.zeros(len(v.hash), bool), rest["doc_id"]))))
        if touched.any():
            passage, lane = _passages(w, starts, window)
            keys, index, _, count = _distinct(passage)
            out += scatter.send(bid, keys, count, lane[index], parts)
            out.append((bid, scatter.TEXTS, int(touched.sum()), None, None, scatter.pack(pa.table({"doc_id": table["doc_id"], "text": table["text"]}).filter(pa.array(touched)))))
            # the starts, as places among the words of the texts that go on
            new = np.cumsum(np.repeat(touched, w.count)) - 1
            out[-1] = (*out[-1][:4], new[starts].astype(np.int64).tobytes(), out[-1][5])
        return pa.Table.from_batches([scatter.rows(*out)])

    def third(left: pa.Table, right: pa.Table) -> pa.Table:
        table = scatter.unpack(left["texts"][0].as_py())
        starts = np.frombuffer(left["vals"][0].as_py(), np.int64)
        w = words(table["text"])
        passage, lane = _passages(w, starts, window)
        keys, index, inverse, _ = _distinct(passage)
        seen = scatter.gathered(right, *scatter.deal(lane[index], parts), scatter.bits, bool)
        return _kept(w, cover(starts[seen[inverse]], window, len(w.hash)), table["doc_id"])

    sent = cut(docs.mapInArrow(first, scatter.ROWS))
    twice = scatter.totals_by(dealt, sent, "bit", scatter.many, ANCHOR_BYTES)
    again = cut(scatter.meet(sent.where(f"p = {scatter.TEXTS}"), twice, second, scatter.ROWS))
    discard(sent)  # the rest reads `again` alone
    found = scatter.totals_by(dealt, again, "bit", scatter.many)
    texts = again.where(f"p = {scatter.TEXTS}").select("bid", "vals", "texts")
    rest = texts.groupBy("bid").cogroup(found.groupBy("bid")).applyInArrow(third, RESULT)
    return rest.unionByName(scatter.done(again, RESULT))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 35 words, over all documents."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), 35)


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT r, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35
), h AS (
  SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS k FROM s
), d AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS c FROM h) WHERE c > 1
), g AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM d
), gone AS (
  SELECT r, list(j) AS js FROM g GROUP BY r
), e AS (
  SELECT w.r, doc_id, ws, coalesce(js, []) AS js FROM w LEFT JOIN gone ON w.r = gone.r
), x AS (
  SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w
), kept AS (
  SELECT x.r, string_agg(x.word, ' ' ORDER BY x.j) AS t FROM x ANTI JOIN g ON x.r = g.r AND x.j = g.j GROUP BY x.r
)
SELECT e.doc_id, len(ws)::BIGINT AS n_words, len(js)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM e LEFT JOIN kept ON e.r = kept.r
"""
