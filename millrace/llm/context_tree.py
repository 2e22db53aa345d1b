"""Language-model scoring by context-tree weighting, with unigram statistics beside it.

Bytes (A-Z folded) are split into eight binary decisions. Each decision has a tree
of contexts: no byte before, the last byte, and so on to the last DEPTH bytes. A
node with a zeros and b ones has the Krichevsky-Trofimov block probability
Pe(a, b), which depends on counts alone, so counts may be summed in any order over
the cluster. Bottom-up, Pw = (Pe + product of the children's Pw) / 2 weighs a node
against the subtree below it; a prediction mixes the estimates of all depths along
the path with these weights. A context that training never saw adds no node: the
mixture ends at its parent. Every text ends with a zero byte. The score is the
log10 probability of the text and its end; its code length is -score * log2(10) bits.

A context with the byte after it is a gram. Counts of grams come from all training
texts: batches send their distinct grams with counts, groups by a hash of the gram
add them up, and groups by the last three bytes of the context then hold whole
subtrees of depth 3 and more: of five bytes, 2^24 grams at most, whatever the corpus.
Nodes of depth 2 are summed by the last two bytes, in at most 65,536 lots of 255 nodes,
and sent to the groups below them. What lies above, 65,536 nodes at most, is summed up at the
driver and broadcast. Predictions go back to the batches by the same ways, as words'
counts do, in two levels where there are many groups (see `scatter`), so the model
never meets in one place and rows sent grow as batches do.

Defined results: null text is empty and scored as its end alone; a null doc_id has
no crc32, and is never held out; repeated rows count as often as they occur; other
columns are not read; an empty table gives no rows; without training texts every
bit has probability 1/2.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import scatter
from .store import cut, parts_for
from .words import U64, chunks, mix, raw, words

RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
END = U64(0x454E445F4F465F54)  # the key of the end token; fixed
DEPTH = 5
#: Rows of grams are in groups numbered down from here, those of words up from 0.
GRAMS = -10
SUMS = "q int, p int, keys binary, vals binary"
LEVEL = "q int, lot int, keys binary, vals binary"
TOP = "key int, zeros double, ones double, below double"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for positive x: Stirling's series beyond 8."""
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        small = y < 8
        shift[small] -= np.log(y[small])
        y[small] += 1
    z = 1 / (y * y)
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y


def log_pe(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - math.log(math.pi) - log_gamma(a + b + 1)


def grams(texts: pa.Array, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of each text and its end with `depth` bytes before it (zero before the text), as one number, and where texts begin."""
    data, offsets = raw(texts)
    n = len(offsets) - 1
    first = offsets + np.arange(n + 1)
    byte = np.zeros(len(data) + n, np.uint8)
    here = np.ones(len(byte), bool)
    here[first[1:] - 1] = False
    byte[here] = _FOLD[data]
    del here
    code = byte.astype(U64)
    for d in range(1, depth + 1):
        before = np.zeros_like(byte)
        before[d:] = byte[: max(0, len(byte) - d)]
        for k in range(d):  # no byte before the text
            start = first[:-1] + k
            before[start[start < first[1:]]] = 0
        code |= np.left_shift(before, U64(8 * d), dtype=U64)
    return code, first


def pieces(texts: pa.Array, step: int = 1 << 20) -> Iterator[pa.Array]:
    """Texts by runs of about `step` bytes, which keep the memory small."""
    for batch in chunks([pa.record_batch({"text": texts})] if len(texts) else [], most=step):
        yield batch["text"]


def counted(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of texts, sorted, and how often each occurs."""
    # sorts of numbers alone are several times as fast as those that keep track of places
    some = [np.unique(np.sort(grams(t, depth)[0]), return_counts=True) for t in pieces(texts)]
    codes = np.unique(np.concatenate([np.zeros(0, U64), *(c for c, _ in some)]))
    counts = np.zeros(len(codes), np.int32)
    for c, n in some:
        counts[np.searchsorted(codes, c)] += n.astype(np.int32)
    return codes, counts


class Nodes:
    """The nodes that grams visit at one decision: for each depth, which node each gram is at, and the nodes' counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, k: int, depths: range):
        byte = codes & U64(255)
        self.ones = ((byte >> U64(7 - k)) & U64(1)).astype(bool)
        node = (U64(1 << k)) | (byte >> U64(8 - k))
        self.at, self.pe, self.kt, self.seen, self.first, self.zeros_ones, self.key = {}, {}, {}, {}, {}, {}, {}
        for d in depths:
            key = (((codes >> U64(8)) & U64((1 << (8 * d)) - 1)) << U64(8)) | node
            self.key[d], self.first[d], at = np.unique(key, return_index=True, return_inverse=True)
            a = np.bincount(at, np.where(self.ones, 0, counts), len(self.key[d]))
            b = np.bincount(at, np.where(self.ones, counts, 0), len(self.key[d]))
            self.at[d], self.pe[d], self.kt[d], self.seen[d], self.zeros_ones[d] = at, log_pe(a, b), (b + 0.5) / (a + b + 1), a + b > 0, (a, b)

    def weigh(self, low: int, high: int) -> tuple[dict, dict]:
        """log Pw of each node of depths low to high, and the weight of its own estimate."""
        pw, own = {high: self.pe[high]}, {}
        for d in range(high - 1, low - 1, -1):
            below = np.bincount(self.at[d][self.first[d + 1]], pw[d + 1], len(self.key[d]))
            pw[d] = np.logaddexp(math.log(0.5) + self.pe[d], math.log(0.5) + below)
            own[d] = np.exp(math.log(0.5) + self.pe[d] - pw[d])
        return pw, own


class Top:
    """The nodes of depths 0 and 1, with their weights: arrays over (last byte, node of the byte)."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        a, b, under = np.zeros(65536), np.zeros(65536), np.zeros(65536)
        a[key], b[key], under[key] = zeros, ones, below
        pe = log_pe(a, b)
        pw = np.logaddexp(math.log(0.5) + pe, math.log(0.5) + under)
        self.kt1, self.own1, self.seen1 = (b + 0.5) / (a + b + 1), np.exp(math.log(0.5) + pe - pw), a + b > 0
        a0, b0, under0 = (x.reshape(256, 256).sum(0) for x in (a, b, np.where(self.seen1, pw, 0)))
        pe0 = log_pe(a0, b0)
        self.kt0, self.own0 = (b0 + 0.5) / (a0 + b0 + 1), np.exp(math.log(0.5) + pe0 - np.logaddexp(math.log(0.5) + pe0, math.log(0.5) + under0))


class Second:
    """The nodes of depth 2 that some grams visit, with their weights: keys (last two bytes, node), sorted, and zeros, ones and the sum of log Pw below of each."""

    def __init__(self, keys: np.ndarray, sums: np.ndarray, depth: int):
        a, b, below = sums
        pe = log_pe(a, b)
        self.keys, self.zeros, self.ones = keys, a, b
        self.pw = pe if depth == 2 else np.logaddexp(math.log(0.5) + pe, math.log(0.5) + below)
        self.kt, self.own, self.seen = (b + 0.5) / (a + b + 1), np.exp(math.log(0.5) + pe - self.pw), a + b > 0

    def above(self) -> tuple[np.ndarray, np.ndarray]:
        """What these add to nodes of depth 1: keys (last byte, node), and rows of zeros, ones, sum of log Pw below."""
        return added(self.keys & U64(0xFFFF), np.stack([self.zeros, self.ones, self.pw]))


def added(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the rows of sums added up for each."""
    names, at = np.unique(keys, return_inverse=True)
    return names, np.stack([np.bincount(at, x, len(names)) for x in sums])


def second_parts(codes: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """What the subtrees of these grams add to nodes of depth 2: keys (last two bytes, node), and rows of zeros, ones, sum of log Pw below."""
    low, parts = min(3, depth), []
    for k in range(8):
        nodes = Nodes(codes, counts, k, range(low, depth + 1))
        pw, _ = nodes.weigh(low, depth)
        parts.append(added(nodes.key[low] & U64(0xFFFFFF), np.stack([*nodes.zeros_ones[low], pw[low]])))
    return np.concatenate([n for n, _ in parts]), np.concatenate([x for _, x in parts], axis=1)


def predictions(codes: np.ndarray, counts: np.ndarray, depth: int, second: Second, top: Top) -> np.ndarray:
    """The log10 probability of each gram's byte after its context."""
    low, out = min(3, depth), np.zeros(len(codes))
    for k in range(8):
        n = Nodes(codes, counts, k, range(low, depth + 1))
        _, own = n.weigh(low, depth)
        value = n.kt[depth][n.at[depth]]
        for d in range(depth - 1, low - 1, -1):
            kt, w = n.kt[d][n.at[d]], own[d][n.at[d]]
            value = np.where(n.seen[d + 1][n.at[d + 1]], w * kt + (1 - w) * value, kt)
        at = np.searchsorted(second.keys, n.key[low] & U64(0xFFFFFF))[n.at[low]]
        if depth > 2:
            kt, w = second.kt[at], second.own[at]
            value = np.where(n.seen[3][n.at[3]], w * kt + (1 - w) * value, kt)
        key = (second.keys[at] & U64(0xFFFF)).astype(np.int64)
        value = np.where(second.seen[at], top.own1[key] * top.kt1[key] + (1 - top.own1[key]) * value, top.kt1[key])
        node = key & 255
        value = np.where(top.seen1[key], top.own0[node] * top.kt0[node] + (1 - top.own0[node]) * value, top.kt0[node])
        out += np.log10(np.where(n.ones, value, 1 - value))
    return out


def _held(ids: pa.Array, modulus: int, remainder: int) -> np.ndarray:
    return np.array([x is not None and zlib.crc32(str(x).encode()) % modulus == remainder for x in ids.to_pylist()], bool)


def _distinct(w, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a batch with the end token, the index of each word, and their counts in training texts."""
    keys, inverse = np.unique(np.append(w.hash, END), return_inverse=True)
    count = np.bincount(inverse[:-1], weights=np.repeat(train, w.count), minlength=len(keys))
    count[inverse[-1]] += train.sum()
    return keys, inverse, count.astype(np.int32)


def _word_sums(kind: str):
    """A group's counts of words over all batches, for each batch in the order in which it sent its words; and a row without a bid that holds in p how many words of the group training has."""

    def add(table: pa.Table) -> pa.Table:
        keys = [scatter.risen(k, 8) for k in table["keys"].to_pylist()]
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(inverse, np.concatenate([np.frombuffer(scatter.plain(v), kind) for v in table["vals"].to_pylist()])).astype(np.int64)
        back = [_write_sums(x) for x in np.split(sums[inverse], np.cumsum([len(k) for k in keys])[:-1])]
        return pa.table({"bid": pa.array([*table["bid"].to_pylist(), None], pa.string()), "p": pa.array([*table["p"].to_pylist(), int((sums > 0).sum())], pa.int32()), "vals": pa.array([*back, None], pa.binary())})

    return add


def _write_sums(sums: np.ndarray) -> bytes:
    return scatter.pressed(sums.tobytes())


def _read_sums(blob: bytes, size: int) -> np.ndarray:
    return np.frombuffer(scatter.plain(blob), np.int64)


def _read_logs(blob: bytes, size: int) -> np.ndarray:
    return np.frombuffer(blob, np.float32)


def _summed(parts: int, width: int, kind: str):
    """A group of grams from all batches as sums, dealt by the last three bytes of their contexts."""

    def add(table: pa.Table) -> pa.Table:
        keys = np.concatenate([scatter.risen(k, width) for k in table["keys"].to_pylist()])
        counts = np.concatenate([np.frombuffer(scatter.plain(v), kind) for v in table["vals"].to_pylist()])
        names, at = np.unique(keys, return_inverse=True)
        sums = np.bincount(at, counts, len(names))
        lane = mix((names >> U64(8)) & U64(0xFFFFFF))
        order, cuts = scatter.deal(lane, parts)
        names, sums = names[order], sums[order]
        found = [(q, table["p"][0].as_py(), names[x:y].tobytes(), sums[x:y].tobytes()) for q, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if y > x]
        q, p, k, v = zip(*found, strict=True)
        return pa.table({"q": pa.array(q, pa.int32()), "p": pa.array(p, pa.int32()), "keys": pa.array(k, pa.binary()), "vals": pa.array(v, pa.binary())})

    return add


def _subtree(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int]]:
    keys, vals = ([np.frombuffer(x, kind) for x in table[c].to_pylist()] for c, kind in (("keys", U64), ("vals", np.float64)))
    return np.concatenate(keys), np.concatenate(vals), [len(k) for k in keys]


def _level(found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.Table:
    """Rows of LEVEL."""
    q, lot, keys, sums = zip(*found, strict=True) if found else ([], [], [], [])
    return pa.table({"q": pa.array(q, pa.int32()), "lot": pa.array(lot, pa.int32()), "keys": pa.array([x.tobytes() for x in keys], pa.binary()), "vals": pa.array([np.ascontiguousarray(x).tobytes() for x in sums], pa.binary())})


def _of_level(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    keys = [np.frombuffer(x, U64) for x in table["keys"].to_pylist()]
    return keys, [np.frombuffer(x, np.float64).reshape(3, -1) for x in table["vals"].to_pylist()]


def gram_answers(rows: DataFrame, parts: int, depth: int, kind: str) -> DataFrame:
    """For each batch (or merge of batches) and group of grams: their predictions, in the order in which they were sent. rows: bid, p, keys and counts (vals, of type `kind`)."""
    width = depth + 1

    def seconds(table: pa.Table) -> pa.Table:
        """A group's parts of nodes of depth 2, by lots of the last two bytes."""
        codes, counts, _ = _subtree(table)
        keys, sums = second_parts(codes, counts, depth)
        order, cuts = scatter.deal(mix(keys >> U64(8)), parts)
        keys, sums = keys[order], sums[:, order]
        return _level([(table["q"][0].as_py(), lot, keys[x:y], sums[:, x:y]) for lot, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if y > x])

    def whole(table: pa.Table) -> pa.Table:
        """A lot's nodes with all that groups know of them, for each group that asked; and for group -1 what they add to depth 1."""
        keys, sums = _of_level(table)
        names, total = added(np.concatenate(keys), np.concatenate(sums, axis=1))
        lot = table["lot"][0].as_py()
        out = [(q, lot, k, total[:, np.searchsorted(names, k)]) for q, k in zip(table["q"].to_pylist(), keys, strict=True)]
        return _level([*out, (-1, lot, *Second(names, total, depth).above())])

    def flat(batches):
        for batch in batches:
            for keys, sums in zip(*_of_level(batch), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), *(pa.array(x) for x in sums)], names=["key", "zeros", "ones", "below"])

    def predict(table: pa.Table, level: pa.Table) -> pa.Table:
        codes, counts, sizes = _subtree(table)
        keys, sums = (np.concatenate(x, axis=-1) for x in _of_level(level))
        order = np.argsort(keys)
        logs = predictions(codes, counts, depth, Second(keys[order], sums[:, order], depth), top.value).astype(np.float32)
        return pa.table({"p": table["p"], "keys": table["keys"], "vals": pa.array([x.tobytes() for x in np.split(logs, np.cumsum(sizes)[:-1])], pa.binary())})

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, U64) for x in right["keys"].to_pylist()])
        logs = np.concatenate([np.frombuffer(x, np.float32) for x in right["vals"].to_pylist()])
        order = np.argsort(keys)
        keys, logs = keys[order], logs[order]
        back = [logs[np.searchsorted(keys, scatter.risen(k, width))].tobytes() for k in left["keys"].to_pylist()]
        return pa.table({"bid": left["bid"], "p": left["p"], "vals": pa.array(back, pa.binary())})

    rows = rows.select("bid", "p", "keys", "vals")
    sums = cut(rows.groupBy("p").applyInArrow(_summed(parts, width, kind), SUMS))
    level = cut(sums.groupBy("q").applyInArrow(seconds, LEVEL).groupBy("lot").applyInArrow(whole, LEVEL))
    # 65,536 nodes at most
    found = level.where("q < 0").mapInArrow(flat, TOP).groupBy("key").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below"))).toPandas()
    top = rows.sparkSession.sparkContext.broadcast(Top(found["key"].to_numpy(np.int64), *(found[c].to_numpy(float) for c in ("zeros", "ones", "below"))))
    logs = sums.groupBy("q").cogroup(level.where("q >= 0").groupBy("q")).applyInArrow(predict, "p int, keys binary, vals binary")
    return rows.groupBy("p").cogroup(logs.groupBy("p")).applyInArrow(answer, scatter.ANSWER)


def _levels(fan: scatter.Fan, sent: DataFrame, batches: int, width: int, read, kind, write) -> tuple[DataFrame, str, Callable[[DataFrame], DataFrame]]:
    """The rows that are to be answered, of batches or of merges of them; the type of their counts; and how answers become those to batches."""
    if fan.fine == 1:
        return sent, "int32", lambda answers: answers
    numbered, on = scatter.merged(fan, sent, "int32", width, True, batches)
    return cut(on), "int64", lambda answers: scatter.sent_back(fan, numbered, answers, read, kind, write, width, True)


def score_documents(docs: DataFrame, modulus: int = 7, remainder: int = 2, depth: int = DEPTH, batch_bytes: int = 8 << 20, fan: int | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): unigram and context-tree scores learned from rows that are not held out. depth: 2 to 7. fan: the most groups that a batch sends words or grams to (see `scatter`)."""
    # a batch has about a word in 80 bytes, and a gram in 16, that it has not had before
    (for_words, for_grams), width = (scatter.Fan.of(parts_for(docs), batch_bytes // each, fan) for each in (80, 16)), depth + 1
    parts = for_words.lanes

    def first(batches):
        bids = scatter.named()
        for chunk in chunks(batches, most=batch_bytes):
            bid = next(bids)
            train = ~_held(chunk["doc_id"], modulus, remainder)
            w = words(chunk["text"], fold=True)
            keys, _, count = _distinct(w, train)
            out = [(bid, scatter.TEXTS, int(w.count[train].sum() + train.sum()), None, None, scatter.pack(chunk)), *scatter.send(bid, keys, count, keys, parts, press=True)]
            del w, keys, count
            known, n = counted(chunk["text"].filter(pa.array(train)), depth)
            codes = np.union1d(known, counted(chunk["text"].filter(pa.array(~train)), depth)[0])
            counts = np.zeros(len(codes), np.int32)
            counts[np.searchsorted(codes, known)] = n
            out += [(b, GRAMS - p, *rest) for b, p, *rest in scatter.send(bid, codes, counts, mix(codes), parts, width, press=True)]
            yield scatter.rows(*out)

    sent = cut(docs.select("doc_id", "text").mapInArrow(first, scatter.ROWS))
    n, batches = sent.where(f"p = {scatter.TEXTS}").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    asked, kind, back = _levels(for_words, sent.where("p >= 0"), batches, 8, _read_sums, np.int64, _write_sums)
    known = cut(asked.select("bid", "p", "keys", "vals").groupBy("p").applyInArrow(_word_sums(kind), scatter.ANSWER))
    v = known.where("bid IS NULL").agg(F.coalesce(F.sum("p"), F.lit(0))).first()[0]
    answers = back(known.where("bid IS NOT NULL"))
    asked, kind, back = _levels(for_grams, sent.where(F.col("p") <= GRAMS).withColumn("p", F.lit(GRAMS) - F.col("p")), batches, width, _read_logs, np.float32, np.ndarray.tobytes)
    logs = back(gram_answers(asked, for_grams.lanes * for_grams.fine, depth, kind))
    answers = answers.unionByName(logs.withColumn("p", F.lit(GRAMS) - F.col("p")))

    def last(bid: str, table: pa.Table, answer: pa.Table) -> pa.Table:
        held = _held(table["doc_id"], modulus, remainder)
        group = answer["p"].to_numpy()
        w = words(table["text"], fold=True)
        keys, inverse, _ = _distinct(w, ~held)
        count = scatter.gathered(answer.filter(pa.array(group >= 0)), *scatter.deal(keys, parts), _read_sums, np.int64)
        at = np.insert(inverse[:-1], w.first[1:], inverse[-1])  # an end after each text
        ends = w.first + np.arange(len(w.first))
        logs = np.log10((count + 1) / (n + v + 1))
        tokens, n_known, base = w.count + 1, np.add.reduceat((count > 0)[at].astype(np.int64), ends[:-1]), np.add.reduceat(logs[at], ends[:-1])
        del w, keys, inverse, count
        placed = []
        for t in pieces(table["text"].combine_chunks()):
            code, begin = grams(t, depth)
            some, where = np.unique(code, return_inverse=True)
            placed.append((some, where.astype(np.int32), begin[:-1]))
        codes = np.unique(np.concatenate([some for some, *_ in placed]))
        mine = answer.filter(pa.array(group <= GRAMS))
        mine = mine.set_column(mine.schema.get_field_index("p"), "p", pa.array(GRAMS - mine["p"].to_numpy(), pa.int32()))
        tree = scatter.gathered(mine, *scatter.deal(mix(codes), parts), _read_logs, np.float64)
        score = [np.add.reduceat(tree[np.searchsorted(codes, some)][where], begin, dtype=np.float64) for some, where, begin in placed]
        return pa.table({
            "doc_id": table["doc_id"].cast(pa.int64()), "held_out": pa.array(held), "n_tokens": pa.array(tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array(np.full(len(table), n), pa.int64()),
            "base_score": pa.array(base), "score": pa.array(np.concatenate(score)),
        })

    return scatter.meet(sent.where(f"p = {scatter.TEXTS}"), answers, last, RESULT)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
