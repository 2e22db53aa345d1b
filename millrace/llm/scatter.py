"""Sums over all documents for keys found in batches of text, and the way back.

Batches of texts hold far fewer distinct keys than words, and a sorted array of
keys needs no row for each. So every batch sends one array to each of P groups of
keys; a group adds up what all batches sent and answers each batch with an array
in the same order. A key that is in a third of all words comes at most once from
a batch. P follows the size of the input, so that a group stays small.

With more than FAN groups, batches times groups would grow with the square of the
input. Then a batch sends to FAN lanes only, and each lane has two levels: the arrays of
many batches are merged first, and what they merge to is dealt on into the lane's
groups, in arrays that hold about EACH keys or more (`Fan`). Rows then grow as batches do.

Rows are (bid, p, n, keys, vals, texts): bid names a batch. p >= 0: keys of group
p with their values. p = TEXTS: the batch's own columns, packed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .words import mix

U64 = np.uint64
ROWS = "bid string, p int, n long, keys binary, vals binary, texts binary"
ANSWER = "bid string, p int, vals binary"
TEXTS, DONE = -1, -2
FAN, EACH = 1024, 1000


@dataclass(frozen=True)
class Fan:
    """How keys are dealt: into lanes, of which each has `fine` groups; `fold` batches are merged between the two."""

    lanes: int
    fine: int
    fold: int

    @staticmethod
    def of(parts: int, keys: int, fan: int | None = None) -> Fan:
        """For so many groups in all, and about so many distinct keys in a batch."""
        lanes = min(parts, fan or FAN)
        fine = -(-parts // lanes)
        return Fan(lanes, fine, max(1, -(-lanes * fine * EACH // max(1, keys))))


def pack(table: pa.Table | pa.RecordBatch) -> bytes:
    """A table as compressed Arrow bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write(table)
    return zstandard.ZstdCompressor(level=6).compress(sink.getvalue())


def unpack(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()


def rows(*given: tuple) -> pa.RecordBatch:
    """A record batch of ROWS from tuples."""
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*given, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bid", "p", "n", "keys", "vals", "texts"])


def named() -> Iterator[str]:
    """Names for the batches of this task. They are used only after the rows have been written once."""
    task, k = TaskContext.get(), 0
    while True:
        yield f"{task.partitionId() if task else 0}-{k}"
        k += 1


def deal(lane: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts keys into groups by their lane, and where the groups begin."""
    p = (lane >> U64(24)) % U64(parts)
    order = np.argsort(p, kind="stable")
    return order, np.searchsorted(p[order], np.arange(parts + 1, dtype=U64))


def narrow(keys: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of each key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def widen(blob: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(blob) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8")


def pressed(blob: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(blob)


def plain(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def steps(keys: np.ndarray, width: int) -> bytes:
    """Sorted keys of `width` bytes, compressed: the steps between them, all lowest bytes first."""
    return pressed(np.frombuffer(narrow(np.diff(keys, prepend=U64(0)), width), np.uint8).reshape(-1, width).T.tobytes())


def risen(blob: bytes, width: int) -> np.ndarray:
    """The keys whose steps were compressed."""
    planes = np.frombuffer(plain(blob), np.uint8).reshape(width, -1)
    return np.cumsum(widen(planes.T.tobytes(), width), dtype=U64)


def send(bid: str, keys: np.ndarray, values: np.ndarray, lane: np.ndarray, parts: int, width: int = 8, press: bool = False) -> list[tuple]:
    """Rows with a batch's distinct keys, dealt by lane. Boolean values take a bit each, others are compressed; keys, which have to be sorted then, too, if press is set."""
    order, at = deal(lane, parts)
    keys, values = keys[order], values[order]
    coded = (lambda v: np.packbits(v).tobytes()) if values.dtype == bool else (lambda v: pressed(v.tobytes()))
    named_ = (lambda k: steps(k, width)) if press else (lambda k: narrow(k, width))
    return [(bid, p, int(b - a), named_(keys[a:b]), coded(values[a:b]), None) for p, (a, b) in enumerate(zip(at, at[1:], strict=False)) if b > a]


def totals(sent: DataFrame, value: str, answer: Callable[[np.ndarray], np.ndarray], width: int = 8) -> DataFrame:
    """For each batch and group: answer(sums over all batches), in the order of the keys that the batch sent.

    value: the type of the values sent; "bit" for a bit that says whether a key counts once or twice.
    """

    def add(table: pa.Table) -> pa.Table:
        sizes, vals = table["n"].to_pylist(), table["vals"].to_pylist()
        given = [_values(v, n, value) for v, n in zip(vals, sizes, strict=True)]
        keys = np.concatenate([widen(k, width) for k in table["keys"].to_pylist()])
        _, inverse = np.unique(keys, return_inverse=True)
        sums = np.bincount(inverse, weights=np.concatenate(given).astype(np.float64)).astype(np.int64)
        cuts = np.cumsum([len(g) for g in given])[:-1]
        back = [answer(x).tobytes() for x in np.split(sums[inverse], cuts)]
        return pa.table({"bid": table["bid"], "p": table["p"], "vals": pa.array(back, pa.binary())})

    return sent.where("p >= 0").select("bid", "p", "n", "keys", "vals").groupBy("p").applyInArrow(add, ANSWER)


def totals_by(fan: Fan, sent: DataFrame, value: str, answer: Callable[[np.ndarray], np.ndarray], width: int = 8) -> DataFrame:
    """As `totals`, for keys that were dealt into the lanes of a fan: in two levels if these have groups of their own."""
    if fan.fine == 1:
        return totals(sent, value, answer, width)
    numbered, on = merged(fan, sent, value, width)
    sums = totals(on, "int64", lambda x: np.frombuffer(pressed(x.tobytes()), np.uint8), width)
    return sent_back(fan, numbered, sums, lambda blob, n: np.frombuffer(plain(blob), np.int64), np.int64, lambda x: answer(x).tobytes(), width)


def merged(fan: Fan, sent: DataFrame, value: str, width: int, press: bool = False, batches: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of batches with the number of their merge (_g), and what the merges send on: rows like those of batches, with groups of fan.fine times as many numbers.

    batches: how many there are, if `sent` holds no row of TEXTS for each.
    """
    if batches is None:
        batches = sent.where(F.col("p") == TEXTS).count()
    groups = F.pmod(F.xxhash64("bid"), F.lit(max(1, -(-batches // fan.fold))))
    numbered = sent.where("p >= 0").select("bid", "p", "n", "keys", "vals", groups.alias("_g"))
    coded = (lambda k: steps(k, width)) if press else (lambda k: narrow(k, width))

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("bid")
        keys, inverse, _ = _union(table, width, press)
        counts = [_values(v, n, value) for v, n in zip(table["vals"].to_pylist(), table["n"].to_pylist(), strict=True)]
        sums = np.bincount(inverse, np.concatenate(counts).astype(np.float64)).astype(np.int64)
        order, at = _subgroups(keys, fan.fine)
        p, g = table["p"][0].as_py(), table["_g"][0].as_py()
        keys, sums = keys[order], sums[order]
        return pa.Table.from_batches([rows(*((f"{p}:{g}", p * fan.fine + b, int(y - x), coded(keys[x:y]), pressed(sums[x:y].tobytes()), None) for b, (x, y) in enumerate(zip(at, at[1:], strict=False)) if y > x))])

    return numbered, numbered.groupBy("p", "_g").applyInArrow(merge, ROWS)


def sent_back(fan: Fan, numbered: DataFrame, answers: DataFrame, read: Callable[[bytes, int], np.ndarray], kind, write: Callable[[np.ndarray], bytes], width: int, press: bool = False) -> DataFrame:
    """The answers to merges as answers to their batches. read, kind: how a merge's answer is read; write: how a batch's is written."""
    found = answers.withColumn("_p", F.split_part("bid", F.lit(":"), F.lit(1)).cast("int")).withColumn("_g", F.split_part("bid", F.lit(":"), F.lit(2)).cast("long"))

    def back(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("bid")
        keys, inverse, cuts = _union(left, width, press)
        order, at = _subgroups(keys, fan.fine)
        first = left["p"][0].as_py() * fan.fine
        told = gathered(right.set_column(right.schema.get_field_index("p"), "p", pa.array(right["p"].to_numpy() - first, pa.int32())), order, at, read, kind)
        return pa.table({"bid": left["bid"], "p": left["p"], "vals": pa.array([write(x) for x in np.split(told[inverse], cuts)], pa.binary())})

    return numbered.groupBy("p", "_g").cogroup(found.groupBy("_p", "_g")).applyInArrow(back, ANSWER)


def _union(table: pa.Table, width: int, press: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of several batches, where each sent key is among them, and where the batches begin."""
    sent = [risen(k, width) if press else widen(k, width) for k in table["keys"].to_pylist()]
    keys, inverse = np.unique(np.concatenate(sent), return_inverse=True)
    return keys, inverse, np.cumsum([len(k) for k in sent])[:-1]


def _subgroups(keys: np.ndarray, fine: int) -> tuple[np.ndarray, np.ndarray]:
    return deal(mix(keys + U64(1)), fine)


def _values(blob: bytes, n: int, value: str) -> np.ndarray:
    """Counts that were sent; a bit says whether a key counts once or twice."""
    return bits(blob, n) + np.int64(1) if value == "bit" else np.frombuffer(plain(blob), value)


def many(sums: np.ndarray) -> np.ndarray:
    """An answer of one bit for each key: whether it was seen twice or more."""
    return np.packbits(sums >= 2)


def gathered(answer: pa.Table, order: np.ndarray, at: np.ndarray, read: Callable[[bytes, int], np.ndarray], kind) -> np.ndarray:
    """The answers to one batch, in the order in which it has its keys."""
    out = np.zeros(len(order), kind)
    for p, blob in zip(answer["p"].to_pylist(), answer["vals"].to_pylist(), strict=True):
        a, b = at[p], at[p + 1]
        out[order[a:b]] = read(blob, b - a)
    return out


def bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def meet(texts: DataFrame, answers: DataFrame, work: Callable[[str, pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """work(bid, its columns, the answers to it) for every batch."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(left["bid"][0].as_py(), unpack(left["texts"][0].as_py()), right)

    return texts.select("bid", "texts").groupBy("bid").cogroup(answers.groupBy("bid")).applyInArrow(both, schema)


def done(sent: DataFrame, schema: str) -> DataFrame:
    """The rows of packed results."""

    def unpacked(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                yield from unpack(blob).to_batches()

    return sent.where(F.col("p") == DONE).select("texts").mapInArrow(unpacked, schema)
