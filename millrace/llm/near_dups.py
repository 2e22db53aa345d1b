"""MinHash near-duplicates with sequential Bayesian verification.

1. Texts become sets of word shingles; texts with equal sets are one node, with a
   128-bit digest of the set as its name. Copies are never paired.
2. A node's signature has MINIMA minima, cut into bands. Nodes that agree on a whole
   band are candidates. At similarity 0.85 a pair fails all of 28 bands of 7 with
   probability 2e-5 (at 0.9: 1e-8); for other thresholds bands are as long as keeps
   this below MISSED.
3. Each bucket links its nodes to its smallest one: no pairs within a bucket.
   Connected components of these links hold every true link between candidates,
   and every node is in one component, so its set is moved once.
4. In a component, two nodes that are not yet known to be connected are compared:
   batches of signature rows are counted, and a pair goes once the posterior
   probability (uniform prior) that its similarity reaches the threshold is below
   MISS. Survivors are verified on their full sets.
5. A component of more than BLOCK nodes is dealt into blocks which hold, besides,
   the same few leaders. Blocks agree by way of the leaders. What does not end up
   with its component's largest class (the rest) is then compared by buckets: a node
   of the rest with the nodes of other classes that share one of its buckets, in
   blocks. A link that the bands find shares a bucket, and one of its ends is in the
   rest if its ends are in two classes, so none is lost; the work is that of band
   collisions, however far components that hold few links grow.

Rows meet their node and their class by `store.attach`: what a large group of copies
shares is broadcast, so no task gets all of its rows.

Defined results: null text, and text without words, has an empty set: linked with
nothing, its own component, kept. With fewer words than a shingle the whole
sequence is one shingle. Ties on the smallest doc_id: all rows with it are kept
here (`keep_one` keeps one row). Nodes without any doc_id have a null component_id
and kept = false, but for an empty set, which is kept. Other columns are not read,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .store import attach, cut
from .words import SPACED, U64, chunks, mix, windows, words

MINIMA = 196
MISSED = 1e-4
MISS = 1e-6
STEP = 28  # signature rows compared at once
BLOCK = 2000
LEADERS = 8
NODE = "doc_id long, key binary, n_shingles long, node string, bands array<long>"
SET = "node string, signature binary, shingles binary"
FILTER_DIGITS = 6  # hex digits of a node's name that a filter of fixed size, 2^24 bits, looks at
LINK = "node string, cls string"
_MULTIPLY = np.random.default_rng(7).integers(1, 1 << 32, MINIMA, dtype=np.uint32) | np.uint32(1)
_ADD = np.random.default_rng(8).integers(0, 1 << 32, MINIMA, dtype=np.uint32)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = words(texts, SPACED, fold=True)
    hashed = windows(w.hash, size)
    out = []
    for a, b in zip(w.first.tolist(), w.first[1:].tolist(), strict=False):
        if b - a >= size:
            out.append(np.unique(hashed[a : b - size + 1]))
        else:  # the whole sequence, if any
            out.append(windows(w.hash[a:b], b - a)[:1] if b > a else np.zeros(0, U64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, MINIMA) minima of 32-bit permutations; no set may be empty."""
    if not sets:
        return np.zeros((0, MINIMA), np.uint32)
    flat = (np.concatenate(sets) >> U64(32)).astype(np.uint32)
    at = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((MINIMA, len(sets)), np.uint32)
    for j, (m, c) in enumerate(zip(_MULTIPLY, _ADD, strict=True)):
        x = flat * m
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= c
        out[j] = np.minimum.reduceat(x, at)
    return np.ascontiguousarray(out.T)


def _name(shingles: np.ndarray) -> str:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()


def _nodes(size: int, rows: int):
    """Rows of NODE for texts."""

    def make(batches):
        for chunk in chunks(batches):
            sets = shingle_sets(chunk["text"], size)
            some = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(signatures([sets[i] for i in some]), rows)
            names, bands = [None] * len(sets), [None] * len(sets)
            for k, i in enumerate(some):
                names[i], bands[i] = _name(sets[i]), keys[k]
            yield pa.RecordBatch.from_arrays([chunk["doc_id"].cast(pa.int64()), chunk["key"], pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.string()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "key", "n_shingles", "node", "bands"])

    return make


def _sets(size: int, wanted):
    """Rows of SET for texts whose node passes the filter, once in a chunk."""

    def make(batches):
        for chunk in chunks(batches):
            found = {}
            for s in shingle_sets(chunk["text"], size):
                if len(s) and wanted.value[int((name := _name(s))[:FILTER_DIGITS], 16)]:
                    found[name] = s
            sign = signatures(list(found.values())).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([x.tobytes() for x in sign], pa.binary()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["node", "signature", "shingles"])

    return make


def _filter(nodes: DataFrame):
    """A broadcast mask of 2^24 bits over the first digits of names. Its size is fixed; it only spares moving sets that have no candidate."""
    place = F.conv(F.substring("node", 1, FILTER_DIGITS), 16, 10).cast("long")
    words_ = nodes.select((place / 64).cast("long").alias("w"), F.expr(f"shiftleft(1L, cast(conv(substring(node, 1, {FILTER_DIGITS}), 16, 10) % 64 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    mask = np.zeros(16**FILTER_DIGITS // 64, np.int64)
    mask[words_["w"].to_numpy(np.int64)] = words_["b"].to_numpy(np.int64)
    return nodes.sparkSession.sparkContext.broadcast(np.unpackbits(mask.view(np.uint8), bitorder="little").astype(bool))


def band_rows(percent: int) -> int:
    """The most rows of a band with which a pair at the threshold is missed with probability MISSED at most."""
    t = percent / 100
    return max([r for r in range(1, 15) if (1 - t**r) ** (MINIMA // r) <= MISSED], default=1)


def band_keys(sign: np.ndarray, rows: int) -> list[np.ndarray]:
    """A 64-bit key of each band, which holds the band's number."""
    out = np.zeros((len(sign), MINIMA // rows), U64)
    for b in range(MINIMA // rows):
        key = np.full(len(sign), b + 1, U64)
        for r in range(rows):
            key = mix(key * U64(0x9E3779B97F4A7C15) + sign[:, b * rows + r])
        out[:, b] = key
    return list(out.view(np.int64))


@lru_cache
def bounds(threshold: float, total: int = MINIMA, step: int = STEP) -> tuple[tuple[int, int], ...]:
    """(rows compared, least matches): below these, P(similarity >= threshold | matches) < MISS under a uniform prior.

    Signatures hold eight bits of each minimum, so that unequal ones match by
    chance in one of 256; this only lets more pairs through.
    """
    grid = np.linspace(0.0005, 0.9995, 2000)
    out = []
    for n in range(step, total + 1, step):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log(1 - grid)
            weight = np.exp(log - log.max())
            if weight[grid >= threshold].sum() / weight.sum() >= MISS:
                out.append((n, m))
                break
    return tuple(out)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a and b| >= percent * |a or b|, on full sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Classes:
    """Union-find over a task's nodes; a class is named by its smallest node."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def compare(names: list[str], sign: np.ndarray, sets: list[np.ndarray], percent: int, rows: list[int] | None = None, known: list[str] | None = None) -> list[str]:
    """The class of each node after comparing nodes (or only `rows`) with all others. Nodes are sorted by name. known: classes that are known already; within one nothing is compared."""
    found = Classes(len(names))
    size = np.array([len(s) for s in sets])
    limits = bounds(percent / 100)
    group = np.arange(len(names)) if known is None else np.unique(known, return_inverse=True)[1]
    for i in range(len(names)) if rows is None else rows:
        other = np.flatnonzero((group != group[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])))
        if rows is None:
            other = other[other > i]
        match, before = np.zeros(len(other), np.int64), 0
        for n, least in limits:
            match += (sign[other, before:n] == sign[i, before:n]).sum(1)
            go = match >= least
            other, match, before = other[go], match[go], n
        for j in other[np.argsort(-match, kind="stable")].tolist():
            if group[j] != group[i] and linked(sets[i], sets[j], percent):
                found.join(i, j)
                a, b = sorted((group[i], group[j]))
                group[group == b] = a
    return [names[found.root(i)] for i in range(len(names))]


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the connected component of each node of links (a, b).

    Every round, a node takes the smallest root among its own and its
    neighbours', and roots point on to their own roots, so that long chains
    halve. Ends when no root changes. The joins of a round are plain ones, which Spark
    splits where one root or the middle of one star is skewed.
    """
    both = cut(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    at = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(at.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low"))
        # the smallest root seen by a root's members is the root's own new root
        step = at.join(near, "node").select("node", "root", F.least("root", "low").alias("low"))
        hooks = step.where("low < root").groupBy(F.col("root").alias("node")).agg(F.min("low").alias("hook"))
        new = step.select("node", F.col("low").alias("root"), (F.col("low") < F.col("root")).alias("moved"))
        new = new.join(hooks, "node", "left").select("node", F.least("root", F.coalesce("hook", "root")).alias("root"), "moved")
        up = new.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        new = cut(new.join(up, "root", "left").select("node", F.least("root", F.coalesce("upper", "root")).alias("root"), (F.col("moved") | (F.col("upper") < F.col("root"))).alias("moved")))
        at = new.select("node", "root")
        if new.where("moved").isEmpty():
            return at


def _decode(table: pa.Table) -> tuple[list[str], np.ndarray, list[np.ndarray], pa.Table]:
    table = table.sort_by("node")
    sign = np.stack([np.frombuffer(x, np.uint8) for x in table["signature"].to_pylist()])
    return table["node"].to_pylist(), sign, [np.frombuffer(x, U64) for x in table["shingles"].to_pylist()], table


def _classes(percent: int):
    def work(table: pa.Table) -> pa.Table:
        names, sign, sets, _ = _decode(table)
        return pa.table({"node": names, "cls": compare(names, sign, sets, percent)})

    return work


def _links_of_rest(percent: int):
    """Within a block of a bucket and a block of its rest: links of the rest with nodes of other classes."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"node": pa.array([], pa.string()), "cls": pa.array([], pa.string())})
        rest = set(right["node"].to_pylist())
        columns = ["node", "signature", "shingles", "cls"]
        left = left.select(columns)
        left = left.filter(pa.array([x not in rest for x in left["node"].to_pylist()], pa.bool_()))
        names, sign, sets, table = _decode(pa.concat_tables([left, right.select(columns)]))
        found = compare(names, sign, sets, percent, [i for i, x in enumerate(names) if x in rest], table["cls"].to_pylist())
        some = [(n, c) for n, c in zip(names, found, strict=True) if n != c]
        return pa.table({"node": pa.array([n for n, _ in some], pa.string()), "cls": pa.array([c for _, c in some], pa.string())})

    return work


def classified(docs: DataFrame, percent: int, size: int, block: int = BLOCK) -> DataFrame:
    """Per row of docs (doc_id, text, key: any bytes, carried along): doc_id, key, n_shingles and its class; null for an empty set."""
    texts = docs.select("doc_id", "text", "key")
    rows = cut(texts.mapInArrow(_nodes(size, band_rows(percent)), NODE))
    total = rows.count()
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"), F.count("*").alias("copies"))
    banded = nodes.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").select("band", "a")
    links = banded.join(buckets, "band").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    at = components(links)
    sizes = at.groupBy("root").agg(F.count("*").alias("n"))
    at = cut(at.join(sizes, "root"))
    # sets of candidates alone, one row for each node
    sets = texts.select("text").mapInArrow(_sets(size, _filter(at)), SET).join(at, "node")
    one = sets.groupBy("node", "root", "n").agg(F.first("signature").alias("signature"), F.first("shingles").alias("shingles"))
    small = F.col("n") <= block
    if at.where(~small).isEmpty():
        classes = one.groupBy("root").applyInArrow(_classes(percent), LINK)
    else:
        one = cut(one)
        classes = one.where(small).groupBy("root").applyInArrow(_classes(percent), LINK).union(_large(one.where(~small), nodes, percent, block))
    counted = nodes.select("node", "copies").join(classes, "node")
    slim = rows.select("doc_id", "key", "n_shingles", "node")
    named = attach(slim, cut(counted), "node", "copies", total, _own_key())
    return cut(named.select("doc_id", "key", "n_shingles", F.coalesce("cls", "node").alias("cls")))


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = 3, block: int = BLOCK) -> DataFrame:
    """Per row of docs (doc_id, text): set size, component and whether it is the component's smallest doc_id."""
    named = classified(docs.select("doc_id", "text", F.lit(None).cast("binary").alias("key")), percent, size, block).drop("key")
    least = named.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    out = attach(named, cut(least), "cls", "n", named.count(), _own_key())
    out = out.select("doc_id", "n_shingles", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), F.col("cls").isNull().alias("empty"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("empty")).alias("kept"))


def _own_key():
    """A key for a row that is to meet nothing; names of nodes are hex digits."""
    return F.concat(F.lit("~"), F.monotonically_increasing_id().cast("string"))


def _large(one: DataFrame, nodes: DataFrame, percent: int, block: int) -> DataFrame:
    """Classes of components of more than `block` nodes, in blocks."""
    salts = F.ceil(F.col("n") / F.lit(block)).cast("long")
    dealt = one.withColumn("salts", salts).withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "node"), "salts"))
    # leaders: the smallest nodes by hash; found by a maximum of few rows of each salt
    few = Window.partitionBy("root", "salt").orderBy(F.xxhash64("node"), "node")
    top = Window.partitionBy("root").orderBy(F.xxhash64("node"), "node")
    leaders = dealt.where(F.pmod(F.xxhash64("node"), "salts") == 0).withColumn("k", F.row_number().over(few)).where(F.col("k") <= LEADERS)
    leaders = cut(leaders.withColumn("k", F.row_number().over(top)).where(F.col("k") <= LEADERS).drop("k", "salt"))
    everywhere = leaders.select("*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    inside = dealt.unionByName(everywhere).dropDuplicates(["root", "salt", "node"])
    first = cut(inside.groupBy("root", "salt").applyInArrow(_classes(percent), LINK))
    joined = cut(_merge(first))
    weight = dealt.select("node", "root").join(joined, "node")
    largest = weight.groupBy("root", "cls").count().groupBy("root").agg(F.max_by("cls", F.struct("count", "cls")).alias("largest"))
    rest = cut(weight.join(largest, "root").where("cls <> largest").select("node", "cls"))
    if rest.isEmpty():
        return joined
    # the rest with whatever shares a bucket, in blocks; a node is one row, with its bands as a list, wherever it is joined
    known = nodes.select("node", "bands").join(joined, "node").join(rest.select("node", F.lit(True).alias("rest")), "node", "left")
    in_bands = known.select("node", "cls", F.coalesce("rest", F.lit(False)).alias("rest"), F.explode("bands").alias("band"))
    mixed = in_bands.groupBy("band").agg(F.ceil(F.count_if("rest") / F.lit(block)).cast("long").alias("parts"), F.ceil(F.count("*") / F.lit(block)).cast("long").alias("salts"), F.min("cls").alias("low"), F.max("cls").alias("high"))
    mixed = mixed.where("parts > 0 AND low < high").select("band", "parts", "salts")
    places = in_bands.join(mixed, "band").groupBy("node", "cls", "rest").agg(F.collect_list(F.struct("band", "parts", "salts")).alias("places"))  # no more than there are bands
    put = cut(places.join(one.select("node", "signature", "shingles"), "node")).withColumn("x", F.explode("places")).select("node", "cls", "rest", "signature", "shingles", "x.*")
    columns = ["band", "salt", "part", "node", "cls", "signature", "shingles"]
    left = put.withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "node"), "salts")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(columns)
    right = put.where("rest").withColumn("part", F.pmod(F.xxhash64(F.lit("rest"), "node"), "parts")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    # both sides come from one frame: fresh names for one of them
    right = right.select(*(F.col(c).alias(c) for c in columns))
    more = left.groupBy("band", "salt", "part").cogroup(right.groupBy("band", "salt", "part")).applyInArrow(_links_of_rest(percent), LINK)
    return _merge(cut(joined.union(more)))


def _merge(links: DataFrame) -> DataFrame:
    """One class for each node, of links (node, cls) from several blocks."""
    at = components(links.where("node <> cls").select(F.col("cls").alias("a"), F.col("node").alias("b")))
    alone = links.select("node").distinct()
    return alone.join(at, "node", "left").select("node", F.coalesce("root", "node").alias("cls"))


def keep_one(docs: DataFrame, percent: int = 85, size: int = 3) -> DataFrame:
    """The rows of docs without near-duplicates: of each component one row stays, with all of its columns, whatever these are called.

    The row with the component's smallest doc_id stays; of several, the one with the
    smallest digest of its text; of rows that are equal in both, any one. A row
    without doc_id stays only if no row of its component has one. Texts without words
    stay, all of them. Rows with one doc_id whose texts aren't linked stay, each of them.
    """
    digest = F.unhex(F.substring(F.sha2(F.col("text"), 256), 1, 32))
    empty = ~F.coalesce(F.col("text").rlike(r"[^ \t-\r]"), F.lit(False))
    rows = classified(docs.select("doc_id", "text", digest.alias("key")), percent, size).where("cls IS NOT NULL")
    first = rows.groupBy("cls").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "key")).alias("x")).select("x.doc_id", "x.key")
    # one key of bytes for (doc_id, text): texts are shuffled once, by it
    name = lambda key: F.unhex(F.substring(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).cast("binary"), F.lit(":").cast("binary"), key), 256), 1, 32))
    stay = first.select(name(F.col("key")).alias("_mr_name"))
    some = docs.where(~empty).withColumn("_mr_name", name(digest)).join(stay, "_mr_name", "left_semi").dropDuplicates(["_mr_name"])
    return some.select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(docs.where(empty))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all documents: 3-word shingles, similarity 0.85."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), 85, 3)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), i AS (
  SELECT r, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0
), s AS (
  SELECT DISTINCT r, array_to_string(ws[i:i + 2], ' ') AS k FROM i
), n AS (
  SELECT r, count(*)::BIGINT AS n FROM s GROUP BY r
), e AS (
  SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.r < b.r GROUP BY a.r, b.r
), l AS (
  SELECT a, b FROM e JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), g AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), reach AS (
  SELECT r AS a, r AS b FROM w UNION SELECT reach.a, g.b FROM reach JOIN g ON reach.b = g.a
), comp AS (
  SELECT reach.a AS r, min(w.doc_id) AS component_id FROM reach JOIN w ON w.r = reach.b GROUP BY reach.a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN comp ON w.r = comp.r LEFT JOIN n ON w.r = n.r
"""
