"""Sharding by balanced label propagation, by DataFrame functions alone.

Documents are linked through hubs: a hub is anything that several documents
share (equal texts, and whatever a frame of links (doc_id, hub) names), so a group of
copies is a star and never all pairs. A document's label is a shard; it starts with
one by its hash, and first follows its main hub, the largest that fits into a shard.
In the first round every hub asks for the shard that most of its members are in, since
that moves the fewest documents. A shard's quota is its final size, and it is hard: the hubs that
ask for a shard are put in order (large ones first, then by hash), and are taken in
while the prefix sum of their members stays within what the shard has left. In each
later round refused hubs are laid out, large ones first, over the room that is left
in the shards with most of it, and again only those are taken in that fit whole.
Rounds end when fewer than `shards` hubs wait, which the driver places by best fit,
or when no waiting hub fits anywhere.

A hub of more members than a shard's size fills whole shards and asks with the rest;
a hub that fits nowhere is cut at as few places as the room allows. Unlinked
documents cut nothing and fill what is left, so that counts are even to one row.

Then documents move one by one (`_rounds`), as some have several hubs, and some hubs
are cut: each adds up the labels of its neighbours over its hubs and asks for the
shard with most of them. Of those that ask, as many move as trade places with others
or find room, those that gain most first; where a shard is full, those in it that lose
least make place, as long as both together gain. A round that doesn't lower the number of cut edges (pairs
of neighbours in different shards, counted by hubs and shards and never listed) is undone;
the next one lets half of the documents ask, then a quarter. `cut_links` counts what is left.
Documents are numbered by prefix sums over buckets, not by one sort of a shard.

Law: `rows`. The counts of shards differ by one at most.

Defined results: null text is the empty text (size 1); rows without doc_id and
repeated rows are rows like others; links hold for all rows with their doc_id, links without doc_id or hub, or given twice, add nothing; of rows that tie in everything any may get any
of their slots; with fewer rows than shards some shards are empty; other columns are
not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .store import attach, cut, discard

BUCKET_ROWS = 500  # rows that are numbered together
ROUNDS = 16  # of documents that move, at most
STUCK = 3  # rounds in succession that bring nothing end them
VOTE = 1 << 20  # a neighbour's vote; ties go by a hash below half of one


def _ranked(df: DataFrame, by: str, order: list[Column], bucket: Column, buckets: int, name: str, weight: Column | None = None) -> DataFrame:
    """df with the weight (by default 1: gapless numbers) of the rows before each, within each value of `by`, ordered by bucket, then by order.

    Buckets are summed up, a prefix sum over the sums gives what is before each
    bucket, and rows are summed up within their bucket.
    """
    keys = df.withColumns({"_bucket": bucket, "_weight": F.lit(1) if weight is None else weight})
    sums = keys.groupBy(by, "_bucket").agg(F.sum("_weight").alias("_n"))
    # prefix sums over buckets, in two levels, so that no task sorts all sums of a shard
    wide = max(1, math.isqrt(buckets))
    sums = sums.withColumn("_group", F.floor(F.col("_bucket") / wide))
    group = Window.partitionBy(by, "_group")
    inner = sums.withColumns({"_in": F.sum("_n").over(group.orderBy("_bucket")) - F.col("_n"), "_g": F.sum("_n").over(group), "_head": F.col("_bucket") == F.min("_bucket").over(group)})
    groups = inner.where("_head").select(by, "_group", "_g")
    groups = groups.withColumn("_before", F.sum("_g").over(Window.partitionBy(by).orderBy("_group")) - F.col("_g")).drop("_g")
    first = inner.join(groups, [by, "_group"]).select(by, "_bucket", (F.col("_in") + F.col("_before")).alias("_first"))
    upto = Window.partitionBy(by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = F.sum("_weight").over(upto) - F.col("_weight")
    return keys.withColumn("_k", within).join(first, [by, "_bucket"]).withColumn(name, (F.col("_first") + F.col("_k")).cast("long")).drop("_bucket", "_k", "_first", "_weight")


def _queue(hubs: DataFrame, by: str, n: int) -> DataFrame:
    """hubs with `before`: the members of those before each in its queue; large hubs come first."""
    classes, each = 64, max(1, math.ceil(n / BUCKET_ROWS))
    step = F.lit(classes - 1) - F.floor(F.log2(F.col("members").cast("double"))).cast("long")
    bucket = step * each + F.pmod(F.xxhash64("hub"), F.lit(each))
    return _ranked(hubs, by, [F.desc("members"), F.xxhash64("hub"), F.col("hub")], bucket, classes * each, "before", F.col("members"))


def _along(at: Column, starts: list[tuple[int, int]], otherwise: Column) -> Column:
    """The value of the last (start, value) whose start is not after `at`; starts ascend."""
    out = otherwise
    for start, value in starts:
        out = F.when(at >= F.lit(start), F.lit(value)).otherwise(out)
    return out


class Rooms:
    """What shards have left, and the pieces (first member, shard) that wide hubs are cut into."""

    def __init__(self, total: int, shards: int):
        self.left = [total // shards + (s < total % shards) for s in range(shards)]
        self.pieces: dict[bytes, list[tuple[int, int]]] = {}
        self.placed: dict[bytes, int] = {}

    def cut(self, hub: bytes, members: int, least: int = 1) -> None:
        """Give members to the shards with most room, while `least` of them are without a place."""
        at = self.placed.get(hub, 0)
        while members - at >= least:
            s = max(range(len(self.left)), key=lambda x: (self.left[x], -x))
            self.pieces.setdefault(hub, []).append((at, s))
            n = min(self.left[s], members - at)
            self.left[s] -= n
            at += n
        self.placed[hub] = at

    def fit(self, members: int) -> int | None:
        """The shard with least room that members fit into."""
        some = [s for s, n in enumerate(self.left) if n >= members]
        return min(some, key=lambda s: (self.left[s], s)) if some else None


def _shared(at: DataFrame, links: DataFrame | None, size: int) -> DataFrame:
    """(_node, hub, members) of the hubs that two rows or more share and that a shard of `size` rows holds: those of at, and links (id, hub)."""
    given = at.where("hub IS NOT NULL").select("_node", "hub")
    if links is not None:
        more = links.select(F.col("id").cast("long").alias("id"), F.col("hub").cast("binary").alias("hub")).where("id IS NOT NULL AND hub IS NOT NULL").distinct()
        given = given.unionByName(at.select("_node", "id").join(more, "id").select("_node", "hub")).distinct()
    given = cut(given)
    sizes = given.groupBy("hub").agg(F.count("*").alias("members")).where(F.col("members").between(2, size))
    out = cut(attach(given, sizes, "hub", "members", given.count(), _own_key("_node")).where("members IS NOT NULL"))
    discard(given)
    return out


def _own_key(name: str) -> Column:
    """A binary key of a row's own, equal to no hub."""
    return F.encode(F.concat(F.lit("row "), F.col(name).cast("string")), "utf-8")


def _flows(asked: dict[tuple[int, int], int], left: list[int]) -> dict[tuple[int, int], int]:
    """How many of those that ask to go from one shard to another (from -1: from none) may: those that trade places, and those that find room. left is what shards have left, and is kept."""
    out = {k: min(n, asked.get(k[::-1], 0)) for k, n in asked.items()}
    open_ = sorted(asked, key=lambda k: (-asked[k], k))
    while True:
        moved = 0
        for a, b in open_:
            n = min(asked[a, b] - out[a, b], left[b])
            out[a, b] += n
            left[b] -= n
            if a >= 0:
                left[a] += n
            moved += n
        if not moved:
            return {k: n for k, n in out.items() if n}


def _votes(label: DataFrame, shards: int, total: int) -> DataFrame:
    """label (_node, _s, hubs) with what its neighbours say, by one shuffle to hubs, one back and one to nodes.

    votes: by shard, null where it has no neighbour; each node counts itself once a hub (self), so that two that could go to each
    other don't. own: what is said for its own shard; to: the shard that has most votes; gain: what going there brings; uncut: neighbours
    that have its label, once for each hub shared.
    """
    each = label.select("_node", "_s", F.explode("hubs").alias("hub"))
    held = each.where("_s >= 0").groupBy("hub").agg(F.array(*(F.count_if(F.col("_s") == s) for s in range(shards))).alias("n"), F.count("*").alias("_w"))
    voted = attach(each, held, "hub", "_w", total, _own_key("_node"))
    said = lambda s: F.when(F.get("n", F.lit(s)) > 0, F.get("n", F.lit(s)) * VOTE + F.pmod(F.xxhash64("hub", F.lit(s)), F.lit(VOTE // 2)))
    sums = voted.groupBy("_node", "_s").agg(F.collect_list("hub").alias("hubs"), F.array(*(F.sum(said(s)) for s in range(shards))).alias("votes"), F.coalesce(F.sum(F.get("n", F.col("_s")) - 1), F.lit(0)).alias("uncut"))
    best = F.array_max(F.filter(F.transform("votes", lambda v, i: F.struct(v.alias("vote"), i.alias("to"))), lambda x: x["vote"].isNotNull()))
    own = F.coalesce(F.get("votes", F.col("_s")), F.lit(0))
    sums = sums.withColumns({"_best": best, "own": own, "self": F.when(F.col("_s") >= 0, F.size("hubs")).otherwise(0).cast("long") * VOTE})
    return sums.select("_node", "_s", "hubs", "votes", "uncut", "own", "self", F.col("_best.to").alias("to"), (F.col("_best.vote") - F.col("own")).alias("gain"))


def _step(gain: Column) -> Column:
    """Gains in whole votes: exact ones up to 32, then powers of two; never more than the gain."""
    whole = F.floor(gain / VOTE)
    power = lambda x: F.pow(F.lit(2.0), F.floor(F.log2(x.cast("double"))))
    return F.when(whole > 32, power(whole)).when(whole < -32, -2 * power(-whole)).otherwise(whole).cast("long")


def _trades(asks: list[tuple[int, int]], others: list[tuple[int, int]], skip: int) -> int:
    """How many of those that ask, after `skip` that go anyway, may trade places with others at a gain for both together. Lists of (gain, how many), large gains first."""
    asks, others = [list(x) for x in asks], [list(x) for x in others]
    for x in asks:
        n = min(skip, x[1])
        x[1] -= n
        skip -= n
    done = i = j = 0
    while i < len(asks) and j < len(others) and asks[i][0] + others[j][0] > 0:
        n = min(asks[i][1], others[j][1])
        done += n
        asks[i][1] -= n
        others[j][1] -= n
        i += not asks[i][1]
        j += not others[j][1]
    return done


Ways = dict[tuple[int, int], list[tuple[int, int]]]


def _asks() -> Column:
    """Whether a row would rather be in another shard."""
    return F.coalesce((F.col("to") != F.col("_s")) & (F.col("gain") > 0), F.lit(False))


def _leaving(to: Column) -> Column:
    """What a row gains by leaving its shard for another than it would ask for."""
    return F.coalesce(F.get("votes", to), F.lit(0)) - F.col("own") + F.col("self")


def _counts(votes: DataFrame, shards: int, may: Column) -> tuple[Ways, Ways, int]:
    """For each way (_s, to) how many of the rows that may ask for it gain how much, large gains first; the same for rows that don't ask, by every way out of their shard; and uncut of all rows. A bounded number of rows for each pair of shards reaches the driver."""
    way = lambda to, gain, uncut: F.struct(to.cast("int").alias("to"), gain.alias("step"), uncut.alias("uncut"))
    none = F.lit(0).cast("long")
    asks = F.array(way(F.col("to"), _step(F.col("gain") + F.col("self")), none))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("_s"))
    ways = F.when(may & _asks(), asks).when(may & (F.col("_s") >= 0), F.transform(others, lambda s: way(s, _step(_leaving(s)), none))).otherwise(F.array().cast("array<struct<to: int, step: bigint, uncut: bigint>>"))
    rows = votes.select("_s", _asks().alias("asks"), F.explode(F.concat(ways, F.array(way(F.lit(None), none, F.col("uncut"))))).alias("w")).select("_s", "asks", "w.*")
    out: tuple[Ways, Ways] = ({}, {})
    uncut = 0
    for x in sorted(rows.groupBy("_s", "asks", "to", "step").agg(F.count("*").alias("n"), F.sum("uncut").alias("uncut")).collect(), key=lambda x: -x["step"]):
        if x["to"] is None:
            uncut += x["uncut"]
        else:
            out[not x["asks"]].setdefault((x["_s"], x["to"]), []).append((x["step"], x["n"]))
    return *out, uncut


def _moves(votes: DataFrame, gains: Ways, stay: Ways, may: Column, room: list[int], shards: int) -> tuple[DataFrame, DataFrame] | None:
    """label (_node, _s, hubs) after the moves, and the written frame that it reads; none if no row may move. gains, stay: as _counts gives them. room is kept.

    Those that ask go by `_flows`. Where more want into a full shard, the rows of that
    shard that lose least by it trade places with them, as long as both together gain.
    Queues are ranges of one order, in which the driver looks for the row where each ends.
    """
    sizes = {k: sum(n for _, n in v) for k, v in gains.items()}
    take = _flows(sizes, room)
    waiting: dict[int, tuple[int, int]] = {}
    for (a, b), n in sizes.items():
        if a >= 0 and (rest := n - take.get((a, b), 0)):
            waiting[b] = max(waiting.get(b, (0, 0)), (rest, a))
    # a full shard gives to the one with most room, or else to the one that most wait in
    wide = max(range(shards), key=lambda s: (room[s], -s))
    target = {b: wide if room[wide] and wide != b else a for b, (_, a) in waiting.items()}
    for b, c in sorted(target.items()):
        a = waiting[b][1]
        n = _trades(gains[a, b], stay.get((b, c), []), take.get((a, b), 0))
        if c != a:
            n = min(n, room[c])
            room[c] -= n
            room[a] += n
        if n:
            take[a, b] = take.get((a, b), 0) + n
            take[b, c + shards] = n  # a way of their own: others may ask for it as well
    if not take:
        return None
    key = lambda a, b: (a + 1) * 2 * shards + b
    out = F.get(F.array(*(F.lit(target.get(s)).cast("int") for s in range(shards))), F.col("_s"))
    to = F.when(may & _asks(), F.col("to")).when(may, out).cast("int")
    rows = votes.select("_node", "_s", "hubs", to.alias("_to"), F.when(_asks(), F.col("gain")).otherwise(_leaving(to)).alias("_gain"), key(F.col("_s"), to + F.when(_asks(), 0).otherwise(shards)).cast("long").alias("_queue"))
    rows = rows.withColumn("_queue", F.when(F.col("_queue").isin([key(*k) for k in take]), F.col("_queue")))  # two for each pair of shards at most
    order = [F.col("_queue"), F.desc("_gain"), F.xxhash64("_node"), F.col("_node")]
    ranged = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    # ids ascend from range to range, without gaps within one; a row for each queue in each range reaches the driver
    pieces = ranged.where("_queue IS NOT NULL").groupBy("_queue", F.shiftright("_id", 33).alias("_part")).agg(F.min("_id").alias("first"), F.count("*").alias("n")).collect()
    ends = []
    for k, most in take.items():
        for x in sorted((x for x in pieces if x["_queue"] == key(*k)), key=lambda x: x["first"]):
            if 0 < most <= x["n"]:
                ends.append((key(*k), x["first"] + most))
            most -= x["n"]
    limits = ranged.sparkSession.createDataFrame(ends, "_queue long, _end long")
    goes = F.col("_id") < F.col("_end")
    return ranged.join(F.broadcast(limits), "_queue", "left").select("_node", F.when(goes, F.pmod(F.col("_to"), F.lit(shards))).otherwise(F.col("_s")).cast("int").alias("_s"), "hubs"), ranged


def _rounds(at: DataFrame, links: DataFrame, left: list[int], shards: int, rounds: int = ROUNDS) -> tuple[DataFrame, list[int]]:
    """at after documents moved towards their neighbours, and what shards have left then.

    at: _node, shard (null: none so far). Where no hub has members in two shards, or a
    member without one, nothing can be gained and no round is made. What a round has written goes with the next one.
    """
    total, every = links.agg(F.count("*"), F.coalesce(F.sum(F.col("members") - 1), F.lit(0))).first()
    hubs = links.groupBy("_node").agg(F.collect_list("hub").alias("hubs"))
    label = base = cut(hubs.join(at.select("_node", F.coalesce("shard", F.lit(-1)).alias("_s")), "_node").select("_node", "_s", "hubs"))
    votes = cut(_votes(label, shards, total))
    gains, stay, kept = _counts(votes, shards, F.lit(True))
    stuck, changed = 0, False
    for r in range(rounds):
        if kept == every or stuck == STUCK:
            break
        may = F.lit(True)
        if stuck:  # neighbours that all moved at once miss each other
            may = F.pmod(F.xxhash64("_node", F.lit(r)), F.lit(1 << stuck)) == 0
            gains, stay, _ = _counts(votes, shards, may)
        room = list(left)
        went = _moves(votes, gains, stay, may, room, shards)
        if went is None:
            stuck += 1
            continue
        after, written = went
        heard = cut(_votes(after, shards, total))
        *ways, more = _counts(heard, shards, F.lit(True))
        if more <= kept:
            discard(heard)
            discard(written)
            stuck += 1
            continue
        discard(votes)
        discard(base)
        label, base, votes, (gains, stay), kept, left, stuck, changed = after, written, heard, ways, more, room, 0, True
    discard(votes)
    if changed:
        moved = at.join(label.select("_node", "_s"), "_node", "left")
        at = cut(moved.withColumn("shard", F.when(F.col("_s") >= 0, F.col("_s")).otherwise(F.col("shard")).cast("int")).select(*at.columns))
    discard(base)
    return at, left


def propagate(nodes: DataFrame, shards: int, links: DataFrame | None = None) -> DataFrame:
    """nodes (id, hub: binary, null for none) with `shard` and `slot`. links (id, hub): more hubs of nodes, as many as there are."""
    own = F.when(F.col("id").isNull(), F.xxhash64(F.lit("row"), F.monotonically_increasing_id())).otherwise(F.xxhash64("id"))
    at = cut(nodes.withColumns({"_key": own, "_node": F.monotonically_increasing_id()}))
    total = at.count()
    rooms = Rooms(total, shards)
    shared = None
    if links is not None:
        shared = _shared(at, links, max(1, total // shards))
        main = shared.groupBy("_node").agg(F.max(F.struct("members", "hub")).alias("_main")).select("_node", F.col("_main.hub").alias("_hub"))
        at = cut(at.join(main, "_node", "left").withColumn("hub", F.coalesce("_hub", "hub")).drop("_hub"))
    start = F.pmod(F.xxhash64("_key", F.lit("start")), F.lit(shards)).cast("int")
    held = at.where("hub IS NOT NULL").groupBy("hub", start.alias("s")).agg(F.count("*").alias("n"))
    hubs = held.groupBy("hub").agg(F.sum("n").alias("members"), F.max_by("s", F.struct("n", F.xxhash64("hub", "s"))).alias("aim")).where("members > 1")
    hubs = cut(hubs)
    # fewer than 2 * shards hubs can be larger than a shard
    size = max(1, total // shards)
    large = {bytes(r["hub"]): r["members"] for r in sorted(hubs.where(F.col("members") > size).collect(), key=lambda r: (-r["members"], bytes(r["hub"])))}
    for hub, n in large.items():
        rooms.cut(hub, n, size)
    for hub, n in large.items():
        if 0 < (rest := n - rooms.placed[hub]) and (s := rooms.fit(rest)) is not None:
            rooms.pieces[hub].append((rooms.placed[hub], s))
            rooms.left[s] -= rest
            rooms.placed[hub] = n
    settled, wait = [], hubs.where(F.col("members") <= size)
    n = wait.count()
    for r in itertools.count():
        most = max(rooms.left)
        fits = wait.where(F.col("members") <= most)
        if r == 0:
            asked = _queue(fits.withColumn("_aim", F.col("aim")), "_aim", n)
            limit = F.element_at(F.array(*map(F.lit, rooms.left)), F.col("_aim") + 1)
        else:  # the shards' room, one after the other, most room first
            order = sorted(range(shards), key=lambda s: (-rooms.left[s], s))
            ends = list(itertools.accumulate(rooms.left[s] for s in order))
            starts = [0, *ends[:-1]]
            asked = _queue(fits.withColumn("_all", F.lit(0)), "_all", n).drop("_all")
            asked = asked.withColumn("_aim", _along(F.col("before"), list(zip(starts, order, strict=True)), F.lit(order[0])))
            limit = _along(F.col("before"), list(zip(starts, ends, strict=True)), F.lit(0))
        taken = F.when(F.col("before") + F.col("members") <= limit, F.col("_aim"))
        done = cut(asked.select("hub", "members", "aim", taken.cast("int").alias("shard")))
        sums = {x["shard"]: (x["n"], x["m"]) for x in done.groupBy("shard").agg(F.count("*").alias("n"), F.sum("members").alias("m")).collect()}
        for s, (_, m) in sums.items():
            if s is not None:
                rooms.left[s] -= m
        settled.append(done.where("shard IS NOT NULL").select("hub", "members", "shard"))
        # what fitted nowhere, and what was not taken in
        wait = wait.where(F.col("members") > most).unionByName(done.where("shard IS NULL").select("hub", "members", "aim"))
        n -= sum(x for s, (x, _) in sums.items() if s is not None)
        if n < 2 * shards or (r and set(sums) <= {None}):
            break
    # where no hub fits, each has more members than any room; all rows have a place, so these are fewer than `shards`
    few = []
    for x in sorted(wait.collect(), key=lambda x: (-x["members"], bytes(x["hub"]))):
        if (s := rooms.fit(x["members"])) is not None:
            rooms.left[s] -= x["members"]
            few.append((x["hub"], x["members"], s))
        else:
            large[bytes(x["hub"])] = x["members"]
    for hub, m in large.items():
        rooms.cut(hub, m)
    wide = list(large)
    spark = nodes.sparkSession
    table = spark.createDataFrame([(h, m, s, None) for h, m, s in few] + [(bytearray(h), large[h], None, i) for i, h in enumerate(wide)], "hub binary, members long, shard int, wide int")
    for frame in settled:
        table = table.unionByName(frame.withColumn("wide", F.lit(None).cast("int")))
    return _placed(at, table, rooms, wide, shards, total, shared).drop("_key", "_node", "members", "wide")


def _placed(at: DataFrame, table: DataFrame, rooms: Rooms, wide: list[bytes], shards: int, total: int, shared: DataFrame | None) -> DataFrame:
    """Rows with the shard of their hub, wide hubs by pieces; then moved towards their neighbours; unlinked rows in what is left; and slots."""
    at = attach(at, table, "hub", "members", total, _own_key("_key"))
    buckets = max(1, math.ceil(total / BUCKET_ROWS))
    spread = F.pmod(F.xxhash64("_key", F.lit("bucket")), F.lit(buckets))
    order = [F.col("_key"), F.col("id")]
    if wide:
        at = cut(at)
        cutting = _ranked(at.where("wide IS NOT NULL"), "wide", order, spread, buckets, "_member")
        shard = F.lit(None).cast("int")
        for i, hub in enumerate(wide):
            shard = F.when(F.col("wide") == i, _along(F.col("_member"), rooms.pieces[hub], F.lit(None).cast("int"))).otherwise(shard)
        at = at.where("wide IS NULL").unionByName(cutting.withColumn("shard", shard).drop("_member"))
    at = cut(at)
    if shared is None:
        # each row has one hub: only hubs of a shard's size at most that were cut, because they fitted nowhere, can gain
        torn = [h for h in wide if len({s for _, s in rooms.pieces[h]}) > 1]
        if torn:
            shared = _shared(at.where(F.col("wide").isin([wide.index(h) for h in torn])), None, max(1, total // shards))
    if shared is not None:
        at, rooms.left = _rounds(at, shared, rooms.left, shards)
    # unlinked rows are numbered in a lane of their own, which is laid over the rooms
    ranked = _ranked(at.withColumn("_lane", F.coalesce("shard", F.lit(shards))), "_lane", order, spread, buckets, "_rank")
    size = [total // shards + (s < total % shards) for s in range(shards)]
    starts = list(itertools.accumulate(rooms.left, initial=0))[:-1]
    free = [(start, s) for s, start in enumerate(starts) if rooms.left[s]]
    shift = [(start, size[s] - rooms.left[s] - start) for start, s in free]
    loose = F.col("shard").isNull()
    rank = F.col("_rank")
    shard = F.when(loose, _along(rank, free, F.lit(0))).otherwise(F.col("shard"))
    slot = F.when(loose, rank + _along(rank, shift, F.lit(0))).otherwise(rank)
    return ranked.select(*(c for c in at.columns if c not in ("shard", "_lane")), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def equal_texts(text: Column) -> Column:
    """The hub of documents with equal texts."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def shared_lines(docs: DataFrame) -> DataFrame:
    """Links (doc_id, hub) of docs (doc_id, text) by their lines: a hub for each line that isn't blank, white space at its ends left out. Those that one document alone has hold nothing together and go in `_shared`."""
    line = F.explode(F.array_distinct(F.transform(F.split(F.col("text"), "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))))
    return docs.where("doc_id IS NOT NULL").select("doc_id", line.alias("line")).where("line <> ''").select("doc_id", F.unhex(F.md5(F.encode("line", "utf-8"))).alias("hub"))


OWN = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def cut_links(placed: DataFrame, links: DataFrame) -> DataFrame:
    """One row for placed (doc_id, shard) and links (doc_id, hub), each given once: n_links of hubs that two rows or more share, and n_cut, those of rows outside the shard that has most of their hub."""
    held = links.select("doc_id", "hub").join(placed.select("doc_id", "shard"), "doc_id").groupBy("hub", "shard").agg(F.count("*").alias("n"))
    hubs = held.groupBy("hub").agg(F.sum("n").alias("n"), F.max("n").alias("most")).where("n > 1")
    return hubs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_links"), F.coalesce(F.sum(F.col("n") - F.col("most")), F.lit(0)).alias("n_cut"))


def shard_documents(docs: DataFrame, shards: int = 8, links: DataFrame | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id and the columns of OWN. links (doc_id, hub): what else holds documents together."""
    return _sharded(docs.select("doc_id", "text"), shards, links).select("doc_id", *OWN)


def _sharded(docs: DataFrame, shards: int, links: DataFrame | None, *more: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(*more, F.col("doc_id").cast("long").alias("id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"), equal_texts(text).alias("hub"))
    links = None if links is None else links.select(F.col("doc_id").alias("id"), "hub")
    return propagate(slim, shards, links).withColumnsRenamed({"id": "doc_id"}).withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def with_shards(docs: DataFrame, shards: int = 8, links: DataFrame | None = None) -> DataFrame:
    """docs with all of its columns, text included, and those of OWN; columns of docs with these names give way. links: as in shard_documents.

    Rows get a number and are written once with it; shards are found without texts and joined by that number.
    """
    docs = docs.drop(*(c for c in docs.columns if c.lower() in OWN))
    rows = cut(docs.withColumn("_row", F.monotonically_increasing_id()))
    return rows.join(_sharded(rows, shards, links, "_row").select("_row", *OWN), "_row").drop("_row")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7."""
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), 8)
