import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import near_dups, scatter, substrings, winnowing, words as w

from . import brute

SCHEMA = "doc_id long, text string, other string"
ODD = [(1, None, "x"), (2, "", "x"), (None, "a b c", None), (3, " \t\n", "x"), (4, "a b c", "x"), (4, "a b c", "x"), (5, "é   x", "x")]


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["É", "Wort", "x,y"]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([3, 30, 80, 200])))) for i in range(n)]
    for i in range(n, n + 30):  # near copies and shared passages
        t = rows[rng.randrange(n)][1].split()
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        rows.append((i, "\n".join([" ".join(t[: len(t) // 2]), " ".join(t[len(t) // 2 :])])))
    rows.append((n + 30, " ".join(["long"] * 5000 + vocab)))
    return [(i, t, "o") for i, t in rows] + [(None if d is None else d + 1000, t, o) for d, t, o in ODD]


def test_words_split_and_hash_as_the_pattern_does():
    texts = [t for _, t, _ in corpus()]
    for member, pattern, fold in ((w.SPACED, brute.SPACE, False), (w.ALNUM, brute.ALNUM, True)):
        got = w.words(pa.array(texts), member, fold)
        names = {}
        for i, t in enumerate(texts):
            want = pattern.findall(brute.fold(t) if fold else t or "")
            assert got.count[i] == len(want)
            for x, h in zip(want, got.hash[got.first[i] : got.first[i + 1]], strict=True):
                assert names.setdefault(x, h) == h
        assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("n", [1, 2, 5, 10, 15, 35])
def test_window_hashes_are_equal_for_equal_windows_only(n):
    h = np.random.default_rng(n).integers(1, 4, 300).astype(np.uint64)
    got, names = w.windows(h, n), {}
    for i, x in enumerate(got.tolist()):
        assert names.setdefault(tuple(h[i : i + n]), x) == x
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("period", substrings.COVERS)
def test_covers_have_every_difference(period):
    d = substrings.COVERS[period]
    assert {(a - b) % period for a in d for b in d} == set(range(period))


@pytest.mark.parametrize("window", [5, 12, 35])
def test_repeated_passages(spark, window):
    rows = corpus()
    got = substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), window, batch_bytes=2000).collect()
    want = [(d, n, n - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for (d, _, _), (n, k) in zip(rows, brute.repeats([(d, t) for d, t, _ in rows], window), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("window", [5, 35])
def test_repeated_passages_in_two_levels(spark, window, monkeypatch):
    """Few lanes, each with groups of its own, and merges of a few batches: the same rows."""
    monkeypatch.setattr(scatter, "EACH", 20)
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert scatter.Fan.of(8, 2000 // 30, 3) == scatter.Fan(3, 3, 3)
    got, one = (substrings.remove_repeats(docs, window, batch_bytes=2000, fan=fan).collect() for fan in (3, None))
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, one), key=str)


def test_rows_sent_grow_as_batches_do(spark):
    """Of ten times the batches with ten times the groups, two levels send some ten times the rows, one level a hundred times."""

    def sent(batches, groups):
        fan = scatter.Fan.of(groups, 400, 8)
        rng = np.random.default_rng(3)
        rows = []
        for b in range(batches):
            keys = np.unique(rng.integers(0, 1 << 63, 400, np.uint64))
            rows += [(f"0-{b}", scatter.TEXTS, 1, None, None, None), *scatter.send(f"0-{b}", keys, np.ones(len(keys), bool), keys, fan.lanes)]
        frame = spark.createDataFrame(pa.Table.from_batches([scatter.rows(*rows)]))
        _, on = scatter.merged(fan, frame, "bit", 8)
        return frame.where("p >= 0").count() + on.count(), batches * groups

    few, many = sent(20, 16), sent(200, 160)
    assert many[0] <= 15 * few[0] and many[1] == 100 * few[1]


@pytest.mark.parametrize("bits", [winnowing.FILTER_BITS, 4])
def test_decontamination(spark, bits):
    """With 16 bits nearly all fingerprints pass the filter, and the joins alone decide."""
    rows = corpus()
    items = [(i, " ".join(rows[i][1].split()[5:25]).upper()) for i in range(0, 12)] + [(12, "w1 w2"), (13, None), (14, ""), (None, "w3 w4 w5"), (12, "w1 w2")]
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    got = winnowing.decontaminate(docs, bench, 10, bits=bits).collect()
    want = [(d, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), h > 0) for (d, _, _), (n, h, x) in zip(rows, brute.contamination([(d, t) for d, t, _ in rows], items, 10), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    clean = winnowing.drop_contaminated(docs, bench, 10, bits=bits)
    assert clean.columns == docs.columns
    assert sorted(map(str, clean.collect())) == sorted(str(r) for r, x in zip(docs.collect(), want, strict=True) if not x[5])


@pytest.mark.parametrize(("percent", "size", "block"), [(85, 3, 2000), (80, 5, 2000), (60, 2, 3)])
def test_near_duplicates(spark, percent, size, block):
    rows = corpus(5, 40)
    got = near_dups.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent, size, block).collect()
    want = []
    for (d, t, _), (c, n) in zip(rows, brute.components([(d, t) for d, t, _ in rows], percent, size), strict=True):
        want.append((d, n, c, n == 0 or (d is not None and d == c)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_large_groups_of_near_copies_are_dealt_in_blocks(spark):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    other = [f"c{i}" for i in range(120)]
    rows = []
    for i in range(60):
        t = list(base if i % 3 else other)
        t[rng.randrange(120)] = f"x{i}"
        if i % 7 == 0:
            t = base[:75] + [f"y{i}_{k}" for k in range(45)]  # candidates that are no links
        rows.append((i, " ".join(t), "o"))
    got = near_dups.near_duplicates(spark.createDataFrame(rows, SCHEMA), 85, 3, 8).collect()
    want = brute.components([(d, t) for d, t, _ in rows], 85, 3)
    assert {r[0]: r[2] for r in got} == {d: c for (d, _, _), (c, _) in zip(rows, want, strict=True)}


def test_keep_one_keeps_columns_and_one_row_of_each_group(spark):
    rows = corpus(5, 40)
    kept = near_dups.keep_one(spark.createDataFrame(rows, SCHEMA), 85, 3)
    assert kept.columns == ["doc_id", "text", "other"]
    ids = [r[0] for r in kept.collect()]
    want = {c for c, n in brute.components([(d, t) for d, t, _ in rows], 85, 3) if n}
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and want <= set(ids)


def test_keep_one_goes_by_row_not_by_id(spark):
    text = [" ".join(f"{a}{i}" for i in range(30)) for a in "abcd"]
    rows = [(7, text[0], "x"), (7, text[1], "x"), (8, text[2], "x"), (None, text[3], "x"), (None, text[3], "x"), (None, text[2], "x"), (9, text[2], "x"), (5, text[0], "x"), (1, "", "x"), (1, "", "x"), (2, None, "x")]
    got = [(r.doc_id, r.text) for r in near_dups.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(3), 85, 3).collect()]
    assert sorted(got, key=str) == sorted([(5, text[0]), (7, text[1]), (8, text[2]), (None, text[3]), (1, ""), (1, ""), (2, None)], key=str)


def test_components_of_chains_and_stars(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("s000", f"s{i:03d}") for i in range(1, 200)]
    got = {r.node: r.root for r in near_dups.components(spark.createDataFrame(chain + star, "a string, b string")).collect()}
    assert got == {f"c{i:03d}": "c000" for i in range(61)} | {f"s{i:03d}": "s000" for i in range(200)}


def test_recall_of_bands_on_many_pairs(spark):
    """300 pairs just above the threshold, against exact similarity."""
    rng = random.Random(11)
    rows, want = [], {}
    for p in range(300):
        base = [f"p{p}w{i}" for i in range(200)]
        other = list(base)
        for k in range(rng.choice([1, 2, 4, 5, 6])):
            other[10 + 30 * k] = f"q{p}x{k}"
        rows += [(2 * p, " ".join(base), "o"), (2 * p + 1, " ".join(other), "o")]
    for (d, _, _), (c, _) in zip(rows, brute.components([(d, t) for d, t, _ in rows], 85, 3), strict=True):
        want[d] = c
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(spark.createDataFrame(rows, SCHEMA), 85, 3).collect()}
    assert got == want and sum(c != d for d, c in want.items()) > 100


def test_windows_of_items_know_their_sets(spark):
    items = [("b", "a b c d e f g h i j k"), ("a", "a b c d e f g h i j"), ("c", "x y"), ("c", "x y"), ("d", None), ("e", "- -")]
    given = winnowing.Benchmark(spark.createDataFrame(items, "item_id string, text string"), 10, 4, 16)
    assert sorted((r.n, tuple(r.items)) for r in given.windows.select("n", "items").collect()) == [(2, ("c",)), (10, ("a", "b")), (10, ("b",))]
    assert given.lengths == [2, 10] and given.windows.select("set").distinct().count() == 3


def test_filter_of_fingerprints_holds_two_bits_each(spark):
    prints = [0, 1, -1, 2**40 + 77, -(2**63), 123456789012345]
    held = np.unpackbits(np.frombuffer(winnowing.filter_bits(spark.createDataFrame([(p,) for p in prints], "print long"), 20), np.uint8), bitorder="little")
    want = {b for p in prints for b in ((p % 2**64) % 2**20, ((p % 2**64) >> 32) % 2**20)}
    assert set(np.flatnonzero(held).tolist()) == want and len(held) == 2**20


def test_passage_in_many_items_and_documents_is_listed_once(spark):
    """300 documents and 40 items share one passage: the joins see windows and sets of items, and no pair of document and item."""
    passage = " ".join(f"p{i}" for i in range(14))
    items = [(i, f"{passage} own{i} " * 2) for i in range(40)]
    rows = [(d, f"d{d} {passage} " + (f"{passage} own{d} p0" if d % 50 == 0 else "end")) for d in range(300)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = winnowing.decontaminate(docs, bench).collect()
    want = [(d, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), h > 0) for (d, _), (n, h, x) in zip(rows, brute.contamination(rows, items, 10), strict=True)]
    assert sorted(map(tuple, got)) == sorted(want)
    given = winnowing.Benchmark(bench, 10, 4, 16)
    hits = given.hits(winnowing._flat(given.candidates(docs, "doc_id", "long", False), "doc_id").withColumnRenamed("doc_id", "_row"))
    assert hits.count() == sum(len({i for i in range(len(t.split()) - 9) if any(" ".join(t.split()[i : i + 10]) in x for _, x in items)}) for _, t in rows)


@pytest.mark.parametrize("run", [lambda d: substrings.remove_repeats(d), lambda d: near_dups.near_duplicates(d), lambda d: winnowing.decontaminate(d, d.sparkSession.createDataFrame([], "item_id long, text string"))])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("percent", [80, 85])
def test_bands_miss_few_pairs(percent):
    r = near_dups.band_rows(percent)
    assert (1 - (percent / 100) ** r) ** (near_dups.MINIMA // r) <= near_dups.MISSED


def test_posterior_bounds_let_true_pairs_through():
    # a pair at the threshold falls below a bound rarely: the binomial tail below it
    from math import comb

    for n, least in near_dups.bounds(0.85):
        assert sum(comb(n, m) * 0.85**m * 0.15 ** (n - m) for m in range(least)) < 1e-4
