"""Quality rules as learned decision lists, by DataFrame functions alone.

Features of every text are native Spark expressions. Labelled rows give, for a
bounded sample, a table of statistics: per combination of binned features how many
rows were good and bad, in a growing and a pruning part. Sequential covering over
that table grows a conjunction of thresholds by information gain, prunes it by
(bad - good) / (bad + good) on the pruning part, takes out what it covers, and
goes on while rules stay precise. The list is emitted as one ordered
CASE WHEN, which Catalyst sees through.

Defined results: null text has no words and fails the base rule; a null label or
doc_id teaches nothing; several labels of one doc_id count as bad if one is;
repeated rows are judged alike, each of them; an empty labels table gives an empty
list, which keeps all that pass the base rule; an empty table gives no rows. `judge`
replaces columns of docs that are named like those it adds; `passing` keeps all.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .store import cut

#: Most labelled rows that a list is learned from, the first by a hash of doc_id.
SAMPLE = 20_000
BINS = 24
#: A rule must be at least this precise on the growing and the pruning part, and cover so many bad rows.
PRECISION, LEAST = 0.9, 4
MOST_RULES, MOST_TERMS = 12, 3
#: Positions take the low 20 bits of a first sort key; longer texts are sorted by structs of the whole hash and the place.
_PLACE = 20

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def features(docs: DataFrame) -> DataFrame:
    """docs with columns of BASE and of the features that rules look at. Needs text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumn("_mr_w", F.array_remove(F.split(text, r"[ \t-\r]+"), ""))
    low = (1 << _PLACE) - 1
    d = d.withColumn("_mr_h", F.expr("CASE WHEN size(_mr_w) < 3 THEN cast(array() as array<bigint>) ELSE transform(sequence(0, size(_mr_w) - 3), i -> xxhash64(_mr_w[i], _mr_w[i + 1], _mr_w[i + 2])) END"))
    # only texts in which a hash occurs twice need places
    d = d.withColumn("_mr_twice", F.expr("size(array_distinct(_mr_h)) < size(_mr_h)"))
    d = d.withColumn("_mr_s", F.expr(f"CASE WHEN _mr_twice AND size(_mr_h) <= {low} THEN sort_array(transform(_mr_h, (x, i) -> (x & {~low}L) | cast(i as bigint))) ELSE cast(array() as array<bigint>) END"))
    same = lambda a, b: f"(_mr_s[{a}] & {~low}L) = (_mr_s[{b}] & {~low}L)"
    d = d.withColumn("_mr_p", F.expr(f"""sort_array(filter(transform(_mr_s, (x, i) -> CASE WHEN (i > 0 AND {same('i', 'greatest(i - 1, 0)')}) OR (i < size(_mr_s) - 1 AND {same('i', 'least(i + 1, size(_mr_s) - 1)')}) THEN x & {low}L ELSE -1L END), x -> x >= 0))"""))
    # what looks repeated by the high bits is compared by whole hashes; long texts are so from the start
    d = d.withColumn("_mr_p", F.expr(f"CASE WHEN _mr_twice AND size(_mr_h) > {low} THEN sequence(0L, size(_mr_h) - 1L) ELSE _mr_p END"))
    d = d.withColumn("_mr_p", F.expr(f"CASE WHEN size(_mr_p) = 0 THEN _mr_p ELSE {_repeated()} END"))
    repeat = F.expr("CASE WHEN size(_mr_p) = 0 THEN 0L ELSE aggregate(transform(_mr_p, (x, i) -> CASE WHEN i = size(_mr_p) - 1 THEN 3L ELSE least(3L, _mr_p[least(i + 1, size(_mr_p) - 1)] - x) END), 0L, (a, x) -> a + x) END")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0)
    d = d.withColumn("_mr_l", lines)
    d = d.withColumns({
        "n_words": F.size("_mr_w").cast("long"), "word_chars": F.length(F.concat_ws("", "_mr_w")).cast("long"),
        "n_symbols": F.expr(r"cast(regexp_count(coalesce(text, ''), '[#*$%&|<>]') as bigint)"),
        "n_dup_lines": (F.size("_mr_l") - F.size(F.array_distinct("_mr_l"))).cast("long"), "n_repeat_words": repeat,
    })
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    d = d.withColumns({
        "f_words": F.col("n_words").cast("double"), "f_mean_chars": F.col("word_chars") / words, "f_symbols": F.col("n_symbols") / words,
        "f_dup_lines": F.col("n_dup_lines") / F.greatest(F.size("_mr_l"), F.lit(1)), "f_repeats": F.col("n_repeat_words") / words,
        "f_upper": count("[A-Z]") / chars, "f_marks": count("[!?|]") / words, "f_lines": F.size("_mr_l") / words,
        "f_distinct": F.size(F.array_distinct("_mr_w")) / words,
    })
    # A generator of one row: filters on features stay above it, else the optimiser would
    # write their expressions, lambdas and all, once more into each filter.
    return d.select(*docs.columns, F.inline(F.array(F.struct(*BASE, *FEATURES))))


def _repeated() -> str:
    """SQL: of the places _mr_p, those whose window hash occurs twice among them, sorted."""
    sorted_ = "sort_array(transform(_mr_p, p -> named_struct('h', _mr_h[cast(p as int)], 'i', p)))"
    return f"""sort_array(flatten(transform(array({sorted_}), t -> filter(transform(t, (x, k) -> CASE WHEN (k > 0 AND t[greatest(k - 1, 0)].h = x.h) OR (k < size(t) - 1 AND t[least(k + 1, size(t) - 1)].h = x.h) THEN x.i ELSE -1L END), x -> x >= 0))))"""


FEATURES = ["f_words", "f_mean_chars", "f_symbols", "f_dup_lines", "f_repeats", "f_upper", "f_marks", "f_lines", "f_distinct"]


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool
    value: float

    def column(self) -> Column:
        return F.col(self.feature) > self.value if self.above else F.col(self.feature) <= self.value

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.value:.6g}"


Rule = tuple[Term, ...]


def failed_base() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def statistics(labelled: DataFrame, sample: int = SAMPLE, bins: int = BINS) -> tuple[dict[str, list[float]], list[dict]]:
    """Thresholds of each feature, and counts by bins: at most `sample` rows. labelled: doc_id, bad, FEATURES."""
    few = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    cuts = few.agg(*(F.percentile_approx(f, [(i + 1) / (bins + 1) for i in range(bins)], 10_000).alias(f) for f in FEATURES), *(F.percentile_approx(F.when(F.col("bad") == 1, F.col(f)), [(i + 1) / (bins + 1) for i in range(bins)], 10_000).alias(f"{f}_bad") for f in FEATURES)).first()
    points = {f: sorted({*(cuts[f] or ()), *(cuts[f"{f}_bad"] or ())}) for f in FEATURES}
    thresholds = {f: [(a + b) / 2 for a, b in zip(p, p[1:], strict=False)] for f, p in points.items()}  # amid the gaps
    binned = [sum((F.when(F.col(f) > t, 1).otherwise(0) for t in thresholds[f]), F.lit(0)).alias(f) for f in FEATURES]
    part = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0, "prune").otherwise("grow").alias("part")
    table = few.select(*binned, part, "bad").groupBy(*FEATURES, "part").agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
    return thresholds, [r.asDict() for r in table.collect()]


def learn(thresholds: dict[str, list[float]], table: list[dict]) -> list[Rule]:
    """Sequential covering over a table of binned counts."""

    def counts(rows: list[dict]) -> tuple[int, int]:
        return sum(r["bad"] for r in rows), sum(r["n"] - r["bad"] for r in rows)

    def covers(term: tuple[str, bool, int], r: dict) -> bool:
        return (r[term[0]] > term[2]) == term[1]

    rules, left = [], table
    while len(rules) < MOST_RULES:
        rows, terms = [r for r in left if r["part"] == "grow"], []
        while len(terms) < MOST_TERMS:
            p0, n0 = counts(rows)
            if not p0 or not n0:
                break
            best, gain = None, 1e-9
            for f in FEATURES:
                size = len(thresholds[f])
                bad, good = [0] * (size + 1), [0] * (size + 1)
                for r in rows:
                    bad[r[f]] += r["bad"]
                    good[r[f]] += r["n"] - r["bad"]
                p, n = 0, 0
                for k in range(size):  # bins up to k against those above
                    p, n = p + bad[k], n + good[k]
                    for above, a, b in ((False, p, n), (True, p0 - p, n0 - n)):
                        if a >= LEAST and (g := a * (math.log2(a / (a + b)) - math.log2(p0 / (p0 + n0)))) > gain:
                            best, gain = (f, above, k), g
            if best is None:
                break
            terms.append(best)
            rows = [r for r in rows if covers(best, r)]
        held = [r for r in left if r["part"] == "prune"]

        def worth(some: list) -> float:
            p, n = counts([r for r in held if all(covers(t, r) for t in some)])
            return (p - n) / (p + n) if p + n else -1.0

        while len(terms) > 1 and worth(terms[:-1]) >= worth(terms):
            terms = terms[:-1]
        if not terms:
            break
        covered = [r for r in left if all(covers(t, r) for t in terms)]
        p, n = counts(covered)
        hp, hn = counts([r for r in covered if r["part"] == "prune"])
        if p < LEAST or p < PRECISION * (p + n) or hp < PRECISION * (hp + hn):
            break
        rules.append(tuple(Term(f, above, thresholds[f][k]) for f, above, k in terms))
        left = [r for r in left if not all(covers(t, r) for t in terms)]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The name of the first rule that fires, else null: an ordered conditional expression."""
    out = F
    for rule in rules:
        condition = rule[0].column()
        for t in rule[1:]:
            condition &= t.column()
        out = out.when(condition, F.lit(" AND ".join(map(str, rule))))
    return out.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs with BASE, base_failed, rule (the rule that rejected it, if any) and kept. Features are taken in one pass over all rows."""
    names = {c.lower() for c in docs.columns}
    clash = [c for c in [*BASE, *FEATURES, "base_failed", "rule", "kept"] if c in names]
    docs = docs.drop(*clash)
    bad = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((1 - F.min("quality")).cast("int").alias("bad"))
    # the sample is found by doc_id alone, so that only its texts are read for learning
    few = docs.select("doc_id").where("doc_id IS NOT NULL").join(bad, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    labelled = features(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id"))
    thresholds, table = statistics(cut(labelled.select("doc_id", "bad", *BASE, *FEATURES)).where(~failed_base()), sample)
    rules = learn(thresholds, table)
    out = features(docs).withColumn("base_failed", failed_base())
    out = out.withColumn("rule", F.when(~F.col("base_failed"), verdict(rules)))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop(*FEATURES)


def passing(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that are kept, with their own columns, whatever these are called."""
    columns = docs.columns
    needed = docs.withColumnsRenamed({c: f"_in_{c}" for c in columns if c not in ("doc_id", "text")})
    kept = judge(needed, labels, sample).where("kept")
    return kept.select(*(F.col(c if c in ("doc_id", "text") else f"_in_{c}").alias(c) for c in columns))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on all documents."""
    found = judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", *BASE, "base_failed", "kept", "rule")
