"""Toxicity by a weighted finite-state pattern grammar.

Texts are cut into clauses at sentence marks. A lexical transducer turns words, and
phrases of several words (the longest that matches), into classes: insult, threat,
target, intent, negation, report, other. Small transducers each read the classes and
give the insults and threats among them a factor. Some read from the left: a target
or an intent stands before, a negation shortly before, reported speech has begun.
Some read from the right: the target, the object of the threat, a negation or the
one who is quoted comes after. The transducers of a direction are composed lazily into
one, whose factors are the products; a clause's score is the sum over its insults and
threats of weight times the factors of both directions. A threat word by itself says
little, with an intent or an object it says much; an insult counts more with a target.

The lexicon's insults are learned: words and word stems whose share among toxic
texts exceeds that among others, with the log of that ratio as weight, from at most
SAMPLE labelled rows that are not held out. A list of common insults and threats
in four languages has fixed weights. The logistic function is fitted to the same rows.

Defined results: null and empty texts have no clauses and get the base rate's
score; a null doc_id is not held out and teaches nothing; several labels of one
doc_id count as toxic if one is; without labels the fixed lists and a default
function are used; repeated rows are scored alike, each of them; other columns are
not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .store import cut

#: Most labelled rows to learn from, the first by a hash of doc_id.
SAMPLE = 20_000
#: Most learned words and stems; those with the largest weights stay.
LEXICON = 20_000
STEM = 5
RESULT = "doc_id long, held_out boolean, score double, predicted int"
INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT, OTHER = range(KINDS := 7)
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")
_MARKS = frozenset(".!?;\n")

#: Words of the classes in English, German, French and Spanish.
SEEDS = {
    INSULT: "idiot moron stupid loser scum trash pathetic worthless disgusting clown imbecile bastard idiota imbécil estúpido basura dummkopf idiotin abschaum trottel imbécile ordure crétin connard",
    THREAT: "kill murder strangle töten umbringen tuer assassiner matar asesinar",
    TARGET: "you your he she they him her them du dich dein ihr sie er tu toi vous il elle ils usted ustedes él ella ellos",
    NEGATION: "not no never without nicht kein keine nie ohne pas jamais sans nunca jamás sin",
    INTENT: "will shall gonna going must should werde wirst wird gehört vais va doit voy vas debe",
    REPORT: "said says wrote quoted claimed reported sagte schrieb berichtete dit écrit dijo escribió",
}
SEED_WEIGHT = {INSULT: 3.0, THREAT: 3.0}
#: Insults and threats of several words.
PHRASES = {
    INSULT: ["piece of trash", "piece of garbage", "waste of space", "shut up", "go to hell", "drop dead", "son of a bitch", "halt die klappe", "fahr zur hölle", "ferme ta gueule", "va en enfer", "vete al infierno", "hijo de puta"],
    THREAT: ["hunt you down", "beat you up", "make you pay", "watch your back", "find out where you live", "mach dich fertig", "schlag dich tot", "te faire payer", "te vas a arrepentir"],
}
PHRASE_WEIGHT = 4.0
#: What an insult and a threat count by themselves.
ALONE = {INSULT: 0.6, THREAT: 0.25}


@dataclass(frozen=True)
class Transducer:
    """States are small integers, 0 the first. arcs: (state, class) -> state; a missing arc stays. factor: (state, class) -> factor of an insult or threat that is read there; a missing one is 1."""

    arcs: dict
    factor: dict

    def step(self, state: int, kind: int) -> int:
        return self.arcs.get((state, kind), state)


def _fading(kind: int, span: int, factors: dict[int, float]) -> Transducer:
    """After a word of `kind`, insults and threats among the next `span` words have factors."""
    arcs = {(s, k): s - 1 for s in range(1, span + 1) for k in range(KINDS)}
    arcs |= {(s, kind): span for s in range(span + 1)}
    return Transducer(arcs, {(s, k): f for s in range(1, span + 1) for k, f in factors.items()})


def _lasting(kind: int, factors: dict[int, float]) -> Transducer:
    """After a word of `kind`, insults and threats in the rest of the clause have factors."""
    return Transducer({(0, kind): 1}, {(1, k): f for k, f in factors.items()})


#: From the left: insult with a target, threat with an intent, negation, reported speech.
FORWARD = (_lasting(TARGET, {INSULT: 1.5}), _fading(INTENT, 4, {THREAT: 3.0}), _fading(NEGATION, 3, {INSULT: 0.25, THREAT: 0.25}), _lasting(REPORT, {INSULT: 0.4, THREAT: 0.4}))
#: From the right: insult with a target, threat with an object, negation, reported speech.
BACKWARD = (_fading(TARGET, 3, {INSULT: 1.5, THREAT: 3.0}), _fading(NEGATION, 3, {INSULT: 0.4, THREAT: 0.25}), _lasting(REPORT, {INSULT: 0.4, THREAT: 0.4}))


class Composed:
    """The product of transducers, whose arcs are made as they are first taken."""

    def __init__(self, parts: tuple[Transducer, ...]):
        self.parts, self.arcs = parts, {}

    def factors(self, kinds: list[int]) -> list[float]:
        """The factor of each word of a clause, in the order in which it is read."""
        state, out = (0,) * len(self.parts), []
        for kind in kinds:
            arc = self.arcs.get((state, kind))
            if arc is None:
                new = tuple(p.step(s, kind) for p, s in zip(self.parts, state, strict=True))
                factor = math.prod(p.factor.get((s, kind), 1.0) for p, s in zip(self.parts, state, strict=True))
                arc = self.arcs[state, kind] = (new, factor)
            out.append(arc[1])
            state = arc[0]
        return out


class Grammar:
    """Both directions, composed."""

    def __init__(self, forward: tuple[Transducer, ...] = FORWARD, backward: tuple[Transducer, ...] = BACKWARD):
        self.forward, self.backward = Composed(forward), Composed(backward)

    def run(self, kinds: list[int], weights: list[float]) -> float:
        """The score of a clause."""
        left, right = self.forward.factors(kinds), self.backward.factors(kinds[::-1])[::-1]
        return sum(w * ALONE[k] * a * b for k, w, a, b in zip(kinds, weights, left, right, strict=True) if w)


class Lexical:
    """From words to (class, weight): phrases by a trie, the longest match first, then single words."""

    def __init__(self, kinds: dict[str, int]):
        self.kinds, self.trie = kinds, {}
        for kind, phrases in PHRASES.items():
            for phrase in phrases:
                node = self.trie
                for w in phrase.split():
                    node = node.setdefault(w, {})
                node[""] = kind

    def read(self, clause: list[str], hot: dict[str, float]) -> tuple[list[int], list[float]]:
        """hot: weights of single insults and threats."""
        kinds, weights, i = [], [], 0
        while i < len(clause):
            node, end, kind, j = self.trie, i, OTHER, i
            while j < len(clause) and (node := node.get(clause[j])):
                j += 1
                if "" in node:
                    end, kind = j, node[""]
            if end > i:
                kinds.append(kind)
                weights.append(PHRASE_WEIGHT)
                i = end
                continue
            w = clause[i]
            own = self.kinds.get(w, OTHER)
            kinds.append(THREAT if own == THREAT else INSULT if w in hot else own)
            weights.append(hot.get(w, 0.0))
            i += 1
        return kinds, weights


class Scorer:
    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words = {w: SEED_WEIGHT[k] for k in SEED_WEIGHT for w in SEEDS[k].split()} | words
        self.stems = stems
        self.lexical = Lexical({w: k for k, ws in SEEDS.items() for w in ws.split()})
        self.grammar = Grammar()

    def weight(self, word: str) -> float:
        return self.words.get(word) or (self.stems.get(word[:STEM], 0.0) if len(word) > STEM else 0.0)

    def raw(self, text: str) -> float:
        """The sum of the scores of a text's clauses, each 0 at least."""
        tokens = _TOKEN.findall(text.lower())
        some = set(tokens)
        hot = {w: x for w in some if (x := self.weight(w))}
        heads = some & self.lexical.trie.keys()
        if not hot and not heads:
            return 0.0
        total, done = 0.0, -1
        for i in [i for i, w in enumerate(tokens) if w in hot or w in heads]:
            if i < done:
                continue
            start = i
            while start > 0 and tokens[start - 1] not in _MARKS:
                start -= 1
            done = i
            while done < len(tokens) and tokens[done] not in _MARKS:
                done += 1
            kinds, weights = self.lexical.read(tokens[start:done], hot)
            if any(weights):
                total += max(0.0, self.grammar.run(kinds, weights))
        return total


def _held(ids: list, modulus: int, remainder: int) -> np.ndarray:
    return np.array([x is not None and zlib.crc32(str(x).encode()) % modulus == remainder for x in ids], bool)


def _evidence(batches):
    """Counts of words and stems in labelled texts: rows (word, stem, toxic, other)."""
    count: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            found = {w for w in _TOKEN.findall((text or "").lower()) if w not in _MARKS}
            count.update((w, False, toxic) for w in found)
            count.update((w, True, toxic) for w in {w[:STEM] for w in found if len(w) > STEM})
    names = list(count)
    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in names], pa.string()), pa.array([x[1] for x in names], pa.bool_()), pa.array([count[x] if x[2] else 0 for x in names], pa.int64()), pa.array([0 if x[2] else count[x] for x in names], pa.int64())], names=["word", "stem", "toxic", "other"])


def lexicon(sample: DataFrame, toxic: int, other: int, least: int = 3, ratio: float = 3.0) -> tuple[dict[str, float], dict[str, float]]:
    """Learned weights of words and stems of sample (text, toxic).

    Candidates have a large enough weight. Of these, words are taken by how many
    toxic texts they explain that no word taken before does: a word that is found
    only beside insults is not one.
    """
    sums = sample.mapInArrow(_evidence, "word string, stem boolean, toxic long, other long").groupBy("word", "stem").agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"))
    weight = F.log((F.col("t") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("o") + 0.5) / F.lit(other + 1.0))
    least = max(least, toxic // 500)
    rows = sums.withColumn("weight", weight).where((F.col("t") >= least) & (F.col("weight") >= ratio)).orderBy(F.desc("weight"), "word").limit(LEXICON).collect()
    weights = {(r["word"], r["stem"]): r["weight"] for r in rows}
    shared = sample.sparkSession.sparkContext.broadcast(frozenset(weights))

    def found(batches):
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                tokens = {w for w in _TOKEN.findall((text or "").lower())}
                out.append([w for w in tokens if (w, False) in shared.value] + [f"^{w}" for w in {w[:STEM] for w in tokens if len(w) > STEM} if (w, True) in shared.value])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], names=["words"])

    held: dict[str, set[int]] = {}
    for i, r in enumerate(sample.where("toxic").mapInArrow(found, "words array<string>").collect()):
        for w in r["words"]:
            held.setdefault(w, set()).add(i)
    words, stems = {}, {}
    while held:
        best = max(held, key=lambda w: (len(held[w]), w[0] != "^", w))
        if len(held[best]) < least:
            break
        gone = held.pop(best)
        if best[0] == "^":
            stems[best[1:]] = weights[best[1:], True]
        else:
            words[best] = weights[best, False]
        held = {w: left for w, x in held.items() if len(left := x - gone) >= least}
    return words, stems


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic function by Newton's method, with a weak prior."""
    w = np.array([1.0, -3.0])
    features = np.stack([x, np.ones_like(x)], 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        grad = features.T @ (n * (y - p)) - 0.01 * w
        hess = (features * (n * p * (1 - p))[:, None]).T @ features + 0.01 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def squash(raw: float) -> float:
    return math.log1p(raw)


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, sample: int = SAMPLE) -> DataFrame:
    """Per row of docs (doc_id, text): held_out, score and predicted, learned from labels (doc_id, toxic) of rows that are not held out."""
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) != remainder).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    few = ids.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` pairs of numbers: a proven bound
    taught = cut(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("text", (F.col("toxic") == 1).alias("toxic")).distinct())
    n = {r[0]: r[1] for r in taught.groupBy("toxic").count().collect()}
    words, stems = lexicon(taught, n.get(True, 0), n.get(False, 0)) if n.get(True) else ({}, {})
    scorer = spark.sparkContext.broadcast(Scorer(words, stems))

    def raws(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([round(squash(scorer.value.raw(t or "")), 2) for t in batch["text"].to_pylist()], pa.float64()), batch["toxic"]], names=["x", "toxic"])

    points = taught.mapInArrow(raws, "x double, toxic boolean").groupBy("x", "toxic").count().toPandas()
    slope, offset = logistic(points["x"].to_numpy(float), points["toxic"].to_numpy(float), points["count"].to_numpy(float)) if len(set(points["toxic"])) == 2 else (2.0, -3.0)

    def judge(batches):
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            x = np.array([squash(scorer.value.raw(t or "")) for t in batch["text"].to_pylist()], float)
            score = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(_held(ids, modulus, remainder)), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(judge, RESULT)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
