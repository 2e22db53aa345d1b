"""Personal data and secrets by patterns and a skip-chain conditional random field.

Base spans come from four patterns and their checks. The field labels tokens as
other, id or secret. Its nodes are words with a digit, an at-sign or an underscore,
words of LONG characters or more, and values that are assigned to a name such as
`password`; the last are observed as secrets, words in base spans as ids. A node has
a unary potential of its form (length, share of digits, marks, case) and of the word
before it. Neighbouring nodes share a chain potential; tokens that repeat, or are
similar (the same letters and digits, or the same first or last EDGE of them), share a
skip potential, each with its next occurrence, however far away in the document.
Loopy message passing brings the labels of a document into line. An unobserved node
whose marginal of id or secret reaches SURE adds a span, unless its messages did not settle.

Unary and coupling weights are learned together by pseudo-likelihood, over all
documents: for every node whose label is known, its form, the word before, its
neighbours' known labels and its own label are counted, and the counts alone are
collected. Observed nodes are known, and nodes that repeat no observed one are taken
as other; what repeats an observed node elsewhere is the field's to find, and teaches
nothing. Forms, words before (which fall into fixed groups) and neighbours' labels have
a fixed number of combinations whatever the corpus, of which some hundreds occur.

Defined results: null text is empty; a text without nodes has no added spans; repeated
rows and rows without doc_id are scored like others, each of them; other columns are
not read, whatever their names; an empty table gives no rows; without base spans or
assigned secrets anywhere nothing is added.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .words import chunks

SURE = 0.9
ROUNDS, SETTLED = 300, 1e-4
LONG, EDGE = 20, 8
KINDS = ("email", "ip", "card", "phone", "id", "secret")
OTHER, ID, SECRET = range(3)
LABELS = 3
CHAIN, EQUAL, SIMILAR = range(3)
RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_id long, n_secret long, n_spans long"
#: Names whose assigned values are secrets, and words that stand before personal data.
SECRET_NAMES = "token secret password passwd passwort pwd apikey api_key api-key access_key secret_key private_key credential clave contraseña"
CUES = ("token secret password passwd pwd key apikey api_key", "phone tel call mobile fax telefon teléfono téléphone", "mail email e-mail contact", "ip host address server adresse")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The look-behind only spares retries inside a run of digits, where no match can begin.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIM = "\"'()[]{}<>,;:.!?#*$%&|="
_CANDIDATE = re.compile(r"[0-9@]")
_NODE = re.compile(r"[0-9@_]|\S{%d}" % LONG)
_ASSIGNED = re.compile(r"[:=]\s{0,3}[\"']?([^\s\"']{8,})")
_NAME = re.compile(rf"(?i)(?<![a-z])(?:{'|'.join(SECRET_NAMES.split())})s?[\"']?\s{{0,3}}$")
_NAME_ROOM = 24  # longer than any name with what may follow it
_CUE = {w: i for i, ws in enumerate(CUES) for w in ws.split()}
_LENGTHS = (4, 6, 8, 12, 16, 24, 40)
FLAGS, BEFORE = 5, 8
MOST_COUPLING = 8.0
#: The prior means of the couplings: equal tokens have one label unless the corpus shows otherwise.
PRIOR = (0.0, 6.0, 0.0)
FORMS = (len(_LENGTHS) + 1) * 4 * (1 << FLAGS)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = x * 2 - 9 * (x > 4)
        total += x
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from each at-sign outwards, so that long words cost no retries."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, m.end(), "email"))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind."""
    out = emails(text)
    if not _CANDIDATE.search(text):
        return out
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(p := x.lstrip("0") or "0") <= 3 and int(p) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def assigned(text: str) -> list[tuple[int, int]]:
    """Where values stand that are assigned to names of secrets."""
    if "=" not in text and ":" not in text:
        return []
    return [m.span(1) for m in _ASSIGNED.finditer(text) if _NAME.search(text, max(0, m.start() - _NAME_ROOM), m.start())]


def tokens(text: str) -> list[tuple[int, int, int, str]]:
    """Nodes: start, end (without marks around them), start of the word, the word before (past marks that stand alone)."""
    out, last = [], -1
    places = [m.start() for m in _NODE.finditer(text)]
    if values := assigned(text):
        places = sorted([*places, *(a for a, _ in values)])
    for at in places:
        if at < last:
            continue
        a, b = at, at
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        last = b
        word = text[a:b]
        s = a + len(word) - len(word.lstrip(_TRIM))
        e = b - (len(word) - len(word.rstrip(_TRIM)))
        if s < e:
            out.append((s, e, a, _before(text, a)))
    return out


def _before(text: str, a: int) -> str:
    """The word before a place; marks that stand alone, such as an equals sign, are passed."""
    while a > 0:
        while a > 0 and text[a - 1].isspace():
            a -= 1
        b = a
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        if word := text[a:b].strip(_TRIM):
            return word.lower()
        if b - a > 1:
            break
    return ""


def form(token: str) -> int:
    """One of FORMS: steps of length and of the share of digits, and flags of marks, case and hexadecimal digits."""
    n = sum(c.isdigit() for c in token)
    share = 0 if not n else 3 if n == len(token) else 1 if 2 * n < len(token) else 2
    flags = ("@" in token, "." in token, any(c in "+-(_" for c in token), token.lower() != token != token.upper(), all(c in "0123456789abcdefABCDEF" for c in token))
    return (bisect_right(_LENGTHS, len(token)) * 4 + share) * (1 << FLAGS) + sum(f << i for i, f in enumerate(flags))


def before_group(word: str) -> int:
    return _CUE.get(word, 4 + zlib.crc32(word.encode()) % (BEFORE - 4))


def features(kind: int, group: int) -> list[int]:
    """Numbers of the unary features of a form and a group: the form itself, its parts, the group, and a bias."""
    flags, rest = kind % (1 << FLAGS), kind >> FLAGS
    share, length = rest % 4, rest // 4
    base = FORMS
    out = [kind, base + share, base + 4 + length, base + 12 + group]
    return out + [base + 20 + i for i in range(FLAGS) if flags >> i & 1] + [base + 20 + FLAGS]


WEIGHTS = FORMS + 21 + FLAGS


def _keys(token: str) -> list[str]:
    """What similar tokens share: their letters and digits, and the first and last of these."""
    key = "".join(c for c in token.lower() if c.isalnum())
    if len(key) < 6:
        return []
    return [f"={key}"] if len(key) < EDGE + 2 else [f"={key}", f"^{key[:EDGE]}", f"${key[-EDGE:]}"]


def _inside(found: list[tuple], spans: list[Span]) -> list[bool]:
    """Whether a base span touches each candidate."""
    starts, ends, top = [s for s, _, _ in spans], [], 0
    for _, e, _ in spans:
        top = max(top, e)
        ends.append(top)
    out = []
    for s, e, *_ in found:
        k = bisect_right(starts, e - 1)
        out.append(k > 0 and ends[k - 1] > s)
    return out


def edges(text: str, found: list[tuple]) -> list[tuple[int, int, int]]:
    """Edges between nodes: of a CHAIN, with only space and marks between them; from each occurrence to the next that is EQUAL, or else SIMILAR. A pair has one skip edge at most."""
    out, last = [], {}
    for i, (s, e, a, _) in enumerate(found):
        if i and not text[found[i - 1][1] : a].strip(_TRIM + " \t\r\n"):
            out.append((i - 1, i, CHAIN))
        near = {}
        for key in _keys(text[s:e]):
            if key in last:
                near.setdefault(last[key], EQUAL if key[0] == "=" else SIMILAR)
            last[key] = i
        out += [(j, i, kind) for j, kind in sorted(near.items())]
    return out


def observed(text: str, found: list[tuple], spans: list[Span]) -> list[int]:
    """The label of each node that is known, else -1."""
    label = [ID if x else -1 for x in _inside(found, spans)]
    values = [(a, b, "") for a, b in assigned(text)]
    for i, x in enumerate(_inside(found, values)) if values else ():
        label[i] = SECRET if x and label[i] < 0 else label[i]
    return label


class Field:
    """Weights of unary features by label, and of agreement along chain and skip edges."""

    def __init__(self, unary: np.ndarray, couplings: np.ndarray):
        self.unary, self.couplings = unary, couplings
        self._cache: dict[tuple[int, int], np.ndarray] = {}

    def potential(self, kind: int, group: int) -> np.ndarray:
        if (kind, group) not in self._cache:
            self._cache[kind, group] = self.unary[features(kind, group)].sum(0)
        return self._cache[kind, group]

    def marginals(self, unary: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, LABELS) marginals by loopy belief propagation, and whether each node's messages settled.

        unary: log-potentials. links: (edges, 3) of node, node, kind. The nodes of a
        whole batch of documents are one graph, which has no edge between documents.
        """
        n = len(unary)
        if not len(links):
            return _normal(unary), np.ones(n, bool)
        src, dst = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
        gain = np.expm1(self.couplings[np.concatenate([links[:, 2]] * 2)])[:, None]
        back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
        sent, move = np.zeros((len(src), LABELS)), np.full(len(src), np.inf)
        for _ in range(ROUNDS):
            p = np.exp(_log_normal(unary[src] + self._into(sent, dst, n)[src] - sent[back]))
            new = np.log1p(gain * p)
            new -= new.max(1, keepdims=True)
            move = np.abs(new - sent).max(1)
            sent = 0.5 * (sent + new)  # damped
            if move.max() < SETTLED:
                break
        settled = np.ones(n, bool)
        settled[dst[move >= 10 * SETTLED]] = False
        return _normal(unary + self._into(sent, dst, n)), settled

    @staticmethod
    def _into(sent: np.ndarray, dst: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(dst, sent[:, y], n) for y in range(LABELS)], 1)


def _log_normal(x: np.ndarray) -> np.ndarray:
    top = x.max(1, keepdims=True)
    return x - top - np.log(np.exp(x - top).sum(1, keepdims=True))


def _normal(x: np.ndarray) -> np.ndarray:
    return np.exp(_log_normal(x)) if len(x) else x


def added(texts: list[str], spans: list[list[Span]], field: Field) -> list[list[Span]]:
    """The spans that the field adds to each text of a batch: nodes that no base span touches."""
    out: list[list[Span]] = [[] for _ in texts]
    unary, links, place, known = [], [], [], []
    for t, text in enumerate(texts):
        if found := tokens(text):
            start = len(place)
            label = observed(text, found, spans[t])
            for (s, e, _, before), y in zip(found, label, strict=True):
                unary.append(field.potential(form(text[s:e]), before_group(before)) if y < 0 else 30.0 * (np.arange(LABELS) == y))
                place.append((t, s, e))
            known += label
            links += [(i + start, j + start, kind) for i, j, kind in edges(text, found)]
    if not place:
        return out
    p, settled = field.marginals(np.array(unary, float), np.array(links, np.int64).reshape(-1, 3))
    for (t, s, e), y, x, ok in zip(place, known, p, settled, strict=True):
        if y == SECRET or (y < 0 and ok and max(x[ID], x[SECRET]) >= SURE):
            out[t].append((s, e, "secret" if y == SECRET or x[SECRET] > x[ID] else "id"))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


def _known(n: int, links: list[tuple[int, int, int]], label: list[int]) -> tuple[list[int], list[int]]:
    """Labels as training takes them (-1: not known), and for each node which labels its neighbours along each kind of edge have, as bits."""
    repeats, beside = set(), [0] * n
    for i, j, kind in links:
        if kind == EQUAL:
            repeats |= {i} if label[j] > 0 else set()
            repeats |= {j} if label[i] > 0 else set()
    known = [y if y >= 0 else -1 if i in repeats else OTHER for i, y in enumerate(label)]
    for i, j, kind in links:
        if known[j] >= 0:
            beside[i] |= 1 << (kind * LABELS + known[j])
        if known[i] >= 0:
            beside[j] |= 1 << (kind * LABELS + known[i])
    return known, beside


def _evidence(batches):
    """Counts of (form and group, neighbours' labels, label) over the nodes of texts whose label is known."""
    count: Counter = Counter()
    for batch in batches:
        for text in batch["text"].to_pylist():
            if text and (found := tokens(text)):
                known, beside = _known(len(found), edges(text, found), observed(text, found, base_spans(text)))
                count.update((form(text[s:e]) * BEFORE + before_group(before), x, y) for (s, e, _, before), x, y in zip(found, beside, known, strict=True) if y >= 0)
    columns = list(zip(*count, strict=True)) or [[]] * 3
    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns), pa.array(list(count.values()), pa.int64())], names=["what", "beside", "label", "n"])


def learn(what: np.ndarray, beside: np.ndarray, label: np.ndarray, n: np.ndarray, rounds: int = 400) -> Field:
    """Unary weights and couplings by pseudo-likelihood of counted nodes: of each node's label, given its neighbours' labels. AdaGrad with a weak prior."""
    unary, couplings = np.zeros((WEIGHTS, LABELS)), np.array(PRIOR)
    if not len(what) or not (label > 0).any():
        unary[-1] = (8.0, 0.0, 0.0)  # nothing is known of ids and secrets
        return Field(unary, couplings)
    lists = [features(int(w) // BEFORE, int(w) % BEFORE) for w in what]
    row, col = np.repeat(np.arange(len(what)), [len(x) for x in lists]), np.concatenate(lists)
    near = np.stack([np.stack([beside >> (kind * LABELS + y) & 1 for y in range(LABELS)], 1) for kind in range(3)])
    truth = np.eye(LABELS)[label]
    square, square2 = np.full(unary.shape, 1e-8), np.full(3, 1e-8)
    for _ in range(rounds):
        score = np.stack([np.bincount(row, unary[col, y], len(what)) for y in range(LABELS)], 1) + np.tensordot(couplings, near, 1)
        off = n[:, None] * (truth - _normal(score))
        grad = np.stack([np.bincount(col, off[row, y], WEIGHTS) for y in range(LABELS)], 1) - 0.5 * unary
        grad2 = (near * off).sum((1, 2)) - 0.5 * (couplings - PRIOR)
        square += grad * grad
        square2 += grad2 * grad2
        unary += 0.5 * grad / np.sqrt(square)
        couplings = np.clip(couplings + 0.5 * grad2 / np.sqrt(square2), 0.0, MOST_COUPLING)
    return Field(unary, couplings)


def find(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): counts and digest of base spans, all spans, and counts of those added."""
    counts = docs.select("text").mapInArrow(_evidence, "what int, beside int, label int, n long").groupBy("what", "beside", "label").agg(F.sum("n").alias("n"))
    table = counts.toPandas().sort_values(["what", "beside", "label"])  # of a fixed number of combinations
    field = docs.sparkSession.sparkContext.broadcast(learn(*(table[c].to_numpy() for c in table.columns)))

    def mark(batches):
        for batch in batches:
            for chunk in chunks([batch]):
                texts = [t or "" for t in chunk["text"].to_pylist()]
                spans = [base_spans(t) for t in texts]
                out = []
                for base, more in zip(spans, added(texts, spans, field.value), strict=True):
                    kinds = Counter(k for _, _, k in [*base, *more])
                    out.append((kinds["email"], kinds["ip"], kinds["card"], kinds["phone"], hashlib.sha256(joined(base).encode()).hexdigest(), joined([*base, *more]), kinds["id"], kinds["secret"], len(base) + len(more)))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 3
                columns = list(zip(*out, strict=True)) or [[]] * 9
                yield pa.RecordBatch.from_arrays([chunk["doc_id"].cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[x.split()[0] for x in RESULT.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(mark, RESULT)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
