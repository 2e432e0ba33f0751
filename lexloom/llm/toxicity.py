"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported speech, other).
Three small transducers rewrite the symbols of a clause: one marks matches in
the scope of a negation, one those near a target, one those in reported speech.
Their composition is a single machine that reads a clause once in each direction
and writes a pattern for each match, such as "insult, targeted" or "threat,
negated". A document's score is a logistic function of the weights of its matched
clauses by pattern. Insults (whole words and word stems) and the patterns'
weights are learned from labelled rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lexloom.llm.common import crc_fold, fitted, given_back, labelled_sample, others, spread, table
from lexloom.llm.textkernel import Words, blocks, texts_of, xxh64

#: The most labelled rows of each class that lexicon and weights are learned from.
SAMPLE = {0: 3000, 1: 2000}
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Word lists of the grammar (English, German, French, Spanish).
LISTS = {
    THREAT: "kill hurt destroy beat punish shoot stab töten umbringen verprügeln tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours he she they him her them dich dir du ihr euch sie toi tu vous ton ta vos tú usted ustedes ti vosotros",
    NEGATION: "not no never isn't don't nicht kein keine nie pas jamais aucun ni nunca jamás ningún",
    REPORT: "said says say claims claimed called calls wrote reported quote sagte sagt schrieb behauptet dit disait écrit dijo dice escribió",
}
STEMS = (4, 5, 6, 7)
#: What ends a clause, and what ends a word: ASCII other than letters, digits and the apostrophe.
CLAUSE = np.zeros(256, bool)
CLAUSE[[ord(c) for c in ".,;:!?()\n\"|"]] = True
CODES = np.arange(256)
ALNUM = (((CODES | 32) >= 97) & ((CODES | 32) <= 122)) | ((CODES >= 48) & (CODES <= 57)) | (CODES >= 128) | (CODES == 39)
LETTERS = np.where(ALNUM, CODES, 32).astype(np.uint8)


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine: step(state, symbol, mark) gives the next state and mark; a mark is a set of bits that pass on."""

    states: int
    step: dict[tuple[int, int], tuple[int, int]] = field(hash=False)


def scope(opens: int, width: int, bit: int, closes: frozenset[int] = frozenset()) -> Transducer:
    """Return a machine that sets ``bit`` on a match at most ``width`` words after the symbol ``opens``."""
    step = {}
    for state in range(width + 1):
        for symbol in range(6):
            following = width if symbol == opens else 0 if symbol in closes else max(0, state - 1)
            step[state, symbol] = (following, bit if state and symbol in (INSULT, THREAT) else 0)
    return Transducer(width + 1, step)


def latch(opens: int, bit: int) -> Transducer:
    """Return a machine that sets ``bit`` on every match after the symbol ``opens``, to the end of the clause."""
    step = {(s, symbol): (int(s or symbol == opens), bit if s and symbol in (INSULT, THREAT) else 0) for s in (0, 1) for symbol in range(6)}
    return Transducer(2, step)


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Return the machine that runs ``a`` and ``b`` at once and joins their marks."""
    step = {}
    for i in range(a.states):
        for j in range(b.states):
            for symbol in range(6):
                (x, m), (y, n) = a.step[i, symbol], b.step[j, symbol]
                step[i * b.states + j, symbol] = (x * b.states + y, m | n)
    return Transducer(a.states * b.states, step)


NEGATED, AIMED, REPORTED = 1, 2, 4
FORWARD = functools.reduce(compose, [scope(NEGATION, 3, NEGATED), scope(TARGET, 4, AIMED), latch(REPORT, REPORTED)])
BACKWARD = scope(TARGET, 4, AIMED)
PATTERNS = 16  # insult or threat, with three marks
#: The parts that a pattern's weight is the sum of: insult or threat, and each mark on it.
PARTS = np.array([[float(t == u) for u in (0, 1)] + [float(t == u and bool(m & bit)) for u in (0, 1) for bit in (NEGATED, AIMED, REPORTED)] for t in (0, 1) for m in range(8)])
#: The parts' weights before any label is seen.
PRIOR = np.array([2.0, 2.5, -1.0, 0.5, -1.0, -1.0, 0.5, -1.0])


def run_clause(symbols: list[int], gaps: list[int]) -> list[int]:
    """Return the pattern of each symbol of a clause (-1: no match); gaps are the other words before each symbol."""
    marks = []
    state = 0
    for symbol, gap in zip(symbols, gaps, strict=True):
        for _ in range(min(gap, 5)):
            state = FORWARD.step[state, OTHER][0]
        state, mark = FORWARD.step[state, symbol]
        marks.append(mark)
    state = 0
    for k in range(len(symbols) - 1, -1, -1):
        state, mark = BACKWARD.step[state, symbols[k]]
        marks[k] |= mark
        for _ in range(min(gaps[k], 5)):
            state = BACKWARD.step[state, OTHER][0]
    return [(8 * (s == THREAT) + m) if s in (INSULT, THREAT) else -1 for s, m in zip(symbols, marks, strict=True)]


class Tokens(Words):
    """Lower-cased words of letters and digits with the clause that each stands in."""

    def __init__(self, texts: list[bytes]) -> None:
        super().__init__([x.translate(bytes(LETTERS)) for x in texts])
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        solid = ALNUM[raw]
        ends = np.flatnonzero(solid[:-1] & ~solid[1:])
        self.clause = np.cumsum(CLAUSE[raw])[ends]

    def keys(self) -> np.ndarray:
        return xxh64(self.buf, self.start, self.end, 1)

    def stem(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Return the first ``size`` bytes of each word as a number, and whether the word is longer."""
        wide = np.ndarray((len(self.buf) - 7,), "<u8", self.buf, strides=(1,))
        return wide[self.start] & np.uint64((1 << 8 * size) - 1), self.end - self.start > size


class Lookup:
    """A sorted table of keys and values, with a bit table that rules most keys out."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.bits = np.zeros(1 << 16, bool)
        self.bits[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys * np.uint64(11400714785074694791)) >> np.uint64(48)

    def find(self, keys: np.ndarray, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Return the places in ``keys`` that are listed (and allowed by ``which``) and their values."""
        if not len(self.keys):
            return np.zeros(0, np.int64), self.values[:0]
        maybe = self.bits[self._slot(keys)]
        at = np.flatnonzero(maybe if which is None else maybe & which)
        slot = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        hit = self.keys[slot] == keys[at]
        return at[hit], self.values[slot[hit]]


def _listed() -> Lookup:
    pairs = [(w, kind) for kind, words in LISTS.items() for w in words.split()]
    t = Tokens([w.encode() for w, _ in pairs])
    return Lookup(t.keys(), np.array([k for _, k in pairs]))


@dataclass
class Grammar:
    """Learned insults (words by hash, stems by size) with weights, and the patterns' weights."""

    words: Lookup
    stems: dict[int, Lookup]
    listed: Lookup
    bias: float = -3.0
    weights: np.ndarray = field(default_factory=lambda: PARTS @ PRIOR)

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """Return, per text and pattern, log(1 + the summed weights of its matches)."""
        out = np.zeros((len(texts), PATTERNS))
        for lo, hi in blocks(texts):
            t = Tokens(texts[lo:hi])
            if not len(t):
                continue
            weight = np.zeros(len(t))
            keys = t.keys()
            at, value = self.words.find(keys)
            weight[at] = value
            for size, lookup in self.stems.items():
                at, value = lookup.find(*t.stem(size))
                np.maximum.at(weight, at, value)
            symbol = np.zeros(len(t), np.int64)
            at, value = self.listed.find(keys)
            symbol[at] = value
            symbol[weight > 0] = INSULT
            weight[symbol == THREAT] = 1.0
            clause, owner = t.clause, t.owner
            group = np.cumsum(np.concatenate([[1], (np.diff(clause) != 0) | (np.diff(owner) != 0)]))
            wanted = np.isin(group, group[(symbol == INSULT) | (symbol == THREAT)])
            at = np.flatnonzero(wanted & (symbol > 0))
            begin = np.flatnonzero(np.concatenate([[True], np.diff(group) > 0]))[group - 1]
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(group[at])) + 1, [len(at)]])
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if a == b:
                    continue
                here = at[a:b]
                gaps = np.diff(np.concatenate([[begin[here[0]] - 1], here])) - 1
                for place, pattern in zip(here, run_clause(symbol[here].tolist(), gaps.tolist()), strict=True):
                    if pattern >= 0:
                        out[lo + owner[place], pattern] += weight[place]
        return np.log1p(out)

    def score(self, texts: list[bytes]) -> np.ndarray:
        z = self.bias + self.matches(texts) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn_insults(texts: list[bytes], y: np.ndarray, support: int | None = None, purity: float = 0.985, mixed: float = 0.5) -> tuple[Lookup, dict[int, Lookup]]:
    """Learn which words and stems mark label 1.

    One is taken if at least ``support`` texts of label 1 hold it (a twentieth of
    them, 4 to 10, if none is given), if these are a
    share of ``purity`` of what holds it, and if it follows different words in at
    least ``mixed`` as many cases as texts (so that copies of one text do not
    teach their own words). Its weight is the smoothed log-odds, over 4.
    """
    pos, neg = max(int(y.sum()), 1), max(int((1 - y).sum()), 1)
    support = support or int(np.clip(pos / 20, 4, 10))
    hot: dict[int, list[np.ndarray]] = {size: [] for size in (0, *STEMS)}
    bad = np.flatnonzero(y == 1)
    for lo, hi in blocks([texts[k] for k in bad]):
        t = Tokens([texts[k] for k in bad[lo:hi]])
        for size, found in hot.items():
            key, longer = (t.keys(), slice(None)) if size == 0 else t.stem(size)
            found.append(np.unique(np.stack([key[longer], t.owner[longer].astype(np.uint64)], 1), axis=0)[:, 0])
    frequent = {}
    for size, found in hot.items():
        names, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        frequent[size] = names[counts >= support]
    rows: dict[int, list[np.ndarray]] = {size: [np.zeros((0, 3), np.uint64)] for size in frequent}
    for lo, hi in blocks(texts):  # only what is frequent is kept, so memory stays small
        t = Tokens(texts[lo:hi])
        keys = t.keys()
        before = np.concatenate([[0], keys[:-1]]).astype(np.uint64)
        owner = (t.owner + lo).astype(np.uint64)
        for size, names in frequent.items():
            key, longer = (keys, True) if size == 0 else t.stem(size)
            which = np.isin(key, names) & longer
            rows[size].append(np.stack([key[which], owner[which], before[which]], 1))
    out = {}
    for size, names in frequent.items():
        part = np.concatenate(rows.pop(size))
        pairs = np.unique(part[:, :2], axis=0)
        slot = np.searchsorted(names, pairs[:, 0])
        label = y[pairs[:, 1].astype(np.int64)]
        p, n = np.bincount(slot, label, len(names)), np.bincount(slot, 1 - label, len(names))
        part = part[y[part[:, 1].astype(np.int64)] == 1]
        kinds = np.bincount(np.searchsorted(names, np.unique(part[:, [0, 2]], axis=0)[:, 0]), minlength=len(names))
        good = (p >= purity * (p + n * pos / neg)) & (p >= purity * (p + n)) & (kinds >= mixed * p)
        odds = np.log((p + 0.5) / (pos + 1)) - np.log((n + 0.5) / (neg + 1))
        out[size] = Lookup(names[good], np.clip(odds[good] / 4, 0.25, 2.5))
    return out.pop(0), out


def fit(sample: list[tuple[str, int]], steps: int = 300) -> Grammar:
    """Learn the insults, then the patterns' weights by logistic regression that is drawn to ``PRIOR``."""
    texts = [t.encode("utf-8", "surrogatepass") for t, _ in sample]
    y = np.array([v for _, v in sample], float)
    grammar = Grammar(*learn_insults(texts, y), _listed())
    if not texts:
        return grammar
    x = np.concatenate([grammar.matches(texts) @ PARTS, np.ones((len(texts), 1))], 1)
    start = np.append(PRIOR, -3.0)
    theta, pull = start.copy(), np.append(np.full(len(PRIOR), 0.1), 0.01)
    for _ in range(steps):  # Newton's method, damped
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (p - y) + pull * (theta - start)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        move = np.linalg.solve(curve, slope)
        theta -= np.clip(move, -1, 1)
        if abs(move).max() < 1e-6:
            break
    grammar.weights, grammar.bias = PARTS @ theta[:-1], float(theta[-1])
    return grammar


def score_toxicity(docs: DataFrame, grammar: Grammar, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Return ``docs`` with ``score_col`` (0 to 1, higher: more toxic) of its whole texts.

    Null texts count as empty and score as texts without a match; a column that
    has the name ``score_col`` already is replaced.
    """
    row, names = others(docs, [score_col], [text_col])
    slim = docs.select(row, F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(grammar)  # bounded by the sample that taught it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(texts_of(batch.column(1))))], ["row", "text", "score"])

    scored = spread(slim).mapInArrow(run, StructType([*slim.schema.fields, StructField("score", DoubleType())]))
    return scored.select(*given_back(names, {text_col: F.col("text")}), F.col("score").alias(score_col))


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: dict[int, int] = SAMPLE) -> Grammar:
    """Fit on a bounded sample (``most`` rows of each class) of the rows whose crc32(doc_id) mod 3 is not 1."""
    return fitted(labelled_sample(docs, labels, "toxic", crc_fold("doc_id", 3) != 1, most), fit)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score, fold and class of every document."""
    docs = table(spark, sf_dir, "documents")
    grammar = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    slim = docs.select("doc_id", F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "text")
    return score_toxicity(slim, grammar).select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
