"""Operator 10 - toxicity by a weighted finite-state pattern grammar.

Tokens fall into classes: insult, threat, target, negation, reported speech, clause break
and other.  Insults are learnt from labelled rows: words, and stems with several endings,
that stand in toxic texts far more often than chance allows, each with a weight.  The
other classes are short fixed lists in the four languages.

Five weighted transducers read the classes of a clause.  Each keeps a small state (was
there a negation just before? a reporting verb? a target?) and multiplies what an insult or threat
weighs.  They are composed into one table: state and class give the next state and a factor.
Clauses are scored by that table; only clauses with an insult or a threat can match.

A text's matched clauses give a few numbers, and a logistic regression on these gives its
score.  Fitting takes at most ``FIT_ROWS`` labelled rows, evenly by label, and then sets the odds to those of all labelled rows; insults are learnt on one half to
make the numbers of the other, so the regression sees weights as unseen texts do.

Edge cases: null and empty texts match nothing and get the score of no match; an id that
is labelled twice is toxic if any label is; null labels and ids are not learnt from, and a null
id is never held out; with no toxic or no other row learnt the share of toxic rows is the
score; repeated rows get the same result; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, hold_out
from .sampling import labelled_sample

MODULUS, FIT_ROWS, CUT = 4, 6000, 0.3
#: Least letters of a stem, most letters, least endings of a stem, words kept per task.
STEM_LEAST, STEM_MOST, STEM_ENDINGS, CACHE_WORDS = 4, 8, 4, 200_000

OTHER, BREAK, INSULT, THREAT, TARGET, NEGATION, REPORT = range(7)

# Fixed word lists, by language.
THREATS = {"kill", "hurt", "destroy", "beat", "shoot", "stab", "burn",
           "tuer", "frapper", "mourir", "töten", "sterben", "schlagen", "matar", "morir", "golpear"}
TARGETS = {"you", "your", "yours", "they", "them", "he", "she", "tu", "toi", "vous", "votre", "ils", "du", "dich",
           "dein", "ihr", "euch", "tú", "usted", "ustedes", "ellos"}
NEGATIONS = {"not", "never", "nobody", "isn", "aren", "ne", "pas", "jamais", "nicht", "kein", "keine", "nie", "no", "nunca"}
REPORTS = {"said", "says", "wrote", "called", "quoted", "quote", "reported", "dit", "écrit", "appelé", "sagte",
           "schrieb", "nannte", "dijo", "escribió", "llamó"}

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n|]+")


class Transducer:
    """States, and for each state and class the next state and the factor put on a match there."""

    def __init__(self, moves: dict[tuple[int, int], tuple[int, float]], states: int):
        self.states = states
        self.next = np.zeros((states, 7), dtype=np.int64)
        self.factor = np.ones((states, 7))
        for s in range(states):
            for c in range(7):
                self.next[s, c], self.factor[s, c] = moves.get((s, c), (0 if c == BREAK else s, 1.0))

    def compose(self, other: Transducer) -> Transducer:
        """Both read the same classes; factors multiply."""
        out = Transducer({}, self.states * other.states)
        for s in range(out.states):
            a, b = divmod(s, other.states)
            out.next[s] = self.next[a] * other.states + other.next[b]
            out.factor[s] = self.factor[a] * other.factor[b]
        return out


def grammar() -> Transducer:
    """Insult, threat, target, negation and reported speech, composed."""
    # a second insult in one clause weighs more than a lone one
    insult = Transducer({(0, INSULT): (1, 1.0), (1, INSULT): (1, 1.25)}, 2)
    # a threat counts fully once somebody is named, else little
    threat = Transducer({(0, TARGET): (1, 1.0), (0, THREAT): (0, 0.1), (1, THREAT): (1, 1.0)}, 2)
    # a target earlier in the clause strengthens an insult
    target = Transducer({(0, TARGET): (1, 1.0), (1, INSULT): (1, 1.2)}, 2)
    # a negation weakens what follows within two tokens
    negation = Transducer({(0, NEGATION): (2, 1.0), (1, NEGATION): (2, 1.0), (2, NEGATION): (2, 1.0),
                           **{(s, c): (s - 1, 0.5 if c in (INSULT, THREAT) else 1.0)
                              for s in (1, 2) for c in (OTHER, INSULT, THREAT, TARGET, REPORT)}}, 3)
    # within a clause, after a reporting verb, words are somebody else's
    report = Transducer({(0, REPORT): (1, 1.0), (1, INSULT): (1, 0.6), (1, THREAT): (1, 0.5)}, 2)
    out = insult
    for part in (threat, target, negation, report):
        out = out.compose(part)
    return out


class Lexicon:
    """Weights of insult words and stems."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems

    def weight(self, word: str) -> float:
        best = self.words.get(word, 0.0)
        for k in range(STEM_LEAST, min(len(word) - 1, STEM_MOST) + 1):
            best = max(best, self.stems.get(word[:k], 0.0))
        return best


def _surprise(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
    """Log-likelihood ratio that a of n_a toxic and b of n_b other texts hold a word, if chance were all."""
    seen, n = a + b, n_a + n_b

    def part(o, e):
        return np.where(o > 0, o * np.log(np.maximum(o, 1e-12) / np.maximum(e, 1e-12)), 0.0)

    return 2 * (part(a, seen * n_a / n) + part(b, seen * n_b / n)
                + part(n_a - a, (n - seen) * n_a / n) + part(n_b - b, (n - seen) * n_b / n))


def _unlike(texts: list[set[str]], bands: int = 4, width: int = 3) -> list[int]:
    """Texts that share no band of least word hashes with an earlier one: of near copies, mostly the first."""
    seen, out = set(), []
    for k, words in enumerate(texts):
        if not words:
            continue
        h = np.array([zlib.crc32(w.encode()) for w in words], dtype=np.uint64)
        least = [int((h * np.uint64(2 * i + 0x9E3779B97F4A7C15) >> np.uint64(20)).min()) for i in range(bands * width)]
        own = {(b, *least[b * width:(b + 1) * width]) for b in range(bands)}
        if not own & seen:
            out.append(k)
        seen |= own
    return out


def learn_lexicon(texts: list[set[str]], toxic: list[bool]) -> Lexicon:
    """Words and stems of toxic texts beyond chance (after Bonferroni) and at least ten times as frequent there.

    Near copies count as one text: their words would pass for frequent.
    """
    unlike = _unlike(texts)
    texts, toxic = [texts[k] for k in unlike], [toxic[k] for k in unlike]
    n_a = sum(toxic)
    n_b = len(toxic) - n_a
    in_a, in_b, stem_a, stem_b = Counter(), Counter(), Counter(), Counter()
    endings: dict[str, set[str]] = {}
    for words, bad in zip(texts, toxic, strict=True):
        (in_a if bad else in_b).update(words)
        stems = set()
        for w in words:
            for k in range(STEM_LEAST, min(len(w) - 1, STEM_MOST) + 1):
                stems.add(w[:k])
                if bad and len(endings.setdefault(w[:k], set())) < STEM_ENDINGS:
                    endings[w[:k]].add(w)
        (stem_a if bad else stem_b).update(stems)

    leading: dict[str, int] = {}  # of a stem, the texts of its most frequent word
    for w, c in in_a.items():
        for k in range(STEM_LEAST, min(len(w) - 1, STEM_MOST) + 1):
            leading[w[:k]] = max(leading.get(w[:k], 0), c)

    def pick(a: Counter, b: Counter, allowed) -> dict[str, float]:
        names = [w for w, c in a.items() if c >= 4 and allowed(w)]
        if not names or not n_b:
            return {}
        x, y = (np.array([c[w] for w in names], dtype=np.float64) for c in (a, b))
        lift = ((x + 0.5) / (n_a + 1)) / ((y + 0.5) / (n_b + 1))
        keep = (_surprise(x, y, n_a, n_b) > 2 * math.log(20 * len(a))) & (lift >= 10)
        return {names[k]: float(np.log(lift[k])) for k in np.flatnonzero(keep)}

    return Lexicon(pick(in_a, in_b, lambda w: len(w) > 1),
                   pick(stem_a, stem_b, lambda w: len(endings[w]) >= STEM_ENDINGS and stem_a[w] >= 1.5 * leading[w]))


class _Classes(dict):
    """Class of each token, found once."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str) -> int:
        if not token[0].isalpha():
            kind = BREAK
        elif self.lexicon.weight(token) > 0:
            kind = INSULT
        else:
            kind = (THREAT if token in THREATS else TARGET if token in TARGETS else NEGATION if token in NEGATIONS
                    else REPORT if token in REPORTS else OTHER)
        self[token] = kind
        return kind


#: Weight of a threat, beside the learnt weights of insults.
THREAT_WEIGHT = 3.0
N_FEATURES = 6


class Matcher:
    """Scores the clauses of texts."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.table, self.classes = lexicon, grammar(), _Classes(lexicon)

    def numbers(self, text: str) -> list[float]:
        """Of the matched clauses: sum, greatest, count, sum per clause, sum per root of the words, different words."""
        tokens = _TOKEN.findall(text.lower())
        if len(self.classes) > CACHE_WORDS:
            self.classes.clear()
        kinds = np.fromiter(map(self.classes.__getitem__, tokens), dtype=np.int8, count=len(tokens))
        hits = np.flatnonzero((kinds == INSULT) | (kinds == THREAT))
        if not len(hits):
            return [0.0] * N_FEATURES
        breaks = np.flatnonzero(kinds == BREAK)
        clause = np.searchsorted(breaks, hits)
        total, most, different = 0.0, 0.0, set()
        step, factor = self.table.next, self.table.factor
        matched = np.unique(clause)
        for c in matched.tolist():
            begin = int(breaks[c - 1]) + 1 if c else 0
            end = int(breaks[c]) if c < len(breaks) else len(tokens)
            state, score = 0, 0.0
            for at in range(begin, end):
                kind = kinds[at]
                if kind == INSULT:
                    score += self.lexicon.weight(tokens[at]) * factor[state, kind]
                    different.add(tokens[at])
                elif kind == THREAT:
                    score += THREAT_WEIGHT * factor[state, kind]
                state = step[state, kind]
            total, most = total + score, max(most, score)
        n = len(breaks) + 1
        return [math.log1p(total), most, math.log1p(len(matched)), total / n, total / math.sqrt(len(tokens)),
                math.log1p(len(different))]


class Model:
    def __init__(self, lexicon: Lexicon, mean, scale, weights, base: float):
        self.lexicon, self.mean, self.scale, self.weights, self.base = lexicon, mean, scale, weights, base

    def score(self, numbers: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(numbers), self.base)
        x = np.hstack((np.ones((len(numbers), 1)), (numbers - self.mean) / self.scale))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is the constant."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(sample: list[tuple[int, str]], stands: dict | None = None) -> Model:
    """Fit to (label 0 or 1, text) pairs; the sample keeps both labels in any proportion.

    ``stands``: how many labelled rows each sampled one of a label stands for.  The odds are those of all of them.
    """
    toxic = [bool(y) for y, _ in sample]
    base = float(np.mean(toxic)) if toxic else 0.0
    words = [set(w for w in _TOKEN.findall(t.lower()) if w[0].isalpha()) for _, t in sample]
    lexicon = learn_lexicon(words, toxic)
    if not any(toxic) or all(toxic):
        return Model(lexicon, None, None, None, base)
    numbers = np.zeros((len(sample), N_FEATURES))
    for half in (0, 1):  # the sample is in order of ids, so halves are alike
        own = [k for k in range(len(sample)) if k % 2 != half]
        matcher = Matcher(learn_lexicon([words[k] for k in own], [toxic[k] for k in own]))
        for k in range(half, len(sample), 2):
            numbers[k] = matcher.numbers(sample[k][1])
    mean, scale = numbers.mean(axis=0), np.maximum(numbers.std(axis=0), 1e-6)
    x = np.hstack((np.ones((len(sample), 1)), (numbers - mean) / scale))
    weights = _logistic(x, np.array(toxic, dtype=np.float64))
    if stands:
        rows, bad = np.array([stands[y] for y, _ in sample]), np.array(toxic)
        weights[0] += math.log(rows[bad].mean() / rows[~bad].mean())
    return Model(lexicon, mean, scale, weights, base)


def _scorer(sent, cut: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value.lexicon)
        for piece, texts in chunks(batches):
            numbers = np.array([matcher.numbers(t.decode("utf-8", "replace")) for t in texts])
            score = sent.value.score(numbers.reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(score),
                                              pa.array((score >= cut).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, labels: DataFrame, modulus: int = MODULUS, fit_rows: int = FIT_ROWS, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; ``labels`` has doc_id and toxic."""
    known = labels.where(~hold_out(F.col("doc_id"), modulus)).select(
        "doc_id", F.col("toxic").cast("int").alias("label"))
    sample, stands = labelled_sample(docs, known, fit_rows)
    model = docs.sparkSession.sparkContext.broadcast(fit([(label, text) for _, label, text in sample], stands))
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       hold_out(F.col("doc_id"), modulus).alias("held_out"))
    return thin.mapInArrow(_scorer(model, cut), "doc_id long, held_out boolean, score double, predicted int")
