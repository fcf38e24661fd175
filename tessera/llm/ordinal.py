"""Operator 6 - quality by ordinal cumulative-link regression on graded ratings.

A text is the mean of its tokens' hashed features (the word, and the shape of its
characters) and a few hashed bands of its length and repetition.  One weight vector w,
shared by all grades, gives f(x) = w . x; ordered thresholds t_0 < t_1 < ... turn it into grades,

    P(grade <= k) = 1 / (1 + exp(f(x) - t_k)),

so a text has an expected grade and a tail probability, that of being above the lowest grades,
by which it is selected.  With two grades this is logistic regression.

Fitting takes at most ``FIT_ROWS`` rated rows, evenly by grade, weighed to the shares of all rated rows; every text is scored whole where it is read.

Edge cases: null and empty texts have the band features only; an id rated twice has its
highest grade; null grades and ids are not learnt from, and a null id is never held out; with
nothing rated the grade is 0 for all, with one grade that grade; repeated rows get the same
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, chunks, hold_out
from .sampling import labelled_sample

MODULUS, FIT_ROWS, BUCKETS, STEPS, SELECT = 4, 4500, 1 << 17, 100, 0.5
#: The tail begins above so many grades.
TAIL = 1
CACHE_TOKENS = 200_000
#: Weight of a band feature, beside the tokens' mean of 1 each.
BAND = 0.5

_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b
               for b in range(256))
_RUN = re.compile(rb"(.)\1+")


def _bucket(kind: bytes, token: bytes) -> int:
    return zlib.crc32(kind + token) % BUCKETS


class _Tokens(dict):
    """Word and shape bucket of each token, found once."""

    def __missing__(self, token: bytes) -> int:
        shape = _RUN.sub(rb"\1", token.translate(_SHAPE))
        self[token] = out = _bucket(b"w", token.translate(LOWER)) * BUCKETS + _bucket(b"s", shape)
        return out


def _bands(words: list[bytes]) -> list[int]:
    """Buckets of the length's magnitude, the share of different words and the mean word length."""
    n = len(words)
    different = 10 * len(set(words)) // n if n else -1
    letters = min(sum(map(len, words)) // n, 20) if n else -1
    return [_bucket(b"n", b"%d" % n.bit_length()), _bucket(b"d", b"%d" % different), _bucket(b"l", b"%d" % letters)]


def featurise(texts: list[bytes], tokens: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: bucket, value, and where each row begins."""
    if len(tokens) > CACHE_TOKENS:
        tokens.clear()
    buckets, values, size = [], [], []
    for text in texts:
        words = text.split()
        both = np.fromiter(map(tokens.__getitem__, words), dtype=np.int64, count=len(words))
        own = np.concatenate((both // BUCKETS, both % BUCKETS))
        bands = _bands(words)
        buckets += [own, np.array(bands, dtype=np.int64)]
        values += [np.full(len(own), 1.0 / max(len(words), 1)), np.full(len(bands), BAND)]
        size.append(len(own) + len(bands))
    return np.concatenate(buckets), np.concatenate(values), np.concatenate(([0], np.cumsum(size)))


def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, begins[:-1]) if len(begins) > 1 else np.zeros(0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Grades in order, shared weights and ordered thresholds."""

    def __init__(self, grades: list[int], weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    def tails(self, texts: list[bytes], tokens: _Tokens) -> np.ndarray:
        """P(grade > k) for each text and threshold."""
        bucket, value, begins = featurise(texts, tokens)
        return _sigmoid(_sums(self.weights[bucket] * value, begins)[:, None] - self.thresholds)


def fit(sample: list[tuple[int, str]], steps: int = STEPS, ridge: float = 1e-5, stands: dict | None = None) -> Model:
    """Fit to (grade, text) pairs by full-batch Adam on the log-likelihood.

    ``stands``: how many rated rows each sampled one of a grade stands for; it weighs as much.
    """
    grades = sorted({g for g, _ in sample}) or [0]
    weights, gaps = np.zeros(BUCKETS), np.zeros(len(grades) - 1)
    if len(grades) < 2:
        return Model(grades, weights, np.zeros(0))
    bucket, value, begins = featurise([t.encode() for _, t in sample], _Tokens())
    used, place = np.unique(bucket, return_inverse=True)
    row = np.repeat(np.arange(len(sample)), np.diff(begins))
    y = np.array([grades.index(g) for g, _ in sample])
    weigh = np.array([stands[g] if stands else 1.0 for g in grades])[y]
    weigh *= len(y) / weigh.sum()
    share = np.cumsum(np.bincount(y, weights=weigh, minlength=len(grades)))[:-1] / len(y)
    start = np.log(share / (1 - share))
    gaps[0], gaps[1:] = start[0], np.log(np.maximum(np.diff(start), 1e-2))
    w = np.zeros(len(used))

    def ordered(g):
        return np.cumsum(np.concatenate((g[:1], np.exp(g[1:]))))

    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(gaps), np.zeros_like(gaps)]
    for step in range(1, steps + 1):
        f, t = _sums(w[place] * value, begins), ordered(gaps)
        below = np.hstack((np.zeros((len(y), 1)), _sigmoid(t - f[:, None]), np.ones((len(y), 1))))
        hi, lo = below[np.arange(len(y)), y + 1], below[np.arange(len(y)), y]
        p = np.maximum(hi - lo, 1e-9)
        slope_hi, slope_lo = weigh * hi * (1 - hi) / p, weigh * lo * (1 - lo) / p
        of_f = (slope_hi - slope_lo) / len(y)  # of the negative log-likelihood
        of_t = np.zeros(len(t))
        np.add.at(of_t, y[y < len(t)], -slope_hi[y < len(t)] / len(y))
        np.add.at(of_t, y[y > 0] - 1, slope_lo[y > 0] / len(y))
        of_gap = np.cumsum(of_t[::-1])[::-1] * np.concatenate(([1.0], np.exp(gaps[1:])))
        of_w = np.bincount(place, weights=of_f[row] * value, minlength=len(used)) + ridge * w
        for x, g, m, rate in ((w, of_w, moments[:2], 0.5), (gaps, of_gap, moments[2:], 0.05)):
            m[0][:] = 0.9 * m[0] + 0.1 * g
            m[1][:] = 0.99 * m[1] + 0.01 * g * g
            x -= rate * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-8)
    weights[used] = w
    return Model(grades, weights, ordered(gaps))


def _scorer(sent, select: float, tail_above: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tokens = sent.value, _Tokens()
        step = np.diff(np.array(model.grades, dtype=np.float64))
        for piece, texts in chunks(batches):
            over = model.tails(texts, tokens)
            tail = over[:, min(tail_above, len(step)) - 1] if len(step) else np.ones(len(texts))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(model.grades[0] + over @ step),
                 pa.array(tail), pa.array(tail >= select)],
                ["doc_id", "held_out", "expected_grade", "tail_probability", "selected"])
    return run


def grade(docs: DataFrame, ratings: DataFrame, modulus: int = MODULUS, fit_rows: int = FIT_ROWS,
          select: float = SELECT, tail_above: int = TAIL) -> DataFrame:
    """(doc_id, held_out, expected_grade, tail_probability, selected) per row; ``ratings`` has doc_id and grade.

    ``tail_probability`` is that of a grade above the ``tail_above`` lowest.
    """
    known = ratings.where(~hold_out(F.col("doc_id"), modulus)).select(
        "doc_id", F.col("grade").cast("int").alias("label"))
    sample, stands = labelled_sample(docs, known, fit_rows)
    model = docs.sparkSession.sparkContext.broadcast(fit([(label, text) for _, label, text in sample], stands=stands))
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       hold_out(F.col("doc_id"), modulus).alias("held_out"))
    return thin.mapInArrow(_scorer(model, select, tail_above), "doc_id long, held_out boolean, expected_grade double, "
                                                   "tail_probability double, selected boolean")
