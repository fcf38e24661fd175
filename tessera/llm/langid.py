"""Operator 3 - language by a linear-chain conditional random field over words.

The labels are the learnt languages.  A word's features are its prefixes and suffixes, its
character trigrams and, if common enough, the word itself (the lexicon).  Features weigh
each label, learnt transitions weigh pairs of neighbouring labels, and forward-backward
gives every word's label probabilities; a text's language is the one with most of them,
its score their mean.  Training sequences splice passages of several documents, so the
transitions are learnt from switches as well as from runs.

Fitting takes at most ``FIT_ROWS`` labelled rows; every text is then labelled whole, where
it is read, without a shuffle.

Edge cases: ``und`` with score 0 for a null or empty text or one without a letter; a language
that is null is not learnt from; with nothing learnt every text is ``und``; repeated rows get
the same result; a null id is never held out; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, hold_out
from .sampling import labelled_sample

MODULUS, FIT_ROWS = 4, 480
#: Least uses of a feature, steps of fitting, words of a training sequence, words per block, words kept per task.
LEAST_USES, STEPS, SEQUENCE, BLOCK, CACHE_WORDS = 3, 40, 48, 256, 150_000
#: Letters of the words kept per task.
CACHE_LETTERS = 8 << 20
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Words of letters, in lower case; none if the text has no letter."""
    words = _WORD.findall(text.lower())
    return words if any(c.isalpha() for w in words for c in w) else []


def features(word: str) -> list[str]:
    """Affixes, trigrams and the word itself, however long it is."""
    marked = f"<{word}>"
    out = [f"={word}", marked[:2], marked[:4], marked[-2:], marked[-4:]]
    out += [marked[i:i + 3] for i in range(len(marked) - 2)]
    return out


class Weights:
    """Label weights of words from their features."""

    def __init__(self, index: dict[str, int], table: np.ndarray):
        self.index, self.table = index, table

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of all words in one array, and where each word's begin."""
        found = [features(w) for w in words]
        begins = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int64)
        numbers = np.fromiter(map(self.index.get, chain.from_iterable(found), repeat(-1)), dtype=np.int64,
                              count=begins[-1])
        known = numbers >= 0
        return numbers[known], np.concatenate(([0], np.cumsum(known)))[begins]

    def of(self, words: list[str]) -> np.ndarray:
        numbers, begins = self.rows(words)
        return _row_sums(self.table[numbers], begins)


def _row_sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros((1, values.shape[1])), np.cumsum(values, axis=0)))
    return total[begins[1:]] - total[begins[:-1]]


def _unit(x: np.ndarray, axes=-1) -> np.ndarray:
    return x / x.sum(axis=axes, keepdims=True)


def marginals(weights: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Label probabilities of every word of all sequences, which stand one after another in ``weights``.

    Sequences are cut into blocks whose transfer matrices are made side by side, so the number
    of steps is that of a block plus the blocks of the longest sequence, not its words.
    """
    labels = weights.shape[1]
    emit = np.exp(weights - weights.max(axis=1, keepdims=True))
    step = np.exp(transition - transition.max())
    per_seq = -(-lengths // BLOCK)
    seq = np.repeat(np.arange(len(lengths)), per_seq)
    nth = np.arange(len(seq)) - np.repeat(np.cumsum(per_seq) - per_seq, per_seq)
    begin = np.repeat(np.cumsum(lengths) - lengths, per_seq) + nth * BLOCK
    size = np.minimum(lengths[seq] - nth * BLOCK, BLOCK)
    order = np.argsort(-size, kind="stable")
    longest = int(size.max(initial=0))
    live = [int(np.searchsorted(-size[order], -s, side="left")) for s in range(longest)]
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    first = begin[order]

    transfer = np.broadcast_to(np.eye(labels), (len(order), labels, labels)).copy()
    for s in range(longest):
        n = live[s]
        transfer[:n] = _unit((transfer[:n] @ step) * emit[first[:n] + s][:, None, :], axes=(1, 2))
    before = np.full((len(order), labels), 1.0 / labels)
    after = np.ones((len(order), labels))
    last = per_seq[seq] - 1
    for k in range(int(per_seq.max(initial=1)) - 1):
        b = np.flatnonzero((nth == k) & (last > k))
        before[place[b + 1]] = _unit((before[place[b]][:, None, :] @ transfer[place[b]])[:, 0])
    for k in range(int(per_seq.max(initial=1)) - 1, 0, -1):
        b = np.flatnonzero(nth == k)
        after[place[b - 1]] = _unit((transfer[place[b]] @ after[place[b]][:, :, None])[:, :, 0])
    forward = np.empty_like(emit)
    for s in range(longest):
        n = live[s]
        before[:n] = _unit((before[:n] @ step) * emit[first[:n] + s])
        forward[first[:n] + s] = before[:n]
    out = np.empty_like(emit)
    for s in range(longest - 1, -1, -1):
        n = live[s]
        at = first[:n] + s
        out[at] = _unit(forward[at] * after[:n])
        after[:n] = _unit((emit[at] * after[:n]) @ step.T)
    return out


def _pair_counts(weights, lengths, transition, marginal):
    """Expected counts of neighbouring labels, for sequences of one length (rows of a block)."""
    n = int(lengths[0])
    emit = np.exp(weights - weights.max(axis=1, keepdims=True)).reshape(-1, n, weights.shape[1])
    step = np.exp(transition - transition.max())
    after = np.ones((len(emit), emit.shape[2]))
    total = np.zeros_like(step)
    m = marginal.reshape(emit.shape)
    for t in range(n - 1, 0, -1):
        tail = emit[:, t] * after
        # probability of a label given its left neighbour, weighed by that neighbour's marginal
        given = step[None] * tail[:, None, :]
        given /= given.sum(axis=2, keepdims=True)
        total += (m[:, t - 1][:, :, None] * given).sum(axis=0)
        after = _unit(tail @ step.T)
    return total


class Model:
    """Languages, feature weights and transitions."""

    def __init__(self, languages: list[str], weights: Weights, transition: np.ndarray):
        self.languages, self.weights, self.transition = languages, weights, transition


def fit(sample: list[tuple[str, str]], steps: int = STEPS, seed: int = 7) -> Model | None:
    """Fit to (language, text) pairs."""
    rng = np.random.default_rng(seed)
    rows = [(lang, words) for lang, text in sample if (words := words_of(text))]
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    pieces = []  # passages of 1 to SEQUENCE words, each of one language
    for lang, words in rows:
        label, at = languages.index(lang), 0
        while at < len(words):
            take = int(rng.integers(3, SEQUENCE))
            pieces.append((label, words[at:at + take]))
            at += take
    order = rng.permutation(len(pieces))
    tokens = [w for k in order for w in pieces[k][1]]
    truth = np.array([pieces[k][0] for k in order for _ in pieces[k][1]], dtype=np.int64)
    n = len(tokens) // SEQUENCE * SEQUENCE or len(tokens)
    length = SEQUENCE if len(tokens) >= SEQUENCE else len(tokens)
    tokens, truth = tokens[:n], truth[:n]
    kinds = sorted(set(tokens))
    number = {w: k for k, w in enumerate(kinds)}
    word = np.array([number[w] for w in tokens], dtype=np.int64)
    uses = Counter()
    for w, c in Counter(tokens).items():
        for f in features(w):
            uses[f] += c
    index = {f: k for k, f in enumerate(sorted(f for f, c in uses.items() if c >= LEAST_USES))}
    table = np.zeros((len(index), len(languages)))
    weights = Weights(index, table)
    numbers, begins = weights.rows(kinds)
    owner = np.repeat(np.arange(len(kinds)), np.diff(begins))
    lengths = np.full(n // length, length, dtype=np.int64)
    transition = np.zeros((len(languages),) * 2)
    real = np.zeros((n, len(languages)))
    real[np.arange(n), truth] = 1.0
    pairs = np.zeros_like(transition)
    grid = truth.reshape(-1, length)
    np.add.at(pairs, (grid[:, :-1].ravel(), grid[:, 1:].ravel()), 1.0)
    seen_table, seen_step = np.full_like(table, 1e-8), np.full_like(transition, 1e-8)
    for _ in range(steps):
        own = _row_sums(table[numbers], begins)[word]
        m = marginals(own, lengths, transition)
        by_word = np.stack([np.bincount(word, weights=real[:, k] - m[:, k], minlength=len(kinds))
                            for k in range(len(languages))], axis=1)
        g = np.stack([np.bincount(numbers, weights=by_word[owner, k], minlength=len(index))
                      for k in range(len(languages))], axis=1) - 0.05 * table
        gt = pairs - _pair_counts(own, lengths, transition, m) - 0.05 * transition
        seen_table += g * g
        seen_step += gt * gt
        table += 0.2 * g / np.sqrt(seen_table)
        transition += 0.2 * gt / np.sqrt(seen_step)
    return Model(languages, weights, transition)


def _labeller(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        number: dict[str, int] = {}
        letters = 0
        table = np.zeros((0, len(model.languages) if model else 0))
        for piece, texts in chunks(batches):
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if model is not None:
                own = [words_of(t.decode("utf-8", "replace")) for t in texts]
                if len(number) > CACHE_WORDS or letters > CACHE_LETTERS:
                    number, table, letters = {}, table[:0], 0
                new = list(dict.fromkeys(w for words in own for w in words if w not in number))
                if new:
                    table = np.concatenate((table, model.weights.of(new)))
                    letters += sum(map(len, new))
                    number.update(zip(new, range(len(number), len(number) + len(new)), strict=True))
                size = np.array([len(words) for words in own], dtype=np.int64)
                has = np.flatnonzero(size)
                if len(has):
                    at = np.fromiter((number[w] for words in own for w in words), dtype=np.int64, count=size.sum())
                    m = marginals(table[at], size[has], model.transition)
                    begins = np.concatenate(([0], np.cumsum(size[has])))
                    share = _row_sums(m, begins) / size[has][:, None]
                    best = share.argmax(axis=1)
                    for k, b, s in zip(has.tolist(), best.tolist(), share.max(axis=1).tolist(), strict=True):
                        lang[k], score[k] = model.languages[b], min(s, 1.0)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(lang),
                                              pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, modulus: int = MODULUS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row; ids whose crc32 leaves remainder 2 are not learnt from."""
    labels = docs.where(~hold_out(F.col("doc_id"), modulus) & F.col("text").isNotNull()).select(
        "doc_id", F.col("lang").cast("string").alias("label"))
    sample, _ = labelled_sample(docs, labels, fit_rows)
    model = docs.sparkSession.sparkContext.broadcast(fit([(lang, text) for _, lang, text in sample]))
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       hold_out(F.col("doc_id"), modulus).alias("held_out"))
    return thin.mapInArrow(_labeller(model), "doc_id long, held_out boolean, lang_pred string, score double")
