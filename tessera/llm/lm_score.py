"""Operator 2 - language-model scores from a subword lattice.

Words and a text's end are tokens.  The model gives a word the mass of two kinds of paths
through its lattice: the whole word, as often as it was learnt (less a discount), and all
segmentations into the pieces of an existing vocabulary, which share the discounted mass:

    p(word) = max(c - D, 0) / N  +  D * V / N  *  sum over segmentations of prod p(piece)

Within a text the words before a token are a further way to spell it: a word seen h times
among the m before it has, with a = CACHE * m / (m + CACHE_WORDS),

    p(word | text so far) = (1 - a) * p(word) + a * h / m .

Piece weights begin at the vocabulary's own scores.  They are fitted to the learnt words
by expected counts (forward-backward over every lattice): ``ROUNDS`` rounds, each over all
of them.  A text's score is the log10 of the product.  All of it sums to one over all token
sequences.

How it runs: words are counted with map-side aggregation; each different word gets its
lattice once, wherever it occurs.  Texts look up at most ``FREQUENT`` words in a table sent
to the tasks (a stated bound); their other words are shuffled to the word table and their
sums back to the text, so nothing that grows with the vocabulary is broadcast.

Edge cases: null and empty texts are one end token; repeated rows get the same score and
count each; a null id is never held out; with nothing learnt the vocabulary's own scores
are the model; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, chunks, cut, hold_out, shared_dir
from .lattice import Lattice, Vocabulary, normalised

MODULUS, DISCOUNT, CACHE, CACHE_WORDS = 7, 0.75, 0.3, 20
#: Words sent to the tasks, rounds over all learnt words, words of one lattice batch.
FREQUENT, ROUNDS, BATCH = 100_000, 4, 4000
#: Different words a task counts before it passes the counts on.
COUNTER_WORDS = 250_000

_PIECE_FILE = "piece_bpe_32k.model"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(learnt: Counter, other: set):
        words = [*learnt, *(w for w in other if w not in learnt)]
        n = [learnt.get(w, 0) for w in words]
        return pa.RecordBatch.from_arrays([pa.array(words, type=pa.binary()), pa.array(n, pa.int64())], ["word", "c"])

    learnt, other = Counter(), set()
    for piece, texts in chunks(batches):
        for text, held in zip(texts, piece.column("held_out").to_pylist(), strict=True):
            words = text.translate(LOWER).split()
            (other if held else learnt).update(words)
        if len(learnt) + len(other) >= COUNTER_WORDS:
            yield flush(learnt, other)
            learnt, other = Counter(), set()
    yield flush(learnt, other)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c): every word of every text and how often it stands in learnt texts."""
    return docs.mapInArrow(_counts, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(scored: DataFrame, limit: int) -> list:
    """At most ``limit`` rows of the word table, those of the greatest base scores.

    They are picked by a threshold from a histogram of the scores, so tasks send no more than is kept.
    """
    band = F.floor(F.col("base") * 64)
    above, least = 0, None
    for b, n in sorted(scored.groupBy(band.alias("b")).agg(F.count("*").alias("n")).collect(), reverse=True):
        above += n
        if above > limit:
            break
        least = b
    return [] if least is None else scored.where(band >= least).collect()


def _expected(logp, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = Vocabulary(vocabulary), None
        for batch in batches:
            words = batch.column("word").to_pylist()
            for at in range(0, len(words), BATCH):
                part = words[at:at + BATCH]
                now = Lattice(own, part).expected(logp.value, np.ones(len(part)))
                total = now if total is None else total + now
        if total is not None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])
    return run


def fit_pieces(learnt: DataFrame, vocabulary: str = _PIECE_FILE, rounds: int = ROUNDS) -> np.ndarray:
    """Log probability of every piece, fitted in each round to all the different words in ``learnt`` (column word).

    The driver gets one sum per piece and round.
    """
    spark = learnt.sparkSession
    own = Vocabulary(vocabulary)
    logp = own.initial
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(logp)
        uses = learnt.select("word").mapInArrow(_expected(sent, vocabulary), "piece long, uses double").groupBy(
            "piece").agg(F.sum("uses").alias("uses")).collect()  # at most one row per piece of the vocabulary
        sent.unpersist()
        if not uses:  # nothing learnt
            break
        total = np.zeros(own.size)
        for piece, n in uses:
            total[piece] = n
        logp = normalised(total)
    return logp


def _word_scores(logp, n: int, v: int, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(vocabulary)
        for batch in batches:
            words = batch.column("word").to_pylist()
            c = np.asarray(batch.column("c")).astype(np.float64)
            for at in range(0, len(words), BATCH):
                part, k = words[at:at + BATCH], c[at:at + BATCH]
                log_q = Lattice(own, part).log_probability(logp.value)
                if n:
                    known = np.log(np.maximum(k - DISCOUNT, 1e-300) / n)
                    known[k <= DISCOUNT] = -np.inf
                    log_q = np.logaddexp(known, math.log(DISCOUNT * v / n) + log_q)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, type=pa.binary()), pa.array(k > 0), pa.array(np.log10((k + 1) / (n + v + 1))),
                     pa.array(log_q / math.log(10))], ["word", "known", "base", "lp"])
    return run


def _earlier(doc: np.ndarray, word: np.ndarray) -> np.ndarray:
    """How often each token's word (a number from 0) stood in its text before."""
    n = len(doc)
    out = np.zeros(n, dtype=np.int64)
    if n:
        group = doc * (int(word.max()) + 1) + word
        both = np.sort(group * n + np.arange(n))  # by text and word, then by place
        group, place = np.divmod(both, n)
        new = np.ones(n, dtype=bool)
        new[1:] = group[1:] != group[:-1]
        nth = np.arange(n)
        out[place] = nth - np.maximum.accumulate(np.where(new, nth, 0))
    return out


def _text_scores(table, end: tuple[bool, float, float]):
    """Sums over the words in ``table``.  Others are listed: ``rest`` where they are new to the text, ``again`` else."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, known, base, lp = table.value
        index = {w: k for k, w in enumerate(words_of)}
        known, base, p = (np.append(x, 0.0) for x in (known, base, 10.0 ** lp))
        for piece, texts in chunks(batches):
            words = [t.translate(LOWER).split() for t in texts]
            n = len(words)
            size = np.fromiter(map(len, words), dtype=np.int64, count=n)
            flat = [w for own in words for w in own]
            at = np.fromiter(map(index.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
            doc = np.repeat(np.arange(n), size)
            other = np.flatnonzero(at < 0)
            number: dict[bytes, int] = {}
            word = at.copy()
            word[other] = [len(index) + number.setdefault(flat[k], len(number)) for k in other]
            m = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
            a = CACHE * m / (m + CACHE_WORDS)
            cached = a * _earlier(doc, word) / np.maximum(m, 1)
            of_end = np.log10(1 - CACHE * size / (size + CACHE_WORDS)) + end[2]
            fresh = (at < 0) & (cached == 0)
            here = np.log10(np.where(at < 0, np.where(fresh, 1 - a, 1.0), (1 - a) * p[at] + cached))
            again = np.flatnonzero((at < 0) & (cached > 0))
            fresh = np.flatnonzero(fresh)

            def listed(where, values, doc=doc, n=n):
                offsets = np.searchsorted(doc[where], np.arange(n + 1))
                return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), values)

            def sums(values, doc=doc, n=n):
                return np.bincount(doc, weights=values, minlength=n)

            seen = pa.StructArray.from_arrays(
                [pa.array([flat[k] for k in again], type=pa.binary()), pa.array(1 - a[again]), pa.array(cached[again])],
                ["word", "new", "old"])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("text_hash"), piece.column("held_out"), pa.array(size + 1),
                 pa.array(sums(known[at]).astype(np.int64) + int(end[0])), pa.array(sums(base[at]) + end[1]),
                 pa.array(sums(here) + of_end), listed(fresh, pa.array([flat[k] for k in fresh], type=pa.binary())),
                 listed(again, seen)],
                ["doc_id", "text_hash", "held_out", "n_tokens", "n_known", "base", "lp", "rest", "again"])
    return run


_PARTS = ("doc_id long, text_hash long, held_out boolean, n_tokens long, n_known long, base double, lp double, "
          "rest array<binary>, again array<struct<word:binary,new:double,old:double>>")


def score(docs: DataFrame, modulus: int = MODULUS, vocabulary: str = _PIECE_FILE, frequent: int = FREQUENT) -> DataFrame:
    """Scores per row of ``docs``; ids whose crc32 leaves remainder 2 are scored but not learnt."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/lm-{uuid.uuid4().hex}"
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"), hold_out(F.col("doc_id"), modulus).alias("held_out"))
    words = cut(word_counts(thin))
    n_words, distinct = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_texts = thin.where("not held_out").count()
    n, v = n_words + n_texts, distinct + (n_texts > 0)
    logp = fit_pieces(words.where("c > 0"), vocabulary)
    sent = spark.sparkContext.broadcast(logp)
    scored = cut(words.mapInArrow(_word_scores(sent, n, v, vocabulary),
                                  "word binary, known boolean, base double, lp double"))
    top = most_frequent(scored, frequent)
    table = spark.sparkContext.broadcast((
        [bytes(r["word"]) for r in top], *(np.array([r[c] for r in top], dtype=np.float64) for c in ("known", "base", "lp"))))
    if n:
        p_end = (n_texts - DISCOUNT) / n + DISCOUNT * v / n * math.exp(logp[Vocabulary(vocabulary).end])
    else:
        p_end = math.exp(logp[Vocabulary(vocabulary).end])
    end = (n_texts > 0, math.log10((n_texts + 1) / (n + v + 1)), math.log10(p_end))
    thin.mapInArrow(_text_scores(table, end), _PARTS).write.option("compression", "zstd").parquet(f"{folder}/parts")
    parts = spark.read.schema(_PARTS).parquet(f"{folder}/parts")
    mix = "struct<new:double,old:double>"
    fresh = parts.select("doc_id", "text_hash", F.explode("rest").alias("word"), F.lit(None).cast(mix).alias("mix"))
    again = parts.select("doc_id", "text_hash", F.explode("again").alias("a")).select(
        "doc_id", "text_hash", "a.word", F.struct("a.new", "a.old").alias("mix"))
    mixed = F.when(F.col("mix").isNull(), F.col("lp")).otherwise(
        F.log10(F.col("mix.new") * F.pow(F.lit(10.0), F.col("lp")) + F.col("mix.old")))
    rest = fresh.unionAll(again).join(scored, "word").groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("r_n"), F.sum(F.col("known").cast("long")).alias("r_known"), F.sum("base").alias("r_base"),
        F.sum(mixed).alias("r_lp"))
    rest = rest.withColumnsRenamed({"doc_id": "r_id", "text_hash": "r_hash"})
    own = parts.withColumn("n_rest", F.size("rest") + F.size("again")).drop("rest", "again")
    # rows of equal id and text were summed together: each takes its part
    share = F.coalesce(F.col("n_rest") / F.col("r_n"), F.lit(0.0))

    def total(mine: str, theirs: str):
        return F.col(mine) + F.coalesce(F.col(theirs) * share, F.lit(0.0))

    joined = own.join(rest, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")), "left")
    return joined.select(
        "doc_id", "held_out", "n_tokens", F.round(total("n_known", "r_known")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), total("base", "r_base").alias("base_score"),
        total("lp", "r_lp").alias("score"))
