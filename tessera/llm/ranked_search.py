"""Operator 13 - ranked lexical search of many queries at once, with shared term sets.

A document's score for an item is a sum over the item's terms, in integers, so it may be
added up in any order.  ``SharedSums`` makes use of it:

1. It mines the terms of all items for sets that several items share: first terms that
   the very same items have, then, round by round, pairs of sets that stand together in two
   items or more.  Each becomes a node of a graph, the sum of the nodes it is made of.
2. A task scores its documents block by block.  It fills the accumulators of the terms, adds up
   every node once, in order, for all items that use it, and an item's scores are the sum of
   the few nodes that it is left with.
3. Each item has a heap of its ``TOP`` best documents in a task; heaps are merged by Spark in
   two steps (within salted groups, then all).

The statistics (documents, terms, and each term's documents) come from one pass over all
documents before that, in the same way: map only, then sums of small rows.  Documents are
neither shuffled nor collected.  Only the items' terms and their graph are sent to tasks;
equal texts are searched once, and items of more than ``BLOCK_BYTES`` are taken in
blocks of about that size, each with its passes.

Edge cases: null, empty and wordless texts hold no term, count in no statistic and are never
found; an item without terms, or whose terms no document holds, finds nothing; repeated rows
are documents, or items, of their own; of equal scores the smaller id comes first, a null id
last; a text of any length is taken whole; empty tables give an empty result; other columns are ignored.
64-bit hashes stand for terms.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, group_bounds, joined, span_hashes, word_spans

TOP = 10
#: Text of the items that one pass takes to the tasks at most.
BLOCK_BYTES = 4 << 20
#: Places apart, in the order of frequency, of two sets that may be joined.
REACH = 6
#: Accumulators of a block of documents, in numbers.
HELD = 1 << 21
#: First groups of the merged heaps.
SALT = 64

#: Lower-cases A-Z and makes every byte outside 0-9, a-z and 0x80-0xFF a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each term, in order."""
    data, begins = joined([t.translate(_FOLD) for t in texts])
    starts, ends = word_spans(data)
    return np.searchsorted(begins, starts, side="right") - 1, span_hashes(data, starts, ends)


class SharedSums:
    """The graph of shared term sets: nodes 0 .. terms - 1 are terms, each later one is the sum of earlier ones."""

    def __init__(self, items: list[list[int]], terms: int, reach: int = REACH):
        holders: dict[int, list[int]] = defaultdict(list)
        for k, own in enumerate(items):
            for t in own:
                holders[t].append(k)
        self.terms, self.parts = terms, []
        same: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for t, of in holders.items():
            same[tuple(of)].append(t)
        left: list[list[int]] = [[] for _ in items]
        often: dict[int, int] = {}
        for of, own in same.items():
            node = own[0] if len(own) == 1 else self._add(own)
            often[node] = len(of)
            for k in of:
                left[k].append(node)
        grown = True
        while grown:
            grown = False
            left = [sorted(own, key=lambda x: (-often[x], x)) for own in left]
            pairs = Counter(pair for own in left for pair in self._pairs(own, often, reach))
            wanted = {pair: n for pair, n in pairs.items() if n > 1}
            users: dict[tuple[int, int], list[int]] = defaultdict(list)
            for k, own in enumerate(left):
                taken: set[int] = set()
                ranked = sorted((p for p in self._pairs(own, often, reach) if p in wanted), key=lambda p: (-wanted[p], p))
                for pair in ranked:
                    if taken.isdisjoint(pair):
                        taken.update(pair)
                        users[pair].append(k)
            for pair, of in users.items():
                if len(of) < 2:
                    continue
                grown = True
                node = self._add(list(pair))
                often[node] = len(of)
                for k in of:
                    left[k] = [x for x in left[k] if x not in pair] + [node]
        self.items = [np.array(sorted(own), dtype=np.int64) for own in left]
        self.nodes = terms + len(self.parts)

    def _add(self, parts: list[int]) -> int:
        self.parts.append(np.array(sorted(parts), dtype=np.int64))
        return self.terms + len(self.parts) - 1

    @staticmethod
    def _pairs(own: list[int], often: dict[int, int], reach: int) -> list[tuple[int, int]]:
        shared = [x for x in own if often[x] > 1]
        return [(min(a, b), max(a, b)) for i, a in enumerate(shared) for b in shared[i + 1:i + 1 + reach]]

    def additions(self) -> int:
        """Row additions of one block of documents."""
        return sum(len(p) - 1 for p in self.parts) + sum(max(len(x) - 1, 0) for x in self.items)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Scores (item, document) from the terms' accumulators (term, document)."""
        held = np.empty((self.nodes, terms.shape[1]), dtype=np.int64)
        held[:self.terms] = terms
        for k, parts in enumerate(self.parts):
            held[parts].sum(axis=0, out=held[self.terms + k])
        out = np.zeros((len(self.items), terms.shape[1]), dtype=np.int64)
        for k, own in enumerate(self.items):
            held[own].sum(axis=0, out=out[k])
        return out


class Search:
    """Items by their terms' codes; ``weigh`` gives the terms their weights."""

    def __init__(self, texts: list[str]):
        item, hashes = _terms([t.encode() for t in texts])
        self.vocabulary, code = np.unique(hashes, return_inverse=True)
        own = np.unique(np.stack((item, code), axis=1), axis=0) if len(code) else np.zeros((0, 2), dtype=np.int64)
        bounds = np.searchsorted(own[:, 0], np.arange(len(texts) + 1))
        self.sums = SharedSums([own[s:e, 1].tolist() for s, e in zip(bounds[:-1], bounds[1:], strict=True)],
                               len(self.vocabulary))
        self.weights, self.documents, self.length = np.zeros(len(self.vocabulary), dtype=np.int64), 0, 0

    def weigh(self, documents: int, length: int, frequency: dict[int, int]) -> None:
        self.documents, self.length = documents, length
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(t, 0) + 1)))
                                 for t in range(len(self.vocabulary))], dtype=np.int64)

    def found(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text, and text, code and number of each term of the items in it."""
        doc, hashes = _terms(texts)
        n = np.bincount(doc, minlength=len(texts))
        if not len(self.vocabulary) or not len(doc):
            return n, *(np.zeros(0, dtype=np.int64) for _ in range(3))
        code = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[code] == hashes
        pair, times = np.unique(doc[known] * len(self.vocabulary) + code[known], return_counts=True)
        return n, pair // len(self.vocabulary), pair % len(self.vocabulary), times

    def scored(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """First text and scores (item, text) of each block of texts."""
        n, doc, code, times = self.found(texts)
        m = 100 - 90 + 90 * n * self.documents // max(self.length, 1)
        part = self.weights[code] * (1_000_000_000 * times // (1000 * times + 8 * m[doc]))
        step = max(1, HELD // max(self.sums.nodes, 1))
        for first in range(0, len(texts), step):
            size = min(step, len(texts) - first)
            lo, hi = np.searchsorted(doc, (first, first + size))
            terms = np.zeros((len(self.vocabulary), size), dtype=np.int64)
            terms[code[lo:hi], doc[lo:hi] - first] = part[lo:hi]
            yield first, self.sums.scores(terms)


_DOCUMENTS, _LENGTH = -1, -2


def _counter(search):
    """(code, n): each term's documents, and under codes below 0 the documents with terms and all their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = np.zeros(len(search.value.vocabulary), dtype=np.int64)
        documents = length = 0
        for _, texts in chunks(batches):
            n, _, code, _ = search.value.found(texts)
            frequency += np.bincount(code, minlength=len(frequency))
            documents += int((n > 0).sum())
            length += int(n.sum())
        own = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((own, [_DOCUMENTS, _LENGTH]))),
                                          pa.array(np.concatenate((frequency[own], [documents, length])))], ["code", "n"])
    return run


def _finder(search, top: int):
    """(item, doc_id, score): a task's best documents of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_items = len(search.value.sums.items)
        least = np.ones(n_items, dtype=np.int64)  # a score above 0
        item, score, ident = (np.zeros(0, dtype=np.int64) for _ in range(3))
        late = np.zeros(0, dtype=bool)
        for piece, texts in chunks(batches):
            ids = piece.column("doc_id")
            null, ids = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0))
            for first, scores in search.value.scored(texts):
                row, column = np.nonzero(scores >= least[:, None])
                if not len(row):
                    continue
                item, score = np.concatenate((item, row)), np.concatenate((score, scores[row, column]))
                ident, late = np.concatenate((ident, ids[column + first])), np.concatenate((late, null[column + first]))
                order = np.lexsort((ident, late, -score, item))
                bounds = group_bounds(item[order])
                nth = np.arange(len(order)) - np.repeat(bounds[:-1], np.diff(bounds))
                last = order[nth == top - 1]
                least[item[last]] = score[last]
                order = order[nth < top]
                item, score, ident, late = item[order], score[order], ident[order], late[order]
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ident, mask=late), pa.array(score)],
                                         ["item", "doc_id", "score"])
    return run


def _blocks(texts: DataFrame, block_bytes: int) -> Iterator[list[str]]:
    """Different texts in blocks of about ``block_bytes``; one text is never divided."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // block_bytes + 1
    for k in range(n):
        own = texts if n == 1 else texts.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        yield [text for text, in own.toLocalIterator()]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each row of ``items``."""
    spark = docs.sparkSession
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select("item_id", "text").where("text is not null")
    out = []
    for texts in _blocks(asked.select("text").distinct(), block_bytes):
        queries = Search(texts)
        counts = thin.mapInArrow(_counter(spark.sparkContext.broadcast(queries)), "code long, n long")
        total = {r["code"]: r["n"] for r in counts.groupBy("code").agg(F.sum("n").alias("n")).collect()}  # the items' terms
        queries.weigh(total.pop(_DOCUMENTS, 0), total.pop(_LENGTH, 0), total)
        best = thin.mapInArrow(_finder(spark.sparkContext.broadcast(queries), top), "item long, doc_id long, score long")
        best = best.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)))
        for keys in (["item", "salt"], ["item"]):
            order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        named = spark.createDataFrame(list(enumerate(texts)), "item long, text string")
        out.append(best.join(named, "item").select("text", "rank", "doc_id", "score"))
    found = out[0]
    for more in out[1:]:
        found = found.unionAll(more)
    return asked.join(found, "text").select("item_id", "rank", "doc_id", "score")
