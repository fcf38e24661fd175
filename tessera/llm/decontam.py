"""Operator 7 - benchmark decontamination with an FM-index per training shard.

A task turns the documents it reads into shards.  A shard's text is the words of its
documents as codes of the benchmark's vocabulary; all other words can match nothing, so
they only end a run, and runs shorter than the shortest window are left out.  Over the
runs the task builds an FM-index, finds every benchmark window by backward search on
wavelet ranks, locates the occurrences from sampled suffix positions and merges them
into removal spans per document.

Documents are neither shuffled nor collected.  Only the benchmark is sent to the tasks:
its size is measured first, and a benchmark of more than ``BLOCK_BYTES`` is searched in
blocks of about that size, whose spans are merged by document afterwards.

Edge cases: null or empty texts have no words and no hits; an item without words has no
window, one of fewer than ``window`` words is one window; items of equal text all count
for a document that holds it; a null item id is not listed; repeated rows get a row
each; an empty benchmark hits nothing; other columns are ignored, or kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, joined, span_hashes, word_spans
from .fm_index import FMIndex

WINDOW, LEAST_SHARE = 13, 20
#: Benchmark text that one search takes to the tasks at most, and text of a shard.
BLOCK_BYTES, SHARD_BYTES = 4 << 20, 1 << 20

#: Lower-cases A-Z and makes every byte outside 0-9, a-z and 0x80-0xFF a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))

_SPANS = "array<struct<start:long,end:long>>"


class Phrases:
    """The different windows of the items, coded by their own vocabulary."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        texts = [(text or "").encode().translate(_FOLD) for _, text in items]
        data, begins = joined(texts)
        starts, ends = word_spans(data)
        item = np.searchsorted(begins, starts, side="right") - 1
        self.vocabulary, code = np.unique(span_hashes(data, starts, ends), return_inverse=True)
        bounds = np.searchsorted(item, np.arange(len(items) + 1))
        size = np.diff(bounds)
        n_windows = np.where(size > 0, np.maximum(size - window, 0) + 1, 0)
        of = np.repeat(np.arange(len(items)), n_windows)
        first = bounds[of] + np.arange(len(of)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        length = np.minimum(size[of], window)
        # codes from 1; a window shorter than the longest one ends in zeros
        place = np.arange(int(length.max(initial=1)))
        inside = place < length[:, None]
        rows = np.where(inside, code[np.minimum(first[:, None] + place, max(len(code) - 1, 0))] + 1 if len(code) else 0, 0)
        self.codes, which = np.unique(rows.astype(np.int64), axis=0, return_inverse=True)
        self.lengths = (self.codes > 0).sum(axis=1)
        names = np.array([-1 if name is None else k for k, (name, _) in enumerate(items)], dtype=np.int64)[of]
        self.items: list[list[str]] = [[] for _ in self.codes]
        for k, name in np.unique(np.stack((which.ravel(), names), axis=1), axis=0).tolist():
            if name >= 0:
                self.items[k].append(items[name][0])
        self.items = [sorted(set(own)) for own in self.items]
        self.shortest = int(self.lengths.min(initial=window))

    def find(self, texts: list[bytes]):
        """Words of each text, merged hit spans (text, first word, end) and (text, phrase) of what occurs."""
        data, begins = joined([t.translate(_FOLD) for t in texts])
        starts, ends = word_spans(data)
        doc = np.searchsorted(begins, starts, side="right") - 1
        n_words = np.bincount(doc, minlength=len(texts))
        first = np.concatenate(([0], np.cumsum(n_words)))
        none = np.zeros((0, 3), dtype=np.int64), np.zeros((0, 2), dtype=np.int64)
        if not len(self.lengths) or not len(doc):
            return n_words, *none
        h = span_hashes(data, starts, ends)
        code = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        known = self.vocabulary[code] == h
        edge = np.ones(len(doc) + 1, dtype=bool)
        edge[1:-1] = (known[1:] != known[:-1]) | (doc[1:] != doc[:-1])
        cut = np.flatnonzero(edge)
        begin, end = cut[:-1], cut[1:]
        long = known[begin] & (end - begin >= self.shortest)
        begin, end = begin[long], end[long]
        if not len(begin):
            return n_words, *none
        size = end - begin + 1
        put = np.concatenate(([0], np.cumsum(size)))
        run = np.repeat(np.arange(len(begin)), size)
        word = np.arange(put[-1]) - put[run] + begin[run]
        text = np.zeros(put[-1], dtype=np.int64)
        inside = word < end[run]
        text[inside] = code[word[inside]] + 1
        index = FMIndex(text, len(self.vocabulary) + 1)
        lo, hi = index.search(self.codes, self.lengths)
        phrase = np.repeat(np.arange(len(lo)), np.maximum(hi - lo, 0))
        if not len(phrase):
            return n_words, *none
        step = np.arange(len(phrase)) - np.repeat(np.cumsum(np.maximum(hi - lo, 0)) - np.maximum(hi - lo, 0),
                                                  np.maximum(hi - lo, 0))
        at = word[index.locate(lo[phrase] + step)]
        occurs = np.unique(np.stack((doc[at], phrase), axis=1), axis=0)
        change = np.zeros(len(doc) + 1, dtype=np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + self.lengths[phrase], -1)
        hit = np.cumsum(change[:-1]) > 0
        edge[1:-1] = (hit[1:] != hit[:-1]) | (doc[1:] != doc[:-1])
        cut = np.flatnonzero(edge)
        begin, end = cut[:-1][hit[cut[:-1]]], cut[1:][hit[cut[:-1]]]
        of = doc[begin]
        return n_words, np.stack((of, begin - first[of], end - first[of]), axis=1), occurs


def _finder(phrases, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in chunks(batches, limit=shard_bytes):
            n_words, hits, occurs = phrases.value.find(texts)
            spans = [[] for _ in texts]
            for k, s, e in hits.tolist():
                spans[k].append({"start": s, "end": e})
            items = [set() for _ in texts]
            for k, p in occurs.tolist():
                items[k].update(phrases.value.items[p])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("_text_hash"), pa.array(n_words),
                 pa.array(spans, type=pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array([sorted(x) for x in items], type=pa.list_(pa.string()))],
                ["doc_id", "_text_hash", "n_words", "spans", "items"])
    return run


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Phrases]:
    """The benchmark in blocks of about ``block_bytes``; one item is never divided."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // block_bytes + 1
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield Phrases([tuple(row) for row in own.toLocalIterator()], window)


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items) per row of ``docs``: merged removal spans, in words, and the items found."""
    spark = docs.sparkSession
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_text_hash"))
    schema = f"doc_id long, _text_hash long, n_words long, spans {_SPANS}, items array<string>"
    found = [thin.mapInArrow(_finder(spark.sparkContext.broadcast(p), shard_bytes), schema)
             for p in _blocks(benchmark, window, block_bytes)]
    if len(found) == 1:
        return found[0].drop("_text_hash")
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    merged = every.groupBy("doc_id", "_text_hash", "n_words").agg(
        (F.count("*") / len(found)).cast("int").alias("_rows"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.withColumn("spans", _merged(F.col("spans"))).withColumn(
        "_row", F.explode(F.sequence(F.lit(1), "_rows"))).select("doc_id", "n_words", "spans", "items")


def _merged(spans: Column) -> Column:
    """Sorted spans, with those that overlap or touch made one."""
    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(-1)) >= span["start"])
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown))
                      ).otherwise(F.concat(done, F.array(span)))
    return F.aggregate(spans, F.array().cast(_SPANS), add)


def judged(found: DataFrame, least_share: int = LEAST_SHARE) -> DataFrame:
    """``found`` with the counts and the verdict: at least one word in ``least_share`` is hit."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (least_share * F.col("n_hit") >= F.col("n_words")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_share: int = LEAST_SHARE,
               block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    With a benchmark of one block, documents are judged where they are read; with more,
    the verdicts come from ``find`` and are joined by id and text.
    """
    spark = docs.sparkSession
    blocks = list(_blocks(benchmark, window, block_bytes)) if _one_block(benchmark, block_bytes) else []
    if blocks:
        phrases = spark.sparkContext.broadcast(blocks[0])

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece, texts in chunks(batches, limit=shard_bytes):
                n_words, hits, _ = phrases.value.find(texts)
                n_hit = np.bincount(hits[:, 0], weights=hits[:, 2] - hits[:, 1], minlength=len(texts))
                yield piece.filter(pa.array((n_hit == 0) | (least_share * n_hit < n_words)))

        return docs.mapInArrow(clean, docs.schema)
    # named by a hash of id and text, rows of equal id are judged by their own text
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    bad = judged(find(keyed, benchmark, window, block_bytes, shard_bytes), least_share)
    gone = bad.where("contaminated").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, F.xxhash64(docs["doc_id"], docs["text"]) == gone["gone"], "left_anti")


def _one_block(benchmark: DataFrame, block_bytes: int) -> bool:
    return (benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) < block_bytes
