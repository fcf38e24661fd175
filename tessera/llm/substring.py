"""Operator 5 - removal of repeated word windows, with a compressed FM-index per shard.

A word goes if a window of ``WINDOW`` words that covers it also begins in a document of a
smaller id.  Equal windows have to meet, so shards are made by content:

1. The least hash among a window's runs of ``ANCHOR`` words is the window's anchor.
   Neighbouring windows of equal anchor make a segment.  Anchors seen under one id
   only cannot repeat across documents; a bitmap of fixed size of the others lets a
   second scan write just the segments that may repeat (a false alarm only costs work).
2. Equal segments fall together, with their least and greatest id; an anchor's
   segments go to one shard (those of a very frequent anchor to pairs of parts).
3. A shard's task builds an FM-index of its segments and streams the segments through
   it by backward search.  The match is kept at the threshold: after each window the
   interval falls back to its first ``WINDOW`` - 1 words and is extended by the next
   word on the left.  The interval's suffixes give the least id that holds the window.
4. Windows whose least id is smaller than the document's become spans; a task removes
   the merged spans from the text.

Edge cases: null and empty texts have no words; texts under ``WINDOW`` words lose nothing;
a window repeated inside one document, or in rows of one id, stays; a null id neither
removes nor loses anything; an empty table gives an empty result; other columns are
ignored, or kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    chunks,
    cut,
    joined,
    mix,
    shared_dir,
    span_hashes,
    window_hashes,
    word_spans,
)
from .fm_index import FMIndex, suffix_order

WINDOW, ANCHOR = 50, 12
#: Bits of the bitmap of anchors, words of one index, windows in a segment, segments of an anchor in one index.
BITMAP_BITS, SHARD_WORDS, SEGMENT_WINDOWS, HOT_SEGMENTS = 1 << 26, 1_000_000, 64, 2000


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    span, least = 1, h
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[:len(h) - width + 1], least[width - span:][:len(h) - width + 1])


def _segments(texts: list[bytes], window: int):
    """Of all texts: data, word starts and ends, and segments (text, anchor, first word, windows)."""
    data, begins = joined(texts)
    starts, ends = word_spans(data)
    doc = np.searchsorted(begins, starts, side="right") - 1
    n = len(doc) - window + 1
    if n <= 0:
        nothing = np.zeros(0, dtype=np.int64)
        return data, starts, ends, doc, nothing, nothing.astype(np.uint64), nothing, nothing
    width = min(ANCHOR, window)
    grams = mix(window_hashes(span_hashes(data, starts, ends), width))
    anchor = _sliding_least(grams, window - width + 1)
    at = np.flatnonzero(doc[:n] == doc[window - 1:])
    if not len(at):
        return data, starts, ends, doc, at, at.astype(np.uint64), at, at
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (anchor[at[1:]] != anchor[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
    group = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    new |= (np.arange(len(at)) - group) % SEGMENT_WINDOWS == 0
    edge = np.append(np.flatnonzero(new), len(at))
    first = at[edge[:-1]]
    return data, starts, ends, doc, doc[first], anchor[first], first, np.diff(edge)


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in chunks(batches):
            of, anchor = _segments(texts, window)[4:6]
            ids = np.asarray(piece.column("doc_id"))[of]
            pairs = np.unique(np.stack((anchor.view(np.int64), ids), axis=1), axis=0) if len(of) else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["anchor", "doc_id"])
    return run


def _bit(anchor: np.ndarray, bits: int) -> np.ndarray:
    return (anchor.view(np.uint64) % np.uint64(bits)).astype(np.int64)


def bitmap(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits (a multiple of 32768) with the bit of every value modulo ``bits`` set.

    It is made by map-side aggregation, and its size does not depend on the table.
    """
    place = F.pmod(F.col(column), F.lit(bits))  # bits is a power of two: the same for signed and unsigned
    rows = values.select(place.alias("p")).groupBy(F.expr("bitmap_bucket_number(p + 1)").alias("k")).agg(
        F.bitmap_construct_agg(F.expr("bitmap_bit_position(p + 1)")).alias("b"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for k, b in rows.toLocalIterator():
        out[(k - 1) * 4096:k * 4096] = np.frombuffer(b, dtype=np.uint8)
    return out


def has_bit(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


_OCCURRENCES = "anchor long, segment long, doc_id long, text_hash long, first long, windows int, words binary"


def _writer(window: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in chunks(batches):
            data, starts, ends, doc, of, anchor, first, windows = _segments(texts, window)
            keep = has_bit(wanted.value, _bit(anchor, len(wanted.value) * 8)) if len(of) else np.zeros(0, bool)
            of, anchor, first, windows = of[keep], anchor[keep], first[keep], windows[keep]
            if not len(of):
                continue
            last = first + windows + window - 2
            text = data.tobytes()
            own = [b" ".join(text[s:e].split()) for s, e in zip(starts[first].tolist(), ends[last].tolist(), strict=True)]
            hashes = [int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little", signed=True) for w in own]
            before = np.searchsorted(doc, np.arange(len(texts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(hashes, type=pa.int64()), piece.column("doc_id").take(pa.array(of)),
                 piece.column("text_hash").take(pa.array(of)), pa.array(first - before[of]),
                 pa.array(windows.astype(np.int32)), pa.array(own, type=pa.binary())],
                ["anchor", "segment", "doc_id", "text_hash", "first", "windows", "words"])
    return run


def matching_statistics(segments: list[bytes], least: np.ndarray, window: int):
    """For every window of every segment, the least id among the segments that hold it.

    Gives (segment, first word, least id).  An FM-index of all segments is built, and all are
    streamed through it from the right, one word a step.
    """
    data, begins = joined(segments)
    starts, ends = word_spans(data)
    of = np.searchsorted(begins, starts, side="right") - 1
    size = np.bincount(of, minlength=len(segments))
    _, code = np.unique(span_hashes(data, starts, ends), return_inverse=True)
    put = np.concatenate(([0], np.cumsum(size + 1)))
    text = np.zeros(put[-1], dtype=np.int64)
    text[np.arange(len(of)) + of] = code + 1
    seg_of = np.repeat(np.arange(len(segments)), size + 1)
    order = suffix_order(text)
    index = FMIndex(text, int(code.max(initial=0)) + 2, order=order)

    def runs_of_equal(length: int) -> np.ndarray:
        """Begin of the run of ranks that share their first ``length`` words; the end of all is added."""
        h = np.zeros(len(text), dtype=np.uint64)
        own = mix(window_hashes(text.astype(np.uint64), length))
        h[:len(own)] = own
        fits = np.arange(len(text)) + length < put[seg_of + 1]
        same = fits[order[1:]] & fits[order[:-1]] & (h[order[1:]] == h[order[:-1]])
        return np.concatenate(([0], np.flatnonzero(~same) + 1, [len(text)]))

    shorter, full = runs_of_equal(window - 1), runs_of_equal(window)
    least_of_run = np.minimum.reduceat(least[seg_of[order]], full[:-1]) if len(text) else least
    del order
    lo, hi = np.zeros(len(segments), dtype=np.int64), np.full(len(segments), len(text), dtype=np.int64)
    matched = np.zeros(len(segments), dtype=np.int64)
    found = []
    for step in range(1, int(size.max(initial=0)) + 1):
        live = np.flatnonzero(size >= step)
        drop = live[matched[live] == window]
        run = np.searchsorted(shorter, lo[drop], side="right") - 1
        lo[drop], hi[drop] = shorter[run], shorter[run + 1]
        matched[drop] -= 1
        lo[live], hi[live] = index.extend(text[put[live] + size[live] - step], lo[live], hi[live])
        matched[live] += 1
        hit = live[matched[live] >= window]
        run = np.searchsorted(full, lo[hit], side="right") - 1
        found.append(np.stack((hit, size[hit] - step, least_of_run[run]), axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)


_FOUND = ("kind byte, anchor long, segment long, at long, n long, owner long, least long, most long, words binary")


def _solved(rows: list[tuple], window: int) -> pa.RecordBatch:
    """Runs of windows that some document of their segment loses, from an index of all ``rows``."""
    least, most = (np.array([r[k] for r in rows], dtype=np.int64) for k in (2, 3))
    seg, at, owner = matching_statistics([r[4] for r in rows], least, window).T
    keep = owner < most[seg]  # else no document of the segment loses the window
    seg, at, owner = seg[keep], at[keep], owner[keep]
    by = np.lexsort((at, seg))
    seg, at, owner = seg[by], at[by], owner[by]
    new = np.ones(len(seg), dtype=bool)
    new[1:] = (seg[1:] != seg[:-1]) | (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)
    cut_at = np.flatnonzero(new)
    n = np.diff(np.append(cut_at, len(seg)))
    anchor, segment = (np.array([r[k] for r in rows], dtype=np.int64) for k in (0, 1))
    none = np.zeros(len(cut_at), dtype=np.int64)
    columns = [anchor[seg[cut_at]], segment[seg[cut_at]], at[cut_at], n, owner[cut_at], none, none]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(len(none), dtype=np.int8)), *map(pa.array, columns), pa.nulls(len(none), pa.binary())],
        ["kind", "anchor", "segment", "at", "n", "owner", "least", "most", "words"])


def _passed_on(rows: list[tuple]) -> pa.RecordBatch:
    anchor, segment, least, most, words = zip(*(r[:5] for r in rows), strict=True)
    none = np.zeros(len(rows), dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(rows), dtype=np.int8)), *(pa.array(x, pa.int64()) for x in (anchor, segment, none, none, none, least, most)),
         pa.array(words, pa.binary())], ["kind", "anchor", "segment", "at", "n", "owner", "least", "most", "words"])


def _searcher(window: int, shard_words: int, group: str, hot: int):
    """Solve shards of whole groups; a group of over ``hot`` segments is passed on as it comes, not held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, words, own, now, passing = [], 0, [], None, False
        names = ("anchor", "segment", "least", "most", "words", group)
        for batch in batches:
            late = []
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if row[5] != now:
                    shard += own
                    words += sum(r[4].count(b" ") + 1 for r in own)
                    if words >= shard_words:
                        yield _solved(shard, window)
                        shard, words = [], 0
                    own, now, passing = [], row[5], False
                (late if passing else own).append(row)
                if len(own) > hot:
                    late += own
                    own, passing = [], True
            if late:
                yield _passed_on(late)
        if shard or own:
            yield _solved(shard + own, window)
    return run


def _repeats(distinct: DataFrame, window: int, shard_words: int, hot: int) -> DataFrame:
    """(anchor, segment, at, n, owner) of the distinct segments: runs of windows and the least id that holds them.

    Segments of one anchor meet in one index.  An anchor of over ``hot`` segments is cut into
    parts, and each pair of parts meets in an index of its own, so no task holds them all.
    """
    dealt = distinct.repartition("anchor").sortWithinPartitions("anchor")
    found = cut(dealt.mapInArrow(_searcher(window, shard_words, "anchor", hot), _FOUND))
    repeats = found.where("kind = 0").select("anchor", "segment", "at", "n", "owner")
    rest = found.where("kind = 1").select("anchor", "segment", "least", "most", "words")
    if rest.isEmpty():
        return repeats
    size = rest.groupBy("anchor").agg(F.ceil(F.count("*") / (hot // 2 or 1)).cast("long").alias("parts"))
    mine = rest.join(size, "anchor").withColumn("mine", F.pmod(F.xxhash64("segment"), F.col("parts")))
    paired = mine.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cells = paired.select(F.xxhash64("anchor", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
                          "anchor", "segment", "least", "most", "words")
    again = cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        _searcher(window, shard_words, "cell", 1 << 30), _FOUND)
    return repeats.unionAll(again.select("anchor", "segment", "at", "n", "owner"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, bitmap_bits: int = BITMAP_BITS,
                   shard_words: int = SHARD_WORDS, hot: int = HOT_SEGMENTS) -> DataFrame:
    """(doc_id, text_hash, spans): per document with repeats, [first word, end) of windows held by smaller ids.

    ``text_hash`` tells rows of equal id and different text apart.
    """
    spark = docs.sparkSession
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    pairs = thin.mapInArrow(_anchors(window), "anchor long, doc_id long")
    shared = pairs.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
    wanted = spark.sparkContext.broadcast(bitmap(shared, "anchor", bitmap_bits))
    path = f"{shared_dir(spark).rstrip('/')}/segments-{uuid.uuid4().hex}"
    hashed = thin.withColumn("text_hash", F.xxhash64("text"))
    hashed.mapInArrow(_writer(window, wanted), _OCCURRENCES).write.option("compression", "zstd").parquet(path)
    seen = spark.read.schema(_OCCURRENCES).parquet(path)
    distinct = seen.groupBy("anchor", "segment").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.first("words").alias("words"))
    repeats = _repeats(distinct, window, shard_words, hot)
    occurrences = seen.select("anchor", "segment", "doc_id", "text_hash", "first")
    spans = occurrences.join(repeats, ["anchor", "segment"]).where("owner < doc_id").select(
        "doc_id", "text_hash", F.struct((F.col("first") + F.col("at")).alias("start"), (
            F.col("first") + F.col("at") + F.col("n") + (window - 1)).alias("end")).alias("span"))
    return spans.groupBy("doc_id", "text_hash").agg(F.collect_list("span").alias("spans"))


def _keep(n_words: int, spans) -> np.ndarray:
    edge = np.zeros(n_words + 1, dtype=np.int64)
    for s in spans or ():
        edge[s["start"]] += 1
        edge[s["end"]] -= 1
    return np.cumsum(edge[:-1]) == 0


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in chunks(batches):
        n, removed, digest = [], [], []
        for text, spans in zip(texts, piece.column("spans").to_pylist(), strict=True):
            words = text.split()
            left = words
            if spans:
                left = [w for w, k in zip(words, _keep(len(words), spans).tolist(), strict=True) if k]
            n.append(len(words))
            removed.append(len(words) - len(left))
            digest.append(hashlib.sha256(b" ".join(left)).hexdigest())
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(digest)], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _with_spans(docs: DataFrame, window: int) -> DataFrame:
    found = repeated_spans(docs, window).select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "spans")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.join(found, (own["doc_id"] == found["found_id"]) & (F.xxhash64(own["text"]) == found["found_hash"]),
                    "left").select("doc_id", "text", "spans")


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row of ``docs``."""
    return _with_spans(docs, window).mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in chunks(batches):
        kept = []
        for text, spans, null in zip(texts, piece.column("spans").to_pylist(), piece.column("text").is_null().to_pylist(),
                                     strict=True):
            if spans:
                words = text.split()
                text = b" ".join(w for w, k in zip(words, _keep(len(words), spans).tolist(), strict=True) if k)
            kept.append(None if null else text.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(kept, type=pa.string())], ["doc_id", "text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text): the texts without repeated words; a text that loses some is joined by single spaces."""
    return _with_spans(docs, window).mapInArrow(_strip, "doc_id long, text string")
