"""Operator 4 - SimHash near-duplicates found by pigeonring filtering.

1. A task makes each document's 64-bit fingerprint from the XXH64 of its shingles.
2. Equal fingerprints fall together, with their smallest id.
3. Pigeonring: the fingerprint is a ring of ``SEGMENTS`` segments.  If two of them
   differ in at most ``bits`` bits, then from some segment on, every chain of l
   segments differs in at most floor(l * bits / SEGMENTS) bits.  The first two links
   of that chain make the join key: one segment equal, the next at most one bit off,
   looked up on one side only (a set bit is cleared).  The longer chains are checked
   in the group, before the full distance.
4. Groups give spanning forests (see ``hamming``), star contraction the components.

Edge cases: a text without words (or null) has fingerprint zero and links like any
other; fewer words than a shingle make one shingle; repeated rows share a fingerprint;
a null id never becomes a component's name unless all its ids are null; an empty
table gives an empty result; other columns are ignored, or kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, chunks, cut
from .components import components
from .hamming import forest

SHINGLE, BITS, SEGMENTS = 4, 4, 5


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of one text."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(line, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    first = np.concatenate(([0], ends[:-shingle])).tolist()
    hashes = np.fromiter((xxh64_intdigest(line[s:e], 42) for s, e in zip(first, (ends[shingle - 1:] - 1).tolist(),
                                                                          strict=True)),
                         dtype=np.uint64, count=len(first))
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprinter(shingle: int, own: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in chunks(batches):
            fp = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(fp.view(np.int64)), *map(piece.column, own)],
                                             ["doc_id", "fp", *own])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, own: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, with the long columns ``own``."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text", *own).mapInArrow(
        _fingerprinter(shingle, list(own)), "doc_id long, fp long" + "".join(f", {c} long" for c in own))


def _layout(segments: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each segment, as even as can be."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def pigeonring(bits: int = BITS, segments: int = SEGMENTS):
    """Check of the chain from the key's segment, then of all 64 bits."""
    masks = np.array([((1 << w) - 1) << lo for lo, w in _layout(segments)], dtype=np.uint64)

    def match(key, x, y):
        diff = np.bitwise_count((x ^ y)[..., None] & masks).astype(np.int64)
        start = (key >> 32).astype(np.int64)
        chain = np.take_along_axis(diff, (start[:, None] + np.arange(segments)) % segments, axis=1)
        budget = np.arange(1, segments + 1) * bits // segments
        return (np.cumsum(chain, axis=1) <= budget).all(axis=1)
    return match


def ring_keys(nodes: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """(key, node, home): a home key per chain start, and one key per set bit of the chain's second segment."""
    layout = _layout(segments)

    def segment(i):
        lo, width = layout[i]
        return F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << width) - 1))

    made = []
    for i in range(segments):
        j = (i + 1) % segments
        base = F.lit(i << 32).bitwiseOR(F.shiftleft(segment(i), 16))
        made.append(F.struct(base.bitwiseOR(segment(j)).alias("key"), F.lit(True).alias("home")))
        for k in range(layout[j][1]):
            bit = F.lit(1 << k)
            off = F.when(segment(j).bitwiseAND(bit) != 0,
                         F.struct(base.bitwiseOR(segment(j).bitwiseXOR(bit)).alias("key"), F.lit(False).alias("home")))
            made.append(off)
    return nodes.select(F.col("fp").alias("node"), F.explode(F.array_compact(F.array(*made))).alias("k")).select(
        "k.key", "node", "k.home")


def _named(docs: DataFrame, shingle: int, bits: int, segments: int, own: list[str]) -> DataFrame:
    if segments <= bits:
        raise ValueError("the ring needs more segments than differing bits")
    fps = cut(fingerprints(docs, shingle, own))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = cut(components(forest(ring_keys(distinct, segments), pigeonring(bits, segments))))
    grouped = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.select("fp", "root").join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``segments`` must exceed ``bits``; a key holds two segments, 128 / segments bits.
    """
    return _named(docs, shingle, bits, segments, []).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each group.

    A document is known by its id and text.  A repeated row is the same document and stays as often as it came; a row
    without id stays.  Where rows of one id have different texts, each is judged by its own, and those of
    one group that share the least id all stay.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_text_hash"))
    found = _named(keyed, shingle, bits, SEGMENTS, ["_text_hash"])
    gone = found.where("doc_id != component_id").select(
        F.col("doc_id").alias("gone"), F.col("_text_hash").alias("gone_hash")).distinct()
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["gone"]) & (
        F.xxhash64(docs["text"]) == gone["gone_hash"]), "left_anti")
