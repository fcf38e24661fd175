"""Operator 1 - best-fit packing by bin completion.

1. Tasks tokenize the texts; a document is its ids and then id 0.  One longer than a
   sequence is cut into full pieces, the first of which may be shorter.
2. Pieces are counted by length: at most ``capacity`` counts, whatever the corpus.
   ``bin_completion`` turns the counts into patterns (a filling, and how many
   sequences get it).  Only these counts and patterns pass through the driver.
3. Every piece gets its rank among the pieces of its length, and the rank names its
   pattern, sequence and offset by arithmetic.  Ranks are counted within hash buckets
   and shifted by the buckets' running totals, so a length that a third of all
   pieces share is spread over all tasks.

Edge cases: null and empty texts are one piece of the single id 0; repeated rows are
packed once for each row; a null id is kept as null; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bin_completion import Pattern, bin_completion
from .common import chunks, cut

CAPACITY, VOCABULARY, END_ID = 2048, "byte_bpe_50k", 0
#: Pieces counted together; the number of buckets follows from the number of pieces.
BUCKET_ROWS = 20_000


def encoder(vocabulary: str = VOCABULARY) -> Callable[[str], list[int]]:
    """Text to ids of a public byte-level vocabulary.

    The ranks file of the vocabulary is read, which gives the ids of ``<vocabulary>.json``
    several times faster; a text it cannot take goes to the tokenizer of the .json file.
    Strings that look like special tokens are ordinary text.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def slow(text: str) -> list[int]:
        whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        whole.encode_special_tokens = True
        return whole.encode(text, add_special_tokens=False).ids

    def encode(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except (KeyboardInterrupt, SystemExit, MemoryError):
            raise
        except BaseException:  # noqa: BLE001 - a panic of the fast tokenizer's pattern matcher
            return slow(text)
    return encode


def _piecer(capacity: int, vocabulary: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for piece, texts in chunks(batches):
            encode = encode or encoder(vocabulary)
            rows = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.array([*encode(text.decode("utf-8", "replace")), END_ID], dtype="<u4")
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows["doc_id"].append(doc_id)
                    rows["piece"].append(k)
                    rows["start"].append(s)
                    rows["length"].append(e - s)
                    rows["ids_crc32"].append(zlib.crc32(ids[s:e].tobytes()))
                    if with_ids:
                        rows["ids"].append(ids[s:e].astype(np.int32))
            if not with_ids:
                del rows["ids"]
            kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays([pa.array(v, type=kinds.get(c, pa.int64())) for c, v in rows.items()],
                                             list(rows))
    return run


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY,
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids, cut to the capacity."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        _piecer(capacity, vocabulary, with_ids), schema)


class _Slots:
    """Where the r-th piece of each length goes."""

    def __init__(self, patterns: list[Pattern], capacity: int):
        rows, used, first = [], [0] * (capacity + 1), 0
        for times, bin_ in patterns:
            offset = 0
            for length in sorted(set(bin_), reverse=True):
                copies = bin_.count(length)
                rows.append((length, used[length], copies, first, offset))
                used[length] += copies * times
                offset += copies * length
            first += times
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 5)
        self.length, self.begin, self.copies, self.first, self.offset = table.T
        self.of_length = np.searchsorted(self.length, np.arange(capacity + 2))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = np.empty(len(length), dtype=np.int64)
        for x in np.unique(length):
            lo, hi = self.of_length[x], self.of_length[x + 1]
            at = length == x
            slot[at] = lo + np.searchsorted(self.begin[lo:hi], rank[at], side="right") - 1
        nth = rank - self.begin[slot]
        copies = self.copies[slot]
        return self.first[slot] + nth // copies, self.offset[slot] + nth % copies * length


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` with ``sequence_id`` and ``offset``; it needs doc_id, piece and length up to ``capacity``.

    All its columns are carried along, so ids or text can travel with their piece.
    """
    names = cut_pieces.columns
    held = cut(cut_pieces)
    buckets = max(1, held.count() // BUCKET_ROWS)
    dealt = held.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = cut(dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n")))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("_n")).collect():  # at most ``capacity`` rows
        histogram[length] = n
    slots = _Slots(bin_completion(histogram, capacity), capacity)
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    among = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = dealt.withColumn("_rank", F.row_number().over(among) - 1).join(base, ["length", "_bucket"]).withColumn(
        "_rank", F.col("_rank") + F.col("_before")).select(*names, "_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "_rank"))
            sequence, offset = slots.place(length, rank)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence),
                                              pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = held.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the sequences themselves, from packed pieces that carry ``ids``."""
    in_place = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` ids
    return packed.groupBy("sequence_id").agg(F.flatten(in_place["ids"]).alias("ids"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY,
                   with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack ``docs``: one row per piece."""
    return pack(pieces(docs, capacity, vocabulary, with_ids), capacity)
