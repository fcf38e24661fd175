"""Helpers shared by the corpus operators: byte-level word spans, rolling hashes, Arrow chunking, lineage.

Texts travel through tasks as Arrow batches.  ``chunks`` cuts a batch into pieces of
a few megabytes, so the numpy arrays of a task stay small however many rows a batch
has; only a single text that is larger than a piece makes a larger one.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20

#: Multiplier of the byte hash and of the word hash; odd, so both have an inverse modulo 2**64.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
_M64 = (1 << 64) - 1

#: Bytes that separate words: space and tab to carriage return.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Byte table that lower-cases A-Z and nothing else.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share, as the session names it (set here only where it is unset)."""
    from tessera.session import ensure_checkpoint_dir

    return ensure_checkpoint_dir(spark)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hold_out(doc_id, modulus: int):
    """True where crc32 of the id as text leaves remainder 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 2, F.lit(False))


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Row ranges of each batch with about ``limit`` bytes of text, and their texts."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            piece = batch.slice(at, stop - at)
            yield piece, texts_of(piece.column(column))
            at = stop
        del batch, piece
        pa.default_memory_pool().release_unused()  # workers live on and would keep it


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BYTE_BASE**i and its inverse powers for i < n (grown by doubling, kept per process)."""
    size = 1 << max(16, int(n - 1).bit_length())
    have = next((t for s, t in _powers.items() if s >= size), None)
    if have is None:
        inverse = pow(BYTE_BASE, -1, 1 << 64)
        tables = []
        for base in (BYTE_BASE, inverse):
            step = np.full(size, base, dtype=np.uint64)
            step[0] = 1
            tables.append(np.cumprod(step, dtype=np.uint64))
        _powers.clear()
        have = _powers[size] = (tables[0], tables[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Bytes whose running hash is held at once; a longer span makes a longer part.
HASH_BYTES = 1 << 19


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes give equal hashes wherever they stand.

    Spans are in order and apart.  They are hashed part by part, so that the running
    hash (8 bytes for each byte of text) stays small.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        begin = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, begin + HASH_BYTES, side="right")))
        part = data[begin:int(ends[stop - 1])]
        up, down = _power_tables(len(part) + 1)
        prefix = np.zeros(len(part) + 1, dtype=np.uint64)
        scaled = part.astype(np.uint64)
        scaled += np.uint64(1)
        scaled *= up[:len(part)]
        np.cumsum(scaled, out=prefix[1:])
        s, e = starts[at:stop] - begin, ends[at:stop] - begin
        out[at:stop] = mix((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64))
        at = stop
    return out


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word ``[^\\x20\\x09-\\x0D]+``."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a line feed after each, and where each begins (one entry more than texts)."""
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    data = np.frombuffer(b"\n".join(texts) + b"\n" if texts else b"", dtype=np.uint8)
    return data, begins


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Rolling hash of each run of ``length`` words (one entry for each start that fits)."""
    n = max(0, len(words) - length + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(length):
        out = out * np.uint64(WORD_BASE) + words[j:j + n]
    return out


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window of ``length`` that begins at one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


def group_bounds(sorted_keys: np.ndarray) -> np.ndarray:
    """Begin of each run of equal keys, and the end of the last."""
    if len(sorted_keys) == 0:
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]))
