"""Operator 9 - quality rules by repetition coverage.

Every text is read as bytes.  Words, lines and runs of words get 64-bit rolling
hashes in numpy; each later copy of a run of n words in one text covers the words it
spans, and the characters of covered words are measured against the characters of
all words, for several n.  Repeated lines are measured likewise.  The first copy is
not counted, so a text with one line given twice stays well under the limits.

One pass over the rows, no shuffle: a document is judged by its own text alone.

Edge cases: a null or empty text has no words, counts 0 and fails the base rule;
a text shorter than a window has no such window; rows of equal id or text are judged
one by one; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, covered, joined, mix, span_hashes, window_hashes, word_spans

#: Largest share of characters inside later copies of runs of n words, by n (fixed values).
RUN_LIMITS = {5: 0.30, 6: 0.29, 7: 0.28, 8: 0.27, 9: 0.26, 10: 0.25}
#: Largest share of lines, and of characters, in lines equal to an earlier one (fixed values).
LINE_LIMIT, LINE_CHAR_LIMIT = 0.50, 0.30
MIN_WORDS, BASE_RUN, MAX_REPEAT_PERCENT = 50, 3, 50
SYMBOLS = b"#*$%&|<>"

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, dup_line_chars long, max_run_share double, reason string")


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries have an equal elsewhere."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    hit = np.zeros(len(keys), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return hit


def _later(keys: np.ndarray) -> np.ndarray:
    """Which entries equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    hit = np.zeros(len(keys), dtype=bool)
    hit[order[1:][s[1:] == s[:-1]]] = True
    return hit


def measure(texts: list[bytes], run_limits: dict[int, float] = RUN_LIMITS) -> dict[str, np.ndarray]:
    """Counts and verdict of each text."""
    n_docs = len(texts)
    data, begins = joined(texts)
    starts, ends = word_spans(data)
    doc = np.searchsorted(begins, starts, side="right") - 1
    chars_before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = chars_before[ends] - chars_before[starts]
    salt = mix(np.arange(n_docs, dtype=np.uint64) + np.uint64(1))
    words = span_hashes(data, starts, ends)

    def per_doc(values, at=doc):
        return np.bincount(at, weights=values, minlength=n_docs).astype(np.int64)

    n_words, word_chars = per_doc(np.ones(len(doc))), per_doc(chars)
    is_symbol = np.zeros(256, dtype=bool)
    is_symbol[list(SYMBOLS)] = True
    symbols_before = np.concatenate(([0], np.cumsum(is_symbol[data])))
    n_symbols = symbols_before[begins[1:]] - symbols_before[begins[:-1]]

    line_ends = np.flatnonzero(data == 0x0A)
    line_starts = np.concatenate(([0], line_ends[:-1] + 1)) if len(line_ends) else line_ends
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_doc = np.searchsorted(begins, line_starts, side="right") - 1
    again = _later(mix(span_hashes(data, line_starts, line_ends) ^ salt[line_doc]))
    word_before = np.concatenate(([0], np.cumsum(chars)))
    line_chars = word_before[np.searchsorted(starts, line_ends)] - word_before[np.searchsorted(starts, line_starts)]
    n_lines, n_dup = per_doc(np.ones(len(line_doc)), line_doc), per_doc(again, line_doc)
    dup_chars = per_doc(again * line_chars, line_doc)

    def run_cover(length, which):
        h = window_hashes(words, length)
        at = np.flatnonzero(doc[:len(h)] == doc[length - 1:]) if len(h) else np.zeros(0, dtype=np.int64)
        rep = at[which(mix(h[at]) ^ salt[doc[at]])]
        return covered(rep, length, len(words))

    n_repeat = per_doc(run_cover(BASE_RUN, _repeated))
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    total = np.maximum(word_chars, 1)
    worst, over = np.zeros(n_docs), np.zeros(n_docs, dtype=bool)
    for length, limit in run_limits.items():
        share = per_doc(run_cover(length, _later) * chars) / total
        worst = np.maximum(worst, share)
        over |= share > limit
    lines_bad = (n_dup > LINE_LIMIT * np.maximum(n_lines, 1)) | (dup_chars / total > LINE_CHAR_LIMIT)
    reason = np.where(base_failed, "base", np.where(over, "runs", np.where(lines_bad, "lines", "")))
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
            "n_repeat_words": n_repeat, "base_failed": base_failed, "kept": ~(base_failed | over | lines_bad),
            "dup_line_chars": dup_chars, "max_run_share": worst, "reason": reason.astype(object)}


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in chunks(batches):
        out = measure(texts)
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, out.values())], ["doc_id", *out])


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict per document (``SCHEMA``)."""
    thin = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return thin.mapInArrow(_judge, SCHEMA)


def _filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in chunks(batches):
        yield piece.filter(pa.array(measure(texts)["kept"]))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is ``kept``, with all their columns (judged where they are read)."""
    return docs.mapInArrow(_filter, docs.schema)
