"""Operator 12 - token counts at every prefix, by dynamic programming.

The vocabulary is a byte-pair one with word ends (``word_bpe_49k.json``).  A text falls into
pieces (a run of letters, one digit, a run of marks, an English contraction), and a piece is
encoded for itself.  Within a piece:

1. ``last[p]`` is the last token of the piece's first p bytes.  A byte-pair encoding is the
   only sequence of tokens in which every two neighbours stand unmerged, so of the tokens
   that end at p just one goes with ``last`` at its own begin; that is one step of the
   recursion, and no prefix is ever encoded again.
2. The count of a prefix that ends at p takes one more step with the tokens that end a word.
3. Neighbours are tested on the merges along their common border (``_Merges.side_by_side``).

Pieces come back often: their tables are kept by worker (``KEPT_PIECES`` of them) and joined to
the table of a text, one count for each of its code points.  ``prefix_counts`` returns it,
and ``tokens_before`` and ``longest_prefix`` answer from it how many tokens a prefix has and
how much of a text a budget holds, for any number of positions and budgets.

A prefix has the count that the library gives for the prefix as a text of its own: with its
own normal form, with a cut contraction as a mark and letters, and with a cut special string
as ordinary marks; a whole special string is one token, as the library has it by default.

Edge cases: null and empty texts have no tokens; a text of any length is taken whole; every
row gets a row, repeated ones too; a null id is kept; an empty table gives an empty result;
other columns are ignored.  The number of tokens may fall where a prefix grows, and
``longest_prefix`` is the last that fits.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks

VOCABULARY, LIMIT = "word_bpe_49k", 2048
#: What a worker keeps of pieces' tables, of prefixes up to ``SHARED_BYTES`` and of pairs of tokens; it only saves time.
KEPT_PIECES, KEPT_PREFIXES, SHARED_BYTES, KEPT_PAIRS = 150_000, 150_000, 24, 1 << 20
_NEVER = 1 << 60
_END = "</w>"

_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: A piece and the space before it, or any other white space; and the same with classes that are faster to match.
_PIECES = regex.compile(r" ?(?:\p{L}++|'(?:s|t|re|ve|m|ll|d)|\p{N}|[^\s\p{L}\p{N}]++)|\s++")
_FAST_PIECES = re.compile(r" ?(?:[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\w\s]|_)+)|\s+")
_SPACES = regex.compile(r"\s+")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next from 256."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Merges:
    """The merges of a vocabulary, and which tokens can stand side by side."""

    def __init__(self, merges: list[list[str]]):
        byte = _byte_letters()

        def spelled(token: str) -> tuple[bytes, bool]:
            ends = token.endswith(_END)
            return bytes(byte[c] for c in (token[:-len(_END)] if ends else token)), ends

        self.code = {(bytes([b]), ends): b + 256 * ends for ends in (False, True) for b in range(256)}
        #: For each token, what stands at its left and right border while it grows, and the merge that ends that.
        self.left: list[list[tuple[int, int]]] = [[(k, _NEVER)] for k in range(512)]
        self.right: list[list[tuple[int, int]]] = [[(k, _NEVER)] for k in range(512)]
        self.rank: dict[tuple[int, int], int] = {}
        whole = [True] * 512
        pairs = []
        for rank, (a, b) in enumerate(merges):
            (x, _), (y, ends) = spelled(a), spelled(b)
            left, right = self.code[x, False], self.code[y, ends]
            self.code[x + y, ends] = len(self.left)
            self.rank[left, right] = rank
            pairs.append((left, right))
            self.left.append([(len(self.left), _NEVER), (left, rank), *self.left[left][1:]])
            self.right.append([(len(self.right), _NEVER), (right, rank), *self.right[right][1:]])
        for rank, (left, right) in enumerate(pairs):  # a token that its own bytes do not give is never used
            whole.append(whole[left] and whole[right] and self.side_by_side(left, right, rank))
        self.inner = {word: k for (word, ends), k in self.code.items() if whole[k] and not ends}
        self.final = {word: k for (word, ends), k in self.code.items() if whole[k] and ends}
        self.longest = max(len(word) for word, _ in self.code)
        self._known: dict[int, bool] = {}
        self._states = _Kept(KEPT_PREFIXES)

    def side_by_side(self, a: int, b: int, until: int = _NEVER) -> bool:
        """No merge across the border of ``a`` and ``b`` comes (before merge ``until``) while both its parts are there.

        Of two equal merges the left one comes first.
        """
        rank = self.rank
        for x, x_ends in self.right[a]:
            for y, y_ends in self.left[b]:
                r = rank.get((x, y))
                if r is not None and r < until and r < x_ends and r <= y_ends:
                    return False
        return True

    def _step(self, data: bytes, p: int, last: list[int], ends: dict[bytes, int]) -> tuple[int, int]:
        """The token of ``ends`` that ends ``data[:p]`` and goes with what stands before it, and where it begins."""
        if p <= self.longest:
            token = ends.get(data[:p])
            if token is not None:  # these tokens are what their own bytes give
                return token, 0
        known = self._known
        for begin in range(p - 1, max(0, p - 1 - self.longest), -1):
            token = ends.get(data[begin:p])
            if token is None:
                continue
            pair = last[begin] << 20 | token
            fits = known.get(pair)
            if fits is None:
                if len(known) >= KEPT_PAIRS:
                    known.clear()
                fits = known[pair] = self.side_by_side(last[begin], token)
            if fits:
                break
        return token, begin

    def counts(self, word: str) -> list[int]:
        """Tokens of each prefix of ``word``, by code points; words that begin alike share the steps of their beginning."""
        data = word.encode("utf-8", "surrogatepass")
        states, last, count, out = self._states, [-1], [0], []
        recent, inner, final, size, step = states.new.get, self.inner, self.final, len(data), self._step
        for p in range(1, min(size, SHARED_BYTES) + 1):
            prefix = data[:p]
            state = recent(prefix) or states.get(prefix)
            if state is None:
                token, begin = step(data, p, last, inner)
                whole = p == size or data[p] & 0xC0 != 0x80  # not inside a code point
                state = token, count[begin] + 1, count[step(data, p, last, final)[1]] + 1 if whole else 0
                states.put(prefix, state)
                recent = states.new.get
            token, n, ended = state
            last.append(token)
            count.append(n)
            if ended:
                out.append(ended)
        for p in range(SHARED_BYTES + 1, size + 1):
            if p < size:
                token, begin = step(data, p, last, inner)
                last.append(token)
                count.append(count[begin] + 1)
            if p == size or data[p] & 0xC0 != 0x80:
                out.append(count[step(data, p, last, final)[1]] + 1)
        return out


class _Kept:
    """What was looked up lately: two tables, of which the older one goes when the newer one is full."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value


def _kind(c: str) -> int:
    """0: both patterns take ``c`` alike; 1: only ``_PIECES`` knows it; 2: Unicode versions may differ on it."""
    if unicodedata.category(c) == "Cn" or c == "İ":  # a capital of two small letters
        return 2
    slow = next(k for k, p in enumerate((r"\p{L}", r"\p{N}", r"\s", r".")) if regex.match(p, c, regex.S))
    fast = next(k for k, p in enumerate((r"[^\W\d_]", r"\d", r"\s", r".")) if re.match(p, c, re.S))
    return int(slow != fast)


class PrefixCounter:
    """Token counts of all prefixes of a text."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = public_tokenizers.path(f"{vocabulary}.json")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"].get("end_of_word_suffix") != _END:
            raise ValueError(f"{vocabulary} has no word ends")
        self.merges = _Merges([m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]])
        self.specials = re.compile("(" + "|".join(re.escape(t["content"]) for t in spec["added_tokens"]) + ")")
        self.library = Tokenizer.from_file(path)
        self._tables = _Kept(KEPT_PIECES)
        self._kinds: dict[str, int] = {}

    def _table(self, piece: str) -> bytes:
        """Counts of a piece's prefixes as 32-bit integers; a space before it counts nothing."""
        body = piece.lstrip(" ")
        if not body or not body[0].isalnum() and _SPACES.match(body):
            own = []
        elif body in _CONTRACTIONS:  # cut, it is a mark and letters
            own = [1, *(1 + k for k in self.merges.counts(body[1:-1])), self.merges.counts(body)[-1]]
        else:
            own = self.merges.counts(body)
        return array("i", [0] * (len(piece) - len(own)) + own).tobytes()

    def _joined(self, pieces: list[str], sizes: np.ndarray) -> np.ndarray:
        tables = self._tables
        own = list(map(tables.new.get, pieces))
        if None in own:
            for k in [k for k, table in enumerate(own) if table is None]:
                table = tables.get(pieces[k])
                if table is None:
                    tables.put(pieces[k], table := self._table(pieces[k]))
                own[k] = table
        counts = np.frombuffer(b"".join(own), dtype=np.int32).astype(np.int64)
        ends = np.cumsum(sizes)
        each = counts[ends - 1]
        return counts + np.repeat(np.cumsum(each) - each, sizes)

    def _plain(self, text: str, lower: str, pattern) -> np.ndarray:
        """Counts of a text without special strings that is its own normal form but for capitals."""
        pieces = pattern.findall(text.replace("Σ", "σ").lower() if "Σ" in text else lower)
        return self._joined(pieces, np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))

    def _pieces(self, text: str) -> list[str]:
        """The library's pieces of normalised text, each with the white space before it."""
        out, at = [], 0
        for _, (s, e) in self.library.pre_tokenizer.pre_tokenize_str(text):
            if s > at:
                out.append(" " * (s - at))
            out.append(text[s:e])
            at = e
        return out + [" " * (len(text) - at)] * (at < len(text))

    def _composed(self, text: str) -> np.ndarray:
        """Counts of a text that normalisation changes.

        It is cut where normalisation does not reach across.  At these places the normal form
        has a prefix of its own; between them the last pieces are counted anew.
        """
        normal, nfc = self.library.normalizer.normalize_str, unicodedata.normalize
        units: list[str] = []
        for c in text:
            if units and (unicodedata.combining(c) or nfc("NFC", units[-1] + c) != nfc("NFC", units[-1]) + nfc("NFC", c)):
                units[-1] += c
            else:
                units.append(c)
        whole = [normal(u) for u in units]
        pieces = self._pieces("".join(whole))
        counts = self._joined(pieces, np.array([len(p) for p in pieces], dtype=np.int64)) if pieces else np.zeros(0, np.int64)
        begins = np.cumsum([0, *(len(p) for p in pieces)])
        text_of, ends, out = "".join(whole), np.cumsum([len(w) for w in whole]), []
        for unit, end, size in zip(units, ends.tolist(), map(len, whole), strict=True):
            begin = end - size
            for k in range(1, len(unit)):
                # a contraction may begin two pieces before
                back = int(begins[max(0, int(np.searchsorted(begins, begin)) - 2)])
                own = self._pieces(text_of[back:begin] + normal(unit[:k]))
                more = sum(int(np.frombuffer(self._table(p), dtype=np.int32)[-1]) for p in own)
                out.append(more + (int(counts[back - 1]) if back else 0))
            out.append(int(counts[end - 1]) if end else 0)
        return np.array(out, dtype=np.int64)

    def _ordinary(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int64)
        lower = text.lower()
        signs = set(lower) | set(text)
        for c in signs - self._kinds.keys():
            self._kinds[c] = _kind(c)
        kind = max(map(self._kinds.__getitem__, signs))
        if kind == 2 or not unicodedata.is_normalized("NFC", text):
            return self._composed(text)
        return self._plain(text, lower, _PIECES if kind else _FAST_PIECES)

    def counts(self, text: str) -> np.ndarray:
        """The number of tokens of each prefix of ``text``: entry k - 1 for its first k code points."""
        parts, out, before = self.specials.split(text), [], 0
        for own, special in zip(parts[::2], [*parts[1::2], None], strict=True):
            # up to its last sign a special string is ordinary text
            counts = self._ordinary(own + (special or "")[:-1])
            out.append(counts + before)
            if special is not None:
                before += (int(counts[len(own) - 1]) if own else 0) + 1
                out.append(np.array([before], dtype=np.int64))
        return np.concatenate(out)


@lru_cache(maxsize=1)
def _kept_counter(vocabulary: str) -> PrefixCounter:
    """The counter of a Python worker, with its bounded tables; the worker's next tasks go on with it."""
    return PrefixCounter(vocabulary)


def _counter(vocabulary: str, limit: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for piece, texts in chunks(batches):
            counter = counter or _kept_counter(vocabulary)
            n_tokens, fits, tables = [], [], []
            for text in texts:
                counts = counter.counts(text.decode("utf-8", "replace"))
                total = int(counts[-1]) if len(counts) else 0
                n_tokens.append(total)
                fits.append(len(counts) if total <= limit else int(np.flatnonzero(counts <= limit)[-1:].sum()
                                                                   + (counts <= limit).any()))
                if keep:
                    tables.append(counts.astype(np.int32))
            columns = {"doc_id": piece.column("doc_id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                       "n_tokens": pa.array(n_tokens, pa.int64()), "fit_chars": pa.array(fits, pa.int64())}
            if keep:
                columns["counts"] = pa.array(tables, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    return run


def prefix_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, keep: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, fit_chars[, counts]) per row of ``docs``.

    ``counts`` holds the tokens of the first 1, 2, ... code points; ``fit_chars`` is the length of the longest
    prefix of at most ``limit`` tokens.  Without ``keep`` the tables stay in their task.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, fit_chars long" + ", counts array<int>" * keep
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _counter(vocabulary, limit, keep), schema)


def tokens_before(counts: Column, position: Column) -> Column:
    """Tokens of the first ``position`` code points (0 for none, the whole text's beyond its end)."""
    inside = F.least(position, F.size(counts)).cast("int")
    return F.when(inside > 0, F.try_element_at(counts, inside)).otherwise(F.lit(0)).cast("long")


def longest_prefix(counts: Column, budget: Column) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    places = F.transform(counts, lambda n, k: F.when(n <= budget, k + 1).otherwise(F.lit(0)))
    return F.coalesce(F.array_max(places), F.lit(0)).cast("long")


def digests(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) per row of ``docs``."""
    found = prefix_counts(docs, vocabulary, limit, keep=False)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars")
