"""Plain versions of the operators, straight from their contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_AZ))


def ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def simhash(text, n=4):
    own = words((text or "").translate(_AZ))
    if not own:
        return 0
    shingles = [" ".join(own[i:i + n]) for i in range(max(1, len(own) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.get(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def components(fingerprints, bits=4):
    """Least id of each row's group; rows are (id, fingerprint)."""
    union = Union()
    for i, (_, x) in enumerate(fingerprints):
        for j in range(i):
            if (x ^ fingerprints[j][1]).bit_count() <= bits:
                union.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(fingerprints):
        if doc_id is not None:
            r = union.root(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    return [least.get(union.root(i)) for i in range(len(fingerprints))]


def repeats(docs, window):
    """Positions each (id, text) loses, by index of the row."""
    first = {}
    for doc_id, text in docs:
        own = words(text)
        for p in range(len(own) - window + 1):
            if doc_id is not None:
                key = tuple(own[p:p + window])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        own, gone = words(text), set()
        for p in range(len(own) - window + 1):
            if doc_id is not None and first[tuple(own[p:p + window])] < doc_id:
                gone.update(range(p, p + window))
        out.append(gone)
    return out


def kept_digest(text, gone):
    return hashlib.sha256(" ".join(w for k, w in enumerate(words(text)) if k not in gone).encode()).hexdigest()


def hits(docs, items, window):
    """(words, hit positions, item names) of each text."""
    of = defaultdict(set)
    for name, text in items:
        own = folded(text)
        for p in range(max(1, len(own) - window + 1) if own else 0):
            of[tuple(own[p:p + window])].add(name)
    out = []
    for text in docs:
        own, hit, names = folded(text), set(), set()
        for size in {len(k) for k in of}:
            for p in range(len(own) - size + 1):
                found = of.get(tuple(own[p:p + size]))
                if found is not None:
                    hit.update(range(p, p + size))
                    names |= found
        out.append((len(own), hit, sorted(str(n) for n in names if n is not None)))
    return out


def quality(text, limits):
    text = text or ""
    own = words(text)
    n, chars = len(own), sum(map(len, own))

    def cover(size, later):
        seen, got = Counter(), set()
        runs = [tuple(own[i:i + size]) for i in range(n - size + 1)]
        total = Counter(runs)
        for i, r in enumerate(runs):
            seen[r] += 1
            if seen[r] > 1 if later else total[r] > 1:
                got.update(range(i, i + size))
        return got

    lines = [line for line in text.split("\n") if words(line)]
    dup = [line for k, line in enumerate(lines) if line in lines[:k]]
    repeat = len(cover(3, False))
    base = n < 50 or 100 * repeat > 50 * n
    total = max(chars, 1)
    shares = {k: sum(len(own[p]) for p in cover(k, True)) / total for k in limits}
    dup_chars = sum(len(w) for line in dup for w in words(line))
    over = any(shares[k] > limits[k] for k in limits)
    bad = len(dup) > 0.5 * max(len(lines), 1) or dup_chars / total > 0.3
    return {"n_words": n, "word_chars": chars, "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(dup), "n_repeat_words": repeat, "base_failed": base, "kept": not (base or over or bad),
            "dup_line_chars": dup_chars, "max_run_share": max(shares.values())}


def normal_line(line):
    line = line.translate(_AZ)
    out = "".join("0" if "0" <= c <= "9" else c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in line)
    return " ".join(out.split())


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def meet(x, y, bits=8):
    """Fingerprints (by family, None where a line has none) of which a pair agrees in two bytes and is within ``bits``."""
    for a, b in zip(x, y, strict=True):
        if a is not None and b is not None and (a ^ b).bit_count() <= bits and sum(
                p == q for p, q in zip(a.to_bytes(8), b.to_bytes(8), strict=True)) >= 2:
            return True
    return False


def lost_lines(docs, sims_of, similarity=0.8):
    """Lines each row loses; ``docs`` are (id, text hash, text), ``sims_of`` gives a normalised line's fingerprints.

    Without ``sims_of`` all lines meet.  Rows of equal id and text are one document.
    """
    lines = []
    for doc_id, text_hash, text in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0, d[1])):
        for k, line in enumerate((text or "").split("\n")):
            own = normal_line(line)
            if own:
                lines.append(((doc_id, text_hash), k, own, sims_of(own) if sims_of else None))
    union = Union()
    for i, (_, _, x, sx) in enumerate(lines):
        for j in range(i):
            _, _, y, sy = lines[j]
            longer = max(len(x), len(y))
            if x == y or min(len(x), len(y)) >= similarity * longer - 1e-9 and (sims_of is None or meet(sx, sy)) and (
                    longer - levenshtein(x, y) >= similarity * longer - 1e-9):
                union.join(i, j)
    gone = defaultdict(set)
    for i, (doc, k, _, _) in enumerate(lines):
        if union.root(i) != i:
            gone[doc].add(k)
    return gone


def lattice(word, pieces, of_byte, logp):
    """Probability of a word over all its segmentations, by recursion."""
    text = "▁" + word

    def rest(i):
        if i == len(text):
            return 1.0
        total, alone = 0.0, False
        for j in range(i + 1, len(text) + 1):
            p = pieces.get(text[i:j])
            if p is not None:
                total += math.exp(logp[p]) * rest(j)
                alone |= j == i + 1
        if not alone:
            total += math.exp(sum(logp[of_byte[b]] for b in text[i].encode())) * rest(i + 1)
        return total

    return rest(0)
