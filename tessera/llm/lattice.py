"""Subword lattices: marginal probability of words over all segmentations into vocabulary pieces.

A word is spelled as the word mark and its characters.  Every vocabulary piece that
matches somewhere is an arc; a character without a piece of its own is spelled by byte
pieces.  A forward recursion in log space sums over all paths, for a batch of words at
once, arc by arc end position.
"""

from __future__ import annotations

import numpy as np

MARK = "▁"


class Vocabulary:
    """Pieces of an existing tokenizer model with the scores it gives them.

    Pieces that cannot match a lower-case word are left out.  The last entry is the end
    of a text.
    """

    def __init__(self, model: str = "piece_bpe_32k.model"):
        import public_tokenizers
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        self.pieces, scores = {}, []
        self.of_byte = np.zeros(256, dtype=np.int64)
        for k in range(processor.get_piece_size()):
            piece = processor.id_to_piece(k)
            if processor.is_byte(k):
                self.of_byte[int(piece[3:5], 16)] = len(scores)
                scores.append(None)
            elif not (processor.is_control(k) or processor.is_unknown(k) or processor.is_unused(k)):
                if MARK in piece[1:] or any("A" <= c <= "Z" for c in piece) or any(
                        c in " \t\n\v\f\r" for c in piece):
                    continue
                self.pieces[piece] = len(scores)
                scores.append(processor.get_score(k))
        least = min(s for s in scores if s is not None)
        # the model's scores count merges down from 0, so weights fall off with the rank they give
        weight = np.array([1.0 / (2.0 - (least if s is None else s)) for s in [*scores, least]])
        self.end = len(scores)
        self.size = len(weight)
        self.initial = np.log(weight / weight.sum())
        self._index()

    def _index(self) -> None:
        """The pieces as a tree by characters: sorted (node, character) keys, the nodes they lead to, and a node's piece."""
        letters = {c: k for k, c in enumerate(sorted({c for piece in self.pieces for c in piece}), 1)}  # 0: in no piece
        self._letters = np.zeros(0x110000, dtype=np.int32)
        self._letters[[ord(c) for c in letters]] = list(letters.values())
        self._width = len(letters) + 1
        node_of, keys, piece_of = {"": 0}, [], [-1]
        for piece, number in self.pieces.items():
            for k in range(1, len(piece) + 1):
                if piece[:k] not in node_of:
                    node_of[piece[:k]] = len(piece_of)
                    keys.append(node_of[piece[:k - 1]] * self._width + letters[piece[k - 1]])
                    piece_of.append(-1)
            piece_of[node_of[piece]] = number
        order = np.argsort(np.array(keys, dtype=np.int64))
        self._keys, self._next = np.array(keys, dtype=np.int64)[order], order + 1
        self._piece_of = np.array(piece_of, dtype=np.int64)

    def arcs(self, words: list[bytes]):
        """(word, start, end, piece) of every match, each word's number of nodes less one, and the characters
        without a piece of their own.

        All places of all words go down the tree together, a character at a time, until none matches.
        """
        texts = [MARK + w.decode("utf-8", "replace") for w in words]
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        signs = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
        letter = self._letters[signs]
        word = np.repeat(np.arange(len(size)), size)
        first = np.cumsum(size) - size
        stop = (first + size)[word]
        at, node = np.arange(len(signs)), np.zeros(len(signs), dtype=np.int64)
        begins, ends, pieces = [at[:0]], [at[:0]], [at[:0]]
        length = 0
        while len(at):
            key = node * self._width + letter[at + length]
            k = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            hit = np.flatnonzero(self._keys[k] == key)
            at, node, length = at[hit], self._next[k[hit]], length + 1
            piece = self._piece_of[node]
            whole = np.flatnonzero(piece >= 0)
            begins.append(at[whole])
            ends.append(at[whole] + length)
            pieces.append(piece[whole])
            more = np.flatnonzero(at + length < stop[at])
            at, node = at[more], node[more]
        alone = np.ones(len(signs), dtype=bool)
        if len(begins) > 1:
            alone[begins[1]] = False
        alone = np.flatnonzero(alone)
        extra = list(zip(word[alone].tolist(), (alone - first[word[alone]]).tolist(), map(chr, signs[alone]), strict=True))
        begin, end, piece = (np.concatenate(x) for x in (begins, ends, pieces))
        own = word[begin]
        return own, begin - first[own], end - first[own], piece, size, extra


def _log_sums(values: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the sum of exponentials of each run of equal ``groups``."""
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    top = np.maximum.reduceat(values, first)
    size = np.diff(np.append(first, len(values)))
    return groups[first], top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, size)), first))


class Lattice:
    """The arcs of a batch of words, ready for the recursion in either direction."""

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]):
        self.vocabulary = vocabulary
        word, start, end, piece, self.size, extra = vocabulary.arcs(words)
        self.bytes_of = [(k, i, vocabulary.of_byte[list(c.encode())]) for k, i, c in extra]
        n = len(word)
        if extra:  # pieces from here on are spelled by bytes
            more = np.array([(k, i, i + 1, -1 - x) for x, (k, i, _) in enumerate(extra)], dtype=np.int64)
            word, start, end, piece = (np.concatenate((a, b)) for a, b in
                                       zip((word, start, end, piece), more.T, strict=True))
        self.n_pieces = n
        self.base = np.concatenate(([0], np.cumsum(self.size + 1)))
        self.piece, self.to, self.source = piece, self.base[word] + end, self.base[word] + start
        self.word, self.start = word, start
        self.by_end = self._layers(end, self.to)
        self.first, self.last = self.base[:-1], self.base[1:] - 1

    @staticmethod
    def _layers(level: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
        """Arcs of one position together, sorted by node."""
        if not len(node):
            return []
        order = np.argsort(level * (int(node.max()) + 1) + node, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(level[order])) + 1)

    def _weights(self, logp: np.ndarray) -> np.ndarray:
        w = np.where(self.piece >= 0, logp[self.piece], 0.0)
        if self.bytes_of:
            spelled = np.array([logp[b].sum() for _, _, b in self.bytes_of])
            w[self.piece < 0] = spelled[-1 - self.piece[self.piece < 0]]
        return w

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """Log probability of every node's prefix."""
        w = self._weights(logp)
        alpha = np.full(self.base[-1], -np.inf)
        alpha[self.first] = 0.0
        for arcs in self.by_end:
            node, value = _log_sums(alpha[self.source[arcs]] + w[arcs], self.to[arcs])
            alpha[node] = value
        return alpha

    def log_probability(self, logp: np.ndarray) -> np.ndarray:
        """Log probability of each word, over all its segmentations."""
        return self.forward(logp)[self.last]

    def expected(self, logp: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece if word k is seen ``counts[k]`` times."""
        w, alpha = self._weights(logp), self.forward(logp)
        beta = np.full(self.base[-1], -np.inf)
        beta[self.last] = 0.0
        for arcs in self._layers(int(self.start.max(initial=0)) - self.start, self.source):
            node, value = _log_sums(beta[self.to[arcs]] + w[arcs], self.source[arcs])
            beta[node] = value
        use = np.exp(alpha[self.source] + w + beta[self.to] - alpha[self.last][self.word]) * counts[self.word]
        real = self.piece >= 0
        out = np.bincount(self.piece[real], weights=use[real], minlength=self.vocabulary.size)
        for arc in np.flatnonzero(~real):
            np.add.at(out, self.bytes_of[-1 - self.piece[arc]][2], use[arc])
        return out


def normalised(counts: np.ndarray, smoothing: float = 0.1) -> np.ndarray:
    """Log probabilities of pieces from expected counts, none of them zero."""
    raised = counts + smoothing
    return np.log(raised / raised.sum())
