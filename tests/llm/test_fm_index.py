"""The FM-index against plain search."""

import numpy as np

from tessera.llm.fm_index import Bits, FMIndex, Wavelet, suffix_order


def texts(n, seed):
    rng = np.random.default_rng(seed)
    for k in range(n):
        sigma = int(rng.integers(2, 7))
        runs = [rng.integers(1, sigma, rng.integers(0, 15)) for _ in range(rng.integers(1, 8))]
        if k % 3 == 0:
            runs += [runs[0].copy() for _ in range(3)]
        yield rng, sigma, np.concatenate([np.append(r, 0) for r in runs])


def test_bits_and_wavelet_ranks():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, 1000)
    at = np.arange(1001)
    assert (Bits(bits).rank(at) == np.concatenate(([0], np.cumsum(bits)))).all()
    codes = rng.integers(0, 11, 500)
    tree = Wavelet(codes, 11)
    assert (tree.access(np.arange(500)) == codes).all()
    for c in range(11):
        assert (tree.rank(np.full(501, c), np.arange(501)) == np.concatenate(([0], np.cumsum(codes == c)))).all()


def test_suffixes_and_search():
    for rng, sigma, text in texts(150, 1):
        seps = np.flatnonzero(text == 0)
        rank = text + len(seps) - 1
        rank[seps] = np.arange(len(seps))
        want = sorted(range(len(text)), key=lambda i: rank[i:].tolist())  # noqa: B023
        assert suffix_order(text).tolist() == want
        index = FMIndex(text, sigma, every=4)
        assert index.locate(np.arange(len(text))).tolist() == want
        phrases = [rng.integers(1, sigma, rng.integers(1, 6)) for _ in range(8)]
        codes = np.zeros((8, 6), dtype=np.int64)
        for row, p in zip(codes, phrases, strict=True):
            row[:len(p)] = p
        lo, hi = index.search(codes, np.array([len(p) for p in phrases]))
        for k, p in enumerate(phrases):
            found = [j for j in range(len(text) - len(p) + 1) if (text[j:j + len(p)] == p).all()]
            assert sorted(index.locate(np.arange(lo[k], max(lo[k], hi[k]))).tolist()) == found
