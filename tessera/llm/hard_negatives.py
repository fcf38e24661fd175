"""Operator 11 - hard negatives by exact integer products of anchor and candidate tiles.

1. A component x becomes floor(256 x).  Rows with a null label, a null vector or a null or
   non-finite component take no part.  Anchors are the rows whose id ``ANCHOR_EVERY`` divides.
2. Candidates are dealt out by their place in the table, anchors likewise, into blocks of
   bounded size; a cell is one block of each.  In a cell, tiles of anchors and candidates are
   multiplied by Strassen's recursion (``product``), in 64-bit integers throughout.
3. First pass: anchors meet the candidates of their label, and a heap for each anchor keeps
   its best ``POSITIVES``.  Second pass: each (anchor, positive) has a heap for the rows of
   other labels whose score lies in the positive's window.  The heaps of all cells are merged by
   Spark; a heap holds at most ``POSITIVES`` or ``NEGATIVES`` rows, so the shuffle is small.

Every anchor is compared with every row (in the first pass: of its label), in blocks; no pair
is emitted but those in a heap.

Edge cases: vectors of different lengths are padded with zeros; a candidate is another row if
its id is another; a row given several times counts as often as a candidate, and once as an
anchor; an anchor id with several different rows has the results of each; a null id comes
after all others and is never an anchor; labels of any number; with no row or no positive
there is no result; other columns are ignored.  Scores are 64-bit integers: they are exact
while no sum of products reaches 2**63.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, group_bounds, parts

SCALE, ANCHOR_EVERY, POSITIVES, NEGATIVES = 256, 100, 5, 5
#: A negative's score is at least this part (of 5) of the positive's, and at most all of it.
WINDOW = (4, 5)
#: Rows of a block, and of a tile.
CELL_CANDIDATES, CELL_ANCHORS = 1 << 15, 1 << 14
TILE_CANDIDATES, TILE_ANCHORS = 1024, 512
#: Sides at which the recursion ends: where a product in doubles is proven exact, and where it is not.
EXACT_LEAF, INTEGER_LEAF = 32, 16

#: Stands for a null id, after all others.
_NO_ID = np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices by Strassen's seven products, padded with zeros to halves at every level.

    A leaf goes through doubles only where no sum in it can reach 2**53, so it is exact; else it is an integer product.
    """
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if not m or not k or not n:
        return np.zeros((m, n), dtype=np.int64)

    def depth(leaf: int) -> int:
        return max(0, (min(m, k, n) - 1) // leaf).bit_length()

    largest = [max(int(x.max()), -int(x.min())) for x in (a, b)]
    levels = depth(EXACT_LEAF)
    # a sum of two blocks at each level can double what is in them
    exact = (largest[0] << levels) * (largest[1] << levels) * -(-k // (1 << levels)) < 1 << 53
    if not exact:
        levels = depth(INTEGER_LEAF)
    side = 1 << levels
    wide = [-(-x // side) * side for x in (m, k, n)]
    left, right = np.zeros((wide[0], wide[1]), dtype=np.int64), np.zeros((wide[1], wide[2]), dtype=np.int64)
    left[:m, :k], right[:k, :n] = a, b
    return _strassen(left, right, levels, exact)[:m, :n]


def _strassen(a: np.ndarray, b: np.ndarray, levels: int, exact: bool) -> np.ndarray:
    if not levels:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64) if exact else a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    c11, c12, c21, c22 = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]

    def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return _strassen(x, y, levels - 1, exact)

    c11[...] = c22[...] = times(a11 + a22, b11 + b22)
    p = times(a21 + a22, b11)
    c21[...] = p
    c22 -= p
    p = times(a11, b12 - b22)
    c12[...] = p
    c22 += p
    p = times(a22, b21 - b11)
    c11 += p
    c21 += p
    p = times(a11 + a12, b22)
    c11 -= p
    c12 += p
    c22 += times(a21 - a11, b11 + b12)
    c11 += times(a12 - a22, b21 + b22)
    return out


class Heaps:
    """For each of ``n`` slots the ``size`` rows of highest score, of equal ones those of least id."""

    def __init__(self, n: int, size: int):
        self.size, self.least = size, np.full(n, _LEAST, dtype=np.int64)
        self.slot, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def push(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """Rows below a full heap's least score (``least``) need not be offered."""
        if not len(slot):
            return
        slot, score, ident = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ident)))
        order = np.lexsort((ident, ~score, slot))  # ~ turns the order of scores round without overflow
        slot, score, ident = slot[order], score[order], ident[order]
        bounds = group_bounds(slot)
        nth = np.arange(len(slot)) - np.repeat(bounds[:-1], np.diff(bounds))
        last = nth == self.size - 1
        self.least[slot[last]] = score[last]
        stay = nth < self.size
        self.slot, self.score, self.id = slot[stay], score[stay], ident[stay]


class _Rows:
    """Rows of a block, by label and id."""

    def __init__(self, table: pa.Table):
        def ints(name: str, default: int = 0) -> np.ndarray:
            return table.column(name).combine_chunks().fill_null(default).to_numpy(zero_copy_only=False)

        vectors = table.column("vec").combine_chunks()
        sizes = np.asarray(vectors.value_lengths(), dtype=np.int64)
        self.matrix = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
        at = np.repeat(np.arange(len(sizes)), sizes)
        self.matrix[at, np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.asarray(vectors.flatten())
        self.label, self.id = ints("label"), ints("vec_id", _NO_ID)
        order = np.lexsort((self.id, self.label))
        self.table = table.take(pa.array(order))
        self.matrix, self.label, self.id = self.matrix[order], self.label[order], self.id[order]

    def widen(self, width: int) -> None:
        self.matrix = np.pad(self.matrix, ((0, 0), (0, width - self.matrix.shape[1])))


def _tiles(anchors: _Rows, candidates: _Rows, by_label: bool):
    """(first anchor, first candidate, scores) of each pair of tiles; ``by_label``: within one label only."""
    width = max(anchors.matrix.shape[1], candidates.matrix.shape[1])
    anchors.widen(width)
    candidates.widen(width)
    if by_label:
        a_at, c_at = group_bounds(anchors.label), group_bounds(candidates.label)
        _, a, c = np.intersect1d(anchors.label[a_at[:-1]], candidates.label[c_at[:-1]], return_indices=True)
        blocks = [(a_at[i], a_at[i + 1], c_at[j], c_at[j + 1]) for i, j in zip(a.tolist(), c.tolist(), strict=True)]
    else:
        blocks = [(0, len(anchors.label), 0, len(candidates.label))]
    for a0, a1, c0, c1 in blocks:
        for c in range(int(c0), int(c1), TILE_CANDIDATES):
            right = candidates.matrix[c:min(c + TILE_CANDIDATES, c1)].T
            for a in range(int(a0), int(a1), TILE_ANCHORS):
                yield a, c, product(anchors.matrix[a:min(a + TILE_ANCHORS, a1)], right)


def _result(columns: dict[str, np.ndarray], ident: str) -> pa.Table:
    no_id = columns[ident] == _NO_ID
    return pa.table({c: pa.array(v, mask=no_id if c == ident else None) for c, v in columns.items()})


def _find_positives(size: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, candidates = _Rows(left), _Rows(right)
        heaps = Heaps(len(anchors.id), size)
        if len(anchors.id) and len(candidates.id):
            for a, c, scores in _tiles(anchors, candidates, by_label=True):
                least, own = heaps.least[a:a + len(scores)], anchors.id[a:a + len(scores)]
                ids = candidates.id[c:c + scores.shape[1]]
                row, column = np.nonzero((scores >= least[:, None]) & (own[:, None] != ids))
                heaps.push(row + a, scores[row, column], ids[column])
        key = anchors.table.column("key").to_numpy()
        return _result({"key": key[heaps.slot], "id": heaps.id, "score": heaps.score}, "id")
    return run


def _find_negatives(size: int, window: tuple[int, int]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, candidates = _Rows(left), _Rows(right)
        scores_of = anchors.table.column("positives").to_pylist()
        most = max(map(len, scores_of), default=0)
        # a place without a positive gets the window from 0 down to -1, which holds nothing
        high = np.array([[*p, *[-1] * (most - len(p))] for p in scores_of], dtype=np.int64).reshape(len(scores_of), most)
        low = -((-high) * window[0] // window[1])
        heaps = Heaps(len(scores_of) * most, size)
        if most and len(candidates.id):
            for a, c, scores in _tiles(anchors, candidates, by_label=False):
                rows = slice(a, a + len(scores))
                ids, labels = candidates.id[c:c + scores.shape[1]], candidates.label[c:c + scores.shape[1]]
                may = (scores >= low[rows].min(axis=1)[:, None]) & (scores <= high[rows].max(axis=1)[:, None])
                may &= anchors.label[rows][:, None] != labels
                may &= anchors.id[rows][:, None] != ids
                row, column = np.nonzero(may)
                found, ident = scores[row, column], ids[column]
                row += a
                for j in range(most):
                    own = (found <= high[row, j]) & (found >= low[row, j]) & (found >= heaps.least[row * most + j])
                    heaps.push(row[own] * most + j, found[own], ident[own])
        key = anchors.table.column("key").to_numpy()
        place = heaps.slot // max(most, 1)
        return _result({"key": key[place], "nth": heaps.slot % max(most, 1), "id": heaps.id, "score": heaps.score}, "id")
    return run


def _best(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The merged heaps: ``found`` with ``rank`` from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def integer_rows(embeddings: DataFrame, scale: int = SCALE, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vec): the rows that take part, with components floor(scale x)."""
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                            F.col(vector).alias("vec"))
    usable = F.col("label").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", finite)
    return own.where(usable).withColumn(
        "vec", F.transform("vec", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def mine(rows: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, cell_candidates: int = CELL_CANDIDATES,
         cell_anchors: int = CELL_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``integer_rows``.

    ``rank`` counts an (anchor, positive)'s negatives from 1; a positive without negatives has no row.
    """
    spark = rows.sparkSession
    held = cut(rows.withColumn("place", F.monotonically_increasing_id()))
    n = held.count()
    blocks = max(1, -(-n // cell_candidates), min(2 * parts(spark), n // TILE_CANDIDATES))
    anchors = held.where(F.col("vec_id") % anchor_every == 0).withColumn(
        "key", F.xxhash64("vec_id", "label", "vec")).drop("place").dropDuplicates(["key"])
    anchors = cut(anchors.withColumn("group", F.lit(0)))
    groups = max(1, -(-anchors.count() // cell_anchors))
    group = F.pmod(F.xxhash64("key"), F.lit(groups))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # rows go to blocks by place, so rows of one id or label are spread
    dealt = held.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks))).withColumn(
        "group", every(groups)).select((F.col("block") * groups + F.col("group")).alias("cell"), "vec_id", "label", "vec")

    def meet(own: DataFrame, run, schema: str) -> DataFrame:
        spread = own.withColumn("group", group).withColumn("block", every(blocks)).withColumn(
            "cell", F.col("block") * groups + F.col("group")).drop("block", "group")
        return spread.groupBy("cell").cogroup(dealt.groupBy("cell")).applyInArrow(run, schema)

    found = meet(anchors, _find_positives(positives), "key long, id long, score long")
    chosen = F.sort_array(F.collect_list(F.struct("rank", "id", "score")))  # at most ``positives``
    best = _best(found, ["key"], positives).groupBy("key").agg(chosen.alias("chosen"))
    armed = cut(anchors.join(best, "key").withColumn("positives", F.col("chosen.score")))
    near = meet(armed.select("key", "vec_id", "label", "vec", "positives"), _find_negatives(negatives, window),
                "key long, nth long, id long, score long")
    ranked = _best(near, ["key", "nth"], negatives).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    positive = F.element_at("chosen", (F.col("nth") + 1).cast("int"))
    return ranked.join(armed.select("key", F.col("vec_id").alias("anchor_id"), "chosen"), "key").select(
        "anchor_id", positive["id"].alias("positive_id"), "rank", "negative_id", positive["score"].alias("positive_score"),
        "negative_score")
