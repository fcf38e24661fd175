"""Links between 64-bit fingerprints that share a block key, without making all pairs of a group.

``forest`` gets rows (key, node[, home]): fingerprints that may link share a key.  Rows
are dealt out and sorted by key; a task walks over the groups and gives, for each, a
spanning forest of the links inside it - enough for connected components, and never
more rows than members.  A group larger than ``HOT`` is passed on instead of held:
its members are cut into blocks, and each pair of blocks becomes a group of its own,
so that one key with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, group_bounds

#: Members of a group up to which one task links them directly.
HOT = 2048

Match = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def within(bits: int) -> Match:
    """Fingerprints link at ``bits`` or fewer differing bits."""
    def match(_key, x, y):
        return np.bitwise_count(x ^ y) <= bits
    return match


def _pairs(key: np.ndarray, node: np.ndarray, home: np.ndarray, bounds: np.ndarray, match: Match):
    """Links of all groups of two, at once."""
    first = bounds[:-1][np.diff(bounds) == 2]
    ok = (home[first] | home[first + 1]) & match(key[first], node[first], node[first + 1])
    return node[first[ok]], node[first[ok] + 1]


def _grow(key: np.ndarray, node: np.ndarray, home: np.ndarray, match: Match):
    """Spanning forest of one group: each member meets only those not yet reached."""
    left = np.arange(len(node))
    a, b, todo = [], [], []
    while len(left) or todo:
        if not todo:
            todo, left = [left[0]], left[1:]
        i = todo.pop()
        if not len(left):
            break
        hit = match(key[left], node[i], node[left])
        if not home[i]:
            hit &= home[left]
        new = left[hit]
        if len(new):
            a.append(np.full(len(new), node[i]))
            b.append(node[new])
            todo.extend(new)
            left = left[~hit]
    return a, b


def _linker(match: Match, hot: int, group: str) -> Callable:
    """Links within runs of equal ``group``; rows are sorted by it."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind, k, a, b, h):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, dtype=np.int8)), pa.array(k), pa.array(a.view(np.int64)),
                 pa.array(b.view(np.int64)), pa.array(h)], ["kind", "key", "a", "b", "home"])

        def solve(g_of, k, n, h):
            bounds = group_bounds(g_of)
            size = np.diff(bounds)
            a, b = ([x] for x in _pairs(k, n, h, bounds, match))
            for g in np.flatnonzero(size > 2):
                s = slice(bounds[g], bounds[g + 1])
                if h[s].any():
                    x, y = _grow(k[s], n[s], h[s], match)
                    a += x
                    b += y
            a, b = np.concatenate(a), np.concatenate(b)
            no = np.zeros(len(a), dtype=bool)
            return out(0, np.zeros(len(a), dtype=np.int64), a, b, no)

        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))
        passing = None  # the group that is too large to hold
        for batch in batches:
            home = (np.asarray(batch.column("home").cast(pa.int8())).astype(bool) if "home" in batch.schema.names
                    else np.ones(batch.num_rows, dtype=bool))
            new = (np.asarray(batch.column(group)), np.asarray(batch.column("key")),
                   np.asarray(batch.column("node")).view(np.uint64), home)
            rows = [np.concatenate(x) for x in zip(held, new, strict=True)]
            if passing is not None:
                other = rows[0] != passing
                upto = int(other.argmax()) if other.any() else len(other)
                if upto:
                    k, n, h = (x[:upto] for x in rows[1:])
                    yield out(1, k, n, n, h)
                rows = [x[upto:] for x in rows]
                if not len(rows[0]):
                    held = tuple(rows)
                    continue
                passing = None
            of = rows[0]
            bounds = group_bounds(of)
            size = np.diff(bounds)
            big = np.repeat(size > hot, size)
            last = np.zeros(len(of), dtype=bool)
            last[bounds[-2] if len(bounds) > 1 else 0:] = True
            if big.any():
                k, n, h = (x[big] for x in rows[1:])
                yield out(1, k, n, n, h)
                if big[-1]:
                    passing = of[-1]
            yield solve(*(x[~big & ~last] for x in rows))
            held = tuple(x[~big & last] for x in rows)
        if len(held[0]):
            yield solve(*held)
    return link


_SCHEMA = "kind byte, key long, a long, b long, home boolean"


def forest(rows: DataFrame, match: Match, hot: int = HOT) -> DataFrame:
    """Edges (a, b) that join the same fingerprints as all links among rows of equal key.

    ``rows``: key long, node long, home boolean (all at home if absent).  Two rows of a key
    link if ``match`` holds and at least one of them is at home there.
    """
    dealt = rows.repartition("key").sortWithinPartitions("key")
    first = cut(dealt.mapInArrow(_linker(match, hot, "key"), _SCHEMA))
    edges = first.where("kind = 0").select("a", "b")
    rest = first.where("kind = 1").selectExpr("key", "a as node", "home")
    if rest.isEmpty():
        return edges
    blocks = F.ceil(F.col("n") / (hot // 2)).cast("int")
    size = rest.groupBy("key").agg(F.count("*").alias("n"))
    mine = rest.join(size, "key").withColumn("blocks", blocks).withColumn(
        "mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    paired = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = paired.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
                         "key", "node", "home")
    cells = cell.repartition("cell").sortWithinPartitions("cell", "key")
    more = cells.mapInArrow(_linker(match, 1 << 30, "cell"), _SCHEMA)
    return edges.unionAll(more.select("a", "b"))
