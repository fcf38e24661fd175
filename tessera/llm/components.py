"""Connected components of an edge table, by star contractions.

Tasks first contract the edges they hold.  Then rounds of joins and aggregates hang every
node on its least neighbour, in both directions in turn, until each component is a star.
Edges are written to the shared checkpoint folder after each round, so a lost executor
costs one round; only "is there a node left to move" reaches the driver.  The rounds needed
grow with the logarithm of the longest path, not with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Edges that a task contracts at once.
LOCAL_EDGES = 100_000


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (node, least node it reaches) by the edges of this task."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (above := up.get(top, top)) != top:
            top = above
        while x != top:  # hang the path on its top
            up[x], x = top, up.get(x, x)
        return top

    def stars() -> pa.RecordBatch:
        pairs = [(x, r) for x in up if (r := root(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], type=pa.int64()) for k in (0, 1)], ["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        if len(up) > LOCAL_EDGES:
            yield stars()
            up.clear()
    yield stars()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node (the larger ones, or the others and itself) on its least neighbour.

    ``edges`` holds (u, v) with u > v.
    """
    if large:
        both = edges.unionAll(edges.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u").where("v > u").selectExpr("v as u", "m as v")
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").selectExpr("inline(array(struct(v as u, m as v), struct(u as u, m as v)))")
    return out.where("u > v")


def _all_stars(edges: DataFrame) -> bool:
    """Does every node hang on one other that hangs on none?"""
    ends = edges.selectExpr("inline(array(struct(u as n, 1 as below, 0 as above), struct(v as n, 0 as below, 1 as above)))")
    return ends.groupBy("n").agg(F.sum("below").alias("below"), F.sum("above").alias("above")).where(
        "below > 1 or (below = 1 and above > 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the edge table; ``root`` is the least node it reaches.

    An empty table gives an empty result; null ends, loops and repeated edges are ignored.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    e = cut(pairs.mapInArrow(_local_stars, "u long, v long"))
    while not _all_stars(e):  # the tasks alone may have ended it
        e = cut(_star(_star(e, True), False).distinct())
    return e.selectExpr("u as node", "v as root").unionAll(e.selectExpr("v as node", "v as root").distinct())
