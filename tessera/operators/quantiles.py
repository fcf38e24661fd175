"""Exact quantiles by distributed selection.

A quantile is found without sorting a column or holding its values in one task: a sketch of
bounded size gives a narrow range around it, rows below the range are only counted, and just
the values inside it are grouped (map-side first) and ranked.  Counts make the result
exact whatever the sketch's error; should a range miss its rank, the whole column is taken as the range.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], accuracy: int = 10_000
                    ) -> dict[str, list[float | None]]:
    """For each column its quantiles, linearly interpolated between ranks (NULLs left out, NaN as the largest number)."""
    columns = list(dict.fromkeys(columns))
    x = df.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)))
    names, slack = x.columns, 3.0 / accuracy
    marks = [m for p in probs for m in (max(0.0, p - slack), min(1.0, p + slack))]
    rough = x.agg(*(F.percentile_approx(c, marks, accuracy).alias(c) for c in names)).first()
    ranges = {(i, j): (rough[c][2 * j] if p > slack else None, rough[c][2 * j + 1] if p < 1 - slack else None)
              for i, c in enumerate(names) if rough[c] is not None for j, p in enumerate(probs)}
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    todo = ranges
    while todo:
        found = _select(x, names, probs, todo)
        todo = {key: (None, None) for key in todo if key not in found}
        for (i, j), value in found.items():
            out[columns[i]][j] = value
    return out


def _select(x: DataFrame, names: list[str], probs: list[float], ranges: dict) -> dict[tuple[int, int], float]:
    """The quantiles (by column and probability) whose ranks lie in their range."""
    keys = sorted(ranges)
    below = [F.count_if(F.col(names[i]) < F.lit(ranges[i, j][0])) if ranges[i, j][0] is not None else F.lit(0) for i, j in keys]
    used = sorted({i for i, _ in keys})
    counts = x.agg(*(b.cast("long").alias(f"b{k}") for k, b in enumerate(below)), *(F.count(names[i]).alias(f"n{i}") for i in used)).first()
    inside = []
    for k, (i, j) in enumerate(keys):
        c, (lo, hi) = F.col(names[i]), ranges[i, j]
        ok = c.isNotNull()
        ok = ok & (c >= F.lit(lo)) if lo is not None else ok
        ok = ok & (c <= F.lit(hi)) if hi is not None else ok
        inside.append(F.when(ok, F.struct(F.lit(k).alias("k"), c.alias("v"))))
    values = x.select(F.explode(F.array_compact(F.array(*inside))).alias("s")).groupBy("s.k", "s.v").agg(F.count("*").alias("n"))
    order = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.withColumn("last", F.sum("n").over(order))
    places = {}
    for k, (i, j) in enumerate(keys):
        at = probs[j] * (counts[f"n{i}"] - 1)
        places[k] = at, math.floor(at) - counts[f"b{k}"], math.ceil(at) - counts[f"b{k}"]  # ranks from 0 within the range
    asked = F.create_map(*(m for k, (_, lo, hi) in places.items() for m in (F.lit(k), F.array(F.lit(lo), F.lit(hi)))))
    rank, first = asked[F.col("k")], F.col("last") - F.col("n")
    hit = [F.max(F.when((first <= rank[e]) & (F.col("last") > rank[e]), F.col("v"))).alias(f"v{e}") for e in (0, 1)]
    found = {}
    for k, lo, hi in ranked.groupBy("k").agg(*hit).collect():
        if lo is None or hi is None or places[k][1] < 0:
            continue
        share = places[k][0] - math.floor(places[k][0])
        found[keys[k]] = lo if lo == hi or not share else (1 - share) * lo + share * hi
    return found
