"""Splits, encoders and class weights.

Exact ordered split without a global window
-------------------------------------------
A naive plan numbers every row with ``row_number() OVER (ORDER BY ano_mes,
cnpj)`` - one task sorts the whole table.  Here the position of a row is
assembled from counts instead:

1. count rows per level-1 bucket (a period, or a range of the
   entity key) - a tiny table - and take running totals over it;
2. whole buckets that end before / start after a cut are labelled at once;
3. only the (at most two) buckets holding a cut are refined: their rows get
   range sub-buckets of the entity key (so a hot period is split across
   many tasks), counted again, and numbered with ``row_number`` inside a
   sub-bucket.  Bucket boundaries only affect balance, never the result:
   buckets are monotone in the sort order, so positions are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SPLIT_FRACTIONS
from ..functions.scores import percent
from ..session import cut_lineage

ENTITY, PERIOD, TARGET = "cnpj", "ano_mes", "situacao_cadastral"
#: Buckets up to which their table is broadcast.
_FEW = 10_000


def _range_bounds(df: DataFrame, key: str, n: int, per_bucket: int = 20, seed: int = 7) -> list:
    """About ``n - 1`` values that cut the sorted ``key`` into parts of like size.

    They come from a random sample of about ``per_bucket * n`` rows, so the driver
    holds a short list whatever the key's type or the table's size.
    """
    keys = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    rows = keys.count()
    if not rows:
        return []
    sample = keys.sample(False, min(1.0, per_bucket * n / rows), seed).limit(2 * per_bucket * n)
    ranked = sample.select("k", F.ntile(n).over(Window.orderBy("k")).alias("t"))  # of the sample only
    return [r["k"] for r in ranked.groupBy("t").agg(F.min("k").alias("k")).where("t > 1").select("k").distinct()
            .orderBy("k").collect()]


def _with_range_bucket(df: DataFrame, key: str, n: int, out: str) -> DataFrame:
    """Add ``out``: a bucket id that is non-decreasing in ``key``, of any ordered type.

    NULL keys sort first and get bucket 0.  The bucket is the number of bounds at or
    below the key, found in two steps of about sqrt(n) comparisons each.  Bounds only
    affect balance; equal keys always share a bucket, so ordering stays exact.
    """
    return df.withColumn(out, _bucket(df, key, _range_bounds(df, key, n)))


def _bucket(df: DataFrame, key: str, bounds: list) -> Column:
    if not bounds:
        return F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.lit(1))
    kind = df.schema[key].dataType
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]

    def literal(values):
        return F.array(*[F.lit(v).cast(kind) for v in values])

    heads, rows = literal([g[0] for g in groups]), F.array(*[literal(g) for g in groups])
    k = F.col(key)
    whole = F.size(F.filter(heads, lambda b: b <= k))  # groups that begin at or below the key
    inner = F.size(F.filter(F.element_at(rows, F.greatest(whole, F.lit(1))), lambda b: b <= k))
    bucket = F.when(whole == 0, F.lit(1)).otherwise((whole - 1) * F.lit(width) + inner + 1)
    return F.when(k.isNull(), F.lit(0)).otherwise(bucket)


def _by_runs(df: DataFrame, key: str, bounds: list, buckets: list) -> DataFrame:
    """Add ``_whole``, the label of the row's range (NULL where a cut lies in it), and ``_b1``, the range's number if so.

    ``buckets`` holds (number, label) of every range.  Ranges of one label follow each other, so a row is
    compared with the few bounds where the label changes instead of all.
    """
    kind, k = df.schema[key].dataType, F.col(key)
    runs: list[tuple] = []  # (last range, label, number if cut)
    for b, label in sorted(buckets):
        own = (label, b if label is None else None)
        if runs and b > 1 and runs[-1][1:] == own:  # range 0 holds the NULL keys
            runs.pop()
        runs.append((b, *own))

    def chosen(i: int, of: str) -> Column:
        out = None
        for n, run in enumerate(runs):
            value = F.lit(run[i]).cast(of)
            if run[0] == 0:
                where = k.isNull()
            elif n + 1 < len(runs):
                where = k < F.lit(bounds[run[0] - 1]).cast(kind)
            else:
                where = F.lit(True)
            out = F.when(where, value) if out is None else out.when(where, value)
        return F.lit(None).cast(of) if out is None else out

    return df.withColumns({"_whole": chosen(1, "string"), "_b1": chosen(2, "int")})


def _label(idx: Column, cuts: list[Column], names: list[str]) -> Column:
    expr = F.when(idx <= cuts[0], F.lit(names[0]))
    for cut, name in zip(cuts[1:], names[1:-1]):
        expr = expr.when(idx <= cut, F.lit(name))
    return expr.otherwise(F.lit(names[-1]))


def row_index(df: DataFrame, order: list[str], out: str = "row_index", buckets: int = 256, hot_rows: int = 100_000
              ) -> DataFrame:
    """Every row with its exact position from 1 in ``order`` (ascending, NULLs first).

    Rows that are equal in ``order`` are put in the order of a hash of all their columns, so equal rows alone can
    change places.  Rows are dealt out by ranges of the first column, a value of more than ``hot_rows`` rows by
    ranges of the second one (or of the hash) too; counts per range give each its first position, and
    rows are numbered within a range only.
    """
    held = cut_lineage(df.withColumn("_tie", F.xxhash64(*df.columns)))
    second = order[1] if len(order) > 1 else "_tie"
    keyed = _with_range_bucket(held, order[0], buckets, "_b1")
    one = F.min(F.col(order[0])).eqNullSafe(F.max(F.col(order[0])))  # NULLs have a range of their own
    sizes = keyed.groupBy(F.col("_b1").alias("_k1")).agg((one & (F.count(F.lit(1)) > hot_rows)).alias("_hot"))
    keyed = keyed.join(F.broadcast(sizes), F.col("_b1") == F.col("_k1"))  # one row per range
    ranged = _with_range_bucket(keyed, second, buckets, "_r2").withColumn(
        "_b2", F.when(F.col("_hot"), F.col("_r2")).otherwise(F.lit(0)))
    counts = ranged.groupBy(F.col("_b1").alias("_j1"), F.col("_b2").alias("_j2")).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.orderBy("_j1", "_j2").rowsBetween(Window.unboundedPreceding, -1)  # over the table of ranges
    starts = counts.withColumn("_s", F.coalesce(F.sum("_n").over(run), F.lit(0)))
    within = Window.partitionBy("_b1", "_b2").orderBy(*order, "_tie")
    return ranged.join(F.broadcast(starts), (F.col("_b1") == F.col("_j1")) & (F.col("_b2") == F.col("_j2"))).withColumn(
        out, F.col("_s") + F.row_number().over(within)).select(*df.columns, out)


def ordered_split(df: DataFrame, order: list[str], fractions=SPLIT_FRACTIONS,
                  names=("train", "val", "test"), level1: str = "value", buckets: int = 256,
                  sub_buckets: int = 256, split_col: str = "split", sub_key: str = ENTITY) -> DataFrame:
    """Label rows by their exact position in ``order`` (ascending, NULLs first).

    A row at 1-based position ``i`` of ``n`` goes to ``names[j]`` for the first
    ``j`` with ``i <= int(fractions[j] * n)``, else to the last name.
    ``level1='value'`` groups by the first order column itself (few distinct
    values, e.g. months); ``level1='range'`` cuts it into ranges.
    Rows of buckets that hold a cut are sub-bucketed by ranges of ``sub_key``
    (the entity, of any type), which must be non-decreasing in ``order``
    within a level-1 bucket.  Rows with NULL order columns are labelled like any other.
    """
    first = order[0]
    bounds = _range_bounds(df, first, buckets) if level1 == "range" else []
    keyed = df.withColumn("_b1", F.col(first) if level1 == "value" else _bucket(df, first, bounds))

    sizes = keyed.groupBy(F.col("_b1").alias("_k1")).agg(F.count(F.lit(1)).alias("_n1"))
    # Over the bucket-size table only (one row per month or range):
    # the running start of each bucket and the grand total, without a subquery.
    tiny = Window.orderBy("_k1")
    sizes = sizes.withColumns({
        "_s1": F.coalesce(F.sum("_n1").over(tiny.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_n": F.sum("_n1").over(Window.partitionBy()),
    })
    cuts = [F.floor(F.col("_n") * F.lit(float(f))) for f in fractions]

    lo, hi = F.col("_s1") + 1, F.col("_s1") + F.col("_n1")
    # A bucket is whole when its first and last position fall in the same part.
    whole_label = F.when(_label(lo, cuts, list(names)) == _label(hi, cuts, list(names)),
                         _label(lo, cuts, list(names)))
    # Written once, like the rows of cut buckets: every read of the result would count and find them again.
    sizes = cut_lineage(sizes.withColumn("_whole", whole_label))
    starts = sizes.where(F.col("_whole").isNull()).select("_k1", "_s1", "_n")  # one row per cut at most
    if level1 == "range":
        keyed = _by_runs(df, first, bounds, [(r["_k1"], r["_whole"]) for r in sizes.select("_k1", "_whole").collect()])
    else:
        labels = sizes.select("_k1", "_whole")
        labels = F.broadcast(labels) if sizes.count() <= _FEW else labels
        keyed = keyed.join(labels, F.col("_b1").eqNullSafe(F.col("_k1"))).drop("_k1")

    settled = keyed.where(F.col("_whole").isNotNull()).withColumn(split_col, F.col("_whole"))
    cut_rows = cut_lineage(keyed.where(F.col("_whole").isNull()).join(
        F.broadcast(starts), F.col("_b1").eqNullSafe(F.col("_k1"))).drop("_k1"))
    cut_rows = _with_range_bucket(cut_rows, sub_key, sub_buckets, "_b2")
    sub = cut_rows.groupBy(F.col("_b1").alias("_j1"), F.col("_b2").alias("_j2")).agg(F.count(F.lit(1)).alias("_n2"))
    run2 = Window.partitionBy("_j1").orderBy("_j2").rowsBetween(Window.unboundedPreceding, -1)
    # At most two cut buckets x ``sub_buckets`` rows.
    sub = sub.withColumn("_s2", F.coalesce(F.sum("_n2").over(run2), F.lit(0)))
    within = Window.partitionBy("_b1", "_b2").orderBy(*order)
    refined = (cut_rows.join(sub, F.col("_b1").eqNullSafe(F.col("_j1")) & (F.col("_b2") == F.col("_j2")))
               .withColumn("_idx", F.col("_s1") + F.col("_s2") + F.row_number().over(within))
               .withColumn(split_col, _label(F.col("_idx"), cuts, list(names))))
    cols = df.columns + [split_col]
    return settled.select(*cols).unionByName(refined.select(*cols))


def temporal_split(df: DataFrame, fractions=SPLIT_FRACTIONS, names=("train", "val", "test")) -> DataFrame:
    """70/20/10 by (period, entity)."""
    return ordered_split(df, [PERIOD, ENTITY], fractions, names, level1="value")


def entity_order_split(df: DataFrame, fractions=(0.8,), names=("train", "test")) -> DataFrame:
    """Split on (entity, period) order, i.e. by company (the pandas behaviour)."""
    return ordered_split(df, [ENTITY, PERIOD], fractions, names, level1="range")


def date_split(df: DataFrame, split_date: str, period: str = PERIOD, split_col: str = "split") -> DataFrame:
    """D3: ``period < split_date`` -> train, otherwise test."""
    return df.withColumn(split_col, F.when(F.col(period) < F.to_date(F.lit(split_date)), F.lit("train"))
                         .otherwise(F.lit("test")))


def split_distribution(df: DataFrame, target: str = TARGET, split_col: str = "split", digits: int = 4) -> DataFrame:
    """Target counts per split, share of the split in all rows."""
    counts = df.groupBy(split_col, target).agg(F.count(F.lit(1)).alias("count"))
    per_split = Window.partitionBy(split_col)  # over the grouped frame: splits x classes rows
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumns({
        "split_rows": F.sum("count").over(per_split),
        "split_pct": percent(F.sum("count").over(per_split), total, digits),
    })


def distinct_values(parts: list[DataFrame], cols: list[str]) -> DataFrame:
    """Union of several frames' columns, distinct."""
    out = parts[0].select(*cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(*cols))
    return out.distinct()


def label_encode(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Encode each column as the 0-based rank of its value among the distinct values
    (of ``fit_on``, by default of ``df``); a value or NULL that was not fitted stays NULL."""
    mapping = mapping_table(fit_on if fit_on is not None else df, cols)
    out = df
    for c in cols:
        own = mapping.where(F.col("column_name") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"{c}_encoded"))
        out = out.join(own, F.col(c).cast("string") == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
    return out


def _ranked(values: DataFrame, order: list, groups: int) -> DataFrame:
    """``values`` with ``code``, its 0-based position by ``order`` within ``column_name``.

    Positions come from counts per range of the value, so a column with very many
    categories is numbered by many tasks.
    """
    ranged = _with_range_bucket(values, order[0], groups, "_r")
    sizes = ranged.groupBy(F.col("column_name").alias("_c"), F.col("_r").alias("_q")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_c").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_s", F.coalesce(F.sum("_n").over(before), F.lit(0)))  # one row per column and range
    within = Window.partitionBy("column_name", "_r").orderBy(*order)
    return (ranged.join(sizes, (F.col("column_name") == F.col("_c")) & (F.col("_r") == F.col("_q")))
            .withColumn("code", (F.col("_s") + F.row_number().over(within) - 1).cast("int"))
            .select(*values.columns, "code"))


def mapping_table(df: DataFrame, cols: list[str], by_frequency: bool = False, groups: int = 64) -> DataFrame:
    """(column_name, value, code) of each column's distinct values, as a distributed table.

    Codes are the 0-based rank of the value (LabelEncoder); ``by_frequency`` ranks by
    descending count over the distinct *combinations* of ``cols``, ties by value.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = (texts.distinct() if by_frequency else texts).unpivot([], cols, "column_name", "value").where(
        F.col("value").isNotNull())
    # written once: the ranges, their sizes and the ranks all read it
    counted = cut_lineage(long.groupBy("column_name", "value").agg((-F.count(F.lit(1))).alias("_by")))
    order = ["_by", "value"] if by_frequency else ["value"]
    return _ranked(counted, order, groups).select("column_name", "value", "code")


def mapping_from(df: DataFrame, col: str) -> DataFrame:
    """E1 as a table for one column: (value, code)."""
    return mapping_table(df, [col]).select("value", "code")


def apply_mapping(df: DataFrame, col: str, mapping: DataFrame, unseen: int = 0) -> DataFrame:
    """Apply a stored mapping; unseen (or NULL) values -> ``unseen`` (0 by default).
    The join strategy is left to AQE, which measures the mapping's bytes."""
    m = mapping.select(F.col("value").alias("_v"), F.col("code").alias("_code"))
    out = df.join(m, F.col(col).cast("string") == F.col("_v"), "left")
    return out.withColumn(f"{col}_encoded", F.coalesce(F.col("_code"), F.lit(unseen))).drop("_v", "_code")


def class_weights(df: DataFrame, target: str = TARGET, digits: int = 6) -> DataFrame:
    """``weight = total / (n_classes * n_c)`` per class (balanced weights)."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    agg = counts.agg(F.struct(F.sum("count").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return counts.withColumn("weight", F.round(agg["n"] / (agg["k"] * F.col("count")), digits))
