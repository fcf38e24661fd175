"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[list[tuple[int, object, str]], dict]:
    """At most ``rows`` of (doc_id, label, text), and how many labelled rows each of a label stands for: as many of each label as evenly fit, by least hash of the id.

    ``labels`` has doc_id and label.  A repeated id is taken once, with its greatest label; rows with
    a null in either column or without a text are left out.  The labels are picked before
    texts are read, so only the sample's texts leave the scan, and the side sent to it has ``rows`` rows at most.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = known.groupBy("label").agg(F.count("*").alias("_size"))
    kinds = sizes.count()
    if not kinds:
        return [], {}
    each = max(1, rows // kinds)
    # hashes are even, so a label's least ``each`` lie below this bound: few rows meet in its window
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    near = known.join(sizes, "label").where(spread <= (4 * each + 200) / F.col("_size"))
    order = Window.partitionBy("label").orderBy(spread, "doc_id")
    picked = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= each)
    if kinds > rows:
        picked = picked.orderBy("label").limit(rows)
    picked = picked.select(F.col("doc_id").alias("_id"), "label", "_size")
    texts = docs.where("text is not null").select("doc_id", "text")
    found = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text", "_size").collect()
    stands = {r["label"]: r["_size"] / min(each, r["_size"]) for r in found}
    return sorted({r["doc_id"]: tuple(r)[:3] for r in sorted(found, key=lambda r: (r["doc_id"], r["text"]))}.values()), stands
