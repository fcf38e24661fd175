"""Pipeline over ``documents``: quality rules, line dedup, SimHash near-dedup, decontamination, packing.

Each stage calls one numbered operator on all that the stage before it kept.  All but the
last return the columns of ``documents``.  ``run`` writes every stage's rows as Parquet
into the shared checkpoint folder and reads them again for the next, so a lost executor
costs at most the stage at work.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, line_dedup, packing, quality_rules, simhash
from tessera.llm.common import documents, shared_dir, table


def quality(_spark: SparkSession, docs: DataFrame, _sf_dir: str) -> DataFrame:
    """Operator 9: documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def lines(_spark: SparkSession, docs: DataFrame, _sf_dir: str) -> DataFrame:
    """Operator 8: of each group of alike lines one stays; a document that loses all its words goes."""
    out = line_dedup.dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_dedup(_spark: SparkSession, docs: DataFrame, _sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents with benchmark passages in at least one word of twenty go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(_spark: SparkSession, docs: DataFrame, _sf_dir: str) -> DataFrame:
    """Operator 1: the place of every piece of the documents left."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontaminate), ("best-fit packing", pack)]

#: SQL has no byte-level tokenizer, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
