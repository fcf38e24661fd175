"""Landed files are done by their content, not by their name.

A file that lands again under its name with other content is read again, and its rows take the place of the old ones.
``content_manifest`` gives size and digest of every file: lines are hashed where they are read, a large file by many
tasks, and added up by file before they are shuffled.  The digest adds 128 bits for each line with its repeats,
so it does not see the order of lines; neither does a load of rows.

A load reads the new and the changed files, commits their rows to a snapshot table with one partition per file
(``sinks/snapshots.py``), then their lines of the manifest.  Its name follows from these files and their
digests: if it dies between both, the next run finds the rows done and adds the manifest.  Only names of files are on the driver.
An empty file has no rows and no digest; a file that has gone stays loaded (``gone`` takes its rows out).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name
from ..sinks import snapshots

MANIFEST = "arquivo string, tamanho long, linhas long, resumo string, caminho string"
NEW, CHANGED, SAME, GONE = "novo", "alterado", "igual", "ausente"


def content_manifest(spark: SparkSession, source: str, file_glob: str = "*") -> DataFrame:
    """(arquivo, tamanho, linhas, resumo, caminho) of every file below ``source``; names are unique there."""
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", file_glob).option("recursiveFileLookup", "true").text(source)

    def added(*seed) -> F.Column:
        return F.sum(F.xxhash64("value", *seed).cast("decimal(20,0)")).cast("string")

    per = lines.groupBy(F.col("_metadata.file_path").alias("caminho")).agg(
        F.max("_metadata.file_size").alias("tamanho"), F.count(F.lit(1)).alias("linhas"),
        F.concat_ws("/", added(), added(F.lit(1))).alias("resumo"))
    return per.select(base_name("caminho").alias("arquivo"), "tamanho", "linhas", "resumo", "caminho")


def compared(now: DataFrame, done: DataFrame) -> DataFrame:
    """``now`` with the state of each file against ``done``; files of ``done`` that are no more are ``ausente``."""
    old = done.select(F.col("arquivo").alias("_arquivo"), F.col("tamanho").alias("_tamanho"), F.col("resumo").alias("_resumo"))
    both = now.join(old, F.col("arquivo").eqNullSafe(F.col("_arquivo")), "full")
    same = F.col("resumo").eqNullSafe(F.col("_resumo")) & F.col("tamanho").eqNullSafe(F.col("_tamanho"))
    state = (F.when(F.col("resumo").isNull(), F.lit(GONE)).when(F.col("_resumo").isNull(), F.lit(NEW))
             .when(same, F.lit(SAME)).otherwise(F.lit(CHANGED)))
    return both.select(F.coalesce("arquivo", "_arquivo").alias("arquivo"), "tamanho", "linhas", "resumo", "caminho",
                       state.alias("estado"))


def done_manifest(spark: SparkSession, table: str) -> DataFrame:
    """What has been loaded into ``table``, one row per file."""
    path = f"{table}/manifest"
    if not snapshots.versions(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return snapshots.read(spark, path).select("arquivo", "tamanho", "linhas", "resumo", "caminho")


def load_changed(spark: SparkSession, source: str, table: str, reader: Callable[[list[str]], DataFrame], file_glob: str = "*",
                 gone: bool = False) -> dict[str, int]:
    """Load new and changed files into ``table``; the number of files in each state.

    ``reader`` gives the rows of a list of paths, with the path of each row's file in ``_path``.
    """
    states = compared(content_manifest(spark, source, file_glob), done_manifest(spark, table)).collect()
    todo = sorted((r for r in states if r["estado"] in (NEW, CHANGED)), key=lambda r: r["arquivo"])
    lost = sorted(r["arquivo"] for r in states if gone and r["estado"] == GONE)
    if todo or lost:
        earlier = len(snapshots.versions(spark, f"{table}/manifest"))
        said = repr([(r["arquivo"], r["tamanho"], r["resumo"]) for r in todo] + lost + [earlier])
        load = hashlib.sha256(said.encode()).hexdigest()[:32]
        replaced = [r["arquivo"] for r in todo] + lost
        entries = spark.createDataFrame([tuple(r)[:5] for r in todo], MANIFEST)
        if todo:
            rows = reader([r["caminho"] for r in todo]).withColumn("arquivo", base_name("_path")).drop("_path")
        else:
            rows = snapshots.read(spark, f"{table}/rows").limit(0)
        snapshots.commit(rows, f"{table}/rows", load, "arquivo", replaced=replaced)
        snapshots.commit(entries, f"{table}/manifest", load, "arquivo", replaced=replaced)
    return {s: sum(r["estado"] == s for r in states) for s in (NEW, CHANGED, SAME, GONE)}


def loaded(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all files as they were last loaded."""
    return snapshots.read(spark, f"{table}/rows")
