"""Table writes and load bookkeeping.

Periods are written as partitions of one table, so "replace a period" replaces
only the partitions present in the frame, instead of a truncate-then-append sequence.

A table known by name is loaded by a commit protocol: rows are staged in a folder of their
own, then each partition's location in the catalog is pointed at its staged files, and
only then are partitions that a truncating load leaves out dropped from the catalog.  No file
that the catalog names is touched, so a load that dies leaves every period as it was or as it will
be, and running it again completes it.  No session setting takes part.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import BAD_ROW_BUDGET
from ..operators.clean import fill_mean
from ..session import cut_lineage

MODES = {"WRITE_TRUNCATE": "overwrite", "WRITE_APPEND": "append", "overwrite": "overwrite", "append": "append"}


def write_table(df: DataFrame, path: str, mode: str = "WRITE_TRUNCATE", partition_by: str | None = None,
                replace_partitions: bool = False) -> None:
    """K1/K2/K3: write with a truncate or append disposition.

    ``replace_partitions`` overwrites only the partitions present in ``df``, so
    re-loading a period is idempotent; without it a truncate drops every old
    partition.  Both are said to the writer, so a session setting decides neither.
    """
    w = df.write.mode(MODES[mode]).format("parquet").option(
        "partitionOverwriteMode", "dynamic" if replace_partitions else "static")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType, location: str,
                           partition_by: str | None = None) -> None:
    """K4: empty Parquet table with the declared schema, created only if absent."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{location}'")


#: Folder of staged loads below a table's own location; the underscore hides it from listings of the table.
STAGED = "_loads"


def table_location(spark: SparkSession, name: str, partition: str | None = None) -> str:
    """Where the files of a table, or of one partition (``p='v', ...``) of it, are."""
    of = f" PARTITION ({partition})" if partition else ""
    rows = spark.sql(f"DESCRIBE FORMATTED {name}{of}").where("col_name = 'Location'").collect()
    return rows[0 if partition else -1]["data_type"].rstrip("/")


def _literal(value) -> str:
    if value is None:
        return "null"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stage(df: DataFrame, base: str, partitions: list[str]) -> str:
    """Write ``df`` into a staging folder of its own; nothing refers to it yet."""
    path = f"{base}/{STAGED}/{uuid.uuid4().hex}"
    w = df.write.format("parquet")
    (w.partitionBy(*partitions) if partitions else w).save(path)
    return path


def _point(spark: SparkSession, name: str, spec: str, location: str, exists: bool) -> None:
    """Let one partition read from ``location`` from now on: one change of the catalog."""
    if exists:
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION {_literal(location)}")
    else:
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec}) LOCATION {_literal(location)}")


def _spec(columns: list[str], values: tuple) -> str:
    return ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(columns, values, strict=True))


def _known_partitions(spark: SparkSession, name: str) -> set[tuple[str | None, ...]]:
    """The values of the catalog's partitions, as text."""
    def value(text: str) -> str | None:
        return None if text == "__HIVE_DEFAULT_PARTITION__" else unquote(text)

    return {tuple(value(pair.split("=", 1)[1]) for pair in r["partition"].split("/"))
            for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def _replace(df: DataFrame, name: str, partitions: list[str], keep_others: bool) -> None:
    spark = df.sparkSession
    if not partitions:
        staged = _stage(df, table_location(spark, name).split(f"/{STAGED}/")[0], [])
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(staged)}")
        return
    staged = _stage(df, table_location(spark, name), partitions)
    known = _known_partitions(spark, name)
    # one row per staged partition: its values and its folder
    files = spark.read.schema(df.schema).option("basePath", staged).parquet(staged)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1)
    own = files.select(*(F.col(c).cast("string") for c in partitions), folder.alias("_folder")).distinct()
    for *values, location in own.collect():
        key = tuple(values)
        _point(spark, name, _spec(partitions, key), unquote(location), key in known)  # Spark names files as URIs
        known.discard(key)
    if not keep_others:
        for gone in known:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(partitions, gone)})")


def load_table(df: DataFrame, name: str, mode: str = "WRITE_TRUNCATE", replace_partitions: bool = False) -> DataFrame:
    """K1-K4 on a table known by name; the table is returned as it reads after the load.

    A truncating load replaces all rows, or with ``replace_partitions`` those of the partitions present in
    ``df``; an appending one adds rows.  Files that were replaced stay until ``remove_replaced``.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(name).columns)
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if MODES[mode] == "append":
        rows.write.insertInto(name, overwrite=False)
    else:
        _replace(rows, name, partitions, keep_others=replace_partitions and bool(partitions))
    spark.catalog.refreshTable(name)
    return spark.table(name)


def remove_replaced(spark: SparkSession, name: str) -> int:
    """Delete staged loads that the table no longer reads; the number of folders deleted.

    To be run when no reader of an older state and no load is at work.
    """
    location = table_location(spark, name)
    base, used = location.split(f"/{STAGED}/")[0], [location]
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if partitions:
        used += [table_location(spark, name, _spec(partitions, own)) for own in _known_partitions(spark, name)]
    loads = {u.split(f"/{STAGED}/")[1].split("/")[0] for u in used if f"/{STAGED}/" in u}
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(f"{base}/{STAGED}")
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    gone = [n for n in names if n not in loads]
    for n in gone:
        fs.delete(hadoop.Path(f"{base}/{STAGED}/{n}"), True)
    return len(gone)


class LoadRejected(RuntimeError):
    """A load had more bad rows than its budget."""


def load_with_rejects(df: DataFrame, bad: F.Column, target: str, rejects: str, max_bad: int,
                      mode: str = "WRITE_TRUNCATE", partition_by: str | None = None,
                      replace_partitions: bool = False) -> dict[str, int]:
    """Write good rows to ``target`` and bad ones to ``rejects``; both are counted.

    The source is read once: rows are marked, checkpointed, counted and then divided.
    More than ``max_bad`` bad rows stop the load before the target is touched (the
    rejects are written, so they can be looked at).
    """
    marked = cut_lineage(df.withColumn("_bad", F.coalesce(bad, F.lit(True))))
    n, n_bad = marked.agg(F.count(F.lit(1)), F.count_if("_bad")).first()
    write_table(marked.where("_bad").drop("_bad"), rejects, mode, partition_by, replace_partitions)
    if n_bad > max_bad:
        raise LoadRejected(f"{n_bad} bad rows of {n}; the load allows {max_bad}")
    write_table(marked.where("not _bad").drop("_bad"), target, mode, partition_by, replace_partitions)
    return {"rows": n - n_bad, "bad_rows": n_bad}


def write_bronze_silver(df: DataFrame, bronze: str, silver: str, key: str = "ano_mes",
                        mode: str = "WRITE_TRUNCATE", rejects: str | None = None) -> DataFrame:
    """K5 + K6: bronze = the frame as collected (REQUIRED key enforced); silver = NULLs
    filled with each column's mean.  The bronze table is written once and silver is
    derived from what was written, so the source is computed only once.  Rows without
    the key go to ``rejects`` (by default beside the bronze table)."""
    load_with_rejects(df, F.col(key).isNull(), bronze, rejects or f"{bronze.rstrip('/')}-rejects", 1 << 62, mode)
    written = df.sparkSession.read.parquet(bronze)
    silver_df = fill_mean(written, [c for c in written.columns if c != key])
    write_table(silver_df, silver, mode)
    return df.sparkSession.read.parquet(silver)


def load_status(loaded: DataFrame, unit_cols: list[str], bad: F.Column, max_bad: int = BAD_ROW_BUDGET["registry"]
                ) -> DataFrame:
    """K7: per load unit (e.g. period x type): rows, bad rows, status; one aggregate pass.

    ``success`` when no bad rows, ``partial`` when within the bad-row budget, else ``failed``.
    """
    per = loaded.groupBy(*unit_cols).agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad_rows"))
    return per.withColumn("status", F.when(F.col("bad_rows") == 0, F.lit("success"))
                          .when(F.col("bad_rows") <= max_bad, F.lit("partial")).otherwise(F.lit("failed")))


def load_summary(status: DataFrame) -> DataFrame:
    """K7: table summary: units, rows, units per status."""
    return status.agg(F.count(F.lit(1)).alias("units"), F.sum("rows").alias("rows"),
                      F.sum("bad_rows").alias("bad_rows"),
                      F.count_if(F.col("status") == "success").alias("success"),
                      F.count_if(F.col("status") == "partial").alias("partial"),
                      F.count_if(F.col("status") == "failed").alias("failed"))


def append_union(frames: list[DataFrame]) -> DataFrame:
    """Union-all of period frames by name (missing columns NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
