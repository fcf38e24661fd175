"""Process each landed file exactly once.

A marker-file scheme (an ``.extracted`` file next to each archive) lets a
re-run skip finished work.  Structured Streaming's file source does this
natively: the checkpoint records which files were committed, so re-running
with ``trigger(availableNow=True)`` picks up only new files, and a crash
between write and commit is retried without duplicates (the file sink is
idempotent per batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import period_of_path
from ..sources.landed import REGISTRY


def registry_stream(spark: SparkSession, source_dir: str, data_type: str, file_glob: str | None = None,
                    encoding: str = "ISO-8859-1", max_files_per_trigger: int = 512) -> DataFrame:
    """Streaming scan of landed registry files with the declared schema (same dialect as S1)."""
    schema, default_glob = REGISTRY[data_type]
    return (spark.readStream.schema(schema).format("csv")
            .option("sep", ";").option("header", "false").option("encoding", encoding)
            .option("multiLine", "true").option("escape", '"').option("mode", "PERMISSIVE")
            .option("pathGlobFilter", file_glob or default_glob).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("maxFileAge", "3650d")  # a late file with an old time stamp is still new to us
            .load(source_dir)
            .withColumn("ano_mes", period_of_path(F.col("_metadata.file_path"))))


def ingest_available(stream: DataFrame, target: str, checkpoint: str, partition_by: str = "ano_mes") -> int:
    """Run the stream over every file not yet committed, then stop; returns the rows the
    target gained, counted in the target itself (a progress report keeps recent batches only)."""
    spark = stream.sparkSession
    before = _rows(spark, target)
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy(partition_by).outputMode("append").trigger(availableNow=True).start(target))
    q.awaitTermination()
    return _rows(spark, target) - before


def _rows(spark: SparkSession, target: str) -> int:
    """Rows of a Parquet target (from file footers); 0 where it does not exist yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return 0
    return spark.read.parquet(target).count()
