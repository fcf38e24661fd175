"""Load registry periods named by trigger messages.

Messages (``id``, base64 ``data``) land as JSON-lines files; a stream decodes (F17)
and validates them (F18).  A micro-batch is reduced to the distinct periods it asks
for of each registry type, those are matched with the folders that are there, and each
type gets one read and one write, however many messages asked.

Every load is a snapshot's load named by its micro-batch (``sinks/snapshots.py``).  A micro-batch that
is retried after a crash writes the same folder again or finds its load done, so nothing is added twice, and
the rows of a load are counted in its own folder.  ``current`` reads the last snapshot: of a
period, the last truncating load and what came after, and no file of any other load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ALL_TYPES, REGISTRY_DATA_TYPES
from ..functions.messages import decode_message, message_status
from ..session import cut_lineage
from ..sinks import snapshots
from ..sinks.tables import write_table
from ..sources.landed import available_periods, read_registry

MESSAGE_FILE_SCHEMA = "id string, data string"


def message_stream(spark: SparkSession, inbox: str) -> DataFrame:
    raw = spark.readStream.schema(MESSAGE_FILE_SCHEMA).json(inbox)
    msg = raw.withColumn("m", decode_message("data"))
    return msg.select("id", "m.*", message_status(F.col("m")).alias("status"))


def _wanted(messages: DataFrame) -> DataFrame:
    """One row per valid message and registry type it asks for."""
    every = F.col("data_type").isNull() | (F.col("data_type") == ALL_TYPES)
    types = F.when(every, F.array(*[F.lit(t) for t in REGISTRY_DATA_TYPES])).otherwise(F.array("data_type"))
    return messages.where("status = 'ok'").select(
        "id", F.explode(types).alias("tipo"), "period", (F.col("mode") == "WRITE_TRUNCATE").alias("substitui"))


def _periods_to_load(spark: SparkSession, landing: str, wanted: DataFrame, data_type: str,
                     file_glob: str) -> dict[str, bool]:
    """Period folders of a type that are asked for, and whether the load replaces the period (at most one
    entry per month)."""
    own = wanted.where(F.col("tipo") == data_type)
    listed = available_periods(spark, f"{landing}/{data_type}", file_glob)
    for_all = own.where("period is null").agg(F.max("substitui").alias("s")).first()["s"]
    named = own.where("period is not null").groupBy("period").agg(F.max("substitui").alias("s"))
    found = listed.join(named, F.col("ano_mes") == F.col("period"), "left")
    return {r["ano_mes"]: bool(r["s"]) or bool(for_all) for r in found.collect()
            if r["s"] is not None or for_all is not None}


def _load(batch_id: int) -> str:
    return f"lote-{batch_id}"


def _loaded(spark: SparkSession, tables: str, data_type: str, batch_id: int, schema) -> DataFrame:
    own = spark.read.schema(schema).parquet(f"{tables}/{data_type}/data/{_load(batch_id)}")
    return own.groupBy("ano_mes").agg(F.count(F.lit(1)).alias("n")).withColumn("tipo", F.lit(data_type))


def handle_batch(landing: str, tables: str, status_table: str, file_glob: str = "*.csv"):
    """Per micro-batch: one load per registry type asked for, and a status row per message.

    ``rows`` of a message are the rows of the periods it asked for, as loaded in this
    micro-batch; a valid message that matches no folder gets ``no_files``.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        messages = cut_lineage(batch)
        wanted = _wanted(messages)
        counts = spark.createDataFrame([], "ano_mes string, n long, tipo string")
        for data_type in REGISTRY_DATA_TYPES:  # the two registry types
            todo = _periods_to_load(spark, landing, wanted, data_type, file_glob)
            if not todo:
                continue
            rows = read_registry(spark, f"{landing}/{data_type}", data_type, sorted(todo), file_glob)
            snapshots.commit(rows, f"{tables}/{data_type}", _load(batch_id), key="ano_mes",
                             replaced=[p for p, replaces in todo.items() if replaces])
            counts = counts.unionByName(_loaded(spark, tables, data_type, batch_id, rows.schema))
        per = wanted.join(counts, "tipo").where(F.col("period").isNull() | (F.col("period") == F.col("ano_mes")))
        rows = per.groupBy("id").agg(F.sum("n").alias("rows"))
        out = messages.join(rows, "id", "left").withColumns({
            "rows": F.coalesce("rows", F.lit(0)), "batch_id": F.lit(batch_id).cast("long"),
            "status": F.when((F.col("status") == "ok") & F.col("rows").isNull(), F.lit("no_files")).otherwise(F.col("status"))})
        write_table(out.select("id", "period", "data_type", "mode", "status", "rows", "batch_id"), status_table,
                    partition_by="batch_id", replace_partitions=True)
    return fn


def current(spark: SparkSession, tables: str, data_type: str) -> DataFrame:
    """A registry table as its loads left it: per period, from the last replacing load on; one snapshot."""
    return snapshots.read(spark, f"{tables}/{data_type}")


def run_triggered_loads(spark: SparkSession, inbox: str, landing: str, tables: str, status_table: str,
                        checkpoint: str) -> DataFrame:
    """Process every pending message once; returns the status table."""
    q = (message_stream(spark, inbox).writeStream.foreachBatch(handle_batch(landing, tables, status_table))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(status_table)
