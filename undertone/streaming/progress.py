"""Incremental evaluation and epoch streams on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def epoch_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    """A materialised epoch as a stream: files in order, offsets and exactly
    once delivery from the checkpoint of the query that reads it."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def fold_predictions(stream: DataFrame, key: list[str], target: str, checkpoint: str) -> StreamingQuery:
    """Append finished predictions to ``target``, each key once (K2).

    Keys that are done stand in the query's state, partitioned by key, so a
    batch costs what it holds however many came before. A batch is written
    under its id, so one that is run again after a failure replaces its rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.dropDuplicates(key).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def finalise(spark: SparkSession, parts: str, final: str, order: list[str]) -> None:
    """All parts as one result in order of ``order``.

    It is written beside ``final`` and renamed when whole, so readers see the
    old result or the new one; then the parts go.
    """
    rows = spark.read.parquet(f"{parts}/batch=*")
    rows.orderBy(*order).write.mode("overwrite").parquet(final + ".tmp")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(final).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(path(final), True)
    if not fs.rename(path(final + ".tmp"), path(final)):
        raise OSError(f"cannot rename {final}.tmp")
    fs.delete(path(parts), True)


def running_scores(stream: DataFrame, group: list[str], edits: str, n_ref: str) -> DataFrame:
    """Error rates so far, for update or complete output."""
    return stream.groupBy(*group).agg(F.sum(edits).alias("edits"), F.sum(n_ref).alias("n_ref")).withColumn("value", F.when(F.col("n_ref") > 0, F.col("edits") / F.col("n_ref")))
