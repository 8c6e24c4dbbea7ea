"""New source files as a stream: each file is extracted once, whatever happens in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nestloom.functions.naming import source_key_column, table_path
from nestloom.plans.compile import tables
from nestloom.plans.schema import Schema
from nestloom.sources.jsonl import parse


def stream(spark: SparkSession, root: str, entity: str, files_per_batch: int = 1000) -> DataFrame:
    """``source_key, line, record`` of the files of an entity as they arrive."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(f"{root}/{entity}")
    path = F.regexp_replace(F.url_decode("_metadata.file_path"), "^file:/*", "/")
    return lines.select(source_key_column(path, root.rstrip("/")).alias("source_key"), F.col("value").alias("line"), parse(F.col("value")).alias("record"))


def ingest(spark: SparkSession, root: str, schema: Schema, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the tables of new files below ``out``; a batch that is repeated replaces its own rows.

    The stream sees new files only; changed and removed ones are found by comparing listings.
    """

    def write(batch: DataFrame, _: int) -> None:
        batch.persist()
        batch.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        for name, df in tables(batch, schema).items():
            df.write.mode("overwrite").partitionBy("source_key").parquet(f"{out}/{table_path(name)}")
        batch.unpersist()

    writer = stream(spark, root, schema.entity).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="300 seconds")).start()
