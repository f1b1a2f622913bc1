"""Incremental standardization as a file-source stream.

The batch pipeline selects one ``yyyyMMdd`` folder per run. The same step as a
Structured Streaming query picks up exactly the raw files it has not processed yet (the
file source records them in its checkpoint), so a re-run after a failure neither skips
nor repeats a file. ``trigger(availableNow=True)`` processes what is there and stops,
which fits a scheduled job.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakestrata.operators.transforms import add_audit_columns

INGEST_FILE = "source_file"


def raw_stream(spark: SparkSession, raw_glob: str, schema: StructType, file_type: str = "json",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of raw rows with their source file; a streaming read needs a schema."""
    reader = spark.readStream.format(file_type).schema(schema)
    if file_type == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(raw_glob).withColumn(INGEST_FILE, F.col("_metadata.file_path"))


def standardize_stream(spark: SparkSession, raw_glob: str, schema: StructType, target: str,
                       file_type: str = "json", checkpoint: str | None = None,
                       load_ts: Any = None, available_now: bool = True) -> StreamingQuery:
    """Append newly landed raw files to a Parquet table with audit columns.

    ``checkpoint`` defaults to ``{target}.checkpoint``: every run on a target goes on where the
    last one ended, so each file is taken exactly once.
    """
    checkpoint = checkpoint or f"{target.rstrip('/')}.checkpoint"
    stream = add_audit_columns(raw_stream(spark, raw_glob, schema, file_type), load_ts)
    writer = (stream.writeStream.format("parquet")
              .option("path", target)
              .option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
