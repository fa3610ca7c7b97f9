"""Structured Streaming counterpart of the processed-file ledger.

A file stream over the landing items, run with ``trigger(availableNow=True)``,
processes every file not yet recorded in the stream's checkpoint and stops.
Each micro-batch is handed to ``sink`` with its epoch number through
``foreachBatch``; a sink that writes to a place named after the epoch replaces
exactly its own output when a micro-batch is replayed after a failure.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_COL = "_file"


def ingest_available(spark: SparkSession, source_glob: str, schema: T.StructType,
                     sink: Callable[[DataFrame, int], None], checkpoint: str,
                     fmt: str = "parquet", options: dict[str, str] | None = None,
                     max_files_per_trigger: int | None = None) -> None:
    """Process all new files under ``source_glob`` once, then stop.

    ``sink`` receives each micro-batch, with the source file path in column
    ``_file`` (for per-file provenance), and the epoch number.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_glob).select("*", F.col("_metadata.file_path").alias(FILE_COL))
    query = (stream.writeStream.foreachBatch(sink)
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True)
                   .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
