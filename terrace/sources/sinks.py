"""Sinks and publishing.

Outputs are Parquet folders. Appends are made idempotent by writing each run
into its own ``batch=<id>`` folder, which the write replaces as a whole; a run
that retries an unfinished batch (see ``ledger.unfinished_batch``) reuses its
id and so replaces it and nothing else (the source system's "write, then log"
gap, where a crash re-appends the same files, is closed).

Curated refreshes go to a new version folder each time, and publishing points
the table at it: a metadata change, not a second copy of the data. Until a
publish succeeds, the table keeps reading the previous version, which is never
written to again.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_first_or_append(df: DataFrame, path: str, first: bool, batch: str,
                          by: dict[str, Column] | None = None) -> None:
    """Overwrite the whole output on the first run (empty ledger), else
    add a batch. ``by`` names partitions within a batch and their values (the
    year of a row), so that readers of a year skip the others' files.

    A later batch overwrites its own folder only, and all of it, so a retried
    batch leaves nothing of its first attempt, in whatever partitions."""
    df = df.withColumns(by or {})
    if first:
        (df.withColumn("batch", F.lit(batch)).write.partitionBy("batch", *(by or {}))
           .mode("overwrite").option("partitionOverwriteMode", "static").parquet(path))
    else:
        w = df.write.partitionBy(*by) if by else df.write
        w.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch}")


def batch_folder(path: str, batch: str) -> str:
    return f"{path}/batch={batch}"


def write_refresh(df: DataFrame, path: str) -> None:
    """A10: full refresh. Callers never refresh a folder from itself."""
    df.write.mode("overwrite").parquet(path)


def new_version(root: str) -> str:
    """A fresh folder for one full refresh: ``<root>/versions/<utc time>-<id>``
    (names sort by creation time)."""
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{root}/versions/{stamp}-{uuid.uuid4().hex[:8]}"


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION {_sql_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")


def publish(spark: SparkSession, source_path: str, database: str, table: str,
            location: str | None = None) -> str:
    """Create-or-replace ``database.table`` over the Parquet output.

    The table is an external table on the output folder, so publishing reads
    no data beyond the files' footers. An existing external table with the
    same schema is repointed with ``SET LOCATION`` (one catalog update;
    readers see the old or the new version, never a mix). Otherwise the
    table is dropped and created again. A missing or unreadable output fails
    before the catalog is touched."""
    ensure_database(spark, database, location)
    name = f"`{database}`.`{table}`"
    schema = spark.read.parquet(source_path).schema
    if spark.catalog.tableExists(f"{database}.{table}"):
        current = spark.catalog.getTable(f"{database}.{table}")
        same = [(f.name, f.dataType) for f in spark.table(name).schema.fields] == \
            [(f.name, f.dataType) for f in schema.fields]
        if current.tableType == "EXTERNAL" and same:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_sql_text(source_path)}")
            spark.sql(f"REFRESH TABLE {name}")
            return name
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_sql_text(source_path)}")
    return name
