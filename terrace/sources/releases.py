"""Releases: one record that names the folders of several tables.

A table is a set of immutable *parts*, each a folder written once. A release
lists the parts of every table of a set; it is one small file, written after
all parts, so it exists whole or not at all. Readers resolve a table through
one release: a run that stops before its release, or between two catalog
updates, leaves them on the earlier set, and tables of one release never mix
input versions. Parts of one release that did not change are listed again in
the next, so a reader needs the latest release only.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import children

ENTRY = T.StructType([T.StructField("table", T.StringType(), False), T.StructField("part", T.StringType(), False),
                      T.StructField("folder", T.StringType(), False)])

Entries = dict[str, dict[str, str]]              # table: part: folder


def new_run() -> str:
    """A name for a run; names sort by time."""
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{stamp}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, root: str, entries: Entries, run: str | None = None) -> str:
    """Record a release of all ``entries``. Its file appears in one step."""
    run = run or new_run()
    rows = [(t, p, f) for t, parts in entries.items() for p, f in parts.items()]
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.parquet(f"{root}/_releases/{run}")
    return run


def latest(spark: SparkSession, root: str) -> str | None:
    """The newest complete release: folder names are listed, no file is read."""
    runs = [c.name for c in children(spark, f"{root}/_releases") if c.is_dir]
    for run in sorted(runs, reverse=True):
        if any(c.name.endswith(".parquet") for c in children(spark, f"{root}/_releases/{run}")):
            return run
    return None


def entries(spark: SparkSession, root: str, run: str | None = None) -> Entries:
    """Parts of a release (default: the latest): names only, a row per part."""
    run = run or latest(spark, root)
    out: Entries = {}
    if run is not None:
        for r in spark.read.schema(ENTRY).parquet(f"{root}/_releases/{run}").collect():
            out.setdefault(r["table"], {})[r["part"]] = r["folder"]
    return out


def read_parts(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    """Rows of the given folders (each once); none gives no rows."""
    folders = sorted(set(folders))
    if not folders:
        return spark.createDataFrame([], schema)
    names = [F.col(f"`{c}`") for c in schema.fieldNames()]
    return spark.read.schema(schema).parquet(*folders).select(*names)


def read(spark: SparkSession, root: str, table: str, schema: T.StructType, run: str | None = None) -> DataFrame:
    """A table as one release has it. An unknown table raises LookupError."""
    found = entries(spark, root, run)
    if table not in found:
        raise LookupError(f"{table} is in no release under {root}")
    return read_parts(spark, list(found[table].values()), schema)
