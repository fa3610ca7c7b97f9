"""Readers (A1-A8) and landing-item discovery.

A landing item is a file or a directory of part files whose name matches a
pattern (``*_idealista``, ``*_pad_cdo_b_barri-des.csv``). Items are listed
with the ``binaryFile`` source, selecting only path and modification time, so
no file content is read; the listing is file metadata, bounded by the number
of files, not by rows.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

ITEM_SCHEMA = T.StructType([
    T.StructField("item", T.StringType()), T.StructField("stem", T.StringType()),
    T.StructField("path", T.StringType()), T.StructField("mtime", T.TimestampType()),
])


class Child(NamedTuple):
    name: str
    path: str
    is_dir: bool
    mtime_ms: int


def children(spark: SparkSession, folder: str) -> list[Child]:
    """Direct children of a folder (hidden ones left out, a missing folder has
    none), by the Hadoop file system that Spark reads it with. One listing call
    on the driver; nothing below the children is visited."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if not name.startswith((".", "_")):
            out.append(Child(name, status.getPath().toString(), status.isDirectory(), status.getModificationTime()))
    return sorted(out)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete files or folders that no reader names any more."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def list_items(spark: SparkSession, root: str, item_regex: str) -> DataFrame:
    """One row per landing item under ``root`` whose name matches
    ``item_regex`` (a regex on the item name, anchored at both ends):
    item name, stem (name without extension), item path and latest mtime."""
    try:
        files = (spark.read.format("binaryFile")
                      .option("recursiveFileLookup", "true")
                      .load(root)
                      .select("path", "modificationTime"))
    except AnalysisException:
        return spark.createDataFrame([], ITEM_SCHEMA)
    # Only the first path part below root names an item; folders above root and
    # deeper ones of the same form do not.
    below = below_root(root)
    item = F.regexp_extract(F.col("path"), rf"{below}({item_regex})(?:/|$)", 1)
    item_path = F.regexp_extract(F.col("path"), rf"^(.*?{below}(?:{item_regex}))(?:/|$)", 1)
    return (files.select(item.alias("item"), item_path.alias("ipath"), "modificationTime")
                 .where(F.col("item") != "")
                 .groupBy("item")
                 .agg(F.max("modificationTime").alias("mtime"), F.min("ipath").alias("path"))
                 .select("item",
                         F.regexp_replace("item", r"\.[^.]*$", "").alias("stem"),
                         "path", "mtime"))


def below_root(root: str) -> str:
    """Regex for the part of a file's path up to its name below ``root``."""
    path = re.sub(r"^\w+:(?://)?", "", root).rstrip("/")
    return "".join(c if c.isalnum() or c in "/_" else "\\" + c for c in path) + "/"


def new_items(spark: SparkSession, items: DataFrame, processed: DataFrame) -> list[str]:
    """Paths of items whose stem is not in the ledger (left anti
    join). Returns file paths for the multi-path scan that follows; this is
    the file list Spark's own scan would list on the driver anyway."""
    fresh = items.join(processed.select(F.col("item").alias("stem")), "stem", "left_anti")
    return [r.path for r in fresh.select("path").orderBy("path").collect()]


def read_parquet(spark: SparkSession, paths: list[str], merge_schema: bool = False) -> DataFrame:
    """A1/A5: one multi-path Parquet scan (G1 union of items for free)."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


def parquet_groups(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Scans of all items, so that items whose columns differ in type do not
    meet before they are aligned: one scan if their schemas merge (one job reads
    all footers, however many items there are), else one per schema that occurs
    among them."""
    try:
        return [spark.read.option("mergeSchema", "true").parquet(*paths)]
    except Exception as e:  # noqa: BLE001 - only schemas that do not merge are handled
        if "MERGE_SCHEMAS" not in str(e) and "merge" not in str(e).lower():
            raise
    groups: dict[str, list[str]] = {}
    for p in paths:
        groups.setdefault(spark.read.parquet(p).schema.json(), []).append(p)
    return [spark.read.parquet(*g) for g in groups.values()]


def read_csv_items(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """A2 for items with headers of their own: the items are grouped by
    header, each group is read under it, and ``columns`` are taken by name.
    A column that an item lacks, or a part file whose header differs from its
    item's, fails the job."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        header = tuple(spark.read.option("header", "true").option("inferSchema", "false").csv(p).columns)
        groups.setdefault(header, []).append(p)
    out = None
    for header, items in groups.items():
        missing = [c for c in columns if c not in header]
        if missing:
            raise ValueError(f"columns {missing} are not in the header of {items}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        part = (spark.read.schema(schema).option("header", "true").option("enforceSchema", "false")
                     .csv(items).select(*[F.col(f"`{c}`") for c in columns]))
        out = part if out is None else out.unionByName(part)
    return out


def read_csv_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A2: headered CSV, every column as text. No schema inference pass:
    only the header line is read to name the columns."""
    return spark.read.option("header", "true").option("inferSchema", "false").csv(paths)


def read_json(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """A3/A4: JSON lines with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def read_json_strict(spark: SparkSession, path: str, schema: T.StructType, arrays: list[str]) -> DataFrame:
    """A3 + B6: JSON lines with a declared schema, where the records of the
    struct arrays ``arrays`` may hold declared fields only.

    Each line is parsed once, as a variant; declared fields are taken from it
    with their types (a value of another type fails the job), and the keys that
    the records really have are compared with the declared ones: any other
    fails the job, which names it. Absent fields are null."""
    lines = spark.read.option("singleVariantColumn", "v").option("mode", "FAILFAST").json(path)
    cols = []
    for f in schema.fields:
        at = "$['" + f.name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        c = F.variant_get("v", at, f.dataType.simpleString())
        if f.name in arrays:
            known = [F.lit(n) for n in f.dataType.elementType.fieldNames()]
            records = F.variant_get("v", at, "array<map<string,variant>>")
            keys = F.array_distinct(F.flatten(F.transform(F.filter(records, lambda r: r.isNotNull()), F.map_keys)))
            other = F.array_except(keys, F.array(*known))
            message = F.concat(F.lit(f"undeclared fields in {f.name}: "), F.array_join(F.array_sort(other), ", "))
            c = F.when(F.size(other) > 0, F.raise_error(message).cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return lines.select(*cols)


def max_mtime(spark: SparkSession, root: str) -> DataFrame:
    """A15/A16 input: the latest modification time under a directory, as a
    one-row DataFrame (file metadata only)."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                      .load(root).select("modificationTime"))
    except AnalysisException:
        return spark.createDataFrame([(None,)], "mtime timestamp")
    return files.agg(F.max("modificationTime").alias("mtime"))
