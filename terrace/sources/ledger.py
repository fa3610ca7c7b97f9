"""Processed-item ledger, version gates and publish status.

The ledger is an append-only Parquet table per pipe. No entry is ever deleted:
a reset appends a marker, and readers only see entries after the latest
marker. Past MAX_TAIL files its entries are gathered in a snapshot (``compact``). Each append is one small Spark write; the gates are aggregates over
the ledger (``max``/``max_by``), evaluated in Spark. An append run records
its batch id as an intent before writing and its items after, so an
interrupted run is visible in the ledger itself.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .. import schemas
from . import files

ITEM, VERSION, RESET, PENDING, OUTPUT, QUALITY = "item", "version", "reset", "pending", "output", "quality"
COVERED = "covered"                    # in a snapshot: a file whose rows it holds
SNAPSHOTS = "_snapshots"
MAX_TAIL = 64                          # appended files beside a snapshot


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _snapshots(spark: SparkSession, path: str) -> list[files.Child]:
    """Complete snapshots, oldest first: folders that hold their one file."""
    return [c for c in files.children(spark, f"{path}/{SNAPSHOTS}")
            if c.is_dir and any(f.name.endswith(".parquet") for f in files.children(spark, c.path))]


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame | None, list[files.Child]]:
    """(latest snapshot, appended files that it does not cover)."""
    tail = [c for c in files.children(spark, path) if c.name.endswith(".parquet")]
    done = _snapshots(spark, path)
    if not done:
        return None, tail
    snapshot = spark.read.schema(schemas.LEDGER).parquet(done[-1].path)
    covered = {r["item"] for r in snapshot.where(F.col("kind") == COVERED).select("item").collect()}
    return snapshot.where(F.col("kind") != COVERED), [c for c in tail if c.name not in covered]


def read(spark: SparkSession, path: str) -> DataFrame:
    """All ledger rows, from the latest snapshot and the files appended
    since; an absent ledger reads as empty."""
    snapshot, tail = _parts(spark, path)
    if tail:
        rows = spark.read.schema(schemas.LEDGER).parquet(*[c.path for c in tail])
        return rows if snapshot is None else snapshot.unionByName(rows)
    return spark.createDataFrame([], schemas.LEDGER) if snapshot is None else snapshot


def compact(spark: SparkSession, path: str) -> None:
    """Write all rows into a new snapshot, one file that also names the appended
    files it covers, so that it exists whole or not at all. Covered files are
    not read any more; those that the snapshot before covers too are removed,
    and older snapshots with them (readers that began before a compaction still
    find what they listed). A compaction that stops anywhere loses nothing."""
    older = _snapshots(spark, path)
    now = [c for c in files.children(spark, path) if c.name.endswith(".parquet")]
    rows = read(spark, path)
    names = spark.createDataFrame([("", c.name, COVERED, "", _now()) for c in now], schemas.LEDGER)
    rows.unionByName(names).coalesce(1).write.parquet(f"{path}/{SNAPSHOTS}/{_now():%Y%m%dT%H%M%S%f}")
    if older:
        before = {r["item"] for r in spark.read.schema(schemas.LEDGER).parquet(older[-1].path)
                  .where(F.col("kind") == COVERED).select("item").collect()}
        files.remove(spark, [c.path for c in now if c.name in before] + [c.path for c in older[:-1]])


def last_reset(spark: SparkSession, path: str) -> int:
    """Microseconds since the epoch of the latest reset marker, or 0."""
    return (read(spark, path).where(F.col("kind") == RESET)
            .agg(F.coalesce(F.max(F.unix_micros("ts")), F.lit(0).cast("long"))).first()[0])


def active(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows written after the latest reset marker."""
    led = read(spark, path)
    # One scalar (the latest reset time) comes back to the driver.
    last_reset = led.where(F.col("kind") == RESET).agg(F.max("ts")).first()[0]
    led = led.where(F.col("kind") != RESET)
    if last_reset is not None:
        led = led.where(F.col("ts") > F.lit(last_reset))
    return led


def processed_items(spark: SparkSession, path: str) -> DataFrame:
    return active(spark, path).where(F.col("kind") == ITEM).select("item")


def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches in the output, in the order of their commits: one
    name per run since the latest reset."""
    done = active(spark, path).where(F.col("kind") == ITEM).groupBy("run_id").agg(F.min("ts").alias("ts"))
    return [r["run_id"] for r in done.orderBy("ts", "run_id").collect()]


def append(spark: SparkSession, path: str, pipe: str, entries: list[str], kind: str = ITEM,
           run_id: str | None = None) -> None:
    """One ledger row per entry, all stamped with one run id/time."""
    ts = _now()
    run_id = run_id or ts.strftime("%Y%m%dT%H%M%S%f")
    rows = [(pipe, e, kind, run_id, ts) for e in entries] or [(pipe, "", kind, run_id, ts)]
    spark.createDataFrame(rows, schemas.LEDGER).coalesce(1).write.mode("append").parquet(path)
    if len(_parts(spark, path)[1]) > MAX_TAIL:
        compact(spark, path)


def reset(spark: SparkSession, path: str, pipe: str) -> None:
    """Append a reset marker; data stay until the next run overwrites."""
    append(spark, path, pipe, ["*"], kind=RESET)


def is_empty(spark: SparkSession, path: str) -> bool:
    """No processed entry since the latest reset (write intents and counts do
    not count)."""
    return active(spark, path).where(~F.col("kind").isin(PENDING, QUALITY)).limit(1).count() == 0


def record_quality(spark: SparkSession, path: str, pipe: str, counts: dict[str, dict[str, int]],
                   run_id: str | None = None) -> None:
    """One row per run: the counts of its reconciliation steps, as JSON."""
    append(spark, path, pipe, [json.dumps(counts, sort_keys=True)], kind=QUALITY, run_id=run_id)


def quality(spark: SparkSession, path: str) -> DataFrame:
    """(pipe, run_id, ts, step, rows, unknown) of all recorded runs."""
    steps = F.from_json("item", "map<string, struct<rows: bigint, unknown: bigint>>")
    return (read(spark, path).where(F.col("kind") == QUALITY)
            .select("pipe", "run_id", "ts", F.explode(steps).alias("step", "c"))
            .select("pipe", "run_id", "ts", "step", "c.rows", "c.unknown"))


def current_output(spark: SparkSession, path: str) -> str | None:
    """The output folder of the latest completed full refresh (all ledger
    rows, resets included: a reset does not remove the data)."""
    return (read(spark, path).where(F.col("kind") == OUTPUT)
            .agg(F.max_by("item", "ts")).first()[0])


def begin(spark: SparkSession, path: str, pipe: str, batch: str) -> None:
    """Write-ahead intent: the batch about to be written, recorded before the
    write so that a run stopping between its write and its ``append`` can be
    recognised from the ledger alone."""
    append(spark, path, pipe, [batch], kind=PENDING, run_id=batch)


def unfinished_batch(spark: SparkSession, path: str) -> str | None:
    """A batch whose intent is recorded but whose items are not: its write may
    be in the output. The next run reuses the id, so it overwrites it."""
    led = active(spark, path)
    pending = led.where(F.col("kind") == PENDING).select("run_id")
    done = led.where(F.col("kind") == ITEM).select("run_id")
    return pending.join(done, "run_id", "left_anti").agg(F.min("run_id")).first()[0]


def newer_than_all(spark: SparkSession, source_mtime: DataFrame, path: str) -> DataFrame:
    """One-row DataFrame ``run`` = source mtime strictly greater than
    every recorded version (true when nothing is recorded). Versions are
    recorded as microseconds since the epoch, so no time zone takes part."""
    rec = (active(spark, path).where(F.col("kind") == VERSION)
           .agg(F.max(F.col("item").cast("long"))).first()[0])
    if rec is None:
        return source_mtime.select(F.lit(True).alias("run"))
    return source_mtime.select((F.unix_micros("mtime") > F.lit(rec)).alias("run"))


def last_versions(spark: SparkSession, path: str) -> DataFrame:
    """The version vector recorded by the most recent run: (item) rows of the
    latest run id."""
    v = active(spark, path).where(F.col("kind") == VERSION)
    last = v.agg(F.max_by("run_id", "ts").alias("_run"))
    return v.join(F.broadcast(last), v.run_id == last._run).select("item")


def version_vector_fresh(spark: SparkSession, current: DataFrame, path: str) -> DataFrame:
    """One-row DataFrame ``fresh`` = the current version vector (rows of
    ``source``, ``version`` text) equals the vector of the latest run.
    Compared as sets of ``source=version`` entries (full outer join)."""
    cur = current.select(F.concat_ws("=", "source", "version").alias("item"))
    rec = last_versions(spark, path)
    both = cur.withColumn("_c", F.lit(1)).join(rec.withColumn("_r", F.lit(1)), "item", "full")
    return both.agg(
        ((F.count(F.lit(1)) > 0)
         & (F.sum(F.when(F.col("_c").isNull() | F.col("_r").isNull(), 1).otherwise(0)) == 0))
        .alias("fresh"))


def record_versions(spark: SparkSession, current: DataFrame, path: str, pipe: str) -> None:
    """Append the current version vector as the latest run (written by Spark
    directly from the DataFrame)."""
    ts = _now()
    run_id = ts.strftime("%Y%m%dT%H%M%S%f")
    (current.select(F.lit(pipe).alias("pipe"),
                    F.concat_ws("=", "source", "version").alias("item"),
                    F.lit(VERSION).alias("kind"), F.lit(run_id).alias("run_id"),
                    F.lit(ts).cast("timestamp").alias("ts"))
            .coalesce(1).write.mode("append").parquet(path))


# --- publish status (A18) ----------------------------------------------------

SUCCESS, FAILED = "SUCCESS", "FAILED_UPDATE"


def record_status(spark: SparkSession, path: str, pipe: str, status: str,
                  output: str | None = None, database: str | None = None) -> None:
    spark.createDataFrame([(pipe, status, output, database, _now())],
                          schemas.PUBLISH_STATUS).coalesce(1).write.mode("append").parquet(path)


def last_status(spark: SparkSession, path: str) -> DataFrame:
    """Latest status per pipe (arg-max by time), with the output and
    database remembered by a failed publish for the retry."""
    try:
        log = spark.read.schema(schemas.PUBLISH_STATUS).parquet(path)
    except AnalysisException:
        log = spark.createDataFrame([], schemas.PUBLISH_STATUS)
    z = F.max_by(F.struct("status", "output", "database", "ts"), "ts")
    return log.groupBy("pipe").agg(z.alias("z")).select("pipe", "z.*")


def last_published(spark: SparkSession, path: str, pipe: str) -> str | None:
    """Output folder of the latest successful publish of ``pipe``."""
    try:
        log = spark.read.schema(schemas.PUBLISH_STATUS).parquet(path)
    except AnalysisException:
        return None
    done = log.where((F.col("pipe") == pipe) & (F.col("status") == SUCCESS))
    return done.agg(F.max_by("output", "ts").alias("output")).first()["output"]


def retry_candidates(spark: SparkSession, path: str) -> DataFrame:
    return last_status(spark, path).where(F.col("status") == FAILED)
