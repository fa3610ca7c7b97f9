"""Curated-zone runs: version gate (A16), refresh (A10), publish (A17) with
status and retry (A18).

A run recomputes a curated table only when the version vector of its inputs
(latest modification time under each input folder) differs from the vector
recorded by its last run. Each refresh is written to a new version folder and
publishing points the table at it (no copy). A failed publish is recorded
with the folder it needs for a retry, and a later run retries it even when
the data are fresh; meanwhile the table keeps reading the previous version.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.joins import held_sides
from ..sources import files, ledger, releases
from ..sources.sinks import new_version, publish, write_refresh
from . import curate
from .standardise import read_formatted

log = logging.getLogger(__name__)

# table -> (database, inputs in order, plan)
CURATED = {
    "neighbourhood": ("descriptive", ["income_opendata", "padro_opendata"],
                      lambda s, f: curate.neighbourhood(
                          read_formatted(s, f, "income_opendata", schemas.INCOME),
                          read_formatted(s, f, "padro_opendata", schemas.MOVES))),
    "real_estate": ("descriptive", ["padro_opendata", "idealista"],
                    lambda s, f: curate.real_estate(
                        read_formatted(s, f, "padro_opendata", schemas.MOVES),
                        read_formatted(s, f, "idealista", schemas.LISTING))),
    "sale_prices": ("descriptive", ["idealista", "income_opendata"],
                    lambda s, f: curate.sale_prices(
                        read_formatted(s, f, "idealista", schemas.LISTING),
                        read_formatted(s, f, "income_opendata", schemas.INCOME))),
    "sales": ("predictive", ["idealista", "income_opendata", "padro_opendata"],
              lambda s, f: curate.sales(
                  read_formatted(s, f, "idealista", schemas.LISTING),
                  read_formatted(s, f, "income_opendata", schemas.INCOME),
                  read_formatted(s, f, "padro_opendata", schemas.MOVES))),
}


SCHEMAS = {"neighbourhood": schemas.NEIGHBOURHOOD, "real_estate": schemas.REAL_ESTATE,
           "sale_prices": schemas.SALE_PRICES, "sales": schemas.SALES}


def version_vector(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """(source, version) rows: latest file time under each input folder."""
    parts = [files.max_mtime(spark, path).select(F.lit(name).alias("source"),
                                                 F.unix_micros("mtime").cast("string").alias("version"))
             for name, path in roots.items()]
    return reduce(DataFrame.unionByName, parts)


def extract(spark: SparkSession, table: str, formatted: str, exploitation: str) -> str | None:
    """Refresh one curated table if its inputs changed; returns the output
    folder, or None when the table is already up to date."""
    _, inputs, plan = CURATED[table]
    led = f"{exploitation}/{table}/_ledger"
    current = version_vector(spark, {i: f"{formatted}/{i}/out" for i in inputs})
    if ledger.version_vector_fresh(spark, current, led).first()["fresh"]:
        return None
    out = new_version(f"{exploitation}/{table}")
    with held_sides():
        write_refresh(plan(spark, formatted), out)
    # The folder is recorded before the versions: a run that stops between
    # here and publishing leaves what the next run needs to publish it.
    ledger.append(spark, led, table, [out], kind=ledger.OUTPUT)
    ledger.record_versions(spark, current, led, table)
    return out


def publish_tracked(spark: SparkSession, table: str, out: str, database: str,
                    status_log: str, location: str | None = None) -> bool:
    """A17 + A18: publish and record the outcome."""
    try:
        publish(spark, out, database, table, location)
    except Exception:  # noqa: BLE001 - any failure is recorded for a retry
        log.exception("publishing %s failed", table)
        ledger.record_status(spark, status_log, table, ledger.FAILED, out, database)
        return False
    ledger.record_status(spark, status_log, table, ledger.SUCCESS, out, database)
    return True


def published(spark: SparkSession, database: str, table: str, exploitation: str | None = None,
              location: str | None = None) -> DataFrame:
    """A published table, read through the catalog. A catalog that lacks it
    (another process, a session without a persistent metastore) gets it again
    from the status log of ``exploitation``: the folder published last."""
    if exploitation and not spark.catalog.tableExists(f"{database}.{table}"):
        out = ledger.last_published(spark, f"{exploitation}/_publish_status", table)
        if out is None:
            raise LookupError(f"{table} has not been published under {exploitation}")
        publish(spark, out, database, table, location)
    return spark.table(f"`{database}`.`{table}`")


def record_release(spark: SparkSession, exploitation: str) -> str | None:
    """Record the set of published folders as a release, if it is a whole set:
    every table is published at its latest output, and all were made from the
    same versions of the inputs that they share. Returns the new release, or
    None if the set is not whole or not new. Until then readers of
    ``released`` stay on the earlier set."""
    status = {r["pipe"]: r for r in ledger.last_status(spark, f"{exploitation}/_publish_status").collect()}
    now: releases.Entries = {}
    versions: dict[str, set[str]] = {}
    for table in CURATED:
        led = f"{exploitation}/{table}/_ledger"
        out, seen = ledger.current_output(spark, led), status.get(table)
        if out is None or seen is None or seen["status"] != ledger.SUCCESS or seen["output"] != out:
            return None
        now[table] = {"all": out}
        for r in ledger.last_versions(spark, led).collect():              # one row per input
            source, version = r["item"].split("=", 1)
            versions.setdefault(source, set()).add(version)
    if any(len(v) > 1 for v in versions.values()) or releases.entries(spark, exploitation) == now:
        return None
    return releases.commit(spark, exploitation, now)


def released(spark: SparkSession, exploitation: str, table: str, release: str | None = None) -> DataFrame:
    """A curated table as one release has it (default: the latest). Tables of a
    release were made from the same inputs."""
    return releases.read(spark, exploitation, table, SCHEMAS[table], release)


def run(spark: SparkSession, formatted: str, exploitation: str, tables: list[str] | None = None,
        location: str | None = None) -> dict[str, str]:
    """Extract and publish; a fresh table is skipped, unless its last output has
    not been published (the publish failed or was never reached) or this
    session's catalog does not have the table: then it is published again."""
    status_log = f"{exploitation}/_publish_status"
    last = {r.pipe: r for r in ledger.last_status(spark, status_log).collect()}
    result = {}
    for table in tables or list(CURATED):
        database = CURATED[table][0]
        out = extract(spark, table, formatted, exploitation)
        if out is None:
            current = ledger.current_output(spark, f"{exploitation}/{table}/_ledger")
            seen = last.get(table)
            if seen is not None and seen.status != ledger.SUCCESS:
                out, database = current or seen.output, seen.database or database
            elif current and (seen is None or seen.output != current
                              or not spark.catalog.tableExists(f"{database}.{table}")):
                out = current
        if out is None:
            result[table] = "fresh"
            continue
        ok = publish_tracked(spark, table, out, database, status_log, location)
        result[table] = ledger.SUCCESS if ok else ledger.FAILED
    record_release(spark, exploitation)
    return result
