"""Standardising plans (P1-P3): raw landing items -> formatted tables.

Each has a pure part (DataFrame in, DataFrame out) and a ``commit`` part
that chooses the input items from the ledger, writes, and records. The pure
part is one stage over the scan: flatten/parse, then broadcast lookups, then
a typed ``select``; no shuffle of the fact rows except E5 (partial
aggregation) for income.
"""

from __future__ import annotations

import uuid
from functools import reduce
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import (conform, flatten_structs, item_prefix, landing_item,
                                 sentinel_to_null, stem_of, strict_long, year_of)
from ..operators.aggregates import keep_first
from ..operators.joins import Quality, checked_broadcast, explode_lookup, reconcile, held_sides
from ..sources import files, ledger
from ..sources.sinks import batch_folder, new_version, write_first_or_append, write_refresh
from ..streaming.file_feed import FILE_COL, ingest_available
from .landing import INCOME_ITEM, LISTING_SUFFIX, MOVES_SUFFIX, Landing

LISTING_ITEMS = r"[^/]*" + LISTING_SUFFIX
MOVES_ITEMS = r"[^/]*" + MOVES_SUFFIX.replace(".", r"\.")


# Partitions within a batch: the year that the curated joins use.
YEAR_PART = "part_year"


def listing_parts() -> dict[str, Column]:
    return {YEAR_PART: year_of("queryDate")}


def moves_parts() -> dict[str, Column]:
    return {YEAR_PART: F.col("year")}


# --- lookups (D1, D3, D4) -----------------------------------------------------

def listing_lookup(spark: SparkSession, lookups: str) -> DataFrame:
    """Raw (district, neighbourhood) names -> reconciled names and ids."""
    d = files.read_json(spark, f"{lookups}/rent_lookup_district.json", schemas.RENT_DISTRICT)
    n = files.read_json(spark, f"{lookups}/rent_lookup_neighborhood.json",
                        schemas.RENT_NEIGHBOURHOOD)
    return explode_lookup(d, "ne_id", {"_di": "di", "_di_re": "di_re", "_di_id": "_id"},
                          n, "_id", {"_ne": "ne", "_ne_re": "ne_re", "_ne_id": "_id"})


def moves_lookup(spark: SparkSession, lookups: str) -> DataFrame:
    """D3 + D4: integer neighbourhood code -> reconciled names and ids, via
    the exploded district lookup and the name-to-code bridge."""
    d = files.read_json(spark, f"{lookups}/income_lookup_district.json", schemas.INCOME_DISTRICT)
    n = files.read_json(spark, f"{lookups}/padro_lookup_neighborhood.json",
                        schemas.INCOME_NEIGHBOURHOOD)
    bridge = files.read_json(spark, f"{lookups}/BarcelonaCiutat_Barri.json", schemas.CODE_BRIDGE)
    lk = explode_lookup(d, "neighborhood_id",
                        {"_d_raw": "district", "district_name": "district_reconciled",
                         "district_id": "_id"},
                        n, "_id",
                        {"_n_raw": "neighborhood", "neighborhood_name": "neighborhood_reconciled",
                         "neighborhood_id": "_id"})
    return (lk.join(bridge, (lk._d_raw == bridge.nom_districte) & (lk._n_raw == bridge.nom_barri))
              .select(strict_long("codi_barri").alias("code"), "neighborhood_name",
                      "neighborhood_id", "district_name", "district_id"))


# --- P1 listings --------------------------------------------------------------

def standardise_listings(raw: DataFrame, lookup: DataFrame, below: str = "/",
                         quality: Quality | None = None) -> DataFrame:
    """B1 flatten, A7 per-row file date, D2 reconciliation, B4 override, B6."""
    if "_file" in raw.columns:      # streamed micro-batch: path already attached
        tagged = raw.select("*", landing_item(LISTING_SUFFIX, "_file", below).alias("_item")).drop("_file")
    else:
        tagged = raw.select("*", landing_item(LISTING_SUFFIX, below=below).alias("_item"))
    flat = flatten_structs(tagged)
    flat = flat.withColumn("queryDate", item_prefix("_item", 10)).drop("_item")
    lk = checked_broadcast(lookup, name="listing lookup")
    joined = reconcile(flat, lk, (F.col("district") == F.col("_di")) & (F.col("neighborhood") == F.col("_ne")),
                       "place", quality)
    out = joined.withColumns({"district": F.col("_di_re"), "district_id": F.col("_di_id"),
                              "neighborhood": F.col("_ne_re"),
                              "neighborhood_id": F.col("_ne_id")})
    return conform(out.drop("_di", "_di_re", "_di_id", "_ne", "_ne_re", "_ne_id"),
                   schemas.LISTING, extra="error", enforce_not_null=True)


# --- P2 movements -------------------------------------------------------------

def standardise_moves(raw: DataFrame, lookup: DataFrame, quality: Quality | None = None) -> DataFrame:
    """S1 strict integer codes, S2 sentinel, D5/D6 the same lookup in the
    origin and destination roles, B8 the typed movement record."""
    lk = checked_broadcast(lookup, name="movement lookup")
    src = lk.select(F.col("code").alias("_src_code"), "neighborhood_name", "neighborhood_id",
                    "district_name", "district_id")
    dst = lk.select(F.col("code").alias("_dst_code"),
                    F.col("neighborhood_name").alias("dest_neighborhood_name"),
                    F.col("neighborhood_id").alias("dest_neighborhood_id"),
                    F.col("district_name").alias("dest_district_name"),
                    F.col("district_id").alias("dest_district_id"))
    rows = raw.select(strict_long("Codi_Barri").alias("_src"),
                      strict_long("CODI_BARRI_DEST").alias("_dst"),
                      strict_long("Any").alias("year"),
                      sentinel_to_null("Valor").alias("moved"))
    rows = reconcile(rows, src, F.col("_src") == F.col("_src_code"), "origin", quality)
    rows = reconcile(rows, dst, F.col("_dst") == F.col("_dst_code"), "destination", quality)
    return conform(rows.drop("_src", "_dst", "_src_code", "_dst_code"), schemas.MOVES)


# --- P3 income ----------------------------------------------------------------

def spread_info(df: DataFrame, array_col: str = "info") -> DataFrame:
    """S9 + B5: one row per array element, the struct's fields spread as
    columns and overriding same-named base columns; the array is dropped."""
    fields = df.schema[array_col].dataType.elementType.fieldNames()
    base = [c for c in df.columns if c != array_col and c not in fields]
    return df.select(*base, F.inline(array_col))


def standardise_income(raw: DataFrame, districts: DataFrame, neighbourhoods: DataFrame,
                       quality: Quality | None = None) -> DataFrame:
    """B3 rename, D7/D8 reconciliation, B4, S9/B5 spread, E5 de-duplicate."""
    base = raw.select(F.col("`neigh_name `").alias("neighborhood_name"), "district_name", "info")
    d = checked_broadcast(districts.select(F.col("district").alias("_d_raw"),
                                           F.col("district_reconciled").alias("_d_re"),
                                           F.col("_id").alias("_d_id")), name="district lookup")
    n = checked_broadcast(neighbourhoods.select(F.col("neighborhood").alias("_n_raw"),
                                                F.col("neighborhood_reconciled").alias("_n_re"),
                                                F.col("_id").alias("_n_id")),
                          name="neighbourhood lookup")
    df = (reconcile(base, d, F.col("district_name") == F.col("_d_raw"), "district", quality)
              .withColumns({"district_name": F.col("_d_re"), "district_id": F.col("_d_id")}))
    df = (reconcile(df, n, F.col("neighborhood_name") == F.col("_n_raw"), "neighbourhood", quality)
              .withColumns({"neighborhood_name": F.col("_n_re"),
                            "neighborhood_id": F.col("_n_id")})
              .select("neighborhood_name", "district_name", "district_id", "neighborhood_id",
                      "info"))
    flat = spread_info(df)
    return conform(keep_first(flat, ["district_id", "neighborhood_id", "year"]), schemas.INCOME)


# --- commit: ledger-driven runs --------------------------------------------------

def _run_id() -> str:
    return uuid.uuid4().hex[:12]


def _stem(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name else name


def commit_items(spark: SparkSession, root: str, item_regex: str, out: str, led: str, pipe: str,
                 load: Callable[[list[str]], DataFrame], by: dict[str, Column] | None = None,
                 quality: Quality | None = None) -> list[str]:
    """A9 + A11 + A12: process only items whose stem is not in the ledger;
    overwrite the output on the first run (empty ledger), else add a batch;
    then record the stems under the batch id. ``load`` turns the new item
    paths into the standardised DataFrame (one multi-path scan); ``by`` names
    partitions of a batch; the counts that ``quality`` takes during the write
    are recorded with it.

    The batch id is recorded as an intent before the write. A run that
    stopped after its write but before recording its items left such an
    unfinished batch; the next run takes over its id (its items are still
    unrecorded, so all of them are in the new input) and overwrites it."""
    items = files.list_items(spark, root, item_regex)
    paths = files.new_items(spark, items, ledger.processed_items(spark, led))
    if not paths:
        return []
    first = ledger.is_empty(spark, led)
    batch = (None if first else ledger.unfinished_batch(spark, led)) or _run_id()
    ledger.begin(spark, led, pipe, batch)
    with held_sides():
        write_first_or_append(load(paths), out, first, batch, by)
    stems = [_stem(p) for p in paths]
    if quality is not None:
        ledger.record_quality(spark, led, pipe, quality.counts(), batch)
    ledger.append(spark, led, pipe, stems, run_id=batch)
    return stems


def commit_listings(spark: SparkSession, land: Landing, formatted: str) -> list[str]:
    """P1 run over new ``*_idealista`` items."""
    lookup, quality = listing_lookup(spark, land.lookups), Quality()
    return commit_items(
        spark, land.listings, LISTING_ITEMS, f"{formatted}/idealista/out",
        f"{formatted}/idealista/_ledger", "idealista",
        lambda paths: reduce(DataFrame.unionByName, [
            standardise_listings(g, lookup, files.below_root(land.listings), quality)
            for g in files.parquet_groups(spark, paths)]), listing_parts(), quality)


def commit_moves(spark: SparkSession, land: Landing, formatted: str) -> list[str]:
    """P2 run over new ``*_pad_cdo_b_barri-des.csv`` items."""
    lookup, quality = moves_lookup(spark, land.lookups), Quality()
    return commit_items(
        spark, land.moves, MOVES_ITEMS, f"{formatted}/padro_opendata/out",
        f"{formatted}/padro_opendata/_ledger", "padro_opendata",
        lambda paths: standardise_moves(
            files.read_csv_items(spark, paths, schemas.RAW_MOVES_COLUMNS), lookup, quality), moves_parts(), quality)


def commit_income(spark: SparkSession, land: Landing, formatted: str) -> list[str]:
    """P3 run, gated (A15): only when the income file is strictly newer than
    every recorded version; always a full refresh.

    The refresh goes to a new version folder, recorded in the ledger only
    after the write; readers take the latest recorded folder, so a run that
    stops mid-write never exposes a partial table and the rerun (the gate is
    still open) writes a fresh version."""
    out, led = f"{formatted}/income_opendata/out", f"{formatted}/income_opendata/_ledger"
    src = f"{land.income}/{INCOME_ITEM}"
    mtime = files.max_mtime(spark, src)
    if mtime.first()["mtime"] is None:
        raise FileNotFoundError(src)
    if not ledger.newer_than_all(spark, mtime, led).first()["run"]:
        return []
    version = mtime.select(F.unix_micros("mtime").cast("string").alias("v")).first()["v"]
    raw = files.read_json_strict(spark, src, schemas.RAW_INCOME, ["info"])
    d = files.read_json(spark, f"{land.lookups}/income_lookup_district.json",
                        schemas.INCOME_DISTRICT)
    n = files.read_json(spark, f"{land.lookups}/income_lookup_neighborhood.json",
                        schemas.INCOME_NEIGHBOURHOOD)
    folder, quality = new_version(out), Quality()
    with held_sides():
        write_refresh(standardise_income(raw, d, n, quality), folder)
    ledger.record_quality(spark, led, "income_opendata", quality.counts())
    ledger.append(spark, led, "income_opendata", [folder], kind=ledger.OUTPUT)
    ledger.append(spark, led, "income_opendata", [version], kind=ledger.VERSION)
    return [version]


def stream_listings(spark: SparkSession, land: Landing, formatted: str) -> None:
    """P1 as a Structured Streaming run over the same output and ledger as
    ``commit_listings``: items that a batch run recorded are left out, and the
    streamed ones are recorded, so the two routes may alternate.

    A micro-batch writes the batch named after its epoch and records its items
    afterwards; a replay overwrites that batch. Only items of other runs are
    left out: the checkpoint itself hands each file over once. A reset starts a
    new checkpoint, and the first run after it overwrites the output."""
    lookup = listing_lookup(spark, land.lookups)
    out, led = f"{formatted}/idealista/out", f"{formatted}/idealista/_ledger"
    below = files.below_root(land.listings)
    glob = f"{land.listings}/*{LISTING_SUFFIX}"
    schema = spark.read.option("mergeSchema", "true").parquet(glob).schema
    generation = f"s{ledger.last_reset(spark, led)}"

    def sink(batch: DataFrame, epoch: int) -> None:
        session, run = batch.sparkSession, f"{generation}_{epoch:09d}"
        others = (ledger.active(session, led)
                  .where((F.col("kind") == ledger.ITEM) & ~F.col("run_id").startswith(generation))
                  .select(F.col("item").alias("_stem")))
        fresh = (batch.withColumn("_stem", stem_of(landing_item(LISTING_SUFFIX, FILE_COL, below)))
                      .join(others, "_stem", "left_anti"))
        stems = [r["_stem"] for r in fresh.select("_stem").distinct().collect()]   # names only
        if not stems:
            return
        first, quality = ledger.is_empty(session, led), Quality()
        with held_sides():
            write_first_or_append(standardise_listings(fresh.drop("_stem"), lookup, below, quality),
                                  out, first, run, listing_parts())
        ledger.record_quality(session, led, "idealista", quality.counts(), run)
        ledger.append(session, led, "idealista", sorted(stems), run_id=run)

    ingest_available(spark, glob, schema, sink,
                     f"{formatted}/idealista/_stream_checkpoint/{generation}")


def read_formatted(spark: SparkSession, formatted: str, source: str, schema) -> DataFrame:
    """A formatted table: the latest recorded version folder for a fully
    refreshed table, else the batch-partitioned output (``batch`` is
    bookkeeping)."""
    current = ledger.current_output(spark, f"{formatted}/{source}/_ledger")
    df = spark.read.parquet(current or f"{formatted}/{source}/out")
    return conform(df.drop("batch", YEAR_PART), schema)


def read_batches(spark: SparkSession, formatted: str, source: str, schema, batches: list[str]) -> DataFrame:
    """Some batches of a formatted table, with their partition column
    ``YEAR_PART`` (long): only their folders are listed and read."""
    out = f"{formatted}/{source}/out"
    df = spark.read.option("basePath", out).parquet(*[batch_folder(out, b) for b in batches])
    year = F.col(YEAR_PART).cast("long").alias(YEAR_PART)
    typed = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
             for f in schema.fields]
    return df.select(*typed, year)
