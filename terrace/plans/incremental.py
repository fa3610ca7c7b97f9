"""Incremental refresh of the curated tables.

A run reads only what the formatted zone has gained since the last one, and
its own state:

* *State* is what the aggregates need, in a form that merges: per role, place
  and year the number, sum and largest value of the movements (enough for the
  null-preserving sum) and the smallest names; per place and year the number
  of listings; per place the latest income record. Each run adds the partial
  aggregate of its new batches as a folder; past MAX_PARTIALS of them, they are
  merged into one.
* *Affected keys* come from the new partials: the places and years whose sums
  changed, and the places whose latest income record changed.
* The two tables keyed by place and year are made from the state alone. The
  two tables with a row per listing are parts by year: new listings add parts,
  and only years that hold an affected key are made again, from the listings
  of those years (the formatted zone is partitioned by year, and the year of
  the affected keys prunes the scan at run time).

Everything a run has written becomes visible in one release (see
``sources.releases``). A run that stops earlier leaves folders that no release
names, and the next one starts from the last release. A reset of a formatted
source, whose batches are then no longer in its ledger, starts all over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import conform
from ..operators.joins import at_once, held_sides
from ..sources import files, ledger, releases
from .curate import (PLACE, PLACE_YEAR, latest_income, listing_counts, neighbourhood_rows, real_estate_rows,
                     sale_price_rows, sales_rows)
from .standardise import YEAR_PART, read_batches, read_formatted

MAX_PARTIALS = 16
MOVES, LISTINGS, INCOME = "state_moves", "state_listings", "state_income"
SOURCES = {MOVES: "padro_opendata", LISTINGS: "idealista", INCOME: "income_opendata"}
TABLES = {"neighbourhood": schemas.NEIGHBOURHOOD, "real_estate": schemas.REAL_ESTATE,
          "sale_prices": schemas.SALE_PRICES, "sales": schemas.SALES}
WHOLE = "all"                                        # the part of a table that has one

_MOVES_STATE = schemas.struct([
    ("role", "string"), ("district_id", "string"), ("neighborhood_id", "string"), ("year", "long"),
    ("district_name", "string"), ("neighbourhood_name", "string"), ("n", "long"), ("total", "long"), ("most", "long")])
_LISTINGS_STATE = schemas.struct([("district_id", "string"), ("neighborhood_id", "string"), ("year", "long"),
                                  ("advertisements", "long")])
_INCOME_STATE = schemas.struct([("district_id", "string"), ("neighborhood_id", "string"), ("year", "long"),
                                ("pop", "long"), ("RFD", "double")])
STATE = {MOVES: _MOVES_STATE, LISTINGS: _LISTINGS_STATE, INCOME: _INCOME_STATE}


def root_of(exploitation: str) -> str:
    return f"{exploitation}/_incremental"


# --- mergeable state ------------------------------------------------------------

def move_partials(moves: DataFrame) -> DataFrame:
    """Partial sums of movements under both roles, from one scan: first per
    pair of ends, so that not each movement but each pair is taken twice."""
    pairs = (moves.groupBy("year", *[f"{end}{c}" for end in ("", "dest_") for c in PLACE],
                           *[f"{end}{c}" for end in ("", "dest_") for c in ("district_name", "neighborhood_name")])
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("moved").alias("total"), F.max("moved").alias("most")))
    roles = F.explode(F.array(*[
        F.struct(F.lit(role).alias("role"), F.col(f"{end}district_id").alias("d"), F.col(f"{end}neighborhood_id").alias("n"),
                 F.col(f"{end}district_name").alias("dn"), F.col(f"{end}neighborhood_name").alias("nn"))
        for role, end in (("origin", ""), ("destination", "dest_"))])).alias("r")
    return (pairs.select("year", "n", "total", "most", roles)
                 .groupBy(F.col("r.role").alias("role"), F.col("r.d").alias("district_id"),
                          F.col("r.n").alias("neighborhood_id"), "year", F.col("r.dn").alias("district_name"),
                          F.col("r.nn").alias("neighbourhood_name"))
                 .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most")))


def merged_moves(partials: DataFrame) -> DataFrame:
    """One row per role, place and year. Merging merged rows changes nothing."""
    return (partials.groupBy("role", *PLACE_YEAR)
                    .agg(F.min("district_name").alias("district_name"), F.min("neighbourhood_name").alias("neighbourhood_name"),
                         F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most")))


def merged_listings(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*PLACE_YEAR).agg(F.sum("advertisements").alias("advertisements"))


def moved_sums(state: DataFrame, role: str, alias: str, *names: str) -> DataFrame:
    """E1 from merged state: the value itself where there is one movement, else
    the sum with nulls as 0."""
    value = F.when(F.col("n") == 1, F.col("most")).otherwise(F.coalesce("total", F.lit(0).cast("long")))
    return state.where(F.col("role") == role).select(*PLACE_YEAR, value.alias(alias), *names)


def sums_of_both(state: DataFrame) -> DataFrame:
    """move_in (by origin) and move_out (by destination) where there are both."""
    return moved_sums(state, "origin", "move_in").join(moved_sums(state, "destination", "move_out"), PLACE_YEAR)


def changed_places(now: DataFrame, before: DataFrame) -> DataFrame:
    """Places whose latest income record is not what it was."""
    old = before.select(*PLACE, F.struct("year", "pop", "RFD").alias("was"))
    both = now.select(*PLACE, F.struct("year", "pop", "RFD").alias("is")).join(old, PLACE, "full")
    return both.where(~F.col("is").eqNullSafe(F.col("was"))).select(*PLACE)


# --- rows of the listing tables --------------------------------------------------

def affected_years(listings_state: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Years in which listings meet an affected key: a few rows, from state."""
    return listings_state.join(keys.select(*on).distinct(), on, "left_semi").select("year").distinct()


def listings_of_years(spark: SparkSession, formatted: str, batches: list[str], years: DataFrame) -> DataFrame:
    """Listings of the batches in ``years``. The join is on the partition
    column, so that the scan takes the years' folders only (dynamic pruning)."""
    wanted = F.broadcast(years.where(F.col("year").isNotNull()).select(F.col("year").alias(YEAR_PART)))
    return read_batches(spark, formatted, SOURCES[LISTINGS], schemas.LISTING, batches).join(wanted, YEAR_PART, "left_semi")


def new_listings(spark: SparkSession, formatted: str, batches: list[str], years: list | None) -> DataFrame:
    """Listings of the new batches, without the years that are made again: the
    folders of those are not read."""
    rows = read_batches(spark, formatted, SOURCES[LISTINGS], schemas.LISTING, batches)
    if not years:
        return rows
    part = F.col(YEAR_PART)
    return rows.where(part.isNull() | ~part.isin([y for y in years if y is not None]))


# --- a run -----------------------------------------------------------------------

class _Run:
    """What a run knows and writes; ``entries`` becomes its release."""

    def __init__(self, spark: SparkSession, formatted: str, exploitation: str):
        self.spark, self.formatted, self.root = spark, formatted, root_of(exploitation)
        self.name = releases.new_run()
        self.out = f"{self.root}/runs/{self.name}"
        old = releases.entries(spark, self.root)
        led = lambda feed: f"{formatted}/{SOURCES[feed]}/_ledger"
        self.batches = {f: ledger.committed_batches(spark, led(f)) for f in (MOVES, LISTINGS)}
        version = ledger.current_output(spark, led(INCOME))
        self.batches[INCOME] = [version] if version else []
        if any(set(old.get(f, {})) - set(self.batches[f]) for f in (MOVES, LISTINGS)):
            old = {}
        self.old = old
        self.entries: releases.Entries = {t: dict(parts) for t, parts in old.items()}
        self.fresh = {f: [b for b in self.batches[f] if b not in old.get(f, {})] for f in self.batches}

    def write(self, df: DataFrame, name: str) -> str:
        folder = f"{self.out}/{name}"
        df.write.parquet(folder)
        return folder

    def state(self, feed: str, folders: list[str] | None = None) -> DataFrame:
        """State as of this run, or the given partials of it."""
        folders = list(self.entries.get(feed, {}).values()) if folders is None else folders
        return releases.read_parts(self.spark, folders, STATE[feed])

    def add_partials(self, feed: str, partials, merged) -> list[str]:
        """Write the partial aggregate of the new batches; its folder."""
        if not self.fresh[feed]:
            return []
        rows = read_batches(self.spark, self.formatted, SOURCES[feed], schemas.MOVES if feed == MOVES else schemas.LISTING,
                            self.fresh[feed])
        folder = self.write(conform(partials(rows), STATE[feed]), feed)
        self.entries.setdefault(feed, {}).update({b: folder for b in self.fresh[feed]})
        if len(set(self.entries[feed].values())) > MAX_PARTIALS:
            whole = self.write(conform(merged(self.state(feed)), STATE[feed]), f"{feed}_merged")
            self.entries[feed] = dict.fromkeys(self.entries[feed], whole)
        return [folder]

    def merged_state(self, feed: str, merged) -> DataFrame:
        """Merged state as of this run, written once for its several readers."""
        return releases.read_parts(self.spark, [self.write(conform(merged(self.state(feed)), STATE[feed]), f"{feed}_now")],
                                   STATE[feed])

    def replace(self, table: str, df: DataFrame) -> None:
        self.entries[table] = {WHOLE: self.write(df, table)}

    def replace_years(self, table: str, years: list, df: DataFrame) -> None:
        """Parts of a listing table: those of ``years`` go, what ``df`` (with
        the column YEAR_PART) holds is added."""
        folder = f"{self.out}/{table}"
        df.write.partitionBy(YEAR_PART).parquet(folder)
        gone = {str(y) for y in years}
        parts = {p: f for p, f in self.entries.get(table, {}).items() if p.split("/")[0] not in gone}
        for child in files.children(self.spark, folder):
            if child.is_dir:
                parts[f"{child.name.split('=', 1)[1]}/{self.name}"] = child.path
        self.entries[table] = parts


def refresh(spark: SparkSession, formatted: str, exploitation: str) -> str | None:
    """Bring the four curated tables up to the formatted zone; returns the
    name of the new release, or None if nothing is new (A16)."""
    run = _Run(spark, formatted, exploitation)
    if not any(run.fresh.values()):
        return None
    with held_sides():
        _refresh(run)
    return releases.commit(spark, run.root, run.entries, run.name)


def _refresh(run: _Run) -> None:
    """Steps that do not depend on each other run at the same time: the state
    of the three sources, then the merged state, then the four tables."""
    spark, formatted = run.spark, run.formatted
    income = read_formatted(spark, formatted, SOURCES[INCOME], schemas.INCOME) if run.batches[INCOME] else None
    before = list(run.entries.get(INCOME, {}).values())

    def new_income() -> None:
        if run.fresh[INCOME]:
            run.entries[INCOME] = {run.fresh[INCOME][0]: run.write(conform(latest_income(income), STATE[INCOME]), INCOME)}

    new_moves, *_ = at_once(lambda: run.add_partials(MOVES, move_partials, merged_moves),
                            lambda: run.add_partials(LISTINGS, listing_counts, merged_listings), new_income)
    places = changed_places(run.state(INCOME), run.state(INCOME, before)) if run.fresh[INCOME] else None
    moves, counts = at_once(lambda: run.merged_state(MOVES, merged_moves), lambda: run.merged_state(LISTINGS, merged_listings))
    latest, sums = run.state(INCOME), sums_of_both(moves)

    def neighbourhood() -> None:
        if income is not None and (run.fresh[MOVES] or run.fresh[INCOME]):
            run.replace("neighbourhood", neighbourhood_rows(income, moved_sums(moves, "origin", "moved_out")))

    def real_estate() -> None:
        if run.fresh[MOVES] or run.fresh[LISTINGS]:
            ins = moved_sums(moves, "destination", "moved_in", "district_name", "neighbourhood_name")
            run.replace("real_estate", real_estate_rows(ins, counts))

    def by_listing(table: str, years: DataFrame | None, rows) -> None:
        parts = []
        names = [] if years is None else [r["year"] for r in years.collect()]     # one row a year
        if names:
            parts.append(listings_of_years(spark, formatted, run.batches[LISTINGS], years))
        if run.fresh[LISTINGS]:
            parts.append(new_listings(spark, formatted, run.fresh[LISTINGS], names))
        if parts:
            source = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            run.replace_years(table, names, rows(source))

    jobs = [neighbourhood, real_estate]
    if run.batches[LISTINGS]:
        by_place = None if places is None else affected_years(counts, places, PLACE)
        by_sum = affected_years(counts, run.state(MOVES, new_moves), PLACE_YEAR) if new_moves else None
        again = by_place if by_sum is None else by_sum if by_place is None else by_place.unionByName(by_sum).distinct()
        jobs += [lambda: by_listing("sale_prices", by_place, lambda x: sale_price_rows(x, latest, (YEAR_PART,))),
                 lambda: by_listing("sales", again, lambda x: sales_rows(x, latest, sums, (YEAR_PART,)))]
    at_once(*jobs)


def table(spark: SparkSession, exploitation: str, name: str, release: str | None = None) -> DataFrame:
    """A curated table as of a release (default: the latest). Tables read from
    one release have the same inputs."""
    return releases.read(spark, root_of(exploitation), name, TABLES[name], release)
