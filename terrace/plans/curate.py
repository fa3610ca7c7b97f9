"""Curated (exploitation-zone) tables, P4-P7, as DataFrame -> DataFrame.

Shape of every plan: one large input (listings or movements) joined with
sides whose cardinality is bounded by the dimensions (aggregates keyed by
district, neighbourhood and year, or the latest income record per
neighbourhood). The sides are aggregated with partial aggregation, measured,
and broadcast; the large input is then scanned once, column-pruned, and never
shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.columns import conform, query_date, query_timestamp, year_of
from ..operators.aggregates import latest_per_key, null_preserving_sum, sum_per_key
from ..operators.joins import checked_broadcast, checked_broadcasts

PLACE = ["district_id", "neighborhood_id"]
PLACE_YEAR = PLACE + ["year"]


def origin_sums(moves: DataFrame, alias: str) -> DataFrame:
    """E1 by origin (district, neighbourhood, year)."""
    return sum_per_key(moves, PLACE_YEAR, "moved", alias)


def destination_sums(moves: DataFrame, alias: str, with_names: bool = False) -> DataFrame:
    """E1 (or E2 with the destination names carried) by destination."""
    dest = moves.select(F.col("dest_district_id").alias("district_id"),
                        F.col("dest_neighborhood_id").alias("neighborhood_id"),
                        "year", "moved", "dest_district_name", "dest_neighborhood_name")
    carry = ({"district_name": "dest_district_name",
              "neighbourhood_name": "dest_neighborhood_name"} if with_names else None)
    return sum_per_key(dest, PLACE_YEAR, "moved", alias, carry)


def both_sums(moves: DataFrame, origin_alias: str, dest_alias: str) -> DataFrame:
    """Origin and destination sums from ONE scan and ONE aggregation: each
    movement is emitted under both roles, grouped by (role, place, year), and
    the two roles are pivoted back into two columns keyed by (place, year)."""
    roles = F.explode(F.array(
        F.struct(F.lit("o").alias("role"), F.col("district_id").alias("d"),
                 F.col("neighborhood_id").alias("n")),
        F.struct(F.lit("d").alias("role"), F.col("dest_district_id").alias("d"),
                 F.col("dest_neighborhood_id").alias("n")),
    )).alias("r")
    per_role = (moves.select("year", "moved", roles)
                     .groupBy(F.col("r.role").alias("role"), F.col("r.d").alias("district_id"),
                              F.col("r.n").alias("neighborhood_id"), "year")
                     .agg(null_preserving_sum("moved").alias("total")))
    # Pivot without a second shuffle of raw rows: the input here is already
    # one row per (role, place, year). A place-year present under one role
    # only has no partner in the inner joins of the callers, so keep both
    # presence flags to drop it.
    return (per_role.groupBy(*PLACE_YEAR)
                    .agg(F.max(F.when(F.col("role") == "o", F.col("total"))).alias(origin_alias),
                         F.max(F.when(F.col("role") == "d", F.col("total"))).alias(dest_alias),
                         F.max(F.when(F.col("role") == "o", F.lit(1))).alias("_has_o"),
                         F.max(F.when(F.col("role") == "d", F.lit(1))).alias("_has_d")))


def latest_income(income: DataFrame) -> DataFrame:
    """Latest income record per neighbourhood (globally latest year, not
    as of the listing's date)."""
    return latest_per_key(income.select(*PLACE, "year", "pop", "RFD"), PLACE, "year")


def place_year_sums(moves: DataFrame) -> DataFrame:
    """Both sums per place and year, for places that have both."""
    both = both_sums(moves, "move_in", "move_out")
    return both.where(F.col("_has_o").isNotNull() & F.col("_has_d").isNotNull()).drop("_has_o", "_has_d")


def listing_counts(listings: DataFrame) -> DataFrame:
    """Listings per place and query year."""
    return (listings.groupBy(*PLACE, year_of("queryDate").alias("year"))
                    .agg(F.count(F.lit(1)).alias("advertisements")))


# The joins, over sides that are already aggregated: a full run takes them from
# the facts, an incremental run from its state.

def neighbourhood_rows(income: DataFrame, outs: DataFrame) -> DataFrame:
    """``outs`` holds moved_out per place and year."""
    outs = checked_broadcast(outs, name="origin sums")
    return conform(
        income.join(outs, PLACE_YEAR)
              .select("moved_out", "RFD", "year", "district_name",
                      F.col("neighborhood_name").alias("neighbourhood_name")),
        schemas.NEIGHBOURHOOD)


def real_estate_rows(ins: DataFrame, ads: DataFrame) -> DataFrame:
    """P5: ``ins`` holds moved_in and the names, ``ads`` advertisements."""
    ads = checked_broadcast(ads, name="advertisement counts")
    return conform(ins.join(ads, PLACE_YEAR)
                      .select("moved_in", "advertisements", "year", "district_name",
                              "neighbourhood_name"),
                   schemas.REAL_ESTATE)


def sale_price_rows(listings: DataFrame, latest: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``latest`` holds the latest income record per place; ``keep`` names
    further columns of the listings."""
    latest = checked_broadcast(latest.select(*PLACE, "RFD"), name="latest income")
    joined = (listings.join(latest, PLACE)
                      .select("price", "RFD", query_timestamp("queryDate").alias("queryDate"),
                              F.col("district").alias("district_name"),
                              F.col("neighborhood").alias("neighbourhood_name"), *keep))
    return _conform_and_keep(joined, schemas.SALE_PRICES, keep)


def sales_rows(listings: DataFrame, latest: DataFrame, sums: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``sums`` holds move_in and move_out per place and year."""
    latest, sums = checked_broadcasts({
        "latest income": latest.select(*PLACE, F.col("pop").alias("population"), "RFD"), "movement sums": sums})
    wide = (listings.withColumn("year", year_of("queryDate"))
                    .join(latest, PLACE)
                    .join(sums, PLACE_YEAR)
                    .withColumn("queryDate", query_date("queryDate"))
                    .drop("year"))
    return _conform_and_keep(wide, schemas.SALES, keep)


def _conform_and_keep(df: DataFrame, schema, keep: tuple[str, ...]) -> DataFrame:
    kept = [df.schema[c] for c in keep]
    return conform(df, T.StructType([*schema.fields, *kept]))


# The whole tables.

def neighbourhood(income: DataFrame, moves: DataFrame) -> DataFrame:
    """Income joined with the movements summed by *origin* (moved_out)."""
    return neighbourhood_rows(income, origin_sums(moves, "moved_out"))


def real_estate(moves: DataFrame, listings: DataFrame) -> DataFrame:
    """P5: movements summed by *destination* (moved_in), carrying the
    destination names, joined with the listing count per place and year."""
    return real_estate_rows(destination_sums(moves, "moved_in", with_names=True), listing_counts(listings))


def sale_prices(listings: DataFrame, income: DataFrame) -> DataFrame:
    """Every listing with the RFD of its neighbourhood's latest income
    year, and its query date as a timestamp."""
    return sale_price_rows(listings, latest_income(income))


def sales(listings: DataFrame, income: DataFrame, moves: DataFrame) -> DataFrame:
    """The wide training table.

    Kept as the source system defines it: ``move_in`` is the sum of movements
    whose *origin* is the listing's place and ``move_out`` the sum by
    *destination* (the reverse of the other two curated tables' naming).
    Population and RFD come from the latest income year; movements from the
    listing's own query year.
    """
    return sales_rows(listings, latest_income(income), place_year_sums(moves))
