"""Formatted-zone stand-ins derived from the driver's star-schema tables.

The source system's raw facts are not available, so the formatted tables are
played by views over the TPC-H-like tables (roles below). They carry the
formatted zone's real column names and types, so the curated plans run on
them unchanged.

* district lookup        : region  (id = r_regionkey, reconciled = lower(r_name))
* neighbourhood lookup   : nation  (id = n_nationkey, reconciled = n_name with '_' -> ' ')
* listing                : an order, located at its customer's nation/region; its
                           flat's features are remainders of the order's keys
* movement               : a line item from the supplier's nation to the
                           customer's nation, in its ship year; no value when
                           the return flag is 'R'
* income record          : per nation and order year: pop = orders, RFD = max price
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import conform, year_of
from ..operators.joins import checked_broadcast


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def district_reconciled(r_name) -> "F.Column":
    return F.lower(r_name)


def neighbourhood_reconciled(n_name) -> "F.Column":
    return F.replace(n_name, F.lit("_"), F.lit(" "))


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region with reconciled names and string ids: the formatted
    view of the two lookups. Dimension-sized; broadcast after a size check."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey)
                 .select("n_nationkey",
                         F.col("r_regionkey").cast("string").alias("district_id"),
                         district_reconciled(F.col("r_name")).alias("district"),
                         F.col("n_nationkey").cast("string").alias("neighborhood_id"),
                         neighbourhood_reconciled(F.col("n_name")).alias("neighborhood")))
    return checked_broadcast(geo, name="geography")


def located_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nation key of their customer: the join that listings,
    movements and income share, on narrow columns."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus",
        "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
                  .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
                          F.date_format("o_orderdate", "yyyy_MM_dd").alias("queryDate"), "c_nationkey"))


def listings(spark: SparkSession, sf_dir: str, geo: DataFrame | None = None,
             located: DataFrame | None = None) -> DataFrame:
    """Formatted listings (declared 44-field record). ``geo`` lets several
    stand-ins of one query share one measured geography side, ``located`` one
    join of the facts (``located_orders``)."""
    located = located if located is not None else located_orders(spark, sf_dir)
    geo = geo if geo is not None else geography(spark, sf_dir)
    df = (located.join(geo, F.col("c_nationkey") == geo.n_nationkey)
                 .select(F.col("o_orderkey").cast("string").alias("propertyCode"),
                         F.col("o_totalprice").alias("price"),
                         "queryDate",
                         F.col("o_orderpriority").alias("typology"),
                         F.col("o_orderstatus").alias("status"),
                         (F.col("o_orderkey") % 3 + 1).alias("bathrooms"),
                         (F.col("o_orderkey") % 6 + 1).alias("rooms"),
                         (F.col("o_orderkey") % 120 + 40).cast("double").alias("size"),
                         (F.col("o_custkey") % 5000).cast("string").alias("distance"),
                         F.when(F.col("o_orderkey") % 5 == 0, F.lit("bj"))
                          .when(F.col("o_orderkey") % 7 == 0, F.lit("en"))
                          .otherwise((F.col("o_orderkey") % 9).cast("string")).alias("floor"),
                         (F.col("o_orderkey") % 2 == 0).alias("exterior"),
                         (F.col("o_custkey") % 3 != 0).alias("hasLift"),
                         "district", "district_id", "neighborhood", "neighborhood_id"))
    return conform(df, schemas.LISTING)


def move_ends(spark: SparkSession, sf_dir: str, located: DataFrame | None = None) -> DataFrame:
    """Movements with the nation keys of their two ends: the join of the facts,
    on numbers only. The order -> customer nation mapping is joined first as a
    narrow two-column table, and the year and the valued quantity are taken
    before the large line-item shuffle, which carries four numbers a row.
    ``located``: see ``listings``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", F.year("l_shipdate").alias("_year"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_quantity")).alias("_quantity"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    located = located if located is not None else located_orders(spark, sf_dir)
    order_nation = located.select("o_orderkey", "c_nationkey")
    return (li.join(supplier, li.l_suppkey == supplier.s_suppkey)
              .join(order_nation, li.l_orderkey == order_nation.o_orderkey)
              .select("s_nationkey", "c_nationkey", F.col("_year").cast("long").alias("year"),
                      F.col("_quantity").cast("long").alias("moved")))


def moves(spark: SparkSession, sf_dir: str, geo: DataFrame | None = None,
          ends: DataFrame | None = None) -> DataFrame:
    """Formatted movements. ``ends`` lets several readers share one join of the
    facts (``move_ends``)."""
    geo = geo if geo is not None else geography(spark, sf_dir)
    ends = ends if ends is not None else move_ends(spark, sf_dir)
    src = geo.select(F.col("n_nationkey").alias("_src"),
                     F.col("neighborhood").alias("neighborhood_name"), "neighborhood_id",
                     F.col("district").alias("district_name"), "district_id")
    dst = geo.select(F.col("n_nationkey").alias("_dst"),
                     F.col("neighborhood").alias("dest_neighborhood_name"),
                     F.col("neighborhood_id").alias("dest_neighborhood_id"),
                     F.col("district").alias("dest_district_name"),
                     F.col("district_id").alias("dest_district_id"))
    df = (ends.join(src, F.col("s_nationkey") == F.col("_src"))
              .join(dst, F.col("c_nationkey") == F.col("_dst"))
              .select("year", "moved", *schemas.MOVES.fieldNames()[2:]))
    return conform(df, schemas.MOVES)


def income(spark: SparkSession, sf_dir: str, listing_df: DataFrame | None = None) -> DataFrame:
    """Formatted income: one record per (district, neighbourhood, year).

    Hash-aggregated by key and names first (fixed-width buffers), then the
    few rows per key are merged; ``min`` of the names runs only there, so no
    listing row is ever sorted for it."""
    lst = listing_df if listing_df is not None else listings(spark, sf_dir)
    keys = ["district_id", "neighborhood_id", "year"]
    pre = (lst.groupBy("district_id", "neighborhood_id", year_of("queryDate").alias("year"),
                       "district", "neighborhood")
              .agg(F.count(F.lit(1)).alias("_n"), F.max("price").alias("_rfd")))
    df = (pre.groupBy(*keys)
             .agg(F.sum("_n").alias("pop"),
                  F.max("_rfd").alias("RFD"),
                  F.min("district").alias("district_name"),
                  F.min("neighborhood").alias("neighborhood_name")))
    return conform(df, schemas.INCOME)
