"""Raw landing files, written by Spark from the driver's tables.

The source system's raw facts are not shipped, so the standardising plans
are exercised on files that have the raw formats and are derived from the
star schema (same roles as ``standins``):

* ``lookup_tables/*.json``     JSON lines lookups (district with an array of
                               neighbourhood ids, neighbourhood, code bridge)
* ``idealista/<yyyy>_01_01_idealista/``   nested Parquet listings, one dated
                               item per order year
* ``padro_opendata/<yyyy>_pad_cdo_b_barri-des.csv/``   headered CSV movements,
                               one item per ship year, ``..`` for a missing value
* ``income_opendata/income_opendata_neighborhood.json``   JSON lines, one
                               record per neighbourhood with an ``info`` array

Items are written one per year: a landing item is a unit of arrival, and the
year list is a handful of values. The raw rows are computed once and staged
partitioned by year; each item is a pruned read of the stage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files
from .standins import district_reconciled, neighbourhood_reconciled, table

LISTING_SUFFIX = "_idealista"
MOVES_SUFFIX = "_pad_cdo_b_barri-des.csv"
INCOME_ITEM = "income_opendata_neighborhood.json"


@dataclass
class Landing:
    root: str

    @property
    def lookups(self) -> str:
        return f"{self.root}/lookup_tables"

    @property
    def listings(self) -> str:
        return f"{self.root}/idealista"

    @property
    def moves(self) -> str:
        return f"{self.root}/padro_opendata"

    @property
    def income(self) -> str:
        return f"{self.root}/income_opendata"


def _places(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def write_lookups(spark: SparkSession, sf: str, land: Landing, known: str = "true") -> None:
    """The lookup files; ``known`` (SQL over nation and region) leaves places out."""
    p = _places(spark, sf).where(known)
    nid = F.col("n_nationkey").cast("string")
    rid = F.col("r_regionkey").cast("string")
    # Districts carry the array of their neighbourhood ids; the array is
    # bounded by the neighbourhoods of one district.
    districts = p.groupBy("r_regionkey", "r_name").agg(
        F.sort_array(F.collect_list(nid)).alias("_kids"))
    (districts.select(rid.alias("_id"), F.col("r_name").alias("di"),
                      F.lower("r_name").alias("di_n"),
                      district_reconciled(F.col("r_name")).alias("di_re"),
                      F.col("_kids").alias("ne_id"))
              .coalesce(1).write.mode("overwrite").json(f"{land.lookups}/rent_lookup_district.json"))
    (p.select(nid.alias("_id"), F.col("n_name").alias("ne"), F.lower("n_name").alias("ne_n"),
              neighbourhood_reconciled(F.col("n_name")).alias("ne_re"))
      .coalesce(1).write.mode("overwrite").json(f"{land.lookups}/rent_lookup_neighborhood.json"))
    (districts.select(rid.alias("_id"), F.col("r_name").alias("district"),
                      F.lower("r_name").alias("district_name"),
                      district_reconciled(F.col("r_name")).alias("district_reconciled"),
                      F.col("_kids").alias("neighborhood_id"))
              .coalesce(1).write.mode("overwrite")
              .json(f"{land.lookups}/income_lookup_district.json"))
    for name in ("income_lookup_neighborhood.json", "padro_lookup_neighborhood.json"):
        (p.select(nid.alias("_id"), F.col("n_name").alias("neighborhood"),
                  F.lower("n_name").alias("neighborhood_name"),
                  neighbourhood_reconciled(F.col("n_name")).alias("neighborhood_reconciled"))
          .coalesce(1).write.mode("overwrite").json(f"{land.lookups}/{name}"))
    (p.select(nid.alias("codi_barri"), F.col("r_name").alias("nom_districte"),
              F.col("n_name").alias("nom_barri"))
      .coalesce(1).write.mode("overwrite").json(f"{land.lookups}/BarcelonaCiutat_Barri.json"))


def raw_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Nested listing rows. ``status`` appears twice (a clash for the
    flattener): ``basic.status`` always, ``detail.extra.status`` only for
    open orders, so the later non-null leaf wins where present."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    p = _places(spark, sf).select("n_nationkey", "n_name", "r_name")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
                  .join(p, F.col("c_nationkey") == p.n_nationkey)
                  .select(
                      F.year("o_orderdate").alias("_year"),
                      F.struct(F.col("o_orderkey").cast("string").alias("propertyCode"),
                               F.col("o_totalprice").alias("price"),
                               F.col("o_orderstatus").alias("status")).alias("basic"),
                      F.struct(F.col("o_orderpriority").alias("typology"),
                               F.struct(F.when(F.col("o_orderstatus") == "O", F.lit("open"))
                                         .alias("status")).alias("extra")).alias("detail"),
                      F.struct(F.col("r_name").alias("district"),
                               F.col("n_name").alias("neighborhood")).alias("location")))


def raw_moves(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate",
                                             "l_quantity", "l_returnflag")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    order_nation = (table(spark, sf, "orders").select("o_orderkey", "o_custkey")
                    .join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"),
                          F.col("o_custkey") == F.col("c_custkey"))
                    .select("o_orderkey", "c_nationkey"))
    return (li.join(supplier, li.l_suppkey == supplier.s_suppkey)
              .join(order_nation, li.l_orderkey == order_nation.o_orderkey)
              .select(F.year("l_shipdate").alias("_year"),
                      F.col("s_nationkey").cast("string").alias("Codi_Barri"),
                      F.col("c_nationkey").cast("string").alias("CODI_BARRI_DEST"),
                      F.year("l_shipdate").cast("string").alias("Any"),
                      F.when(F.col("l_returnflag") == "R", F.lit(".."))
                       .otherwise(F.col("l_quantity").cast("long").cast("string")).alias("Valor")))


def raw_income(spark: SparkSession, sf: str) -> DataFrame:
    """One record per neighbourhood (raw names), ``info`` = its yearly
    records. The array is bounded by the number of years."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    p = _places(spark, sf).select("n_nationkey", "n_name", "r_name")
    yearly = (orders.join(customer, orders.o_custkey == customer.c_custkey)
                    .join(p, F.col("c_nationkey") == p.n_nationkey)
                    .groupBy("r_name", "n_name", F.year("o_orderdate").cast("long").alias("year"))
                    .agg(F.count(F.lit(1)).alias("pop"), F.max("o_totalprice").alias("RFD")))
    return (yearly.groupBy("r_name", "n_name")
                  .agg(F.sort_array(F.collect_list(F.struct("year", "pop", "RFD"))).alias("info"))
                  .select(F.col("n_name").alias("neigh_name "),
                          F.col("r_name").alias("district_name"), "info"))


def write_items(spark: SparkSession, df: DataFrame, key: str, root: str,
                name_of: Callable[[object], str],
                write: Callable[[DataFrame, str], None],
                keys: list | None = None) -> list[str]:
    """One landing item per distinct value of ``key`` (a handful of years).

    The source plan (a join over the fact tables) runs once: its rows are
    written partitioned by ``key`` to a staging folder under the shared
    root, and each item is then a partition-pruned read of that folder, so
    the per-item loop never recomputes or rescans the whole input.
    """
    if keys is not None:
        df = df.where(F.col(key).isin(list(keys)))
    stage = scratch_path(spark, "stage")
    df.write.partitionBy(key).parquet(stage)
    staged = spark.read.parquet(stage)
    # The key values are the partition folder names: a file listing, no scan.
    parts = files.list_items(spark, stage, rf"{key}=[^/]+").select(
        F.regexp_extract("item", rf"^{key}=(.*)$", 1).alias("v"))
    field = staged.schema[key].dataType
    found = sorted(r.v for r in parts.select(F.col("v").cast(field).alias("v")).collect())
    written = []
    for k in found:
        item = name_of(k)
        write(staged.where(F.col(key) == k).drop(key), f"{root}/{item}")
        written.append(item)
    return written


def write_listings(spark: SparkSession, sf: str, land: Landing,
                   years: list[int] | None = None) -> list[str]:
    return write_items(spark, raw_listings(spark, sf), "_year", land.listings,
                       lambda y: f"{y:04d}_01_01{LISTING_SUFFIX}",
                       lambda df, path: df.write.mode("overwrite").parquet(path), years)


def write_moves(spark: SparkSession, sf: str, land: Landing,
                years: list[int] | None = None) -> list[str]:
    return write_items(spark, raw_moves(spark, sf), "_year", land.moves,
                       lambda y: f"{y:04d}{MOVES_SUFFIX}",
                       lambda df, path: (df.write.mode("overwrite").option("header", "true")
                                           .csv(path)), years)


def write_income(spark: SparkSession, sf: str, land: Landing) -> None:
    raw_income(spark, sf).write.mode("overwrite").json(f"{land.income}/{INCOME_ITEM}")


def build(spark: SparkSession, sf: str, what: tuple[str, ...] = ("lookups", "listings",
                                                                 "moves", "income")) -> Landing:
    land = Landing(scratch_path(spark, "landing"))
    if "lookups" in what:
        write_lookups(spark, sf, land)
    if "listings" in what:
        write_listings(spark, sf, land)
    if "moves" in what:
        write_moves(spark, sf, land)
    if "income" in what:
        write_income(spark, sf, land)
    return land
