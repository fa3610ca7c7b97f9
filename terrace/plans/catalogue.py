"""The query catalogue: one ``(spark, sf_dir) -> DataFrame`` per operator
group (SURVEY section 7.3). Every query reads the driver's tables, or files
Spark writes from them ("round trip": the operator under test reads them
back), so its work grows with the tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.columns import (conform, flatten_structs, item_prefix, landing_item,
                                 lenient_number, query_date, query_timestamp, sentinel_to_null,
                                 strict_long, year_of)
from ..operators.aggregates import keep_first, null_preserving_sum, sum_per_key
from ..operators.joins import at_once
from ..operators.quantiles import exact_median, exact_medians, mode_value, mode_values
from ..session import scratch_path
from ..sources import files, ledger
from ..sources.sinks import new_version, publish, write_first_or_append, write_refresh
from . import curate, incremental, landing, price_model, standardise, standins
from .extract import publish_tracked, published

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return standins.table(spark, sf, name)


# --- round-trip fixtures ------------------------------------------------------

ORDER_ITEM_SUFFIX = "_orders"
ORDER_ITEMS = r"[0-9]{4}_01_01" + ORDER_ITEM_SUFFIX


def write_orders_by_year(spark: SparkSession, sf: str, root: str) -> list[str]:
    """Orders as dated landing items ``<yyyy>_01_01_orders`` (one per order
    year), the shape of the dated listing deliveries."""
    orders = _t(spark, sf, "orders").withColumn("_y", F.year("o_orderdate"))
    return landing.write_items(spark, orders, "_y", root,
                               lambda y: f"{y:04d}_01_01{ORDER_ITEM_SUFFIX}",
                               lambda df, path: df.write.mode("overwrite").parquet(path))


# --- sources ------------------------------------------------------------------

def scan_parquet_project(spark: SparkSession, sf: str) -> DataFrame:
    """A1/A5 + B9: Parquet scan, projection with renames (pruned ReadSchema)."""
    return files.read_parquet(spark, [f"{sf}/orders.parquet"]).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))


def scan_csv_header(spark: SparkSession, sf: str) -> DataFrame:
    """A2 + S1: headered CSV, all text, strict number parse."""
    root = scratch_path(spark, "csv")
    _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal") \
        .write.option("header", "true").csv(root)
    raw = files.read_csv_text(spark, [root])
    return raw.select(strict_long("c_custkey").alias("c_custkey"), "c_name",
                      strict_long("c_nationkey").alias("c_nationkey"),
                      F.col("c_acctbal").cast("double").alias("c_acctbal"))


NESTED_ORDER = T.StructType([
    T.StructField("order_key", T.LongType()),
    T.StructField("attributes", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())]))),
])


def scan_json_nested(spark: SparkSession, sf: str) -> DataFrame:
    """A3/A4 + S10: JSON lines with an array of structs, declared schema,
    explode and struct field access. Each order is one record whose array
    is built from its own columns (bounded, no grouping)."""
    root = scratch_path(spark, "json")
    attr = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"))
    (_t(spark, sf, "orders")
        .select(F.col("o_orderkey").alias("order_key"),
                F.array(attr("status", "o_orderstatus"),
                        attr("priority", "o_orderpriority")).alias("attributes"))
        .write.json(root))
    df = files.read_json(spark, root, NESTED_ORDER)
    return (df.select("order_key", F.explode("attributes").alias("a"))
              .select("order_key", F.col("a.kind").alias("kind"), F.col("a.value").alias("value")))


def scan_file_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """A6 + A7 + S4: items chosen by name pattern; each row carries the date
    of the item it came from (per-file constant from the file path)."""
    root = scratch_path(spark, "dated")
    write_orders_by_year(spark, sf, root)
    paths = [r.path for r in files.list_items(spark, root, ORDER_ITEMS).collect()]
    df = files.read_parquet(spark, paths)
    dated = df.select(item_prefix(landing_item(ORDER_ITEM_SUFFIX), 10).alias("queryDate"))
    return dated.groupBy("queryDate").agg(F.count(F.lit(1)).alias("orders"))


# --- projections / schema -------------------------------------------------------

def flatten_structs_q(spark: SparkSession, sf: str) -> DataFrame:
    """B1: nested rows flattened; ``flag`` clashes (the later non-null leaf
    wins)."""
    root = scratch_path(spark, "nested")
    li = _t(spark, sf, "lineitem")
    li.select(
        F.struct("l_orderkey", "l_linenumber",
                 F.struct("l_quantity", F.col("l_returnflag").alias("flag")).alias("qty"))
         .alias("key"),
        F.struct("l_extendedprice",
                 F.when(F.col("l_linestatus") == "F", F.lit("final")).alias("flag"))
         .alias("amount"),
    ).write.parquet(root)
    return flatten_structs(files.read_parquet(spark, [root]))


ORDERS_DECLARED = schemas.struct([
    ("o_orderkey", "long"), ("o_custkey", "long"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
])


def align_schema(spark: SparkSession, sf: str) -> DataFrame:
    """B2 + B6 + G1: two deliveries with different schemas (one lacks a
    column and has a narrower key type) aligned by name to one declared
    schema, then unioned."""
    root = scratch_path(spark, "align")
    orders = _t(spark, sf, "orders")
    done = F.col("o_orderstatus") == "F"
    orders.where(done).write.parquet(f"{root}/a")
    (orders.where(~done | F.col("o_orderstatus").isNull())
           .select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"),
                   "o_orderstatus", "o_totalprice", "o_orderdate")
           .write.parquet(f"{root}/b"))
    parts = [conform(files.read_parquet(spark, [f"{root}/{p}"]), ORDERS_DECLARED, extra="error")
             for p in ("a", "b")]
    return parts[0].unionByName(parts[1])


RAW_CUSTOMER = schemas.struct([("c_custkey", "long"), ("c_name ", "string"),
                               ("c_nationkey", "long"), ("c_acctbal", "double"),
                               ("c_mktsegment", "string")])


def rename_override_drop(spark: SparkSession, sf: str) -> DataFrame:
    """B3 (a field named with a trailing space), B4 add/override, B5 drop."""
    root = scratch_path(spark, "cust")
    (_t(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("c_name "),
                                      "c_nationkey", "c_acctbal", "c_mktsegment")
                              .write.json(root))
    raw = files.read_json(spark, root, RAW_CUSTOMER)
    return (raw.withColumnRenamed("c_name ", "customer_name")
               .withColumns({"customer_name": F.upper("customer_name"),
                             "in_debt": F.col("c_acctbal") < 0})
               .drop("c_mktsegment"))


def union_all_files(spark: SparkSession, sf: str) -> DataFrame:
    """G1: every item in one multi-path scan (bag union)."""
    root = scratch_path(spark, "union")
    write_orders_by_year(spark, sf, root)
    paths = [r.path for r in files.list_items(spark, root, ORDER_ITEMS).collect()]
    return files.read_parquet(spark, paths).select("o_orderkey", "o_custkey", "o_totalprice")


# --- incremental state ----------------------------------------------------------

def ledger_skip_processed(spark: SparkSession, sf: str) -> DataFrame:
    """A11 + A12 + C1: the two earliest items are already in the ledger; a
    run loads only the others, and a second run loads nothing."""
    root = scratch_path(spark, "ledger")
    items = write_orders_by_year(spark, sf, f"{root}/landing")
    led, out = f"{root}/_ledger", f"{root}/out"
    ledger.append(spark, led, "orders", items[:2])
    load = lambda paths: files.read_parquet(spark, paths).select(
        "o_orderkey", F.year("o_orderdate").cast("long").alias("year"))
    standardise.commit_items(spark, f"{root}/landing", ORDER_ITEMS, out, led, "orders", load)
    again = standardise.commit_items(spark, f"{root}/landing", ORDER_ITEMS, out, led, "orders",
                                     load)
    if again:
        raise AssertionError(f"second run re-processed {again}")
    return spark.read.parquet(out).select("o_orderkey", "year")


def overwrite_or_append(spark: SparkSession, sf: str) -> DataFrame:
    """A9 + A14: run 1 (first: overwrite), run 2 (new item: append), reset,
    run 3 (ledger empty again: overwrite with everything)."""
    root = scratch_path(spark, "ovw")
    land, led, out = f"{root}/landing", f"{root}/_ledger", f"{root}/out"
    orders = _t(spark, sf, "orders")
    done = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    load = lambda paths: files.read_parquet(spark, paths)
    pattern = r"part_[ab]_orders"
    orders.where(done).write.parquet(f"{land}/part_a_orders")
    counts = []
    standardise.commit_items(spark, land, pattern, out, led, "orders", load)
    counts.append(("run1", spark.read.parquet(out).count()))
    orders.where(~done).write.parquet(f"{land}/part_b_orders")
    standardise.commit_items(spark, land, pattern, out, led, "orders", load)
    counts.append(("run2", spark.read.parquet(out).count()))
    ledger.reset(spark, led, "orders")
    standardise.commit_items(spark, land, pattern, out, led, "orders", load)
    counts.append(("reset_run", spark.read.parquet(out).count()))
    return spark.createDataFrame(counts, "state string, rows long")


def newer_than_gate(spark: SparkSession, sf: str) -> DataFrame:
    """A15 (strictly newer than every recorded version) and A16 (version
    vector equal to the last run's) over a folder Spark writes and rewrites."""
    root = scratch_path(spark, "gate")
    src, led15, led16 = f"{root}/src", f"{root}/_l15", f"{root}/_l16"
    orders = _t(spark, sf, "orders")
    orders.write.parquet(src)
    mt = files.max_mtime(spark, src)
    run_first = ledger.newer_than_all(spark, mt, led15).first()["run"]
    version = mt.select(F.unix_micros("mtime").cast("string").alias("v")).first()["v"]
    ledger.append(spark, led15, "orders", [version], kind=ledger.VERSION)
    run_after = ledger.newer_than_all(spark, files.max_mtime(spark, src), led15).first()["run"]
    vec = lambda: files.max_mtime(spark, src).select(
        F.lit("orders").alias("source"), F.unix_micros("mtime").cast("string").alias("version"))
    fresh_first = ledger.version_vector_fresh(spark, vec(), led16).first()["fresh"]
    ledger.record_versions(spark, vec(), led16, "orders")
    fresh_after = ledger.version_vector_fresh(spark, vec(), led16).first()["fresh"]
    rows = spark.read.parquet(src).count()
    orders.write.mode("overwrite").parquet(src)
    fresh_rewritten = ledger.version_vector_fresh(spark, vec(), led16).first()["fresh"]
    run_rewritten = ledger.newer_than_all(spark, files.max_mtime(spark, src), led15).first()["run"]
    return spark.createDataFrame(
        [(run_first, run_after, run_rewritten, fresh_first, fresh_after, fresh_rewritten, rows)],
        "run_first boolean, run_after_record boolean, run_after_rewrite boolean, "
        "fresh_first boolean, fresh_after_record boolean, fresh_after_rewrite boolean, "
        "rows long")


def publish_replace(spark: SparkSession, sf: str) -> DataFrame:
    """A10 + A17: a table published twice holds the second content once;
    the first version's folder is left as it was."""
    root = scratch_path(spark, "pub")
    orders = _t(spark, sf, "orders")
    done = orders.where(F.col("o_orderstatus") == "F")
    name = f"orders_{root.rsplit('-', 1)[-1]}"
    first, second = new_version(root), new_version(root)
    write_refresh(done, first)
    publish(spark, first, "descriptive", name, f"{root}/descriptive.db")
    write_refresh(orders, second)
    table = publish(spark, second, "descriptive", name, f"{root}/descriptive.db")
    if spark.read.parquet(first).count() != done.count():
        raise AssertionError("publishing changed an earlier version")
    return spark.table(table)


def publish_status_retry(spark: SparkSession, sf: str) -> DataFrame:
    """Status per publish; the latest status per table by time; a
    failed publish is retried from the output it remembered."""
    root = scratch_path(spark, "status")
    log, db, loc = f"{root}/_status", "descriptive", f"{root}/descriptive.db"
    tag = root.rsplit("-", 1)[-1]
    names = {t: f"{t}_{tag}" for t in ("orders", "supplier", "customer")}
    write_refresh(_t(spark, sf, "orders"), f"{root}/orders")
    publish_tracked(spark, names["orders"], f"{root}/orders", db, log, loc)
    publish_tracked(spark, names["supplier"], f"{root}/missing_supplier", db, log, loc)
    publish_tracked(spark, names["customer"], f"{root}/customer", db, log, loc)
    write_refresh(_t(spark, sf, "customer"), f"{root}/customer")   # output appears later
    for r in ledger.retry_candidates(spark, log).collect():
        publish_tracked(spark, r.pipe, r.output, r.database, log, loc)
    status = spark.read.schema(schemas.PUBLISH_STATUS).parquet(log)
    last = (status.groupBy("pipe")
                  .agg(F.count(F.lit(1)).alias("attempts"),
                       F.max_by("status", "ts").alias("status")))
    sizes = None
    for t, name in names.items():
        if spark.catalog.tableExists(f"{db}.{name}"):
            part = spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("rows")) \
                        .select(F.lit(name).alias("pipe"), "rows")
            sizes = part if sizes is None else sizes.unionByName(part)
    out = last.join(sizes, "pipe", "left") if sizes is not None else last
    inverse = {v: k for k, v in names.items()}
    mapping = F.create_map(*[x for k, v in inverse.items() for x in (F.lit(k), F.lit(v))])
    return out.select(mapping[F.col("pipe")].alias("table"), "attempts", "status",
                      F.col("rows").cast("long").alias("rows"))


# --- lookups and reconciliation -------------------------------------------------

def _landing(spark: SparkSession, sf: str, *what: str) -> landing.Landing:
    return landing.build(spark, sf, what)


def lookup_explode_join(spark: SparkSession, sf: str) -> DataFrame:
    """S8 + D1/D3: district array exploded and joined to neighbourhoods."""
    land = _landing(spark, sf, "lookups")
    return standardise.listing_lookup(spark, land.lookups).select(
        F.col("_di_id").alias("district_id"), F.col("_di").alias("district_raw"),
        F.col("_di_re").alias("district"), F.col("_ne_id").alias("neighborhood_id"),
        F.col("_ne").alias("neighborhood_raw"), F.col("_ne_re").alias("neighborhood"))


def lookup_code_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """(district, neighbourhood) names bridged to the integer code."""
    land = _landing(spark, sf, "lookups")
    return standardise.moves_lookup(spark, land.lookups)


def reconcile_listings(spark: SparkSession, sf: str) -> DataFrame:
    """P1 end to end: dated nested items -> formatted listings."""
    land = _landing(spark, sf, "lookups", "listings")
    formatted = scratch_path(spark, "formatted")
    standardise.commit_listings(spark, land, formatted)
    return standardise.read_formatted(spark, formatted, "idealista", schemas.LISTING)


def stream_listings(spark: SparkSession, sf: str) -> DataFrame:
    """P1 through Structured Streaming (file source, availableNow trigger,
    checkpoint as the ledger); a second run finds nothing new."""
    land = _landing(spark, sf, "lookups", "listings")
    formatted = scratch_path(spark, "formatted")
    standardise.stream_listings(spark, land, formatted)
    standardise.stream_listings(spark, land, formatted)
    return standardise.read_formatted(spark, formatted, "idealista", schemas.LISTING)


def batch_then_stream(spark: SparkSession, sf: str) -> DataFrame:
    """P1 by both routes into one output: a batch run over the first years, a
    stream over all items, and a batch run that finds nothing new."""
    land = _landing(spark, sf, "lookups")
    formatted = scratch_path(spark, "formatted")
    landing.write_listings(spark, sf, land, years=list(range(1990, 1998)))
    standardise.commit_listings(spark, land, formatted)
    landing.write_listings(spark, sf, land)
    standardise.stream_listings(spark, land, formatted)
    standardise.commit_listings(spark, land, formatted)
    return standardise.read_formatted(spark, formatted, "idealista", schemas.LISTING)


def reconcile_both_ends(spark: SparkSession, sf: str) -> DataFrame:
    """P2 end to end: CSV movements, origin and destination reconciled."""
    land = _landing(spark, sf, "lookups", "moves")
    formatted = scratch_path(spark, "formatted")
    standardise.commit_moves(spark, land, formatted)
    return standardise.read_formatted(spark, formatted, "padro_opendata", schemas.MOVES)


def reconcile_income(spark: SparkSession, sf: str) -> DataFrame:
    """P3 end to end: nested income records reconciled."""
    land = _landing(spark, sf, "lookups", "income")
    formatted = scratch_path(spark, "formatted")
    standardise.commit_income(spark, land, formatted)
    return standardise.read_formatted(spark, formatted, "income_opendata", schemas.INCOME)


def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    """M2: rows that reach each reconciliation and those whose place is not in
    the lookups (here: every fifth one), counted by the three writes themselves
    and read from their ledgers."""
    land = _landing(spark, sf, "listings", "moves", "income")
    landing.write_lookups(spark, sf, land, "n_nationkey % 5 <> 0")
    formatted = scratch_path(spark, "formatted")
    parts = []
    for pipe, commit in (("idealista", standardise.commit_listings), ("padro_opendata", standardise.commit_moves),
                         ("income_opendata", standardise.commit_income)):
        commit(spark, land, formatted)
        parts.append(ledger.quality(spark, f"{formatted}/{pipe}/_ledger").select("pipe", "step", "rows", "unknown"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sentinel_to_null_q(spark: SparkSession, sf: str) -> DataFrame:
    """C4 + S1 + S2 over the CSV movement items."""
    land = _landing(spark, sf, "moves")
    paths = [r.path for r in files.list_items(spark, land.moves, standardise.MOVES_ITEMS)
             .collect()]
    raw = files.read_csv_text(spark, paths)
    return raw.select(strict_long("Codi_Barri").alias("origin"),
                      strict_long("CODI_BARRI_DEST").alias("destination"),
                      strict_long("Any").alias("year"), sentinel_to_null("Valor").alias("moved"))


def explode_info(spark: SparkSession, sf: str) -> DataFrame:
    """S9 + B5 on the raw income records."""
    land = _landing(spark, sf, "income")
    raw = files.read_json(spark, f"{land.income}/{landing.INCOME_ITEM}", schemas.RAW_INCOME)
    return standardise.spread_info(
        raw.select(F.col("`neigh_name `").alias("neighborhood_name"), "district_name", "info"))


# --- aggregations ----------------------------------------------------------------

def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """E5: one line item per (order, line number), the smallest by all other
    columns."""
    return keep_first(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def agg_null_preserving_sum(spark: SparkSession, sf: str) -> DataFrame:
    """E1 + S7 keyed by (origin, destination, year)."""
    mv = standins.moves(spark, sf)
    return (mv.groupBy("neighborhood_id", "dest_neighborhood_id", "year")
              .agg(null_preserving_sum("moved").alias("moved")))


def agg_sum_with_names(spark: SparkSession, sf: str) -> DataFrame:
    """Destination sums carrying the destination names."""
    return curate.destination_sums(standins.moves(spark, sf), "moved_in", with_names=True)


def agg_count_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """E3 + S3: listings per place and query year."""
    lst = standins.listings(spark, sf)
    return (lst.groupBy("district_id", "neighborhood_id", year_of("queryDate").alias("year"))
               .agg(F.count(F.lit(1)).alias("advertisements")))


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """Latest income record per neighbourhood."""
    return curate.latest_income(standins.income(spark, sf))


def date_string_parse(spark: SparkSession, sf: str) -> DataFrame:
    """S3 + S5 + S6 on ``yyyy_MM_dd`` strings."""
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy_MM_dd").alias("queryDate"))
    return o.select("o_orderkey", "queryDate", year_of("queryDate").alias("year"),
                    query_timestamp("queryDate").alias("query_ts"),
                    query_date("queryDate").alias("query_day"))


# --- curated tables (P4-P7) --------------------------------------------------------

def gold_neighbourhood(spark: SparkSession, sf: str) -> DataFrame:
    geo = standins.geography(spark, sf)
    lst = standins.listings(spark, sf, geo)
    return curate.neighbourhood(standins.income(spark, sf, lst), standins.moves(spark, sf, geo))


def gold_real_estate(spark: SparkSession, sf: str) -> DataFrame:
    geo = standins.geography(spark, sf)
    return curate.real_estate(standins.moves(spark, sf, geo), standins.listings(spark, sf, geo))


def gold_sale_prices(spark: SparkSession, sf: str) -> DataFrame:
    lst = standins.listings(spark, sf)
    return curate.sale_prices(lst, standins.income(spark, sf, lst))


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    geo = standins.geography(spark, sf)
    lst = standins.listings(spark, sf, geo)
    return curate.sales(lst, standins.income(spark, sf, lst), standins.moves(spark, sf, geo))


def gold_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _sales(spark, sf)


def staged(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """``rows`` written once, for several readers."""
    write_refresh(rows, path)
    return spark.read.parquet(path)


def write_formatted_batches(spark: SparkSession, sf: str, formatted: str, number: int, of: int,
                            ends: DataFrame | None = None, located: DataFrame | None = None) -> None:
    """Stand-in listings and movements whose order key (movements: sum of both
    nation keys and the year) modulo ``of`` is ``number``, as one committed
    batch each. ``ends`` and ``located`` let several batches share one join of
    the facts; the batch's rows are taken from them before any name is joined."""
    geo = standins.geography(spark, sf)
    located = located if located is not None else standins.located_orders(spark, sf)
    ends = ends if ends is not None else standins.move_ends(spark, sf, located)
    listed = located.where(F.col("o_orderkey").cast("long") % of == number)
    moved = ends.where((F.col("s_nationkey").cast("long") + F.col("c_nationkey").cast("long") + F.col("year")) % of == number)
    batch = f"b{number}"

    def commit(source: str, rows: DataFrame, by: dict) -> None:
        write_first_or_append(rows, f"{formatted}/{source}/out", number == 0, batch, by)
        ledger.append(spark, f"{formatted}/{source}/_ledger", source, [f"item_{number}"], run_id=batch)

    at_once(lambda: commit("idealista", standins.listings(spark, sf, geo, listed), standardise.listing_parts()),
            lambda: commit("padro_opendata", standins.moves(spark, sf, geo, moved), standardise.moves_parts()))


def write_formatted_income(spark: SparkSession, income: DataFrame, formatted: str) -> None:
    folder = new_version(f"{formatted}/income_opendata/out")
    write_refresh(income, folder)
    ledger.append(spark, f"{formatted}/income_opendata/_ledger", "income_opendata", [folder], kind=ledger.OUTPUT)


def _incremental(table: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        root = scratch_path(spark, "incremental")
        formatted, exploitation = f"{root}/formatted", f"{root}/exploitation"
        # The joins of the facts and the income run once, not once a delivery.
        located = staged(spark, standins.located_orders(spark, sf), f"{root}/staged/located_orders")
        ends = staged(spark, standins.move_ends(spark, sf, located), f"{root}/staged/move_ends")
        income = staged(spark, standins.income(spark, sf, standins.listings(spark, sf, located=located)),
                        f"{root}/staged/income")
        # Older income first, so that the last delivery changes latest records.
        write_formatted_income(spark, income.where(F.col("year") < 1996), formatted)
        for number in range(3):
            write_formatted_batches(spark, sf, formatted, number, 3, ends, located)
            if number == 2:
                write_formatted_income(spark, income, formatted)
            incremental.refresh(spark, formatted, exploitation)
        return incremental.table(spark, exploitation, table)

    query.__doc__ = f"M1: ``{table}`` after three deliveries, each brought in by an incremental refresh."
    return query


incremental_neighbourhood = _incremental("neighbourhood")
incremental_real_estate = _incremental("real_estate")
incremental_sale_prices = _incremental("sale_prices")
incremental_sales = _incremental("sales")


def published_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table is published, its catalog entry is lost (as in a
    process with another catalog), and the table is read as published."""
    root = scratch_path(spark, "published")
    out, location = new_version(f"{root}/sales"), f"{root}/predictive.db"
    table = f"sales_{root.rsplit('-', 1)[-1]}"
    write_refresh(_sales(spark, sf), out)
    publish_tracked(spark, table, out, "predictive", f"{root}/_publish_status", location)
    spark.sql(f"DROP TABLE `predictive`.`{table}`")
    return published(spark, "predictive", table, root, location)


# --- model steps (P8) ----------------------------------------------------------------

def feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Listing-like frame over ``part``: floor codes ('bj', 'en', numbers)
    and some missing prices."""
    p = _t(spark, sf, "part")
    floor = (F.when(F.col("p_size") % 5 == 0, F.lit("bj"))
              .when(F.col("p_size") % 7 == 0, F.lit("en"))
              .otherwise(F.col("p_size").cast("string")))
    price = F.when(F.col("p_partkey") % 10 == 0, F.lit(None).cast("double")) \
             .otherwise(F.col("p_retailprice"))
    return p.select("p_partkey", floor.alias("floor"), F.col("p_size").alias("size"),
                    F.col("p_brand").alias("brand"), price.alias("price"))


def clean_features(spark: SparkSession, sf: str) -> DataFrame:
    """S11 + S12 + C2 + C3 + B11."""
    df = feature_frame(spark, sf)
    cleaned = price_model.clean(df, features=["p_partkey", "floor", "size", "brand"],
                                target="price", numeric_text=("floor",), strict_text=())
    return cleaned


def split_by_hash(spark: SparkSession, sf: str) -> DataFrame:
    """L1: repeatable 80/20 split by md5 bucket of the key."""
    o = _t(spark, sf, "orders")
    b = price_model.hash_bucket("o_orderkey")
    return o.select("o_orderkey", b.alias("bucket"),
                    F.when(b == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"))


def _orders_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("priority"))


def impute_median_mode(spark: SparkSession, sf: str) -> DataFrame:
    """L2 (exact median) + L4 (most frequent, ties to the smallest)."""
    df = _orders_with_gaps(spark, sf)
    med = exact_median(df, "price")
    mode = mode_value(df, "priority")
    return df.select("o_orderkey", F.expr(price_model.imputed("price", med)).alias("price"),
                     F.expr(price_model.imputed("priority", mode)).alias("priority"))


def joint_median_mode(spark: SparkSession, sf: str) -> DataFrame:
    """M4 + M5: exact medians of several columns by one search, most frequent
    values of several columns by one aggregate."""
    o = _t(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_totalprice")).alias("price"),
        (F.col("o_custkey") % 3).cast("double").alias("few"), F.col("o_orderkey").cast("double").alias("key"),
        F.lit(None).cast("double").alias("empty"),
        F.when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"), F.lit(None).cast("string").alias("nothing"))
    medians = exact_medians(o, ["price", "few", "key", "empty"])
    modes = mode_values(o, ["priority", "status", "nothing"])
    # One row over the orders, so that the statistics stand beside their count.
    return o.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.lit(v).cast("double").alias(f"median_{c}") for c, v in medians.items()],
                 *[F.lit(v).cast("string").alias(f"mode_{c}") for c, v in modes.items()])


def standardise_columns(spark: SparkSession, sf: str) -> DataFrame:
    """L3: zero mean, unit (population) variance, rounded."""
    o = _t(spark, sf, "orders")
    mean, sd = price_model.population_stats(o, {"p": "o_totalprice"})["p"]
    return o.select("o_orderkey", F.round(F.expr(price_model.z_score("o_totalprice", mean, sd)), 6)
                                   .alias("price_z"))


def _label_name(prefix: str, label: str) -> str:
    return prefix + re.sub(r"[^0-9A-Za-z]+", "_", label).strip("_")


def one_hot_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Index + one-hot with unknown -> all zeros, one 0/1 column per
    known category."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    idx = StringIndexer(inputCol="o_orderpriority", outputCol="_idx", handleInvalid="keep",
                        stringOrderType="alphabetAsc").fit(o)
    enc = OneHotEncoder(inputCol="_idx", outputCol="_vec", dropLast=True,
                        handleInvalid="keep").fit(idx.transform(o))
    arr = enc.transform(idx.transform(o)).select("o_orderkey",
                                                 vector_to_array("_vec").alias("_a"))
    return arr.select("o_orderkey", *[F.col("_a")[i].alias(_label_name("priority_", lab))
                                      for i, lab in enumerate(idx.labels)])


def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """L9 + E6 on a fixed-formula prediction of the order price."""
    o = _t(spark, sf, "orders").select(
        F.col("o_totalprice").alias("label"),
        (F.col("o_totalprice") * 0.95 + 500.0).alias("prediction"))
    return price_model.regression_metrics(o, "label", "prediction")


def train_price_model(spark: SparkSession, sf: str) -> DataFrame:
    """L1-L8 + A19 + G2: the forest on the wide table, with all 14 features, all
    rows, 100 trees and the default depth, stored, loaded again and compared
    with its stored metrics."""
    root = scratch_path(spark, "model")
    write_refresh(_sales(spark, sf), f"{root}/sales")
    sales = spark.read.parquet(f"{root}/sales")
    store = price_model.train(spark, sales, "propertyCode", numeric=price_model.NUMERIC,
                              categorical=price_model.CATEGORICAL, model_root=root)
    rows = price_model.model_rows(sales, "propertyCode", price_model.NUMERIC, price_model.CATEGORICAL)
    train_rows, test_rows = price_model.split(rows.na.drop(subset=price_model.FEATURES), "propertyCode")
    scored = PipelineModel.load(store.first()["model_path"]).transform(test_rows)
    again = price_model.regression_metrics(scored, "price", "prediction").first()
    same = lambda name: F.abs(F.max(name) - F.lit(again[name])) < 0.01
    return store.agg(F.max("entries").alias("entries"), F.lit(train_rows.count()).cast("long").alias("train_rows"),
                     F.lit(test_rows.count()).cast("long").alias("test_rows"),
                     F.lit(again["entries"]).cast("long").alias("predictions"),
                     F.count(F.lit(1)).alias("store_rows"),
                     (F.max("rmse") >= F.max("mae")).alias("rmse_ge_mae"),
                     (same("mae") & same("rmse")).alias("reloaded_same"))


QUERIES: dict[str, Query] = {
    "scan_parquet_project": scan_parquet_project,
    "scan_csv_header": scan_csv_header,
    "scan_json_nested": scan_json_nested,
    "scan_file_provenance": scan_file_provenance,
    "flatten_structs": flatten_structs_q,
    "align_schema": align_schema,
    "rename_override_drop": rename_override_drop,
    "union_all_files": union_all_files,
    "ledger_skip_processed": ledger_skip_processed,
    "overwrite_or_append": overwrite_or_append,
    "newer_than_gate": newer_than_gate,
    "publish_replace": publish_replace,
    "publish_status_retry": publish_status_retry,
    "lookup_explode_join": lookup_explode_join,
    "lookup_code_bridge": lookup_code_bridge,
    "reconcile_listings": reconcile_listings,
    "stream_listings": stream_listings,
    "batch_then_stream": batch_then_stream,
    "reconcile_both_ends": reconcile_both_ends,
    "reconcile_income": reconcile_income,
    "reject_counts": reject_counts,
    "sentinel_to_null": sentinel_to_null_q,
    "explode_info": explode_info,
    "dedup_keep_first": dedup_keep_first,
    "agg_null_preserving_sum": agg_null_preserving_sum,
    "agg_sum_with_names": agg_sum_with_names,
    "agg_count_per_key": agg_count_per_key,
    "latest_per_key": latest_per_key,
    "date_string_parse": date_string_parse,
    "gold_neighbourhood": gold_neighbourhood,
    "gold_real_estate": gold_real_estate,
    "gold_sale_prices": gold_sale_prices,
    "gold_sales": gold_sales,
    "published_scan": published_scan,
    "incremental_neighbourhood": incremental_neighbourhood,
    "incremental_real_estate": incremental_real_estate,
    "incremental_sale_prices": incremental_sale_prices,
    "incremental_sales": incremental_sales,
    "clean_features": clean_features,
    "split_by_hash": split_by_hash,
    "impute_median_mode": impute_median_mode,
    "joint_median_mode": joint_median_mode,
    "standardise_columns": standardise_columns,
    "one_hot_categories": one_hot_categories,
    "regression_metrics": regression_metrics,
    "train_price_model": train_price_model,
}
