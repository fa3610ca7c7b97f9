"""Plan-shape and schema tests."""

import re

import pytest

from terrace import schemas
from terrace.operators.aggregates import keep_first, latest_per_key
from terrace.plans import catalogue, curate, standins

from .conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonRDD", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonUDF")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["gold_sales", "gold_neighbourhood", "gold_real_estate",
                                  "gold_sale_prices", "reconcile_listings",
                                  "reconcile_both_ends", "reconcile_income",
                                  "dedup_keep_first", "agg_null_preserving_sum"])
def test_no_python_in_plans(spark, name):
    text = plan_text(catalogue.QUERIES[name](spark, SF_SMALL))
    assert not any(node in text for node in PYTHON_NODES), name


def test_curated_sides_are_broadcast(spark):
    lst = standins.listings(spark, SF_SMALL)
    df = curate.sales(lst, standins.income(spark, SF_SMALL, lst), standins.moves(spark, SF_SMALL))
    text = plan_text(df)
    assert text.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in text.split("InMemoryRelation")[0]


def test_scans_are_pruned(spark):
    df = catalogue.scan_parquet_project(spark, SF_SMALL)
    text = plan_text(df)
    assert "o_orderdate" not in text and "o_orderstatus" not in text


@pytest.mark.parametrize("name,schema", [
    ("gold_sales", schemas.SALES), ("gold_neighbourhood", schemas.NEIGHBOURHOOD),
    ("gold_real_estate", schemas.REAL_ESTATE), ("gold_sale_prices", schemas.SALE_PRICES),
    ("reconcile_listings", schemas.LISTING), ("reconcile_both_ends", schemas.MOVES),
    ("reconcile_income", schemas.INCOME)])
def test_output_schemas_are_declared(spark, name, schema):
    got = catalogue.QUERIES[name](spark, SF_SMALL).schema
    assert [(f.name, f.dataType) for f in got.fields] == \
        [(f.name, f.dataType) for f in schema.fields]


def test_sales_keeps_source_naming_of_moves(spark):
    """move_in is the ORIGIN sum and move_out the DESTINATION sum."""
    from pyspark.sql import functions as F
    lst = standins.listings(spark, SF_SMALL)
    mv = standins.moves(spark, SF_SMALL)
    sales = curate.sales(lst, standins.income(spark, SF_SMALL, lst), mv)
    r = sales.select("district_id", "neighborhood_id", "queryDate", "move_in",
                     "move_out").first()
    y = r.queryDate.year
    origin = curate.origin_sums(mv, "m").where(
        (F.col("district_id") == r.district_id) & (F.col("neighborhood_id") == r.neighborhood_id)
        & (F.col("year") == y)).first().m
    dest = curate.destination_sums(mv, "m").where(
        (F.col("district_id") == r.district_id) & (F.col("neighborhood_id") == r.neighborhood_id)
        & (F.col("year") == y)).first().m
    assert (r.move_in, r.move_out) == (origin, dest)


def _deepest_aggregate(df) -> str:
    lines = [ln for ln in plan_text(df).splitlines() if "Aggregate" in ln]
    return lines[-1].split("Aggregate")[0].split()[-1] + "Aggregate"


def test_fact_rows_are_hash_aggregated_not_sorted(spark):
    """Carrying names (min of a string) must not put a sort under the fact
    rows: the aggregate next to the scan is a HashAggregate."""
    mv = standins.moves(spark, SF_SMALL)
    assert _deepest_aggregate(curate.destination_sums(mv, "m", with_names=True)) \
        .endswith("HashAggregate")
    assert _deepest_aggregate(standins.income(spark, SF_SMALL)).endswith("HashAggregate")


def test_row_choices_aggregate_before_the_shuffle(spark):
    """E4 and E5 carry whole rows, so they sort and aggregate; the sorted
    partial aggregate stands on both sides of the one shuffle, so that a hot
    key sends a row per map task."""
    line = standins.table(spark, SF_SMALL, "lineitem")
    for df in (latest_per_key(line, ["l_orderkey"], "l_shipdate"), keep_first(line, ["l_orderkey", "l_linenumber"])):
        text = plan_text(df)
        nodes = re.findall(r"\b(SortAggregate|Exchange|Window)\b", text)
        assert nodes == ["SortAggregate", "Exchange", "SortAggregate"], text


@pytest.mark.parametrize("name", ["gold_sales", "gold_real_estate"])
def test_shuffle_fallback_gives_the_same_rows(spark, name):
    """Over the broadcast bound a side is joined by shuffle instead; the
    answer must not change."""
    want = catalogue.QUERIES[name](spark, SF_SMALL)
    want_rows = want.collect()
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.terrace.broadcast", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.catalog.clearCache()
    try:
        got = catalogue.QUERIES[name](spark, SF_SMALL)
        assert "BroadcastHashJoin" not in plan_text(got)
        assert sorted(map(tuple, got.collect()), key=repr) == \
            sorted(map(tuple, want_rows), key=repr)
    finally:
        spark.conf.set("spark.terrace.broadcast", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
