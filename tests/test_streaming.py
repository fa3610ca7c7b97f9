"""P1 through Structured Streaming: the checkpoint is the ledger."""

import pytest
from pyspark.sql import functions as F

from terrace import schemas
from terrace.plans import landing, standardise
from terrace.sources import ledger
from terrace.session import scratch_path

from .conftest import SF_SMALL


def test_stream_picks_up_only_new_items(spark):
    land = landing.build(spark, SF_SMALL, ("lookups",))
    formatted = scratch_path(spark, "fmt")
    landing.write_listings(spark, SF_SMALL, land, years=[1995, 1996])
    standardise.stream_listings(spark, land, formatted)
    first = standardise.read_formatted(spark, formatted, "idealista", schemas.LISTING)
    assert {r.y for r in first.select(F.substring("queryDate", 1, 4).alias("y"))
            .distinct().collect()} == {"1995", "1996"}
    n_first = first.count()

    landing.write_listings(spark, SF_SMALL, land, years=[1997])      # a new delivery
    standardise.stream_listings(spark, land, formatted)
    standardise.stream_listings(spark, land, formatted)              # nothing new
    out = spark.read.parquet(f"{formatted}/idealista/out")
    per_year = {r.y: r.n for r in out.groupBy(F.substring("queryDate", 1, 4).alias("y"))
                .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(per_year) == {"1995", "1996", "1997"}
    assert per_year["1995"] + per_year["1996"] == n_first
    # every listing once, and each micro-batch in its own partition
    assert out.select("propertyCode").distinct().count() == out.count()
    assert out.select("batch").distinct().count() == 2


def test_stream_and_batch_share_one_output(spark):
    land = landing.build(spark, SF_SMALL, ("lookups",))
    formatted = scratch_path(spark, "fmt")
    count = lambda: standardise.read_formatted(spark, formatted, "idealista", schemas.LISTING).count()
    landing.write_listings(spark, SF_SMALL, land, years=[1995])
    standardise.commit_listings(spark, land, formatted)
    n = count()
    standardise.stream_listings(spark, land, formatted)              # recorded by the batch run
    assert count() == n
    landing.write_listings(spark, SF_SMALL, land, years=[1996])
    standardise.stream_listings(spark, land, formatted)
    both = count()
    assert both > n
    assert standardise.commit_listings(spark, land, formatted) == []  # recorded by the stream
    ledger.reset(spark, f"{formatted}/idealista/_ledger", "idealista")
    standardise.stream_listings(spark, land, formatted)              # all again, over the old output
    standardise.stream_listings(spark, land, formatted)
    assert count() == both


def test_unexpected_listing_column_fails(spark):
    land = landing.build(spark, SF_SMALL, ("lookups",))
    raw = spark.createDataFrame([("x", "/l/2020_01_01_idealista/p", 1)], "district string, _file string, surprise int")
    with pytest.raises(ValueError, match="surprise"):
        standardise.standardise_listings(raw.selectExpr("*", "'n' AS neighborhood"),
                                         standardise.listing_lookup(spark, land.lookups))
