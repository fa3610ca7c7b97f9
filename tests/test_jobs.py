"""The zone jobs end to end: landing files -> formatted -> curated and
published -> model trained from the published table (P1-P8, A8)."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from terrace import jobs
from terrace.plans import catalogue, landing
from terrace.session import scratch_path

from .conftest import SF_SMALL


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_zone_jobs_end_to_end(spark):
    land = landing.build(spark, SF_SMALL)
    formatted = scratch_path(spark, "fmt")
    exploitation = scratch_path(spark, "exp")
    loc = f"{exploitation}/warehouse"

    committed = jobs.commit_zone(spark, land.root, formatted)
    assert set(committed) == set(jobs.COMMITTERS)
    assert all(committed.values())
    assert jobs.commit_zone(spark, land.root, formatted) == {p: [] for p in jobs.COMMITTERS}

    assert jobs.extract_zone(spark, formatted, exploitation, location=loc) == \
        {t: "SUCCESS" for t in ("neighbourhood", "real_estate", "sale_prices", "sales")}
    assert jobs.extract_zone(spark, formatted, exploitation, ["sales"], location=loc) == \
        {"sales": "fresh"}

    # the tables keyed by year agree with the stand-in route over the same data
    assert _same_rows(spark.table("descriptive.neighbourhood"),
                      catalogue.gold_neighbourhood(spark, SF_SMALL))
    assert _same_rows(spark.table("descriptive.real_estate"),
                      catalogue.gold_real_estate(spark, SF_SMALL))

    # a catalog that lost the table gets it again from the status log
    before = spark.table("predictive.sales").count()
    spark.sql("DROP TABLE predictive.sales")
    assert jobs.published_sales(spark, exploitation=exploitation, location=loc).count() == before
    with pytest.raises(LookupError):
        jobs.published_sales(spark, table="unknown", exploitation=exploitation)

    model_root = scratch_path(spark, "model")
    train = lambda: jobs.train_published(
        spark, model_root, numeric=["population", "RFD", "move_in", "move_out"],
        categorical=["district", "neighborhood", "typology"], num_trees=3, max_depth=3)
    row = train().first()
    assert row.entries == spark.table("predictive.sales").where(F.col("price").isNotNull()).count()
    assert row.mae > 0 and row.rmse >= row.mae
    runs = train().collect()                  # a second run adds a row and a model
    assert len(runs) == 2 and runs[0].model_path != runs[1].model_path
    first = PipelineModel.load(runs[0].model_path)
    assert first.transform(spark.table("predictive.sales")).count() > 0


def test_reset_makes_the_next_commit_overwrite(spark):
    land = landing.build(spark, SF_SMALL, ("lookups", "moves"))
    formatted = scratch_path(spark, "fmt")
    first = jobs.commit_zone(spark, land.root, formatted, ["padro_opendata"])
    n = spark.read.parquet(f"{formatted}/padro_opendata/out").count()
    again = jobs.commit_zone(spark, land.root, formatted, ["padro_opendata"], reset=True)
    assert again == first
    assert spark.read.parquet(f"{formatted}/padro_opendata/out").count() == n


def test_a_failing_pipe_does_not_stop_the_others(spark):
    land = landing.build(spark, SF_SMALL, ("lookups", "moves"))   # no income file
    formatted = scratch_path(spark, "fmt")
    with pytest.raises(jobs.ZoneRunError) as err:
        jobs.commit_zone(spark, land.root, formatted, ["padro_opendata", "income_opendata"])
    assert set(err.value.failures) == {"income_opendata"}
    assert spark.read.parquet(f"{formatted}/padro_opendata/out").count() > 0
