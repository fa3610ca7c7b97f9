"""Ledger, gates, sinks and publishing (A9-A18) on small Spark-written data."""

from pyspark.sql import functions as F

from terrace import schemas
from terrace.plans import extract, landing, standardise
from terrace.session import scratch_path
from terrace.sources import files, ledger

from .conftest import SF_SMALL


def test_second_commit_adds_nothing_and_reset_overwrites(spark):
    land = landing.build(spark, SF_SMALL, ("lookups", "moves"))
    formatted = scratch_path(spark, "fmt")
    first = standardise.commit_moves(spark, land, formatted)
    assert first
    n1 = spark.read.parquet(f"{formatted}/padro_opendata/out").count()
    assert standardise.commit_moves(spark, land, formatted) == []
    assert spark.read.parquet(f"{formatted}/padro_opendata/out").count() == n1
    ledger.reset(spark, f"{formatted}/padro_opendata/_ledger", "padro_opendata")
    again = standardise.commit_moves(spark, land, formatted)
    assert sorted(again) == sorted(first)
    # overwrite after a reset: no duplicated rows
    assert spark.read.parquet(f"{formatted}/padro_opendata/out").count() == n1


def test_new_item_is_appended_as_its_own_batch(spark):
    land = landing.build(spark, SF_SMALL, ("lookups",))
    formatted = scratch_path(spark, "fmt")
    raw = landing.raw_listings(spark, SF_SMALL)
    years = [r[0] for r in raw.select("_year").distinct().orderBy("_year").collect()]
    landing.write_listings(spark, SF_SMALL, land, years[:1])
    assert len(standardise.commit_listings(spark, land, formatted)) == 1
    landing.write_listings(spark, SF_SMALL, land, years[1:])
    assert len(standardise.commit_listings(spark, land, formatted)) == len(years) - 1
    out = spark.read.parquet(f"{formatted}/idealista/out")
    assert out.select("batch").distinct().count() == 2
    assert out.count() == raw.count()
    assert out.select("queryDate").distinct().count() == len(years)


def test_income_gate_runs_once_per_version(spark):
    land = landing.build(spark, SF_SMALL, ("lookups", "income"))
    formatted = scratch_path(spark, "fmt")
    assert standardise.commit_income(spark, land, formatted)
    assert standardise.commit_income(spark, land, formatted) == []
    read = lambda: standardise.read_formatted(
        spark, formatted, "income_opendata", schemas.INCOME)
    n = read().count()
    landing.write_income(spark, SF_SMALL, land)          # a newer delivery
    assert standardise.commit_income(spark, land, formatted)
    assert read().count() == n                           # the new version only
    ledger.reset(spark, f"{formatted}/income_opendata/_ledger", "income_opendata")
    assert read().count() == n                           # a reset keeps the data


def test_item_listing_matches_pattern_only(spark):
    root = scratch_path(spark, "items")
    spark.range(3).write.parquet(f"{root}/2020_01_01_idealista")
    spark.range(3).write.parquet(f"{root}/2020_01_01_other")
    items = files.list_items(spark, root, r"[^/]*_idealista").collect()
    assert [r.item for r in items] == ["2020_01_01_idealista"]
    assert items[0].path.endswith("/2020_01_01_idealista")


def test_extract_is_skipped_when_fresh_and_retries_failed_publish(spark):
    land = landing.build(spark, SF_SMALL)
    formatted = scratch_path(spark, "fmt")
    exploitation = scratch_path(spark, "exp")
    standardise.commit_listings(spark, land, formatted)
    standardise.commit_moves(spark, land, formatted)
    standardise.commit_income(spark, land, formatted)
    loc = f"{exploitation}/warehouse"
    res = extract.run(spark, formatted, exploitation, ["neighbourhood", "sales"], loc)
    assert res == {"neighbourhood": "SUCCESS", "sales": "SUCCESS"}
    assert spark.table("predictive.sales").count() > 0
    assert extract.run(spark, formatted, exploitation, ["neighbourhood"], loc) == \
        {"neighbourhood": "fresh"}
    # a failed publish is remembered and retried although the data are fresh
    log = f"{exploitation}/_publish_status"
    out = ledger.last_status(spark, log).where(F.col("pipe") == "neighbourhood").first().output
    ledger.record_status(spark, log, "neighbourhood", ledger.FAILED, out, "descriptive")
    assert extract.run(spark, formatted, exploitation, ["neighbourhood"], loc) == \
        {"neighbourhood": "SUCCESS"}
    last = ledger.last_status(spark, log).where(F.col("pipe") == "neighbourhood").first()
    assert last.status == ledger.SUCCESS


def test_retry_after_a_crash_between_write_and_ledger_does_not_duplicate(spark, monkeypatch):
    land = landing.build(spark, SF_SMALL, ("lookups",))
    formatted = scratch_path(spark, "fmt")
    raw = landing.raw_listings(spark, SF_SMALL)
    years = [r[0] for r in raw.select("_year").distinct().orderBy("_year").collect()]
    landing.write_listings(spark, SF_SMALL, land, years[:2])
    standardise.commit_listings(spark, land, formatted)
    landing.write_listings(spark, SF_SMALL, land, years[2:4])

    real_append = ledger.append

    def crash(spark, path, pipe, entries, kind=ledger.ITEM, run_id=None):
        if kind == ledger.ITEM:
            raise RuntimeError("driver lost after the write")
        real_append(spark, path, pipe, entries, kind, run_id)
    monkeypatch.setattr(ledger, "append", crash)
    try:
        standardise.commit_listings(spark, land, formatted)
    except RuntimeError:
        pass
    monkeypatch.setattr(ledger, "append", real_append)
    out = f"{formatted}/idealista/out"
    assert spark.read.parquet(out).select("batch").distinct().count() == 2   # orphan batch

    landing.write_listings(spark, SF_SMALL, land, years[4:])   # more arrives before the retry
    assert len(standardise.commit_listings(spark, land, formatted)) == len(years) - 2
    df = spark.read.parquet(out)
    assert df.count() == raw.count()
    assert df.select("propertyCode").distinct().count() == raw.count()
    assert df.select("batch").distinct().count() == 2
