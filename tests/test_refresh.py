"""Incremental refresh, releases and year partitions (M1, M7, M9)."""

import pytest
from pyspark.sql import functions as F

from terrace import schemas
from terrace.functions.columns import conform
from terrace.operators import joins
from terrace.plans import catalogue, curate, extract, incremental, standardise, standins
from terrace.session import scratch_path
from terrace.sources import files, ledger, releases

from .conftest import SF_SMALL


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(autouse=True)
def scope():
    """The full refreshes that the tests compare with release their sides too."""
    with joins.held_sides():
        yield


def _as_full(spark, formatted, exploitation, table):
    with joins.held_sides():
        return _same_rows(incremental.table(spark, exploitation, table), _full(spark, formatted, table))


def _full(spark, formatted, table):
    """The curated table from the whole formatted zone."""
    read = {s: standardise.read_formatted(spark, formatted, s, k) for s, k in (
        ("idealista", schemas.LISTING), ("padro_opendata", schemas.MOVES), ("income_opendata", schemas.INCOME))}
    lst, mov, inc = read["idealista"], read["padro_opendata"], read["income_opendata"]
    return {"neighbourhood": lambda: curate.neighbourhood(inc, mov), "real_estate": lambda: curate.real_estate(mov, lst),
            "sale_prices": lambda: curate.sale_prices(lst, inc), "sales": lambda: curate.sales(lst, inc, mov)}[table]()


@pytest.fixture(scope="module")
def zone(spark):
    """Formatted zone with one delivery, brought in once."""
    root = scratch_path(spark, "refresh")
    formatted, exploitation = f"{root}/formatted", f"{root}/exploitation"
    income = standins.income(spark, SF_SMALL)
    catalogue.write_formatted_income(spark, income.where("year < 1997"), formatted)
    catalogue.write_formatted_batches(spark, SF_SMALL, formatted, 0, 4)
    assert incremental.refresh(spark, formatted, exploitation)
    return formatted, exploitation, income


def test_each_delivery_equals_a_full_refresh(spark, zone):
    formatted, exploitation, income = zone
    root = incremental.root_of(exploitation)
    assert incremental.refresh(spark, formatted, exploitation) is None          # nothing new

    first = releases.latest(spark, root)
    kept = incremental.table(spark, exploitation, "sales")
    before = kept.count()
    for number, new_income in ((1, False), (2, True), (3, False)):
        catalogue.write_formatted_batches(spark, SF_SMALL, formatted, number, 4)
        if new_income:
            catalogue.write_formatted_income(spark, income, formatted)
        assert incremental.refresh(spark, formatted, exploitation)
        for table in incremental.TABLES:
            assert _as_full(spark, formatted, exploitation, table), (number, table)
    # An earlier release is still what it was.
    assert incremental.table(spark, exploitation, "sales", first).count() == before == kept.count()


def test_a_delivery_of_listings_reads_its_batch_only(spark, zone):
    """No sum changes: one part per year is added, from the new folder alone."""
    formatted, exploitation, _ = zone
    root = incremental.root_of(exploitation)
    old = releases.entries(spark, root)["sales"]
    rows = standins.listings(spark, SF_SMALL).where(F.col("propertyCode").cast("long") % 50 == 7)
    standardise.write_first_or_append(rows, f"{formatted}/idealista/out", False, "extra", standardise.listing_parts())
    ledger.append(spark, f"{formatted}/idealista/_ledger", "idealista", ["extra"], run_id="extra")

    plan = incremental.new_listings(spark, formatted, ["extra"], None)
    assert plan.inputFiles() and all("/batch=extra/" in f for f in plan.inputFiles())
    assert incremental.refresh(spark, formatted, exploitation)
    new = releases.entries(spark, root)["sales"]
    assert set(old.items()) < set(new.items())
    assert _as_full(spark, formatted, exploitation, "sales")


def test_years_prune_the_scan_at_run_time(spark, zone):
    formatted, _, _ = zone
    batches = ledger.committed_batches(spark, f"{formatted}/idealista/_ledger")
    listed = standardise.read_formatted(spark, formatted, "idealista", schemas.LISTING)
    first, last = (int(y) for y in listed.agg(F.min(F.substring("queryDate", 1, 4)), F.max(F.substring("queryDate", 1, 4))).first())
    assert first < last
    years = spark.createDataFrame([(first, "x"), (last, "y")], "year long, tag string").where("tag = 'x'")
    df = incremental.listings_of_years(spark, formatted, batches, years)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert {r[0] for r in df.select(F.substring("queryDate", 1, 4)).distinct().collect()} == {str(first)}
    one = [c for c in files.children(spark, f"{formatted}/idealista/out/batch={batches[0]}") if c.is_dir]
    assert len(one) > 1 and all(c.name.startswith("part_year=") for c in one)


def test_a_run_without_its_release_changes_nothing(spark, zone, monkeypatch):
    formatted, exploitation, _ = zone
    root = incremental.root_of(exploitation)
    before = releases.latest(spark, root), incremental.table(spark, exploitation, "sales").count()
    rows = standins.listings(spark, SF_SMALL).limit(5)
    standardise.write_first_or_append(rows, f"{formatted}/idealista/out", False, "late", standardise.listing_parts())
    ledger.append(spark, f"{formatted}/idealista/_ledger", "idealista", ["late"], run_id="late")

    def stop(*a):
        raise RuntimeError("stopped before the release")

    monkeypatch.setattr(releases, "commit", stop)
    with pytest.raises(RuntimeError):
        incremental.refresh(spark, formatted, exploitation)
    monkeypatch.undo()
    assert (releases.latest(spark, root), incremental.table(spark, exploitation, "sales").count()) == before
    assert incremental.refresh(spark, formatted, exploitation)
    assert _as_full(spark, formatted, exploitation, "sales")


def test_partials_are_merged_and_a_reset_starts_over(spark, zone, monkeypatch):
    formatted, exploitation, _ = zone
    root = incremental.root_of(exploitation)
    monkeypatch.setattr(incremental, "MAX_PARTIALS", 1)
    rows = standins.listings(spark, SF_SMALL).limit(3)
    standardise.write_first_or_append(rows, f"{formatted}/idealista/out", False, "more", standardise.listing_parts())
    ledger.append(spark, f"{formatted}/idealista/_ledger", "idealista", ["more"], run_id="more")
    assert incremental.refresh(spark, formatted, exploitation)
    assert len(set(releases.entries(spark, root)[incremental.LISTINGS].values())) == 1
    assert _as_full(spark, formatted, exploitation, "real_estate")

    for source in ("idealista", "padro_opendata"):
        ledger.reset(spark, f"{formatted}/{source}/_ledger", source)
    catalogue.write_formatted_batches(spark, SF_SMALL, formatted, 0, 2)
    assert incremental.refresh(spark, formatted, exploitation)
    for table in incremental.TABLES:
        assert _as_full(spark, formatted, exploitation, table), table


def test_a_single_movement_without_value_stays_null(spark):
    """The null-preserving sum survives merging: null alone, 0 with others."""
    row = lambda v: (2020, v, "n", "1", "d", "1", "n", "2", "d", "1")
    schema = schemas.MOVES
    one = incremental.move_partials(spark.createDataFrame([row(None)], schema))
    two = incremental.move_partials(spark.createDataFrame([row(None)], schema))
    three = incremental.move_partials(spark.createDataFrame([row(4)], schema))
    total = lambda *p: incremental.moved_sums(
        incremental.merged_moves(p[0] if len(p) == 1 else p[0].unionByName(p[1])), "origin", "m").first()["m"]
    assert total(one) is None
    assert total(one, two) == 0
    assert total(one, three) == 4
    assert total(incremental.merged_moves(one.unionByName(two)), three) == 4


def test_releases_hold_whole_sets(spark):
    root = scratch_path(spark, "releases")
    assert releases.latest(spark, root) is None and releases.entries(spark, root) == {}
    spark.range(3).write.parquet(f"{root}/a")
    spark.range(4).write.parquet(f"{root}/b")
    run = releases.commit(spark, root, {"t": {"x": f"{root}/a", "y": f"{root}/b"}})
    again = releases.commit(spark, root, {"t": {"x": f"{root}/a"}, "u": {"all": f"{root}/b"}})
    schema = spark.range(1).schema
    assert releases.latest(spark, root) == again
    assert releases.read(spark, root, "t", schema).count() == 3
    assert releases.read(spark, root, "t", schema, run).count() == 7
    with pytest.raises(LookupError):
        releases.read(spark, root, "missing", schema)


def test_published_tables_move_as_one_set(spark, monkeypatch):
    """A publish that fails leaves readers of the release on the earlier set."""
    root = scratch_path(spark, "sets")
    formatted, exploitation = f"{root}/formatted", f"{root}/exploitation"
    location = f"{exploitation}/warehouse"
    tag = root.rsplit("-", 1)[-1]
    monkeypatch.setattr(extract, "CURATED", {t: (f"{db}_{tag}", i, p) for t, (db, i, p) in extract.CURATED.items()})
    catalogue.write_formatted_income(spark, standins.income(spark, SF_SMALL), formatted)
    catalogue.write_formatted_batches(spark, SF_SMALL, formatted, 0, 2)
    assert set(extract.run(spark, formatted, exploitation, location=location).values()) == {ledger.SUCCESS}
    first = releases.latest(spark, exploitation)
    rows = {t: extract.released(spark, exploitation, t).count() for t in extract.CURATED}
    assert first and extract.run(spark, formatted, exploitation, location=location) == dict.fromkeys(extract.CURATED, "fresh")
    assert releases.latest(spark, exploitation) == first

    catalogue.write_formatted_batches(spark, SF_SMALL, formatted, 1, 2)
    plain = extract.publish
    monkeypatch.setattr(extract, "publish", lambda s, out, db, table, loc: (_ for _ in ()).throw(OSError("catalog away"))
                        if table == "sale_prices" else plain(s, out, db, table, loc))
    result = extract.run(spark, formatted, exploitation, location=location)
    assert result["sale_prices"] == ledger.FAILED and result["sales"] == ledger.SUCCESS
    assert releases.latest(spark, exploitation) == first
    assert {t: extract.released(spark, exploitation, t).count() for t in extract.CURATED} == rows

    monkeypatch.setattr(extract, "publish", plain)
    assert extract.run(spark, formatted, exploitation, location=location)["sale_prices"] == ledger.SUCCESS
    assert releases.latest(spark, exploitation) != first
    assert extract.released(spark, exploitation, "sale_prices").count() > rows["sale_prices"]


# --- ledger snapshots -----------------------------------------------------------------

def _items(spark, led):
    return sorted(r["item"] for r in ledger.processed_items(spark, led).collect())


def test_the_number_of_ledger_files_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(ledger, "MAX_TAIL", 4)
    led = scratch_path(spark, "ledger")
    for i in range(30):
        ledger.append(spark, led, "p", [f"i{i:02d}"], run_id=f"r{i:02d}")
        assert len(files.children(spark, led)) <= 3 * ledger.MAX_TAIL
    assert _items(spark, led) == [f"i{i:02d}" for i in range(30)]
    assert len(files.children(spark, f"{led}/{ledger.SNAPSHOTS}")) <= 3
    assert ledger.committed_batches(spark, led) == [f"r{i:02d}" for i in range(30)]
    ledger.reset(spark, led, "p")
    assert _items(spark, led) == [] and ledger.is_empty(spark, led)


def test_an_interrupted_compaction_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(ledger, "MAX_TAIL", 10**6)
    led = scratch_path(spark, "ledger")
    for i in range(4):
        ledger.append(spark, led, "p", [f"i{i}"])
    # Stopped before the snapshot's file appeared: a folder without one.
    spark.range(1).write.parquet(f"{led}/{ledger.SNAPSHOTS}/99990101T000000000000/_temporary/x")
    assert _items(spark, led) == ["i0", "i1", "i2", "i3"]
    files.remove(spark, [f"{led}/{ledger.SNAPSHOTS}/99990101T000000000000"])
    ledger.compact(spark, led)
    ledger.append(spark, led, "p", ["i4"])
    # Stopped between the snapshot and the removal of what it covers.
    monkeypatch.setattr(files, "remove", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        ledger.compact(spark, led)
    assert _items(spark, led) == [f"i{i}" for i in range(5)]
    monkeypatch.undo()
    ledger.append(spark, led, "p", ["i5"])
    ledger.compact(spark, led)
    assert _items(spark, led) == [f"i{i}" for i in range(6)]


@pytest.mark.parametrize("table", ["sale_prices", "sales"])
def test_deliveries_join_the_movements_once(spark, monkeypatch, table):
    read, table_of = [], standins.table
    monkeypatch.setattr(standins, "table", lambda spark, sf, name: read.append(name) or table_of(spark, sf, name))
    got = catalogue.QUERIES[f"incremental_{table}"](spark, SF_SMALL)
    assert read.count("lineitem") == 1
    monkeypatch.undo()
    want = catalogue.QUERIES[f"gold_{table}"](spark, SF_SMALL)
    assert _same_rows(got.select(want.columns), want)


def test_deliveries_join_the_orders_once(spark, monkeypatch):
    read, table_of = [], standins.table
    monkeypatch.setattr(standins, "table", lambda spark, sf, name: read.append(name) or table_of(spark, sf, name))
    got = catalogue.QUERIES["incremental_real_estate"](spark, SF_SMALL)
    assert {t: read.count(t) for t in ("orders", "customer", "lineitem")} == {"orders": 1, "customer": 1, "lineitem": 1}
    monkeypatch.undo()
    want = catalogue.QUERIES["gold_real_estate"](spark, SF_SMALL)
    assert _same_rows(got.select(want.columns), want)


def test_years_made_again_are_not_read_as_new(spark):
    formatted = scratch_path(spark, "years")
    rows = conform(spark.createDataFrame([("1", "2020_01_02"), ("2", "2021_01_02"), ("3", None)],
                                         "propertyCode string, queryDate string"), schemas.LISTING)
    standardise.write_first_or_append(rows, f"{formatted}/idealista/out", True, "b0", standardise.listing_parts())
    new = incremental.new_listings(spark, formatted, ["b0"], [2020])
    assert {r["propertyCode"] for r in new.collect()} == {"2", "3"}
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "2020" in plan.split("PartitionFilters: [")[1].split("]")[0]       # its folder is not read
