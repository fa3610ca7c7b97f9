"""Deliveries and runs that differ from the tidy case: headers and types of
their own, hot values, null keys, missing sources, rewritten lookups."""

import pytest
from pyspark.sql import functions as F

from terrace.functions.columns import strict_long
from terrace.operators import joins, quantiles
from terrace.plans import price_model
from terrace.sources import files, sinks

COLUMNS = ["Codi_Barri", "CODI_BARRI_DEST", "Any", "Valor"]


def test_csv_items_are_read_under_their_own_header(spark, tmp_path):
    (tmp_path / "2019_x.csv").write_text("Codi_Barri,CODI_BARRI_DEST,Any,Valor\n1,2,2019,5\n")
    (tmp_path / "2020_x.csv").write_text("Any,CODI_BARRI_DEST,Extra,Codi_Barri,Valor\n2020,2,e,1,..\n")
    df = files.read_csv_items(spark, [str(p) for p in sorted(tmp_path.iterdir())], COLUMNS)
    assert sorted(map(tuple, df.collect())) == [("1", "2", "2019", "5"), ("1", "2", "2020", "..")]
    (tmp_path / "2021_x.csv").write_text("Any,Codi_Barri,Valor\n2021,1,3\n")
    with pytest.raises(ValueError, match="CODI_BARRI_DEST"):
        files.read_csv_items(spark, [str(tmp_path / "2021_x.csv")], COLUMNS)


def test_parquet_items_of_different_types(spark, tmp_path):
    for name, kind in (("a", "int"), ("b", "long"), ("c", "int")):
        spark.range(2).select(F.col("id").cast(kind).alias("rooms")).write.parquet(str(tmp_path / name))
    groups = files.parquet_groups(spark, [str(tmp_path / n) for n in "abc"])
    assert sorted(g.count() for g in groups) == [2, 4]


def test_items_are_named_by_the_first_part_below_the_root(spark, tmp_path):
    root = tmp_path / "2018_01_01_team_idealista" / "landing"
    for item in ("2020_01_01_idealista", "2021_01_01_idealista"):
        spark.range(1).write.parquet(str(root / item))
    spark.range(1).write.parquet(str(root / "old" / "2020_01_01_idealista"))
    items = files.list_items(spark, str(root), r"[^/]*_idealista").collect()
    assert sorted(r["item"] for r in items) == ["2020_01_01_idealista", "2021_01_01_idealista"]
    assert all("/old/" not in r["path"] and r["path"].endswith(r["item"]) for r in items)


@pytest.mark.parametrize("hot", [0.5, 1.0, 99.0, 200.0])
@pytest.mark.parametrize("n", [2000, 2001])
def test_median_with_a_hot_edge(spark, monkeypatch, hot, n):
    """Half of all rows share one value; the read in order stays small."""
    monkeypatch.setattr(quantiles, "FINAL_ROWS", 50)
    values = [float(i % 100) if i % 2 else hot for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    want = sorted(values)
    mid = n // 2
    assert quantiles.exact_median(df, "x") == (want[mid] if n % 2 else (want[mid - 1] + want[mid]) / 2)


def test_split_loses_no_row(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,), ("c",)], "k string")
    train, test = price_model.split(df, "k")
    assert train.count() + test.count() == 5


def test_strict_integer_without_ansi(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("7",), (None,)], "x string")
        assert [r[0] for r in df.select(strict_long("x")).collect()] == [7, None]
        with pytest.raises(Exception, match="not an integer"):
            spark.createDataFrame([("x1",)], "x string").select(strict_long("x")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_first_write_replaces_all_under_dynamic_overwrite(spark, tmp_path):
    out = str(tmp_path / "out")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for batch in ("one", "two"):
            sinks.write_first_or_append(spark.range(3), out, True, batch)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.parquet(out).count() == 3


def test_released_sides_see_new_files(spark, tmp_path):
    path, names = str(tmp_path / "lookup"), []
    for name in ("old", "new"):
        spark.createDataFrame([(1, name)], "k int, name string").write.mode("overwrite").parquet(path)
        spark.catalog.refreshByPath(path)
        with joins.held_sides():
            side = joins.checked_broadcast(spark.read.parquet(path), name="lookup")
            names.append(spark.range(1, 2).join(side, F.col("id") == F.col("k")).first()["name"])
    assert names == ["old", "new"]


def test_a_run_releases_its_own_sides_only(spark):
    held = lambda sides: [s.storageLevel.useMemory for s in sides]
    with joins.held_sides():
        joins.checked_broadcast(spark.range(5).withColumn("x", F.lit("outer")))
        outer = list(joins._SCOPE.get())
        with joins.held_sides():
            sides = joins.checked_broadcasts({"a": spark.range(6).withColumn("y", F.lit("a")),
                                              "b": spark.range(7).withColumn("y", F.lit("b"))})
            inner = list(joins._SCOPE.get())
            assert [s.count() for s in sides] == [6, 7] and held(inner) == [True, True]
        assert held(outer) == [True] and held(inner) == [False, False]
    assert held(outer) == [False]
