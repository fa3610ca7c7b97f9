"""Reject counts taken by the writes (M2), strict nested records (M3), joint
medians and modes (M4, M5), and the bound on trees."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from terrace import schemas
from terrace.operators import quantiles
from terrace.operators.joins import Quality
from terrace.plans import landing, price_model, standardise
from terrace.session import scratch_path
from terrace.sources import files, ledger

from .conftest import SF_SMALL


def test_counts_come_from_the_write_itself(spark):
    root = scratch_path(spark, "quality")
    spark.range(100).select((F.col("id") % 10).alias("k"), "id").write.parquet(f"{root}/facts")
    lookup = spark.createDataFrame([(i, f"n{i}") for i in range(7)], "code long, name string")
    other = spark.createDataFrame([(f"n{i}", i) for i in range(5)], "n2 string, z long")
    quality = Quality()
    df = quality.reconcile(spark.read.parquet(f"{root}/facts"), F.broadcast(lookup), F.col("k") == F.col("code"), "first")
    df = quality.reconcile(df, F.broadcast(other), F.col("name") == F.col("n2"), "second")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{root}/facts") == 1 and plan.count("CollectMetrics") == 2
    df.write.parquet(f"{root}/out")
    assert quality.counts() == {"first": {"rows": 100, "unknown": 30}, "second": {"rows": 70, "unknown": 20}}
    assert spark.read.parquet(f"{root}/out").count() == 50


def test_every_run_records_one_row(spark):
    land = landing.Landing(scratch_path(spark, "landing"))
    landing.write_lookups(spark, SF_SMALL, land, "n_nationkey <> 3")
    years = landing.write_listings(spark, SF_SMALL, land, [1995])
    formatted = scratch_path(spark, "fmt")
    led = f"{formatted}/idealista/_ledger"
    assert standardise.commit_listings(spark, land, formatted)
    landing.write_listings(spark, SF_SMALL, land, [1996, 1997])
    assert standardise.commit_listings(spark, land, formatted)
    assert standardise.commit_listings(spark, land, formatted) == []
    rows = ledger.read(spark, led).where(F.col("kind") == ledger.QUALITY).collect()
    assert len(rows) == 2 and {r["run_id"] for r in rows} == set(ledger.committed_batches(spark, led))
    counts = ledger.quality(spark, led).collect()
    kept = standardise.read_formatted(spark, formatted, "idealista", schemas.LISTING).count()
    raw = landing.raw_listings(spark, SF_SMALL).where("_year IN (1995, 1996, 1997)")
    assert sum(r["rows"] for r in counts) == raw.count()
    assert sum(r["rows"] - r["unknown"] for r in counts) == kept
    assert sum(r["unknown"] for r in counts) > 0 and len(years) == 1


def test_a_null_or_empty_side_is_counted(spark):
    lookup = spark.createDataFrame([], "code long, name string")
    facts = spark.createDataFrame([(None,), (1,)], "k long")
    quality = Quality()
    df = quality.reconcile(facts, lookup, F.col("k") == F.col("code"), "s")
    assert df.count() == 0 and quality.counts() == {"s": {"rows": 2, "unknown": 2}}
    quality = Quality()
    df = quality.reconcile(facts.limit(0), lookup, F.col("k") == F.col("code"), "s")
    df.collect()
    assert quality.counts() == {"s": {"rows": 0, "unknown": 0}}


# --- strict records ----------------------------------------------------------------

def _income(spark, lines):
    path = scratch_path(spark, "income")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return files.read_json_strict(spark, path, schemas.RAW_INCOME, ["info"])


def test_declared_records_are_read_as_before(spark):
    lines = ['{"neigh_name ": "a", "district_name": "d", "info": [{"year": 2010, "pop": 5, "RFD": 1.5}, {"year": 2011, "RFD": 2}]}',
             '{"neigh_name ": "b", "info": []}', '{"district_name": "e", "info": null, "other": 1}',
             '{"neigh_name ": "c", "info": [null, {"pop": 1}]}']
    got = [r.asDict(recursive=True) for r in _income(spark, lines).orderBy("`neigh_name `").collect()]
    assert got == [
        {"neigh_name ": None, "district_name": "e", "info": None},
        {"neigh_name ": "a", "district_name": "d", "info": [{"year": 2010, "pop": 5, "RFD": 1.5}, {"year": 2011, "pop": None, "RFD": 2.0}]},
        {"neigh_name ": "b", "district_name": None, "info": []},
        {"neigh_name ": "c", "district_name": None, "info": [None, {"year": None, "pop": 1, "RFD": None}]}]


@pytest.mark.parametrize("line, message", [
    ('{"neigh_name ": "a", "info": [{"year": 1}, {"year": 2, "births": 3, "Area": 1}]}', "undeclared fields in info: Area, births"),
    ('{"neigh_name ": "a", "info": [{"year": "soon"}]}', "soon"),
    ('{"neigh_name ": ', "(?i)malformed|json"),
])
def test_other_records_fail_the_run_by_name(spark, line, message):
    with pytest.raises(Exception, match=message):
        _income(spark, ['{"neigh_name ": "x", "info": []}', line]).collect()


# --- medians and modes ---------------------------------------------------------------

def _jobs(spark, run):
    """(result, number of jobs)."""
    group = scratch_path(spark, "group")
    spark.sparkContext.setJobGroup(group, "count")
    out = run()
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_joint_medians_equal_single_ones(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "JOINT_ROWS", 20)
    rng = random.Random(4)
    rows = [(rng.gauss(0, 1), float(rng.choice([1, 1, 1, 1, 2, 7])), None if i % 3 else float(i % 40), None, i if i % 2 else -i,
             5.0 if i < 900 else rng.random()) for i in range(2001)]
    df = spark.createDataFrame(rows, "a double, `b.c` double, c double, d double, e long, hot double").cache()
    cols = df.columns
    got, jobs = _jobs(spark, lambda: quantiles.exact_medians(df, cols))
    for i, c in enumerate(cols):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[c] == (statistics.median(values) if values else None), c
    one, fewer = _jobs(spark, lambda: quantiles.exact_medians(df, ["a"]))
    assert one["a"] == got["a"] and jobs <= fewer + 8             # rounds, not columns
    assert quantiles.exact_medians(df.limit(0), cols) == dict.fromkeys(cols)
    for n in range(1, 8):
        few = spark.createDataFrame([(float(x),) for x in range(n)], "v double")
        assert quantiles.exact_medians(few, ["v"]) == {"v": statistics.median(range(n))}


def test_joint_modes_are_one_pass(spark):
    rows = [("x", 1, None, "b"), ("y", 1, None, "a"), ("y", 2, None, "a"), (None, 2, None, "b"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a string, b long, c string, `d.e` string")
    got, jobs = _jobs(spark, lambda: quantiles.mode_values(df, df.columns))
    assert got == {"a": "y", "b": 1, "c": None, "d.e": "a"}
    _, one = _jobs(spark, lambda: quantiles.mode_values(df, ["a"]))
    assert jobs == one
    assert got["a"] == quantiles.mode_value(df, "a") and got["b"] == quantiles.mode_value(df, "b")
    assert quantiles.mode_values(df.limit(0), ["a", "b"]) == {"a": None, "b": None}
    assert quantiles.mode_values(df, []) == {}


def test_trees_are_bounded_by_rows_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(price_model, "MAX_LEAVES", 4)
    rng = random.Random(1)
    rows = [(str(i), float(rng.random()), rng.choice("ab"), float(i % 97)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, x double, c string, price double")
    root = scratch_path(spark, "model")
    price_model.train(spark, df, "k", ["x"], ["c"], root, num_trees=3)
    from pyspark.ml import PipelineModel
    path = spark.read.parquet(f"{root}/model_store").first()["model_path"]
    forest = PipelineModel.load(path).stages[-1]
    assert max((t.numNodes + 1) // 2 for t in forest.trees) <= 4


def test_training_rows_are_dealt_over_the_cores(spark):
    # As from a file of one row group: one partition with all rows.
    rows = spark.range(4000).selectExpr("cast(id as string) AS k", "id % 7 AS `a.b`").coalesce(1)
    dealt = price_model.spread(rows, 4000)
    sizes = dealt.rdd.glom().map(len).collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism
    assert sum(sizes) == 4000 and max(sizes) <= 2 * min(sizes)
    assert dealt.collect() == price_model.spread(rows, 4000).collect()
    assert price_model.spread(rows, 9 * price_model.ROWS_A_TASK).rdd.getNumPartitions() == 9
    forest = price_model.build_pipeline(None, ["x"], ["c"]).getStages()[-1]
    assert forest.getCacheNodeIds() and forest.getNumTrees() == 100 and forest.getMaxDepth() == 30
