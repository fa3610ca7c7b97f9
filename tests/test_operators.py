"""Unit tests on tiny literal frames for semantics the TPC-like data cannot
show (SURVEY section 5, point 2)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace import schemas
from terrace.functions.columns import (conform, flatten_structs, lenient_number, query_date,
                                       query_timestamp, sentinel_to_null, strict_long, year_of)
from terrace.operators.aggregates import keep_first, latest_per_key, null_preserving_sum
from terrace.operators.quantiles import exact_median, kth_smallest, mode_value
from terrace.plans.standardise import spread_info


def test_null_preserving_sum_four_cases(spark):
    df = spark.createDataFrame(
        [("single_null", None), ("two_nulls", None), ("two_nulls", None),
         ("value_and_null", 5), ("value_and_null", None), ("single_value", 7),
         ("three", 1), ("three", 2), ("three", None)],
        "k string, v long")
    got = {r.k: r.s for r in df.groupBy("k").agg(null_preserving_sum("v").alias("s")).collect()}
    assert got == {"single_null": None, "two_nulls": 0, "value_and_null": 5,
                   "single_value": 7, "three": 3}


def test_null_preserving_sum_differs_from_sql_sum(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "k string, v long")
    r = df.groupBy("k").agg(null_preserving_sum("v").alias("s"), F.sum("v").alias("plain")).first()
    assert r.s == 0 and r.plain is None


def test_flatten_last_non_null_leaf_wins(spark):
    schema = T.StructType([
        T.StructField("a", T.StructType([T.StructField("x", T.LongType()),
                                         T.StructField("y", T.StringType())])),
        T.StructField("b", T.StructType([T.StructField("x", T.LongType()),
                                         T.StructField("z", T.ArrayType(T.LongType()))])),
    ])
    df = spark.createDataFrame([((1, "p"), (2, [1, 2])), ((3, "q"), (None, None)),
                                (None, (4, [])), ((None, "r"), None)], schema)
    flat = flatten_structs(df)
    assert flat.columns == ["x", "y", "z"]
    rows = [tuple(r) for r in flat.collect()]
    assert rows == [(2, "p", [1, 2]), (3, "q", None), (4, None, []), (None, "r", None)]


def test_strict_integer_parse_fails_on_bad_text(spark):
    df = spark.createDataFrame([("12",), ("x1",)], "v string")
    with pytest.raises(PySparkException):
        df.select(strict_long("v")).collect()


def test_sentinel_to_null(spark):
    df = spark.createDataFrame([("..",), ("7",), (None,)], "v string")
    assert [r[0] for r in df.select(sentinel_to_null("v")).collect()] == [None, 7, None]


def test_lenient_number_and_floor_code(spark):
    df = spark.createDataFrame([("bj",), ("3",), ("en",), (None,)], "v string")
    got = [r[0] for r in df.select(lenient_number("v", {"bj": "0"})).collect()]
    assert got == [0.0, 3.0, None, None]


def test_query_date_parsing(spark):
    df = spark.createDataFrame([("2020_03_04",)], "d string")
    r = df.select(year_of("d").alias("y"), query_date("d").alias("dt"),
                  query_timestamp("d").alias("ts")).first()
    assert r.y == 2020 and str(r.dt) == "2020-03-04" and str(r.ts) == "2020-03-04 00:00:00"


def test_spread_info_empty_and_null_arrays(spark):
    df = spark.createDataFrame(
        [("a", [(2020, 1, 1.0), (2021, 2, 2.0)]), ("b", []), ("c", None)],
        T.StructType([T.StructField("n", T.StringType()),
                      T.StructField("info", T.ArrayType(schemas.INCOME_INFO))]))
    out = spread_info(df)
    assert out.columns == ["n", "year", "pop", "RFD"]
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2020, 1, 1.0), ("a", 2021, 2, 2.0)]


def test_spread_info_struct_fields_override_base(spark):
    df = spark.createDataFrame(
        [("a", 1999, [(2020, 1, 1.0)])],
        T.StructType([T.StructField("n", T.StringType()), T.StructField("year", T.LongType()),
                      T.StructField("info", T.ArrayType(schemas.INCOME_INFO))]))
    assert [tuple(r) for r in spread_info(df).collect()] == [("a", 2020, 1, 1.0)]


def test_latest_per_key_ties_are_deterministic(spark):
    df = spark.createDataFrame([("k", 2020, 5), ("k", 2021, 1), ("k", 2021, 9), ("j", 2000, 3)],
                               "key string, year long, v long")
    got = {r.key: (r.year, r.v) for r in latest_per_key(df, ["key"], "year").collect()}
    assert got == {"k": (2021, 9), "j": (2000, 3)}


def test_keep_first_is_stable_and_complete(spark):
    df = spark.createDataFrame([(1, 1, "b", 2.0), (1, 1, "a", 9.0), (1, 2, "z", 0.0)],
                               "o long, l long, s string, x double")
    got = sorted(tuple(r) for r in keep_first(df, ["o", "l"]).collect())
    assert got == [(1, 1, "a", 9.0), (1, 2, "z", 0.0)]


def test_conform_by_name_with_widening_and_nulls(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    target = schemas.struct([("a", "string"), ("b", "long"), ("c", "double")])
    out = conform(df, target)
    assert out.schema == target
    assert tuple(out.first()) == ("x", 1, None)
    with pytest.raises(ValueError):
        conform(df.withColumn("extra", F.lit(1)), target, extra="error")


def test_conform_enforces_non_nullable(spark):
    df = spark.createDataFrame([("2020_01_01",), (None,)], "queryDate string")
    with pytest.raises(PySparkException):
        conform(df, schemas.LISTING, enforce_not_null=True).collect()


@pytest.mark.parametrize("values", [[1.0, 5.0, 2.0, 8.0], [3.0], [4.0, 4.0, 4.0, 1.0, 9.0]])
def test_exact_median_matches_definition(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    s = sorted(values)
    n = len(s)
    want = s[n // 2] if n % 2 else (s[n // 2 - 1] + s[n // 2]) / 2
    assert exact_median(df, "v") == want


def test_kth_smallest_narrowing_path(spark, monkeypatch):
    import terrace.operators.quantiles as q
    monkeypatch.setattr(q, "FINAL_ROWS", 50)
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).cast("double").alias("v"))
    for k in (1, 777, 2500, 5000):
        assert kth_smallest(df, "v", k) == float(k - 1)


def test_kth_smallest_hot_value(spark, monkeypatch):
    import terrace.operators.quantiles as q
    monkeypatch.setattr(q, "FINAL_ROWS", 50)
    # a third of all rows share one value
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(42.0)).otherwise(F.col("id").cast("double"))
         .alias("v"))
    vals = sorted(r.v for r in df.collect())
    for k in (1, 1000, 1500, 3000):
        assert kth_smallest(df, "v", k) == vals[k - 1]


def test_exact_median_narrowing_even_and_hot(spark, monkeypatch):
    import terrace.operators.quantiles as q
    monkeypatch.setattr(q, "FINAL_ROWS", 50)
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).cast("double").alias("v"))
    assert exact_median(df, "v") == 2499.5
    hot = spark.range(0, 3000).select(
        F.when(F.col("id") < 1400, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("v"))
    vals = sorted(r.v for r in hot.collect())
    assert exact_median(hot, "v") == (vals[1499] + vals[1500]) / 2
    assert q.smallest_at(hot, "v", 1399, 3) == vals[1398:1401]


def test_mode_ties_go_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,),
                                (None,)], "v string")
    assert mode_value(df, "v") == "a"


def test_broadcast_only_within_measured_size(spark):
    from terrace.operators.joins import checked_broadcast, measure
    side = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("s"))
    assert measure(side) == (100, 100 * 8 + 100 * 1000)
    big = spark.range(10_000).select(F.col("id").alias("k"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        within = big.join(checked_broadcast(side, max_bytes=200_000, persist=False), "k")
        over = big.join(checked_broadcast(side, max_bytes=50_000, persist=False), "k")
        assert "BroadcastHashJoin" in within._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in over._jdf.queryExecution().executedPlan().toString()
        assert within.count() == over.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_reject_count_reports_rows_an_inner_lookup_join_drops(spark):
    from terrace.operators.joins import reject_count
    rows = spark.createDataFrame([("Gracia", "la Salut"), ("Gracia", "La Salut"),
                                  ("Sants", "Hostafrancs"), (None, "x")], "d string, n string")
    lookup = spark.createDataFrame([("Gracia", "la Salut", "7"), ("Sants", "Hostafrancs", "9")],
                                   "d string, n string, id string")
    assert reject_count(rows, lookup, ["d", "n"]).first().rejected == 2   # case differs; null
    assert rows.join(lookup, ["d", "n"]).count() == 2                      # result unchanged
