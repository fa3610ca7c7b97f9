import numpy as np

from terrace.llm import blocked_bloom


def test_no_key_is_lost_and_few_others_pass(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(-(1 << 63), 1 << 63, 3000, dtype=np.int64)
    others = rng.integers(-(1 << 63), 1 << 63, 20_000, dtype=np.int64)
    known = spark.createDataFrame([(int(k),) for k in keys], "k long")
    rows = spark.createDataFrame([(int(k), "own") for k in keys] + [(int(k), "other") for k in others] + [(None, "null")],
                                 "key long, tag string")
    got = {r["tag"]: r["count"] for r in blocked_bloom.keep_held(rows, "key", known, "k").groupBy("tag").count().collect()}
    assert got["own"] == 3000 and got.get("other", 0) < 200 and "null" not in got


def test_a_full_filter_lets_all_through(spark, monkeypatch):
    monkeypatch.setattr(blocked_bloom, "FILTER_BYTES", 64)
    assert blocked_bloom.blocks_for(10**12) == 1
    rng = np.random.default_rng(4)
    keys = rng.integers(-(1 << 63), 1 << 63, 2000, dtype=np.int64)
    known = spark.createDataFrame([(int(k),) for k in keys], "k long")
    assert blocked_bloom.keep_held(known, "k", known, "k").count() == 2000


def test_no_keys(spark):
    known = spark.createDataFrame([], "k long")
    rows = spark.createDataFrame([(1,), (2,)], "k long")
    assert blocked_bloom.keep_held(rows, "k", known, "k").count() == 0
    assert blocked_bloom.keep_held(known, "k", rows, "k").count() == 0
