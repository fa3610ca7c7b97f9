import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from terrace.llm import components as component_module
from terrace.llm import simhash
from terrace.llm.components import components

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("_mark", T.StringType()), T.StructField("Component_ID", T.LongType())])


def brute_fingerprint(text, k):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_groups(rows, k, bits):
    marks = [brute_fingerprint(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    lowest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            lowest[find(i)] = min(d, lowest.get(find(i), d))
    return sorted(((d, f"{marks[i]:016x}", lowest.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def texts(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeÉ") for _ in range(rng.randint(1, 6)))
    base = [word() for _ in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "one\x0btwo"),
            (None, "one two"), (None, "alone here now then"), (7, "é b  c"), (3, "one")]
    for i in range(10, 70):
        w = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            w[rng.randrange(len(w))] = word()
        rows.append((i, (" " if i % 2 else "\n").join(w).upper() if i % 5 == 0 else " ".join(w)))
    rows += [(i, " ".join(word() for _ in range(rng.randint(1, 30)))) for i in range(70, 90)]
    rows.append((90, "long " * 70_000 + "tail"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], DOCS)


@pytest.mark.parametrize("bits", [0, 3, 6])
def test_matches_brute_force(spark, bits):
    rows = texts()
    got = simhash.near_duplicates(frame(spark, rows), 3, bits).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(rows, 3, bits)


def test_hidden_bit_errors_are_found(spark):
    """Marks with errors spread over the segments in every way."""
    rng = random.Random(5)
    marks = set()
    for at in ((1, 2, 3), (0, 30, 50), (22, 23, 60), (0, 1, 63), (43, 44, 45), (30, 31, 45), (21, 22, 43)):
        m = rng.getrandbits(64)
        marks |= {m, m ^ sum(1 << i for i in at)}
    signed = np.array(sorted(marks), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(m,) for m in signed], "mark long")
    got = {r.mark: r.component for r in simhash.mark_components(df, 3).collect()}
    assert len(got) == 14 and len(set(got.values())) == 7


def test_dense_group_stays_connected(spark):
    """A chain of marks one bit apart inside one bucket, and a group near it."""
    rng = random.Random(6)
    m, chain = rng.getrandbits(63), []
    for i in range(40):
        m ^= 1 << rng.randrange(63)
        chain.append(m)
    far = [m ^ 0b11111, m ^ 0b111110]
    df = spark.createDataFrame([(x,) for x in sorted({*chain, *far})], "mark long")
    got = {r.mark: r.component for r in simhash.mark_components(df, 3).collect()}
    rows = sorted({*chain, *far})
    groups = {x: x for x in rows}
    changed = True
    while changed:
        changed = False
        for a in rows:
            for b in rows:
                if (a ^ b).bit_count() <= 3 and groups[a] != groups[b]:
                    low = min(groups[a], groups[b])
                    groups[a] = groups[b] = low
                    changed = True
    linked = {x: g for x, g in groups.items() if sum(v == g for v in groups.values()) > 1}
    assert got == linked


def test_keep_one(spark):
    rows = texts()
    want = brute_groups(rows, 3, 3)
    out = simhash.keep_one(frame(spark, rows), 3, 3)
    assert out.columns == ["doc_id", "text", "_mark", "Component_ID"]
    kept = [r.doc_id for r in out.collect()]
    assert sorted(d for d in kept if d is not None) == sorted({c for _, _, c in want if c is not None})
    assert sum(d is None for d in kept) == len({m for d, m, c in want if c is None})


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, []), 3, 3).count() == 0
    assert simhash.keep_one(frame(spark, []), 3, 3).count() == 0


def test_golay_code_is_perfect():
    tables = simhash.golay_tables()
    words = np.arange(1 << 23, dtype=np.int64)
    index = simhash.decode(words, tables)
    assert (np.bincount(index, minlength=4096) == 2048).all()


def test_components_of_long_path_and_star(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 400)] + [(500, 500), (None, 3)]
    got = {r.node: r.component
           for r in components(spark.createDataFrame(path + star, "u long, v long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 400)} == {100}
    assert 500 not in got and len(got) == 61 + 300
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_no_side_that_grows_is_broadcast(spark, monkeypatch):
    """Whatever size Spark gives the buckets (it takes them to be no more than
    the marks they were made from), no join gathers them in the driver."""
    plans, write = [], simhash.cut

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(simhash, "cut", seen)
    monkeypatch.setattr(component_module, "cut", seen)
    seen(simhash.near_duplicates(frame(spark, texts()), 3, 3), "near")
    assert {"near", "simhash-buckets", "simhash-mixed", "simhash-links"} <= {n for n, _ in plans}
    assert [n for n, p in plans if "Broadcast" in p] == []
    assert sum("SortMergeJoin" in p for _, p in plans) >= 5
