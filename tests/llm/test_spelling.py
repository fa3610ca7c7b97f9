import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from terrace.llm import queries, spelling

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("word", T.StringType()), T.StructField("N", T.StringType())])
FOLD = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows, salt=31, least=7):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            if salt:
                x = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if x % salt == 0:
                    run = run[:x % len(run)] + run[x % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    rel = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(rel[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(rel[w]), words.get(form[w])))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS).repartition(3)


def random_rows(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé×ÿ") for _ in range(rng.randint(6, 12))) for _ in range(40)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(40):
            w = rng.choice(base[:rng.choice([3, 10, 40])])
            if rng.random() < 0.1:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abÀ") + w[at:],
                                w[:at] + rng.choice("xyÖ") + w[at + 1:]])
            words.append(rng.choice([w, w.upper(), w.title(), w]))
        rows.append((i, rng.choice([" ", "-", "1"]).join(words)))
    return rows + [(None, "Doubled Doubled doubled"), (200, None), (201, ""), (202, "ß" * 9 + " " + "ß" * 9),
                   (203, "a" * 300 + " " + "a" * 300 + " " + "a" * 299 + " " + "a" * 299), (204, "a" * 300),
                   (5, "Repeated repeated rows"), (5, "Repeated repeated rows")]


def test_query_against_all_pairs(spark, monkeypatch):
    rows = random_rows(1)
    monkeypatch.setattr(queries, "table", lambda *a: frame(spark, rows))
    got = sorted(map(tuple, queries.op13_spelling_variants(spark, "").collect()), key=str)
    want = expected(rows)
    assert got == want
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)


def test_full_filters_change_nothing(spark, monkeypatch):
    rows = random_rows(2)
    monkeypatch.setattr(spelling, "FILTER_BYTES", 64)
    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    got = sorted(map(tuple, spelling.variants(frame(spark, rows), 31).collect()), key=str)
    assert got == expected(rows)


def test_chains_of_forms(spark):
    """Every word ten times as frequent as the one before it."""
    words = ["aaaaaaa" + "b" * i for i in range(5)]
    text = " ".join(" ".join([w] * (2 * 10 ** i)) for i, w in enumerate(words))
    got = {r["word"]: (r["form"], r["root"], r["form_n"]) for r in spelling.variants(frame(spark, [(1, text)])).collect()}
    assert got == {w: (words[i + 1] if i < 4 else None, words[4], 2 * 10 ** (i + 1) if i < 4 else None)
                   for i, w in enumerate(words)}


def test_ties_take_the_smallest_word(spark):
    text = " ".join(["tiedword"] * 2 + ["tiedworz"] * 20 + ["tiedworb"] * 20 + ["alonealone"] * 2)
    got = {r["word"]: r for r in spelling.variants(frame(spark, [(1, text)])).collect()}
    assert got["tiedword"]["form"] == "tiedworb" and got["tiedword"]["n_near"] == 2
    assert (got["alonealone"]["form"], got["alonealone"]["root"], got["alonealone"]["n_near"]) == (None, "alonealone", 0)


def test_no_words(spark):
    for rows in ([], [(1, None)], [(1, "short one")]):
        assert spelling.variants(frame(spark, rows)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(frame(spark, []), times=1)


def test_filters_hold_all_words_and_stay_in_their_bound():
    sizes = spelling.blocks_per_shard({7: 10**9, 8: 10, 48: 10**8})
    assert sum(sizes.values()) * 64 <= spelling.FILTER_BYTES + 64 * len(sizes)
    words = [f"word{i:04d}x" for i in range(3000)]
    hashes = spelling.sums_of(spelling.codes_of(words))[:, -1]
    table = np.zeros((100, spelling.LANES), np.uint64)
    block, mixed = spelling.places(hashes, 100)
    for lane in range(spelling.LANES):
        np.bitwise_or.at(table[:, lane], block, spelling.lane_bit(mixed, lane))
    assert len(spelling.probe(table, hashes)) == len(words)
    assert len(spelling.probe(None, hashes)) == 0


def test_all_edits_are_probed_in_lots(monkeypatch):
    """With full filters, every deletion and every higher replacement once."""
    monkeypatch.setattr(spelling, "PROBES", 7)
    words = ["aabbcab", "cccaaab"]
    full = {n: np.full((3, spelling.LANES), ~np.uint64(0)) for n in (6, 7)}
    got = list(spelling.candidates(words, full, np.array([ord(c) for c in "abc"], np.uint64)))
    want = [(k, w[:i] + w[i + 1:]) for k, w in enumerate(words) for i in range(7) if w[i:i + 1] != w[i + 1:i + 2]]
    want += [(k, w[:i] + c + w[i + 1:]) for k, w in enumerate(words) for i in range(7) for c in "abc" if c > w[i]]
    assert sorted(got) == sorted(want)
