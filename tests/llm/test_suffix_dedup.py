import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from terrace.llm import queries, suffix_dedup
from terrace.llm.suffix_array import repeated_starts, suffix_array

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("th", T.StringType()), T.StructField("spans", T.StringType())])


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=80), st.lists(st.sampled_from(b"ab"), max_size=120).map(bytes),
                 st.tuples(st.binary(max_size=6), st.integers(0, 20)).map(lambda x: x[0] * x[1])))
def test_suffix_array_is_the_sorted_suffixes(text):
    assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_starts_of_some_windows():
    text = b"abcabcdabcabcd-abcabce"
    starts = np.array([0, 3, 7, 10, 15])
    assert repeated_starts(text, starts, 3).tolist() == [0, 3, 7, 10, 15]
    assert repeated_starts(text, starts, 7).tolist() == [0, 7]
    assert repeated_starts(text, np.array([0, 15]), 7).tolist() == []
    assert repeated_starts(text, np.array([4]), 2).tolist() == []


def expected(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((r[0], len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def query(spark, rows, monkeypatch, length):
    monkeypatch.setattr(queries, "WINDOW", length)
    monkeypatch.setattr(queries, "table", lambda *a: spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS))
    return sorted(map(tuple, queries.op12_suffix_dedup(spark, "").collect()), key=str)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}é" for i in range(40)]
    passages = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        for _ in range(rng.choice([0, 1, 1, 2])):
            passage = rng.choice(passages)
            a = rng.randint(0, 15)
            parts.insert(rng.randint(0, 3), passage[a:len(passage) - rng.randint(0, 15)])
        rows.append((i, "\n".join(parts)))
    return rows


EDGES = [(100, None), (101, ""), (102, "short"), (103, "é" * 150), (104, "ab" * 300), (105, "x" * 7 + "ab" * 40 + "y"),
         (106, "same row, twice, with an id and more than forty bytes of text"),
         (106, "same row, twice, with an id and more than forty bytes of text"),
         (None, "no id here, but a text of more than forty bytes that stands twice"),
         (None, "no id here, but a text of more than forty bytes that stands twice"),
         (107, "".join(chr(0x4E00 + i % 97) for i in range(400))), (108, "\x00\x7f" * 60)]


def test_against_all_windows(spark, monkeypatch):
    rows = random_rows(1) + EDGES
    assert query(spark, rows, monkeypatch, 40) == expected(rows, 40)


def test_small_pieces_and_packs(spark, monkeypatch):
    """Texts longer than a piece, many suffix arrays."""
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 300)
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", 500)
    rows = random_rows(2, 20) + EDGES
    assert query(spark, rows, monkeypatch, 40) == expected(rows, 40)


def test_hot_keys_are_counted(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 400)
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 300)
    rows = random_rows(3) + EDGES
    assert query(spark, rows, monkeypatch, 40) == expected(rows, 40)


def test_odd_lengths_and_empty_table(spark, monkeypatch):
    rows = random_rows(4, 25) + EDGES
    for length in (4, 37, 200):
        assert query(spark, rows, monkeypatch, length) == expected(rows, length)
    assert query(spark, [], monkeypatch, 40) == []


def test_real_outputs(spark):
    passage = "a passage of forty bytes, more or less, é"
    rows = [(1, f"before {passage} after", "t", "s"), (2, passage, "t", "s"), (3, "other", "t", "s")]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCS), 30).collect()}
    assert bytes(got[1]["kept"]) == b"before  after"
    assert [tuple(x) for x in got[1]["removed"]] == [(7, len(passage.encode()))]
    assert bytes(got[2]["kept"]) == b"" and bytes(got[3]["kept"]) == b"other" and got[3]["removed"] == []
