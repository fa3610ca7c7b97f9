import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm import merkle, queries

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType()),
                     T.StructField("text", T.StringType()), T.StructField("node", T.StringType()),
                     T.StructField("G", T.StringType()), T.StructField("witness", T.StringType())])


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def tree(leaves):
    """(root, per leaf the list of (siblings before, siblings after)) by levels."""
    paths, where, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for p, at in zip(paths, where):
            a = at // 3 * 3
            p.append((nodes[a:at], nodes[at + 1:a + 3]))
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        where = [at // 3 for at in where]
    return nodes[0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        subs[s] = (own, *tree([leaf_of(*r) for r in own]))
    root, upper = tree([subs[s][1] for s in order])
    out = []
    for s, up in zip(order, upper):
        own, sub, paths = subs[s]
        for r, path in zip(own, paths):
            node = leaf_of(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                node = leaf_of(*r[:4], r[4].replace("\n", "") if r[4] is not None else None)
            for before, after in path + up:
                node = h(*before, node, *after)
            out.append((r[0], leaf_of(*r), sub, root, h(*[x for b, a in path + up for x in b + a]), node, node == root))
    return out


def query(spark, rows, monkeypatch):
    frame = spark.createDataFrame([(*r, "n", "g", "w") for r in rows], DOCS).repartition(3)
    monkeypatch.setattr(queries, "table", lambda *a: frame)
    return sorted(map(tuple, queries.op11_merkle_manifest(spark, "").collect()), key=str)


def test_against_plain_levels(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "a", "a", "a", "é", "b", "", None, "="]), rng.choice(["en", None]), rng.choice([5, None]),
             rng.choice(["one\ntwo", "three", "", "\n\n", None, "日本\n"])) for i in range(60)]
    rows += [(100, "single", "en", 1, "x\ny"), (7, "b", "en", 3, "again"), (7, "b", "en", 3, "again"),
             (None, "b", "en", 3, "no\nid"), (None, None, None, None, None)]
    assert query(spark, rows, monkeypatch) == sorted(expected(rows), key=str)


def test_one_source_in_many_blocks(spark, monkeypatch):
    """Small blocks, so that a source takes several rounds; sizes around powers of three."""
    plain = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda *a: plain(*a, height=1))
    rows = [(i, "hot" if i < 82 else f"s{i % 11}", "en", i, f"t\n{i}") for i in range(120)]
    assert query(spark, rows, monkeypatch) == sorted(expected(rows), key=str)


def test_one_row_and_no_rows(spark, monkeypatch):
    one = [(2, "s", "en", 3, "a\nb")]
    assert query(spark, one, monkeypatch) == sorted(expected(one), key=str)
    assert query(spark, [], monkeypatch) == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 100])
def test_witnesses_are_complete_after_the_last_append(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    tree_ = merkle.Appender(merkle.levels_of(n))
    for i, leaf in enumerate(leaves):
        tree_.append(leaf)
        # No witness is longer than the completed runs above its leaf.
        assert len(tree_.witnesses[i]) <= 65 * tree_.levels
    root = tree_.close()
    want, paths = tree([x.hex() for x in leaves])
    assert root.hex() == want
    for leaf, witness, path in zip(leaves, tree_.witnesses, paths):
        folded, proof = merkle.fold(leaf, bytes(witness))
        assert folded == want
        assert proof == h(*[x for b, a in path for x in b + a])


def test_a_changed_row_is_found(spark):
    rows = [(i, "s", "en", 1, f"text {i}", "n", "g", "w") for i in range(10)]
    docs = spark.createDataFrame(rows, DOCS)
    copy = merkle.row_digest([F.lit("other")])
    kept = merkle.manifest(docs, ["text"], F.when(docs["doc_id"] == 4, copy))
    assert {r["id"]: r["verified"] for r in merkle.audit(kept).collect()} == {i: i != 4 for i in range(10)}
