"""The pipeline against plain Python over the input of each stage."""

import logging
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from terrace.llm import components, language_id, pii, queries, simhash
from terrace.llm.shared import cut

from .test_scans import brute_items
from .test_simhash import brute_groups

SF = "/root/testdata/sf0.001"
NAMES = ["doc_id", "text", "lang", "source", "n_chars"]
# Nothing of a language that the corpus has; no letter; copies; a benchmark item; values.
VALUES = " mail jane.roe@example.org or call +1 212 555 0187 on 2024-03-05, card 4111 1111 1111 1111"
PLANTED = [(900_001, "日本語の文章です。これは学習されていない文字で書かれています。" * 6), (900_002, "12345 -- 67890 !!"), (900_003, None),
           (900_004, "")]


@pytest.fixture(scope="module")
def corpus(spark):
    docs = queries.table(spark, SF, "documents").select(*NAMES)
    item = queries.table(spark, SF, "benchmark").first()["text"]
    first, other = (r["text"] for r in docs.where("length(text) > 500").orderBy("doc_id").take(2))
    extra = [*PLANTED, (900_005, " ".join(reversed(other.split())) + VALUES), (900_006, first), (900_007, "some words before it " + item + " and some after it")]
    added = spark.createDataFrame([(d, t, None, "planted", None) for d, t in extra], docs.schema)
    return cut(docs.unionByName(added), "pipeline-test")


def test_every_stage_against_plain_python(spark, corpus):
    spark.conf.set(corpus_pipeline.KEY_SETTING, "a key for the tests")
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    # 1: what the nearest centroid of the same model rejects, computed text by text.
    docs = corpus
    _, learn = language_id.learn_rule(docs["doc_id"])
    model = language_id.train(docs, learn)
    make = language_id.Vectoriser(model.letters, model.codes, model.idf)
    kept = {}
    for d, t in rows(docs).items():
        if not t or not any(c.isalpha() for c in t):
            continue
        vector = np.zeros(len(model.codes))
        at, w, n = make.vector(t)
        vector[at] = w
        near = model.centroids.astype(np.float64) @ vector
        best = int(near.argmax())
        if near[best] > 0 and near[best] >= model.floors[best] * min(1.0, (n / language_id.FULL) ** 0.5):
            kept[d] = t
    docs = cut(stages["language_id"](spark, docs, SF), "pipeline-test")
    assert rows(docs) == kept and not {900_001, 900_002, 900_003, 900_004} & set(kept)

    # 2: the smallest id of each group of fingerprints within three bits.
    groups = brute_groups(sorted(rows(docs).items()), 3, 3)
    docs = cut(stages["simhash_near_dedup"](spark, docs, SF), "pipeline-test")
    assert set(rows(docs)) == {d for d, _, lowest in groups if d == lowest} and 900_006 not in rows(docs)

    # 3: documents with a window like an item go.
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF, "benchmark").collect()]
    before = rows(docs)
    short = {d: t for d, t in before.items() if len(t) < 3000}            # all windows of all items: slow in Python
    found = {d for d, _, _ in brute_items(sorted(short.items()), items)}
    docs = cut(stages["benchmark_decontamination"](spark, docs, SF), "pipeline-test")
    assert set(short) - set(rows(docs)) == found and 900_007 in found

    # 4: each text by itself.
    before = rows(docs)
    docs = cut(stages["pii"](spark, docs, SF), "pipeline-test")
    assert rows(docs) == {d: pii.pseudonymise_text(t, b"a key for the tests")[0] for d, t in before.items()}
    assert VALUES in before[900_005] and VALUES not in rows(docs)[900_005]
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())

    # 5: the public library.
    public = Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    public.no_truncation()
    public.no_padding()
    want = {d: public.encode(t, add_special_tokens=False).ids for d, t in rows(docs).items()}
    last = {r["doc_id"]: r for r in stages["bpe"](spark, docs, SF).collect()}
    assert {d: r["ids"] for d, r in last.items()} == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in last.values())


def test_near_dedup_broadcasts_nothing(spark, monkeypatch):
    """The buckets of a mark are about 70 rows, which Spark sizes as one: no
    join of the stage may broadcast by that size."""
    plans, write = {}, simhash.cut

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return write(df, name)

    monkeypatch.setattr(simhash, "cut", seen)
    monkeypatch.setattr(components, "cut", seen)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:30 + i % 25]), "en", "x", 1) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = seen(corpus_pipeline.near_dedup(spark, docs, SF), "kept")
    assert 0 < kept.count() < 50
    assert {"kept", "simhash-buckets", "simhash-mixed", "simhash-links"} <= set(plans)
    assert [n for n, p in plans.items() if "Broadcast" in p] == []


def test_the_key_comes_from_the_session(spark):
    spark.conf.set(corpus_pipeline.KEY_SETTING, "abc")
    assert corpus_pipeline.pseudonym_key(spark) == b"abc"
    spark.conf.set(corpus_pipeline.KEY_SETTING, "  ")
    with pytest.raises(ValueError):
        corpus_pipeline.pseudonym_key(spark)
    spark.conf.unset(corpus_pipeline.KEY_SETTING)
    a, b = corpus_pipeline.pseudonym_key(spark), corpus_pipeline.pseudonym_key(spark)
    assert len(a) == 32 and a != b
    with pytest.raises(ValueError):
        pii.pseudonymise(spark.createDataFrame([("x",)], "text string"), b"")
    long = spark.createDataFrame([("card 4111 1111 1111 1111",)], "text string")
    assert pii.pseudonymise(long, b"k" * 100).first()["text"] != "card 4111 1111 1111 1111"


def test_core_queries_stay_without_a_library(monkeypatch, caplog):
    """A library that only the training-data operators need is missing."""
    import importlib

    for name in [m for m in sys.modules if m.startswith("terrace.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    with caplog.at_level(logging.WARNING):
        entry = importlib.import_module("__spark_entry__")
    assert "public_tokenizers" in caplog.text
    names = set(entry.queries())
    assert "gold_sales" in names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
    assert set(entry.oracle_sql()) <= names
    monkeypatch.delitem(sys.modules, "__spark_entry__")
