import os
import random
import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import types as T

from terrace.llm import substring_dedup as sd
from terrace.llm.shared import CLEANUP_CONF

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("kind", T.StringType()), T.StructField("_spans", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], DOCS)


def prose(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def paragraphs(rows):
    """Lines of five words or more, and blocks of several lines, as
    (document, first word, words)."""
    seen = set()
    for d, t in rows:
        at, block = 0, []
        for line in [*(t or "").split("\n"), ""] if d is not None else []:
            w = line.lower().split()
            if len(w) >= 5:
                seen.add((d, at, tuple(w)))
            if not w:
                whole = [x for _, line in block for x in line]
                if len(block) > 1 and len(whole) >= 5:
                    seen.add((d, block[0][0], tuple(whole)))
                block = []
            else:
                block.append((at, w))
            at += len(w)
    return sorted(seen)


def brute(rows):
    units = paragraphs(rows)
    sets = [{w[i:i + 5] for i in range(len(w) - 4)} for _, _, w in units]
    parent = list(range(len(units)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(units)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (d, s, w) in enumerate(units):
        groups.setdefault(find(i), []).append((d, s, len(w)))
    out = []
    for g in groups.values():
        d, s, n = min(g, key=lambda x: (x[0], x[1], -x[2]))
        gone = {x: x[0] != d or x[1] >= s + n for x in g}
        if any(gone.values()):
            out += [(*x, d, s, gone[x]) for x in g]
    return sorted(out)


def found_paragraphs(got):
    return sorted((r.doc_id, r.start_word, r.n_words, r.component_id, r.component_start, r.removed) for r in got
                  if r.kind == "paragraph")


def sample():
    rng = random.Random(8)
    bases = [prose(rng, 60) for _ in range(3)]
    rows = [(1, None), (2, ""), (3, "too short"), (None, " ".join(bases[0]))]
    for i in range(10, 60):
        lines = []
        for b in rng.sample(bases, 2):
            w = list(b)
            for _ in range(rng.choice((0, 0, 1, 2, 3, 4))):
                w[rng.randrange(len(w))] = prose(rng, 1)[0]
            lines.append(" ".join(w))
        lines.insert(1, " ".join(prose(rng, rng.randint(1, 80))))
        rows.append((i, "\n".join(lines)))
    rows += [rows[-1], (70, "Same Line " * 20 + "\n" + "same line " * 20), (71, " ".join(prose(rng, 30_000)))]
    return rows


def test_paragraphs_match_brute_force(spark):
    rows = sample()
    got = sd.repeats(frame(spark, rows)).collect()
    assert found_paragraphs(got) == brute(rows)


def test_short_lines_and_wrapped_blocks(spark):
    """Lines of 5 to 24 words; blocks whose lines break elsewhere; repeats
    within one text; blank lines of spaces; all kinds of white space."""
    rng = random.Random(11)
    lines = [" ".join(prose(rng, n)) for n in (5, 6, 9, 14, 24)]
    block = prose(rng, 60)
    rows = []
    for i in range(30):
        w = list(block)
        for _ in range(i % 4):
            w[rng.randrange(60)] = prose(rng, 1)[0]
        cuts = sorted(rng.sample(range(1, 60), rng.randint(0, 6)))
        wrapped = [" ".join(w[a:b]) for a, b in zip([0, *cuts], [*cuts, 60])]
        own = [" ".join(prose(rng, rng.randint(1, 12))) for _ in range(4)]
        text = [*own[:2], rng.choice(lines).title(), rng.choice(["", "   ", "\t"]), *wrapped, "", rng.choice(lines), own[2], "", "", own[3]]
        rows.append((i, "\n".join(text)))
    title = prose(rng, 30)
    rows += [(50, "title\n" + " ".join(title)), (51, "x y z\n" + " ".join(prose(rng, 40)) + "\nend")]
    rows += [(40, f"{lines[1]}\n\n{lines[1]}\n\nother words\n{lines[1]}"), (41, "a b c d"), (42, "\n\n"), (43, "one\ntwo\nthree\nfour\nfive"),
             (44, "one two\u2003three\u00a0four\x1cfive"), (45, "É é\u3000e e e\n\né É e e e")]
    got = sd.repeats(frame(spark, rows)).collect()
    assert found_paragraphs(got) == brute(rows)
    assert len({r.n_words for r in got}) > 5


@pytest.mark.parametrize("large", [64, 2])
def test_members_of_several_groups_in_one_bucket(spark, monkeypatch, large):
    """A long shared passage inside paragraphs that differ beside it, and
    chains of near copies: buckets hold several groups."""
    monkeypatch.setattr(sd, "LARGE_BUCKET", large)
    rng = random.Random(12)
    shared, rows = prose(rng, 40), []
    chain = prose(rng, 40)
    for i in range(40):
        rows.append((i, " ".join(prose(rng, 14) + shared + prose(rng, 14))))
        chain = list(chain)
        chain[rng.randrange(40)] = prose(rng, 1)[0]
        rows.append((100 + i, " ".join(chain)))
        rows.append((200 + i, " ".join(shared[:30 + i % 11])))
    got = sd.repeats(frame(spark, rows)).collect()
    assert found_paragraphs(got) == brute(rows)


def test_passages_repeated_in_one_text(spark):
    rng = random.Random(13)
    passage = prose(rng, 51)
    words = prose(rng, 33) + passage + prose(rng, 70) + passage + prose(rng, 20)
    got = sd.repeats(frame(spark, [(1, " ".join(words)), (2, " ".join(prose(rng, 300)))])).collect()
    assert got and {r.doc_id for r in got} == {1} and {r.kind for r in got} == {"passage"}
    assert {r.removed for r in got} == {True, False}
    spans = [(r.start_word, r.start_word + r.n_words) for r in got]
    assert all(33 <= a and b <= 84 or 154 <= a and b <= 205 for a, b in spans)


def test_words_as_python_splits_them():
    import pyarrow as pa

    rng = random.Random(14)
    gaps = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x85", "\u00a0", "\u1680", "\u2000", "\u200a", "\u2028", "\u202f",
            "\u205f", "\u3000", "\x1c", "\x1f"]
    letters = "abÉß你🙂\u200b\u2010\u180e\u00c2.".replace("\u00c2", "Â")
    texts = ["".join(rng.choice(gaps) if rng.random() < 0.3 else rng.choice(letters) for _ in range(rng.randint(0, 60)))
             for _ in range(400)]
    how = sd.Units(0.8, 0.999, 25, 27)
    seen = {}
    for number, codes, offsets in sd.text_lots(pa.array(texts)):
        w = how.words(codes, offsets)
        for k, i in enumerate(number.tolist()):
            own = slice(int(w.first[k]), int(w.first[k + 1]))
            expected = texts[i].lower().split()
            assert own.stop - own.start == len(expected), texts[i]
            for h, word in zip(w.hash[own].tolist(), expected):
                assert seen.setdefault(word, h) == h
            numbers = [n for n, line in enumerate(texts[i].split("\n")) for _ in line.split()]
            assert np.diff(w.line[own]).tolist() == np.diff(numbers).tolist()
    assert len(set(seen.values())) == len(seen)


def test_passages_inside_lines(spark):
    """Fifty-one shared words anywhere are found; other texts are left alone."""
    rng = random.Random(9)
    rows = []
    for i in range(20):
        passage = prose(rng, 51)
        for j in range(2):
            words = prose(rng, 80) + passage + prose(rng, 40)
            rows.append((i * 10 + j, (" " if j else "\n").join(words)))
        rows.append((i * 10 + 5, " ".join(prose(rng, 200))))
    got = sd.repeats(frame(spark, rows)).collect()
    assert {r.doc_id for r in got} == {d for d, _ in rows if d % 10 < 5}
    assert {(r.doc_id // 10) for r in got if r.removed} == set(range(20))


def test_remove(spark):
    rng = random.Random(10)
    same = " ".join(prose(rng, 60))
    df = frame(spark, [(1, f"first\n\n{same}\n\nend"), (2, f"Second here\n\n{same}\n\nlast words"), (3, None)])
    out = {r.doc_id: r for r in sd.remove(df, sd.repeats(df)).collect()}
    assert out[1].text == f"first\n\n{same}\n\nend" and out[3].text is None
    assert out[2].text.split() == "Second here last words".split() and out[2]["_spans"] == 1


def test_empty_table(spark):
    assert sd.repeats(frame(spark, [])).count() == 0


def test_bands_reach_the_recall():
    bands, rows = sd.tune_bands(0.8, 0.999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999
    how = sd.Units(0.8, 0.999, 25, 27)
    rng, hit = np.random.default_rng(1), 0
    for _ in range(300):
        a = rng.integers(0, 1 << 62, 90, dtype=np.uint64)
        b = np.concatenate([a[:80], rng.integers(0, 1 << 62, 10, dtype=np.uint64)])    # Jaccard 0.8
        ka, kb = (how.bands_of(how.signatures(x, np.array([0])))[0] for x in (a, b))
        hit += bool((ka == kb).any())
    assert hit >= 296


def test_sketches_rule_out_what_is_not_similar(spark):
    rng = random.Random(16)
    base = rng.sample(range(1 << 31), 400)
    part = lambda a, b: base[a:a + 100] + [rng.randrange(1 << 31) for _ in range(b)]
    rows = [(i, part(0, 0)[:100 - i % 12]) for i in range(60)] + [(100 + i, part(i, 60)) for i in range(60)]
    sets = spark.createDataFrame(rows, "node long, shingles array<int>")
    got = {r["node"]: [r[f"s{i}"] & (1 << 64) - 1 for i in range(sd.SKETCH_BITS // 64)] for r in sd._with_sketches(sets).collect()}
    known, limit, ruled_out = {k: set(v) for k, v in rows}, sd.sketch_limit(0.8), 0
    for u, v in combinations(sorted(known), 2):
        apart = sum((a ^ b).bit_count() for a, b in zip(got[u], got[v]))
        j = len(known[u] & known[v]) / len(known[u] | known[v])
        assert j < 0.8 or apart <= limit
        ruled_out += j < 0.55 and apart > limit
    assert ruled_out > 0.95 * sum(len(known[u] & known[v]) < 0.55 * len(known[u] | known[v]) for u, v in combinations(known, 2))


def nodes_of(units):
    return units.where(units.kind == sd.PARAGRAPH).selectExpr("d1 AS node").distinct()


def test_shingle_sets_are_made_where_the_texts_are_read(spark):
    """The texts are neither joined nor shuffled for their paragraphs' sets."""
    how = sd.Units(0.8, 0.999, 25, 27)
    texts = frame(spark, sample()).where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    units = sd.cut(sd.extract_units(texts, how), "test-units")
    sets = sd._paragraph_sets(texts, units, nodes_of(units), how)
    assert "Join" not in sets._jdf.queryExecution().executedPlan().toString()
    assert sets.count() == nodes_of(units).count()


@pytest.mark.parametrize("filter_bytes", [32 << 20, 64])
def test_shingle_sets_of_chosen_paragraphs(spark, monkeypatch, filter_bytes):
    """Ids that stand for several texts, repeated rows, and a full filter,
    which lets every paragraph through: each set is that of its words."""
    monkeypatch.setattr(sd.blocked_bloom, "FILTER_BYTES", filter_bytes)
    rng = random.Random(21)
    lines = [" ".join(prose(rng, rng.choice((5, 8, 40)))) for _ in range(40)]
    rows = [(i % 9, "\n\n".join(rng.sample(lines, 3))) for i in range(60)]
    texts = frame(spark, [*rows, rows[-1]]).select("doc_id", "text")
    how = sd.Units(0.8, 0.999, 25, 27)
    units = sd.cut(sd.extract_units(texts, how), "test-units")
    some = nodes_of(units).where("node % 2 = 0")
    got = {r.node: r for r in sd._paragraph_sets(texts, units, some, how).collect()}
    want = {}
    for line in {x for _, t in rows for x in t.split("\n\n")}:
        w = how.words(np.frombuffer(line.encode(), np.uint8), np.array([0, len(line)]))
        (d1,), (d2,) = how.digests(w.hash, np.array([0]), np.array([len(w.hash)]))
        want[int(d1)] = (int(d2), sorted(set(how.shingles(w.hash).astype(np.uint32).view(np.int32).tolist())))
    asked = {r.node for r in some.collect()}
    assert asked and asked <= set(got) <= set(want)
    assert all((r.d2, r.shingles) == want[n] for n, r in got.items())


def test_cut_leaves_no_shuffle_files(spark):
    """The disk that a step's shuffle took is free once its copy is written,
    and the session's setting is as before."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        return {f for d in manager.localDirs() for _, _, names in os.walk(d.getPath()) for f in names
                if f.startswith("shuffle_")}

    before, setting = held(), spark.conf.get(CLEANUP_CONF, None)
    rows = sd.cut(spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").agg({"id": "sum"}), "test-cut")
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.1)
    assert not held() - before
    assert spark.conf.get(CLEANUP_CONF, None) == setting
    assert rows.count() == 7
