"""Decontamination and license scans against brute force."""

import random
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm import decontaminate, license_scan

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("text_key", T.StringType()), T.StructField("gram", T.LongType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], DOCS)


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def grams(w, k):
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute_items(rows, items):
    best = {}
    for d, t in rows:
        w = words((t or "").lower())
        for item, text in items:
            v = words((text or "").lower())
            if not v:
                continue
            k = min(5, len(v))
            own = grams(v, k)
            for s in range(-len(v) + 1, len(w)):
                win = grams(w[max(0, s):s + len(v)], k)
                if not win:
                    continue
                sim = sum((own & win).values()) / sum((own | win).values())
                if sim >= 0.8 and sim > best.get((d, item), 0):
                    best[d, item] = sim
    return sorted((d, i, round(s, 12)) for (d, i), s in best.items())


def bench_sample():
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(prose(rng.randint(12, 50)))) for i in range(12)]
    items += [(20, "Tiny item"), (21, "one"), (22, None), (23, "  "), (24, "the the the the the the the the")]
    rows = [(0, None), (1, ""), (2, "only tiny, ITEM here"), (3, "the " * 30), (None, items[1][1])]
    for d in range(10, 40):
        w = prose(60)
        part = items[d % 12][1].split()
        for _ in range(d % 4):
            part[rng.randrange(len(part))] = rng.choice(vocab)
        if d % 5 == 0:
            part.insert(len(part) // 2, "extra")
        w[30:30] = part
        rows.append((d, (", " if d % 2 else " ").join(w).upper() if d % 7 == 0 else " ".join(w)))
    rows += [(50, " ".join(prose(20_000)) + " " + items[3][1]), rows[8], rows[8]]
    return rows, items


def test_decontamination_matches_brute_force(spark):
    rows, items = bench_sample()
    got = decontaminate.matches(frame(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    want = [(None if d == -1 else d, i, s)
            for d, i, s in brute_items([(-1 if d is None else d, t) for d, t in rows], items)]
    assert sorted(((r.doc_id, r.item_id, round(r.similarity, 12)) for r in got), key=str) == sorted(want, key=str)


def test_clean_keeps_the_others(spark):
    rows, items = bench_sample()
    bad = {d for d, _, _ in brute_items([r for r in rows if r[0] is not None], items)} | {None}
    out = decontaminate.clean(frame(spark, rows), spark.createDataFrame(items, ITEMS))
    assert out.columns == DOCS.names
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, _ in rows if d not in bad)


def test_decontamination_of_empty_tables(spark):
    rows, items = bench_sample()
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.matches(frame(spark, rows), none).count() == 0
    assert decontaminate.matches(frame(spark, []), spark.createDataFrame(items, ITEMS)).count() == 0


def test_simhash_radius_is_guaranteed():
    """Any error pattern within the radius leaves a block with at most two."""
    rng = random.Random(3)
    for _ in range(2000):
        bits = rng.sample(range(64), decontaminate.RADIUS)
        assert min(Counter(b // 8 for b in bits).get(i, 0) for i in range(8)) <= decontaminate.FLIPS


PIECES = ["MIT License", "mit-license!", "the Apache  License, Version 2.0", "GNU General Public License",
          "general public", "All rights reserved.", "Licensed under CC BY-NC 4.0.", "mitlicense", "É MIT\nLICENSE É",
          license_scan.TEXTS[0][1], license_scan.TEXTS[5][1].upper(), license_scan.TEXTS[2][1].replace("file", "FILE X")]


def license_sample():
    rng = random.Random(5)
    rows = [(0, None), (1, ""), (2, "—"), (3, "mit license mit license " * 3), (None, "MIT License")]
    for d in range(10, 60):
        w = ["".join(rng.choice("abcé") for _ in range(3)) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            w.insert(rng.randint(0, len(w)), rng.choice(PIECES))
        rows.append((d, " ".join(w)))
    return [*rows, rows[-1], (70, "word " * 50_000 + "mit license")]


def brute_licenses(text):
    w = words(text)
    places = [(i, label) for phrase, label in license_scan.PHRASES for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def test_base_report_matches_brute_force(spark):
    rows = license_sample()
    got = license_scan.report(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) \
        == sorted(((d, *brute_licenses(t)) for d, t in rows), key=str)
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got)


@pytest.mark.parametrize("i", [0, 2, 5, 9, 12])
def test_license_texts_are_labelled(spark, i):
    label, text = license_scan.TEXTS[i]
    w = text.split()
    changed = w[:3] + ["inserted"] + w[3:] if len(w) > 12 else w
    rows = [(1, "before " + " ".join(changed) + " after"), (2, "nothing of the kind"), (3, " ".join(w[:2]))]
    got = {r.doc_id: r for r in license_scan.report(frame(spark, rows)).collect()}
    assert label in got[1].labels.split(",") and got[2].labels == "" and label not in got[3].labels.split(",")


def test_license_scan_of_empty_table(spark):
    assert license_scan.report(frame(spark, [])).count() == 0


def test_decontamination_of_reordered_items(spark):
    """Parts of an item in another order: no shingle stands at its place in the most similar window."""
    rng = random.Random(21)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    items, rows = [], []
    for i in range(8):
        passage, question = prose(80), prose(20)
        items.append((i, " ".join(passage + question)))
        moved = question + passage
        for j, (a, z) in enumerate([(prose(30), prose(30)), (prose(3), []), ([], prose(40)), ([], []), (prose(50), prose(1))]):
            rows.append((10 * i + j, " ".join(a + moved + z)))
        rows.append((10 * i + 8, " ".join(moved[2:-3])))
        rows.append((10 * i + 9, " ".join(prose(20) + moved[:50] + prose(40) + moved[50:])))
    want = brute_items(rows, items)
    assert len(want) == 48
    df, bench = frame(spark, rows), spark.createDataFrame(items, ITEMS)
    got = decontaminate.matches(df, bench).collect()
    assert sorted((r.doc_id, r.item_id, round(r.similarity, 12)) for r in got) == want
    assert sorted(r.doc_id for r in decontaminate.clean(df, bench).collect()) == [10 * i + 9 for i in range(8)]


def test_neighbouring_gnu_notices_are_told_apart(spark):
    """The base phrase labels each of them gpl, so the long templates are looked at."""
    notice = ("This program is free software: you can redistribute it and/or modify it under the terms of the {} as "
              "published by the Free Software Foundation, either version 3 of the License, or any later version.")
    gpl, lgpl = "GNU General Public License", "GNU Lesser General Public License"
    rows = [(1, notice.format(gpl)), (2, notice.format(lgpl)), (3, notice.format("GNU Affero General Public License")),
            (4, notice.format("GNU Library General Public License")), (5, notice.format(gpl) + " word" * 40 + " " + notice.format(lgpl)),
            (6, notice.format("GNU GPL")), (7, notice.format(f"{gpl} or the {lgpl}"))]
    rows += [(100 + i, text) for i, (_, text) in enumerate(license_scan.TEXTS)]
    df = frame(spark, rows)
    keys = {r.k: r.doc_id for r in df.selectExpr("xxhash64(text) AS k", "doc_id").collect()}
    got = {}
    for r in license_scan.scan(df).where("NOT base").collect():
        got.setdefault(keys[r.text_key], set()).add(r.label)
    assert [got.get(i, set()) for i in range(1, 8)] == [
        {"gpl"}, {"lgpl"}, {"agpl"}, {"lgpl"}, {"gpl", "lgpl"}, {"gpl"}, {"gpl", "lgpl"}]
    assert all(got[100 + i] == {label} for i, (label, _) in enumerate(license_scan.TEXTS))
    labels = {r.doc_id: r.labels for r in license_scan.report(df).collect()}
    assert labels[1] == "gpl" and labels[2] == "gpl,lgpl" and labels[3] == "agpl,gpl"


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_labels(text):
    """(labels, score) by the documented rule, from the words themselves."""
    w, out = words(text), []
    for label, phrase in [(x, p) for p, x in license_scan.PHRASES] + list(license_scan.TEXTS):
        t = words(phrase)
        base = (phrase, label) in license_scan.PHRASES
        if base or len(t) < 8:
            out += [(label, 1.0)] * any(w[i:i + len(t)] == t for i in range(len(w)))
            continue
        at = {}
        for j in range(len(t) - 3):
            at.setdefault(tuple(t[j:j + 4]), []).append(j)
        hits = {(i, j) for i in range(len(w) - 3) for j in at.get(tuple(w[i:i + 4]), [])}
        bands = {}
        for i, j in hits:
            for grid, shift in ((0, 0), (1, license_scan.DRIFT)):
                bands.setdefault((grid, (i - j + shift) // (2 * license_scan.DRIFT)), set()).add((i, j))
        for own in bands.values():
            if len(own) < license_scan.VOTES * (len(t) - 3):
                continue
            win = w[min(i for i, _ in own):max(i for i, _ in own) + 4]
            coverage = 1 - word_distance(win, t) / len(t)
            joined = f" {' '.join(win)} "
            fits = {"gpl": not re.search(license_scan.OTHER_GNU, joined) or regex.search(license_scan.PLAIN_GPL, joined),
                    "lgpl": re.search(license_scan.LESSER_GPL, joined), "agpl": re.search(license_scan.AFFERO_GPL, joined)}
            if coverage >= license_scan.COVERAGE and fits.get(label, True):
                out.append((label, coverage))
    return ",".join(sorted({x for x, _ in out})), max((c for _, c in out), default=0.0)


def license_variants():
    rng = random.Random(31)
    other = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    rows = license_sample()[:40]
    for i, (_, text) in enumerate(license_scan.TEXTS):
        w = text.split()
        for edits in (0, 1, max(1, len(w) // 12), len(w) // 4):
            v = list(w)
            for _ in range(edits):
                p = rng.randrange(len(v))
                v[p:p + rng.choice((0, 1, 2))] = other(rng.choice((0, 1, 1)))
            rows.append((1000 + 10 * i + edits % 10, " ".join(other(rng.randint(0, 30)) + v + other(rng.randint(0, 30)))))
        rows.append((2000 + i, " ".join(w[:len(w) // 2])))
        rows.append((3000 + i, " ".join(w + other(rng.randint(0, 9)) + w)))
        parts = [w[a:a + 5] for a in range(0, max(1, len(w) - 4), 2)]
        rows.append((4000 + i, " ".join(x for part in reversed(parts) for x in part)))
    return rows


def test_labels_and_score_match_brute_force(spark):
    rows = license_variants()
    got = sorted(((r.doc_id, r.labels, round(r.score, 9)) for r in license_scan.report(frame(spark, rows)).collect()), key=str)
    want = sorted(((d, labels, round(score, 9)) for d, t in rows for labels, score in [brute_labels(t)]), key=str)
    assert got == want


def test_words_in_another_order_give_no_label(spark):
    """The fragments of a license, written backwards, are not that license."""
    rows = [(i, t) for i, t in license_variants() if i is not None and i >= 4000 and len(license_scan.TEXTS[i - 4000][1].split()) > 12]
    assert {r.labels for r in license_scan.report(frame(spark, rows)).collect()} <= {"", "gpl", "apache", "mit"}
    long = {r.label for r in license_scan.scan(frame(spark, rows)).where("NOT base AND n_words > 8").collect()}
    assert long == set()


def test_spans_are_no_longer_than_their_template_and_the_band(spark):
    rows = license_variants()
    sizes = {}
    for i, (_, text) in enumerate(license_scan.TEXTS):
        sizes[len(license_scan.PHRASES) + i] = len(words(text))
    found = license_scan.scan(frame(spark, rows)).where("NOT base").collect()
    assert found and all(r.n_words <= sizes[r.template] + 2 * license_scan.DRIFT for r in found)
    spans = {}
    for r in found:
        spans.setdefault((r.text_key, r.template), []).append((r.start, r.start + r.n_words))
    for own in spans.values():
        own.sort()
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))


def test_weighted_similarity_of_repeated_values(spark):
    rng = random.Random(17)
    pairs = [([rng.randrange(6) for _ in range(rng.randint(0, 12))], [rng.randrange(6) for _ in range(rng.randint(1, 12))])
             for _ in range(200)] + [([1], [1]), ([1, 1, 1], [1, 1]), ([], [2])]
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    for r in df.withColumn("s", decontaminate.similarity(F.col("a"), F.col("b"))).collect():
        a, b = Counter(r["a"]), Counter(r["b"])
        assert r["s"] == sum((a & b).values()) / sum((a | b).values())
