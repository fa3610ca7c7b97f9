"""License scans by diagonal voting.

All rolling word k-gram hashes of all texts are joined with the k-gram
positions of the license templates. A hit at text position p and template
position t votes for the diagonal p - t, on which the whole template would
start. Votes are added up per (text, template, diagonal), and neighbouring
diagonals (words inserted or left out) merged: into bands of 2 * DRIFT
diagonals, on two grids half a band apart, so that any DRIFT neighbours are in
one band. A span is thus never longer than its template by more than the band.

Spans with enough votes are verified on the words themselves, in order: a
phrase must stand there word for word; a longer template at a word edit
distance that leaves COVERAGE of it (a span of the same words in another order
does not); and the words that tell neighbouring licenses (GPL, LGPL, AGPL) apart
must be its own. Of overlapping spans of a template the best stays.

Everything is DataFrame functions. Texts are split once: every text also gives
one row with its number of words, beside its hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.operators.joins import checked_broadcast

from .grams import with_grams, words
from .shared import column, cut

PHRASE_K, TEXT_K = 2, 4
COVERAGE = 0.6               # share of a template that a span must hold, in order
VOTES = 0.25                 # share of a template's k-grams that a span must have to be looked at
DRIFT = 8                    # diagonals this near belong to one span
MARK = -0x6C6963656E736573   # stands for a k-gram in the row that counts a text's words
# A character for each distinct word of a template; the first is for all others.
LETTERS = "".join(chr(0x4E00 + i) for i in range(4000))

# The GNU notices differ in these words only, far less than COVERAGE asks for.
OTHER_GNU = r" (lesser|affero|lgpl|agpl|library general) "
PLAIN_GPL = r"(?<! lesser| library| affero) general public | gpl "
LESSER_GPL = r" (lesser|lgpl|library general) "
AFFERO_GPL = r" (affero|agpl) "

# The phrases of the base report and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Sentences of public licenses and notices, and their labels.
TEXTS = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the "
               "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("all-rights-reserved", "all rights reserved"),
    # Whole license texts and notices.
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS
        OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
        OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
        CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
        DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
        STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
        PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    *((label, f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        {name} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}
        for more details.""") for label, name in (
            ("gpl", "General Public License"), ("lgpl", "Lesser General Public License"),
            ("agpl", "Affero General Public License"))),
)


def templates(spark: SparkSession, phrases=PHRASES, texts=TEXTS) -> DataFrame:
    """(template, label, base, k, w, n_grams, at, gram): one row per k-gram
    position. Short texts are matched as phrases are. Bounded by the templates;
    a template may have as many distinct words as LETTERS has characters."""
    rows = [(i, label, True, text) for i, (text, label) in enumerate(phrases)]
    rows += [(len(rows) + i, label, False, text) for i, (label, text) in enumerate(texts)]
    quoted = ", ".join("({}, {}, {}, {})".format(
        i, _literal(label), str(base).lower(), _literal(text)) for i, label, base, text in rows)
    t = spark.sql(f"SELECT * FROM VALUES {quoted} AS t(template, label, base, text)")
    t = t.select("template", "label", "base", words(F.col("text")).alias("w"))
    short = F.col("base") | (F.size("w") < 2 * TEXT_K)
    parts = [with_grams(t.where(short if k == PHRASE_K else ~short), k, "g").select(
        "template", "label", "base", F.lit(k).alias("k"), "w", "g") for k in (PHRASE_K, TEXT_K)]
    both = parts[0].unionByName(parts[1])
    return both.select("template", "label", "base", "k", "w", F.size("g").alias("n_grams"),
                       F.posexplode("g").alias("at", "gram"))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _own_words(label: Column, win: Column) -> Column:
    """False for a span of the GPL's template that names only another GNU
    license, and for one of the LGPL's that does not name the LGPL."""
    text = F.concat(F.lit(" "), F.array_join(win, " "), F.lit(" "))
    return (F.when(label == "gpl", ~text.rlike(OTHER_GNU) | text.rlike(PLAIN_GPL))
             .when(label == "lgpl", text.rlike(LESSER_GPL))
             .when(label == "agpl", text.rlike(AFFERO_GPL)).otherwise(F.lit(True)))


def _spelt(sequence: Column, vocabulary: Column) -> Column:
    """Words as characters: the place of each in the vocabulary."""
    return F.array_join(F.transform(sequence, lambda x: F.substr(
        F.lit(LETTERS), (F.array_position(vocabulary, x) + 1).cast("int"), F.lit(1))), "")


def _in_order(win: Column, w: Column) -> Column:
    """Share of a template's words ``w`` that a span holds in order: one less
    the edit distance of the words over the template's length, at least 0."""
    vocabulary = F.array_distinct(w)
    distance = F.levenshtein(_spelt(win, vocabulary), _spelt(w, vocabulary))
    return F.greatest(F.lit(0.0), 1.0 - distance / F.size(w))


def _hits(docs: DataFrame, every: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """From one pass over the texts, the hits (doc_id, text_key, place, gram,
    template, at, ...) and one row per row of ``docs`` with its n_words, where
    template is null."""
    side = every.select("gram", "template", "k", "n_grams", "at")
    mark = docs.sparkSession.range(1).select(
        F.lit(MARK).alias("gram"), *[F.lit(None).cast(side.schema[c].dataType).alias(c) for c in side.columns[1:]])
    side = checked_broadcast(side.unionByName(mark), name="license templates", persist=False)
    text = F.coalesce(column(docs, text_col), F.lit(""))
    split = docs.select(column(docs, id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), words(text).alias("w"))
    # One array: all 2-grams, then all 4-grams, then the mark; the place tells which.
    both = with_grams(split, TEXT_K, "g")
    grams = both.select("doc_id", "text_key", F.size("w").alias("n_words"), F.size("g2").alias("n_short"),
                        F.posexplode_outer(F.concat("g2", "g", F.array(F.lit(MARK)))).alias("place", "gram"))
    hits = grams.join(side, "gram")
    return hits.where(F.col("template").isNull() | ((F.col("place") < F.col("n_short")) == (F.col("k") == PHRASE_K)))


def _spans(docs: DataFrame, hits: DataFrame, every: DataFrame, text_col: str) -> DataFrame:
    """Verified spans of the texts from their hits."""
    pos = F.when(F.col("k") == PHRASE_K, F.col("place")).otherwise(F.col("place") - F.col("n_short"))
    votes = (hits.where(F.col("template").isNotNull())
                 .select("text_key", "template", "k", "n_grams", "at", pos.alias("pos")).distinct()
                 .groupBy("text_key", "template", "k", "n_grams", (F.col("pos") - F.col("at")).alias("diagonal"))
                 .agg(F.count(F.lit(1)).alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi")))
    votes = cut(votes, "license-votes")
    # A phrase stands on one diagonal; a longer template on neighbouring ones.
    exact = votes.where((F.col("k") == PHRASE_K) & (F.col("votes") == F.col("n_grams"))).select(
        "text_key", "template", F.col("lo").alias("start"), (F.col("hi") + PHRASE_K).alias("end"))
    band = F.explode(F.array(*[F.floor((F.col("diagonal") + shift) / (2 * DRIFT)) * 2 + grid
                               for grid, shift in enumerate((0, DRIFT))])).alias("band")
    spans = (votes.where(F.col("k") == TEXT_K).select("*", band)
                  .groupBy("text_key", "template", "n_grams", "band")
                  .agg(F.sum("votes").alias("votes"), F.min("lo").alias("start"), F.max("hi").alias("hi"))
                  .where(F.col("votes") >= F.col("n_grams") * VOTES)
                  .select("text_key", "template", "start", (F.col("hi") + TEXT_K).alias("end")).distinct())
    found = cut(exact.unionByName(spans), "license-spans")

    text = docs.select(column(docs, text_col).alias("text")).where(F.col("text").isNotNull())
    some = text.select(F.xxhash64("text").alias("text_key"), "text").join(
        found.select("text_key").distinct(), "text_key", "left_semi")
    own = some.groupBy("text_key").agg(F.first("text").alias("text")).select("text_key", words(F.col("text")).alias("w"))
    info = checked_broadcast(every.select("template", "label", "base", "k", F.col("w").alias("t")).distinct(),
                             name="license texts", persist=False)
    rows = (found.join(own, "text_key")
                 .select("text_key", "template", "start", F.slice("w", F.col("start") + 1, F.col("end") - F.col("start")).alias("win"))
                 .join(info, "template"))
    coverage = F.when(F.col("k") == PHRASE_K, (F.col("win") == F.col("t")).cast("double")).otherwise(_in_order(F.col("win"), F.col("t")))
    good = (rows.withColumn("coverage", coverage).where(F.col("coverage") >= COVERAGE)
                .where((F.col("k") == PHRASE_K) | _own_words(F.col("label"), F.col("win")))
                .withColumn("n_words", F.size("win")))
    # Of a template's spans that overlap, the best stays, then the first.
    by_start = Window.partitionBy("text_key", "template").orderBy("start", "n_words")
    so_far = F.max(F.col("start") + F.col("n_words")).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    cluster = F.sum(F.when(F.col("start") < so_far, 0).otherwise(1)).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    best = F.row_number().over(Window.partitionBy("text_key", "template", "cluster")
                               .orderBy(F.desc("coverage"), "start", "n_words"))
    longer = (good.where(F.col("k") == TEXT_K).withColumn("cluster", cluster).withColumn("best", best)
                  .where("best = 1").drop("cluster", "best"))
    return (good.where(F.col("k") == PHRASE_K).unionByName(longer)
                .select("text_key", "template", "label", "base", "start", "n_words", "coverage"))


def _templates(spark: SparkSession, phrases, texts) -> DataFrame:
    return cut(templates(spark, phrases, texts), "license-templates")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, texts=TEXTS) -> DataFrame:
    """One row per verified span: text_key (hash of the text), template, label,
    base, start (first word), n_words (of the span) and coverage (0 to 1)."""
    every = _templates(docs.sparkSession, phrases, texts)
    return _spans(docs, cut(_hits(docs, every, id_col, text_col), "license-hits"), every, text_col)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, texts=TEXTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base (places of the base
    phrases), first_word and last_word (their smallest and largest start, or
    null), base_labels and labels (distinct, sorted, comma-joined) and score
    (largest coverage of a span, 0 without one).

    Null texts count as empty; repeated rows are returned each; other columns
    are ignored; an empty table gives no rows."""
    every = _templates(docs.sparkSession, phrases, texts)
    hits = cut(_hits(docs, every, id_col, text_col), "license-hits")
    found = cut(_spans(docs, hits, every, text_col), "license-found")
    base = F.col("base")
    names = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    per_text = found.groupBy("text_key").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"), names(F.when(base, F.col("label"))).alias("base_labels"),
        names(F.col("label")).alias("labels"), F.max("coverage").alias("score"))
    rows = hits.where(F.col("template").isNull()).select("doc_id", F.col("text_key").alias("key"), F.col("n_words").cast("long"))
    return rows.join(per_text, rows["key"] == per_text["text_key"], "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
