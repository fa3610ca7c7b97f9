"""Language identification by nearest centroid.

A text becomes a normalised TF-IDF vector of character 1-, 2- and 3-grams
within words (a word's ends count as characters). Every language has several
centroids from spherical k-means over its training vectors; a text gets the
language of the centroid with the largest cosine. A text that is much farther
from the nearest centroid than that language's training texts usually are is
rejected: below REJECT_SHARE of their similarity (the USUAL quantile), less for
texts of under FULL n-grams, whose vectors are sparse (by the square root of
their share of FULL).

Training uses a bounded sample of labelled rows (``per_language`` expected
rows of each language, chosen by a hash of the id), at most ``letters``
letters and ``grams`` n-grams; prediction reads every whole text, block by
block.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.joins import checked_broadcast

from .shared import column, cut, free_name, small_batches

PER_LANGUAGE = 500        # bound: expected training texts of each language
LETTERS = 4000            # bound: letters told apart (12 bits); others share one sign
GRAMS = 12_000            # bound: n-grams kept, by document frequency
CLUSTERS = 4
ROUNDS = 12
SLOTS = 20                # n-gram table of 2**SLOTS entries
BLOCK = 1 << 20           # characters vectorised at a time
REJECT_SHARE = 0.5        # rejected below this share of the usual similarity
USUAL = 0.01              # quantile of the training similarities
FULL = 500                # n-grams of a text from which the whole floor holds
UNKNOWN = "und"


def is_letter(text: str) -> bool:
    """True if the text has a letter (Unicode category L)."""
    return any(map(str.isalpha, text))


# ---- vectors --------------------------------------------------------------

@dataclass
class Vectoriser:
    """Turns texts into sparse TF-IDF vectors; rebuilt in each worker from the
    plain arrays of ``parts`` (letters, gram codes, idf)."""
    letters: np.ndarray            # code points told apart
    codes: np.ndarray              # code of each n-gram
    idf: np.ndarray

    def __post_init__(self):
        self.signs = sign_table(self.letters)
        self.slots = np.full(1 << SLOTS, -1, np.int32)
        spots = _slot(self.codes)
        self.slots[spots[::-1]] = np.arange(len(self.codes), dtype=np.int32)[::-1]
        self.rarest = float(self.idf.max()) if len(self.idf) else 1.0

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """Occurrences of every kept n-gram, and of all others."""
        total, others = np.zeros(len(self.codes), np.int64), 0
        for codes in gram_blocks(text, self.signs):
            at = self.slots[_slot(codes)]
            known = (at >= 0) & (self.codes[at] == codes) if len(self.codes) else np.zeros(len(at), bool)
            total += np.bincount(at[known], minlength=len(total))
            others += int(len(codes) - known.sum())
        return total, others

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """(n-gram indices, weights, n-grams in the text); the weights have
        length one, other n-grams count towards it as the rarest kept one."""
        total, others = self.counts(text.lower())
        at = np.flatnonzero(total)
        w = (1 + np.log(total[at])) * self.idf[at]
        length = np.sqrt((w * w).sum() + others * self.rarest ** 2)
        return at, (w / length if length else w), int(total.sum()) + others


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).astype(np.int64)


_SIGNS: dict[bytes, np.ndarray] = {}


def sign_table(letters: np.ndarray) -> np.ndarray:
    """Sign of every code point: 0 outside words, 1 for letters and marks not
    told apart, from 2 on for ``letters``."""
    key = letters.tobytes()
    if key not in _SIGNS:
        _SIGNS.clear()
        table = np.zeros(0x110000, np.int16)
        inside = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] in "LM"]
        table[inside] = 1
        table[letters] = np.arange(2, 2 + len(letters))
        _SIGNS[key] = table
    return _SIGNS[key]


def gram_blocks(lowered: str, signs: np.ndarray):
    """Codes of all 1-, 2- and 3-grams of a lower-cased text, block by block.
    Runs of characters outside words count as one boundary sign 0; no n-gram
    crosses a boundary."""
    tail = np.zeros(1, np.int64)
    for a in range(0, len(lowered) + 1, BLOCK):
        part = lowered[a:a + BLOCK]
        if a + BLOCK > len(lowered):
            part += " "
        x = signs[np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
        x = x[(x != 0) | (np.concatenate([tail[-1:], x[:-1]]) != 0)]
        x, old = np.concatenate([tail, x]), len(tail)
        one = x[old:]
        two = (x[old - 1:-1] << 12 | one) + (1 << 40)
        three = np.zeros(0, np.int64)
        if len(x) > 2:
            first = max(old, 2)
            mid = x[first - 1:-1]
            three = ((x[first - 2:-2] << 24 | mid << 12 | x[first:]) + (2 << 40))[mid != 0]
        yield np.concatenate([one[one != 0], two, three])
        tail = x[-2:]


# ---- training ---------------------------------------------------------------

def sample_training(docs: DataFrame, learn: Column, per_language: int, id_col: str, text_col: str,
                    lang_col: str) -> DataFrame:
    """(lang, text) of about ``per_language`` rows of each language among the
    rows where ``learn`` holds, text and language not null. Which rows depends
    on a hash of the id alone."""
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, lang_col).alias("lang"),
                       column(docs, text_col).alias("text"), learn.alias("learn"))
    rows = rows.where("learn AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    spot = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1_000_003))
    sizes = checked_broadcast(sizes, name="language sizes", persist=False)     # a row per language
    return (rows.join(sizes, "lang")
                .where(spot < F.lit(per_language) * 1_000_003 / F.col("n"))
                .select("lang", "text"))


def _top(rows: DataFrame, limit: int) -> list:
    return (rows.groupBy("item").agg(F.sum("n").alias("n"))
                .orderBy(F.desc("n"), "item").limit(limit).collect())


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; rows of ``x`` have length
    one (or zero). Ties go to the first row or cluster."""
    mean = x.mean(axis=0)
    seeds = [int(np.argmax(x @ mean))]
    near = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds].copy()
    for _ in range(ROUNDS):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            total = x[own == j].sum(axis=0)
            size = np.linalg.norm(total)
            if size:
                c[j] = total / size
    return c


@dataclass
class Model:
    letters: np.ndarray
    codes: np.ndarray
    idf: np.ndarray
    languages: list[str]           # language of each centroid
    centroids: np.ndarray          # centroid by n-gram
    floors: np.ndarray             # least accepted similarity, by centroid


def train(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, letters: int = LETTERS,
          grams: int = GRAMS, clusters: int = CLUSTERS, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    """Model from a bounded sample of the rows where ``learn`` holds."""
    small_batches(docs.sparkSession)
    sample = cut(sample_training(docs, learn, per_language, id_col, text_col, lang_col), "language-sample")

    def letter_counts(batches):
        for pdf in batches:
            seen = Counter(c for t in pdf["text"] for c in t.lower() if c.isalpha())
            yield pd.DataFrame({"item": [ord(c) for c in seen], "n": list(seen.values())})

    known = np.array([r["item"] for r in _top(sample.select("text").mapInPandas(
        letter_counts, "item long, n long"), letters)], np.int64)

    def gram_counts(batches):
        signs = sign_table(known)
        for pdf in batches:
            own = [np.unique(np.concatenate(list(gram_blocks(t.lower(), signs)))) for t in pdf["text"]]
            item, n = np.unique(np.concatenate(own), return_counts=True)
            yield pd.DataFrame({"item": item, "n": n})

    size = sample.count()
    top = _top(sample.select("text").mapInPandas(gram_counts, "item long, n long"), grams)
    codes = np.array([r["item"] for r in top], np.int64)
    idf = np.log((1 + size) / (1 + np.array([r["n"] for r in top], np.float64))) + 1

    def fit(key, pdf):
        make = Vectoriser(known, codes, idf)
        x = np.zeros((len(pdf), len(codes)), np.float32)
        for i, t in enumerate(sorted(pdf["text"])):
            at, w, _ = make.vector(t)
            x[i, at] = w
        c = _clusters(x, clusters)
        floor = float(np.quantile((x @ c.T).max(axis=1), USUAL)) * REJECT_SHARE
        return pd.DataFrame({"lang": key[0], "cluster": range(len(c)), "floor": floor,
                             "centroid": list(c)})

    rows = (sample.groupBy("lang").applyInPandas(fit, "lang string, cluster int, floor double, "
                                                      "centroid array<float>")
                  .orderBy("lang", "cluster").collect())
    return Model(known, codes, idf, [r["lang"] for r in rows],
                 np.array([r["centroid"] for r in rows], np.float32).reshape(len(rows), len(codes)),
                 np.array([r["floor"] for r in rows]))


# ---- prediction -------------------------------------------------------------

KIND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                     T.StructField("rejected", T.BooleanType())])


def predict_texts(model: Model, make: Vectoriser, texts) -> pd.DataFrame:
    rows = []
    for t in texts:
        if not t or not is_letter(t) or not model.languages:
            rows.append((UNKNOWN, 0.0, True))
            continue
        at, w, n = make.vector(t)
        near = model.centroids[:, at] @ w
        best = int(np.argmax(near))
        score = min(1.0, max(0.0, float(near[best])))
        floor = model.floors[best] * min(1.0, (n / FULL) ** 0.5)
        rows.append((model.languages[best], score, score <= 0 or score < floor))
    return pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"])


def prediction(model: Model, text: Column) -> Column:
    """Struct column (lang_pred, score, rejected). The model's arrays are of
    bounded size and travel with the function."""
    make: list[Vectoriser] = []

    @F.pandas_udf(KIND)
    def nearest_centroid(texts: pd.Series) -> pd.DataFrame:
        if not make:
            make.append(Vectoriser(model.letters, model.codes, model.idf))
        return predict_texts(model, make[0], texts)

    return nearest_centroid(text)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the columns ``keep``, lang_pred,
    score (cosine with the nearest centroid, 0 to 1) and rejected.

    Null texts and texts without a letter are ``und`` with score 0, and
    rejected; so is everything if there was nothing to learn from. Equal
    cosines go to the smaller language name. Other columns are not read."""
    small_batches(docs.sparkSession)
    return (docs.select(column(docs, id_col).alias("doc_id"), *keep,
                        prediction(model, column(docs, text_col)).alias("_p"))
                .select("doc_id", *_names(docs, keep), "_p.*"))


def _names(docs: DataFrame, keep: tuple[Column, ...]) -> list[str]:
    return [f"`{n}`" for n in docs.select(*keep).columns] if keep else []


def accept(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    small_batches(docs.sparkSession)
    name = free_name(docs, "_language")
    return (docs.withColumn(name, prediction(model, column(docs, text_col)))
                .where(~F.col(name)["rejected"]).drop(name))


def learn_rule(doc_id: Column) -> tuple[Column, Column]:
    """(held_out, learn): a row is held out if crc32 of its id as text leaves
    2 modulo 4; rows without an id are neither."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False)), F.coalesce(rest != 2, F.lit(False))
