"""SimHash near-duplicates by Golay-code fuzzy hashing.

Every text gets a 64-bit SimHash of its word shingles. Two texts are linked
if their fingerprints differ in at most ``max_bits`` bits; near-duplicate
groups are the components of these links.

Search. The 64 bits are cut into s = max(3, max_bits + 1) segments. The binary
Golay code [23, 12] is perfect: each word of up to 23 bits decodes to exactly
one codeword. A segment's *home* key is its codeword index; its *near* keys
are the indices of all words within one bit of it (one or six different ones).
If segments of a and b differ in at most one bit, a's home key is among b's
near keys. Every fingerprint is filed, for each segment e, under (e exact,
home of the next segment), and looks under (e exact, near of the next one).
This meets every linked pair: with d < s bit errors, let z segments have none
and h have two or more; then 2h + (s - z - h) <= d < s, so z > h, and of the z
different segments that follow an error-free one at least one is not among
the h. Each meeting is verified by the exact bit distance.

Groups. Equal fingerprints are one node. In every bucket the members are first
verified against one pivot, and the components of those links labelled; then
only members of *different* components of a bucket are compared, so a
bucket full of copies never emits its pairs, and no link between different
components is lost.
"""

from __future__ import annotations

from itertools import accumulate, combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import by_key, column, cut, free_name, small_batches

SEED = 42
# Fixed value: generator polynomial of the binary Golay code,
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
BLOCK = 1 << 16                                   # shingles per counting block


# ---- fingerprints ---------------------------------------------------------

def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of ``text``: a bit is set if it is set in over half of
    the XXH64 values of the word shingles (repeats included). Only A-Z is
    lower-cased, words end at ASCII white space; fewer words than ``shingle``
    are one shingle; no words (or null) give 0. Counting goes block by block,
    so memory does not grow with the text beyond its words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = max(1, len(words) - shingle + 1)
    ends = starts[shingle:] if len(words) >= shingle else [len(flat) + 1]
    counts = np.zeros(64, np.int64)
    for a in range(0, n, BLOCK):
        part = [flat[s:e - 1] for s, e in zip(starts[a:min(n, a + BLOCK)], ends[a:a + BLOCK])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = np.packbits(counts * 2 > n, bitorder="little")
    return int(ones.view(np.uint64)[0])


def fingerprint_column(text, shingle: int):
    """Column of fingerprints as signed 64-bit integers."""
    @F.pandas_udf(T.LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        marks = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return pd.Series(marks.view(np.int64))

    return simhash(text)


# ---- Golay keys -------------------------------------------------------------

def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GOLAY << (bit - 11)
    return word


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits of a word, and the error
    pattern of weight <= 3 that each of the 2,048 syndromes stands for."""
    single = [_remainder(1 << i) for i in range(23)]

    def syndromes(first, bits):
        out = np.zeros(1 << bits, np.int32)
        for i in range(bits):
            out[1 << i:2 << i] = out[:1 << i] ^ single[first + i]
        return out

    leader = np.zeros(2048, np.int32)
    for weight in range(4):
        for at in combinations(range(23), weight):
            s = 0
            for i in at:
                s ^= single[i]
            leader[s] = sum(1 << i for i in at)
    return syndromes(0, 12), syndromes(12, 11), leader


def decode(words: np.ndarray, tables) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    low, high, leader = tables
    return (words ^ leader[low[words & 4095] ^ high[words >> 12]]) >> 11


def segments(count: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``count`` segments that cover the 64 bits."""
    edges = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def bucket_rows(marks: DataFrame, max_bits: int) -> DataFrame:
    """(key, mark, probe): the buckets each mark is filed under (probe =
    false) and looks into (probe = true)."""
    parts = segments(max(3, max_bits + 1))

    def keys(batches):
        tables = golay_tables()
        for pdf in batches:
            own = pdf["mark"].to_numpy(np.int64)
            row = np.arange(len(own))[:, None] << 12
            cut_up = [((own.view(np.uint64) >> np.uint64(a)) & np.uint64((1 << w) - 1)).astype(np.int64)
                      for a, w in parts]
            for e, exact in enumerate(cut_up):
                nxt = (e + 1) % len(parts)
                flips = np.array([0] + [1 << i for i in range(parts[nxt][1])], np.int64)
                home = decode(cut_up[nxt], tables).astype(np.int64)
                near = np.unique(row | decode(cut_up[nxt][:, None] ^ flips, tables))
                prefix = (e << 35) | (exact << 12)
                yield pd.DataFrame({"key": prefix | home, "mark": own, "probe": False})
                yield pd.DataFrame({"key": prefix[near >> 12] | (near & 4095),
                                    "mark": own[near >> 12], "probe": True})

    return marks.mapInPandas(keys, "key long, mark long, probe boolean")


# ---- links and groups -------------------------------------------------------

def _apart(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def mark_components(marks: DataFrame, max_bits: int) -> DataFrame:
    """(mark, component) for every mark linked to a different one; ``marks``
    has distinct non-null 64-bit integers in column ``mark``."""
    if not 0 <= max_bits <= 15:
        raise ValueError("max_bits must be 0 to 15: beyond, a segment has under four bits")
    if max_bits == 0:
        return marks.select("mark", F.col("mark").alias("component")).limit(0)
    rows = bucket_rows(marks, max_bits)
    shared = (rows.groupBy("key")
                  .agg(F.min("mark").alias("lo"), F.max("mark").alias("hi"),
                       F.min(F.when(~F.col("probe"), F.col("mark"))).alias("pivot"))
                  .where((F.col("lo") != F.col("hi")) & F.col("pivot").isNotNull())
                  .select("key", "pivot"))
    rows = cut(rows.join(by_key(shared), "key"), "simhash-buckets")
    star = (rows.where(_apart(F.col("mark"), F.col("pivot")).between(1, max_bits))
                .select(F.col("mark").alias("u"), F.col("pivot").alias("v")).distinct())
    first = components(star, "simhash-star")
    rows = (rows.join(by_key(first), rows["mark"] == first["node"], "left")
                .select("key", "mark", "probe", F.coalesce("component", "mark").alias("c")))
    mixed = (rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                 .where(F.col("lo") != F.col("hi")).select("key"))
    rows = cut(rows.join(by_key(mixed), "key"), "simhash-mixed")
    filed = rows.where(~F.col("probe")).select("key", F.col("mark").alias("a"), F.col("c").alias("ca"))
    probe = rows.where("probe").select("key", F.col("mark").alias("b"), F.col("c").alias("cb"))
    cross = (filed.join(by_key(probe), (filed["key"] == probe["key"]) & (F.col("a") < F.col("b"))
                        & (F.col("ca") != F.col("cb"))
                        & (_apart(F.col("a"), F.col("b")) <= max_bits))
                  .select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    known = first.select(F.col("node").alias("u"), F.col("component").alias("v"))
    return (components(known.unionByName(cross), "simhash-links")
            .select(F.col("node").alias("mark"), "component"))


def near_duplicates(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 lowercase hex
    digits) and component_id, the smallest doc_id of its near-duplicate group.

    Null and empty texts have fingerprint zero and are linked like any other;
    a repeated doc_id is returned once per row; a null doc_id is passed over
    when the smallest is taken (component_id is null only if the whole group
    has none). Other columns are ignored; an empty table gives no rows."""
    small_batches(docs.sparkSession)
    marked = cut(docs.select(column(docs, id_col).alias("doc_id"),
                             fingerprint_column(column(docs, text_col), shingle).alias("mark")),
                 "simhash-marks")
    return _labelled(marked, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def _groups(marked: DataFrame, max_bits: int) -> DataFrame:
    """(mark, group, first): group of every distinct mark of ``marked``
    (doc_id, mark) and the smallest doc_id under that mark."""
    nodes = cut(marked.groupBy("mark").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    found = mark_components(nodes.select("mark"), max_bits)
    return nodes.join(by_key(found), "mark", "left").select(
        "mark", F.coalesce("component", "mark").alias("group"), "first")


def _labelled(marked: DataFrame, max_bits: int) -> DataFrame:
    groups = cut(_groups(marked, max_bits), "simhash-groups")
    lowest = groups.groupBy("group").agg(F.min("first").alias("component_id"))
    ids = groups.join(by_key(lowest), "group").select("mark", "component_id")
    return marked.join(by_key(ids), "mark")


def keep_one(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each near-duplicate group the row with
    the smallest doc_id (ties: smallest fingerprint; rows that repeat both are
    one document, one of them stays). Rows without a doc_id stay only if
    their whole group has none. All columns of ``docs`` are kept."""
    small_batches(docs.sparkSession)
    mark = free_name(docs, "_mark")
    marked = cut(docs.withColumn(mark, fingerprint_column(column(docs, text_col), shingle)),
                 "simhash-documents")
    thin = marked.select(column(marked, id_col).alias("doc_id"), F.col(mark).alias("mark"))
    groups = _groups(thin, max_bits)
    kept = (groups.groupBy("group")
                  .agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "mark")).alias("k"))
                  .select(F.col("k.mark").alias("_k_mark"), F.col("k.first").alias("_k_id")))
    rows = marked.join(by_key(kept), (marked[mark] == kept["_k_mark"])
                       & column(marked, id_col).eqNullSafe(kept["_k_id"]), "left_semi")
    return rows.dropDuplicates([id_col, mark]).drop(mark)
