"""Benchmark decontamination by SimHash windows of an item's size.

1. *Windows.* A window as long as an item can only be similar to it if it shares
   enough word shingles, in whatever order. All shingle hashes of all texts are
   joined with those of the items; of every text and item, all item-sized
   windows that hold as many hits as the threshold needs are looked at.
2. *Fingerprints.* Window and item get a 64-bit SimHash of their shingles.
   The 64 bits are cut into eight blocks: fingerprints within RADIUS = 23
   bits agree to within two bits in some block (eight blocks with three
   errors each make 24). Items are filed under every block value within two
   bits, windows under their own, and the join on (item, block, value)
   finds all within the radius, whatever the bits.
3. *Verification.* Exact weighted-shingle similarity: the sum over shingles of
   the smaller number of occurrences, over that of the larger.

At a similarity of 0.8 two fingerprints differ in about ten bits, so a radius
of 23 lets practically nothing slip. Everything is DataFrame functions.
Equal texts are scanned once and joined back at the end.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.joins import checked_broadcast

from .grams import with_grams, words
from .shared import column, cut

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 8                   # of 8 bits
FLIPS = 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
MASKS = [sum(1 << i for i in at) for n in range(FLIPS + 1) for at in combinations(range(8), n)]


def simhash(hashes: Column) -> Column:
    """64-bit majority of an array of hashes; 0 for an empty one."""
    def bit(i):
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, F.lit(i)).cast("int"))
        return F.when(ones * 2 > F.size(hashes), F.lit(1 << i if i < 63 else -(1 << 63))).otherwise(F.lit(0).cast("long"))

    out = bit(0)
    for i in range(1, 64):
        out = out.bitwiseOR(bit(i))
    return out


def _block(mark: Column, i: int) -> Column:
    return F.shiftrightunsigned(mark, 8 * i).bitwiseAND(F.lit(255)).cast("int")


def _repeated(values: Column) -> Column:
    """The values that an array holds more than once."""
    ordered = F.array_sort(values)
    after = F.slice(ordered, F.lit(2), F.greatest(F.size(ordered) - 1, F.lit(0)))
    return F.array_distinct(F.filter(F.zip_with(ordered, after, lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull()))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays, each value weighted by its
    number of occurrences. Shared values count once by a set operation; only
    those that both arrays repeat are counted one by one."""
    def count(arr, v):
        return F.size(F.filter(arr, lambda x: x == v))

    again = F.aggregate(F.array_intersect(_repeated(a), _repeated(b)), F.lit(0),
                        lambda n, v: n + F.least(count(a, v), count(b, v)) - 1)
    shared = F.size(F.array_intersect(a, b)) + again
    return shared.cast("double") / (F.size(a) + F.size(b) - shared).cast("double")


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, k, n_words, grams): shingle length is five, or all words of a
    shorter item; items without a word are left out."""
    w = items.select(column(items, id_col).alias("item_id"), words(column(items, text_col)).alias("w"))
    w = w.where((F.size("w") > 0) & F.col("item_id").isNotNull()).distinct()
    out = None
    for k in range(1, SHINGLE + 1):
        own = w.where(F.size("w") >= k if k == SHINGLE else F.size("w") == k)
        own = with_grams(own, k, "grams").select("item_id", F.lit(k).alias("k"), F.size("w").alias("n_words"), "grams")
        out = own if out is None else out.unionByName(own)
    return out


def _starts(hits: DataFrame, threshold: float) -> DataFrame:
    """(text_key, item_id, k, n_words, n_text, s): the starts of all item-sized
    windows that can reach the threshold; before 0 or past the last whole
    window they are cut short by the text's ends.

    Of N shingles, a whole window needs 2 t N / (1 + t) hits and one cut short
    t N. A window of c hits whose first is the i-th starts after hit i - 1 and
    no later than hit i, and reaches hit i + c - 1: each is made once."""
    n = F.col("n_words") - F.col("k") + 1

    def need(share):
        return F.greatest(F.lit(1), F.ceil(n * F.lit(share) - F.lit(1e-9)).cast("int"))

    keys = ["text_key", "item_id", "k", "n_words", "n_text"]
    rows = (hits.groupBy(*keys).agg(F.sort_array(F.collect_set("pos")).alias("hit"))
                .withColumn("whole", need(2 * threshold / (1 + threshold))).withColumn("short", need(threshold))
                .where(F.size("hit") >= F.col("short")))
    rows = cut(rows.withColumn("before", F.concat(F.array(F.lit(-(1 << 30))), F.col("hit"))), "decontaminate-places")
    last = F.col("n_text") - F.col("n_words")

    def part(c, low, high):
        many = F.greatest(F.lit(0), F.size("hit") - c + 1)
        spans = F.arrays_zip(F.slice("hit", F.lit(1), many).alias("i"), F.slice("hit", c, many).alias("j"),
                             F.slice("before", F.lit(1), many).alias("h"))
        each = rows.select(*keys, F.explode(spans).alias("x"))
        each = each.select(*keys, F.greatest(F.col("x.h") + 1, F.col("x.j") - n + 1, low).alias("lo"),
                           F.least(F.col("x.i"), high).alias("hi"))
        return each.where("lo <= hi").select(*keys, F.explode(F.sequence("lo", "hi")).alias("s"))

    none = F.lit(1 << 30)
    return (part(F.col("whole"), F.lit(0), last).unionByName(part(F.col("short"), F.lit(-(1 << 30)), F.lit(-1)))
            .unionByName(part(F.col("short"), F.greatest(F.lit(0), last + 1), none)))


def matches(docs: DataFrame, items: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id",
            text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
            keep_key: bool = False) -> DataFrame:
    """One row per text and item it holds to ``threshold`` or more: doc_id,
    item_id, similarity, bits (fingerprint distance), start_word (of the most
    similar window; of equals one with a shingle at the item's place goes first,
    then the first) and n_words (of the window).

    Null and empty texts hold nothing; an item of fewer than five words is
    one shingle; an item_id with several texts counts each; rows repeating a
    doc_id and item give one row; null doc_ids are kept as null, null item_ids
    left out; empty tables give no rows. Other columns are ignored. With
    ``keep_key`` the hash of the text stands in column ``text_key`` in place of
    doc_id, once per text."""
    ready = cut(_items(items, item_id_col, item_text_col), "decontaminate-items")
    ks = [r["k"] for r in ready.select("k").distinct().collect()]       # at most five numbers
    text = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    text = text.withColumn("text_key", F.xxhash64("text"))
    split = text.where(F.col("text").isNotNull()).select("text_key", words(F.col("text")).alias("w"))
    sized = split.withColumn("n_text", F.size("w"))

    # posexplode_outer: for posexplode the optimiser would add a filter on the
    # array's size and compute all grams again in it. The join drops the nulls.
    hits = None
    for k in ks:
        own = ready.where(F.col("k") == k).select("item_id", "n_words", F.posexplode("grams").alias("at", "gram"))
        side = checked_broadcast(cut(own, "decontaminate-shingles"), name="item shingles", persist=False)
        grams = with_grams(sized, k, "g").select("text_key", "n_text", F.posexplode_outer("g").alias("pos", "gram"))
        found = grams.join(side, "gram").select(
            "text_key", "item_id", "n_words", F.lit(k).alias("k"), "n_text", "pos", (F.col("pos") - F.col("at")).alias("s"))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return _result(docs, None, id_col, keep_key)
    hits = cut(hits.distinct(), "decontaminate-hits")
    anchors = hits.select("text_key", "item_id", "k", "n_words", "s", F.lit(1).alias("anchored")).distinct()
    starts = cut(_starts(hits, threshold).join(anchors, ["text_key", "item_id", "k", "n_words", "s"], "left"),
                 "decontaminate-starts")

    some = split.join(starts.select("text_key").distinct(), "text_key", "left_semi")
    texts = some.groupBy("text_key").agg(F.first("w").alias("w"))
    first = F.greatest(F.lit(0), F.col("s"))
    places = (starts.select("text_key", "item_id", "k", first.alias("start"), F.coalesce("anchored", F.lit(0)).alias("anchored"),
                            (F.least(F.col("n_text"), F.col("s") + F.col("n_words")) - first).alias("n_words"))
                    .groupBy("text_key", "item_id", "k", "start", "n_words").agg(F.max("anchored").alias("anchored")))
    windows = places.join(texts, "text_key").withColumn("win", F.slice("w", F.col("start") + 1, F.col("n_words"))).drop("w")
    parts = [with_grams(windows.where((F.col("k") == k) & (F.size("win") >= k)), k, "grams", "win").select(
        "text_key", "item_id", "start", "n_words", "anchored", "grams") for k in ks]
    grams = parts[0]
    for x in parts[1:]:
        grams = grams.unionByName(x)
    marked = cut(grams.withColumn("mark", simhash(F.col("grams"))), "decontaminate-windows")

    item_marks = cut(ready.select("item_id", F.col("grams").alias("item_grams"),
                                  simhash(F.col("grams")).alias("item_mark")), "decontaminate-marks")
    masks = F.array(*[F.lit(m) for m in MASKS])

    def near_values(i):
        return F.transform(masks, lambda m: _block(F.col("item_mark"), i).bitwiseXOR(m))

    filed = item_marks.select("item_id", "item_mark", F.posexplode(
        F.array(*[near_values(i) for i in range(BLOCKS)])).alias("block", "values")).select(
        "item_id", "item_mark", "block", F.explode("values").alias("value"))
    looked = marked.select("text_key", "item_id", "start", "n_words", "mark", F.posexplode(
        F.array(*[_block(F.col("mark"), i) for i in range(BLOCKS)])).alias("block", "value"))
    near = (looked.join(filed, ["item_id", "block", "value"])
                  .withColumn("bits", F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark"))))
                  .where(F.col("bits") <= RADIUS)
                  .select("text_key", "item_id", "start", "n_words", "mark", "item_mark", "bits").distinct())
    exact = (near.join(marked.select("text_key", "item_id", "start", "n_words", "anchored", "grams"),
                       ["text_key", "item_id", "start", "n_words"])
                 .join(item_marks, ["item_id", "item_mark"])
                 .withColumn("similarity", similarity(F.col("grams"), F.col("item_grams")))
                 .where(F.col("similarity") >= threshold))
    best = exact.groupBy("text_key", "item_id").agg(F.max(F.struct(
        "similarity", "anchored", (-F.col("start")).alias("s"), "n_words", (-F.col("bits")).alias("b"))).alias("m"))
    found = best.select("text_key", "item_id", F.col("m.similarity").alias("similarity"), (-F.col("m.b")).alias("bits"),
                        (-F.col("m.s")).cast("long").alias("start_word"), F.col("m.n_words").cast("long").alias("n_words"))
    return _result(text, cut(found, "decontaminate-matches"), "doc_id", keep_key)


def _result(text: DataFrame, found: DataFrame | None, id_col: str, keep_key: bool) -> DataFrame:
    if found is None:
        spark = text.sparkSession
        found = spark.createDataFrame([], "text_key long, item_id long, similarity double, bits int, "
                                          "start_word long, n_words long")
        text = text.select(column(text, id_col).alias("doc_id"), F.lit(0).cast("long").alias("text_key"))
    if keep_key:
        return found
    return (text.select("doc_id", "text_key").join(found, "text_key").drop("text_key")
                .groupBy("doc_id", "item_id").agg(F.max(F.struct(
                    "similarity", (-F.col("start_word")).alias("s"), "n_words", "bits")).alias("m"))
                .select("doc_id", "item_id", "m.similarity", "m.bits", (-F.col("m.s")).alias("start_word"), "m.n_words"))


def clean(docs: DataFrame, items: DataFrame, threshold: float = SIMILARITY, text_col: str = "text",
          id_col: str = "doc_id", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns.
    Rows with a null text stay."""
    found = matches(docs, items, threshold, id_col, text_col, item_id_col, item_text_col, keep_key=True)
    bad = found.select(F.col("text_key").alias("_bad_key")).distinct()
    return docs.join(bad, F.xxhash64(column(docs, text_col)) == bad["_bad_key"], "left_anti")
