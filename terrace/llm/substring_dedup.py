"""Substring deduplication by paragraph MinHash banding.

Units. A *paragraph* is a line of at least five words, or a block: lines that
follow each other without a blank one, joined over their line ends. Because a
copied passage need be neither, every text also gives *passages*: runs of
PASSAGE_WORDS words that start where the hash of the next five words is the
smallest among ANCHOR_RANGE places in a row. Where two texts, or two places of
one text, share over PASSAGE_WORDS + ANCHOR_RANGE - 2 = 50 words, they share a
passage, wherever it stands and however lines are broken.

1. Units with the same words (two 64-bit hashes) are one class; copies never
   meet in pairs. Passages need no more: they are compared word for word.
2. Each paragraph gets a MinHash signature of its five-word shingles, cut into
   bands; the number and length of bands are tuned so that a pair at the
   threshold collides with the wanted recall. A block's signature is the
   smaller of its lines' and of the shingles that cross their ends.
3. Paragraphs that collide in a band are verified by exact Jaccard similarity:
   first every member of a bucket against one pivot. A bucket full of near
   copies thus never emits its pairs. Where a bucket still holds several
   groups, the members outside its largest group meet the others, and only what
   is similar leaves the join of a large bucket, where one-bit MinHash sketches
   rule out most pairs before their sets are compared.
4. Connected components of the links are the groups; in each the first
   occurrence stays and the others are removals.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocked_bloom
from .components import components
from .shared import column, cut, free_name, small_batches

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
PASSAGE_WORDS = 25
ANCHOR_RANGE = 27
LOT_BYTES = 1 << 18                    # bytes of text hashed at once
LARGE_BUCKET = 64                      # members; pairs of larger buckets are not listed
SKETCH_BITS = 512                      # of a member of a large bucket
SEED = 20240229
PARAGRAPH, PASSAGE = 0, 1


def tune_bands(threshold: float, recall: float, longest: int = 8) -> tuple[int, int]:
    """(bands, rows): the longest bands (fewest chance collisions) for which
    pairs at ``threshold`` collide with probability ``recall`` in no more
    than 12 bands, or else in the fewest bands."""
    need = [(int(np.ceil(np.log1p(-recall) / np.log1p(-threshold ** r))), r) for r in range(1, longest + 1)]
    return max((x for x in need if x[0] <= 12), key=lambda x: x[1], default=min(need))


# ---- words ---------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


# The white space that str.split() knows, in UTF-8.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_WIDE_SPACES = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def space_mask(codes: np.ndarray) -> np.ndarray:
    """Which bytes of a UTF-8 text belong to white space."""
    out = _SPACE[codes]
    for lead in {s[0] for s in _WIDE_SPACES}:
        at = np.flatnonzero(codes == lead)
        for s in (s for s in _WIDE_SPACES if s[0] == lead):
            hit = at[at + len(s) <= len(codes)]
            for i in range(1, len(s)):
                hit = hit[codes[hit + i] == s[i]]
            for i in range(len(s)):
                out[hit + i] = True
    return out


def text_lots(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-cased texts without nulls in lots of about LOT_BYTES: (number of
    each text, bytes, offsets)."""
    texts = pc.utf8_lower(texts).cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + LOT_BYTES, "right")) - 1)
        yield np.arange(a, b), data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


class Words:
    """The words of a lot of texts: hash, text and line of each."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray, base: int):
        begins = np.zeros(len(codes) + 1, bool)
        begins[offsets] = True
        hashes, starts, lines, a, n_lines = [], [], [], 0, 0
        while a < len(codes):
            # A long text is hashed in parts that end at a line or word end.
            b = min(len(codes), a + LOT_BYTES)
            while b < len(codes) and codes[b] not in (10, 32) and not begins[b]:
                b += 1
            part = codes[a:b]
            space = space_mask(part)
            first = ~space
            first[1:] &= space[:-1] | begins[a + 1:b]
            last = ~space
            last[:-1] &= space[1:] | begins[a + 1:b]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(base, len(part)), out=sums[1:])
            back = powers(pow(base, -1, 1 << 64), len(part))
            hashes.append(_mix((sums[e] - sums[s]) * back[s]))
            breaks = np.cumsum(part == 10)
            starts.append(s + a)
            lines.append(breaks[s] + n_lines)
            n_lines += int(breaks[-1]) if len(breaks) else 0
            a = b
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        self.hash = join(hashes).astype(np.uint64)
        self.text = np.searchsorted(offsets, join(starts), "right") - 1
        # A new text is a new line, with a gap, so that blocks end there too.
        self.line = join(lines) + 2 * self.text
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))     # first word of each text


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


# ---- units of a text -----------------------------------------------------------

class Units:
    """Hash parameters, the same in every task."""

    def __init__(self, threshold: float, recall: float, passage_words: int, anchor_range: int):
        rng = np.random.default_rng(SEED)
        self.bands, self.rows = tune_bands(threshold, recall)
        n = self.bands * self.rows
        odd = lambda *shape: rng.integers(0, 1 << 63, shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shingle, self.scale, self.shift = odd(SHINGLE), odd(n), odd(n)
        self.band = odd(self.rows + 1)
        self.letters, *self.runs = (int(x) for x in odd(3))
        self.place = odd(2)
        self.passage_words, self.anchor_range = passage_words, anchor_range

    def words(self, codes: np.ndarray, offsets: np.ndarray) -> Words:
        return Words(codes, offsets, self.letters)

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """Hash of every run of five words (of word hashes)."""
        n = len(words) - SHINGLE + 1
        if n < 1:
            return np.zeros(0, np.uint64)
        total = words[:n] * self.shingle[0]
        for j in range(1, SHINGLE):
            total = total + words[j:j + n] * self.shingle[j]
        return _mix(total)

    def signatures(self, shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(parts, hash functions): least values of the parts of ``shingles``
        that start at ``first``."""
        return np.stack([np.minimum.reduceat(shingles * a + b, first)
                         for a, b in zip(self.scale, self.shift)], axis=1)

    def bands_of(self, least: np.ndarray) -> np.ndarray:
        """(paragraphs, bands) keys of signatures."""
        parts = least.reshape(len(least), self.bands, self.rows)
        key = (parts * self.band[:self.rows]).sum(axis=2, dtype=np.uint64)
        return _mix(key + np.arange(1, self.bands + 1, dtype=np.uint64) * self.band[self.rows])

    def digests(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Two hashes of the words of each run (first word, number)."""
        out = []
        for base in self.runs:
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * powers(base, len(words)), out=sums[1:])
            back = powers(pow(base, -1, 1 << 64), len(words) + 1)
            out.append(_mix((sums[starts + sizes] - sums[starts]) * back[starts] + sizes.astype(np.uint64)).view(np.int64))
        return out

    def spans(self, w: Words):
        """(first word, words) of all lines and blocks, and what their
        signatures come from: the shingles inside blocks, the first one of each
        part, whether a part is a line, the first part of each block and whether
        the block has several lines."""
        n = max(len(w.hash) - SHINGLE + 1, 0)
        block = np.cumsum(np.append(0, np.diff(w.line) > 1))
        pure = w.line[:n] == w.line[SHINGLE - 1:]
        at = np.flatnonzero(block[:n] == block[SHINGLE - 1:]) if n else np.zeros(0, np.int64)
        if not len(at):
            return at, at, None
        # Parts: the shingles of a line, and those that start there and cross its end.
        line, inside = w.line[at], pure[at]
        new = np.append(True, (line[1:] != line[:-1]) | (inside[1:] != inside[:-1]))
        part = np.flatnonzero(new)
        whole = inside[part]
        sizes = np.diff(np.append(part, len(at)))
        # Blocks of one line are that line.
        owner = block[at[part]]
        head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        number = owner[head]
        starts = np.searchsorted(block, number)
        n_words = np.searchsorted(block, number, "right") - starts
        several = w.line[starts] != w.line[starts + n_words - 1]
        return (np.concatenate([at[part[whole]], starts[several]]),
                np.concatenate([sizes[whole] + SHINGLE - 1, n_words[several]]),
                (at, part, whole, head, several))

    def paragraphs(self, w: Words, shingles: np.ndarray):
        """(first word, words, signature) of all lines and blocks."""
        starts, sizes, parts = self.spans(w)
        if not len(starts):
            return starts, sizes, np.zeros((0, self.bands * self.rows), np.uint64)
        at, part, whole, head, several = parts
        least = self.signatures(shingles[at], part)
        of_block = np.minimum.reduceat(least, head, axis=0)
        return starts, sizes, np.concatenate([least[whole], of_block[several]])

    def place_keys(self, doc_id: np.ndarray, start: np.ndarray, d1: np.ndarray) -> np.ndarray:
        """Hash of the place and the words of paragraphs."""
        a, b = self.place
        return _mix(d1.view(np.uint64) + doc_id.astype(np.uint64) * a + start.astype(np.uint64) * b).view(np.int64)

    def anchors(self, w: Words, shingles: np.ndarray) -> np.ndarray:
        """First words of the passages."""
        low = np.uint64((1 << 24) - 1)
        value = shingles & ~low | (np.arange(len(shingles), dtype=np.uint64) & low)
        counts = np.maximum(np.diff(w.first) - self.passage_words + 1, 0)
        out = []
        least, reach = value, 1
        while reach < self.anchor_range and len(least):
            step = min(reach, self.anchor_range - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        for a, n in zip(w.first[:-1].tolist(), counts.tolist()):
            if n > self.anchor_range:
                places = least[a:a + n - self.anchor_range + 1]
                fresh = np.append(True, places[1:] != places[:-1])
                at = np.flatnonzero(fresh)
                # The low bits tell the place among the next words.
                out.append(a + at + ((places[at] - np.uint64(1) * (a + at).astype(np.uint64)) & low).astype(np.int64))
            elif n:
                out.append(np.array([a + int(value[a:a + n].argmin())]))
        return np.concatenate(out) if out else np.zeros(0, np.int64)


# ---- Spark -----------------------------------------------------------------------

UNIT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("kind", T.IntegerType()),
                     T.StructField("start", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
                     T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
                     T.StructField("bands", T.ArrayType(T.LongType()))])


def extract_units(texts: DataFrame, how: Units) -> DataFrame:
    """Units of all ``texts`` (doc_id, text; no nulls), a lot at a time."""
    def rows(kind, ids, w, number, starts, sizes, bands):
        d1, d2 = how.digests(w.hash, starts, sizes)
        text = w.text[starts]
        n = len(starts)
        if bands is None:
            bands = pa.nulls(n, pa.list_(pa.int64()))
        else:
            bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * how.bands),
                                             pa.array(bands.view(np.int64).ravel()))
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(number[text])), pa.array(np.full(n, kind, np.int32)),
             pa.array((starts - w.first[text]).astype(np.int32)), pa.array(sizes.astype(np.int32)),
             pa.array(d1), pa.array(d2), bands], names=UNIT.names)

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for number, codes, offsets in text_lots(batch.column("text")):
                w = how.words(codes, offsets)
                shingles = how.shingles(w.hash)
                if len(shingles):
                    starts, sizes, least = how.paragraphs(w, shingles)
                    if len(starts):
                        yield rows(PARAGRAPH, ids, w, number, starts, sizes, how.bands_of(least))
                    starts = how.anchors(w, shingles)
                    if len(starts):
                        yield rows(PASSAGE, ids, w, number, starts, np.full(len(starts), how.passage_words), None)

    return texts.mapInArrow(run, UNIT)


_SETS = "node long, d2 long, shingles array<int>"


def _paragraph_sets(texts: DataFrame, units: DataFrame, nodes: DataFrame, how: Units) -> DataFrame:
    """(node, d2, shingles) for paragraphs ``nodes``, read again from one text
    each; a few others may be listed too. The texts stay where they are read: a
    Bloom filter of the places tells which paragraphs of a text to take."""
    place = (units.where(F.col("kind") == PARAGRAPH).join(nodes, F.col("d1") == F.col("node"), "left_semi")
                  .groupBy("d1").agg(F.min(F.struct("doc_id", "start")).alias("at")).select("d1", "at.*"))

    def keys(batches):
        for batch in batches:
            key = how.place_keys(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "start", "d1")))
            yield pa.RecordBatch.from_arrays([pa.array(key)], names=["key"])

    table = blocked_bloom.build(cut(place.mapInArrow(keys, "key long"), "substring-places"), "key")
    schema = pa.schema([("node", pa.int64()), ("d2", pa.int64()), ("shingles", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for number, codes, offsets in text_lots(batch.column("text")):
                w = how.words(codes, offsets)
                start, size, _ = how.spans(w)
                if not len(start):
                    continue
                d1, d2 = how.digests(w.hash, start, size)
                text = w.text[start]
                hit = blocked_bloom.held(table.value, how.place_keys(ids[number[text]], start - w.first[text], d1))
                if len(hit):
                    # 32 bits tell the shingles of two paragraphs apart: a clash, in one
                    # of 10^5 pairs of 200, moves their similarity by one shingle.
                    shingles = how.shingles(w.hash).astype(np.uint32).view(np.int32)
                    sets = [np.unique(shingles[s:s + n - SHINGLE + 1]) for s, n in
                            zip(start[hit].tolist(), size[hit].tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(d1[hit]), pa.array(d2[hit]),
                                                      pa.array(sets, schema.field("shingles").type)], schema=schema)

    return texts.mapInArrow(run, _SETS).dropDuplicates(["node"])


def _similar(a: Column, b: Column, threshold: float) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both >= threshold * (F.size(a) + F.size(b) - both)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose shingle sets have the Jaccard similarity."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(a, "u").join(b, "v").where(_similar(F.col("a"), F.col("b"), threshold)).select("u", "v")


def sketch_limit(threshold: float) -> int:
    """Differing bits of two sketches that sets at the threshold hardly ever
    pass: the mean and four deviations."""
    p = (1 - threshold) / 2
    return int(SKETCH_BITS * p + 4 * (SKETCH_BITS * p * (1 - p)) ** 0.5)


def _with_sketches(sets: DataFrame) -> DataFrame:
    """``sets`` (node, shingles) with s0, s1 ...: of the least value under each
    of SKETCH_BITS hash functions, one bit. Of two sets that share the part J
    of their shingles, (1 - J) / 2 of the bits differ."""
    rng = np.random.default_rng(SEED + 1)
    scale, shift = (rng.integers(0, 1 << 63, SKETCH_BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
    names = [f"s{i}" for i in range(SKETCH_BITS // 64)]

    def run(batches):
        for batch in batches:
            shingles = batch.column("shingles")
            first = np.append(0, np.cumsum(pc.list_value_length(shingles).to_numpy(zero_copy_only=False))[:-1])
            flat = _mix(shingles.flatten().to_numpy(zero_copy_only=False).view(np.uint32).astype(np.uint64))
            columns = []
            for i in range(0, SKETCH_BITS, 64):
                word = np.zeros(len(first), np.uint64)
                for j in range(64):
                    least = np.minimum.reduceat(flat * scale[i + j] + shift[i + j], first)
                    word |= (_mix(least) >> np.uint64(63)) << np.uint64(j)
                columns.append(pa.array(word.view(np.int64)))
            if len(first):
                yield pa.RecordBatch.from_arrays([batch.column("node"), shingles, *columns], names=["node", "shingles", *names])

    return sets.select("node", "shingles").mapInArrow(run, "node long, shingles array<int>, " + ", ".join(f"{n} long" for n in names))


def _open_links(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (u, v) between the groups that share a bucket: of ``rows`` (key,
    node, c: group so far, size), those outside a bucket's largest group meet
    the others. Pairs of small buckets are listed, each once, and verified; in
    buckets of more than LARGE_BUCKET members the sets, and one-bit MinHash
    sketches that rule out most pairs, go into the join, which lets out only
    what is similar."""
    groups = (rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
                  .groupBy("key").agg(F.max(F.struct("n", "c")).alias("m"), F.count(F.lit(1)).alias("groups"),
                                      F.sum("n").alias("n"))
                  .where("groups > 1")
                  .select(F.col("key").alias("k"), F.col("m.c").alias("most"), (F.col("n") > LARGE_BUCKET).alias("large")))
    rows = cut(rows.join(cut(groups, "substring-mixed"), F.col("key") == F.col("k")).drop("k"), "substring-open")

    def sides(x, *more):
        ours = [F.col("c").alias("cu"), F.col("size").alias("nu"), F.col("node").alias("u")]
        theirs = [F.col("c").alias("cv"), F.col("size").alias("nv"), F.col("node").alias("v")]
        a = x.where(F.col("c") != F.col("most")).select("key", *ours, *[F.col(m).alias(f"{m}_u") for m in more])
        b = x.select(F.col("key").alias("key_b"), *theirs, *[F.col(m).alias(f"{m}_v") for m in more])
        # Members outside the largest group meet each other once.
        once = (F.col("cv") == F.col("most_u")) | (F.col("u") < F.col("v"))
        fits = ((F.col("key") == F.col("key_b")) & (F.col("cu") != F.col("cv")) & once
                & (F.least("nu", "nv") >= threshold * F.greatest("nu", "nv")))
        return a, b, fits

    a, b, fits = sides(rows.where("NOT large"), "most")
    pairs = a.join(b, fits).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    links = _verified(cut(pairs, "substring-pairs"), sets, threshold)
    large = rows.where("large")
    if large.limit(1).count():
        own = sets.join(large.select("node").distinct(), "node", "left_semi")
        held = cut(large.join(_with_sketches(own), "node"), "substring-large")
        words = [f"s{i}" for i in range(SKETCH_BITS // 64)]
        a, b, fits = sides(held, "most", "shingles", *words)
        apart = reduce(add, [F.bit_count(F.col(f"{w}_u").bitwiseXOR(F.col(f"{w}_v"))) for w in words])
        # Cheap tests first: most pairs of a large bucket end at the sketches.
        alike = (apart <= sketch_limit(threshold)) & _similar(F.col("shingles_u"), F.col("shingles_v"), threshold)
        links = links.unionByName(a.join(b, fits & alike).select("u", "v").distinct())
    return links


def _shared_rows(units: DataFrame, shared: DataFrame) -> DataFrame:
    """(node, key) of the paragraphs' bands, most of those left out whose key
    is not shared."""
    table = blocked_bloom.build(shared, "key")

    def run(batches):
        for batch in batches:
            bands = batch.column("bands")
            keys = bands.flatten().to_numpy(zero_copy_only=False)
            own = np.repeat(batch.column("d1").to_numpy(zero_copy_only=False),
                            pc.list_value_length(bands).to_numpy(zero_copy_only=False))
            hit = blocked_bloom.held(table.value, keys)
            yield pa.RecordBatch.from_arrays([pa.array(own[hit]), pa.array(keys[hit])], names=["node", "key"])

    return (units.where(F.col("kind") == PARAGRAPH).select("d1", "bands").mapInArrow(run, "node long, key long"))


def paragraph_links(texts: DataFrame, units: DataFrame, how: Units, threshold: float) -> DataFrame:
    """(node, d2, component) for paragraphs similar to a different one; node
    and d2 are the hashes of a paragraph's words."""
    rows = units.where(F.col("kind") == PARAGRAPH).select(F.col("d1").alias("node"), F.explode("bands").alias("key"))
    shared = (rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("n"))
                  .where(F.col("lo") != F.col("hi")).select("key", "n"))
    # Each aggregate is written before a join on its key, so that the join can
    # be split where a key is hot.
    shared = cut(shared, "substring-shared")
    rows = cut(_shared_rows(units, shared).join(shared, "key").distinct(), "substring-buckets")
    # The pivot of a bucket is the member that meets the most others in all its
    # buckets: of a group of near copies, one near its centre.
    central = cut(rows.groupBy("node").agg(F.sum("n").alias("met")), "substring-central")
    pivots = cut(rows.select("key", "node").join(central, "node").groupBy("key")
                     .agg(F.max(F.struct("met", "node")).alias("p")).select("key", F.col("p.node").alias("pivot")),
                 "substring-pivots")
    rows = cut(rows.select("key", "node").join(pivots, "key"), "substring-rows")
    sets = cut(_paragraph_sets(texts, units, rows.select("node").distinct(), how), "substring-sets")
    star = (rows.where(F.col("node") != F.col("pivot"))
                .select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct())
    first = components(_verified(star, sets, threshold), "substring-star")
    size = sets.select("node", F.size("shingles").alias("size"))
    rows = cut(rows.select("key", "node").join(first, "node", "left").join(size, "node")
                   .select("key", "node", F.coalesce("component", "node").alias("c"), "size"), "substring-groups")
    cross = _open_links(rows, sets, threshold)
    known = first.select(F.col("node").alias("u"), F.col("component").alias("v"))
    linked = components(known.unionByName(cross), "substring-links")
    return linked.join(sets.select("node", "d2"), "node")


def repeats(docs: DataFrame, threshold: float = SIMILARITY, recall: float = RECALL, passage_words: int = PASSAGE_WORDS,
            anchor_range: int = ANCHOR_RANGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per unit that occurs more than once: doc_id, kind (paragraph or
    passage), start_word and n_words (words split at white space, from 0),
    component_id and component_start (document and word where the group's first
    occurrence starts, by doc_id, then word) and removed (false for that one and
    for units that overlap it). Units that are alike only because they overlap
    are no repeats.

    Units count wherever they occur, in one document or several. Null texts,
    lines and blocks of fewer than five words and texts shorter than
    ``passage_words`` words have no units; rows without a doc_id are left out;
    repeated rows are one document. Other columns are ignored; an empty table
    gives no rows."""
    small_batches(docs.sparkSession)
    how = Units(threshold, recall, passage_words, anchor_range)
    texts = (docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text"))
                 .where("doc_id IS NOT NULL AND text IS NOT NULL"))
    units = cut(extract_units(texts, how), "substring-units")
    twice = (F.col("lo") != F.col("hi")) | (F.col("first") != F.col("last"))
    classes = (units.groupBy("kind", "d1", "d2")
                    .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                         F.min("start").alias("first"), F.max("start").alias("last"))
                    .select("kind", "d1", "d2", twice.alias("twice")))
    classes = cut(classes.where((F.col("kind") == PARAGRAPH) | F.col("twice")), "substring-classes")
    linked = paragraph_links(texts, units, how, threshold).select(
        F.lit(PARAGRAPH).alias("kind"), F.col("node").alias("d1"), "d2", "component")
    labels = (classes.join(linked, ["kind", "d1", "d2"], "left").where(F.col("twice") | F.col("component").isNotNull())
                     .select("kind", "d1", "d2", F.coalesce("component", "d1").alias("component")))
    labels = cut(labels, "substring-labels")
    known = blocked_bloom.keep_held(units.drop("bands"), "d1", labels, "d1")
    members = (known.join(labels, ["kind", "d1", "d2"])
                    .select("kind", "component", "doc_id", "start", "n_words").distinct())
    members = cut(members, "substring-members")
    # The first occurrence stays, at its longest, with what lies inside it: a
    # block and a line of it may be alike, but do not repeat each other.
    first = F.col("at.start") - F.col("at.less")
    lead = (members.groupBy("kind", "component")
                   .agg(F.min(F.struct("doc_id", "start", (-F.col("n_words")).alias("less"))).alias("at"),
                        F.max(F.struct("doc_id", "start")).alias("last"))
                   .where((F.col("last.doc_id") != F.col("at.doc_id")) | (F.col("last.start") >= first))
                   .select("kind", "component", F.col("at.doc_id").alias("component_id"),
                           F.col("at.start").alias("component_start"), first.alias("lead_end")))
    # Written first, so that the join does not run in the aggregate's stage:
    # the members of a hot group can then be split among tasks.
    lead = cut(lead, "substring-leads")
    return members.join(lead, ["kind", "component"]).select(
        "doc_id", F.when(F.col("kind") == PARAGRAPH, "paragraph").otherwise("passage").alias("kind"),
        F.col("start").cast("long").alias("start_word"), F.col("n_words").cast("long").alias("n_words"),
        "component_id", F.col("component_start").cast("long").alias("component_start"),
        ((F.col("doc_id") != F.col("component_id")) | (F.col("start") >= F.col("lead_end"))).alias("removed"))


def remove(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the words of all removed units of ``found`` (from
    ``repeats``) cut out of the text, white space after them included. Rows
    without such a unit stay as they are."""
    small_batches(docs.sparkSession)
    name, key = free_name(docs, "_spans"), free_name(docs, "_span_doc")
    spans = (found.where("removed").groupBy(F.col("doc_id").alias(key))
                  .agg(F.collect_set(F.struct("start_word", "n_words")).alias(name)))

    @F.pandas_udf(T.StringType())
    def cut_out(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None else without(t, [(x["start_word"], x["n_words"]) for x in s])
                          for t, s in zip(texts, spans)], dtype=object)

    joined = docs.join(spans, column(docs, id_col) == spans[key], "left")
    return joined.withColumn(text_col, cut_out(column(docs, text_col), F.col(name))).select(
        *[f"`{c}`" for c in docs.columns])


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given runs of words (start, number)."""
    gone = set()
    for start, n in spans:
        gone.update(range(start, start + n))
    out, at, i = [], 0, 0
    for word in text.split():
        a = text.index(word, at)
        b = a + len(word)
        if i in gone:
            out.append(text[at:a] if i and i - 1 not in gone or not i else "")
        else:
            out.append(text[at:b])
        at, i = b, i + 1
    return "".join(out) + text[at:]
