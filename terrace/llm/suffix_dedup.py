"""Exact substring deduplication with suffix arrays.

Every byte covered by a string of ``length`` bytes (a *window*) that also
starts anywhere else, in another text or the same one, is removed.

1. *Anchors.* The anchor of a window is the place of the smallest hash among
   its runs of GRAM bytes (the first one of equals). Equal windows have equal
   anchors at the same offset, so only windows with the same anchor hash, the
   *key*, need comparing. Neighbouring windows with one key form a *segment*.
2. Keys that occur once are dropped. Segments with equal bytes (key and a
   second 64-bit hash) are one *class*: where a class has two members, all its
   windows are repeated, and only one member goes on.
3. The bytes of one member of each class are read again. Windows at nearby
   offsets from the anchor have most of their bytes, a *core*, in common:
   classes that share no core with another class of their key hold no repeated
   window and go.
4. The other classes of a key meet in one task. Keys are packed into texts of
   about ``PACK_BYTES``; the suffix array of such a text (see ``suffix_array``)
   puts equal windows side by side, so that comparing neighbours finds them all.
5. A key with more than ``HOT_BYTES`` of different segments (a passage that
   stands in very many surroundings) is not gathered: its windows are counted
   by two 64-bit hashes in an ordinary aggregate, which combines before the
   shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import column, cut, small_batches
from .suffix_array import repeated_starts

GRAM_SHARE = 2                         # an anchor is half as long as a window
PIECE_BYTES = 1 << 18                  # bytes hashed at once
CORES = 4                              # groups of offsets from the anchor
PACK_BYTES = 1 << 15                   # bytes of one suffix array, unless one key has more
HOT_BYTES = 1 << 20                    # bytes of different segments of one key that one task takes
SEED = 20240613
PLACE_BITS = 22                        # a place within a piece; the rest of 64 bits is the hash


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Windows:
    """Hash parameters for windows of ``length`` bytes, the same in all tasks."""

    def __init__(self, length: int):
        if length < 2 * GRAM_SHARE:
            raise ValueError("windows need at least four bytes")
        rng = np.random.default_rng(SEED)
        self.length, self.gram, self.piece = length, length // GRAM_SHARE, PIECE_BYTES
        self.base = [int(b) | 1 for b in rng.integers(1 << 62, 1 << 63, 3)]
        self.known: dict[int, np.ndarray] = {}

    def powers(self, base: int, n: int) -> np.ndarray:
        """The first powers of ``base``, kept for the next piece."""
        if len(self.known.get(base, ())) < n:
            out = np.full(max(n, self.piece + 2 * self.length), base, np.uint64)
            out[0] = 1
            self.known[base] = np.multiply.accumulate(out)
        return self.known[base][:n]

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def run_hashes(self, codes: np.ndarray, size: int, which: int) -> np.ndarray:
        """Hash of every run of ``size`` bytes: a polynomial, by its sums over
        all prefixes, moved back to the start of the run."""
        base, n = self.base[which], len(codes)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.powers(base, n), out=sums[1:])
        back = self.powers(pow(base, -1, 1 << 64), n - size + 1)
        return _mix((sums[size:] - sums[:n - size + 1]) * back)

    def segments(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Segments of the texts ``codes[starts[i]:ends[i]]``: arrays (text,
        first byte, bytes, key, place of the anchor in the segment or -1 if it
        has several), first byte within ``codes``."""
        width = self.length - self.gram + 1
        hashes = self.run_hashes(codes, self.gram, 0)
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = hashes & ~low | np.arange(len(hashes), dtype=np.uint64)
        reach = 1
        while reach < width:
            step = min(reach, width - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        counts = np.maximum(ends - starts - self.length + 1, 0)
        text = np.repeat(np.arange(len(starts)), counts)
        window = np.arange(len(text)) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
        anchor = (least[window] & low).astype(np.int64)
        fresh = np.ones(len(text), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(fresh)                 # runs of windows with one anchor
        key, owner = hashes[anchor[first]], text[first]
        new = np.ones(len(first), bool)
        new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        seg = np.flatnonzero(new)                     # runs with one key
        begin = first[seg]
        n_windows = np.diff(np.append(begin, len(text)))
        anchors = np.diff(np.append(seg, len(first)))
        start = window[begin]
        at = np.where(anchors == 1, anchor[begin] - start, -1)
        return owner[seg], start, n_windows + self.length - 1, key[seg].view(np.int64), at

    def cores(self, data: bytes, at: int) -> list[int]:
        """Hashes of the cores of a segment with one anchor: the windows whose
        anchor is ``lo`` to ``hi`` bytes behind their start all hold the bytes
        from ``lo`` before the anchor to ``hi`` short of a window behind it."""
        width = self.length - self.gram + 1
        last = at - (len(data) - self.length)         # the anchor's place in the last window
        out = []
        for j in range(CORES):
            lo, hi = width * j // CORES, width * (j + 1) // CORES - 1
            if lo <= hi and last <= hi and at >= lo:  # the segment has such windows
                out.append(xxhash.xxh3_64_intdigest(data[at - lo:at + self.length - hi], seed=j))
        return out


def _text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _pieces(offsets: np.ndarray, length: int, piece: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts (number, first byte, end) in lots of about ``piece`` bytes. A longer
    text comes in several lots that overlap, so that each window is in one."""
    lot, size = [], 0
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while b - a >= length:
            end = min(b, a + piece + length - 1)
            if lot and size + end - a > piece:
                yield tuple(np.array(c) for c in zip(*lot))
                lot, size = [], 0
            lot.append((i, a, end))
            size += end - a
            a = end - length + 1 if end < b else b
    if lot:
        yield tuple(np.array(c) for c in zip(*lot))


_SEGMENT = "doc_id long, th long, start long, size long, key long, d long, at long"


def _segments(texts: DataFrame, how: Windows) -> DataFrame:
    """Segments of all ``texts`` (doc_id, th, text)."""
    names = ["doc_id", "th", "start", "size", "key", "d", "at"]

    def run(batches):
        for batch in batches:
            codes, offsets = _text_buffers(batch.column("text"))
            ids, hashes = batch.column("doc_id"), batch.column("th")
            for which, a, b in _pieces(offsets, how.length, how.piece):
                # Texts of a lot stand side by side, but for skipped short ones.
                base = int(a[0])
                part = codes[base:int(b[-1])]
                owner, first, size, key, at = how.segments(part, a - base, b - base)
                view = memoryview(part)
                d = np.fromiter((xxhash.xxh3_64_intdigest(view[s:e])
                                 for s, e in zip(first.tolist(), (first + size).tolist())), np.uint64, len(first))
                doc = pa.array(which[owner])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(doc), hashes.take(doc), pa.array(first + base - offsets[which[owner]]),
                     pa.array(size), pa.array(key), pa.array(d.view(np.int64)), pa.array(at)], names=names)

    return texts.mapInArrow(run, _SEGMENT)


_BYTES = "key long, d long, twice boolean, doc_id long, th long, start long, bytes binary, cores array<long>"


def _read_again(texts: DataFrame, classes: DataFrame, how: Windows) -> DataFrame:
    """Bytes and cores of one member (doc_id, th, start, size, at) of each
    class; null for the cores of a segment with several anchors."""
    listed = (classes.groupBy(F.col("doc_id").alias("doc_id2"), F.col("th").alias("th2"))
                     .agg(F.collect_list(F.struct("key", "d", "twice", "start", "size", "at")).alias("own")))
    both = texts.join(listed, texts["doc_id"].eqNullSafe(F.col("doc_id2")) & (texts["th"] == F.col("th2")))
    schema = pa.schema([("key", pa.int64()), ("d", pa.int64()), ("twice", pa.bool_()), ("doc_id", pa.int64()),
                        ("th", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary()),
                        ("cores", pa.list_(pa.int64()))])

    def run(batches):
        last = None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text", "own")))
            out = []
            for doc_id, th, text, own in rows:
                if (doc_id, th) == last:              # a repeated row
                    continue
                last, data = (doc_id, th), text.encode("utf-8")
                for o in own:
                    part = data[o["start"]:o["start"] + o["size"]]
                    cores = None if o["at"] < 0 else [_signed(c) for c in how.cores(part, o["at"])]
                    out.append((o["key"], o["d"], o["twice"], doc_id, th, o["start"], part, cores))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return both.select("doc_id", "th", "text", "own").mapInArrow(run, _BYTES)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _with_partners(read: DataFrame) -> DataFrame:
    """Classes that may hold a window of another class of their key, or several
    times the same window; at least one of the two has one member."""
    cores = read.where("cores IS NOT NULL").select("key", "d", "twice", F.explode("cores").alias("core"))
    shared = (cores.groupBy("key", "core").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.min("twice").alias("all_twice"))
                   .where("lo <> hi AND NOT all_twice").select(F.col("key").alias("k"), F.col("core").alias("c")))
    needed = (cores.join(cut(shared, "suffix-cores"), (F.col("key") == F.col("k")) & (F.col("core") == F.col("c")))
                   .select("key", "d"))
    # A segment with several anchors is compared with its whole key.
    several = cut(read.where("cores IS NULL").select("key").distinct(), "suffix-several")
    needed = needed.unionByName(read.join(several, "key").select("key", "d")).distinct()
    needed = cut(needed.withColumnsRenamed({"key": "k", "d": "d2"}), "suffix-needed")
    return read.drop("cores").join(needed, (F.col("key") == F.col("k")) & (F.col("d") == F.col("d2")), "left_semi")


_SPAN = "doc_id long, th long, s long, e long"


def _covered(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of bytes covered by the windows at ``starts`` (ascending)."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(np.diff(starts) > length)
    return starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)] + length


def _compare(length: int):
    """Rows sorted by key: spans of repeated windows of classes with one
    member, by the suffix arrays of whole keys."""
    def solve(lot):
        begins = np.cumsum([0] + [len(r[6]) + 1 for r in lot])
        starts = [np.arange(a, a + len(r[6]) - length + 1) for a, r in zip(begins.tolist(), lot)]
        # Segments are parted by a byte that UTF-8 does not hold.
        found = repeated_starts(b"\xff".join(r[6] for r in lot), np.concatenate(starts), length)
        out = []
        cuts = np.searchsorted(found, begins)
        for i, (_, _, twice, doc_id, th, start, _) in enumerate(lot):
            if not twice:
                for s, e in zip(*(x.tolist() for x in _covered(found[cuts[i]:cuts[i + 1]] - begins[i], length))):
                    out.append((doc_id, th, start + s, start + e))
        return out

    def run(batches):
        lot, size, last = [], 0, None
        schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                if row[:2] == last:                   # a class that was read twice
                    continue
                if size > PACK_BYTES and row[0] != last[0]:
                    out += solve(lot)
                    lot, size = [], 0
                last = row[:2]
                lot.append(row)
                size += len(row[6])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
        out = solve(lot) if lot else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
    return run


def _count_windows(rows: DataFrame, how: Windows) -> DataFrame:
    """Spans of the repeated windows of hot keys' classes, by counting."""
    names = ["h1", "h2", "n", "doc_id", "th", "s"]

    def run(batches):
        for batch in batches:
            for key, d, twice, doc_id, th, start, data in zip(*(batch.column(c).to_pylist()
                                                                for c in batch.schema.names)):
                codes = np.frombuffer(data, np.uint8)
                for a in range(0, len(codes) - how.length + 1, how.piece):
                    part = codes[a:a + how.piece + how.length - 1]
                    h1, h2 = (how.run_hashes(part, how.length, i).view(np.int64) for i in (1, 2))
                    n = len(h1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h1), pa.array(h2), pa.array(np.full(n, 1 + twice)), pa.array([doc_id] * n, pa.int64()),
                         pa.array([th] * n, pa.int64()), pa.array(np.arange(n) + start + a)], names=names)

    windows = rows.dropDuplicates(["key", "d"]).mapInArrow(
        run, "h1 long, h2 long, n long, doc_id long, th long, s long")
    windows = cut(windows, "suffix-windows")
    often = cut(windows.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2")).agg(F.sum("n").alias("times"))
                       .where("times > 1"), "suffix-often")
    return (windows.where("n = 1").join(often, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
                   .select("doc_id", "th", "s", (F.col("s") + how.length).alias("e")))


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, s, e): byte spans of ``texts`` (doc_id, th: hash of the
    text, text) that repeated windows cover; spans may overlap or touch."""
    how = Windows(length)
    segments = cut(_segments(texts, how), "suffix-segments")
    anchors = F.when(F.col("at") < 0, 2).otherwise(1)
    keys = (segments.groupBy(F.col("key").alias("k"))
                    .agg(F.sum(anchors).alias("anchors"), F.count(F.lit(1)).alias("rows"),
                         F.min("d").alias("lo"), F.max("d").alias("hi"))
                    .where("anchors > 1").select("k", ((F.col("lo") == F.col("hi")) & (F.col("rows") > 1)).alias("alike")))
    keys = cut(keys, "suffix-keys")
    again = cut(segments.join(keys, F.col("key") == F.col("k")).drop("k"), "suffix-again")
    alike, mixed = again.where("alike"), again.where("NOT alike")
    classes = cut(mixed.groupBy("key", "d").agg((F.count(F.lit(1)) > 1).alias("twice"),
                                                F.min(F.struct("doc_id", "th", "start", "size", "at")).alias("m"))
                       .select("key", "d", "twice", "m.*"), "suffix-classes")
    copies = classes.where("twice").select(F.col("key").alias("k"), F.col("d").alias("d2"))
    whole = alike.select("doc_id", "th", "start", "size").unionByName(
        mixed.join(copies, (F.col("key") == F.col("k")) & (F.col("d") == F.col("d2")))
             .select("doc_id", "th", "start", "size"))
    whole = whole.select("doc_id", "th", F.col("start").alias("s"), (F.col("start") + F.col("size")).alias("e"))
    # Keys whose classes all have two members need no more than that.
    open_keys = classes.groupBy(F.col("key").alias("k")).agg(F.min("twice").alias("all_twice")).where("NOT all_twice")
    classes = classes.join(cut(open_keys.select("k"), "suffix-open"), F.col("key") == F.col("k"), "left_semi")
    read = cut(_with_partners(cut(_read_again(texts, classes, how), "suffix-read")), "suffix-bytes")
    hot = cut(read.groupBy(F.col("key").alias("k")).agg(F.sum(F.length("bytes")).alias("n"))
                  .where(F.col("n") > HOT_BYTES).select("k"), "suffix-hot")
    kept = read.join(hot, F.col("key") == F.col("k"), "left_anti")
    columns = [F.col(c) for c in read.columns]
    found = (kept.repartition("key").sortWithinPartitions("key", "d").select(*columns)
                 .mapInArrow(_compare(length), _SPAN))
    spans = whole.unionByName(cut(found, "suffix-found"))
    if hot.limit(1).count():
        counted = read.join(hot, F.col("key") == F.col("k"), "left_semi").select(*columns)
        spans = spans.unionByName(_count_windows(counted, how))
    return spans


def remove_repeats(docs: DataFrame, length: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (of the text in UTF-8),
    removed (maximal runs of removed bytes, as (start, size) in order) and kept
    (binary, the other bytes).

    All copies of a repeated string go, the first one too. Null texts count as
    empty; texts shorter than ``length`` bytes lose nothing. Rows are told
    apart by id and text: repeated rows are texts of their own and remove each
    other, with or without an id. Other columns are ignored; an empty table
    gives no rows."""
    small_batches(docs.sparkSession)
    text = F.coalesce(column(docs, text_col).cast("string"), F.lit(""))
    texts = docs.select(column(docs, id_col).cast("long").alias("doc_id"), text.alias("text"))
    texts = texts.withColumn("th", F.xxhash64("text"))
    spans = repeated_spans(texts.where(F.octet_length("text") >= length), length)
    spans = spans.groupBy(F.col("doc_id").alias("doc_id2"), F.col("th").alias("th2")).agg(
        F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans"))
    rows = texts.join(spans, F.col("doc_id").eqNullSafe(F.col("doc_id2")) & (F.col("th") == F.col("th2")), "left")
    kind = "doc_id long, n_bytes long, removed array<struct<start: long, size: long>>, kept binary"

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                            ("removed", pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))),
                            ("kept", pa.binary())])
        for batch in batches:
            out = []
            for doc_id, text, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                data = text.encode("utf-8")
                gone, kept, at = _merged(own or []), [], 0
                for s, e in gone:
                    kept.append(data[at:s])
                    at = e
                kept.append(data[at:])
                out.append((doc_id, len(data), [{"start": s, "size": e - s} for s, e in gone], b"".join(kept)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.select("doc_id", "text", "spans").mapInArrow(run, kind)


def _merged(spans: list[dict]) -> list[list[int]]:
    """Spans in order, those that overlap or touch made one."""
    out: list[list[int]] = []
    for x in spans:
        if out and x["s"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x["e"])
        else:
            out.append([x["s"], x["e"]])
    return out
