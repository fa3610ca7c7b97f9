"""Spelling variants of a corpus' vocabulary, found through Bloom filters.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point.

1. Words are counted in each task first, then by word.
2. The vocabulary goes into blocked Bloom filters, one per word length: a word
   sets one bit in each of the eight 64-bit lanes of one block. Tasks set the
   bits of their words, blocks are joined with ``bit_or``, and the filters are
   broadcast. Their size never passes ``FILTER_BYTES``: a vocabulary too large
   for that makes the filters fuller and lets more wrong edits through, but
   changes no result.
3. For every word all single deletions, and all replacements by a higher code
   point, are probed in the filter of their length. An insertion is a deletion
   seen from the other word, and a lower code point likewise. The hash of an
   edit comes from sums over the word's prefixes, so that no edited word is
   built for a probe; positives only are spelt out.
4. Positives are joined with the vocabulary, which removes the wrong ones.
5. A word's form is its most frequent near word, if that is frequent enough;
   roots are found by doubling the steps along forms.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import column, cut, small_batches

# Fixed value: the characters of a word.
WORD_CHARS = r"A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10                             # a form occurs so many times as often
FILTER_BYTES = 64 << 20                # of all filters together
BITS_PER_WORD = 16
LANES = 8
LONGEST = 48                           # longer words share one filter
PROBES = 1 << 19                       # edits hashed at once
HELD_WORDS = 200_000                   # counted words that a task holds
SEED = 20240711


# ---- counting ------------------------------------------------------------------

def lowered(text: str) -> str:
    """A-Z to a-z, all other characters as they are."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def _word_batch(words, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])


def word_counts(docs: DataFrame, salt: int | None, min_length: int, id_col: str, text_col: str) -> DataFrame:
    """(word, n): words of all texts with their occurrences. With a ``salt``,
    a word loses the code point h modulo its length where salt divides
    h = crc32("<id>:<word>")."""
    # A word that loses a code point has one more before.
    runs = re.compile(f"[{WORD_CHARS}]{{{min_length},}}")
    texts = docs.select(column(docs, id_col).cast("string").alias("id"), column(docs, text_col).alias("text"))

    def run(batches):
        held: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                own = Counter(runs.findall(lowered(text)))
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for w, n in own.items():
                    if salt:
                        h = zlib.crc32(w.encode(), start)
                        if not h % salt:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                    held[w] = held.get(w, 0) + n
            if len(held) > HELD_WORDS:
                yield _word_batch(list(held), list(held.values()))
                held = {}
        yield _word_batch(list(held), list(held.values()))

    counted = texts.where("text IS NOT NULL").mapInArrow(run, "word string, n long")
    return counted.where(F.char_length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n"))


# ---- filters -------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_RNG = np.random.default_rng(SEED)
BASE = int(_RNG.integers(1 << 62, 1 << 63)) | 1
BACK = np.uint64(pow(BASE, -1, 1 << 64))
LANE_MULTIPLIERS = _RNG.integers(1 << 62, 1 << 63, LANES, dtype=np.uint64) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def codes_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def sums_of(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of every prefix: column i is that of i code points."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    np.cumsum(codes * _powers(codes.shape[1]), axis=1, out=out[:, 1:])
    return out


def shard_of(length: int) -> int:
    return min(length, LONGEST)


def places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, mixed hash) of polynomial hashes."""
    mixed = _mix(hashes)
    return ((mixed >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), mixed


def lane_bit(mixed: np.ndarray, lane: int) -> np.ndarray:
    return np.uint64(1) << ((mixed * LANE_MULTIPLIERS[lane]) >> np.uint64(58))


def blocks_per_shard(sizes: dict[int, int]) -> dict[int, int]:
    """Blocks of each filter, about BITS_PER_WORD bits a word, all together
    within FILTER_BYTES."""
    wanted = {s: -(-n * BITS_PER_WORD // (64 * LANES)) for s, n in sizes.items()}
    room = FILTER_BYTES // (8 * LANES)
    share = min(1.0, room / max(1, sum(wanted.values())))
    return {s: max(1, int(n * share)) for s, n in wanted.items()}


def by_length(batch: pa.RecordBatch) -> dict[int, list[tuple[str, int]]]:
    """Rows (word, n) of a batch by the word's length."""
    out: dict[int, list[tuple[str, int]]] = {}
    for row in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
        out.setdefault(len(row[0]), []).append(row)
    return out


def build_filters(words: DataFrame) -> dict[int, np.ndarray]:
    """Filter (blocks, lanes) of each shard. Only their blocks, within
    FILTER_BYTES, reach the driver."""
    shard = F.least(F.char_length("word"), F.lit(LONGEST))
    sizes = {r["s"]: r["n"] for r in words.groupBy(shard.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = blocks_per_shard(sizes)
    lanes = [f"b{i}" for i in range(LANES)]

    def run(batches):
        for batch in batches:
            for length, part in by_length(batch).items():
                block, mixed = places(sums_of(codes_of([w for w, _ in part]))[:, -1], blocks[shard_of(length)])
                order = np.argsort(block, kind="stable")
                block, mixed = block[order], mixed[order]
                first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), shard_of(length), np.int32)), pa.array(block[first])]
                    + [pa.array(np.bitwise_or.reduceat(lane_bit(mixed, i), first).view(np.int64)) for i in range(LANES)],
                    names=["shard", "block", *lanes])

    kind = "shard int, block long, " + ", ".join(f"{b} long" for b in lanes)
    rows = (words.select("word", "n").mapInArrow(run, kind).groupBy("shard", "block")
                 .agg(*[F.bit_or(b).alias(b) for b in lanes]).toPandas())
    out = {s: np.zeros((n, LANES), np.uint64) for s, n in blocks.items()}
    for s, part in rows.groupby("shard"):
        out[int(s)][part["block"].to_numpy()] = part[lanes].to_numpy(np.int64).view(np.uint64)
    return out


def probe(found: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    """Numbers of the hashes that the filter may hold."""
    if found is None or not len(hashes):
        return np.zeros(0, np.int64)
    block, mixed = places(hashes, len(found))
    left = np.flatnonzero(found[block, 0] & lane_bit(mixed, 0))
    for lane in range(1, LANES):
        left = left[(found[block[left], lane] & lane_bit(mixed[left], lane)) != 0]
    return left


# ---- edits ---------------------------------------------------------------------

def candidates(words: list[str], filters: dict[int, np.ndarray], alphabet: np.ndarray):
    """(word number, edit) for edits of words of one length that the filters
    may hold: deletions, and replacements by a higher code point."""
    codes = codes_of(words)
    n, length = codes.shape
    sums, powers = sums_of(codes), _powers(length)
    whole, shorter, same = sums[:, -1], filters.get(shard_of(length - 1)), filters.get(shard_of(length))
    step = max(1, PROBES // n)
    for a in range(0, length, step):
        at = np.arange(a, min(length, a + step))
        # The same word comes from each of a run of equal code points: take the last.
        keep = np.ones((n, len(at)), bool)
        inner = at < length - 1
        keep[:, inner] = codes[:, at[inner]] != codes[:, at[inner] + 1]
        w, i = np.nonzero(keep)
        i = at[i]
        hashes = sums[w, i] + (whole[w] - sums[w, i + 1]) * BACK
        for x in probe(shorter, hashes).tolist():
            word, gone = words[w[x]], i[x]
            yield int(w[x]), word[:gone] + word[gone + 1:]
    # Without the code point at a place, a replacement there adds its own term.
    without = whole[:, None] - codes * powers
    step = max(1, PROBES // (n * max(1, len(alphabet))))
    for a in range(0, length if same is not None else 0, step):
        at = np.arange(a, min(length, a + step))
        higher = alphabet > codes[:, at, None]
        hashes = (without[:, at, None] + alphabet * powers[at, None])[higher]
        hits = probe(same, hashes)
        if len(hits):
            places_ = np.flatnonzero(higher)[hits]
            w, rest = np.divmod(places_, len(at) * len(alphabet))
            i, c = np.divmod(rest, len(alphabet))
            for k, place, new in zip(w.tolist(), at[i].tolist(), alphabet[c].tolist()):
                word = words[k]
                yield k, word[:place] + chr(new) + word[place + 1:]


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), both ways, for all near pairs of ``words``
    (word, n; each word once)."""
    letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct()
    # At most the characters that a word can have.
    alphabet = np.array(sorted(ord(r["c"]) for r in letters.collect()), np.uint64)
    filters = words.sparkSession.sparkContext.broadcast(build_filters(words))

    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("edit", pa.string())])

    def run(batches):
        for batch in batches:
            for length, part in by_length(batch).items():
                lot = max(1, PROBES // (length * max(1, len(alphabet))))
                for a in range(0, len(part), lot):
                    some = part[a:a + lot]
                    rows = [(*some[i], edit) for i, edit in candidates([w for w, _ in some], filters.value, alphabet)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                                         schema=schema)

    small_batches(words.sparkSession)
    probed = words.select("word", "n").mapInArrow(run, "word string, n long, edit string")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = cut(probed.join(known, F.col("edit") == F.col("near")).select("word", "n", "near", "near_n"), "spelling-pairs")
    back = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                        F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(back)


# ---- forms ---------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form or null) with ``root``. A form occurs at least
    TIMES as often as its word, so paths have no circles and are short; every
    round doubles the steps taken."""
    steps = cut(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        ahead = steps.select(F.col("word").alias("at"), F.col("root").alias("further")).where("at <> further")
        longer = cut(steps.join(ahead, F.col("root") == F.col("at"), "left")
                          .select("word", F.coalesce("further", "root").alias("root"),
                                  F.col("further").isNotNull().alias("moved")), "spelling-roots")
        steps = longer.drop("moved")
        if not longer.where("moved").limit(1).count():
            return steps


def variants(docs: DataFrame, salt: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             times: int = TIMES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of the vocabulary: word, form, root, n, n_near, form_n.

    A word is a run of letters of ``text_col`` with A-Z lowered, of at least
    ``min_length`` code points and ``min_count`` occurrences (n) in all texts.
    n_near is the number of near words; form is the one of largest n (ties:
    the smallest in code-point order) if its n is at least ``times`` the
    word's, else null, and form_n its n; root is reached from the word by
    following forms, the word itself without one. Null texts have no words; a
    null id counts as empty text in the salt's checksum. Repeated rows count
    each time. Other columns are ignored; an empty table gives no rows."""
    if times < 2:
        raise ValueError("a form must occur at least twice as often as its word")
    small_batches(docs.sparkSession)
    words = cut(word_counts(docs, salt, min_length, id_col, text_col).where(F.col("n") >= min_count), "spelling-words")
    near = (near_pairs(words).groupBy(F.col("word").alias("w"))
                             .agg(F.count(F.lit(1)).alias("n_near"),
                                  F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")))
    best_n = -F.col("best.m")
    fits = best_n >= times * F.col("n")
    forms = cut(words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", F.when(fits, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, best_n).alias("form_n")), "spelling-forms")
    rooted = roots(forms).withColumnRenamed("word", "w")
    return forms.join(rooted, F.col("word") == F.col("w")).select("word", "form", "root", "n", "n_near", "form_n")
