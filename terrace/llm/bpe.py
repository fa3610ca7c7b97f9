"""Byte-level BPE encoding by speculation and verification, and decoding.

A text is cut at the special token strings and then into words by the public
split pattern. Each distinct word is encoded once per batch:

1. *Speculate*: greedy longest match proposes tokens from the left.
2. *Verify*: the proposal is the BPE result if and only if no merge fires
   across any boundary between adjacent tokens. Whether one does depends only
   on the two tokens, so all distinct adjacent pairs are tested together, as
   arrays.
3. *Mend*: where a pair fails, the bytes of its two tokens are merged exactly;
   the pairs at the borders of what comes out are tested again, and while one
   of them fails its token is taken into the merge too. A sequence in which
   every adjacent pair holds is the BPE result, so the rest of the word stays.

When a merge fires. A token was built by a chain of merges; its right spine
is the token, its right half, that half's right half, and so on, down to a
byte; its left spine likewise. A spine piece is alive from the merge that
makes it until the merge that makes the next larger piece. A merge (x, y)
crosses the boundary l | r if x is on l's right spine, y on r's left spine,
and the merge's rank falls in both lifetimes. Merges of equal rank run from
left to right: on l the larger piece has then been made already, on r not yet.
This needs merge lists in which both halves of a merge are made by earlier
merges, and tokens that encode to themselves; both are checked when the
vocabulary is loaded, and tokens that break the rule are never proposed.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from dataclasses import dataclass, field
from itertools import chain
from struct import pack

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import column, free_name, small_batches

# Fixed value: the public split pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = 1 << 40                        # a rank later than any merge
CACHE_WORDS = 60_000                   # distinct words in each of two generations per Python worker
CACHE_PAIRS = 150_000                  # verified pairs kept per Python worker
CACHE_SPANS = 60_000                   # mended byte spans kept per Python worker
SEPARATOR = b"\xff"                    # a byte that no UTF-8 text holds
SPAN_BYTES = 24                        # longer spans are not kept
LONG_MERGE = 100                       # bytes; longer words are merged with a heap
LONG_WORD = 400                        # bytes; longer words skip the cache


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    visible Latin-1 characters stand for themselves, the other bytes, in
    order, for the characters from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def check_supported(spec: dict) -> None:
    """Refuse a tokenizer file whose settings would change the ids in a way
    that is not built here (ValueError naming the setting)."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    flags = ("single_word", "lstrip", "rstrip", "normalized")
    unsupported = [name for name, found in {
        "normalizer": spec.get("normalizer"),
        "model.type": model.get("type", "BPE") != "BPE",
        "model.dropout": model.get("dropout"),
        "model.unk_token": model.get("unk_token"),
        "model.continuing_subword_prefix": model.get("continuing_subword_prefix"),
        "model.end_of_word_suffix": model.get("end_of_word_suffix"),
        "model.byte_fallback": model.get("byte_fallback"),
        "model.ignore_merges": model.get("ignore_merges"),
        "pre_tokenizer.type": pre.get("type") != "ByteLevel",
        "pre_tokenizer.add_prefix_space": pre.get("add_prefix_space"),
        "pre_tokenizer.use_regex": not pre.get("use_regex", True),
        "added_tokens": any(t.get(f) for t in spec.get("added_tokens", []) for f in flags),
    }.items() if found]
    if unsupported:
        raise ValueError("tokenizer settings that are not supported: " + ", ".join(unsupported))


def read_vocabulary(path: str) -> dict:
    """The parts of a tokenizer file that encoding needs, as plain data that
    can be broadcast (its size is the vocabulary's, not the corpus')."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    check_supported(spec)
    symbols = byte_symbols()
    raw = lambda s: bytes(symbols[c] for c in s)
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    return {"vocab": {raw(t): i for t, i in spec["model"]["vocab"].items()},
            "merges": [(raw(a), raw(b)) for a, b in merges],
            "special": {t["content"]: t["id"] for t in spec["added_tokens"]}}


@dataclass
class Encoder:
    """Vocabulary, spine tables and the caches of one Python worker."""
    vocab: dict[bytes, int]
    special: dict[str, int]
    ranks: dict[tuple[int, int], tuple[int, int]]       # pair of ids: (rank, merged id)
    matcher: ahocorasick.Automaton = field(repr=False)  # tokens that may be proposed
    pieces: list                                        # id to bytes
    right: np.ndarray = field(repr=False)               # spine piece ids, -1 beyond the end
    left: np.ndarray = field(repr=False)
    birth: np.ndarray = field(repr=False)               # rank of the merge that makes a token
    pair_keys: np.ndarray = field(repr=False)
    pair_ranks: np.ndarray = field(repr=False)
    right_spines: list = field(repr=False)              # the same spines as tuples
    left_spines: list = field(repr=False)
    births: list = field(repr=False)
    fixed: dict[str, bytes] = field(default_factory=dict, repr=False)     # special tokens
    words: dict[str, bytes] = field(default_factory=dict, repr=False)
    older: dict[str, bytes] = field(default_factory=dict, repr=False)     # the generation before
    verdicts: dict[int, bool] = field(default_factory=dict, repr=False)
    spans: dict[bytes, list] = field(default_factory=dict, repr=False)
    merged_bytes: int = 0                               # bytes that went through exact merging

    # ---- exact merging -----------------------------------------------------

    def merge(self, word: bytes) -> list[int]:
        """BPE by definition: merge the pair of lowest rank, leftmost first,
        every occurrence, until none is left."""
        ids = [self.vocab[word[i:i + 1]] for i in range(len(word))]
        ranks = self.ranks
        while len(ids) > 1:
            best = min((ranks[p] for p in zip(ids, ids[1:]) if p in ranks), default=None)
            if best is None:
                break
            out, i, n = [], 0, len(ids)
            while i < n:
                if i + 1 < n and ranks.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def merge_long(self, word: bytes) -> list[int]:
        """The same result for long words, in n log n: a heap of (rank,
        position) over a linked list of pieces."""
        ids = [self.vocab[word[i:i + 1]] for i in range(len(word))]
        n, ranks = len(ids), self.ranks
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] is None or j >= n or (ids[i], ids[j]) != pair:
                continue                              # a piece has gone meanwhile
            ids[i], ids[j], nxt[i] = ranks[pair][1], None, nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            for a, b in ((prev[i], i), (i, nxt[i])):
                if a >= 0 and b < n and (ids[a], ids[b]) in ranks:
                    p = (ids[a], ids[b])
                    heapq.heappush(heap, (ranks[p][0], a, p))
        return [i for i in ids if i is not None]

    # ---- speculation -------------------------------------------------------

    def propose(self, words: list[bytes]) -> np.ndarray:
        """Greedy longest match of all words, from the left: their token ids
        one after another, -1 between words. Every byte is a token, so that
        the longest matches that do not overlap are the greedy ones."""
        text = SEPARATOR.join(words).decode("latin-1")
        return np.fromiter((i for _, i in self.matcher.iter_long(text)), np.int64)

    # ---- verification ------------------------------------------------------

    def first_merge(self, pairs: np.ndarray) -> np.ndarray:
        """For an (n, 2) array of adjacent token ids: rank of the first merge
        that crosses the boundary (NEVER if none does)."""
        out = np.full(len(pairs), NEVER, np.int64)
        lefts, rights, birth = self.right[pairs[:, 0]], self.left[pairs[:, 1]], self.birth
        for i in range(lefts.shape[1]):
            x = lefts[:, i]
            if (x < 0).all():
                break
            x_until = np.where(i == 0, NEVER, birth[lefts[:, i - 1]])
            for j in range(rights.shape[1]):
                y = rights[:, j]
                if (y < 0).all():
                    break
                y_until = np.where(j == 0, NEVER, birth[rights[:, j - 1]])
                key = x * len(birth) + y
                at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
                rank = self.pair_ranks[at]
                fires = ((x >= 0) & (y >= 0) & (self.pair_keys[at] == key)
                         & (rank > birth[x]) & (rank < x_until)
                         & (rank > birth[y]) & (rank <= y_until))
                out = np.where(fires, np.minimum(out, rank), out)
        return out

    def holds(self, left: int, right: int) -> bool:
        """Whether no merge crosses the boundary of one pair of tokens."""
        known, key = self.verdicts, left * len(self.births) + right
        verdict = known.get(key)
        if verdict is None:
            if len(known) > CACHE_PAIRS:
                known.clear()
            verdict = known[key] = self._holds(left, right)
        return verdict

    def _holds(self, left: int, right: int) -> bool:
        births, ranks, rights = self.births, self.ranks, self.left_spines[right]
        x_until = NEVER
        for x in self.right_spines[left]:
            y_until = NEVER
            for y in rights:
                merge = ranks.get((x, y))
                if merge is not None and births[x] < merge[0] < x_until and births[y] < merge[0] <= y_until:
                    return False
                y_until = births[y]
            x_until = births[x]
        return True

    # ---- mending -----------------------------------------------------------

    def _span(self, span: bytes) -> list[int]:
        ids = self.spans.get(span)
        if ids is None:
            self.merged_bytes += len(span)
            ids = self.merge(span) if len(span) <= LONG_MERGE else self.merge_long(span)
            if len(span) <= SPAN_BYTES:
                if len(self.spans) > CACHE_SPANS:
                    self.spans.clear()
                self.spans[span] = ids
        return ids

    def mend(self, ids: list[int], failing: list[int]) -> list[int]:
        """The BPE result of the bytes of ``ids``, where the pairs that start
        at ``failing`` (ascending) do not hold and all others do. ``out`` is
        always the result for the bytes before token ``at``."""
        holds, pieces, out, at, widened = self.holds, self.pieces, [], 0, 0
        for first in failing:
            if first + 1 < at:
                continue
            if first >= at:
                out += ids[at:first + 1]
                at = first + 1
            while at < len(ids):
                token = ids[at]
                at += 1
                if holds(out[-1], token):
                    out.append(token)
                    break
                span, part = pieces[token], None
                while part is None or out and not holds(out[-1], part[0]):
                    widened += 1
                    if widened > len(ids) + 8:         # long chains: merge the whole word once
                        return self._span(b"".join(pieces[i] for i in ids))
                    span = pieces[out.pop()] + span
                    part = self._span(span)
                out += part
        return out + ids[at:]

    # ---- words and texts ---------------------------------------------------

    def code_words(self, words: list[bytes]) -> list[bytes]:
        """Token ids (little-endian unsigned 32-bit) of each word: speculate,
        verify all pairs, mend."""
        if not words:
            return []
        found, size = self.propose(words), len(self.birth)
        ends = np.append(np.flatnonzero(found < 0), len(found))
        starts = np.append(0, ends[:-1] + 1)
        inner = np.flatnonzero((found[:-1] >= 0) & (found[1:] >= 0))
        keys, where = np.unique(found[inner] * size + found[inner + 1], return_inverse=True)
        bad = inner[~self._verdicts(keys)[where]]
        owner = np.searchsorted(ends, bad)
        coded = found.astype("<u4").tobytes()
        out = [coded[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]
        first, last = starts[owner].tolist(), ends[owner].tolist()
        group: list[int] = []
        for i, (w, at) in enumerate(zip(owner.tolist(), bad.tolist())):
            group.append(at - first[i])
            if i + 1 == len(bad) or owner[i + 1] != w:
                ids = self.mend(found[first[i]:last[i]].tolist(), group)
                out[w] = pack(f"<{len(ids)}I", *ids)
                group = []
        return out

    def _verdicts(self, keys: np.ndarray) -> np.ndarray:
        known, size = self.verdicts, len(self.birth)
        new = np.array([k for k in keys.tolist() if k not in known], np.int64)
        if len(new):
            if len(known) > CACHE_PAIRS:
                known.clear()
                new = keys
            known.update(zip(
                new.tolist(),
                (self.first_merge(np.stack([new // size, new % size], 1)) == NEVER).tolist()))
        return np.array([known[k] for k in keys.tolist()], bool)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids (unsigned 32-bit) of every text.

        Words are kept in two generations: the younger takes every word used
        since the last change; when it is full it becomes the older one, so
        that words in use stay and the others go."""
        parts = [self._split(t) for t in texts]
        used = set().union(*parts)
        young, older = self.words, self.older
        look = dict(self.fixed)
        new = []
        for w in used:
            b = young.get(w)
            if b is None:
                b = older.get(w)
                if b is None:
                    if w not in look:
                        new.append(w)
                    continue
                young[w] = b
            look[w] = b
        for a in range(0, len(new), CACHE_WORDS):
            some = new[a:a + CACHE_WORDS]
            look.update(zip(some, self.code_words([w.encode("utf-8") for w in some])))
        for w in new:
            if len(young) >= CACHE_WORDS:
                break
            if len(w) <= LONG_WORD:
                young[w] = look[w]
        if len(young) >= CACHE_WORDS:
            self.words, self.older = {}, young
        return [np.frombuffer(b"".join(map(look.__getitem__, ws)), "<u4") for ws in parts]

    def _split(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return WORDS.findall(text)
        out = []
        for piece in regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text):
            out += [piece] if piece in self.special else WORDS.findall(piece)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of token ids; bytes that are no UTF-8 become U+FFFD. Ids outside
        the vocabulary, negative ones among them, stand for no text."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.pieces)):
            ids = ids[(ids >= 0) & (ids < len(self.pieces))]
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


WORDS = regex.compile(PATTERN)


def build_encoder(data: dict) -> Encoder:
    """Spine tables of a vocabulary read by ``read_vocabulary``."""
    vocab, special = data["vocab"], data["special"]
    size = max([*vocab.values(), *special.values()]) + 1
    birth = np.full(size, NEVER, np.int64)
    halves: dict[int, tuple[int, int]] = {}
    ranks: dict[tuple[int, int], tuple[int, int]] = {}
    for t, i in vocab.items():
        if len(t) == 1:
            birth[i] = -1
    for rank, (a, b) in enumerate(data["merges"]):
        pair, made = (vocab[a], vocab[b]), vocab[a + b]
        ranks.setdefault(pair, (rank, made))
        if birth[made] == NEVER and birth[pair[0]] < rank and birth[pair[1]] < rank:
            birth[made] = rank
            halves[made] = pair

    def spine(token, side):
        out = [token]
        while out[-1] in halves:
            out.append(halves[out[-1]][side])
        return out

    def table(side):
        rows = [spine(i, side) for i in range(size)]
        out = np.full((size, max(map(len, rows))), -1, np.int64)
        for i, r in enumerate(rows):
            out[i, :len(r)] = r
        return out

    pieces = [b""] * size
    for t, i in vocab.items():
        pieces[i] = t
    order = sorted((x * size + y, rank) for (x, y), (rank, _) in ranks.items())
    enc = Encoder(vocab, special, ranks, ahocorasick.Automaton(), pieces,
                  table(1), table(0), birth,
                  np.array([k for k, _ in order], np.int64), np.array([r for _, r in order], np.int64),
                  [tuple(spine(i, 1)) for i in range(size)], [tuple(spine(i, 0)) for i in range(size)],
                  birth.tolist())
    # A token may be proposed if it is a byte, or if its last merge joins two
    # such tokens and no other merge fires across that joint before.
    made = sorted(halves, key=lambda i: birth[i])
    joints = np.array([halves[i] for i in made], np.int64).reshape(-1, 2)
    first = enc.first_merge(joints)
    good = {i for i in vocab.values() if birth[i] == -1}
    for i, f in zip(made, first.tolist()):
        if f == birth[i] and halves[i][0] in good and halves[i][1] in good:
            good.add(i)
    for t, i in vocab.items():
        if i in good and SEPARATOR not in t:
            enc.matcher.add_word(t.decode("latin-1"), i)
    enc.matcher.add_word(SEPARATOR.decode("latin-1"), -1)
    enc.matcher.make_automaton()
    for text, i in special.items():
        pieces[i] = text.encode("utf-8")
        enc.fixed[text] = np.array([i], "<u4").tobytes()
    return enc


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """The worker's encoder for a broadcast vocabulary, built once."""
    if shared.bid not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[shared.bid] = build_encoder(shared.data.value)
    return _ENCODERS[shared.bid]


class _Shared:
    """A broadcast vocabulary and its number, small enough for a closure."""

    def __init__(self, spark, data):
        self.data = spark.sparkContext.broadcast(data)
        self.bid = self.data._jbroadcast.id()

    def __getstate__(self):
        return {"data": self.data, "bid": self.bid}


def encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids_col`` (array of int) of token ids of the
    whole text. Null texts count as empty and have no ids. Special token
    strings in a text become their ids. A column of that name is replaced; all
    others are kept."""
    small_batches(docs.sparkSession)
    shared = _Shared(docs.sparkSession, read_vocabulary(vocabulary_path))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def bpe_encode(texts: pd.Series) -> pd.Series:
        ids = _encoder(shared).encode_batch([t or "" for t in texts])
        return pd.Series([i.astype(np.int32) for i in ids], dtype=object)

    return docs.withColumn(ids_col, bpe_encode(column(docs, text_col)))


def _whole(ids) -> np.ndarray:
    """Ids as integers, nulls as -1 (Arrow hands over arrays with nulls as
    floating point or as objects)."""
    ids = np.asarray(ids)
    if ids.dtype.kind == "i":
        return ids.astype(np.int64)
    return np.array([-1 if x is None or x != x else int(x) for x in ids.tolist()], np.int64)


def decode(rows: DataFrame, vocabulary_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with a column ``text_col``: the text of the ids (special tokens
    included). A null array gives null; null ids and ids outside the vocabulary
    within an array stand for no text."""
    small_batches(rows.sparkSession)
    shared = _Shared(rows.sparkSession, read_vocabulary(vocabulary_path))

    @F.pandas_udf(T.StringType())
    def bpe_decode(ids: pd.Series) -> pd.Series:
        enc = _encoder(shared)
        return pd.Series([None if i is None else enc.decode(_whole(i)) for i in ids], dtype=object)

    return rows.withColumn(text_col, bpe_decode(column(rows, ids_col)))


def round_trip(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Digests of encoding and decoding every text in one pass: doc_id,
    n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers) and
    decoded_sha256 (the text decoded from the ids, in UTF-8). One row per row
    of ``docs``; null texts count as empty; an empty table gives no rows."""
    small_batches(docs.sparkSession)
    shared = _Shared(docs.sparkSession, read_vocabulary(vocabulary_path))
    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                         T.StructField("decoded_sha256", T.StringType())])

    @F.pandas_udf(kind)
    def digests(texts: pd.Series) -> pd.DataFrame:
        enc, rows = _encoder(shared), []
        for ids in enc.encode_batch([t or "" for t in texts]):
            text = enc.decode(ids)
            rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                         hashlib.sha256(text.encode("utf-8")).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    name = free_name(docs, "_digest")
    return (docs.select(column(docs, id_col).alias("doc_id"), digests(column(docs, text_col)).alias(name))
                .select("doc_id", f"{name}.*"))
