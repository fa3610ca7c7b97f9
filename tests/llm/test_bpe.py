import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from terrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("ids", T.StringType()), T.StructField("_digest", T.StringType())])


@pytest.fixture(scope="module")
def encoder():
    return bpe.build_encoder(bpe.read_vocabulary(PATH))


@pytest.fixture(scope="module")
def public():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def samples():
    rng = random.Random(3)
    out = ["", " ", "\n\n  x", "a" * 3000, "ab" * 500, "<|endoftext|>", "x<|endoftext|><|endoftext|> y ",
           "I'll don't we've THE'LL 's", "tab\tand\x0b\x0c\r\n\x1c\x1d\x85  ​ end",
           "é Ж 你好 🙂🙂 \U0001f469‍\U0001f4bb é", "1234567890²½Ⅷ", "\x00\x01\x7f�"]
    pieces = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "tion", "ing", "é", "ouo", "ß",
              " ", " ", "\n", "  ", ".", ",", "1", "99", "-", "'s", "<|endo"]
    for _ in range(400):
        out.append("".join(rng.choice(pieces) for _ in range(rng.randint(1, 120))))
    for _ in range(300):
        out.append("".join(chr(rng.choice((rng.randrange(32, 127), rng.randrange(32, 0x2000),
                                           rng.randrange(0x10000, 0x20000)))) for _ in range(40)))
    return out


def test_encode_and_decode_as_the_library(encoder, public):
    texts = samples()
    want = [e.ids for e in public.encode_batch(texts, add_special_tokens=False)]
    got = encoder.encode_batch(texts)
    for text, g, w in zip(texts, got, want):
        assert g.tolist() == w, text
        assert encoder.decode(g) == public.decode(w, skip_special_tokens=False) == text


def test_every_character_splits_as_the_library(encoder, public):
    """Each code point between letters, digits and spaces."""
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and c < 0x30000]
    texts = [f"a{c}b {c}1 {c}{c} " for c in chars]
    want = public.encode_batch(texts, add_special_tokens=False)
    got = encoder.encode_batch(texts)
    assert [hex(ord(c)) for c, g, w in zip(chars, got, want) if g.tolist() != w.ids] == []


def encode_words(encoder, words):
    return [np.frombuffer(b, "<u4").tolist() for b in encoder.code_words(words)]


def longest_match(encoder, word, tokens):
    out, at = [], 0
    while at < len(word):
        end = next(e for e in range(len(word), at, -1) if word[at:e] in tokens)
        out.append(tokens[word[at:end]])
        at = end
    return out


def test_the_proposal_is_the_greedy_longest_match(encoder):
    rng = random.Random(6)
    tokens = {k.encode("latin-1"): v for k, v in encoder.matcher.items()}
    for _ in range(2000):
        word = "".join(rng.choice("etaoinsh rdlu\n=-aé你") for _ in range(rng.randint(1, 30))).encode()
        assert encoder.propose([word]).tolist() == longest_match(encoder, word, tokens)


def test_speculation_is_verified(encoder):
    """Exact merging of every word agrees, and the speculation both holds and
    fails somewhere, so that both ways are covered."""
    rng = random.Random(4)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 14))).encode() for _ in range(5000)]
    exact = [encoder.merge(w) for w in words]
    assert encode_words(encoder, words) == exact
    assert [encoder.merge_long(w) for w in words] == exact
    same = sum(encoder.propose([w]).tolist() == e for w, e in zip(words, exact))
    assert 0 < same < len(words)


def test_words_past_the_cache(encoder, public, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 10)
    monkeypatch.setattr(bpe, "CACHE_SPANS", 5)
    texts = samples()[:60]
    for _ in range(2):
        got = [g.tolist() for g in encoder.encode_batch(texts)]
        assert got == [e.ids for e in public.encode_batch(texts, add_special_tokens=False)]


def test_query_digests(spark, public):
    rows = [(i, t, "x", "y") for i, t in enumerate(samples()[:40])] + [(None, None, "x", "y"), (0, "", None, None)]
    df = spark.createDataFrame(rows, DOCS)
    got = bpe.round_trip(df, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for i, t, _, _ in rows:
        ids = public.encode(t or "", add_special_tokens=False).ids
        text = public.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert bpe.round_trip(df.limit(0), PATH).count() == 0


def test_encode_then_decode_frames(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(samples()[:40])] + [(None, None, "x", "y")]
    df = spark.createDataFrame(rows, DOCS)
    out = bpe.decode(bpe.encode(df, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "_digest", "decoded"]
    assert all(r.decoded == (r.text or "") for r in out.collect())


def test_words_in_use_stay_and_others_go(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 4)
    enc = bpe.build_encoder(bpe.read_vocabulary(PATH))
    for i in range(20):
        enc.encode_batch([f"stay x{chr(97 + i)}q"])
        assert len(enc.words) + len(enc.older) <= 8
    assert "stay" in {**enc.words, **enc.older}
    assert " xaq" not in {**enc.words, **enc.older}


def test_only_the_failing_places_are_merged():
    """Long words that fail at one place go through exact merging there only."""
    enc = bpe.build_encoder(bpe.read_vocabulary(PATH))
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 40))).encode() for _ in range(3000)]
    exact = [enc.merge(w) for w in words]
    assert encode_words(enc, words) == exact
    whole = sum(len(w) for w, e in zip(words, exact) if enc.propose([w]).tolist() != e)
    assert 0 < enc.merged_bytes < 0.8 * whole
    done = enc.merged_bytes
    encode_words(enc, words)
    assert enc.merged_bytes < 1.2 * done         # spans already mended are known


def test_long_chains_of_one_piece(encoder, public):
    texts = ["a" * n for n in (7, 31, 500)] + ["=-" * 300, "ing" * 200, "aab" * 99, "x" * 65 + "xy" * 70]
    want = [e.ids for e in public.encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in encoder.encode_batch(texts)] == want


def test_decode_ids_outside_the_vocabulary(spark, encoder):
    rows = [(1, [64, None, 65]), (2, [-1, 64]), (3, [10**9, 65]), (4, None), (5, [])]
    got = {r["k"]: r["decoded"] for r in bpe.decode(
        spark.createDataFrame(rows, "k long, ids array<int>"), PATH).collect()}
    a, b = (encoder.pieces[i].decode() for i in (64, 65))
    assert got == {1: a + b, 2: a, 3: b, 4: None, 5: ""}


def test_other_tokenizer_files_are_refused(tmp_path):
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    for change, name in (({"normalizer": {"type": "NFC"}}, "normalizer"),
                         ({"pre_tokenizer": {"type": "Whitespace"}}, "pre_tokenizer.type"),
                         ({"model": spec["model"] | {"ignore_merges": True}}, "model.ignore_merges")):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(spec | change))
        with pytest.raises(ValueError, match=name):
            bpe.read_vocabulary(str(path))
