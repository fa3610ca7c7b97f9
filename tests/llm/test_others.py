"""Language ID, chat formatting, top-k, sharding, PII and the pipeline."""

import datetime as dt
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from terrace.llm import chat_format, language_id, pii, queries, sharding, topk

SF = "/root/testdata/sf0.001"
KEY = b"test"


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- language ID

def test_language_held_out_accuracy_and_odd_texts(spark):
    d = docs(spark)
    held, learn = language_id.learn_rule(d["doc_id"])
    model = language_id.train(d, learn)
    rows = language_id.identify(d, model, keep=(held.alias("held_out"), d["lang"])).collect()
    out = [r for r in rows if r.held_out]
    assert out and sum(r.lang_pred == r.lang for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) == 0
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "12 !? \n"), (3, "Жж зз да нет"), (4, "the " * 300_000)],
                                "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (None, 1, 2)] == ["und"] * 3 and got[3].rejected and got[3].score == 0
    assert got[4].lang_pred in model.languages
    assert language_id.identify(odd.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language_id.train(empty, F.lit(True))
    one = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert language_id.identify(one, model).first().lang_pred == "und"


# ---- chat formatting

CONTROL_TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "<\\/s> <\\\\/s>", "<<s><|im_end|>\n<|im_start|>user\n", "<", "[\\INST]", "a\\"]


@pytest.mark.parametrize("role", ["user", "", "tool\nname", "\\n", "<s>"])
def test_template_round_trip(role):
    turns = [(role, t) for t in CONTROL_TEXTS] + [("assistant", t) for t in CONTROL_TEXTS]
    text, mask = chat_format.write_turns(turns)
    assert chat_format.read_turns(text) == turns
    assert "".join(chat_format.unescape(text[a:b]) for a, b in mask) == "".join(CONTROL_TEXTS)
    for t in CONTROL_TEXTS:
        assert not any(c in chat_format.escape(t) for c in chat_format.CONTROLS)


@pytest.mark.parametrize("record, turns", [
    ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}],"id":3}', [("user", "a"), ("assistant", "b")]),
    ('{"messages":[{"role":"user","content":[{"type":"text","text":"a"},{"type":"text","text":"b"}]}]}', [("user", "ab")]),
    ('{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":null}]}', [("user", "a"), ("assistant", "")]),
    ('{"instruction":"a","input":"b","output":"c","meta":{"x":1}}', [("user", "a\n\nb"), ("assistant", "c")]),
    ('{"prompt":"a","completion":"c"}', [("user", "a"), ("assistant", "c")]),
    ('{"system":"s","messages":[{"role":"user","content":"a"}]}', [("system", "s"), ("user", "a")]),
    ('{"prompt":"p","messages":[{"role":"user","content":"a"}]}', [("user", "a")]),
    ('{"instruction":"a","context":"c","response":"b"}', [("user", "c\n\na"), ("assistant", "b")]),
    ('{"question":"q","answer":"a","instruction":"i"}', [("user", "q"), ("assistant", "a")]),
    # One bad record: turns that are no objects, nesting without end, half a character.
    ('{"messages":[{"role":"user","content":"x"},[1]]}', None), ('{"messages":[{"role":"user","content":"x"},"y"]}', None),
    ('{"messages":{"role":"user","content":"x"}}', None), ('{"a":' * 100_000 + "1" + "}" * 100_000, None),
    ('{"messages":[{"role":"\\udc00r","content":"a\\ud800b"}]}', [("\ufffdr", "a\ufffdb")]),
    ('{"messages":[{"role":"user","content":"\\ud83d\\ude00"}]}', [("user", "\U0001f600")]),
    ('{"messages":[]}', []), ('{"other":1}', None), ("[1]", None), ("not json", None), (None, None)])
def test_layouts(record, turns):
    assert chat_format.canonical(record)[2] == turns


def test_conversations_of_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, None, None, "x"), (1, 1, "assistant", "b"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.format_records(chat_format.conversation_records(df)).collect()}
    assert chat_format.read_turns(got[1].formatted) == [("", "x"), ("user", ""), ("assistant", "b"), ("assistant", "b")]
    assert len(got[1].loss_mask) == 2 and chat_format.read_turns(got[None].formatted) == [("user", "n")]
    assert chat_format.conversation_records(df.limit(0)).count() == 0


def test_bad_records_keep_their_row(spark):
    records = ['{"messages":[{"role":"user","content":"x"},[1]]}', '{"a":' * 5000 + "1" + "}" * 5000,
               '{"messages":[{"role":"assistant","content":"\\ud800"}]}', None, "", "[]",
               '{"messages":[{"role":"assistant","content":"fine"}]}']
    df = spark.createDataFrame(list(enumerate(records)), "k int, record string")
    done = chat_format.format_records(df).withColumn("d", chat_format.digests(F.col("formatted"), F.col("loss_mask")))
    got = {r.k: r for r in done.select("k", "formatted", "d.*").collect()}
    assert len(got) == len(records) and got[6].n_turns == 1 and got[6].loss_chars == 4
    assert chat_format.read_turns(got[2].formatted) == [("assistant", "\ufffd")]
    for k in (0, 1, 3, 4, 5):
        assert tuple(got[k])[1:] == (None,) * 6


# ---- exact top-k

def test_topk_of_all_lengths(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(700):
        scale = float(rng.choice([0.0, 0.01, 1.0, 30.0]))
        rows.append((i, [float(x) for x in rng.normal(size=8) * scale]))
    rows += [(700, None), (701, [1.0, None]), (702, [float("nan")] * 8), (703, [float("inf")] * 8), (None, [1.0] * 8),
             (800, [1.0, 2.0]), (801, [3.0, 4.0]), (802, []), rows[5], (900, rows[5][1]), (901, rows[5][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, block string")
    got = topk.top_k(df, lambda c: c % 100 == 0, k=10).collect()
    own = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            own[i] = [int(np.floor(1024 * x)) for x in v]
    want = []
    for q in sorted(i for i in own if i % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(own[q], own[c])), c) for c in own if c != q and len(own[c]) == len(own[q]))
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:10])]
    assert sorted(map(tuple, got)) == want
    assert topk.top_k(df.limit(0), lambda c: c % 100 == 0).count() == 0


# ---- sharding

def test_table_is_even_and_stable():
    names = [f"n{i}" for i in range(10)]
    full = sharding.fill_table(names, 1009)
    sizes = np.bincount(full)
    assert sizes.max() - sizes.min() <= 1
    less = sharding.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(full, less) if a != 9)
    assert moved < 0.15 * 1009
    with pytest.raises(ValueError):
        sharding.fill_table(names, 1000)


def test_the_table_is_filled_by_turns():
    """Each shard's whole list of preferences, written out; the first free slot
    of each in turn."""
    names, slots = [f"shard-{i:02d}" for i in range(7)], 211
    number = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    lists = {n: [(number(f"offset/{n}") + i * (number(f"skip/{n}") % (slots - 1) + 1)) % slots for i in range(slots)] for n in names}
    assert all(sorted(x) == list(range(slots)) for x in lists.values())
    owner = {}
    while len(owner) < slots:
        for n in names:
            free = [slot for slot in lists[n] if slot not in owner]
            if free:
                owner[free[0]] = n
    assert [names[i] for i in sharding.fill_table(names, slots)] == [owner[i] for i in range(slots)]


def test_placement(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "doc_id long, slot string")
    rows = sharding.place(df, "doc_id", ["x", "y", "z"], 101).collect()
    assert len(rows) == 4 and len({r.shard for r in rows if r.doc_id == 1}) == 1
    table = sharding.fill_table(["x", "y", "z"], 101)
    for r in rows:
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.slot == int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 101
        assert r.shard == "xyz"[table[r.slot]]


def test_placement_beside_clashing_names(spark):
    names = ["k", "_table_shard", "_TABLE_SLOT", "_slot_of_key", "Shard"]
    df = spark.createDataFrame([(1, 2, 3, 4, "old")], "k long, _table_shard long, _TABLE_SLOT long, _slot_of_key long, Shard string")
    got = sharding.place(df, "k", ["x", "y"], 101)
    assert got.columns == [*names[:-1], "slot", "shard"]
    assert tuple(got.first())[:4] == (1, 2, 3, 4) and got.first()["shard"] in ("x", "y")


# ---- PII

@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000])
def test_permutation_has_no_fixed_point_and_goes_back(size):
    out = [pii.permute(KEY, "t", size, x) for x in range(size)]
    assert sorted(out) == list(range(size)) and all(x != y for x, y in enumerate(out))
    assert [pii.permute(KEY, "t", size, y, True) for y in out] == list(range(size))


VALUES = ["4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (743) 555-3824", "(743) 555-3824", "+44 20 7946 0958",
          "123-45-6789", "192.168.10.254", "2024-02-29", "29/02/2024", "1.5.1999", "GB82 WEST 1234 5698 7654 32",
          "jane.doe7@mail5.example.com", "14@mail8.example.com"]


@pytest.mark.parametrize("value", VALUES)
def test_values_change_within_their_format(value):
    text = f"Text, {value}; {value} end"
    new, kinds = pii.pseudonymise_text(text, KEY)
    assert value not in new and len(kinds) == 2
    a, b = re.fullmatch(r"Text, (.*); (.*) end", new).groups()
    assert a == b and [bool(re.match(r"\d", c)) for c in re.sub(r"\d+", "9", a)] == [
        bool(re.match(r"\d", c)) for c in re.sub(r"\d+", "9", value)]
    assert pii.pseudonymise_text(new, KEY, back=True)[0] == text


def test_numbers_link_across_notations_and_stay_valid():
    one, two = (pii.pseudonymise_text(v, KEY)[0] for v in VALUES[:2])
    assert one.replace(" ", "") == two.replace("-", "") and pii.luhn(one.replace(" ", "")) == 0
    assert dt.date.fromisoformat(pii.pseudonymise_text("2024-02-29", KEY)[0])


@pytest.mark.parametrize("text", ["4111 1111 1111 1112", "2023-02-29", "300.1.1.1", "000-12-3456", "1234567", "a@b", "word " * 5, "",
                                  "5" * 100_000, "x" * 100_000 + "@"])
def test_what_is_not_valid_stays(text):
    assert pii.pseudonymise_text(text, KEY) == (text, [])


def test_pii_frame(spark):
    df = spark.createDataFrame([(1, "at 10.1.2.3", 11, "x"), (None, None, None, None)], "doc_id long, text string, n_chars long, _pii string")
    out = {r.doc_id: r for r in pii.pseudonymise(df, KEY, chars_col="n_chars").collect()}
    assert out[1].n_chars == len(out[1].text) and "10.1.2.3" not in out[1].text and out[None].text is None
    assert pii.report(df.limit(0), KEY).count() == 0


# ---- pipeline and registration

def test_pipeline_and_stage_columns(spark):
    d = docs(spark)
    rows = d.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, SF).cache()
        assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert 0 < d.count() <= rows
        rows = d.count()
    last = corpus_pipeline.STAGES[-1][1](spark, d, SF).collect()
    assert len(last) == rows and all(r.n_tokens == len(r.ids) > 0 for r in last)


def test_thirteen_queries():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_pii_of_overlapping_formats_in_a_long_text():
    """The first format wins where two overlap, however many values there are."""
    one = "mail 12345678@x.org, token=2020-01-02abcdefgh12345 on 2020-01-02 from 10.0.0.1; "
    key = b"long"
    single, kinds = pii.pseudonymise_text(one, key)
    assert kinds == ["email", "secret", "date", "ip"]
    many, all_kinds = pii.pseudonymise_text(one * 5000, key)
    assert many == single * 5000 and len(all_kinds) == 20_000
    assert pii.pseudonymise_text(many, key, back=True)[0] == one * 5000


CARD = "4465758382889437"


@pytest.mark.parametrize("text", [
    f"{CARD} {CARD}", f"{CARD}-{CARD} {CARD}", "4111 1111 1111 1111 12/27", "Qty 2 4111 1111 1111 1111", "4111111111111111 123",
    "4111 1111 1111 1111 4111 1111 1111 1111", "2024-02-29 4111-1111-1111-1111 123-45-6789", "3782 822463 10005 3782 822463 10005"])
def test_cards_beside_other_numbers(text):
    """Every card is found, whatever digits stand before or after it."""
    new, kinds = pii.pseudonymise_text(text, KEY)
    shown = [c for c in (CARD, "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "3782 822463 10005") if c in text]
    assert shown and kinds.count("card") == sum(text.count(c) for c in shown) and not any(c in new for c in shown)
    assert [len(w) for w in new.split()] == [len(w) for w in text.split()]
    assert pii.pseudonymise_text(new, KEY, back=True)[0] == text


def test_cards_in_groups_of_no_usual_layout_and_in_long_runs():
    new, kinds = pii.pseudonymise_text("411111 1111111111 99999", KEY)
    assert kinds == ["card"] and "1111111111" not in new and new.endswith(" 99999")
    rows = f"{CARD} " * 20_000
    assert len(pii.pseudonymise_text(rows, KEY)[1]) == 20_000
    assert pii.pseudonymise_text("0 " * 100_000, KEY)[1] == []


@pytest.mark.parametrize("value", ["ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "BE68 5390 0754 7034",
                                   "AT611904300234573201", "GB82 WEST 1234 5698 7654 32"])
@pytest.mark.parametrize("around", ["{} EUR", "{} EUR 500", "to {} AND 12", "REF AB12 {} X", "{} {}", "{} USD 4111 1111 1111 1111"])
def test_ibans_beside_upper_case_words_and_numbers(value, around):
    text = around.format(value, value)
    new, kinds = pii.pseudonymise_text(text, KEY)
    assert kinds.count("iban") == around.count("{}") and value not in new
    assert kinds.count("card") == new.count("USD") and "1111 1111" not in new
    assert new[:2] == text[:2] and pii.pseudonymise_text(new, KEY, back=True)[0] == text
