"""Chat formatting by schema fingerprints.

A record is a JSON object in one of several layouts (messages, from/value
pairs, prompt and completion, instruction and output ...). The paths of its
nested fields, restricted to those that any layout knows, are sorted and
hashed; the hash selects a declarative mapping that turns the record into
canonical turns (role, text). Turns are written with control strings around
them; control strings inside texts are escaped reversibly, so the output can
be read back exactly. The loss mask lists where assistant texts stand.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import column, free_name, small_batches

# ---- layouts ----------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """``needs``: paths that every record of the layout has; ``may``: paths it
    may have. ``turns`` (with ``role`` and ``text`` inside each) or ``fields``
    ((role, path), in order) say where the turns are."""
    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), ("system",),
           turns="messages", role="role", text="content", fields=(("system", "system"),)),
    Layout("message parts", ("messages[].role", "messages[].content[].text"),
           ("messages[].content", "messages[].content[].type", "system"),
           turns="messages", role="role", text="content", fields=(("system", "system"),)),
    Layout("no messages", ("messages[]",), turns="messages", role="role", text="content"),
    Layout("from and value", ("conversations[].from", "conversations[].value"), ("system",),
           turns="conversations", role="from", text="value", fields=(("system", "system"),)),
    Layout("dialogue", ("dialogue[].speaker", "dialogue[].text"), turns="dialogue", role="speaker", text="text"),
    Layout("instruction", ("instruction", "output"), ("input", "system"),
           fields=(("system", "system"), ("user", "instruction+input"), ("assistant", "output"))),
    Layout("instruction and response", ("instruction", "response"), ("context", "system"),
           fields=(("system", "system"), ("user", "context+instruction"), ("assistant", "response"))),
    Layout("completion", ("prompt", "completion"), ("system",),
           fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Layout("response", ("prompt", "response"), ("system",),
           fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question", ("question", "answer"), ("context",),
           fields=(("user", "context+question"), ("assistant", "answer"))),
)
# Names that layouts use for the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
KNOWN = frozenset(p for x in LAYOUTS for p in (*x.needs, *x.may))


def paths(value, at: str = "") -> set[str]:
    """Paths of the leaves of a JSON value; an empty list is a leaf."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(found: set[str]) -> str:
    """Hash of the known paths among ``found``, in sorted order."""
    return hashlib.sha256("\n".join(sorted(found & KNOWN)).encode()).hexdigest()[:16]


def registry(layouts=LAYOUTS) -> dict[str, Layout]:
    """Layout of every fingerprint: the needed paths with any of the others."""
    out: dict[str, Layout] = {}
    for x in layouts:
        for n in range(len(x.may) + 1):
            for some in combinations(x.may, n):
                out.setdefault(fingerprint({*x.needs, *some}), x)
    return out


REGISTRY = registry()


def layout_of(found: set[str]) -> Layout | None:
    """The layout of a fingerprint. A record that also has known fields of
    another layout takes the first one whose needed fields it has, by the
    fingerprint of that layout's own fields."""
    exact = REGISTRY.get(fingerprint(found))
    if exact is not None:
        return exact
    for x in LAYOUTS:
        if found.issuperset(x.needs):
            return REGISTRY.get(fingerprint(found & {*x.needs, *x.may}))
    return None


_SURROGATE = re.compile("[\ud800-\udfff]")


def _plain(value) -> str:
    """Text of a content value: a string, or the texts of a list of parts.
    Lone surrogates, which no text in UTF-8 can hold, become U+FFFD."""
    if value is None:
        return ""
    if isinstance(value, list):
        return "".join(_plain(p.get("text") if isinstance(p, dict) else p) for p in value)
    return _SURROGATE.sub("\ufffd", value if isinstance(value, str) else json.dumps(value, ensure_ascii=False))


def canonical(record: str | None) -> tuple[str | None, str | None, list[tuple[str, str]] | None]:
    """(fingerprint, layout, turns) of a record. Null, text that is no JSON
    object and JSON nested too deeply to be read have neither; an unknown
    fingerprint, or turns that are no list of objects, have no layout and no
    turns."""
    try:
        data = json.loads(record) if record is not None else None
        found = paths(data) if isinstance(data, dict) else None
    except (ValueError, RecursionError):
        found = None
    if found is None:
        return None, None, None
    mark = fingerprint(found)
    layout = layout_of(found)
    listed = data.get(layout.turns) if layout is not None and layout.turns else []
    if layout is None or not isinstance(listed, list) or not all(isinstance(t, dict) for t in listed):
        return mark, None, None
    turns = []
    for role, spec in layout.fields:
        text = "\n\n".join(t for t in (_plain(data.get(p)) for p in spec.split("+")) if t)
        if text or all(p in layout.needs for p in spec.split("+")):
            turns.append((role, text))
    for turn in listed:
        role = _plain(turn.get(layout.role))
        turns.append((ROLES.get(role, role), _plain(turn.get(layout.text))))
    return mark, layout.name, turns


# ---- template ---------------------------------------------------------------

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates.
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_ESCAPE = re.compile(rf"([<\[]\\*)(?={_REST})")
_UNESCAPE = re.compile(rf"([<\[]\\*)\\(?={_REST})")
_TURN = re.compile(rf"{re.escape(START)}(.*?)\n(.*?){re.escape(END)}\n", re.S)


def escape(text: str) -> str:
    """No control string is left: a backslash goes after the first character
    of each, and of each that already has backslashes there."""
    return _ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def write_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and its loss mask: (start, end) in code points of
    every assistant text, as escaped."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


# ---- Spark --------------------------------------------------------------------

FORMATTED = T.StructType([
    T.StructField("fingerprint", T.StringType()), T.StructField("layout", T.StringType()),
    T.StructField("formatted", T.StringType()),
    T.StructField("loss_mask", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                         T.StructField("end", T.LongType())])))])


def formatted(record: Column) -> Column:
    """Struct column (fingerprint, layout, formatted, loss_mask) of JSON records."""
    @F.pandas_udf(FORMATTED)
    def chat_format(records: pd.Series) -> pd.DataFrame:
        rows = []
        for r in records:
            mark, layout, turns = canonical(r)
            text, spans = (None, None) if turns is None else write_turns(turns)
            rows.append((mark, layout, text,
                         None if spans is None else [{"start": a, "end": b} for a, b in spans]))
        return pd.DataFrame(rows, columns=[f.name for f in FORMATTED])

    return chat_format(record)


def format_records(records: DataFrame, record_col: str = "record") -> DataFrame:
    """``records`` with the columns fingerprint, layout, formatted and
    loss_mask, which replace columns of those names. Null records, text that
    is no JSON object and unknown layouts keep their row, with nulls."""
    small_batches(records.sparkSession)
    name = free_name(records, "_chat")
    out = records.withColumn(name, formatted(column(records, record_col)))
    for f in FORMATTED:
        out = out.withColumn(f.name, F.col(name)[f.name])
    return out.drop(name)


def conversation_records(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, record) from one row per turn: a JSON object in the messages
    layout, turns in order (ties by role, then text; repeated rows stay).
    Null roles and texts count as empty. A conversation is one training
    example, so it is one row, as long as its turns together."""
    turns = rows.select(column(rows, conv_col).alias("conv_id"), column(rows, turn_col).alias("t"),
                        F.coalesce(column(rows, role_col), F.lit("")).alias("r"),
                        F.coalesce(column(rows, text_col), F.lit("")).alias("x"))
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("t", "r", "x"))).alias("m"))
    messages = F.transform("m", lambda m: F.struct(m["r"].alias("role"), m["x"].alias("content")))
    return listed.select("conv_id", F.to_json(F.struct(messages.alias("messages"))).alias("record"))


DIGESTS = T.StructType([T.StructField(n, T.StringType() if "sha" in n else T.LongType())
                        for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")])


def digests(formatted_col: Column, mask_col: Column) -> Column:
    """Struct column read back from the formatted text and its loss mask; its
    fields are null where either is."""
    @F.pandas_udf(DIGESTS)
    def read_back(texts: pd.Series, masks: pd.Series) -> pd.DataFrame:
        rows = []
        for text, mask in zip(texts, masks):
            if text is None or mask is None:
                rows.append((None,) * len(DIGESTS))
                continue
            turns = read_turns(text)
            loss = "".join(unescape(text[m["start"]:m["end"]]) for m in mask)
            whole = "".join(f"{r}\n{t}\n" for r, t in turns)
            rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                         hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        return pd.DataFrame(rows, columns=[f.name for f in DIGESTS], dtype=object)

    return read_back(formatted_col, mask_col)
