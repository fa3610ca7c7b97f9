"""Format-preserving pseudonyms for personal data.

Numbers and dates are found by pattern, validated (Luhn, mod 97, calendar,
number-plan and octet ranges) and replaced by another valid value of the same
format. The values of a format are numbered 0 .. N-1 and permuted with a
keyed Feistel network (cycle-walking for N that is no power of two), so equal
values get equal pseudonyms in every document, different values different
ones, and the key holder can go back. The permutation is P^-1(P(x) + 1 mod N):
no value stands for itself. A number that is valid only as part of a longer run
of digit groups in no usual layout may be cut otherwise on the way back (about
one in ten cuts of digits passes Luhn).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import column, free_name, small_batches

ROUNDS = 8


# ---- permutation ------------------------------------------------------------

def _round(key: bytes, domain: bytes, i: int, half: int, bits: int) -> int:
    data = domain + bytes([i]) + half.to_bytes((bits + 7) // 8, "big")
    out, n = b"", (bits + 7) // 8
    while len(out) < n:
        out += hashlib.blake2b(data, key=key, salt=len(out).to_bytes(8, "big")).digest()
    return int.from_bytes(out[:n], "big") & ((1 << bits) - 1)


def _feistel(key: bytes, domain: bytes, size: int, x: int, back: bool) -> int:
    """Keyed permutation of 0 .. size-1, or its inverse."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        a, b = x >> half, x & mask
        for i in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)):
            if back:
                a, b = b ^ _round(key, domain, i, a, half), a
            else:
                a, b = b, a ^ _round(key, domain, i, b, half)
        x = a << half | b
        if x < size:
            return x


@lru_cache(maxsize=100_000)
def permute(key: bytes, domain: str, size: int, x: int, back: bool = False) -> int:
    """Another number below ``size`` for ``x``; one to one, and undone with
    ``back``. Only a size of one leaves x as it is."""
    if size < 2:
        return x
    name = f"{domain}/{size}".encode()
    y = (_feistel(key, name, size, x, False) + (-1 if back else 1)) % size
    return _feistel(key, name, size, y, True)


# ---- formats ----------------------------------------------------------------
# Each format: a function (match text, permutation) that gives the replacement, or
# None if the text is not a valid value.

Permutation = Callable[[str, int, int], int]


def luhn(digits: str) -> int:
    """Luhn sum modulo 10; 0 for a valid number."""
    twice = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10


def _refill(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced, in order, by ``digits``."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in pattern)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def valid_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and not luhn(digits) and bool(digits.strip("0"))


def card(text: str, perm: Permutation) -> str | None:
    d = _digits(text)
    if not valid_card(d):
        return None
    body = f"{perm('card', 10 ** (len(d) - 1), int(d[:-1])):0{len(d) - 1}d}"
    return _refill(text, body + str(-luhn(body + "0") % 10))


SSN_AREAS = [a for a in range(1, 900) if a != 666]


def ssn(text: str, perm: Permutation) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area not in SSN_AREAS or not group or not serial:
        return None
    x = (SSN_AREAS.index(area) * 99 + group - 1) * 9999 + serial - 1
    x = perm("ssn", len(SSN_AREAS) * 99 * 9999, x)
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return f"{SSN_AREAS[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def phone(text: str, perm: Permutation) -> str | None:
    d = _digits(text)
    m = re.match(r"\+(\d{1,3})", text)
    code = "" if not m else m[1] if len(_digits(text[m.end():])) >= 6 else m[1][:1]
    local = d[len(code):]
    if len(local) == 10 and code in ("", "1") and local[0] in "23456789" and local[3] in "23456789":
        x = ((int(local[:3]) - 200) * 800 + int(local[3:6]) - 200) * 10_000 + int(local[6:])
        x, line = divmod(perm("phone", 800 * 800 * 10_000, x), 10_000)
        area, exchange = divmod(x, 800)
        local = f"{area + 200}{exchange + 200}{line:04d}"
    elif code and 8 <= len(d) <= 15:
        local = f"{perm('phone' + code, 10 ** len(local), int(local)):0{len(local)}d}"
    else:
        return None
    return _refill(text, code + local)


def ip(text: str, perm: Permutation) -> str | None:
    octets = list(map(int, text.split(".")))
    if max(octets) > 255:
        return None
    x = perm("ip", 1 << 32, int.from_bytes(bytes(octets), "big"))
    return ".".join(map(str, x.to_bytes(4, "big")))


FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def date(text: str, perm: Permutation) -> str | None:
    """Year first, or year last with the day first (the month first if only
    that is a date). Padding with zeros is kept."""
    sep = re.search(r"\D", text)[0]
    parts = text.split(sep)
    orders = ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1))
    for order in orders:
        try:
            day = dt.date(*(int(parts[i]) for i in order)).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = dt.date.fromordinal(FIRST_DAY + perm("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY))
        width = 2 if all(len(p) >= 2 for p in parts) else 1
        out = ["", "", ""]
        for i, v in zip(order, (new.year, new.month, new.day)):
            out[i] = f"{v:0{4 if v > 999 else width}d}"
        return sep.join(out)
    return None


def _classes(text: str, perm: Permutation, domain: str) -> str | None:
    """Letters and digits of ASCII permuted together, each within its class;
    None if there are none."""
    kinds = [("0", 10) if "0" <= c <= "9" else ("a", 26) if "a" <= c <= "z" else
             ("A", 26) if "A" <= c <= "Z" else ("", 1) for c in text]
    x, size = 0, 1
    for c, (base, n) in zip(text, kinds):
        if base:
            x, size = x * n + ord(c) - ord(base), size * n
    if size == 1:
        return None
    x = perm(domain + ":" + "".join(b or "-" for b, _ in kinds), size, x)
    out = []
    for c, (base, n) in zip(reversed(text), reversed(kinds)):
        if base:
            x, r = divmod(x, n)
            c = chr(ord(base) + r)
        out.append(c)
    return "".join(reversed(out))


def _iban_value(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


def valid_iban(plain: str) -> bool:
    return 15 <= len(plain) <= 34 and _iban_value(plain[4:] + plain[:4]) % 97 == 1


def iban(text: str, perm: Permutation) -> str | None:
    plain = text.replace(" ", "")
    if not valid_iban(plain):
        return None
    body = _classes(plain[4:], perm, "iban" + plain[:2])
    check = f"{98 - _iban_value(body + plain[:2] + '00') % 97:02d}"
    it = iter(plain[:2] + check + body)
    return "".join(c if c == " " else next(it) for c in text)


def email(text: str, perm: Permutation) -> str | None:
    local, _, host = text.rpartition("@")
    name = _classes(local, perm, "email")
    if name is not None:
        return f"{name}@{host}"
    first, dot, rest = host.partition(".")
    host = _classes(first, perm, "host")
    return None if host is None else f"{local}@{host}{dot}{rest}"


def secret(text: str, perm: Permutation) -> str | None:
    if not any("0" <= c <= "9" for c in text):
        return None
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        new = f"{perm('hex', 16 ** len(text), int(text, 16)):0{len(text)}x}"
        return new.upper() if text.upper() == text else new
    return _classes(text, perm, "secret")


# ---- places of candidates ---------------------------------------------------
# Each: (text, free) -> spans that do not overlap, in order; free(a, b) tells
# whether no value found before overlaps a to b.

Free = Callable[[int, int], bool]


def by_pattern(pattern: str) -> Callable:
    regex = re.compile(pattern)
    group = "value" if "value" in regex.groupindex else 0

    def spans(text: str, free: Free) -> Iterator[tuple[int, int]]:
        return (m.span(group) for m in regex.finditer(text) if free(*m.span(group)))

    return spans


DIGIT_RUN = re.compile(r"\d+(?:[ \-]\d+)*")
CARD_LAYOUTS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), *((n,) for n in range(13, 20))}


def card_spans(text: str, free: Free) -> Iterator[tuple[int, int]]:
    """Valid numbers of 13 to 19 digits that start and end at the borders of
    groups of digits, whatever stands beside them: first the usual layouts,
    then, in what is left of a run, any groups (the first start, the longest)."""
    for run in DIGIT_RUN.finditer(text):
        if run.end() - run.start() < 13:
            continue
        parts: list[list[tuple[int, int]]] = [[]]
        for g in re.finditer(r"\d+", run[0]):
            a, b = run.start() + g.start(), run.start() + g.end()
            if free(a, b):
                parts[-1].append((a, b))
            else:
                parts.append([])
        for groups in parts:
            found, rest = [], [[]]
            i = 0
            while i < len(groups):
                n = _card_at(text, groups, i, usual=True)
                if n:
                    found.append((groups[i][0], groups[i + n - 1][1]))
                    rest.append([])
                else:
                    rest[-1].append(groups[i])
                i += n or 1
            for left in rest:
                i = 0
                while i < len(left):
                    n = _card_at(text, left, i, usual=False)
                    if n:
                        found.append((left[i][0], left[i + n - 1][1]))
                    i += n or 1
            yield from sorted(found)


def _card_at(text: str, groups: list[tuple[int, int]], i: int, usual: bool) -> int:
    """Number of groups from the i-th that make up a valid card, or 0."""
    sizes, total = [], 0
    for a, b in groups[i:i + 19]:
        total += b - a
        if total > 19:
            break
        sizes.append(b - a)
    for n in range(len(sizes), 0, -1):
        if sum(sizes[:n]) < 13:
            break
        if (not usual or tuple(sizes[:n]) in CARD_LAYOUTS) and valid_card(_digits(text[groups[i][0]:groups[i + n - 1][1]])):
            return n
    return 0


# Length of an IBAN by country, as registered.
IBAN_LENGTHS = {code: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for code in codes.split()}
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}")
IBAN_GROUP = re.compile(r" ?([A-Z0-9]{1,4})")
IBAN_END = re.compile(r"(?![A-Za-z0-9])")


def iban_spans(text: str, free: Free) -> Iterator[tuple[int, int]]:
    """Valid numbers in groups of four and a shorter last one, each ending
    before a character that is no letter or digit: the country's length first,
    then any from long to short, so that a word that follows is left out."""
    done = 0
    for m in IBAN_HEAD.finditer(text):
        a = m.start()
        if a < done:
            continue
        ends, at, n = [], m.end(), 4
        while n < 34 and (g := IBAN_GROUP.match(text, at)):
            at, n = g.end(), n + len(g[1])
            if 15 <= n <= 34 and IBAN_END.match(text, at):
                ends.append((n, at))
            if len(g[1]) < 4:
                break
        usual = IBAN_LENGTHS.get(text[a:a + 2])
        for n, b in sorted(ends, key=lambda e: (e[0] != usual, -e[0])):
            if free(a, b) and valid_iban(text[a:b].replace(" ", "")):
                yield a, b
                done = b
                break


# In order of precedence where matches overlap. Patterns are bounded or start
# only at the start of a run, so that matching stays linear in long texts.
FORMATS: tuple[tuple[str, Callable, Callable], ...] = (
    ("email", by_pattern(r"(?<![\w.%+\-])[\w%+][\w.%+\-]{0,255}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){1,8}(?<!-)"), email),
    ("secret", by_pattern(r"(?i:\b(?:token|secret|passwd|password|api[_\-]?key|access[_\-]?key)[\"']?[ ]{0,4}[=:][ ]{0,4}[\"']?)"
                          r"(?P<value>[A-Za-z0-9_\-/+]{16,512})"), secret),
    ("iban", iban_spans, iban),
    ("date", by_pattern(r"(?<![\d./\-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\d]|[./\-]\d)"), date),
    ("ssn", by_pattern(r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"), ssn),
    ("ip", by_pattern(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"), ip),
    ("card", card_spans, card),
    ("phone", by_pattern(r"(?<![\w+])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}"
                         r"|\([2-9]\d\d\)[ .\-]?[2-9]\d\d[ .\-]\d{4}|[2-9]\d\d[.\-][2-9]\d\d[.\-]\d{4})(?!\d)"), phone),
)
NEEDS = re.compile(r"[0-9@]")


def find(text: str, perm: Permutation) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, replacement) of the valid values of a text, in order;
    of overlapping ones the first format, then the first match."""
    found: list[tuple[int, int, str, str]] = []
    if not NEEDS.search(text):
        return found
    for kind, spans, change in FORMATS:
        taken = sorted(found)                         # they do not overlap
        ends = [y for _, y, _, _ in taken]

        def free(a: int, b: int) -> bool:
            i = bisect_right(ends, a)                 # the first that ends after a
            return i == len(taken) or taken[i][0] >= b

        for a, b in spans(text, free):
            new = change(text[a:b], perm)
            if new is not None:
                found.append((a, b, kind, new))
    return sorted(found)


def pseudonymise_text(text: str, key: bytes, back: bool = False) -> tuple[str, list[str]]:
    """The text with its values replaced, and the kinds of the values."""
    perm = lambda domain, size, x: permute(key, domain, size, x, back)
    out, at, kinds = [], 0, []
    for a, b, kind, new in find(text, perm):
        out += [text[at:a], new]
        at = b
        kinds.append(kind)
    return "".join(out) + text[at:], kinds


KIND = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_values", T.LongType()),
                     T.StructField("kinds", T.StringType())])


def pseudonyms(text: Column, key: bytes, back: bool = False) -> Column:
    """Struct column (text, n_values, kinds: distinct, sorted, comma-joined).
    The key may have any length but none."""
    if not key:
        raise ValueError("pseudonyms need a key")
    if len(key) > hashlib.blake2b.MAX_KEY_SIZE:
        key = hashlib.blake2b(key).digest()

    @F.pandas_udf(KIND)
    def feistel_pseudonyms(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            new, kinds = (None, []) if t is None else pseudonymise_text(t, key, back)
            rows.append((new, len(kinds), ",".join(sorted(set(kinds)))))
        return pd.DataFrame(rows, columns=["text", "n_values", "kinds"])

    return feistel_pseudonyms(text)


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", chars_col: str | None = None,
                 back: bool = False) -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced and, if ``chars_col``
    is given, that column set to the new length. Null texts stay null; texts
    without a valid value stay as they are; all other columns are kept."""
    small_batches(docs.sparkSession)
    name = free_name(docs, "_pii")
    out = docs.withColumn(name, pseudonyms(column(docs, text_col), key, back))
    out = out.withColumn(text_col, F.col(name)["text"])
    if chars_col:
        out = out.withColumn(chars_col, F.length(F.col(text_col)).cast("long"))
    return out.drop(name)


def report(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text (pseudonymised), n_values and
    kinds. Null texts stay null with no values."""
    small_batches(docs.sparkSession)
    return (docs.select(column(docs, id_col).alias("doc_id"),
                        pseudonyms(column(docs, text_col), key).alias("_p"))
                .select("doc_id", "_p.*"))
