"""Column-level helpers: flattening, schema alignment and scalar parsing.

Everything returns ``Column`` expressions or a single ``select``; nothing
leaves the JVM, so all of it stays inside whole-stage codegen.
"""

from __future__ import annotations

import logging
from collections import OrderedDict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def _quote(path: list[str]) -> str:
    return ".".join(f"`{p}`" for p in path)


def struct_leaves(schema: T.StructType, prefix: list[str] | None = None):
    """Yield (leaf name, path) for every non-struct field, depth first in
    schema order. Arrays and maps are leaves (kept whole)."""
    prefix = prefix or []
    for field in schema.fields:
        path = prefix + [field.name]
        if isinstance(field.dataType, T.StructType):
            yield from struct_leaves(field.dataType, path)
        else:
            yield field.name, path


def flatten_structs(df: DataFrame) -> DataFrame:
    """B1: recursive struct flatten, leaf names without prefix.

    When several leaves share a name, the *last non-null* one in traversal
    order wins (nulls are discarded before the merge), so each output column is
    ``coalesce(last, ..., first)``. A column keeps the position of its first
    occurrence. Leaves under a null struct read as null.
    """
    groups: "OrderedDict[str, list[list[str]]]" = OrderedDict()
    for name, path in struct_leaves(df.schema):
        groups.setdefault(name, []).append(path)
    cols = []
    for name, paths in groups.items():
        exprs = [F.col(_quote(p)) for p in reversed(paths)]
        col = exprs[0] if len(exprs) == 1 else F.coalesce(*exprs)
        cols.append(col.alias(name))
    return df.select(*cols)


def conform(df: DataFrame, schema: T.StructType, extra: str = "drop",
            enforce_not_null: bool = False) -> DataFrame:
    """B2 + B6: one typed ``select`` producing exactly ``schema``.

    Fields are matched by *name*; absent fields become typed nulls; present
    ones are cast (strict under ANSI mode, so bad text fails the job, while
    int -> double widens). Unexpected input columns are reported and dropped
    (``extra="drop"``) or rejected (``extra="error"``). With
    ``enforce_not_null`` a null in a non-nullable field fails the job, as the
    source system's strict record check does.
    """
    have = {f.name: f for f in df.schema.fields}
    unexpected = [n for n in have if n not in set(schema.fieldNames())]
    if unexpected:
        if extra == "error":
            raise ValueError(f"unexpected columns {unexpected} for declared schema")
        log.warning("dropping unexpected columns %s", unexpected)
    cols = []
    for field in schema.fields:
        if field.name in have:
            col = F.col(f"`{field.name}`")
            if have[field.name].dataType != field.dataType:
                col = col.cast(field.dataType)
        else:
            col = F.lit(None).cast(field.dataType)
        if enforce_not_null and not field.nullable:
            col = F.coalesce(col, F.raise_error(F.lit(f"null in non-nullable field {field.name}"))
                             .cast(field.dataType))
        cols.append(col.alias(field.name))
    return df.select(*cols)


# --- scalar helpers (S1-S12) ------------------------------------------------

def strict_long(c: Column | str) -> Column:
    """Text -> bigint; bad text fails the job, whatever the session's ANSI
    setting."""
    c = F.col(c) if isinstance(c, str) else c
    value = c.try_cast("long")
    bad = F.raise_error(F.concat(F.lit("not an integer: "), c.cast("string"))).cast("long")
    return F.when(c.isNotNull() & value.isNull(), bad).otherwise(value)


def sentinel_to_null(c: Column | str, sentinel: str = "..") -> Column:
    """The sentinel becomes null, anything else is parsed strictly."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == F.lit(sentinel), F.lit(None).cast("long")).otherwise(strict_long(c))


def year_of(c: Column | str) -> Column:
    """S3: the year of a ``yyyy_MM_dd`` string = its first four characters."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(c, 1, 4).cast("long")


def item_prefix(c: Column | str, n: int = 10) -> Column:
    """First ``n`` characters of a file stem."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(c, 1, n)


QUERY_DATE_FORMAT = "yyyy_MM_dd"


def query_timestamp(c: Column | str) -> Column:
    """``yyyy_MM_dd`` -> zone-less timestamp (the parsed value has no zone)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_timestamp_ntz(c, F.lit(QUERY_DATE_FORMAT))


def query_date(c: Column | str) -> Column:
    """``yyyy_MM_dd`` -> date."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(c, QUERY_DATE_FORMAT)


def lenient_number(c: Column | str, replace: dict[str, str] | None = None) -> Column:
    """S11 + S12: optional code replacement, then text -> double with
    unparsable values as null."""
    c = F.col(c) if isinstance(c, str) else c
    for old, new in (replace or {}).items():
        c = F.when(c == F.lit(old), F.lit(new)).otherwise(c)
    return c.try_cast("double")


def landing_item(suffix_regex: str, path_col: str = "_metadata.file_path", below: str = "/") -> Column:
    """A7 helper: the name of the landing item (file or directory) a row came
    from, found in the row's source file path. ``suffix_regex`` matches the
    end of the item name (e.g. ``_idealista``); ``below`` the path up to it
    (see ``files.below_root``)."""
    return F.regexp_extract(F.col(path_col), rf"{below}([^/]*{suffix_regex})(?:/|$)", 1)


def stem_of(item: Column) -> Column:
    """Path stem: the item name without its last extension."""
    return F.regexp_replace(item, r"\.[^./]*$", "")
