"""Aggregations (E1-E5). All are declarative aggregates with a partial
(map-side) step, so a hot key is collapsed to one row per map task before the
shuffle, and no group is ever materialised in one task. Sums and counts have
fixed-width buffers and run as ``HashAggregate``. The arg-max and keep-first of
whole rows (E4, E5) keep a struct, which Spark aggregates by sorting: each map
task sorts its rows by key (spilling if need be) before it collapses them. A
window function would avoid neither the sort nor, for a hot key, the pull of
all its rows into one task, so none is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_preserving_sum(c: Column | str) -> Column:
    """The pairwise fold ``(x or 0) + (y or 0)``.

    A fold is never applied to a one-element group, so a single null stays
    null; two or more values (even all null) give the sum with nulls as 0.
    Plain SQL ``sum`` would give null for an all-null group.
    """
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(F.count(F.lit(1)) == 1, F.max(c))
            .otherwise(F.coalesce(F.sum(c), F.lit(0).cast("long"))))


def sum_per_key(df: DataFrame, keys: list[str], value: str, alias: str,
                carry: dict[str, str] | None = None) -> DataFrame:
    """Null-preserving sum per key, optionally carrying columns that
    are functionally dependent on the key (the smallest value is the pick).

    ``min`` of a string cannot live in a hash-aggregation buffer, so a direct
    ``groupBy(keys).agg(min(name))`` sorts every input row. With ``carry``
    the rows are therefore hash-aggregated by key *and* carried columns first
    (count, sum, max: fixed-width buffers, partial aggregation), and only
    those few rows per key are merged by key, where ``min`` is cheap."""
    if not carry:
        return df.groupBy(*keys).agg(null_preserving_sum(value).alias(alias))
    v = F.col(value)
    pre = (df.groupBy(*keys, *[F.col(src).alias(dst) for dst, src in carry.items()])
             .agg(F.count(F.lit(1)).alias("_n"), F.sum(v).alias("_s"), F.max(v).alias("_m")))
    merged = (pre.groupBy(*keys)
                 .agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), F.max("_m").alias("_m"),
                      *[F.min(dst).alias(dst) for dst in carry]))
    total = (F.when(F.col("_n") == 1, F.col("_m"))
              .otherwise(F.coalesce(F.col("_s"), F.lit(0).cast("long"))))
    return merged.select(*keys, total.alias(alias), *carry)


def latest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The whole row with the largest ``order`` value per key.

    Implemented as ``max(struct(order, other columns...))``: an ordinary
    aggregate (partial + final), ties broken deterministically by the
    remaining columns in schema order.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    packed = F.struct(F.col(order), *[F.col(c) for c in rest])
    return (df.groupBy(*keys)
              .agg(F.max(packed).alias("_latest"))
              .select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in [order] + rest])
              .select(*df.columns))


def keep_first(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """E5: one row per key.

    The source system keeps an arbitrary element; here the kept row is the
    smallest by ``order`` (default: all non-key columns in schema order), which
    makes the answer stable. ``min(struct)`` is a partial aggregate, so a hot
    key never gathers its rows in one task.
    """
    order = order or [c for c in df.columns if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (df.groupBy(*keys)
              .agg(F.min(packed).alias("_first"))
              .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest])
              .select(*df.columns))
