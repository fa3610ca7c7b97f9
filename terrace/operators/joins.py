"""Joins: lookup construction (D1, D3, D4) and reconciliation.

Every join in this engine is an inner equi-join of a large side with a side
whose cardinality is bounded by a dimension (a lookup file, or an aggregate
keyed by neighbourhood and year). Such a side is broadcast only after its
size has been *measured* (``checked_broadcast``); if it is over the bound the
join is left to the planner (sort-merge with AQE skew splitting). A broadcast
join is immune to a hot key on the large side: no row of the large side moves.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import partial
from typing import TypeVar

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
T = TypeVar("T")

# Bounds for a broadcast side. Lookups are tens of rows; aggregates keyed by
# (district, neighbourhood, year) are thousands. Anything past these bounds is
# not dimension-sized any more and goes through a shuffle join instead.
MAX_BROADCAST_ROWS = 2_000_000
# Session switch for ablations: "false" turns every measured broadcast into
# a planner-chosen join (with autoBroadcastJoinThreshold=-1: shuffle joins).
BROADCAST_SWITCH = "spark.terrace.broadcast"
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


# Fixed-width types count their width per row; variable-width values are
# measured (strings and binary by their byte length, nested values by the
# length of their JSON text).
_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4}
_VARIABLE = ("string", "binary")
_NESTED = ("array", "map", "struct")


def _bytes_expr(field) -> "F.Column":
    name = field.dataType.typeName()
    c = F.col(f"`{field.name}`")
    if name in _VARIABLE:
        return F.coalesce(F.sum(F.octet_length(c)), F.lit(0))
    if name in _NESTED:
        return F.coalesce(F.sum(F.octet_length(F.to_json(c))), F.lit(0))
    return F.count(F.lit(1)) * F.lit(_WIDTH.get(name, 8))


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` from one aggregate over it: a partial
    aggregation, so only one small row per task is shuffled."""
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [_bytes_expr(f).cast("long").alias(f"_b{i}") for i, f in enumerate(df.schema.fields)]
    r = df.agg(*exprs).first()
    return r["rows"], sum(r[f"_b{i}"] or 0 for i in range(len(df.schema.fields)))


_SCOPE: ContextVar[list[DataFrame] | None] = ContextVar("held sides", default=None)


@contextmanager
def held_sides():
    """A run's scope: the sides that ``checked_broadcast`` persists inside are
    unpersisted at its end, those of other runs are not touched. Spark finds
    cached data by plan, so a side kept longer would hide later changes of its
    files."""
    own: list[DataFrame] = []
    token = _SCOPE.set(own)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for df in own:
            df.unpersist()


def at_once(*jobs: Callable[[], T]) -> list[T]:
    """Results of jobs that do not depend on each other, run at the same time,
    each in a copy of this run's scope. All have ended when this returns or
    raises."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        futures = [pool.submit(copy_context().run, job) for job in jobs]
        return [f.result() for f in futures]


def checked_broadcasts(sides: dict[str, DataFrame]) -> list[DataFrame]:
    """``checked_broadcast`` of several sides that do not depend on each other,
    measured at the same time."""
    return at_once(*[partial(checked_broadcast, df, name=name) for name, df in sides.items()])


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES, name: str = "side",
                      persist: bool = True) -> DataFrame:
    """Broadcast ``df`` if, and only if, its measured size is within bounds.

    The side is persisted (memory and disk, recomputable from lineage if an
    executor is lost) and measured; the measuring job materialises it, so the
    main job reads it from cache instead of recomputing it. Over the bound,
    the un-hinted DataFrame is returned and the planner chooses a shuffle join.
    """
    if persist:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        scope = _SCOPE.get()
        if scope is not None:
            scope.append(df)
    if df.sparkSession.conf.get(BROADCAST_SWITCH, "true").lower() == "false":
        return df
    n, size = measure(df)
    if n <= max_rows and size <= max_bytes:
        log.info("broadcasting %s: %d rows, %d bytes", name, n, size)
        return F.broadcast(df)
    log.warning("not broadcasting %s: %d rows, %d bytes over bound", name, n, size)
    return df


def explode_lookup(parents: DataFrame, children_col: str, parent_cols: dict[str, str],
                   children: DataFrame, child_key: str, child_cols: dict[str, str]) -> DataFrame:
    """Parent rows with an array of child ids, exploded (S8) and joined
    to the child rows. Output columns are renamed per the two dicts
    (output name -> source column)."""
    exploded = parents.select(
        *[F.col(src).alias(dst) for dst, src in parent_cols.items()],
        F.explode(F.col(children_col)).alias("_child"),
    )
    kids = children.select(F.col(child_key).alias("_child"),
                           *[F.col(src).alias(dst) for dst, src in child_cols.items()])
    return exploded.join(kids, "_child", "inner").drop("_child")


def reject_count(df: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Diagnostics for 2.13 point 5: rows an inner lookup join drops, as a
    one-row count (left anti join against the lookup keys)."""
    return (df.join(lookup.select(*keys).distinct(), keys, "left_anti")
              .agg(F.count(F.lit(1)).alias("rejected")))


class Quality:
    """Row counts of the reconciliations of one run, taken by the write itself.

    Each step is a left join whose rows are counted (all, and those without a
    match) by an observation on the way, before the unmatched ones are dropped:
    no second pass, no other plan than the write's. ``counts`` waits for the
    action that runs the plan."""

    def __init__(self):
        self._steps: list[tuple[str, Observation]] = []

    def reconcile(self, df: DataFrame, lookup: DataFrame, on: Column, step: str) -> DataFrame:
        """``df`` inner-joined with a lookup, the step counted."""
        seen = Observation()
        self._steps.append((step, seen))
        flagged = df.join(lookup.withColumn("_known", F.lit(True)), on, "left")
        counted = flagged.observe(seen, F.count(F.lit(1)).alias("rows"),
                                  F.count(F.when(F.col("_known").isNull(), 1)).alias("unknown"))
        return counted.where(F.col("_known")).drop("_known")

    def counts(self) -> dict[str, dict[str, int]]:
        """Per step the rows that reached it and those without a match; steps
        of one name (inputs of several schemas) are added up."""
        out: dict[str, dict[str, int]] = {}
        for step, seen in self._steps:
            # A plan without rows may leave its metrics out.
            got = seen.get or {}
            have = out.setdefault(step, {"rows": 0, "unknown": 0})
            for name in have:
                have[name] += int(got.get(name) or 0)
        return out


def reconcile(df: DataFrame, lookup: DataFrame, on: Column, step: str, quality: Quality | None) -> DataFrame:
    """Inner join with a lookup; with ``quality``, the step is counted."""
    return df.join(lookup, on) if quality is None else quality.reconcile(df, lookup, on, step)
