"""Zone runs as job functions; a ``spark-submit`` entry calls these.

* ``commit_zone``   landing -> formatted (P1-P3), each pipe over its new items
* ``extract_zone``  formatted -> exploitation -> published tables (P4-P7)
* ``train_published``  the price model on the published ``sales`` table (P8, A8)

A failing pipe does not stop the others: the ones that succeed are committed
(their ledgers record it), and the job raises at the end naming every
failure, so the run exits non-zero and a rerun repeats only what is missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import extract, price_model, standardise
from .plans.landing import Landing
from .sources import ledger

COMMITTERS: dict[str, Callable[[SparkSession, Landing, str], list[str]]] = {
    "idealista": standardise.commit_listings,
    "padro_opendata": standardise.commit_moves,
    "income_opendata": standardise.commit_income,
}


class ZoneRunError(RuntimeError):
    def __init__(self, failures: dict[str, BaseException]):
        self.failures = failures
        super().__init__("; ".join(f"{p}: {e!r}" for p, e in failures.items()))


def reset_formatted(spark: SparkSession, formatted: str, pipes: list[str] | None = None) -> None:
    """A14 for the formatted zone: the next commit reprocesses every item and
    overwrites the output."""
    for pipe in pipes or list(COMMITTERS):
        ledger.reset(spark, f"{formatted}/{pipe}/_ledger", pipe)


def reset_exploitation(spark: SparkSession, exploitation: str,
                       tables: list[str] | None = None) -> None:
    """A14 for the exploitation zone: the next extract recomputes the tables."""
    for table in tables or list(extract.CURATED):
        ledger.reset(spark, f"{exploitation}/{table}/_ledger", table)


def commit_zone(spark: SparkSession, landing_root: str, formatted: str,
                pipes: list[str] | None = None, reset: bool = False) -> dict[str, list[str]]:
    """Returns, per pipe, the items (or income versions) it committed."""
    pipes = pipes or list(COMMITTERS)
    if reset:
        reset_formatted(spark, formatted, pipes)
    land = Landing(landing_root)
    done, failed = {}, {}
    for pipe in pipes:
        try:
            done[pipe] = COMMITTERS[pipe](spark, land, formatted)
        except Exception as e:  # noqa: BLE001 - isolate pipes, report all at the end
            failed[pipe] = e
    if failed:
        raise ZoneRunError(failed)
    return done


def extract_zone(spark: SparkSession, formatted: str, exploitation: str,
                 tables: list[str] | None = None, reset: bool = False,
                 location: str | None = None) -> dict[str, str]:
    """P4-P7 + publish: per table ``SUCCESS``, ``FAILED`` or ``fresh``."""
    if reset:
        reset_exploitation(spark, exploitation, tables)
    done, failed = {}, {}
    for table in tables or list(extract.CURATED):
        try:
            done.update(extract.run(spark, formatted, exploitation, [table], location))
            if done[table] == ledger.FAILED:
                failed[table] = RuntimeError("not published; the log has the error, the next run tries again")
        except Exception as e:  # noqa: BLE001
            failed[table] = e
    if failed:
        raise ZoneRunError(failed)
    return done


def published_sales(spark: SparkSession, database: str = "predictive", table: str = "sales",
                    exploitation: str | None = None, location: str | None = None) -> DataFrame:
    """The analysis input is the published table, read through the catalog;
    with ``exploitation``, registered from its status log if the catalog lacks it."""
    return extract.published(spark, database, table, exploitation, location)


def train_published(spark: SparkSession, model_root: str, database: str = "predictive",
                    table: str = "sales", numeric: list[str] | None = None,
                    categorical: list[str] | None = None, num_trees: int = 100,
                    max_depth: int = 30, exploitation: str | None = None,
                    location: str | None = None) -> DataFrame:
    """P8 on the published table: ``price_model.train`` (clean, split, fit,
    evaluate, store).

    The feature lists default to the source system's; pass a subset when some
    of those columns are empty in the data at hand (every row with a null
    feature is dropped before training)."""
    numeric = numeric if numeric is not None else price_model.NUMERIC
    categorical = categorical if categorical is not None else price_model.CATEGORICAL
    sales = published_sales(spark, database, table, exploitation, location)
    return price_model.train(spark, sales, "propertyCode", numeric=numeric,
                             categorical=categorical, model_root=model_root,
                             num_trees=num_trees, max_depth=max_depth)
