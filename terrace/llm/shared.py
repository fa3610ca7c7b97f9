"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import scratch_path

ARROW_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows per Arrow batch sent to a Python worker. Documents are whole texts, so
# the default of 10,000 rows would let a batch of long ones fill a worker.
ARROW_ROWS = 1000
# Lets Spark remove a query's shuffle files when the query ends, and not only
# when the driver happens to collect garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` (never raises it)."""
    now = int(spark.conf.get(ARROW_CONF))
    if now <= 0 or now > rows:
        spark.conf.set(ARROW_CONF, str(rows))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet under the cluster's shared folder
    and read it back. The copy outlives any executor; the shuffle files it was
    made from are removed once it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def by_key(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is dealt out by key and never broadcast.

    For sides that grow with the documents. Spark would broadcast some of them:
    it sizes the output of an explode or of a Python function as if each row
    gave one, and a Parquet copy by its compressed bytes. Adaptive execution
    does not take such a broadcast back, because its plan has fewer shuffles."""
    return df.hint("merge")


def ascii_lower(text: Column) -> Column:
    """Lower-cased text for matching ASCII words.

    ``lower`` maps more than A-Z, but no character outside ASCII becomes a
    lone ASCII letter other than the Kelvin sign (to k), which is kept apart
    first, so ASCII words match exactly as after an A-Z mapping and word
    boundaries do not move."""
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138")))


def column(df: DataFrame, name: str) -> Column:
    """The column called exactly ``name`` (names may hold dots)."""
    return df[f"`{name}`"]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it
    (column names compare without case, as Spark resolves them)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
