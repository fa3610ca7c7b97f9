"""Price model on the wide training table (P8, L1-L9, A19), on Spark ML.

The source system trains in one process; here every step is distributed:
cleaning is column expressions, the split is a hash bucket of the row key
(repeatable, no shuffle), imputation and scaling are expressions over exact
statistics of the training rows, encoding is ``ml.feature`` and the forest is
``RandomForestRegressor``. The expressions are a ``SQLTransformer``, so the
saved model holds them. Only the fitted model and one metrics row are written.
"""

from __future__ import annotations

import datetime as _dt

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import lenient_number
from ..operators.quantiles import exact_medians, mode_values
from ..sources.sinks import new_version

# The source system's feature lists and target.
FEATURES = ["bathrooms", "typology", "distance", "district", "exterior", "size", "rooms",
            "floor", "hasLift", "neighborhood_id", "population", "RFD", "move_in", "move_out"]
CATEGORICAL = ["typology", "district", "exterior", "hasLift", "neighborhood_id"]
NUMERIC = ["bathrooms", "distance", "size", "rooms", "floor", "population", "RFD",
           "move_in", "move_out"]
TARGET = "price"
# Trees are grown in the driver's memory. Leaves take at least so many rows that
# a tree has at most this many; up to that many rows a leaf may hold one row,
# as in the source system.
MAX_LEAVES = 512
# Statistics of as many nodes as fit this are gathered in one pass over the rows.
NODES_MB = 1024
# Rows a training task takes at most; below that there is a task for every core.
ROWS_A_TASK = 2_000_000
FLOOR_CODES = {"bj": "0"}


def labelled(df: DataFrame, features: list[str] = FEATURES, target: str = TARGET,
             numeric_text: tuple[str, ...] = ("floor",), strict_text: tuple[str, ...] = ("distance",),
             keep: tuple[str, ...] = ()) -> DataFrame:
    """S11/S12 floor codes and lenient parse; strict parse of numeric text
    columns; C2 drop null target; B11. ``keep`` names further columns."""
    cols = {}
    for f in features:
        c = F.col(f)
        if f in numeric_text:
            c = lenient_number(c, FLOOR_CODES)
        elif f in strict_text:
            c = c.cast("double")
        cols[f] = c.alias(f)
    return df.where(F.col(target).isNotNull()).select(*keep, *cols.values(), F.col(target))


def clean(df: DataFrame, features: list[str] = FEATURES, target: str = TARGET,
          numeric_text: tuple[str, ...] = ("floor",), strict_text: tuple[str, ...] = ("distance",)
          ) -> DataFrame:
    """``labelled``, and C3: rows with any null feature are dropped."""
    return labelled(df, features, target, numeric_text, strict_text).na.drop(subset=features)


def hash_bucket(key: Column | str, buckets: int = 5) -> Column:
    """L1: repeatable bucket from the md5 of the key's text (first 28 bits)."""
    key = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 7), 16, 10).cast("long")
    # A row without a key goes to a bucket too, so that no row is lost.
    return F.coalesce(h % F.lit(buckets), F.lit(1).cast("long"))


def split(df: DataFrame, key: str, test_bucket: int = 0, buckets: int = 5):
    """80/20 split by hash bucket: no shuffle, same rows every run."""
    b = hash_bucket(key, buckets)
    return df.where(b != test_bucket), df.where(b == test_bucket)


def regression_metrics(df: DataFrame, label: str, prediction: str, digits: int = 6) -> DataFrame:
    """L9 + E6: MAE, RMSE and row count in one aggregate."""
    e = F.col(prediction) - F.col(label)
    return df.agg(F.round(F.avg(F.abs(e)), digits).alias("mae"),
                  F.round(F.sqrt(F.avg(e * e)), digits).alias("rmse"),
                  F.count(F.lit(1)).alias("entries"))


# --- preparation: SQL text, so that the saved model can hold it ---------------

def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"double('{float(value)!r}')"


def imputed(col: str, value) -> str:
    """L2/L4: the column with nulls replaced (a column without any value stays)."""
    return f"`{col}`" if value is None else f"coalesce(`{col}`, {_literal(value)})"


def z_score(expr: str, mean: float, sd: float) -> str:
    """L3: zero mean, unit population variance; a constant column gives 0."""
    return f"(({expr}) - {_literal(mean)}) / {_literal(sd or 1.0)}"


def population_stats(df: DataFrame, exprs: dict[str, str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per named expression, in one aggregate."""
    row = df.agg(*[f(F.expr(e)).alias(f"{k}{n}") for k, f in (("m_", F.avg), ("s_", F.stddev_pop))
                   for n, e in exprs.items()]).first()
    return {n: (row[f"m_{n}"], row[f"s_{n}"]) for n in exprs}


def preparation(rows: DataFrame, numeric: list[str], categorical: list[str]) -> SQLTransformer:
    """L2-L4 fitted on ``rows``: exact median and z-score of numeric columns,
    most frequent value of categorical ones."""
    medians, modes = exact_medians(rows, numeric), mode_values(rows, categorical)
    filled = {c: imputed(c, medians[c]) for c in numeric}
    stats = population_stats(rows, filled)
    cols = [f"{z_score(filled[c], *stats[c])} AS `{c}__z`" for c in numeric]
    cols += [f"{imputed(c, modes[c])} AS `{c}__full`" for c in categorical]
    return SQLTransformer(statement=f"SELECT *, {', '.join(cols)} FROM __THIS__")


def build_pipeline(prepare: SQLTransformer, numeric: list[str], categorical: list[str],
                   target: str = TARGET, num_trees: int = 100, max_depth: int = 30, seed: int = 42,
                   min_instances: int = 1) -> Pipeline:
    """The fitted preparation, index + one-hot (unknown -> all zeros)
    for categorical columns, then the forest. It keeps the node of each row in
    each tree, so that a pass does not lead every row down every tree again."""
    idx = [f"{c}__idx" for c in categorical]
    ohe = [f"{c}__ohe" for c in categorical]
    return Pipeline(stages=[
        prepare,
        StringIndexer(inputCols=[f"{c}__full" for c in categorical], outputCols=idx,
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="keep"),
        VectorAssembler(inputCols=[f"{c}__z" for c in numeric] + ohe, outputCol="features"),
        RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=num_trees,
                              maxDepth=max_depth, seed=seed, featureSubsetStrategy="all",
                              minInstancesPerNode=min_instances, maxMemoryInMB=NODES_MB,
                              cacheNodeIds=True)])


def model_rows(table: DataFrame, key: str, numeric: list[str], categorical: list[str],
               target: str = TARGET) -> DataFrame:
    """``labelled`` rows as the model takes them: the key, numbers as doubles
    and categories as text."""
    rows = labelled(table, numeric + categorical, target, keep=(key,))
    return rows.select(key, *[F.col(c).cast("double").alias(c) for c in numeric],
                       *[F.col(c).cast("string").alias(c) for c in categorical], target)


def spread(rows: DataFrame, n_rows: int) -> DataFrame:
    """The rows dealt evenly over the cores. A stored row is small and its
    training long, so that the few partitions of a scan (one row group of a
    file may hold them all) leave most cores idle; more partitions than needed
    cost too, as each one sends the statistics of all nodes. Sorted, so that
    the forest's seed draws the same rows in every run."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // ROWS_A_TASK))
    return rows.repartition(tasks).sortWithinPartitions(*[f"`{c}`" for c in rows.columns])


def train(spark: SparkSession, table: DataFrame, key: str, numeric: list[str],
          categorical: list[str], model_root: str, target: str = TARGET,
          num_trees: int = 100, max_depth: int = 30, min_instances: int | None = None) -> DataFrame:
    """Clean, split, fit, evaluate, store (A19): each run saves its
    model in its own folder under ``model_root/models`` and appends one
    metrics row naming it to ``model_root/model_store``; returns the first
    rows of the store (G2).

    ``max_depth`` is Spark's limit by default (the source system has none).
    ``min_instances`` (rows a leaf needs) defaults to the training rows over
    MAX_LEAVES, which bounds a tree whatever the number of rows."""
    rows = model_rows(table, key, numeric, categorical, target)
    entries = rows.count()                                            # E6
    # Every pass scans these rows: keep the narrow projection (memory and disk,
    # rebuilt from lineage if an executor is lost), filled by the next pass.
    rows = spread(rows, entries).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_df, test_df = split(rows.na.drop(subset=numeric + categorical), key)   # C3
        prepare = preparation(train_df, numeric, categorical)
        if min_instances is None:
            min_instances = max(1, -(-train_df.count() // MAX_LEAVES))
        model = build_pipeline(prepare, numeric, categorical, target, num_trees, max_depth,
                               min_instances=min_instances).fit(train_df)
        m = regression_metrics(model.transform(test_df), target, "prediction").first()
    finally:
        rows.unpersist()
    model_path = new_version(f"{model_root}/models")     # one saved model per run
    model.write().save(model_path)
    store_path = f"{model_root}/model_store"
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    (spark.createDataFrame([(model_path, now, m["mae"], m["rmse"], entries)],
                           schemas.MODEL_METRICS)
          .coalesce(1).write.mode("append").parquet(store_path))
    return spark.read.parquet(store_path).orderBy("timestamp", "model_path").limit(5)
