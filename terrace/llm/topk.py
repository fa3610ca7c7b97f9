"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are quantised to integers and grouped by length into buckets, and the
buckets cut into blocks of bounded size. For a query with a known lower bound
s on its k-th best score, a block needs a cosine of at least
t = s / (|q| * longest vector in the block):

* t above one: no vector of the block can do it, the block is skipped;
* small t: *length* pruning, only vectors at least s / |q| long remain;
* large t: *coordinate* pruning on the query's largest coordinates: what is
  left out adds at most the product of the two remaining lengths.

The remaining products are computed exactly in integers. The bounds start from
a seed of the longest vectors and grow while a task goes through its blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.joins import checked_broadcast

from .shared import column, cut, small_batches

SCALE = 1024
BLOCK_BYTES = 1 << 16        # bytes of vectors in a block
SEED_BLOCKS = 64             # blocks of the longest vectors that give first bounds
LANE_BLOCKS = 32             # blocks of a group that queries are sent to
MAX_LANES = 4096             # groups at most: each gets its copy of the queries
STEPS = 8                    # length buckets for each doubling of the length
FOCUS = 8                    # coordinates looked at in coordinate pruning
SWITCH = 0.3                 # local cosine threshold from which they are
HELD = 1000                  # query blocks whose best rows a task holds
SLACK = 1e-9                 # relative error allowed for in bounds


def quantise(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<long>, length): floor(scale * x) of each component as
    double. Rows with a null id, a null vector or a null or non-finite
    component are left out; of several rows with one id the smallest vector
    counts. An empty vector has length zero."""
    x = column(vectors, vec_col).cast("array<double>")
    rows = (vectors.select(column(vectors, id_col).cast("long").alias("vec_id"), x.alias("x"))
                   .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()))
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf))))
    ints = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    squares = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return (rows.select("vec_id", ints.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
                .select("vec_id", "v", F.sqrt(squares).alias("length")))


def _packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group of ``keys``: ids and vectors as bytes. Groups have
    bounded size by construction of the block number."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        first = pdf.iloc[0]
        return pd.DataFrame([{**{k: first[k] for k in keys}, "longest": float(pdf["length"].max()),
                              "ids": pdf["vec_id"].to_numpy(np.int64).tobytes(),
                              "data": np.stack(pdf["v"].to_numpy()).astype(np.int64).tobytes()}])

    kind = ", ".join(f"{k} long" for k in keys) + ", longest double, ids binary, data binary"
    return rows.groupBy(*keys).applyInPandas(pack, kind)


def _blocks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a block number in each group of ``keys`` (of which ``dim`` is
    the vector size), so that a block has about BLOCK_BYTES of vectors."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    per = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (8 * F.greatest("dim", F.lit(1)))))
    n = F.ceil(F.col("n") / per)
    return (rows.join(sizes, keys)
                .withColumn("block", F.pmod(F.xxhash64("vec_id"), n)).drop("n"))


# ---- inside a task ------------------------------------------------------------

def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def survivors(q: np.ndarray, q_len: float, bound: float, c: np.ndarray, c_len: np.ndarray) -> np.ndarray:
    """Indices of the block's vectors whose product with q may reach ``bound``."""
    longest = c_len.max()
    if bound <= 0 or q_len == 0 or longest == 0:
        return np.arange(len(c)) if bound <= 0 else np.zeros(0, np.int64)
    need = bound / q_len * (1 - SLACK)
    if need > longest:
        return np.zeros(0, np.int64)
    fit = c_len >= need
    if need / longest >= SWITCH:
        at = np.argsort(-np.abs(q))[:FOCUS]
        part_q, part_c = q[at] / q_len, c[:, at].astype(np.float64)
        rest_q = math.sqrt(max(0.0, 1 - float(part_q @ part_q)) + SLACK)
        rest_c = np.sqrt(np.maximum(0, c_len * c_len * (1 + SLACK) - (part_c * part_c).sum(axis=1)))
        fit &= part_c @ part_q + rest_q * rest_c >= need
    return np.flatnonzero(fit)


def search_block(q_ids, q, q_len, bounds, c_ids, c, c_len, k):
    """Per query: (scores, ids) of its best k in the block that reach its bound."""
    for i in range(len(q_ids)):
        at = survivors(q[i], q_len[i], bounds[i], c, c_len)
        scores, ids = c[at] @ q[i], c_ids[at]
        keep = (ids != q_ids[i]) & (scores >= bounds[i])
        yield _best(scores[keep], ids[keep], k)


def _arrays(ids: bytes, data: bytes):
    ids = np.frombuffer(ids, np.int64)
    v = np.frombuffer(data, np.int64).reshape(len(ids), -1)
    f = v.astype(np.float64)
    return ids, v, np.sqrt((f * f).sum(axis=1))


class _Held:
    """Best rows so far of the queries of one block, and their bounds."""

    def __init__(self, ids, data, bounds, k):
        self.ids, self.v, self.length = _arrays(ids, data)
        self.k = k
        self.bounds = np.frombuffer(bounds, np.float64).copy()
        empty = np.zeros(0, np.int64)
        self.best = [(empty, empty)] * len(self.ids)

    def add(self, c_ids, c, c_len):
        found = search_block(self.ids, self.v, self.length, self.bounds, c_ids, c, c_len, self.k)
        for i, (scores, ids) in enumerate(found):
            if len(ids):
                old = self.best[i]
                self.best[i] = _best(np.concatenate([old[0], scores]), np.concatenate([old[1], ids]), self.k)
                if len(self.best[i][0]) == self.k:
                    self.bounds[i] = max(self.bounds[i], float(self.best[i][0][-1]))

    def rows(self):
        n = [len(s) for s, _ in self.best]
        return pd.DataFrame({"query_id": np.repeat(self.ids, n),
                             "vec_id": np.concatenate([i for _, i in self.best]),
                             "score": np.concatenate([s for s, _ in self.best])})


def _searched(k: int):
    """mapInPandas function over rows of (query block, candidate block)."""
    def run(batches):
        held: dict[tuple, _Held] = {}
        for pdf in batches:
            last, block = None, None
            for r in pdf.itertuples(index=False):
                key = (r.dim, r.q_block)
                if key not in held:
                    if len(held) >= HELD:
                        yield from (h.rows() for h in held.values())
                        held.clear()
                    held[key] = _Held(r.q_ids, r.q_data, r.bounds, k)
                if last is not r.ids:
                    last, block = r.ids, _arrays(r.ids, r.data)
                held[key].add(*block)
        yield from (h.rows() for h in held.values())

    return run


RESULT = "query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = SCALE, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """For every row whose id satisfies ``is_query`` (a function of the id
    column): its ``k`` best other rows by integer inner product: query_id,
    rank (from 1), vec_id, score. Ties go to the smaller id; fewer rows are
    returned where there are fewer. Only vectors of the query's size are its
    candidates. Rows that ``quantise`` leaves out take no part; other columns
    are ignored; an empty table gives no rows."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = quantise(vectors, scale, id_col, vec_col).withColumn("dim", F.size("v").cast("long"))
    step = F.when(F.col("length") > 0, F.floor(F.log2("length") * STEPS)).otherwise(F.lit(-1))
    rows = cut(rows.withColumn("bucket", step.cast("long")), "topk-vectors")
    blocks = cut(_packed(_blocks(rows, ["dim", "bucket"]), ["dim", "bucket", "block"]), "topk-blocks")
    queries = _packed(_blocks(rows.where(is_query(F.col("vec_id"))), ["dim"]), ["dim", "block"]).select(
        "dim", F.col("block").alias("q_block"), F.col("longest").alias("q_longest"),
        F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    queries = cut(queries, "topk-queries")

    # The blocks are ranked without their vectors; each input part sends its
    # first SEED_BLOCKS only. The winners (4 MiB for a vector size) go to the
    # queries, which stay where they are.
    longest = Window.partitionBy("dim").orderBy(F.desc("longest"), "bucket", "block")
    names = blocks.select("dim", "bucket", "block", "longest").withColumn("r", F.row_number().over(longest))
    names = names.where(F.col("r") <= SEED_BLOCKS).select("dim", "bucket", "block")
    seeds = cut(blocks.join(names, ["dim", "bucket", "block"]).select("dim", "ids", "data"), "topk-seeds")
    seeds = checked_broadcast(seeds, name="seed blocks", persist=False)
    unknown = F.expr(f"unhex(repeat('{np.float64(-np.inf).tobytes().hex()}', length(q_ids) div 8))")
    first = (queries.repartition("dim", "q_block").join(seeds, "dim").withColumn("bounds", unknown)
                    .select("dim", "q_block", "q_ids", "q_data", "bounds", "ids", "data")
                    .mapInPandas(_searched(k), RESULT))
    known = (_ranked(first, k).where(F.col("rank") == k)
             .select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bound")))

    bounds = _with_bounds(queries, known)
    lanes = min(MAX_LANES, max(1, -(-blocks.count() // LANE_BLOCKS)))
    lane = F.pmod(F.xxhash64("dim", "bucket", "block"), F.lit(lanes)).cast("int")
    sent = bounds.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    # No product of two blocks passes that of their longest vectors: pairs that
    # cannot reach the least bound of their queries are not made.
    reach = F.col("longest") * F.col("q_longest") * (1 + SLACK) >= F.col("least")
    other = blocks.withColumn("lane", lane).withColumnRenamed("dim", "c_dim").withColumnRenamed("lane", "c_lane")
    pairs = sent.join(other, (F.col("dim") == F.col("c_dim")) & (F.col("lane") == F.col("c_lane")) & reach)
    found = pairs.select("dim", "q_block", "q_ids", "q_data", "bounds", "ids", "data").mapInPandas(
        _searched(k), RESULT)
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _with_bounds(queries: DataFrame, known: DataFrame) -> DataFrame:
    """Query blocks with the bounds of their queries as bytes (minus infinity
    where the seed had fewer than k rows), and the least of them."""
    def ids(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                own = np.frombuffer(r.q_ids, np.int64)
                yield pd.DataFrame({"dim": r.dim, "q_block": r.q_block, "vec_id": own,
                                    "place": np.arange(len(own))})

    listed = queries.select("dim", "q_block", "q_ids").mapInPandas(
        ids, "dim long, q_block long, vec_id long, place long").join(known, "vec_id", "left")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        bounds = pdf.sort_values("place")["bound"].fillna(-np.inf).to_numpy(np.float64)
        return pd.DataFrame([{"dim": pdf["dim"].iloc[0], "q_block": pdf["q_block"].iloc[0],
                              "least": bounds.min(), "bounds": bounds.tobytes()}])

    packed = listed.groupBy("dim", "q_block").applyInPandas(pack, "dim long, q_block long, least double, bounds binary")
    return queries.join(packed, ["dim", "q_block"])
