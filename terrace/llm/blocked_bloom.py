"""Blocked Bloom filters over 64-bit hashes, to thin out rows before a shuffle.

Rows that only an equi-join with a much smaller table would drop need not be
shuffled for it: what the filter of that table's keys cannot hold goes where it
is read, and the exact join that follows removes the rest. A filter never holds
more than ``FILTER_BYTES``, so that it can be broadcast whatever the number of
keys; with too many keys it is fuller and lets more rows through.

A key sets one bit in each of eight 64-bit lanes of one block. Keys must be
well-mixed hashes already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BYTES = 32 << 20
BITS_PER_KEY = 16
LANES = 8
_RNG = np.random.default_rng(20240805)
_MULTIPLIERS = _RNG.integers(1 << 62, 1 << 63, LANES, dtype=np.uint64) | np.uint64(1)


def _block(keys: np.ndarray, blocks: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _bit(keys: np.ndarray, lane: int) -> np.ndarray:
    return np.uint64(1) << ((keys * _MULTIPLIERS[lane]) >> np.uint64(58))


def blocks_for(n_keys: int) -> int:
    return max(1, min(-(-n_keys * BITS_PER_KEY // (64 * LANES)), FILTER_BYTES // (8 * LANES)))


def build(keys: DataFrame, name: str):
    """Broadcast filter of the long column ``name`` of ``keys``: tasks set the
    bits of their keys, blocks are joined with ``bit_or``, and the blocks,
    within FILTER_BYTES, come to the driver."""
    blocks = blocks_for(keys.count())
    lanes = [f"b{i}" for i in range(LANES)]

    def run(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if len(own):
                block = _block(own, blocks)
                order = np.argsort(block, kind="stable")
                block, own = block[order], own[order]
                first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                bits = [pa.array(np.bitwise_or.reduceat(_bit(own, i), first).view(np.int64)) for i in range(LANES)]
                yield pa.RecordBatch.from_arrays([pa.array(block[first]), *bits], names=["block", *lanes])

    kind = "block long, " + ", ".join(f"{b} long" for b in lanes)
    rows = (keys.where(F.col(name).isNotNull()).select(name).mapInArrow(run, kind)
                .groupBy("block").agg(*[F.bit_or(b).alias(b) for b in lanes]).toPandas())
    out = np.zeros((blocks, LANES), np.uint64)
    out[rows["block"].to_numpy(np.int64)] = rows[lanes].to_numpy(np.int64).view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(out)


def held(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the keys (64-bit) that the filter may hold, ascending."""
    keys = keys.view(np.uint64)
    if not len(keys):
        return np.zeros(0, np.int64)
    block = _block(keys, len(table))
    left = np.flatnonzero(table[block, 0] & _bit(keys, 0))
    for lane in range(1, LANES):
        left = left[(table[block[left], lane] & _bit(keys[left], lane)) != 0]
    return left


def keep_held(rows: DataFrame, name: str, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose long column ``name`` is not among
    the column ``key`` of ``keys``; none that is there is lost. Nulls go."""
    table = build(keys, key)
    at = rows.columns.index(name)

    def run(batches):
        for batch in batches:
            values = batch.column(at)
            if values.null_count:
                batch = batch.filter(values.is_valid())
                values = batch.column(at)
            yield batch.take(pa.array(held(table.value, values.to_numpy(zero_copy_only=False).astype(np.int64))))

    return rows.mapInArrow(run, rows.schema)
