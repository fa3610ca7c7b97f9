"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size: it starts at an offset and goes on by a skip, both from a hash of the
shard's name, and so visits every slot once. The shards take turns, each
claiming the first slot on its list that is still free, until the table is
full. Shards then hold equally many slots (to within one), and a shard that
leaves gives up little more than its own slots. A row's slot is a hash of its
key; one lookup in the broadcast table places it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import column, free_name

SLOTS = 65_537               # prime
MAX_SLOTS = 1 << 20          # bound of what is broadcast: one short row per slot
HEX = 15                     # hex digits of the key hash that count (60 bits)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:HEX], 16)


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Index of the shard that holds each slot."""
    if len(set(shards)) != len(shards) or not 1 <= len(shards) <= slots:
        raise ValueError("shard names must be different, at least one and at most the slots")
    if not is_prime(slots) or slots > MAX_SLOTS:
        raise ValueError(f"the table size must be a prime up to {MAX_SLOTS}")
    at = [_hash("offset/" + s) % slots for s in shards]
    skip = [_hash("skip/" + s) % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    table, left = [-1] * slots, slots
    while left:
        for i in range(min(len(shards), left)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            left -= 1
    return table


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard) with one row per slot."""
    table = ",".join(map(str, fill_table(shards, slots)))
    names = F.split(F.lit("\x00".join(shards)), "\x00")
    return (spark.range(1).select(F.posexplode(F.split(F.lit(table), ",")).alias("slot", "i"))
                 .select("slot", F.element_at(names, F.col("i").cast("int") + 1).alias("shard")))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of the md5 of its text, modulo the
    table size; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, HEX), 16, 10).cast("long") % slots).cast("int")


def place(rows: DataFrame, key_col: str, shards: list[str], slots: int = SLOTS, shard_col: str = "shard",
          slot_col: str = "slot") -> DataFrame:
    """``rows`` with the slot and the shard of each, in columns that replace
    those of the same name. Equal keys share a shard; null keys count as the
    empty text. No row moves: the table (at most MAX_SLOTS short rows) is
    broadcast."""
    key, slot, shard = (free_name(rows, n) for n in ("_slot_of_key", "_table_slot", "_table_shard"))
    table = lookup_table(rows.sparkSession, shards, slots).select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    keyed = rows.withColumn(key, slot_of(column(rows, key_col), slots))
    joined = keyed.join(F.broadcast(table), keyed[key] == table[slot])
    own = [joined[f"`{c}`"] for c in rows.columns if c.lower() not in (shard_col.lower(), slot_col.lower())]
    return joined.select(*own, F.col(key).alias(slot_col), F.col(shard).alias(shard_col))


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1, shard_col: str = "shard") -> None:
    """Write a placed table as one folder per shard. Rows go to
    ``files_per_shard`` tasks per shard by a hash of the whole row, so a shard
    with very many rows is no single task."""
    part = F.pmod(F.xxhash64(*[column(placed, c) for c in placed.columns]), F.lit(max(1, files_per_shard)))
    (placed.repartition(F.col(shard_col), part).write.mode("overwrite").partitionBy(shard_col).parquet(path))
