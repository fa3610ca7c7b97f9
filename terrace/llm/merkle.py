"""Merkle manifest of a dataset with incremental witnesses.

The tree. Every row is a leaf; the leaves of a group, in order, are joined in
runs of three consecutive nodes, level by level, until one node, the subroot,
remains; the subroots of all groups, in order, are joined the same way into
the root. H is the lower-case hex SHA-256 of its inputs put together, digests
as hex text. The last run of a level may hold fewer nodes, even one.

1. Rows are ranked within their group by a range partitioning and the sizes of
   its parts, so that a group with most of the rows is spread over all tasks.
2. A group is cut at multiples of 3^HEIGHT into aligned blocks. A task streams
   the leaves of a block through an *appender*: every open subtree holds the
   partial witnesses of the leaves below it, and whenever a later sibling
   completes a run, the witnesses below each of its nodes are extended by the
   other nodes. One block is in memory at a time.
3. The block roots are further appends: they are the leaves of the next round,
   until each group has one node, and then the subroots go through the same
   rounds as one group. Each round has 3^HEIGHT times fewer rows.
4. On the way back down, the witness of a block root is put behind the
   witnesses of its leaves (a join by block).

A witness is binary: per level one byte, 4 * (place in the run) + (number of
siblings), and the siblings' 32-byte digests from left to right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import column, cut, small_batches

RUN = 3
HEIGHT = 6                   # levels of a block: 729 leaves


# ---- digests -------------------------------------------------------------------

def row_digest(fields: list[Column]) -> Column:
    """H of the fields in order, each ``-`` if null, else its number of UTF-8
    bytes, a colon and its value as text."""
    parts = []
    for f in fields:
        value = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def join_nodes(nodes: list[bytes]) -> bytes:
    """The parent of a run of nodes."""
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def levels_of(leaves: int) -> int:
    """Levels of runs above that many nodes until one remains."""
    n = 0
    while leaves > 1:
        leaves = -(-leaves // RUN)
        n += 1
    return n


# ---- appending -----------------------------------------------------------------

class Appender:
    """Open subtrees of one block with the partial witnesses below them."""

    def __init__(self, levels: int):
        self.levels = levels
        # Per level the open run: (node, witnesses of the leaves below it).
        self.open: list[list[tuple[bytes, list[bytearray]]]] = [[] for _ in range(levels + 1)]
        self.witnesses: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        witness = bytearray()
        self.witnesses.append(witness)
        self._add(0, leaf, [witness])

    def _add(self, level: int, node: bytes, below: list[bytearray]) -> None:
        self.open[level].append((node, below))
        if level < self.levels and len(self.open[level]) == RUN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [node for node, _ in run]
        for place, (_, below) in enumerate(run):
            step = bytes([4 * place + len(run) - 1]) + b"".join(nodes[:place] + nodes[place + 1:])
            for witness in below:
                witness += step
        self._add(level + 1, join_nodes(nodes), [w for _, below in run for w in below])

    def close(self) -> bytes:
        """Complete the last run of every level; the root of the block."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        return self.open[self.levels][0][0]


def fold(node: bytes, witness: bytes) -> tuple[str, str]:
    """(root that ``node`` leads to, H of the siblings) along a witness."""
    at, proof = 0, hashlib.sha256()
    while at < len(witness):
        place, n = divmod(witness[at], 4)
        siblings = witness[at + 1:at + 1 + 32 * n]
        proof.update(siblings.hex().encode())
        run = siblings[:32 * place] + node + siblings[32 * place:]
        node = hashlib.sha256(run.hex().encode()).digest()
        at += 1 + 32 * n
    return node.hex(), proof.hexdigest()


_GROWN = T.StructType([
    T.StructField("g", T.StringType()), T.StructField("block", T.LongType()),
    T.StructField("total", T.LongType()), T.StructField("node", T.BinaryType()),
    T.StructField("carry", T.BinaryType()), T.StructField("id", T.LongType()),
    T.StructField("witness", T.BinaryType()), T.StructField("block_root", T.BinaryType())])


def _grow(height: int):
    """Rows sorted by group, block and rank, streamed block by block: each row
    with its witness within the block, the first one with the block's root."""
    schema = pa.schema([("g", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("node", pa.binary()),
                        ("carry", pa.binary()), ("id", pa.int64()), ("witness", pa.binary()),
                        ("block_root", pa.binary())])
    names = ["g", "block", "total", "node", "carry", "id"]

    def closed(rows, tree):
        root = tree.close()
        return [(*row, bytes(witness), root if i == 0 else None)
                for i, (row, witness) in enumerate(zip(rows, tree.witnesses))]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, tree = None, [], None
        for b in batches:
            out = []
            for row in zip(*(b.column(n).to_pylist() for n in names)):
                if row[:2] != now:
                    if rows:
                        out += closed(rows, tree)
                    now, rows, tree = row[:2], [], Appender(min(height, levels_of(row[2])))
                rows.append(row)
                tree.append(row[3])
            if out:
                yield batch(out)
        if rows:
            yield batch(closed(rows, tree))

    return run


# ---- Spark ---------------------------------------------------------------------

def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) within the group ``g`` by ``order`` and
    the group's ``total``. Groups are in order too, null first.

    The rank is the place in a range-partitioned, sorted table less what stands
    before the group; only the sizes of (group, part) pairs are added up."""
    by = [F.col("g").asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in order]
    placed = cut(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                     .withColumn("place", F.monotonically_increasing_id()), f"{name}-sorted")
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumn("part", part).withColumn("at", at).drop("place")
    sizes = placed.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("g").alias("g2"), F.col("part").alias("part2"),
                         (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("n").over(whole).alias("total"))
    return (placed.join(sizes, (F.col("part") == F.col("part2")) & F.col("g").eqNullSafe(F.col("g2")))
                  .withColumn("rank", F.col("at") + F.col("shift")).drop("g2", "part2", "part", "at", "shift"))


def _blocks(rows: DataFrame, height: int, name: str) -> DataFrame:
    """Witnesses within the blocks of rows (g, rank, total, node, carry, id)."""
    keyed = rows.select("g", F.floor(F.col("rank") / RUN ** height).alias("block"), "rank", "total", "node", "carry", "id")
    keyed = keyed.repartition("g", "block").sortWithinPartitions("g", "block", "rank")
    return cut(keyed.select("g", "block", "total", "node", "carry", "id").mapInArrow(_grow(height), _GROWN), name)


def grow(rows: DataFrame, height: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Whole trees of the groups of ``rows`` (g, rank, total, node, carry, id):
    (rows with ``g``, ``node``, ``carry``, ``id``, ``witness`` up to the
    group's root, which is ``top``; roots (g, node) of the groups)."""
    rounds = []
    more = True
    while more:
        rounds.append(_blocks(rows, height, f"{name}-{len(rounds)}"))
        heads = rounds[-1].where("block_root IS NOT NULL")
        more = bool(heads.where(F.col("total") > RUN ** height).limit(1).count())
        nothing = F.lit(None)
        # A block root's ``id`` is its number in its own round.
        rows = heads.select("g", F.col("block").alias("rank"),
                            F.ceil(F.col("total") / RUN ** height).alias("total"), F.col("block_root").alias("node"),
                            F.lit(None).cast("binary").alias("carry"), F.col("block").alias("id"))
    # The last round has one block a group: its root is the group's.
    above = heads.select(F.col("g").alias("g2"), F.col("block").alias("block2"),
                         F.col("block_root").alias("top"), F.lit(b"").alias("rest"))
    for depth in range(len(rounds) - 1, -1, -1):
        done = (rounds[depth].join(above, F.col("g").eqNullSafe(F.col("g2")) & (F.col("block") == F.col("block2")))
                             .withColumn("witness", F.concat("witness", "rest")).drop("g2", "block2", "rest"))
        if depth:
            above = cut(done.select(F.col("g").alias("g2"), F.col("id").alias("block2"), "top",
                                    F.col("witness").alias("rest")), f"{name}-up-{depth}")
    return done, heads.select("g", F.col("block_root").alias("node"))


def witnesses(leaves: DataFrame, height: int = HEIGHT, name: str = "merkle") -> DataFrame:
    """``leaves`` (g: group as string, id: long, node: 32-byte digest, carry:
    any binary) with ``subroot``, ``root`` (digests) and ``witness`` (from the
    leaf to the root). Leaves are ordered by id, then digest, null ids first;
    groups in order, null first. No rows give no rows."""
    done, subroots = grow(ranked(leaves.select("g", "id", "node", "carry"), ["id", "node", "carry"], name), height, name)
    alone = subroots.select(F.lit(None).cast("string").alias("g"), F.col("g").alias("source"), "node")
    alone = ranked(alone, ["source"], f"{name}-top")
    # The group's name rides in ``carry``, with a mark that tells null from "".
    alone = alone.select("g", "rank", "total", "node", F.lit(None).cast("long").alias("id"),
                         F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).cast("binary").alias("carry"))
    top, _ = grow(alone, height, f"{name}-top")
    top = top.select(F.col("carry").cast("string").alias("group_name"), F.col("top").alias("root"),
                     F.col("witness").alias("upper"))
    own = F.coalesce(F.concat(F.lit("="), "g"), F.lit("-"))
    return (done.withColumn("group_name", own).join(top, "group_name")
                .select("g", "id", "node", "carry", F.col("top").alias("subroot"), "root",
                        F.concat("witness", "upper").alias("witness")))


_FOLDED = T.StructType([T.StructField("folded", T.StringType()), T.StructField("proof", T.StringType())])


@F.pandas_udf(_FOLDED)
def folded(nodes: pd.Series, steps: pd.Series) -> pd.DataFrame:
    """Root reached from a digest along a witness, and H of the siblings."""
    return pd.DataFrame([fold(bytes(n), bytes(w)) for n, w in zip(nodes, steps)], columns=["folded", "proof"])


def manifest(docs: DataFrame, fields: list[str], copies: Column | None = None,
             id_col: str = "doc_id", group_col: str = "source", height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: id, leaf (hex digest of ``fields``), copy
    (``copies`` as given, a hex digest to audit, else null), subroot, root (hex)
    and witness (binary, from the leaf to the root).

    Null groups are a group, before all others; null ids come first in their
    group; equal ids are ordered by their digests, and repeated rows are
    repeated leaves. Other columns are ignored; an empty table gives no rows."""
    small_batches(docs.sparkSession)
    leaf = row_digest([column(docs, f) for f in fields])
    leaves = cut(docs.select(column(docs, group_col).cast("string").alias("g"),
                             column(docs, id_col).cast("long").alias("id"), F.unhex(leaf).alias("node"),
                             F.unhex(F.lit(None).cast("string") if copies is None else copies).alias("carry")),
                 "merkle-leaves")
    hexed = lambda c: F.lower(F.hex(c))
    return witnesses(leaves, height).select("id", hexed("node").alias("leaf"), hexed("carry").alias("copy"),
                                    hexed("subroot").alias("subroot"), hexed("root").alias("root"), "witness")


def audit(rows: DataFrame) -> DataFrame:
    """Rows of ``manifest`` with folded_root (the root that the copy's digest,
    or the leaf's where there is no copy, leads to along the witness),
    proof_sha256 (H of the siblings) and verified (folded_root equals root)."""
    small_batches(rows.sparkSession)
    both = folded(F.unhex(F.coalesce("copy", "leaf")), F.col("witness"))
    return (rows.withColumn("both", both)
                .withColumns({"folded_root": F.col("both.folded"), "proof_sha256": F.col("both.proof"),
                              "verified": F.col("both.folded") == F.col("root")}).drop("both"))
