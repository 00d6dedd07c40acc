"""Sharding along a Hilbert curve, for files that can be pruned by several columns at once.

Metadata dimensions are quantised to ``2 ** BITS`` levels each; a document's cell is the point of its
levels, and cells are ordered by their index on the Hilbert curve, so that neighbours on the curve are
neighbours in every dimension.  The order is cut into runs: shard s of S holds the ranks from
``ceil(s * N / S)``, so the shards' row counts differ by one at most (law ``rows``).

Ranks come without a global sort: rows are counted by cell (at most ``2 ** (BITS * dimensions)``
cells), cells of many rows are divided by the hash of the row, the counts' running sums give each division
its first rank, and rows are numbered inside their division only.  Both tables of counts are broadcast;
their sizes don't depend on the documents but on the number of cells and of tasks.

Defined results: nulls are a level of their own (0); a null text has 0 bytes.  Ties on the curve are
ordered by the hash of (id, size, checksum), then by these; rows equal in all of them are interchangeable, so
any order gives the same result.  Repeated rows have slots of their own.  An empty table has no
shards with rows.  Columns named in ``carry`` come along.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, partitions

SHARDS = 40
BITS = 4
OVERHEAD = 16


def curve_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points (one row each, coordinates of ``bits`` bits).

    Skilling's transposed form ("Programming the Hilbert curve", 2004) on all points at once: undo the
    excess work from the highest bit down, Gray encode, then interleave the bits.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(on, p, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t ^= np.where(x[n - 1] & (1 << b), (1 << b) - 1, 0)
    x ^= t
    out = np.zeros_like(t)
    for b, i in itertools.product(range(bits - 1, -1, -1), range(n)):
        out = (out << 1) | ((x[i] >> b) & 1)
    return out


def text_level(c: str | Column) -> Column:
    """A string's level: its hash, so a whole value is always in one level (null: 0)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.lit(1 << BITS))).cast("int")


def size_level(c: str | Column) -> Column:
    """A size's level: its order of magnitude to the base 2, from 16 up (null: 0)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), F.floor(F.log2(c)) - 4)), F.lit(0)).cast("int")


def curve(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Adds ``curve``, the index of the row's cell; the table of cells is made by the rule above."""
    points = np.array(list(itertools.product(range(1 << BITS), repeat=len(levels))))
    table = np.zeros(len(points), np.int64)
    cell = sum((points[:, i] << (BITS * i)) for i in range(len(levels)))
    table[cell] = curve_index(points, BITS)
    cells = df.sparkSession.createDataFrame([(int(c), int(h)) for c, h in enumerate(table)], "cell int, curve int")
    own = sum((F.col(c) * (1 << (BITS * i)) for i, c in enumerate(levels)), F.lit(0))
    return df.withColumn("cell", own.cast("int")).join(F.broadcast(cells), "cell").drop("cell")


def _first_ranks(spark, counts, keys: Sequence[str], kinds: str) -> DataFrame:
    """Sorted counts (*keys, n) as a table (*keys, base): the rows before each."""
    base, rows = 0, []
    for r in counts:
        rows.append((*r[:-1], base))
        base += r[-1]
    return spark.createDataFrame(rows, kinds + ", base long")


def hilbert_shards(rows: DataFrame, levels: Sequence[str], order: Sequence[str], n_shards: int = SHARDS,
                   carry: Sequence[str] = ()) -> DataFrame:
    """(*order, *levels, *carry, curve, shard, slot): the shard of each row and its place in it.

    ``rows`` should be narrow: it is written once and read three times.  ``order`` breaks ties.
    """
    spark = rows.sparkSession
    names = list(dict.fromkeys([*order, *levels, *carry]))
    placed = keep(curve(rows.select(*names), levels).withColumn("tie", F.xxhash64(*order)))
    per_cell = [tuple(r) for r in placed.groupBy("curve").agg(F.count(F.lit(1)).alias("n")).collect()]
    total = sum(n for _, n in per_cell)
    share = max(1, total // (4 * partitions(rows)))
    cut = spark.createDataFrame([(c, -(-n // share)) for c, n in per_cell], "curve int, cuts long")
    # divisions of a cell follow the order of the tie's upper bits
    top = F.shiftrightunsigned("tie", 33)
    split = (placed.join(F.broadcast(cut), "curve")
             .withColumn("division", F.shiftright(top * F.col("cuts"), 31)).drop("cuts"))
    per_division = sorted(tuple(r) for r in split.groupBy("curve", "division").agg(F.count(F.lit(1)).alias("n")).collect())
    first = _first_ranks(spark, per_division, ("curve", "division"), "curve int, division long")
    inside = Window.partitionBy("curve", "division").orderBy(F.shiftrightunsigned("tie", 1), "tie", *order)
    ranked = (split.withColumn("in", F.row_number().over(inside) - 1)
              .join(F.broadcast(first), ["curve", "division"])
              .withColumn("rank", F.col("base") + F.col("in")))
    shard = F.expr(f"cast(rank * {n_shards} div {max(total, 1)} as int)")
    begin = F.expr(f"cast((shard * {max(total, 1)}L + {n_shards - 1}) div {n_shards} as long)")
    return (ranked.withColumn("shard", shard).withColumn("slot", F.col("rank") - begin)
            .select(*names, "curve", "shard", "slot"))


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order, so that readers skip files by folder and by min/max."""
    (df.repartition("shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
