"""Exact dedup by progressive refinement, in DataFrame operations only.

Texts are equal when they are identical after lower-casing A-Z.  Three keys of growing cost refine the
groups, and each is taken only of rows that the one before left in company:

1. the length in bytes and, from the same scan, a hash of the first characters.  Rows are counted by
   (length, prefix) before they are shuffled; lengths with one row end first, then prefixes;
2. SHA-256 of the full text, read only where the (length, prefix) group survived.

Which rows survived is told by ``CELLS`` hash cells, a broadcast of at most that many numbers whatever
the input; two keys in one cell cost a needless hash, never a wrong group.  Texts never move: rows carry
their hash.  Counts and the largest id are partial aggregates, and the join that hands them back has an
exchange of its own on either side, so that a group of very many copies can be split.

Defined results: null text is the empty text.  Every row comes back, repeated ones too; rows that
repeat the id of the row that stays are all marked as kept.  A null id never wins over another; a
group of null ids only has a null ``keep_id``, and all its rows are kept.  Columns named in ``carry``
come along; other columns, of whatever names, are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, keep

PREFIX_CHARS = 64
CELLS = 1 << 20


def normalised(text: str | Column = "text") -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return ascii_lower(F.coalesce(text, F.lit("")))


def _cell(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(CELLS))


def surviving_cells(rows: DataFrame) -> DataFrame:
    """The cells of (length, prefix) groups that hold more than one row."""
    by_prefix = rows.groupBy("n_bytes", "prefix").agg(F.count(F.lit(1)).alias("n"))
    lengths = by_prefix.groupBy("n_bytes").agg(F.sum("n").alias("of_length")).where("of_length > 1")
    groups = by_prefix.where("n > 1").join(lengths.select("n_bytes"), "n_bytes", "left_semi")
    return groups.select(_cell("n_bytes", "prefix").alias("cell")).distinct()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: Sequence[str] = ()) -> DataFrame:
    """(id, keep_id, group_size, kept, *carry) for every row of ``docs``; the largest id stays."""
    rows = docs.select(
        F.col(id_col), normalised(text_col).alias("_text"), *[F.col(c) for c in carry]).select(
        id_col, *carry, "_text", F.octet_length("_text").alias("n_bytes"),
        F.xxhash64(F.substring("_text", 1, PREFIX_CHARS)).alias("prefix"))
    cells = keep(surviving_cells(rows.select("n_bytes", "prefix"))).withColumn("company", F.lit(True))
    hashed = (rows.withColumn("cell", _cell("n_bytes", "prefix"))
              .join(F.broadcast(cells), "cell", "left")
              .select(id_col, *carry, "n_bytes",
                      F.when(F.col("company"), F.sha2(F.col("_text").cast("binary"), 256)).alias("full")))
    groups = (hashed.where("full is not null").groupBy("full")
              .agg(F.first("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("group_size"),
                   F.max(id_col).alias("keep_id")).where("group_size > 1"))
    # rows that no other can equal take no part in the join: their key is their own
    alone = F.concat(F.lit("-"), F.coalesce(F.xxhash64(id_col), F.lit(0)).cast("string"))
    out = hashed.withColumn("full", F.coalesce("full", alone)).join(groups, ["n_bytes", "full"], "left")
    stays = F.coalesce("keep_id", F.when(F.col("group_size").isNull(), F.col(id_col)))
    return out.select(id_col, stays.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
                      F.col(id_col).eqNullSafe(stays).alias("kept"), *carry)
