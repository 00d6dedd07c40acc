"""Trie of the prefixes that conversations share, with totals of each node's subtree.

Van Emde Boas recursion.  A conversation is a sequence of turns, position 0 being the root's.  Sequences are cut at
half depth: the prefix of a position in the lower half is named by the name of the cut prefix and its own name
within the lower half, so the upper trie and the forests below it are built alike, at half the depth, independently of
each other.  Here all parts of one size are done together, the smallest first: a level joins pairs of neighbouring
blocks of ``2^(k-1)`` positions, and a conversation of n turns takes log2 n levels, not n.

Totals are grafted upward by the same levels: the root of a lower part has the total of its subtree within the
part, which is added to all nodes of the upper part above it, along the positions of one conversation that
holds them.  Totals of roots with the same parent are added up first, so a level moves each position at most once.

Positions stay together in blocks of ``BLOCK`` of a conversation, so a very long one spreads over tasks.  Levels
inside a block share one shuffle; above it, a cut prefix's name is sent to each block below.  A prefix's name is a
SHA-256 digest, so equal names mean equal turns.

Defined results: turns are sorted by turn (null first), then by their digest; null roles and texts are empty; repeated
rows are turns of their own.  Rows with a null conv_id belong to no conversation and are ignored, as are other columns.
An empty table has no conversations and no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, partitions, spread, written

#: Positions of a conversation that stay together: 2^BLOCK_BITS.
BLOCK_BITS = 10
WORD = r"[^\x20\x09-\x0D]+"
_SUM = ("leaves", "saved")


def _sha(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turn_digest(role: Column, text: Column) -> Column:
    """Equal for equal turns only: the length of the role tells where the text begins."""
    return _sha(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary"))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): each conversation's turns, counted from 1.

    One conversation may hold any part of all rows, so these are sorted by range, each range numbers its own turns, and
    the counts of the ranges before it are added.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest(role, text).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    # The row's number only lets equal rows be cut apart.
    ranged = rows.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(
        partitions(rows), "conv_id", "turn", "digest", "nth")
    ranged = written(ranged.withColumn("range", F.spark_partition_id()).drop("nth"))
    own = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy("turn", "digest"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy("conv_id", "range").count()
              .select("conv_id", "range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")))
    return (ranged.withColumn("own", own).join(before, ["conv_id", "range"])
            .select("conv_id", (F.col("own") + F.col("before")).alias("pos"), "digest", "words"))


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, length) of conversations with turns."""
    return turns.groupBy("conv_id").agg(F.max("pos").alias("length"))


def _bits(k: int) -> Column:
    return F.shiftright("pos", k)


def _named(rows: DataFrame, levels: int) -> DataFrame:
    """Adds ``name``, that of the prefix which ends at the position, and ``parent``, that of the one before."""
    rows = rows.withColumn("block", _bits(BLOCK_BITS)).withColumnRenamed("digest", "name")
    lower = lambda k: F.col("pos").bitwiseAND(F.lit(1 << (k - 1)).cast("long")) != 0
    is_cut = lambda k: F.col("pos").bitwiseAND(F.lit((1 << k) - 1).cast("long")) == (1 << (k - 1)) - 1
    for k in range(1, min(levels, BLOCK_BITS) + 1):
        cut = F.max(F.when(is_cut(k), F.col("name"))).over(Window.partitionBy("conv_id", "block", _bits(k)))
        rows = rows.withColumn("cut", cut)
        rows = rows.withColumn("name", F.when(lower(k), _sha(F.col("cut"), F.col("name"))).otherwise(F.col("name")))
    for k in range(BLOCK_BITS + 1, levels + 1):
        rows = written(rows)
        last = F.least(F.shiftleft(_bits(k), k - BLOCK_BITS) + (1 << (k - BLOCK_BITS)) - 1,
                       F.shiftright("length", BLOCK_BITS))
        cuts = (rows.where(is_cut(k) & (F.col("length") > F.col("pos")))
                .select("conv_id", F.explode(F.sequence(F.col("block") + 1, last)).alias("block"), F.col("name").alias("cut")))
        rows = rows.drop("cut").join(cuts, ["conv_id", "block"], "left")
        rows = rows.withColumn("name", F.when(lower(k), _sha(F.col("cut"), F.col("name"))).otherwise(F.col("name")))
    rows = rows.drop("cut")
    inside = F.lag("name").over(Window.partitionBy("conv_id", "block").orderBy("pos"))
    if levels <= BLOCK_BITS:
        return rows.withColumn("parent", inside)
    rows = written(rows)
    ends = rows.where(F.col("pos").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long")) == (1 << BLOCK_BITS) - 1)
    ends = ends.select("conv_id", (F.col("block") + 1).alias("block"), F.col("name").alias("earlier"))
    return (rows.withColumn("parent", inside).join(ends, ["conv_id", "block"], "left")
            .withColumn("parent", F.coalesce("parent", "earlier")).drop("earlier"))


def _grafted(nodes: DataFrame, rows: DataFrame, levels: int) -> DataFrame | None:
    """(name, leaves, saved): what the subtrees below a node add to its own values."""
    added: DataFrame | None = None
    for k in range(1, levels + 1):
        half = 1 << (k - 1)
        root = (F.col("pos") > 0) & (F.col("pos").bitwiseAND(F.lit(2 * half - 1).cast("long")) == half)
        totals = nodes.where(root)
        if added is not None:
            more = added.where(root).groupBy("name").agg(*[F.sum(c).alias(f"{c}_below") for c in _SUM])
            totals = totals.join(more, "name", "left").withColumns(
                {c: F.col(c) + F.coalesce(f"{c}_below", F.lit(0)) for c in _SUM})
        above = totals.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("pos") - 1).alias("cut")).agg(
            *[F.sum(c).alias(c) for c in _SUM])
        bits = min(k - 1, BLOCK_BITS)   # the upper part's positions, or blocks of them
        first, last = F.shiftright(F.col("cut") - (half - 1), bits), F.shiftright("cut", bits)
        above = above.withColumn("part", F.explode(F.sequence(first, last))).drop("cut")
        level = (rows.select("conv_id", "pos", "name", _bits(bits).alias("part")).join(above, ["conv_id", "part"])
                 .groupBy("name", "pos").agg(*[F.sum(c).alias(c) for c in _SUM]))
        level = written(level)
        added = level if added is None else added.unionByName(level)
    return added


def build(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and members of the trie of ``turns`` (conv_id, pos from 1 without gaps, digest, words) of
    ``conversations`` (conv_id, length; length 0 has no turns).

    Nodes: (name, depth, conv_id, parent, parent_conv_id, n_convs, n_ends, n_children, n_leaves, saved_tokens), conv_id
    being the smallest member's.  Members: (conv_id, name) of the node at which each conversation ends.
    """
    root = conversations.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("digest"),
                                F.lit(0).cast("long").alias("words"), "length")
    rows = turns.join(spread(conversations), "conv_id").select(*root.columns).unionByName(root)
    most = conversations.agg(F.max("length")).first()[0] or 0
    levels = int(most).bit_length()
    rows = written(_named(rows, levels))
    nodes = rows.groupBy("name", "pos").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.max("parent").alias("parent"), F.sum((F.col("pos") == F.col("length")).cast("long")).alias("n_ends"))
    nodes = written(nodes.select(
        "name", "pos", "conv_id", "n_convs", "parent", "n_ends", (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = written(nodes.join(spread(parents), "parent", "left"))
    added = _grafted(nodes, rows, levels)
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    out = nodes.join(children, "name", "left")
    if added is not None:
        below = added.groupBy("name").agg(*[F.sum(c).alias(f"{c}_below") for c in _SUM])
        out = out.join(below, "name", "left").withColumns(
            {c: F.col(c) + F.coalesce(f"{c}_below", F.lit(0)) for c in _SUM})
    out = out.select("name", F.col("pos").alias("depth"), "conv_id", "parent", "parent_conv_id", "n_convs", "n_ends",
                     F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                     F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    return out, rows.where("pos = length").select("conv_id", "name")


def prefix_trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`build` of (conv_id, turn, role, text) rows."""
    turns = written(numbered_turns(conversations))
    return build(turns, lengths(turns))


def with_shared_openings(conversations: DataFrame, group: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations, for :func:`build`, after each conversation's first h turns gave way to the first h of
    the conversation ``conv_id - conv_id % group`` (all if it has fewer, none if it is absent); h is the unsigned
    crc32 of the decimal conv_id modulo ``most + 1``."""
    turns = written(numbered_turns(conversations))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    known = written(lengths(turns).select("conv_id", F.col("length").alias("own"), h.alias("h"),
                                          (F.col("conv_id") - F.col("conv_id") % group).alias("base")))
    there = known.select(F.col("conv_id").alias("base"), F.least("own", F.lit(most)).alias("there"))
    known = known.join(there, "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0))).cast("long")
    known = written(known.select("conv_id", "base", "h", taken.alias("taken"),
                                 (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("length")))
    opening = (turns.where(F.col("pos") <= most).withColumnRenamed("conv_id", "base")
               .join(known.select("conv_id", "base", "taken"), "base").where("pos <= taken")
               .select("conv_id", "pos", "digest", "words"))
    rest = (turns.join(spread(known.select("conv_id", "h", "taken")), "conv_id").where("pos > h")
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words"))
    return opening.unionByName(rest), known.select("conv_id", "length")


_TEXTS = pa.schema([("name", pa.binary()), ("first", pa.int64()), ("text", pa.string())])
_DIGESTS = pa.schema([("name", pa.binary()), ("ends_sha256", pa.string())])


def _listed(limit: int):
    def run(batches: Iterator[pa.RecordBatch]):
        name, ids, rows = None, [], []
        for batch in batches:
            for key, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != name or len(ids) == limit:
                    if ids:
                        rows.append({"name": name, "first": ids[0], "text": ",".join(map(str, ids))})
                    name, ids = key, []
                ids.append(conv_id)
            yield pa.RecordBatch.from_pylist(rows, schema=_TEXTS)
            rows = []
        if ids:
            yield pa.RecordBatch.from_pylist([{"name": name, "first": ids[0], "text": ",".join(map(str, ids))}], schema=_TEXTS)
    return run


def _hashed(batches: Iterator[pa.RecordBatch]):
    name, digest = None, None
    for batch in batches:
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if key != name:
                if digest:
                    rows.append({"name": name, "ends_sha256": digest.hexdigest()})
                name, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        yield pa.RecordBatch.from_pylist(rows, schema=_DIGESTS)
    if digest:
        yield pa.RecordBatch.from_pylist([{"name": name, "ends_sha256": digest.hexdigest()}], schema=_DIGESTS)


def ends_digest(members: DataFrame) -> DataFrame:
    """(name, ends_sha256): SHA-256 of each node's ending conv_ids, ascending, decimal, joined by commas.

    Ids are sorted by range and written as texts of bounded length there; a node's texts then stream, in order,
    through one hash, which holds nothing but its state.
    """
    n = partitions(members)
    order = ["name", "conv_id"]
    texts = in_arrow(members.select("name", "conv_id").repartitionByRange(n, *order).sortWithinPartitions(*order),
                     _listed(1 << 14), "name binary, first long, text string")
    return in_arrow(texts.repartition(n, "name").sortWithinPartitions("name", "first"), _hashed,
                    "name binary, ends_sha256 string")
