"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a target: its weight's share of all words, at most ``MAX_REPEAT`` times its own words;
what capped sources can't take goes to the others by weight, until none is above its cap.  A source takes
``floor(target / size)`` whole passes, and the rest of its target from the documents whose hash lies
at or below a threshold.  The threshold is found without sorting:

* words are summed by (source, bucket of the hash's top bits), partial sums first;
* running sums over a source's buckets give the bucket in which the rest runs out;
* that bucket alone is divided by the next bits, and so on, until it holds one hash.  Budgets nest: the
  words of buckets before the boundary are settled and only the remainder goes down a level.

The document at the boundary is taken if that comes nearer to the target.  Documents are then filtered by
comparing their hash with the source's threshold.  Only one row per source passes through the driver.

The hash is of the id, so reruns agree.  Where rows that repeat an id meet at a boundary, they are divided by a hash of
their text in the same way, and rows that repeat both, being alike, by their number.

Defined results: size is the number of words ``[^\\x20\\x09-\\x0D]+``, 0 for null and empty texts.  A
null source is a source, the last one; a null id hashes like the text "null".  A source without words
has target 0 and takes nothing.  Columns named in ``carry`` come along.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, keep
from .words import SPACED, Words, batch_texts

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
HASH_BITS = 60
LEVEL_BITS = 10
BROADCAST_ROWS = 50_000


def id_hash(c: str | Column) -> Column:
    """60 bits of the MD5 of the id's text."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.coalesce(c.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def text_hash(c: str | Column) -> Column:
    """60 bits of the MD5 of a text; null has one of its own."""
    c = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(F.coalesce(F.concat(F.lit("t"), c), F.lit("null")).cast("binary")), 1, HASH_BITS // 4),
                  16, 10).cast("long")


def _count_words(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in batch_texts(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(Words(part.column(0), SPACED).counts)], schema=schema)
    return run


def sized(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, *carry, size): the words of each text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    rows = docs.select("text", "doc_id", "source", *rest)
    out = rows.drop("text").withColumn("size", F.lit(0).cast("long")).schema
    counted = in_arrow(rows, _count_words(to_arrow_schema(out)), out)
    return counted.select("doc_id", "source", *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "size")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: int = MAX_REPEAT) -> list[float]:
    """The target of each source, in the order given (weights repeat along it)."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total = sum(n for _, n in sizes)
    capped: set[int] = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = total - most * sum(sizes[i][1] for i in capped)
        weight = sum(w[i] for i in free)
        over = {i for i in free if rest * w[i] > most * sizes[i][1] * weight}
        if not over:
            return [float(most * n) if i in capped else rest * w[i] / weight if weight else 0.0
                    for i, (_, n) in enumerate(sizes)]
        capped |= over


def _small(df: DataFrame, rows: int) -> DataFrame:
    """One row per source: broadcast where that is small, else joined like any other table."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _edges(rows: DataFrame, rests: list[tuple[str, float]]) -> dict[str, tuple[int, float, int, int]]:
    """The hash at which each source's remaining target (source key, words) runs out: (hash, what is left of the target
    before it, the words and the number of the rows that have it)."""
    spark = rows.sparkSession
    state = [(k, rest, 0) for k, rest in rests]  # and the bits settled so far
    settled: dict[str, tuple[int, float, int, int]] = {}
    shift = HASH_BITS
    while state and shift > 0:
        above, shift = shift, max(0, shift - LEVEL_BITS)
        known = spark.createDataFrame(state, "key string, rest double, prefix long")
        hist = (rows.join(_small(known, len(state)), "key").where(F.shiftright("hash", above) == F.col("prefix"))
                .groupBy("key", "rest", F.shiftright("hash", shift).alias("bucket"))
                .agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("m"), F.min("hash").alias("lo"), F.max("hash").alias("hi")))
        order = Window.partitionBy("key").orderBy("bucket")
        edges = (hist.withColumn("before", F.sum("n").over(order) - F.col("n"))
                 .where("before <= rest and before + n > rest").collect())
        state = []
        for r in edges:
            if r["lo"] == r["hi"]:
                settled[r["key"]] = (r["hi"], r["rest"] - r["before"], r["n"], r["m"])
            else:
                state.append((r["key"], r["rest"] - r["before"], r["bucket"]))
    return settled


def _nearest(rest: float, size: float, most: int) -> int:
    """How many of ``most`` rows of one size come nearest to ``rest`` words; the fewer if two numbers do."""
    k = min(most, int(rest // size))
    return min(most, k + ((k + 1) * size - rest < rest - k * size))


class Cut:
    """Which rows of each source the rest of its target takes: hashes up to ``below``; of hash ``edge`` those of text
    hashes up to ``text_below``, and of text hash ``text_edge`` the first ``some``."""

    NONE = (-1, -1, -1, -1, 0)
    SCHEMA = "below long, edge long, text_below long, text_edge long, some long"

    def __init__(self, rows: DataFrame, rests: list[tuple[str, float]]):
        found = _edges(rows.select("key", "hash", "size"), rests)
        self.of: dict[str, tuple[int, int, int, int, int]] = {}
        several = {}
        for key, (at, rest, n, m) in found.items():
            if m == 1:
                self.of[key] = (at - 1 + _nearest(rest, n, 1), -1, -1, -1, 0)
            else:
                several[key] = (at, rest)
        if several:
            edges = rows.sparkSession.createDataFrame([(k, at) for k, (at, _) in several.items()], "key string, hash long")
            same = rows.join(_small(edges, len(several)), ["key", "hash"]).select("key", F.col("text_hash").alias("hash"), "size")
            found = _edges(same, [(k, rest) for k, (_, rest) in several.items()])
            for key, (at, rest) in several.items():
                text, rest, n, m = found[key]
                some = _nearest(rest, n / m, m)
                self.of[key] = (at - 1, at, text - (some < m), text if 0 < some < m else -1, some)
        self.divides = any(c[3] >= 0 for c in self.of.values())

    def taken(self, rows: DataFrame) -> DataFrame:
        """Adds ``more``: 1 for the rows that are taken, else 0.  ``rows`` have the columns of ``SCHEMA``."""
        edge = F.col("hash") == F.col("edge")
        sure = (F.col("hash") <= F.col("below")) | (edge & (F.col("text_hash") <= F.col("text_below")))
        if not self.divides:
            return rows.withColumn("more", sure.cast("int"))
        # Equal rows are numbered inside the task that reads them, and the tasks' counts are added up.
        alike = edge & (F.col("text_hash") == F.col("text_edge"))
        kept = keep(rows.withColumn("nth", F.monotonically_increasing_id()))
        split = kept.where(alike).withColumn("task", F.shiftright("nth", 33))
        earlier = Window.partitionBy("key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        before = (split.groupBy("key", "task").count()
                  .select("key", "task", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")))
        own = F.row_number().over(Window.partitionBy("key", "task").orderBy("nth"))
        some = (split.withColumn("own", own).join(before, ["key", "task"])
                .withColumn("more", (F.col("own") + F.col("before") <= F.col("some")).cast("int")))
        return kept.where(~alike).withColumn("more", sure.cast("int")).unionByName(some.select(*kept.columns, "more"))


def mix_sources(docs: DataFrame, carry: Sequence[str] = (), weights=WEIGHTS, most: int = MAX_REPEAT) -> DataFrame:
    """(doc_id, source, *carry, size, source_size, target, copies): ``copies`` says how often the mix
    takes the document (0 to ``most``)."""
    spark = docs.sparkSession
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    source, hashed = F.col("source").cast("string"), text_hash(F.col("text").cast("string"))

    def hashes(df: DataFrame) -> DataFrame:
        return df.withColumns({"key": key, "hash": id_hash("doc_id")})

    narrow = sized(docs.select("doc_id", "text", source.alias("source"), hashed.alias("text_hash")), ["text_hash"])
    narrow = keep(hashes(narrow))
    sizes = sorted(((r["source"], r["n"]) for r in
                    narrow.groupBy("source").agg(F.sum("size").alias("n")).collect()),
                   key=lambda r: (r[0] is None, (r[0] or "").encode()))
    goal = targets(sizes, weights, most)
    plan = []
    for (name, n), target in zip(sizes, goal):
        passes = min(most, int(target // n)) if n else 0
        plan.append(("n" if name is None else "s" + name, n, target, passes))
    cut = Cut(narrow, [(k, t - passes * n) for k, n, t, passes in plan if n and t > passes * n])
    known = spark.createDataFrame([(*p, *cut.of.get(p[0], Cut.NONE)) for p in plan],
                                  f"key string, source_size long, target double, passes int, {Cut.SCHEMA}")
    rows = narrow
    if carry:
        own = docs.select("doc_id", "text", source.alias("source"), *[F.col(c).alias(f"kept{i}") for i, c in enumerate(carry)],
                          hashed.alias("text_hash"))
        rows = hashes(sized(own, [*[f"kept{i}" for i in range(len(carry))], "text_hash"]))
    chosen = cut.taken(rows.join(_small(known, len(plan)), "key"))
    copies = F.least(F.lit(most), F.col("passes") + F.col("more"))
    return chosen.select("doc_id", "source", *[F.col(f"kept{i}").alias(c) for i, c in enumerate(carry)], "size",
                         "source_size", "target", copies.alias("copies"))
