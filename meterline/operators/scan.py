"""Per-key computations in event order that stay balanced when one key is huge.

A running total per key is naturally a window partitioned by the key, but one window partition is
processed by one task: a key holding a third of all rows would put a third of the data into one task.
So a key's rows are cut into time buckets of a fixed ``width``:

1. rows are aggregated by (key, bucket), combined before the shuffle;
2. a window over a key's buckets, one row each, gives what a bucket needs from the others (the carry);
3. the carry is joined back by (key, bucket), and a window inside (key, bucket) does the rest.

The join and the last window share one shuffle of the rows.  A hot key spreads over its buckets, so
``width`` bounds what a task gets; it should be chosen so that a bucket of the busiest key fits one.
Where a bucket may not fit (a key with very many rows in one second, or without a time), ``piece_rows`` cuts buckets
again, by the whole order: about one row in ``piece_rows``, chosen by its hash, begins a new piece, so that pieces have
that many rows on average however times and ties are spread, and buckets of fewer rows mostly stay whole.  (key,
bucket, piece) then takes the place of (key, bucket); rows equal in the whole order stay together.  Pieces are found
in levels, so the work grows with the rows: one in ``piece_rows * FAN ** 3`` rows begins a piece of the coarsest level,
one in ``FAN`` times fewer a piece of the next, inside the first.  The lists of chosen rows take four more passes and are
joined to the rows level by level, which Spark may split; a row finds its place in a list by binary search.
Everything is a DataFrame expression: no job runs while a result is being defined, nothing is written, and
there is no switch on size.  ``plan="window"`` is the plain window, for input that is partitioned by key
already (a bucketed table).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = timedelta(hours=1)
FAN = 128                            # chosen rows of one level in a piece of the level above, on average
LEVELS = 4                           # of pieces; good for buckets of piece_rows * FAN ** LEVELS rows
BROADCAST_RATE = 1 << 20             # levels of one chosen row in so many, or fewer, are broadcast
_KEY, _BUCKET = "_key", "_bucket"


def check_sums(sums, values):
    """Raise if a running sum left the 64-bit range.  ``sums`` wrap, so the sum before a value is exactly
    ``sum - value`` again, and an addition overflowed if both terms have the sign that the sum lacks."""
    before = sums - values
    if (((before ^ sums) & (values ^ sums)) < 0).any():
        raise OverflowError("running usage total exceeds the 64-bit range")
    return sums


def _whole(plan: str) -> bool:
    if plan not in ("buckets", "window"):
        raise ValueError(f"unknown plan {plan!r}")
    return plan == "window"


def time_buckets(df: DataFrame, keys: Sequence[str], time: str, width: timedelta = WIDTH) -> DataFrame:
    """Adds the key as one struct, which compares nulls as equal, and the number of the time bucket."""
    us = max(1, width // timedelta(microseconds=1))
    kind = df.schema[time].dataType
    at = F.unix_micros(time) if isinstance(kind, T.TimestampType) else F.col(time).cast("long") * 1_000_000
    return df.withColumns({_KEY: F.struct(*keys), _BUCKET: F.floor(at / F.lit(us))})


def _with_carry(rows: DataFrame, parts: list[Column], carry: dict[str, Column]) -> DataFrame:
    per = rows.groupBy(_KEY, _BUCKET).agg(*parts)
    return rows.join(per.withColumns(carry).select(_KEY, _BUCKET, *carry), [_KEY, _BUCKET])


def _same_bucket(rows: DataFrame) -> DataFrame:
    """Null buckets (rows without a time) join as well: they get a number before all others."""
    return rows.withColumn(_BUCKET, F.coalesce(_BUCKET, F.lit(-(1 << 63) + 1)))


def _placed(rows: DataFrame, levels: list[DataFrame], parts: list[str]) -> DataFrame:
    """Adds to rows with ``_place`` the piece they lie in, level by level: how many chosen rows of the piece above are at
    or before it, by binary search."""
    def further(found: Column, step: Column) -> Column:
        return F.when(F.get("_marks", found + step - 1) <= F.col("_place"), found + step).otherwise(found)

    steps = F.lit([1 << b for b in range(30, -1, -1)])
    for n, marks in enumerate(levels):
        found = F.when(F.col("_marks").isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), further))
        rows = rows.join(marks, parts[:2 + n], "left").withColumn(parts[2 + n], found).drop("_marks")
    return rows


def _marks(chosen: DataFrame, up: list[str]) -> DataFrame:
    """The chosen rows of each piece, in order."""
    return chosen.groupBy(*up).agg(F.sort_array(F.collect_list("_place")).alias("_marks"))


def _cut(rows: DataFrame, order: Sequence[str], piece_rows: int) -> DataFrame:
    """Makes the bucket a struct of its number and the piece of it that a row lies in, a number for each level.

    The chosen rows of a level are among those of the next, which are listed by the level's pieces; so a row meets some
    ``FAN`` chosen rows a level, however many the bucket has.  Two levels are made at a time: a window
    holds the finer one's chosen rows in a piece of the levels before, some ``FAN ** 2``."""
    if piece_rows < 1:
        raise ValueError("piece_rows must be at least 1")
    hashed, levels = F.xxhash64(_KEY, *order), []
    parts = [_KEY, _BUCKET, *[f"_piece{n}" for n in range(LEVELS)]]

    def one_in(rate: int) -> Column:
        return F.pmod("_hash", F.lit(rate).cast("long")) == 0

    for n in range(0, LEVELS, 2):
        coarse, fine = (piece_rows * FAN ** (LEVELS - 1 - i) for i in (n, n + 1))
        up, piece = parts[:2 + n], parts[2 + n]
        chosen = rows.select(_KEY, _BUCKET, F.struct(*order).alias("_place"), hashed.alias("_hash")).where(one_in(fine))
        inside = Window.partitionBy(*up).orderBy("_place")
        chosen = (_placed(chosen.distinct(), levels, parts)
                  .withColumn(piece, F.sum(F.when(one_in(coarse), 1).otherwise(0)).over(_up_to(inside)).cast("int")))
        pair = [_marks(chosen.where(one_in(coarse)), up), _marks(chosen, [*up, piece])]
        levels += [F.broadcast(marks) for marks in pair] if fine >= BROADCAST_RATE else pair
    pieces = parts[2:]
    return (_placed(rows.withColumn("_place", F.struct(*order)), levels, parts)
            .withColumn(_BUCKET, F.struct(F.col(_BUCKET).alias("bucket"), *pieces)).drop("_place", *pieces))


def _rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], width: timedelta, piece_rows: int | None) -> DataFrame:
    rows = _same_bucket(time_buckets(df, keys, order[0], width))
    return rows if piece_rows is None else _cut(rows, order, piece_rows)


def _inside(order: Sequence[str]):
    return Window.partitionBy(_KEY, _BUCKET).orderBy(*order)


def _across():
    return Window.partitionBy(_KEY).orderBy(_BUCKET)


def _up_to(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                prev_order: str | None = None, plan: str = "buckets", width: timedelta = WIDTH,
                piece_rows: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``value`` over the key's rows up to and including this row.

    ``order`` must be a total order within a key (add a tie column) and begin with its time.  Nulls add
    nothing.  With ``prev_order`` set, also add ``_prev`` = the first ``order`` column of the key's
    previous row (null on the first row).  Sums are checked: an overflow raises instead of wrapping.
    """
    order, amount = list(order), F.coalesce(F.col(value), F.lit(0)).cast("long")
    if _whole(plan):
        w = Window.partitionBy(*keys).orderBy(*order)
        res = df.withColumn(out, F.sum(amount).over(_up_to(w)))
        return res.withColumn("_prev", F.lag(order[0]).over(w)) if prev_order else res
    rows = _rows(df, keys, order, width, piece_rows)
    before = _across().rowsBetween(Window.unboundedPreceding, -1)
    res = _with_carry(rows, [F.sum(amount).alias("_part"), F.max(order[0]).alias("_last")],
                      {"_carry": F.coalesce(F.sum("_part").over(before), F.lit(0)),
                       "_carry_last": F.lag("_last").over(_across())})
    res = res.withColumn(out, F.col("_carry") + F.sum(amount).over(_up_to(_inside(order))))
    if prev_order:
        res = res.withColumn("_prev", F.coalesce(F.lag(order[0]).over(_inside(order)), "_carry_last"))
    return res.drop(_KEY, _BUCKET, "_carry", "_carry_last")


def crossing_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, limit: str, passes,
                  width: timedelta = WIDTH, piece_rows: int | None = None) -> DataFrame:
    """The rows of those time buckets in which a key's running sum may pass its limit for the first time,
    with ``_carry``, the key's sum before the bucket; exact for amounts of either sign.

    ``passes(sum, limit)`` must hold for every larger sum and every smaller limit too, and never for a null
    limit.  No row of a bucket passes unless the carry plus the bucket's positive amounts passes its smallest
    limit.  If the sum at a bucket's end passes its largest limit, its last row does, so later buckets aren't
    needed.  With amounts of 0 and more that leaves about one bucket per key.
    """
    amount = F.coalesce(F.col(value), F.lit(0)).cast("long")
    rows = _rows(df, keys, order, width, piece_rows)
    before = _across().rowsBetween(Window.unboundedPreceding, -1)
    most = F.sum(F.greatest(amount, F.lit(0)).cast("decimal(38,0)"))
    per = (rows.groupBy(_KEY, _BUCKET)
           .agg(F.sum(amount).alias("_part"), most.alias("_most"), F.min(limit).alias("_low"),
                F.max(limit).alias("_high"), F.max(F.col(limit).isNull()).alias("_open"))
           .withColumn("_end", F.sum("_part").over(_up_to(_across())))
           .withColumn("_sure", ~F.col("_open") & passes(F.col("_end"), F.col("_high")))
           .withColumns({"_carry": F.lag("_end", 1, 0).over(_across()),
                         "_done": F.coalesce(F.max("_sure").over(before), F.lit(False))})
           .where(~F.col("_done") & passes(F.col("_carry") + F.col("_most"), F.col("_low"))))
    return rows.join(per.select(_KEY, _BUCKET, "_carry"), [_KEY, _BUCKET])


def running_sum_of(rows: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """``running_sum`` of the rows of :func:`crossing_rows`."""
    amount = F.coalesce(F.col(value), F.lit(0)).cast("long")
    res = rows.withColumn(out, F.col("_carry") + F.sum(amount).over(_up_to(_inside(order))))
    return res.drop(_KEY, _BUCKET, "_carry")


def next_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, plan: str = "buckets",
                  width: timedelta = WIDTH, piece_rows: int | None = None) -> DataFrame:
    """Add ``out`` = the first ``order`` column of the key's next row (``lead``), null on the last."""
    order = list(order)
    if _whole(plan):
        return df.withColumn(out, F.lead(order[0]).over(Window.partitionBy(*keys).orderBy(*order)))
    rows = _rows(df, keys, order, width, piece_rows)
    res = _with_carry(rows, [F.min(order[0]).alias("_first")], {"_carry": F.lead("_first").over(_across())})
    following = F.lead(F.struct(F.col(order[0]).alias("first"))).over(_inside(order))     # null only at the end
    return (res.withColumn(out, F.when(following.isNull(), F.col("_carry")).otherwise(following["first"]))
               .drop(_KEY, _BUCKET, "_carry"))


def last_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
              plan: str = "buckets", width: timedelta = WIDTH, piece_rows: int | None = None) -> DataFrame:
    """Add ``out`` = the last non-null ``value`` at or before this row within the key.

    This is the carry-forward step of a merge as-of join: ``value`` is set on the dimension rows and
    null on the fact rows, which then pick up the latest dimension row before them.
    """
    order = list(order)
    if _whole(plan):
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(_up_to(w)))
    rows = _rows(df, keys, order, width, piece_rows)
    at = F.when(F.col(value).isNotNull(), F.struct(*order))  # rows without a value don't count
    before = _across().rowsBetween(Window.unboundedPreceding, -1)
    res = _with_carry(rows, [F.max_by(value, at).alias("_part")],
                      {"_carry": F.last("_part", ignorenulls=True).over(before)})
    here = F.last(value, ignorenulls=True).over(_up_to(_inside(order)))
    return res.withColumn(out, F.coalesce(here, "_carry")).drop(_KEY, _BUCKET, "_carry")
