"""Event-time as-of join: each usage row gets the account version in force at its time.

A version of account ``id`` holds from its ``ts`` (inclusive) to the next version's ``ts``
(exclusive).  A usage row with no version at or before its time finds none and is dropped (inner join
semantics).  Spark SQL has no per-row as-of join, so it is built from DataFrame operations with one of
three physical strategies:

``broadcast``
    version intervals (``lead`` over the versions of one account) are broadcast and probed with an
    equi-join on the account plus the time range as residual; the usage side is not shuffled.  Beyond
    ``max_broadcast_rows`` versions this becomes ``shuffle``.
``shuffle``
    the same interval join as a sort-merge join, in which Spark can split a hot account's usage.
``merge``
    usage and versions are unioned, put in event order and every usage row carries forward the last
    version before it (see :mod:`meterline.operators.scan`).  Linear, balanced under any skew, and
    needs no bound on the number of versions per account.

One aggregate over the versions gives their number, the most of one account, and duplicates.  Where an
account has more than ``FAN`` versions, the interval strategies go down through levels of coarser intervals
(:func:`interval_levels`), so a usage row meets at most ``FAN`` intervals in each; ``auto`` then takes ``merge``.
"""

from __future__ import annotations

from datetime import timedelta

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_partitions
from .scan import WIDTH, last_seen, next_in_order, running_sum

# Defaults of the strategy choice.
MAX_BROADCAST_ROWS = 1_000_000       # about 60 MB of intervals per executor
MAX_BROADCAST_BYTES = 128 << 20      # of ids and values, which may be wide
MAX_VERSIONS_PER_KEY = 64            # above it, "auto" takes the merge
FAN = 64                             # comparisons per usage row in one level of an interval join


@dataclass(frozen=True)
class VersionStats:
    rows: int
    keys: int
    max_per_key: int
    max_same_time: int
    bytes: int = 0

    @property
    def unique(self) -> bool:
        return self.max_same_time <= 1

    def small(self, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
        """Whether the versions may be broadcast: bounded in rows and in bytes."""
        return self.rows <= max_rows and self.bytes <= max_bytes


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row's values take."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    return size


def version_stats(versions: DataFrame, id_col: str = "id", ts_col: str = "ts") -> VersionStats:
    """Row count, key count, most versions of one key, most versions of one key at one time, and bytes.

    Three grouped aggregates with map-side combining; only one row reaches the driver.
    """
    per_time = versions.groupBy(id_col, ts_col).agg(F.count(F.lit(1)).alias("c"), F.sum(row_bytes(versions)).alias("b"))
    per_key = per_time.groupBy(id_col).agg(F.sum("c").alias("n"), F.max("c").alias("d"), F.sum("b").alias("b"))
    r = per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"),
                    F.max("n").alias("mx"), F.max("d").alias("dup"), F.sum("b").alias("bytes")).first()
    return VersionStats(*[int(r[c] or 0) for c in ("rows", "keys", "mx", "dup", "bytes")])


def latest_per_time(versions: DataFrame, tie: str, id_col: str = "id", ts_col: str = "ts") -> DataFrame:
    """Keep one version per ``(id, ts)``: the one with the largest ``tie`` (an aggregate, so a key with
    many copies is combined map-side)."""
    rest = [c for c in versions.columns if c not in (id_col, ts_col)]
    return (versions.groupBy(id_col, ts_col)
                    .agg(F.max_by(F.struct(*rest), F.col(tie)).alias("_v"))
                    .select(id_col, ts_col, *[F.col(f"_v.{c}").alias(c) for c in rest]))


def version_intervals(versions: DataFrame, id_col: str = "id", ts_col: str = "ts", plan: str = "buckets",
                      width: timedelta = WIDTH) -> DataFrame:
    """``versions`` plus ``valid_from`` (= ``ts``) and ``valid_to`` (next version's time or null).

    ``plan="window"`` is a plain ``lead``, for accounts of few versions; otherwise see
    :mod:`meterline.operators.scan`.
    """
    out = next_in_order(versions, [id_col], [ts_col], "valid_to", plan=plan, width=width)
    return out.withColumn("valid_from", F.col(ts_col))


def interval_levels(versions: DataFrame, values: list[str], max_per_key: int, id_col: str = "id",
                    ts_col: str = "ts", plan: str = "buckets", width: timedelta = WIDTH) -> list[DataFrame]:
    """The version intervals below as many levels of coarser ones as keep any row's comparisons in each
    level within ``FAN``: an interval of one level covers up to ``FAN`` successive ones of the next.

    Each level has ``_iv_id, _iv_up`` (number of the interval above), ``_iv_at`` (own number), ``_iv_from``
    and ``_iv_to``; the last one, the versions themselves, also ``values`` as ``_iv_*``.
    """
    depth = 1
    while FAN ** depth < max_per_key:
        depth += 1
    iv = version_intervals(versions, id_col, ts_col, plan, width).withColumn("_one", F.lit(1))
    if depth > 1:
        iv = running_sum(iv, [id_col], [ts_col], "_one", "_rank", plan=plan, width=width)
    else:
        iv = iv.withColumn("_rank", F.lit(1).cast("long"))
    levels = []
    for level in range(depth - 1, -1, -1):
        key = [F.col(id_col).alias("_iv_id"), F.expr(f"(_rank - 1) div {FAN ** (level + 1)}").alias("_iv_up"),
               F.expr(f"(_rank - 1) div {FAN ** level}").alias("_iv_at")]
        if level:
            levels.append(iv.groupBy(*key).agg(F.min("valid_from").alias("_iv_from"),
                                               F.max_by("valid_to", "_rank").alias("_iv_to")))
        else:
            levels.append(iv.select(*key, F.col("valid_from").alias("_iv_from"), F.col("valid_to").alias("_iv_to"),
                                    *[F.col(v).alias(f"_iv_{v}") for v in values]))
    return levels


def interval_join(left: DataFrame, levels: list[DataFrame], left_key: str, left_ts: str, values: list[str],
                  broadcast: bool) -> DataFrame:
    """Level by level, an equi-join on the key (and the interval above) with ``from <= ts < to`` as residual.

    ``broadcast`` only for intervals whose number the caller has checked.  Otherwise these are sort-merge joins,
    and as the intervals are dealt out anew, both sides have an exchange of their own: only so does Spark split
    the left rows of a hot key.
    """
    out, names = left, left.columns
    for i, level in enumerate(levels):
        iv = (F.broadcast(level) if broadcast
              else level.repartition(shuffle_partitions(left.sparkSession)).hint("merge"))
        cond = ((out[left_key] == iv["_iv_id"]) & (out[left_ts] >= iv["_iv_from"])
                & (iv["_iv_to"].isNull() | (out[left_ts] < iv["_iv_to"])))
        if i:
            cond &= out["_at"] == iv["_iv_up"]
        found = ([iv["_iv_at"].alias("_at")] if i < len(levels) - 1
                 else [iv[f"_iv_{v}"].alias(v) for v in values])
        out = out.join(iv, cond, "inner").select(*[out[c] for c in names], *found)
    return out


def _merge_join(left: DataFrame, right: DataFrame, left_key: str, left_ts: str, id_col: str,
                ts_col: str, values: list[str], plan: str, width: timedelta) -> DataFrame:
    row_t = left.select(F.struct(*left.columns).alias("r")).schema["r"].dataType
    ver_t = right.select(F.struct(*values).alias("v")).schema["v"].dataType
    facts = left.select(F.col(left_key).alias("_k"), F.col(left_ts).alias("_t"), F.lit(1).alias("_side"),
                        F.struct(*left.columns).alias("_row"), F.lit(None).cast(ver_t).alias("_ver"))
    dims = right.select(F.col(id_col).alias("_k"), F.col(ts_col).alias("_t"), F.lit(0).alias("_side"),
                        F.lit(None).cast(row_t).alias("_row"), F.struct(*values).alias("_ver"))
    # Versions sort before usage at the same time: a version applies from its own time on.
    both = facts.unionByName(dims)
    found = last_seen(both, ["_k"], ["_t", "_side"], "_ver", "_found", plan=plan, width=width)
    return (found.where((F.col("_side") == 1) & F.col("_found").isNotNull())
                 .select(*[F.col(f"_row.{c}").alias(c) for c in left.columns],
                         *[F.col(f"_found.{v}").alias(v) for v in values]))


def choose_strategy(stats: VersionStats, max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                    max_versions_per_key: int = MAX_VERSIONS_PER_KEY) -> str:
    if stats.max_per_key > max_versions_per_key:
        return "merge"
    if stats.small(max_broadcast_rows):
        return "broadcast"
    return "shuffle"


def as_of_join(left: DataFrame, right: DataFrame, left_key: str = "account", right_key: str = "id",
               left_ts: str = "ts", right_ts: str = "ts", values: list[str] | None = None,
               strategy: str = "auto", tie: str | None = None,
               max_broadcast_rows: int = MAX_BROADCAST_ROWS,
               max_versions_per_key: int = MAX_VERSIONS_PER_KEY,
               plan: str = "buckets", width: timedelta = WIDTH) -> DataFrame:
    """Inner as-of join: ``left`` columns plus ``values`` of the latest ``right`` row with the same key
    and ``right_ts <= left_ts``.

    ``right`` must have one row per ``(key, time)``; with ``tie`` the row with the largest tie value is
    kept, without it duplicates raise under every strategy.
    ``plan`` is the ordered-scan plan of the merge strategy (see :mod:`meterline.operators.scan`).
    """
    values = values or [c for c in right.columns if c not in (right_key, right_ts)]
    if tie is not None:
        right = latest_per_time(right, tie, right_key, right_ts)
    right = right.select(right_key, right_ts, *values)
    if tie is None or strategy != "merge":
        stats = version_stats(right, right_key, right_ts)
        if not stats.unique:
            raise ValueError(f"{stats.max_same_time} versions of one key share a time; pass tie=")
    if strategy == "auto":
        strategy = choose_strategy(stats, max_broadcast_rows, max_versions_per_key)
    if strategy in ("broadcast", "shuffle"):
        scan = "window" if stats.max_per_key <= FAN else plan
        levels = interval_levels(right, values, stats.max_per_key, right_key, right_ts, scan, width)
        small = strategy == "broadcast" and stats.small(max_broadcast_rows)
        return interval_join(left, levels, left_key, left_ts, values, small)
    if strategy == "merge":
        return _merge_join(left, right, left_key, left_ts, right_key, right_ts, values, plan, width)
    raise ValueError(f"unknown strategy {strategy!r}")
