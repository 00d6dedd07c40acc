"""Quota enrichment of a usage stream.

``enrich_static``
    the version table is static (a snapshot, like the demo's account generator, which emits its rows
    once and then a final watermark): a stream–static join with the validity intervals.  Stateless, no
    watermark, nothing is ever late.
``enrich_versioned``
    versions arrive as a stream too.  Both streams are unioned and keyed by account into
    :class:`VersionedJoinProcessor`: versions are stored in time buckets; a usage row waits in a calendar queue and
    is joined once the watermark has reached its time.
``enrich_changes``
    the same join without waiting: usage is joined at once, and a version that arrives after usage it covers retracts
    and corrects that usage (``+I``, ``-U``, ``+U`` rows).

**Completeness.**  With ``wait_for="both"`` each side has its own watermark and the lower one holds: usage waits until
both streams have reached its time, and versions that lag behind are not missed.  A row without an account
or id is a heartbeat: it only moves its side's time.  A side that is idle, or finished, must send heartbeats (a finished
one once, :data:`FINISHED`; after a restart of the query again, as Spark forgets the time of each side), or
the other side's rows wait for it.  With ``wait_for="usage"``, the default, only usage moves time and nothing stalls, but a
version that arrives after usage it covers was released does not correct it.

**Late usage**, behind the watermark, is joined and emitted at once by default (``late="emit"``): the watermark
column is kept away from the processor's input, so Spark filters nothing.  Versions then stay in state for it;
with a ``horizon`` only as long as usage up to that far behind the watermark needs them, and usage still later is
dropped.  With ``late="drop"`` Spark drops late usage before the processor (``numRowsDroppedByWatermark``), so
``delay`` is the lateness tolerated, and each release is in event order.  Versions are never late: each is stored and
applies from its own time on.

Nulls: a null amount counts as 0, a null tie as 0; rows without a time match nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import shared_dir, use_rocksdb_state

from ..functions.billing import billing_month, billing_year
from ..operators.asof import FAN, MAX_BROADCAST_ROWS, interval_join, interval_levels, version_stats
from .keyed_state import (BUCKET, NEVER, Accounts, Calendar, VersionStore, code_of, grouped, groups, in_order, last_before,
                          latest_versions, micros, opened, packed, versions_at)

#: Time of the heartbeat of a side that sends no more rows.
FINISHED = datetime(9999, 1, 1, tzinfo=timezone.utc)
VERSION, USAGE, HEARTBEAT = 0, 1, 2
MOST = 1 << 18      # usage rows that a correction holds at a time, or a time bucket's


def enrich_static(usage: DataFrame, versions: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Stream (or batch) usage joined with a static version table, plus the billing period.

    The version table is checked once (unique per ``(id, ts)``); it is broadcast when small, else
    joined by sort-merge.  A stream can only meet a table through a join; accounts of many versions are
    searched through levels of coarser intervals, with a bounded number of comparisons in each.
    """
    stats = version_stats(versions)
    if not stats.unique:
        raise ValueError("versions must be unique per (id, ts)")
    plan = "window" if stats.max_per_key <= FAN else "buckets"
    levels = interval_levels(versions.select("id", "ts", "quota"), ["quota"], stats.max_per_key, plan=plan)
    if usage.isStreaming:
        # The static side is planned again in every micro-batch: compute the intervals once and keep
        # them in the shared checkpoint folder, so a batch only reads them.
        shared_dir(usage.sparkSession)
        levels = [level.checkpoint(eager=True) for level in levels]
    joined = interval_join(usage, levels, "account", "ts", ["quota"], stats.small(max_broadcast_rows))
    return joined.withColumns({"billingYear": billing_year("ts"), "billingMonth": billing_month("ts")})


def split_rows(pdf: pd.DataFrame, tie: str, accounts: Accounts) -> tuple[np.ndarray, np.ndarray]:
    """Versions (time, quota, null) and usage (time, bytes, tie) of a chunk of input rows, with the account's number if
    accounts share the key; heartbeats are left out."""
    if accounts.column:
        pdf = pdf[pdf["side"] != HEARTBEAT]
        pdf = pdf.assign(code=accounts.codes(pdf))
    side, last = pdf["side"].to_numpy(), ["code"] if accounts.column else []
    found = []
    for which, columns in ((VERSION, ["ts_us", "quota", "quota_null"]), (USAGE, ["ts_us", "bytesUsed", tie])):
        at = side == which
        found.append(np.stack([pdf[c].to_numpy()[at].astype("<i8") for c in columns + last], axis=1))
    return found[0], found[1]


class VersionedJoinProcessor(StatefulProcessor):
    """Per account: versions in time buckets, and usage that waits in a calendar queue.  With ``column``, the accounts'
    column, a key is a group of accounts.

    ``horizon`` (microseconds): versions that usage this far behind the watermark can't use are removed by a timer,
    of idle accounts too; None keeps them all.
    """

    def __init__(self, tie: str, horizon: int | None, bucket: timedelta = BUCKET, column: str | None = None):
        self.tie, self.horizon, self.bucket, self.column = tie, horizon, bucket, column

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        columns = 4 if self.column else 3
        self.accounts = Accounts(handle, self.column)
        self.versions = VersionStore(handle, self.bucket, columns)
        self.calendar = Calendar(handle, self.bucket, columns)
        self.prune_at = handle.getValueState("prune_at", "ms long")

    def joined(self, rows: np.ndarray, late: bool) -> Iterator[pd.DataFrame]:
        """What goes out for usage in time order with its versions; a subclass may make something else of it."""
        found, version = self.versions.in_force(rows[:, 0], code_of(rows))
        if found.any():
            rows, version = rows[found], version[found]
            quota = pd.array(version[:, 1], dtype="Int64")
            quota[version[:, 2] != 0] = pd.NA
            yield pd.DataFrame({"account": self.accounts.of(code_of(rows)), "bytesUsed": rows[:, 1], "ts_us": rows[:, 0], self.tie: rows[:, 2],
                                "quota": quota, "event_ts": pd.to_datetime(rows[:, 0], unit="us", utc=True),
                                "late": late})

    def _schedule(self) -> None:
        """The timer at which the oldest version is of no more use."""
        us, have = self.versions.second(), self.prune_at.get()
        if us is None:
            return
        if self.column:     # of many accounts, those of a bucket's time together
            us = -(-us // self.versions.width) * self.versions.width
        ms = -(-(us + self.horizon) // 1000)
        if have is None or int(have[0]) != ms:
            self.handle.registerTimer(ms)
            self.prune_at.update((ms,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        late, any_version = [], False
        self.accounts.begin(key)
        for pdf in rows:
            versions, usage = split_rows(pdf, self.tie, self.accounts)
            if len(versions):
                self.versions.add(versions)
                any_version = True
            # The watermark has millisecond resolution; a row counts as reached once its millisecond is.
            later = usage[:, 0] // 1000 > watermark
            if later.any():
                self.calendar.add(usage[later])
            if not later.all():
                late.append(usage[~later])
        self.accounts.save()
        if any_version and self.horizon is not None:
            self._schedule()
        if late:
            late = in_order(np.concatenate(late))
            if self.horizon:
                late = late[late[:, 0] >= watermark * 1000 - self.horizon]
            yield from self.joined(late, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, expiry = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        self.accounts.begin(key)
        ready = self.calendar.release(expiry, watermark)
        if len(ready):
            yield from self.joined(ready, False)
        if self.horizon is not None:
            due = self.prune_at.get()
            if due is not None and int(due[0]) == expiry:
                self.prune_at.clear()
                waits = self.calendar.earliest()
                until = watermark if waits is None else min(watermark, waits)
                self.versions.prune(until * 1000 - self.horizon)
                self._schedule()

    def close(self) -> None:
        pass


def two_sides(usage: DataFrame, versions: DataFrame, tie: str, delay: str, version_delay: str, wait_for: str,
              clocked: bool = True) -> DataFrame:
    """Usage and versions as rows of one stream, each with a watermark of its own.

    ``wm_ts`` is the event time of usage rows.  Every long is null-free with a flag for a missing quota, as a column
    with nulls would reach the processor as float64.  Heartbeats stay: a filter would be pushed below the watermark.
    """
    if wait_for not in ("both", "usage"):
        raise ValueError(f"wait_for must be 'both' or 'usage', not {wait_for!r}")
    policy = usage.sparkSession.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min")
    if wait_for == "both" and policy != "min":
        raise ValueError("waiting for both sides needs spark.sql.streaming.multipleWatermarkPolicy = min")
    use_rocksdb_state(usage.sparkSession)
    zero = F.lit(0).cast("long")

    def side(number: int, key: str):
        return F.when(F.col(key).isNull() | F.col("ts").isNull(), F.lit(HEARTBEAT)).otherwise(F.lit(number)).alias("side")

    def time():
        return F.coalesce(F.unix_micros("ts"), zero).alias("ts_us")

    u = usage.select(F.col("account").alias("key_id"), F.col("ts").alias("wm_ts"), time(), side(USAGE, "account"),
                     F.coalesce(F.col("bytesUsed").cast("long"), zero).alias("bytesUsed"),
                     F.coalesce(F.col(tie).cast("long"), zero).alias(tie), zero.alias("quota"),
                     F.lit(False).alias("quota_null"))
    v = versions.select(F.col("id").alias("key_id"), F.col("ts").alias("v_ts"), time(), side(VERSION, "id"),
                        zero.alias("bytesUsed"), zero.alias(tie), F.coalesce(F.col("quota").cast("long"), zero).alias("quota"),
                        F.col("quota").isNull().alias("quota_null"))
    if clocked:
        u = u.withWatermark("wm_ts", delay)
        v = v.withWatermark("v_ts", version_delay) if wait_for == "both" else v
    # Versions carry no event time beyond this point, so Spark never takes one for late.
    v = v.drop("v_ts").withColumn("wm_ts", F.lit(None).cast("timestamp"))
    return u.unionByName(v)


def _horizon(horizon: timedelta | None, late: str) -> int | None:
    if late not in ("emit", "drop"):
        raise ValueError(f"late must be 'emit' or 'drop', not {late!r}")
    return 0 if late == "drop" else None if horizon is None else micros(horizon)


def enrich_versioned(usage: DataFrame, versions: DataFrame, tie: str, delay: str = "0 seconds",
                     late: str = "emit", wait_for: str = "usage", version_delay: str | None = None,
                     horizon: timedelta | None = None, mark_late: bool = False, account_groups: int | None = None,
                     bucket: timedelta = BUCKET) -> DataFrame:
    """Usage stream joined with a version stream (both carry event times), plus the billing period.

    Output rows come out when the watermark reaches their time; ``delay`` and ``version_delay`` (the same by default)
    say how far out of order each side may be.  Output columns: ``account, bytesUsed, ts, tie, quota, billingYear,
    billingMonth``; with ``mark_late`` also ``late``; with ``late="drop"`` also ``event_ts`` (= ``ts``), the event-time
    column through which a later event-time operator of the same query gets the watermark.

    ``account_groups``: into how many groups accounts are dealt, each with one call a micro-batch and bucket; by default
    every account has its own.  ``bucket``: width of the time buckets; much below a micro-batch's span it costs calls.
    """
    keep = _horizon(horizon, late)
    both = two_sides(usage, versions, tie, delay, version_delay or delay, wait_for)
    both = both.select("key_id", *(["wm_ts"] if late == "drop" else []), "ts_us", "side", "bytesUsed", tie, "quota", "quota_null")
    schema = T.StructType([
        T.StructField("account", T.StringType()), T.StructField("bytesUsed", T.LongType()),
        T.StructField("ts_us", T.LongType()), T.StructField(tie, T.LongType()),
        T.StructField("quota", T.LongType()), T.StructField("event_ts", T.TimestampType()),
        T.StructField("late", T.BooleanType())])
    # ``event_ts`` carries the watermark on to later event-time operators in the same query.
    carry = {"eventTimeColumnName": "event_ts"} if late == "drop" else {}
    out = grouped(both, "key_id", account_groups).transformWithStateInPandas(
        VersionedJoinProcessor(tie, keep, bucket, "key_id" if account_groups else None), schema, "Append", "EventTime", **carry)
    out = out.select("account", "bytesUsed", F.timestamp_micros("ts_us").alias("ts"), tie, "quota",
                     *(["late"] if mark_late else []), *(["event_ts"] if late == "drop" else []))
    return out.withColumns({"billingYear": billing_year("ts"), "billingMonth": billing_month("ts")})


class RetractingJoinProcessor(StatefulProcessor):
    """Per account, or with ``column`` group of accounts: versions, and the usage seen so far, both in time buckets.

    New usage is joined at once.  A new version covers the time up to the next one: usage seen in that time gets a
    ``-U`` row with its former quota, if it had a version, and a ``+U`` row (``+I`` if it had none) with the new one.
    Only the buckets of that time are read.  With a ``horizon`` (microseconds) a bucket's usage is forgotten once the
    watermark is that far past its end: versions still later don't correct it.
    """

    def __init__(self, tie: str, horizon: int | None, bucket: timedelta = BUCKET, column: str | None = None):
        self.tie, self.horizon, self.bucket, self.column = tie, horizon, bucket, column

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.width = micros(self.bucket) // 1000 * 1000
        self.columns = 4 if self.column else 3
        self.accounts = Accounts(handle, self.column)
        self.versions = VersionStore(handle, self.bucket, self.columns)
        self.list = handle.getValueState("usage_buckets", "buckets binary")
        self.parts = handle.getMapState("usage_parts", "bucket long", "n long")
        self.rows = handle.getMapState("usage", "bucket long, part long", "rows binary")

    def _buckets(self) -> np.ndarray:
        value = self.list.get()
        return opened(value[0], 1)[:, 0] if value is not None else np.zeros(0, "<i8")

    def _seen(self, buckets) -> np.ndarray:
        found = [np.zeros((0, self.columns), "<i8")]
        for bucket in buckets:
            for part in range(int(self.parts.getValue((bucket,))[0])):
                found.append(opened(self.rows.getValue((bucket, part))[0], self.columns))
        return in_order(np.concatenate(found))

    def _remember(self, rows: np.ndarray) -> None:
        known = self._buckets()
        have, fresh = set(known.tolist()), []
        for bucket, at in groups(rows[:, 0] // self.width):
            n = int(self.parts.getValue((bucket,))[0]) if bucket in have else 0
            self.rows.updateValue((bucket, n), (packed(rows[at]),))
            self.parts.updateValue((bucket,), (n + 1,))
            if not n:
                fresh.append(bucket)
                if self.horizon is not None:
                    self.handle.registerTimer(((bucket + 1) * self.width + self.horizon) // 1000)
        if fresh:
            self.list.update((packed(np.union1d(known, np.array(fresh, "<i8"))),))

    def _frame(self, op, rows, version, step: int) -> pd.DataFrame:
        quota = pd.array(version[:, 1], dtype="Int64")
        quota[version[:, 2] != 0] = pd.NA
        return pd.DataFrame({"op": op, "account": self.accounts.of(code_of(rows)), "bytesUsed": rows[:, 1], "ts_us": rows[:, 0],
                             self.tie: rows[:, 2], "quota": quota, "step": step})

    def _corrected(self, new: np.ndarray) -> Iterator[pd.DataFrame]:
        """Stores new versions; the change rows of the usage they cover."""
        low, known = int(new[:, 0].min()), self._buckets()
        known = known[known >= low // self.width]
        new = latest_versions(new)
        codes = np.unique(code_of(new))
        # The times that a new version covers end at its account's next one.
        old = (self.versions.around(low, int(known[-1] + 1) * self.width, codes) if len(known)
               else np.zeros((0, self.columns), "<i8"))
        self.versions.add(new)
        every = latest_versions(np.concatenate([old, new]))
        own = code_of(every)
        after = np.append(np.where(own[1:] == own[:-1], every[1:, 0], NEVER), NEVER)
        starts, ends = new[:, 0], after[last_before(every, new[:, 0], code_of(new))]
        hit = [b for b in known.tolist() if ((starts < (b + 1) * self.width) & (ends > b * self.width)).any()]
        held, seen = 0, []
        for bucket in hit:
            rows = self._seen([bucket])
            rows = rows[np.isin(code_of(rows), codes)]
            held += len(rows)
            seen.append(rows)
            if held >= MOST or bucket == hit[-1]:   # a bounded part of what is to be corrected at a time
                yield from self._changed(np.concatenate(seen), old, every)
                held, seen = 0, []

    def _changed(self, rows: np.ndarray, old: np.ndarray, every: np.ndarray) -> Iterator[pd.DataFrame]:
        had, before = versions_at(old, rows[:, 0], code_of(rows))
        has, now = versions_at(every, rows[:, 0], code_of(rows))
        changed = has & (~had | (before[:, 1:] != now[:, 1:]).any(axis=1))
        if changed.any():
            back = changed & had
            if back.any():
                yield self._frame("-U", rows[back], before[back], 0)
            yield self._frame(np.where(had[changed], "+U", "+I"), rows[changed], now[changed], 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new, used = [], []
        self.accounts.begin(key)
        for pdf in rows:
            versions, usage = split_rows(pdf, self.tie, self.accounts)
            new.append(versions)
            used.append(usage)
        new, used = np.concatenate(new), in_order(np.concatenate(used))
        self.accounts.save()
        if len(new):
            yield from self._corrected(new)
        if len(used):
            found, version = self.versions.in_force(used[:, 0], code_of(used))
            if found.any():
                yield self._frame("+I", used[found], version[found], 1)
            self._remember(used)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = (expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.horizon) // self.width
        known = self._buckets()
        for bucket in known[known < over].tolist():
            for part in range(int(self.parts.getValue((bucket,))[0])):
                self.rows.removeKey((bucket, part))
            self.parts.removeKey((bucket,))
        if (known < over).any():
            self.list.update((packed(known[known >= over]),))
        if len(known):
            self.versions.prune(int(over) * self.width)
        return iter(())

    def close(self) -> None:
        pass


def enrich_changes(usage: DataFrame, versions: DataFrame, tie: str, horizon: timedelta | None = None,
                   delay: str = "0 seconds", account_groups: int | None = None) -> DataFrame:
    """Change rows of the version-stream join, without waiting: ``op, account, bytesUsed, ts, tie, quota, billingYear,
    billingMonth, step`` (within a batch, ``-U`` rows have step 0 and the others 1).

    Whatever the order in which versions and usage arrive, the rows that :func:`folded` leaves are those of the batch
    join.  ``horizon`` bounds the state: usage older than that, behind the watermark (``delay`` behind the
    latest usage), is corrected no more.
    """
    both = two_sides(usage, versions, tie, delay, delay, "usage", clocked=horizon is not None)
    both = both.select("key_id", "ts_us", "side", "bytesUsed", tie, "quota", "quota_null")
    schema = T.StructType([
        T.StructField("op", T.StringType()), T.StructField("account", T.StringType()),
        T.StructField("bytesUsed", T.LongType()), T.StructField("ts_us", T.LongType()), T.StructField(tie, T.LongType()),
        T.StructField("quota", T.LongType()), T.StructField("step", T.IntegerType())])
    out = grouped(both, "key_id", account_groups).transformWithStateInPandas(
        RetractingJoinProcessor(tie, None if horizon is None else micros(horizon), BUCKET,
                                "key_id" if account_groups else None), schema, "Append",
        "None" if horizon is None else "EventTime")
    out = out.select("op", "account", "bytesUsed", F.timestamp_micros("ts_us").alias("ts"), tie, "quota", "step")
    return out.withColumns({"billingYear": billing_year("ts"), "billingMonth": billing_month("ts")})


def folded(changes: DataFrame) -> DataFrame:
    """The rows that change rows leave: each as often as it was added and not taken back."""
    rest = [c for c in changes.columns if c not in ("op", "step")]
    left = F.sum(F.when(F.col("op") == "-U", F.lit(-1)).otherwise(F.lit(1)))
    return (changes.groupBy(*rest).agg(left.alias("left")).where("left > 0")
            .select(*rest, F.explode(F.sequence(F.lit(1).cast("long"), F.col("left").cast("long")))).select(*rest))
