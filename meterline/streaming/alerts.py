"""Streaming usage alerts: a keyed stateful processor, one of the few places where rows meet Python.

Per billing key ``(account, billingYear, billingMonth, quota)`` the processor keeps the running total
and whether the key has already warned (a ``MapState`` per account).  Within a micro-batch the rows
are put in ``(ts, tie)`` order before they are added, so files replayed in event order give the batch
result.  Rows go through numpy (Arrow batches), so the work is vectorized.

State grows with accounts × months × quotas unless ``clear_after`` is set: then an event-time timer at
the end of the billing month plus that grace clears the key.  Rows of a month that is still open are added
however late they are (the watermark column is kept away from the processor's input, so Spark filters
nothing); rows of a month past its end plus grace are dropped, so a cleared total is never restarted.
Times inside the processor are epoch microseconds — the process's zone can never shift them.

After a version stream, :func:`stream_versioned_alerts` does the join and the totals in one processor keyed by
account: both see the same watermark, so months are cleared and late usage of open months still counts.
Null amounts count as 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import scratch_path, use_rocksdb_state

from ..functions.billing import alert_message
from ..operators.scan import check_sums
from ..schemas import ALERT_RATIO, BILLING_KEY
from .enrich import VersionedJoinProcessor, _horizon, two_sides
from .keyed_state import BUCKET, Accounts, code_of, grouped, opened, packed

_COLUMNS = ("ts_us", "billingYear", "billingMonth", "quota", "quota_null", "bytesUsed")


def checked_cumsum(prior: int, values: np.ndarray) -> np.ndarray:
    """Running sum continuing from ``prior``; raises rather than wrapping past the long range."""
    values = values.astype("int64")
    return check_sums(np.int64(prior) + np.cumsum(values), values)


def month_end_ms(year: int, month: int) -> int:
    nxt = datetime(year + (month == 12), month % 12 + 1, 1, tzinfo=timezone.utc)
    return int(nxt.timestamp() * 1000)


class BillingTotals:
    """Totals and flags by billing key, in a ``MapState``: year, month and, by default, quota.
    Only the keys of the rows at hand are read.  Key parts left out of ``key`` (e.g. the quota) are read
    from each row.  Where accounts share a key (``shared``), a value is a month's table of all their billing keys."""

    SUB_KEY_TYPES = {"billingYear": "long", "billingMonth": "long", "quota": "long"}

    def __init__(self, tie: str, ratio: float, clear_after: timedelta | None, key: Sequence[str],
                 shared: bool = False):
        self.tie, self.ratio, self.shared = tie, float(ratio), shared
        self.sub = [k for k in key if k != "account"]
        if "account" not in key or any(k not in self.SUB_KEY_TYPES for k in self.sub):
            raise ValueError(f"key must be account plus some of {sorted(self.SUB_KEY_TYPES)}")
        if clear_after is not None and not {"billingYear", "billingMonth"} <= set(self.sub):
            raise ValueError("clearing by month needs billingYear and billingMonth in the key")
        self.grace = None if clear_after is None else int(clear_after.total_seconds() * 1000)

    def open(self, handle: StatefulProcessorHandle, accounts: Accounts) -> None:
        self.handle, self.accounts = handle, accounts
        if self.shared:
            self.state = handle.getMapState("usage", "billingYear long, billingMonth long", "rows binary")
        else:
            sub_schema = ", ".join(f"{k} {self.SUB_KEY_TYPES[k]}" for k in self.sub)
            self.state = handle.getMapState("usage", sub_schema, "total long, alerted boolean")

    def _keys(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        """Account, key parts and, with the quota, whether it is null; the quota is 0 then, so that it stays an int64."""
        return np.stack([rows["code"], *[rows[c].astype("int64") for c in self.sub],
                         *([rows["quota_null"].astype("int64")] if "quota" in self.sub else [])], axis=1)

    def _months(self, keys: np.ndarray) -> np.ndarray:
        """(year, month) of billing keys, 0 if not part of them."""
        return np.stack([keys[:, 1 + self.sub.index(c)] if c in self.sub else np.zeros(len(keys), "<i8")
                         for c in ("billingYear", "billingMonth")], axis=1)

    def _load(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Total, flag and whether the month has any, of distinct billing keys; :meth:`_save` goes on from here."""
        prior, alerted, known = np.zeros(len(keys), "int64"), np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        self.opened = []
        if not self.shared:
            for g, row in enumerate(keys.tolist()):
                sk = tuple(None if c == "quota" and row[-1] else v for c, v in zip(self.sub, row[1:]))
                have = self.state.getValue(sk)
                self.opened.append(sk)
                if have is not None:
                    prior[g], alerted[g], known[g] = int(have[0]), bool(have[1]), True
            return prior, alerted, known
        width = keys.shape[1]
        months, of = np.unique(self._months(keys), axis=0, return_inverse=True)
        for m, month in enumerate(map(tuple, months.tolist())):
            at = np.flatnonzero(of.reshape(-1) == m)
            value = self.state.getValue(month)
            table = opened(value[0], width + 2) if value is not None else np.zeros((0, width + 2), "<i8")
            every, where = np.unique(np.concatenate([table[:, :width], keys[at]]), axis=0, return_inverse=True)
            where = where.reshape(-1)
            merged = np.concatenate([every, np.zeros((len(every), 2), "<i8")], axis=1)
            merged[where[:len(table)], width:] = table[:, width:]
            own = where[len(table):]
            prior[at], alerted[at], known[at] = merged[own, width], merged[own, width + 1] != 0, value is not None
            self.opened.append((month, merged, own, at))
        return prior, alerted, known

    def _save(self, total: np.ndarray, alerted: np.ndarray) -> None:
        if not self.shared:
            for g, sk in enumerate(self.opened):
                self.state.updateValue(sk, (int(total[g]), bool(alerted[g])))
            return
        for month, merged, own, at in self.opened:
            merged[own, -2], merged[own, -1] = total[at], alerted[at]
            self.state.updateValue(month, (packed(merged),))

    def _set_timers(self, keys: np.ndarray) -> None:
        """A timer at the end of each month, grace included."""
        for year, month in np.unique(self._months(keys), axis=0).tolist():
            self.handle.registerTimer(month_end_ms(year, month) + self.grace)

    def add(self, rows: dict[str, np.ndarray], watermark: int | None) -> pd.DataFrame | None:
        """Adds rows (any order; ``code``: the account's number) to their totals; the first row of each key that passes, once per key."""
        order = np.lexsort((rows[self.tie], rows["ts_us"]))
        rows = {c: v[order] for c, v in rows.items()}
        if self.grace is not None:  # months that are over, grace included, take no more rows
            months = rows["billingYear"] * 12 + rows["billingMonth"] - 1
            over = [m for m in np.unique(months).tolist() if month_end_ms(m // 12, m % 12 + 1) + self.grace <= watermark]
            keep = ~np.isin(months, over)
            rows = {c: v[keep] for c, v in rows.items()}
        n = len(rows["ts_us"])
        if not n:
            return None
        keys, group = np.unique(self._keys(rows), axis=0, return_inverse=True)
        group = group.reshape(-1)
        prior, alerted, known = self._load(keys)
        if self.grace is not None and not known.all():
            self._set_timers(keys[~known])
        used = rows["bytesUsed"].astype("int64")
        run = check_sums(pd.Series(used).groupby(group).cumsum().to_numpy() + prior[group], used)
        # Java compares long > double: the total is widened to double, like here; a null quota
        # never passes (NaN compares false).
        quota = np.where(rows["quota_null"].astype(bool), np.nan, rows["quota"].astype("float64"))
        hit = np.flatnonzero(~alerted[group] & (run.astype("float64") > self.ratio * quota))
        passed, at = np.unique(group[hit], return_index=True)
        alerted[passed] = True
        last = np.zeros(len(keys), "int64")
        last[group] = np.arange(n)      # the last row of a group is the last one written
        self._save(run[last], alerted)
        if not len(hit):
            return None
        at = np.sort(hit[at])
        return pd.DataFrame({"ts_us": rows["ts_us"][at], "account": self.accounts.of(rows["code"][at]), "billingYear": rows["billingYear"][at],
                             "billingMonth": rows["billingMonth"][at], "quota": rows["quota"][at], "total": run[at],
                             self.tie: rows[self.tie][at]}).astype(
            {c: "int64" for c in ("ts_us", "billingYear", "billingMonth", "quota", "total", self.tie)})

    def start(self, known: pd.DataFrame) -> None:
        """Totals and flags to begin with (rows of :func:`~meterline.operators.alerts.billing_state`)."""
        keys = self._keys({"code": self.accounts.codes(known), **{c: known[c].to_numpy() for c in known.columns}})
        self._load(keys)
        self._save(known["total"].to_numpy().astype("int64"), known["alerted"].to_numpy().astype(bool))
        if self.grace is not None:
            self._set_timers(keys)

    def clear(self, expiry_ms: int) -> None:
        """Drops the billing keys of every month whose end plus grace has passed."""
        iy, im = (0, 1) if self.shared else (self.sub.index("billingYear"), self.sub.index("billingMonth"))
        for sk in list(self.state.keys()):
            if month_end_ms(sk[iy], sk[im]) + self.grace <= expiry_ms:
                self.state.removeKey(sk)


class UsageAlertProcessor(StatefulProcessor):
    """Per account: add each row to its billing key's total; the first time a key's total passes
    ``ratio * quota``, emit once.

    The processor is keyed by account, or with ``column``, the accounts' column, by group of accounts (one call per key
    and micro-batch; the per-call cost of the operator dominates when keys are many and small).  Within a call the running totals of all its billing
    keys are computed together, vectorized; rows are held as integers, some 60 bytes each.
    """

    def __init__(self, tie: str, ratio: float = ALERT_RATIO, clear_after: timedelta | None = None,
                 key: Sequence[str] = BILLING_KEY, column: str | None = None):
        self.column, self.totals = column, BillingTotals(tie, ratio, clear_after, key, column is not None)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accounts = Accounts(handle, self.column)
        self.totals.open(handle, self.accounts)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.accounts.begin(key)
        self.totals.start(initialState)
        self.accounts.save()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.accounts.begin(key)
        chunks = [{"code": self.accounts.codes(pdf), **{c: pdf[c].to_numpy().astype("int64") for c in (*_COLUMNS, self.totals.tie)}}
                  for pdf in rows]
        whole = {c: np.concatenate([chunk[c] for chunk in chunks]) for c in chunks[0]}
        watermark = timerValues.getCurrentWatermarkInMs() if self.totals.grace is not None else None
        out = self.totals.add(whole, watermark)
        self.accounts.save()
        if out is not None:
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.totals.clear(expiredTimerInfo.getExpiryTimeInMs())
        if self.column and next(iter(self.totals.state.keys()), None) is None:
            self.accounts.forget()
        return iter([])

    def close(self) -> None:
        pass


class VersionedAlertProcessor(VersionedJoinProcessor):
    """The version-stream join whose joined usage goes straight into the account's totals."""

    def __init__(self, tie: str, horizon: int | None, ratio: float = ALERT_RATIO, clear_after: timedelta | None = None,
                 key: Sequence[str] = BILLING_KEY, column: str | None = None, bucket: timedelta = BUCKET):
        super().__init__(tie, horizon, bucket, column)
        self.totals = BillingTotals(tie, ratio, clear_after, key, column is not None)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.totals.open(handle, self.accounts)

    def joined(self, rows: np.ndarray, late: bool) -> Iterator[pd.DataFrame]:
        found, version = self.versions.in_force(rows[:, 0], code_of(rows))
        if found.any():
            rows, version = rows[found], version[found]
            month = rows[:, 0].astype("datetime64[us]").astype("datetime64[M]").astype("int64")
            out = self.totals.add({
                "code": code_of(rows), "ts_us": rows[:, 0], "bytesUsed": rows[:, 1], self.tie: rows[:, 2], "quota": version[:, 1],
                "quota_null": version[:, 2], "billingYear": 1970 + month // 12, "billingMonth": month % 12 + 1}, self.watermark)
            if out is not None:
                yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.watermark = timerValues.getCurrentWatermarkInMs()
        yield from super().handleInputRows(key, rows, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # The clock is the timer's: however far the watermark jumped, usage that waited is not late, and it comes before
        # its month is cleared, as a row of a month lies before its end.
        expiry = self.watermark = expiredTimerInfo.getExpiryTimeInMs()
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
        if self.totals.grace is not None:
            end = datetime.fromtimestamp(0, timezone.utc) + timedelta(milliseconds=expiry - self.totals.grace)
            if (end.day, end.hour, end.minute, end.second, end.microsecond) == (1, 0, 0, 0, 0):
                self.totals.clear(expiry)


def _is_versioned_join(df: DataFrame) -> bool:
    """Whether a stateful operator with event time stands below already."""
    return df.isStreaming and "EventTimeWatermark" in df._jdf.queryExecution().logical().toString()


def _out_schema(tie: str) -> T.StructType:
    return T.StructType([
        T.StructField("ts_us", T.LongType()), T.StructField("account", T.StringType()),
        T.StructField("billingYear", T.LongType()), T.StructField("billingMonth", T.LongType()),
        T.StructField("quota", T.LongType()), T.StructField("total", T.LongType()),
        T.StructField(tie, T.LongType())])


def _with_message(out: DataFrame, tie: str) -> DataFrame:
    return (out.select(F.timestamp_micros("ts_us").alias("ts"), "account", "billingYear", "billingMonth",
                       "quota", "total", tie)
               .withColumn("message", alert_message("ts", "account", "total", "quota")))


def stream_usage_alerts(enriched: DataFrame, tie: str, ratio: float = ALERT_RATIO,
                        key: Sequence[str] = BILLING_KEY, clear_after: timedelta | None = None,
                        watermark_delay: str = "0 seconds", initial: DataFrame | None = None,
                        account_groups: int | None = None) -> DataFrame:
    """Alerts of an enriched usage stream (append mode): ``ts, account, billingYear, billingMonth,
    quota, total, message`` plus ``tie``.  Also runs on a bounded DataFrame (without ``clear_after``).

    ``initial`` takes over from a batch run: totals and flags of the usage before the stream's first row, from
    :func:`~meterline.operators.alerts.billing_state` with the same key and ratio.  It is computed by this
    call; Spark reads it in the query's first micro-batch only.  ``account_groups``: into how many groups accounts are
    dealt, each with one call a micro-batch; by default every account has its own."""
    use_rocksdb_state(enriched.sparkSession)
    key, zero = list(key), F.lit(0).cast("long")
    upstream_time = "event_ts" in enriched.columns
    cols = ["account", "billingYear", "billingMonth", F.coalesce("quota", zero).alias("quota"),
            F.col("quota").isNull().alias("quota_null"), F.unix_micros("ts").alias("ts_us"),
            F.coalesce(F.col("bytesUsed").cast("long"), zero).alias("bytesUsed"),
            F.coalesce(F.col(tie).cast("long"), zero).alias(tie)]
    prepared = enriched.select(*cols, *(["event_ts"] if upstream_time else []))
    time_mode = "None"
    if clear_after is not None and not upstream_time and _is_versioned_join(enriched):
        raise ValueError("clearing after a version-stream join needs its watermark: use stream_versioned_alerts, "
                         "or late='drop' in the join")
    if clear_after is not None:
        # Rows of the version-stream join already carry its watermark (``event_ts``); any other input
        # gets one here.  A second watermark after that join would find every released row late.
        if not upstream_time:
            prepared = (prepared.withColumn("event_ts", F.timestamp_micros("ts_us"))
                                .withWatermark("event_ts", watermark_delay).drop("event_ts"))
        time_mode = "EventTime"
    begin = None
    if initial is not None:
        sub = [k for k in key if k not in ("account", "quota")]
        quota = [F.coalesce("quota", zero).alias("quota"), F.col("quota").isNull().alias("quota_null")] if "quota" in key else []
        start = initial.select("account", *sub, *quota, "total", "alerted")
        if enriched.isStreaming:
            # Planned within a stream, whose planner does without adaptive shuffles, large joins of the batch fail, and
            # every micro-batch would plan them again: compute it once into the shared folder.
            path = scratch_path(start.sparkSession, "initial")
            start.write.parquet(path)
            start = start.sparkSession.read.schema(start.schema).parquet(path)
        begin = grouped(start, "account", account_groups)
    out = grouped(prepared, "account", account_groups).transformWithStateInPandas(
        UsageAlertProcessor(tie, ratio, clear_after, key, "account" if account_groups else None), _out_schema(tie), "Append", time_mode, begin)
    return _with_message(out, tie)


def stream_versioned_alerts(usage: DataFrame, versions: DataFrame, tie: str, ratio: float = ALERT_RATIO,
                            key: Sequence[str] = BILLING_KEY, clear_after: timedelta | None = None,
                            delay: str = "0 seconds", late: str = "emit", wait_for: str = "usage",
                            version_delay: str | None = None, horizon: timedelta | None = None,
                            account_groups: int | None = None, bucket: timedelta = BUCKET) -> DataFrame:
    """Alerts of a usage stream joined with a version stream, in one stateful operator; the parameters are those of
    :func:`~meterline.streaming.enrich.enrich_versioned` and :func:`stream_usage_alerts`.  With ``clear_after`` late
    usage counts as long as its month is open."""
    keep = _horizon(horizon, late)
    both = two_sides(usage, versions, tie, delay, version_delay or delay, wait_for)
    both = both.select("key_id", *(["wm_ts"] if late == "drop" else []), "ts_us", "side", "bytesUsed", tie, "quota", "quota_null")
    out = grouped(both, "key_id", account_groups).transformWithStateInPandas(
        VersionedAlertProcessor(tie, keep, ratio, clear_after, list(key), "key_id" if account_groups else None, bucket), _out_schema(tie), "Append", "EventTime")
    return _with_message(out, tie)
