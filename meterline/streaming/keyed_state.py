"""What the stateful processors keep per account, or group of accounts, cut by time so that a call reads only the times it needs.

Rows are small arrays of 64-bit integers, kept as bytes: one state value holds a bucket's rows (or a batch's share of
them), and a state call costs far more than the few bytes it moves.
"""

from __future__ import annotations

import json
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

#: Width of the time buckets of waiting usage and of versions.
BUCKET = timedelta(days=1)
NEVER = np.iinfo("<i8").max
#: Groups of accounts that streams of many accounts pass as ``account_groups``: a call costs milliseconds, however few
#: its rows.
GROUPS = 1024


def micros(width: timedelta) -> int:
    return max(1000, width // timedelta(microseconds=1))


def packed(rows: np.ndarray) -> bytes:
    return np.ascontiguousarray(rows, dtype="<i8").tobytes()


def opened(data, columns: int) -> np.ndarray:
    return np.frombuffer(bytes(data), "<i8").reshape(-1, columns)


def groups(numbers: np.ndarray):
    """(number, positions) of the distinct numbers of an array, ascending."""
    order = np.argsort(numbers, kind="stable")
    distinct, first = np.unique(numbers[order], return_index=True)
    return zip(distinct.tolist(), np.split(order, first[1:]))


def last_before(rows: np.ndarray, times: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Of each (time, account) the position of the account's last row at or before the time, or -1; ``rows`` begin
    with a time, end with an account's number in column 3, if they have one, and are sorted by account and time."""
    if not len(rows):
        return np.full(len(times), -1)
    distinct, own = np.unique(rows[:, 0]), code_of(rows)
    room = len(distinct) + 1
    at = np.searchsorted(own * room + np.searchsorted(distinct, rows[:, 0], "right"),
                         codes * room + np.searchsorted(distinct, times, "right"), "right") - 1
    return np.where((at >= 0) & (own[at] == codes), at, -1)


def code_of(rows: np.ndarray) -> np.ndarray:
    """The accounts' numbers of rows: column 3, where several accounts share a key."""
    return rows[:, 3] if rows.shape[1] > 3 else np.zeros(len(rows), "<i8")


def by_account(rows: np.ndarray) -> np.ndarray:
    return rows[np.lexsort((rows[:, 0], code_of(rows)))]


def grouped(rows: DataFrame, account: str, account_groups: int | None) -> GroupedData:
    """Rows by the key of a processor: the account, or one of so many groups of accounts."""
    if account_groups is None:
        return rows.groupBy(account)
    return rows.withColumn("account_group", F.pmod(F.xxhash64(account), F.lit(account_groups))).groupBy("account_group")


class Accounts:
    """The accounts that share a key, as numbers that stay the same from call to call; without ``column`` the key is
    an account itself and its number is 0."""

    def __init__(self, handle: StatefulProcessorHandle, column: str | None):
        self.column = column
        self.state = handle.getValueState("accounts", "names string") if column else None

    def begin(self, key) -> None:
        if not self.column:
            self.names = [key[0]]
            return
        value = self.state.get()
        self.names = json.loads(value[0]) if value is not None else []
        self.known, self.number = len(self.names), {name: i for i, name in enumerate(self.names)}

    def codes(self, pdf: pd.DataFrame) -> np.ndarray:
        if not self.column:
            return np.zeros(len(pdf), "<i8")
        own, distinct = pd.factorize(pdf[self.column].to_numpy(), use_na_sentinel=False)
        found = np.zeros(len(distinct), "<i8")
        for i, name in enumerate(distinct.tolist()):
            name = name if isinstance(name, str) else None
            found[i] = self.number.setdefault(name, len(self.names))
            if found[i] == len(self.names):
                self.names.append(name)
        return found[own]

    def of(self, codes: np.ndarray) -> np.ndarray:
        return np.array(self.names, object)[codes]

    def save(self) -> None:
        if self.column and len(self.names) > self.known:
            self.state.update((json.dumps(self.names),))
            self.known = len(self.names)

    def forget(self) -> None:
        """Nothing is kept of these accounts any more."""
        if self.column:
            self.state.clear()


class VersionStore:
    """Versions (time, quota, whether the quota is null; account's number, if accounts share the key) in time buckets,
    and a list of the buckets in which each account has any, with its first and second time there.  A lookup reads the
    list and the buckets that hold the versions it finds."""

    def __init__(self, handle: StatefulProcessorHandle, width: timedelta = BUCKET, columns: int = 3):
        self.width, self.columns = micros(width), columns
        self.rows = handle.getMapState("versions", "bucket long", "rows binary")
        self.list = handle.getValueState("version_buckets", "buckets binary")

    def _listed(self) -> np.ndarray:
        """(bucket, first time, second time, account) by account and bucket."""
        value = self.list.get()
        return opened(value[0], 4) if value is not None else np.zeros((0, 4), "<i8")

    def _load(self, bucket: int) -> np.ndarray:
        return opened(self.rows.getValue((int(bucket),))[0], self.columns)

    def _loaded(self, buckets) -> np.ndarray:
        return by_account(np.concatenate([np.zeros((0, self.columns), "<i8"), *map(self._load, buckets)]))

    def _entries(self, bucket: int, rows: np.ndarray) -> np.ndarray:
        codes = code_of(rows)
        at = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        two = np.diff(np.append(at, len(rows))) > 1
        second = np.where(two, rows[np.minimum(at + 1, len(rows) - 1), 0], NEVER)
        return np.stack([np.full(len(at), bucket), rows[at, 0], second, codes[at]], axis=1)

    def _relist(self, listed: np.ndarray, buckets: list[int], fresh: list[np.ndarray]) -> None:
        rest = listed[~np.isin(listed[:, 0], buckets)]
        self.list.update((packed(by_account(np.concatenate([rest, *fresh]))),))

    def add(self, new: np.ndarray) -> None:
        """Versions, later ones replacing earlier ones of the same time."""
        listed = self._listed()
        have, touched, fresh = set(listed[:, 0].tolist()), [], []
        for bucket, at in groups(new[:, 0] // self.width):
            rows = new[at]
            if bucket in have:
                rows = np.concatenate([self._load(bucket), rows])
            rows = latest_versions(rows)
            self.rows.updateValue((bucket,), (packed(rows),))
            touched.append(bucket)
            fresh.append(self._entries(bucket, rows))
        self._relist(listed, touched, fresh)

    def _entry_in_force(self, listed: np.ndarray, times: np.ndarray, codes: np.ndarray) -> np.ndarray:
        p = last_before(listed, times // self.width, codes)
        if not len(listed):
            return p
        # A time before its own bucket's first version takes the account's bucket before.
        early = (p >= 0) & (listed[p, 1] > times)
        earlier = np.where((p > 0) & (listed[np.maximum(p - 1, 0), 3] == codes), p - 1, -1)
        return np.where(early, earlier, p)

    def around(self, low: int, high: int, codes: np.ndarray | None = None) -> np.ndarray:
        """The accounts' versions in force at some time from ``low`` to ``high``, by account and time (perhaps a few
        more)."""
        codes = np.zeros(1, "<i8") if codes is None else codes
        listed = self._listed()
        p = self._entry_in_force(listed, np.full(len(codes), low), codes)
        within = (listed[:, 0] >= low // self.width) & (listed[:, 0] <= high // self.width)
        later = listed[within & np.isin(listed[:, 3], codes), 0]
        return self._loaded(np.union1d(later, listed[p[p >= 0], 0]).tolist())

    def in_force(self, times: np.ndarray, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Whether a version is in force at each of the times, and which: rows of (time, quota, null)."""
        codes = np.zeros(len(times), "<i8") if codes is None else codes
        listed = self._listed()
        p = self._entry_in_force(listed, times, codes)
        return versions_at(self._loaded(np.unique(listed[p[p >= 0], 0]).tolist()), times, codes)

    def prune(self, before: int) -> None:
        """Removes versions that no time from ``before`` on can use."""
        listed = self._listed()
        old = np.unique(listed[listed[:, 0] <= before // self.width, 0]).tolist()
        rows = self._loaded(old)
        keep = np.arange(len(rows)) >= last_before(rows, np.full(len(rows), before), code_of(rows))
        if keep.all():
            return
        own, touched, fresh = rows[:, 0] // self.width, [], []
        for bucket in np.unique(own[~keep]).tolist():
            left = rows[(own == bucket) & keep]
            touched.append(bucket)
            if len(left):
                self.rows.updateValue((bucket,), (packed(left),))
                fresh.append(self._entries(bucket, left))
            else:
                self.rows.removeKey((bucket,))
        self._relist(listed, touched, fresh)

    def second(self) -> int | None:
        """The time from which some account's oldest version is of no use, if there is one after it."""
        listed = self._listed()
        if not len(listed):
            return None
        first = np.append(True, listed[1:, 3] != listed[:-1, 3])
        after = np.append(np.where(first[1:], NEVER, listed[1:, 1]), NEVER)
        us = int(np.minimum(listed[:, 2], after)[first].min())
        return None if us == NEVER else us


def latest_versions(rows: np.ndarray) -> np.ndarray:
    """Versions by account and time, the last given one of each."""
    rows = by_account(rows[::-1])
    codes = code_of(rows)
    return rows[np.append(True, (rows[1:, 0] != rows[:-1, 0]) | (codes[1:] != codes[:-1]))]


def versions_at(rows: np.ndarray, times: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the versions (by account and time) is in force at each time, if any."""
    at = last_before(rows, times, codes)
    return at >= 0, rows[at, :3] if len(rows) else np.zeros((len(times), 3), "<i8")


class Calendar:
    """Usage (time, bytes, tie; account's number, if accounts share the key) waiting for its time: a queue of time buckets.

    A batch's rows of a bucket are one part of it, so nothing that waits is rewritten.  Each bucket has a timer at its
    earliest row; a release reads that bucket only, however much waits in others.
    """

    def __init__(self, handle: StatefulProcessorHandle, width: timedelta = BUCKET, columns: int = 3):
        self.handle, self.width, self.columns = handle, micros(width) // 1000 * 1000, columns
        self.parts = handle.getMapState("waiting_parts", "bucket long", "n long, first_ms long")
        self.rows = handle.getMapState("waiting", "bucket long, part long", "rows binary")

    def add(self, rows: np.ndarray) -> None:
        for bucket, at in groups(rows[:, 0] // self.width):
            have = self.parts.getValue((bucket,))
            n, first = (0, None) if have is None else (int(have[0]), int(have[1]))
            own = int(rows[at, 0].min()) // 1000
            if first is None or own < first:
                self.handle.registerTimer(own)
                first = own
            self.rows.updateValue((bucket, n), (packed(rows[at]),))
            self.parts.updateValue((bucket,), (n + 1, first))

    def earliest(self) -> int | None:
        """Time (ms) of the earliest row that waits; reads a number per bucket."""
        return min((int(first) for _, first in self.parts.values()), default=None)

    def release(self, expiry_ms: int, watermark_ms: int) -> np.ndarray:
        """The rows that the watermark has reached in the bucket whose timer expired, in (time, tie) order."""
        bucket = expiry_ms * 1000 // self.width
        have = self.parts.getValue((bucket,))
        if have is None:
            return np.zeros((0, self.columns), "<i8")
        rows = []
        for part in range(int(have[0])):
            rows.append(opened(self.rows.getValue((bucket, part))[0], self.columns))
            self.rows.removeKey((bucket, part))
        rows = np.concatenate(rows)
        ready = rows[:, 0] // 1000 <= watermark_ms
        rest = rows[~ready]
        if len(rest):
            first = int(rest[:, 0].min()) // 1000
            self.rows.updateValue((bucket, 0), (packed(rest),))
            self.parts.updateValue((bucket,), (1, first))
            self.handle.registerTimer(first)
        else:
            self.parts.removeKey((bucket,))
        return in_order(rows[ready])


def in_order(rows: np.ndarray) -> np.ndarray:
    """Rows of (time, bytes, tie) by time and tie."""
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]
