"""Continuously updated per-account totals.

``account_totals`` from :mod:`meterline.operators.totals` is the same expression on a ``readStream``
DataFrame: Spark keeps one aggregation state row per account (no watermark, so nothing is late and no
state is dropped) and, in ``update`` mode, emits the changed accounts of each micro-batch.  When every
step matters, :class:`TotalChangesProcessor` emits the change rows ``+I`` / ``-U`` / ``+U`` per usage
record instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import use_rocksdb_state

from ..operators.totals import account_totals
from ..operators.scan import check_sums
from .keyed_state import Accounts, by_account, grouped, in_order, opened, packed


def stream_account_totals(usage: DataFrame) -> DataFrame:
    """``account, totalUsage, asOf`` — run with ``outputMode("update")`` (or ``complete``)."""
    return account_totals(usage, total="totalUsage")


class TotalChangesProcessor(StatefulProcessor):
    """Per account: running total and latest time; one ``+I`` and then ``-U``/``+U`` pairs per row.  With ``column``,
    the accounts' column, a key is a group of accounts, and one value holds (number, total, time) of each."""

    def __init__(self, tie: str, column: str | None = None):
        self.tie, self.column = tie, column

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accounts = Accounts(handle, self.column)
        self.state = handle.getValueState("acc", "rows binary" if self.column else "total long, asof long")

    def _known(self, n: int) -> np.ndarray:
        """(total, latest time, whether there was any) of the first ``n`` accounts."""
        have, out = self.state.get(), np.zeros((n, 3), "<i8")
        if have is not None:
            rows = opened(have[0], 3) if self.column else np.array([[have[0], have[1], 1]], "<i8")
            out[:len(rows)] = rows
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.accounts.begin(key)
        chunks = [np.stack([pdf[c].to_numpy().astype("int64") for c in ("ts_us", "bytesUsed", self.tie)]
                           + [self.accounts.codes(pdf)], axis=1) for pdf in rows]
        ts, used, tie, code = by_account(in_order(np.concatenate(chunks))).T
        known = self._known(len(self.accounts.names))
        first = np.append(True, code[1:] != code[:-1])
        fresh = first & (known[code, 2] == 0)
        totals = check_sums(pd.Series(used).groupby(code).cumsum().to_numpy() + known[code, 0], used)
        # Rows of an account are in time order: only its time so far may lie after them.
        asof = np.where(known[code, 2] == 0, ts, np.maximum(ts, known[code, 1]))
        before_total = np.where(first, known[code, 0], np.append(0, totals[:-1]))
        before_asof = np.where(first, known[code, 1], np.append(0, asof[:-1]))
        last = np.flatnonzero(np.append(first[1:], True))
        known[code[last]] = np.stack([totals[last], asof[last], np.ones(len(last), "<i8")], axis=1)
        self.state.update((packed(known),) if self.column else (int(known[0, 0]), int(known[0, 1])))
        names = self.accounts.of(code)
        self.accounts.save()
        plus = pd.DataFrame({"op": np.where(fresh, "+I", "+U"), "account": names, "totalUsage": totals, "asof_us": asof,
                             "ts_us": ts, self.tie: tie, "step": 1})
        minus = pd.DataFrame({"op": "-U", "account": names, "totalUsage": before_total, "asof_us": before_asof, "ts_us": ts,
                              self.tie: tie, "step": 0})[~fresh]
        yield pd.concat([minus, plus], ignore_index=True)

    def close(self) -> None:
        pass


def stream_total_changes(usage: DataFrame, tie: str, account_groups: int | None = None) -> DataFrame:
    """Change rows of the per-account total, one step per usage row (append mode):
    ``op, account, totalUsage, asOf, ts, tie``.  A null amount counts as 0.  ``account_groups``: into how many groups
    accounts are dealt, each with one call a micro-batch; by default every account has its own."""
    use_rocksdb_state(usage.sparkSession)
    schema = T.StructType([
        T.StructField("op", T.StringType()), T.StructField("account", T.StringType()),
        T.StructField("totalUsage", T.LongType()), T.StructField("asof_us", T.LongType()),
        T.StructField("ts_us", T.LongType()), T.StructField(tie, T.LongType()),
        T.StructField("step", T.IntegerType())])
    zero = F.lit(0).cast("long")     # a column with nulls would reach the processor as float64
    prepared = usage.select("account", F.coalesce(F.col("bytesUsed").cast("long"), zero).alias("bytesUsed"),
                            F.unix_micros("ts").alias("ts_us"), F.coalesce(F.col(tie).cast("long"), zero).alias(tie))
    out = grouped(prepared, "account", account_groups).transformWithStateInPandas(
        TotalChangesProcessor(tie, "account" if account_groups else None), schema, "Append", "None")
    return out.select("op", "account", "totalUsage", F.timestamp_micros("asof_us").alias("asOf"),
                      F.timestamp_micros("ts_us").alias("ts"), tie)
