"""Quota enrichment: usage joined to the account version in force at the usage time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.billing import billing_month, billing_year
from ..schemas import ENRICHED
from .asof import as_of_join


def enrich_usage(usage: DataFrame, versions: DataFrame, strategy: str = "auto",
                 version_tie: str | None = None, **kw) -> DataFrame:
    """Usage columns plus ``quota``, ``billingYear`` and ``billingMonth`` (longs, session zone UTC).

    ``versions`` has ``id, quota, ts``; usage before an account's first version and usage of unknown
    accounts are dropped.
    """
    joined = as_of_join(usage, versions, "account", "id", "ts", "ts", values=["quota"],
                        strategy=strategy, tie=version_tie, **kw)
    return joined.withColumns({"billingYear": billing_year("ts"), "billingMonth": billing_month("ts")})


def to_enriched_records(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed enriched records: the fields of the fixed ``ENRICHED`` schema, matched by name and cast to
    their types (``keep`` passes further columns, such as a tie column, through)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ENRICHED.fields], *keep)


def enriched_view(enriched: DataFrame) -> DataFrame:
    """The projection of the enrichment query: ``account, bytesUsed, quota, ts``."""
    return enriched.select("account", "bytesUsed", "quota", "ts")


def in_time_order(df: DataFrame, tie: str | None = None) -> DataFrame:
    """Global event-time order (range-partitioned sort); ``tie`` orders equal times.

    The row position closes the sort key, so that the range shuffle can split even a run of identical
    rows over several partitions.
    """
    return (df.withColumn("_pos", F.monotonically_increasing_id())
              .orderBy("ts", *([tie] if tie else []), "_pos").drop("_pos"))
