"""Account versions: ``id, quota, ts`` — the quota in force for account ``id`` from ``ts`` on.

A snapshot (the demo's single version per account) or a changelog of quota changes, read as a table
(``read``) or as a stream (``readStream``).  One row per ``(id, ts)`` is required by the as-of join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import latest_per_time, version_stats
from ..schemas import ACCOUNT_VERSION


def read_versions(spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Versions with the fixed schema (JSON times use the session zone, UTC)."""
    r = (spark.readStream if streaming else spark.read).schema(ACCOUNT_VERSION).format(fmt)
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def snapshot(spark: SparkSession, ids: DataFrame, quota: int, valid_from: str, id_col: str = "id") -> DataFrame:
    """One version per id with the same quota, valid from ``valid_from`` (an ISO instant)."""
    return ids.select(F.col(id_col).cast("string").alias("id"), F.lit(quota).cast("long").alias("quota"),
                      F.to_timestamp(F.lit(valid_from)).alias("ts"))


def checked_versions(versions: DataFrame, tie: str | None = None) -> DataFrame:
    """Raise if two versions of an account share a time, unless ``tie`` picks the one to keep."""
    if tie is not None:
        return latest_per_time(versions, tie)
    st = version_stats(versions)
    if not st.unique:
        raise ValueError(f"{st.max_same_time} versions of one account share a time")
    return versions
