"""Event-time ordered output of an unbounded stream.

A plain sort is not allowed on a stream.  The version-stream join releases rows only when the
watermark reaches them, so of the rows that weren't late micro-batch ``k`` holds those with
times in ``(wm[k-1], wm[k]]``: sorting inside each batch and appending batches in order gives one
ordered sequence.  Late rows (``mark_late=True`` in the join) can't have a place in it any more; they go to a
folder of their own in the same run, so nothing is lost.  Each batch is written sorted (range-partitioned, so its files are in order too) to
``batch_id=N`` with overwrite, which keeps the sink idempotent under replays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runner import BATCH


def ordered_batch_writer(path: str, order: Sequence[str], late_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch in order to ``path/batch_id=N``; with ``late_path``, rows whose
    column ``late`` is true go to ``late_path/batch_id=N`` instead.  Both overwrite, so replays are idempotent."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # the sort samples its input first: without this the stateful operators would run twice
        kept = batch.persist(StorageLevel.DISK_ONLY)
        try:
            main = kept
            if late_path is not None:
                kept.where("late").drop("late").write.mode("overwrite").parquet(f"{late_path}/{BATCH}={batch_id}")
                main = kept.where("not late").drop("late")
            main.orderBy(*order).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        finally:
            kept.unpersist()
    return write


def read_ordered(spark: SparkSession, path: str, order: Sequence[str]) -> DataFrame:
    """The output as one ordered sequence (batch by batch, then time within a batch)."""
    return spark.read.parquet(path).orderBy(F.col(BATCH), *order).drop(BATCH)
