"""Running streaming queries restart-safely, and the idempotent sinks they write to.

Every query gets a ``checkpointLocation`` (offsets, commits and state live there), so a restarted query
resumes after the last committed micro-batch.  Sinks are either Spark's file sink (exactly once through
its own commit log) or ``foreachBatch`` writers that overwrite the folder of their ``batch_id``, so a
batch replayed after a failure replaces its first attempt instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path

BATCH = "batch_id"


def batch_folder_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch to ``path/batch_id=N`` (overwrite: idempotent)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/{BATCH}={batch_id}")
    return write


def start(df: DataFrame, checkpoint: str, output_mode: str = "append", path: str | None = None,
          sink: Callable[[DataFrame, int], None] | None = None, fmt: str = "parquet",
          trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Start ``df`` into a file sink at ``path`` or a ``foreachBatch`` ``sink``.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` — ``{"availableNow": True}`` replays what is
    there and stops; ``{"processingTime": "5 seconds"}`` is the producer's interval; none means
    micro-batches back to back.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    if sink is not None:
        return w.foreachBatch(sink).start()
    return w.format(fmt).option("path", path).start()


def run_to_end(df: DataFrame, checkpoint: str, output_mode: str = "append", path: str | None = None,
               sink: Callable[[DataFrame, int], None] | None = None, timeout_s: float | None = None) -> None:
    """Replay everything available (``availableNow``) and wait for the query to stop."""
    q = start(df, checkpoint, output_mode, path, sink, trigger={"availableNow": True})
    await_end(q, timeout_s)


def await_end(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for a query started with ``availableNow`` to stop, without a limit by default; re-raise its
    failure."""
    try:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            raise TimeoutError(f"stream did not finish in {timeout_s} s")
        if q.exception() is not None:
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()


def latest_per_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Read a ``batch_id``-partitioned update log back as the latest row per key (a grouped
    ``max_by`` — combined map-side, so a key updated in every batch does not meet in one task)."""
    log = spark.read.parquet(path)
    rest = [c for c in log.columns if c not in keys and c != BATCH]
    return (log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("_r"))
               .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def fresh_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """A new (output, checkpoint) pair below the shared folder."""
    base = scratch_path(spark, "streams", name)
    return f"{base}/out", f"{base}/checkpoint"
