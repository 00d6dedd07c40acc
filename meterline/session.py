"""Session builder and the shared-folder helper.

Everything the library does assumes the session zone is UTC: usage times are instants, and
``year``/``month``/``date_format`` read them in the session zone.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job of the library relies on.  Callers may add to them, not remove them.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",  # a long sum that overflows raises instead of wrapping
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "meterline",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster leave ``master`` unset and let the launcher decide; ``shuffle_partitions`` should then
    be sized so that one partition of the largest shuffle fits an executor core's memory.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # Runtime SQL settings also apply when the session already existed.
    for k, v in settings.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def use_rocksdb_state(spark: SparkSession) -> None:
    """The keyed processors need the RocksDB state store (several state variables per key).  The
    provider is read when a streaming query starts, so setting it on the session here is enough."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it).  Only a local master without one — tests —
    gets a scratch folder; on a cluster a machine-local folder would lose data, so that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="meterline-")
    sc.setCheckpointDir(path)
    # The context may place a sub-folder below the given one; use what it reports.
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared folder (for stream checkpoints and replay files)."""
    base = shared_dir(spark)
    return os.path.join(base, *parts, uuid.uuid4().hex)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`scratch_path`, wherever the shared folder lies."""
    base, own = shared_dir(spark).rstrip("/") + "/", spark._jvm.org.apache.hadoop.fs.Path(path)
    if not path.startswith(base):
        raise ValueError(f"{path!r} is not below the shared folder")
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
