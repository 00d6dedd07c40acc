"""Maps the driver's test tables onto the usage and account-version records.

``events`` rows other than sign-ups are usage; sign-ups are new quota versions of the user's
account.  ``orders``/``customer`` give a long range (1990s to 2000s) for month and year changes.
Parquet times there carry no zone; they are read as UTC instants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.billing import account_id

# Fixed values of the mapping: the sign-up event type, the quota base of an event version, the
# snapshot time and quota of the long-range (orders) versions, and a one-week range of the test month.
SIGNUP = "signup"
EVENT_QUOTA_BASE = 50000
ORDER_VERSION_TS = "1990-01-01 00:00:00"
LONG_RANGE_QUOTA = 1_000_000
RANGE_START = "2024-01-08 00:00:00"
RANGE_END = "2024-01-15 00:00:00"
HOT_ACCOUNT = "000000"


# Declared schemas of the tables used.  Their zone-less parquet times are read as instants (the
# session zone is UTC), which keeps time filters on the raw column, so they reach the parquet scan.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp, o_orderpriority string"),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def usage_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``account, bytesUsed, ts, event_id`` — ``event_id`` orders rows with equal times."""
    ev = table(spark, sf_dir, "events")
    return (ev.where(F.col("event_type") != SIGNUP)
              .select(account_id("user_id").alias("account"),
                      F.round(F.col("value") * 100).cast("long").alias("bytesUsed"),
                      F.col("ts"),
                      F.col("event_id")))


def usage_hot_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events usage with a third of its rows (every third event id) re-assigned to one account,
    ``HOT_ACCOUNT``: a skew fixture.  No row is dropped."""
    u = usage_from_events(spark, sf_dir)
    return u.withColumn("account", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(HOT_ACCOUNT))
                                    .otherwise(F.col("account")))


def usage_hot_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The skew fixture with all rows of ``HOT_ACCOUNT`` at one time: only the tie orders them."""
    u = usage_hot_account(spark, sf_dir)
    at = F.lit(RANGE_START).cast("timestamp")
    return u.withColumn("ts", F.when(F.col("account") == HOT_ACCOUNT, at).otherwise(F.col("ts")))


def versions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, quota, ts`` — every sign-up starts a new quota for the user's account."""
    ev = table(spark, sf_dir, "events")
    return (ev.where(F.col("event_type") == SIGNUP)
              .select(account_id("user_id").alias("id"),
                      (F.lit(EVENT_QUOTA_BASE) + F.round(F.col("value") * 100).cast("long")).alias("quota"),
                      F.col("ts")))


def versions_hot_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events versions, and every one of them as a version of ``HOT_ACCOUNT`` too (of equal times the
    largest quota): one account with as many versions as there are sign-up times."""
    v = versions_from_events(spark, sf_dir)
    hot = (v.groupBy("ts").agg(F.max("quota").alias("quota"))
            .select(F.lit(HOT_ACCOUNT).alias("id"), "quota", "ts"))
    return v.where(F.col("id") != HOT_ACCOUNT).unionByName(hot)


def usage_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-range usage: one order is one usage row; ``o_orderkey`` is the tie column."""
    o = table(spark, sf_dir, "orders")
    return o.select(account_id("o_custkey").alias("account"),
                    F.round(F.col("o_totalprice")).cast("long").alias("bytesUsed"),
                    F.col("o_orderdate").alias("ts"),
                    F.col("o_orderkey").alias("event_id"))


def versions_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot version per customer, like the demo's single account snapshot."""
    c = table(spark, sf_dir, "customer")
    return c.select(account_id("c_custkey").alias("id"),
                    F.lit(LONG_RANGE_QUOTA).cast("long").alias("quota"),
                    F.to_timestamp(F.lit(ORDER_VERSION_TS)).alias("ts"))


def raw_log_from_events(spark: SparkSession, sf_dir: str, topic: str = "input",
                        partitions: int = 8) -> DataFrame:
    """The usage rows as a log would hold them: JSON bodies, record time = event time.

    The log partition is a hash of the event id (the producer sets no key), the offset the event id.
    """
    from .sources.codec import encode_usage

    u = usage_from_events(spark, sf_dir)
    return encode_usage(u, topic=topic, extra=[
        F.pmod(F.xxhash64("event_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    ])
