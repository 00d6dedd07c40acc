"""SQL access: the usage and account tables as temporary views, and the enrichment query as SQL text.

Spark SQL has no per-row ``FOR SYSTEM_TIME AS OF`` join, so the account view is offered as validity
intervals (``account_intervals``) and the as-of lookup becomes an equi-join plus a time range.  Where accounts
have many versions, views of coarser intervals (``account_spans_1``, ...) lie above it, as in
:func:`meterline.operators.asof.interval_levels`: a span covers up to ``FAN`` of the next level, so a usage row
meets at most that many rows of each view.  :func:`enrich_text` is the query for a number of levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import FAN, interval_levels, version_stats
from ..sources.codec import decode_usage, decode_usage_tolerant

ENRICH_SQL = """
SELECT data_consumption.account AS account,
       data_consumption.bytesUsed AS bytesUsed,
       account_intervals.quota AS quota,
       data_consumption.ts AS ts,
       CAST(EXTRACT(YEAR FROM data_consumption.ts) AS BIGINT) AS billingYear,
       CAST(EXTRACT(MONTH FROM data_consumption.ts) AS BIGINT) AS billingMonth
FROM data_consumption JOIN account_intervals
  ON data_consumption.account = account_intervals.id
 AND data_consumption.ts >= account_intervals.valid_from
 AND (account_intervals.valid_to IS NULL OR data_consumption.ts < account_intervals.valid_to)
"""


TOTALS_SQL = """
SELECT account, SUM(bytesUsed) AS totalConsumption, MAX(ts) AS asOf
FROM data_consumption
GROUP BY account
"""


def enrich_text(levels: int = 1) -> str:
    """The enrichment query through ``levels`` interval views, the coarsest first."""
    joins, above = [], None
    for name in [f"account_spans_{n}" for n in range(1, levels)] + ["account_intervals"]:
        joins.append(f"JOIN {name} ON data_consumption.account = {name}.id AND data_consumption.ts >= {name}.valid_from\n"
                     f" AND ({name}.valid_to IS NULL OR data_consumption.ts < {name}.valid_to)"
                     + (f"\n AND {name}.above = {above}.number" if above else ""))
        above = name
    select = ENRICH_SQL.partition("FROM data_consumption JOIN")[0]
    return select + "FROM data_consumption\n" + "\n".join(joins) + "\n"


def register_views(spark: SparkSession, usage: DataFrame, versions: DataFrame) -> int:
    """``data_consumption`` (usage), ``account`` (versions), ``account_intervals`` and the views above it; returns
    the number of interval views, which follows from the most versions of an account (one aggregate, run here).

    ``ENRICH_SQL`` reads ``account_intervals`` alone, which is right at any number of levels.
    """
    usage.createOrReplaceTempView("data_consumption")
    versions.createOrReplaceTempView("account")
    most = version_stats(versions).max_per_key
    levels = interval_levels(versions, ["quota"], most, plan="window" if most <= FAN else "buckets")
    # two versions of one account at one time fail the query that reads them
    same = F.raise_error(F.lit("two versions of one account share a time"))
    for n, level in enumerate(levels, 1):
        view = level.select(F.col("_iv_id").alias("id"), F.col("_iv_up").alias("above"), F.col("_iv_at").alias("number"),
                            F.col("_iv_from").alias("valid_from"), F.col("_iv_to").alias("valid_to"),
                            *([F.col("_iv_quota").alias("quota")] if n == len(levels) else []))
        if n < len(levels):
            view.createOrReplaceTempView(f"account_spans_{n}")
        else:
            (view.withColumn("valid_to", F.when(F.col("valid_to") == F.col("valid_from"), same.cast("timestamp"))
                             .otherwise(F.col("valid_to"))).createOrReplaceTempView("account_intervals"))
    return len(levels)


def enrich_sql(spark: SparkSession, levels: int = 1) -> DataFrame:
    return spark.sql(enrich_text(levels))


def totals_sql(spark: SparkSession) -> DataFrame:
    return spark.sql(TOTALS_SQL)


def register_log_table(raw: DataFrame, name: str = "data_consumption", strict: bool = True) -> DataFrame:
    """The SQL-declared log table: ``account, bytesUsed`` from the JSON body and ``ts`` from the log
    record's own timestamp (the record metadata), as a temporary view.  Works on ``read`` and
    ``readStream`` log DataFrames; add ``withWatermark("ts", …)`` for event-time operators.  With
    ``strict=False`` malformed records go to the view ``<name>_rejects`` instead of failing."""
    if strict:
        table = decode_usage(raw, ts_from="record")
    else:
        table, rejects = decode_usage_tolerant(raw, ts_from="record")
        rejects.createOrReplaceTempView(f"{name}_rejects")
    table.createOrReplaceTempView(name)
    return table
