"""Small helpers that several operators share."""

from __future__ import annotations

import string
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir

ARROW_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written once to the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage through a table in the shared folder: the rows are computed once and read narrow."""
    path = scratch_path(df.sparkSession, "tables")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_arrow(df: DataFrame, function, schema, size: int = ARROW_BYTES) -> DataFrame:
    """``mapInArrow`` over batches that are bounded in bytes, not only in rows: texts may be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return df.mapInArrow(function, schema)


def spread(df: DataFrame) -> DataFrame:
    """Deal an aggregate's rows out evenly.  A join on its key then makes an exchange of its own on this
    side too, and only so can Spark split the other side where a key is hot."""
    return df.repartition(partitions(df))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else.  ``lower`` does just that to a text of single-byte characters, and
    is much the faster; other texts go through ``translate``."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def ratio(threshold: float | str) -> tuple[int, int]:
    """A similarity such as 0.85 as an exact fraction."""
    f = Fraction(str(threshold))
    return f.numerator, f.denominator
