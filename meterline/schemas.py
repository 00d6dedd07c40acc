"""Fixed record schemas.  Nothing in the library infers a schema."""

from pyspark.sql import types as T

# The JSON time pattern of usage records, the default topic and broker, the alert text.
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"
DEFAULT_TOPIC = "input"
DEFAULT_BROKERS = "localhost:9092"
ALERT_FORMAT = "WARNING: as of %s account %s has used %d out of %d bytes"
ALERT_RATIO = 0.9

# Usage record (JSON body of a log record).
USAGE = T.StructType([
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("account", T.StringType(), False),
    T.StructField("bytesUsed", T.LongType(), False),
])

# The body fields the SQL-declared table reads: event time comes from the record, not the body.
USAGE_BODY_NO_TS = T.StructType([
    T.StructField("account", T.StringType(), True),
    T.StructField("bytesUsed", T.LongType(), True),
])

# Parsing schema: every field nullable so that missing fields can be detected and reported.
USAGE_PARSE = T.StructType([T.StructField(f.name, f.dataType, True) for f in USAGE.fields])

# A log record as Kafka (and our file replay of it) exposes it.
RAW_LOG = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# One version of an account: the quota in force from ``ts`` on.
ACCOUNT_VERSION = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("quota", T.LongType(), True),
    T.StructField("ts", T.TimestampType(), False),
])

ENRICHED = T.StructType([
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("account", T.StringType(), False),
    T.StructField("bytesUsed", T.LongType(), False),
    T.StructField("quota", T.LongType(), True),
    T.StructField("billingYear", T.LongType(), False),
    T.StructField("billingMonth", T.LongType(), False),
])

BILLING_KEY = ["account", "billingYear", "billingMonth", "quota"]
