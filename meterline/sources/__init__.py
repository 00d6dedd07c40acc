"""Sources and sinks: the usage log (Kafka or file replay), JSON codec, account versions, tables."""

from .codec import decode_usage, decode_usage_tolerant, encode_usage, usage_json
from .log import in_range, kafka_options, read_log, write_log
from .tables import read_table, save_bucketed
from .versions import checked_versions, read_versions, snapshot

__all__ = ["decode_usage", "decode_usage_tolerant", "encode_usage", "usage_json", "in_range", "kafka_options",
           "read_log", "write_log", "read_table", "save_bucketed", "checked_versions", "read_versions",
           "snapshot"]
