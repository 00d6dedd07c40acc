"""Structured Streaming: totals, change rows, enrichment, alerts, ordered output, restart-safe runs."""

from .alerts import UsageAlertProcessor, VersionedAlertProcessor, stream_usage_alerts, stream_versioned_alerts
from .carried import CarriedAlerts, carried_alerts_writer
from .enrich import (FINISHED, RetractingJoinProcessor, VersionedJoinProcessor, enrich_changes, enrich_static,
                     enrich_versioned, folded)
from .ordered import ordered_batch_writer, read_ordered
from .runner import await_end, batch_folder_writer, latest_per_key, run_to_end, start
from .totals import TotalChangesProcessor, stream_account_totals, stream_total_changes

__all__ = ["UsageAlertProcessor", "VersionedAlertProcessor", "stream_usage_alerts", "stream_versioned_alerts",
           "CarriedAlerts", "carried_alerts_writer",
           "FINISHED", "RetractingJoinProcessor", "VersionedJoinProcessor", "enrich_changes", "enrich_static",
           "enrich_versioned", "folded", "ordered_batch_writer", "read_ordered", "await_end", "batch_folder_writer",
           "latest_per_key", "run_to_end", "start", "TotalChangesProcessor", "stream_account_totals",
           "stream_total_changes"]
