"""Batch operators: totals, as-of enrichment, running usage and alerts, slice-wise ordered scans."""

from .alerts import running_usage, usage_alerts
from .asof import as_of_join, choose_strategy, latest_per_time, version_intervals, version_stats
from .enrich import enrich_usage, enriched_view, in_time_order, to_enriched_records
from .scan import last_seen, next_in_order, running_sum, time_buckets
from .totals import account_total_changes, account_totals

__all__ = ["running_usage", "usage_alerts", "as_of_join", "choose_strategy", "latest_per_time",
           "version_intervals", "version_stats", "enrich_usage", "enriched_view", "in_time_order",
           "to_enriched_records",
           "last_seen", "next_in_order", "time_buckets", "running_sum", "account_total_changes",
           "account_totals"]
