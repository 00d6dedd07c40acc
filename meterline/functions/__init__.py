"""Column functions (billing period and key, alert text, times)."""

from .billing import (account_id, alert_message, billing_key, billing_month, billing_year,
                      epoch_millis, from_epoch_millis, instant, instant_text, over_threshold,
                      with_billing_period)

__all__ = ["account_id", "alert_message", "billing_key", "billing_month", "billing_year",
           "epoch_millis", "from_epoch_millis", "instant", "instant_text", "over_threshold",
           "with_billing_period"]
