"""Scalar column functions: billing period, billing key, alert text, ids and times.

All are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ALERT_FORMAT, ALERT_RATIO


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def billing_year(ts="ts") -> Column:
    """EXTRACT(YEAR FROM ts) as a long, in the session zone (UTC)."""
    return F.year(_c(ts)).cast("long")


def billing_month(ts="ts") -> Column:
    return F.month(_c(ts)).cast("long")


def with_billing_period(df, ts: str = "ts"):
    return df.withColumns({"billingYear": billing_year(ts), "billingMonth": billing_month(ts)})


def billing_key(account="account", year="billingYear", month="billingMonth", quota="quota") -> Column:
    """The text key ``account/year/month/quota``; grouping uses the four columns instead."""
    return F.format_string("%s/%d/%d/%d", _c(account), _c(year), _c(month), _c(quota))


def account_id(n) -> Column:
    """Zero-padded six-digit account id; longer numbers are kept whole."""
    return F.format_string("%06d", _c(n))


def over_threshold(total="total", quota="quota", ratio: float = ALERT_RATIO) -> Column:
    """``total > ratio * quota`` compared in double, strict.  Null quota never alerts."""
    return _c(total).cast("double") > F.lit(float(ratio)) * _c(quota).cast("double")


def instant_text(ts="ts") -> Column:
    """ISO-8601 UTC text of an instant, with the fraction printed as needed: none, 3 or 6 digits.

    ``2021-10-01T00:00:00Z``, ``2021-10-01T00:00:00.160Z``, ``2021-10-01T00:00:00.160001Z``.
    """
    t = _c(ts)
    micros = F.pmod(F.unix_micros(t), F.lit(1_000_000))
    frac = (F.when(micros == 0, F.lit(""))
             .when(F.pmod(micros, F.lit(1000)) == 0, F.format_string(".%03d", (micros / 1000).cast("long")))
             .otherwise(F.format_string(".%06d", micros)))
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("Z"))


def alert_message(ts="ts", account="account", total="total", quota="quota") -> Column:
    return F.format_string(ALERT_FORMAT, instant_text(ts), _c(account), _c(total), _c(quota))


def epoch_millis(ts="ts") -> Column:
    return F.unix_millis(_c(ts))


def from_epoch_millis(ms) -> Column:
    return F.timestamp_millis(_c(ms))


def instant(text: str) -> Column:
    """An ISO instant literal such as ``2021-10-01T00:00:00.000Z``."""
    return F.to_timestamp(F.lit(text))
