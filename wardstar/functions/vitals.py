"""Vital-sign alert rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert limits.
HR_HIGH = 120   # heart rate above this is too fast
HR_LOW = 50     # heart rate below this is too slow
SPO2_LOW = 90   # oxygen saturation below this is low

# Alert reasons, in priority order.
REASON_FAST_HR = "Heart rate too fast"
REASON_SLOW_HR = "Heart rate too slow"
REASON_LOW_SPO2 = "Low blood oxygen (SpO2)"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def alert_flag(hr: Column | str = "heart_rate", spo2: Column | str = "spo2") -> Column:
    """HR > 120 or HR < 50 or SpO2 < 90, with SQL three-valued logic.

    A NULL reading with no other breach gives NULL, which an alert filter drops.
    """
    h, s = _c(hr), _c(spo2)
    return (h > HR_HIGH) | (h < HR_LOW) | (s < SPO2_LOW)


def alert_reason(hr: Column | str = "heart_rate", spo2: Column | str = "spo2") -> Column:
    h, s = _c(hr), _c(spo2)
    return (F.when(h > HR_HIGH, REASON_FAST_HR)
            .when(h < HR_LOW, REASON_SLOW_HR)
            .when(s < SPO2_LOW, REASON_LOW_SPO2)
            .otherwise(F.lit(None).cast("string")))
