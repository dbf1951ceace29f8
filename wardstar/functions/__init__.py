"""Column builders: native Spark expressions, no UDFs."""

from .clean import exclude_values, fill_unknown, null_tokens
from .codes import icd9_group, prior_visits, readmit_target, risk_tier
from .dates import calendar_parts, date_key
from .rounding import exact_mean_2dp, exact_pct_2dp
from .vitals import alert_flag, alert_reason

__all__ = [
    "null_tokens", "fill_unknown", "exclude_values",
    "icd9_group", "prior_visits", "risk_tier", "readmit_target",
    "date_key", "calendar_parts", "exact_mean_2dp", "exact_pct_2dp",
    "alert_flag", "alert_reason",
]
