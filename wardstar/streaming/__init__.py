"""Structured Streaming jobs."""

from .vitals import (ALERT_COLS, VITALS_SCHEMA, alerts, parse_vitals, read_vitals_stream,
                     run_vitals, write_alerts, write_vitals)

__all__ = ["VITALS_SCHEMA", "ALERT_COLS", "read_vitals_stream", "parse_vitals", "alerts",
           "write_vitals", "write_alerts", "run_vitals"]
