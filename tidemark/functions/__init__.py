"""Column-level functions (JVM built-ins only)."""

from tidemark.functions.json import json_key, json_path, json_value
from tidemark.functions.periods import (blank_default, coupled_default, daily_window,
                                        period_range, period_type, period_window,
                                        prev_month_end, prev_period, week_cycle)
from tidemark.functions.text import dot_line
from tidemark.functions.timez import (date_text, days_before, local_day, midnight_days_before,
                                      minute, ntz_to_unix_ms, parse_ts_ms, shift_zone,
                                      ts_literal, unix_ms_to_local, unix_ms_to_ntz)

__all__ = ["json_key", "json_path", "json_value", "blank_default", "coupled_default",
           "daily_window", "period_range", "period_type", "period_window", "prev_month_end",
           "prev_period", "week_cycle", "dot_line", "date_text", "days_before", "local_day",
           "midnight_days_before", "minute", "ntz_to_unix_ms", "parse_ts_ms", "shift_zone",
           "ts_literal", "unix_ms_to_local", "unix_ms_to_ntz"]
