"""Column expressions shared by the operators; all are Catalyst built-ins."""

from dockmetrics.functions.flags import empty_flag, full_flag, saturation_flag, situation
from dockmetrics.functions.text import column_label, display_round, table_label
from dockmetrics.functions.time import (
    utc_day,
    utc_hour,
    with_day,
    with_event_time,
    with_partition_keys,
)

__all__ = [
    "column_label",
    "display_round",
    "empty_flag",
    "full_flag",
    "saturation_flag",
    "situation",
    "table_label",
    "utc_day",
    "utc_hour",
    "with_day",
    "with_event_time",
    "with_partition_keys",
]
