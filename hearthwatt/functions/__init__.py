from .calendar import calendar_parts, epoch_seconds, weekend_flag
from .keyed import in_first_share
from .numeric import fixed_width_bin, missing, number, percent_difference, squared
from .parsing import clock_hour, parse_date, reading_timestamp

__all__ = [
    "calendar_parts",
    "clock_hour",
    "epoch_seconds",
    "fixed_width_bin",
    "in_first_share",
    "missing",
    "number",
    "parse_date",
    "percent_difference",
    "reading_timestamp",
    "squared",
    "weekend_flag",
]
