"""Expression builders. Arguments and results are SQL texts over column names.

One text becomes one Catalyst expression, which keeps plans cheap to build; all of them stay
inside whole-stage code generation.
"""

from .calendar import completed_years, date_key, minute_key, minutes_between, padded_name, whole_days_between
from .keys import surrogate_key
from .numeric import money, ratio, zero_padded

__all__ = [
    "completed_years", "date_key", "minute_key", "minutes_between", "money", "padded_name", "ratio",
    "surrogate_key", "whole_days_between", "zero_padded",
]
