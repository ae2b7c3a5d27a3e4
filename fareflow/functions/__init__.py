from fareflow.functions.clean import (blank_default, clamp, clean_enum, default_false, floor_zero,
                                     trim_ws, whitelist)
from fareflow.functions.dates import days_between, elapsed, months_crossed, part, trailing_days, week_sunday
from fareflow.functions.keys import surrogate_key
from fareflow.functions.rates import exact_avg, safe_divide, safe_pct
from fareflow.functions import bands

__all__ = [
    "blank_default", "clamp", "clean_enum", "default_false", "floor_zero", "trim_ws", "whitelist",
    "days_between", "elapsed", "months_crossed", "part", "trailing_days", "week_sunday",
    "surrogate_key", "exact_avg", "safe_divide", "safe_pct", "bands",
]
