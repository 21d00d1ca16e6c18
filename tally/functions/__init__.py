"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from tally.functions.calendar import calendar_columns, day_of_week_sunday0, month_label
from tally.functions.numeric import (
    MONEY_SCALE,
    Money,
    round_half_away,
    safe_div,
    to_double,
)
from tally.functions.text import NULL_TOKENS, contains_any, null_tokens_to_null, strip_ws

__all__ = [
    "MONEY_SCALE", "Money", "round_half_away", "safe_div", "to_double",
    "calendar_columns", "day_of_week_sunday0", "month_label",
    "NULL_TOKENS", "contains_any", "null_tokens_to_null", "strip_ws",
]
